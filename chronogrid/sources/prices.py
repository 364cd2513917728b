"""Readers for price files with `;` separators and decimal commas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from chronogrid.functions.numbers import decimal_comma
from chronogrid.functions.timeparts import parse_timestamp
from chronogrid.operators import align, impute

# File patterns of the yearly electricity and the single gas file.
ELECTRICITY_GLOB = "*dynamische_stroomprijzen_jaar_*.csv"
GAS_GLOB = "*dynamische_gasprijzen_alltime.csv"


def parse_prices(raw: DataFrame, name: str) -> DataFrame:
    """First two columns by position as (ts, name, _file); unreadable times are dropped.

    Each row is parsed on its own: the day-first format, then ISO. Both decimal
    styles are read.
    """
    time_column, price_column = raw.columns[0], raw.columns[1]
    return raw.select(
        parse_timestamp(F.col(f"`{time_column}`")).alias("ts"),
        decimal_comma(F.col(f"`{price_column}`")).alias(name),
        F.col("_metadata.file_path").alias("_file"),
    ).filter(F.col("ts").isNotNull())


def read_prices(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Prices, one row per time; a duplicated time keeps the first file's row.

    Missing prices become the mean of the file set.
    """
    try:
        raw = spark.read.option("header", True).option("sep", ";").csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no price files at {path}") from error
    rows = parse_prices(raw, name)
    first = align.keep_first(rows, ["ts"], [F.col("_file"), F.col(name)])
    return impute.impute_mean(first.drop("_file"), name)


def read_electricity(spark: SparkSession, directory: str) -> DataFrame:
    """Hourly electricity prices of all years."""
    return read_prices(spark, f"{directory}/{ELECTRICITY_GLOB}", "elec_price")


def read_gas(spark: SparkSession, directory: str) -> DataFrame:
    """Daily gas prices."""
    return read_prices(spark, f"{directory}/{GAS_GLOB}", "gas_price")


def duplicate_times(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows whose time was already seen: all rows less the distinct times."""
    per_time = df.groupBy(ts).agg(F.count("*").alias("n"))
    return per_time.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_times"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
    )
