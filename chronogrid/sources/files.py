"""Readers for result and feature files, and selection of the latest file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from chronogrid.functions import schema as names
from chronogrid.functions.timeparts import parse_timestamp

# Fixed value: a date in a file name, with or without separators.
DATE_IN_NAME = r"(\d{4})[-_]?(\d{2})[-_]?(\d{2})"


def logical_file(path: Column) -> Column:
    """Name of a file, or of the folder when a writer split the file into parts."""
    return F.regexp_extract(path, r"([^/]+?)(/part-[^/]*)?$", 1)


def listing(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The files at `paths` without their content: file (or the folder that a writer
    split it into), name and time of the last change. No file at all is an error."""
    try:
        found = spark.read.format("binaryFile").load(paths)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise FileNotFoundError(f"no input files at {paths}") from error
    whole = F.regexp_replace("path", r"/part-[^/]*$", "").alias("file")
    return found.select(whole, F.col("modificationTime").alias("modified")).groupBy("file").agg(
        F.max("modified").alias("modified")
    ).select("file", logical_file(F.col("file")).alias("name"), "modified")


def newest_file(spark: SparkSession, paths: str | list[str], by: str) -> str:
    """The file with the latest date in its name (`by` name) or the last change (`by`
    time); the later name wins a tie. Only the listing is looked at, so an empty newest
    file is found too."""
    key = name_date(F.col("name")) if by == "name" else F.col("modified")
    found = listing(spark, paths).agg(F.max(F.struct(key.alias("key"), "name", "file")).alias("top")).first()["top"]
    if found is None:
        raise FileNotFoundError(f"no input files at {paths}")
    return found["file"]


def headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(header, files): the distinct first lines of the files at `paths` and who has them.

    One pass over the lines, as many jobs for any number of files: each file's first block
    gives its first line. A file without any line has no header. Of a file in parts the
    first part with a line counts.
    """
    lines = spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start")
    lines = lines.where("file_block_start = 0").withColumn("place", F.monotonically_increasing_id())
    path = F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B")))
    whole = F.regexp_replace(path, r"/part-[^/]*$", "").alias("file")
    first = lines.groupBy(whole).agg(F.min_by("value", F.struct("file_path", "place")).alias("header"))
    return first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))


def read_csv_set(spark: SparkSession, paths: str | list[str], sep: str = ",") -> DataFrame:
    """A set of CSV files as text columns, each file under its own header.

    The headers are found in one job (see `headers`); only distinct ones, with the names of
    their files, reach the driver. Files with the same header are read together, and the
    groups are put together by name. A column that a file lacks is NULL in its rows. Files
    without any line have no rows; if all are such, or there are none, that is an error. Adds the file's path, name and time.
    """
    reader = lambda: spark.read.option("header", True).option("sep", sep)
    try:
        groups = [row["files"] for row in headers(spark, paths).orderBy("header").collect()]
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise FileNotFoundError(f"no input files at {paths}") from error
    if not groups:
        raise FileNotFoundError(f"no input files at {paths}")
    parts = []
    for members in groups:
        text = T.StructType([T.StructField(c, T.StringType()) for c in reader().csv(members[0]).columns])
        parts.append(
            reader().schema(text).csv(members).withColumns(
                {
                    "_path": F.col("_metadata.file_path"),
                    "_file": logical_file(F.col("_metadata.file_path")),
                    "_modified": F.col("_metadata.file_modification_time"),
                }
            )
        )
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV by header name with all columns as text, plus file name and time."""
    return read_csv_set(spark, path).drop("_path")


def _typed(df: DataFrame, text: tuple[str, ...] = ()) -> DataFrame:
    """Time column parsed to `ts`, the other columns as numbers unless named in text."""
    time_name = "ts" if "ts" in df.columns else names.find_column(df.columns, *names.TIME_WORDS)
    others = [c for c in df.columns if c != time_name]
    return df.select(
        parse_timestamp(F.col(f"`{time_name}`")).alias("ts"),
        *[
            F.col(f"`{c}`").alias(_plain(c)) if c in text else F.col(f"`{c}`").try_cast("double").alias(_plain(c))
            for c in others
        ],
    )


def _plain(name: str) -> str:
    """Internal column name: hyphens as underscores, quantiles as q10 .. q90."""
    if name.startswith("0."):
        return f"q{int(round(float(name) * 100)):02d}"
    return name.replace("-", "_")


def read_series(spark: SparkSession, path: str, text: tuple[str, ...] = ()) -> DataFrame:
    """A time-keyed CSV with numeric columns: features, temperatures, forecasts."""
    raw = read_text_table(spark, path)
    return _typed(raw.drop("_file", "_modified"), text)


def read_price_features(spark: SparkSession, path: str) -> DataFrame:
    """The price feature table from CSV, or from parquet when the path says so."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return read_series(spark, path, text=("crisis_phase", "item_id"))


def name_date(name: Column) -> Column:
    """Date in a file name as yyyymmdd text, empty when there is none."""
    return F.concat(*[F.regexp_extract(name, DATE_IN_NAME, i) for i in (1, 2, 3)])


def read_newest(spark: SparkSession, paths: str | list[str], by: str) -> DataFrame:
    """The text table of the newest file alone."""
    return read_text_table(spark, newest_file(spark, paths, by))


def read_emissions(spark: SparkSession, path: str) -> DataFrame:
    """Newest combined history with normalised names (ts, emission_factor, volumes)."""
    raw = read_newest(spark, path, "name").drop("_file", "_modified")
    names.require_columns(raw, ["emissionfactor"])
    return _typed(raw).withColumnRenamed("emissionfactor", "emission_factor")


def read_forecast_pair(spark: SparkSession, forecast: str, prediction: str) -> DataFrame:
    """Newest production forecast and newest prediction side by side by hour."""
    left = _typed(read_newest(spark, forecast, "time").drop("_file", "_modified"))
    right = _typed(read_newest(spark, prediction, "time").drop("_file", "_modified"), ("item_id",))
    return left.join(right, "ts")


def read_correlation_inputs(spark: SparkSession, history: str, temperatures: str) -> DataFrame:
    """History and temperature series joined by hour."""
    return read_series(spark, history).join(read_series(spark, temperatures), "ts")


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
