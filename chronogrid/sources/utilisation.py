"""Readers for utilisation data: split CSV files and landed JSON pages."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogrid.functions.timeparts import days, parse_timestamp
from chronogrid.operators import align
from chronogrid.sources.files import read_csv_set

# Headers and file patterns of the split CSV files.
TIME_HEADER = "validfrom (UTC)"
VOLUME_HEADER = "volume (kWh)"
FACTOR_HEADER = "emissionfactor (kg CO2/kWh)"
HISTORY_GLOBS = {
    "mix": "electriciteitsmix-*-uur-data.csv",
    "sun": "zon-*-uur-data.csv",
    "land_wind": "wind-*-uur-data.csv",
    "sea_wind": "zeewind-*-uur-data.csv",
}
FORECAST_GLOBS = {
    "sun": "zon-uur-voorspelling*.csv",
    "land_wind": "wind-uur-voorspelling*.csv",
    "sea_wind": "zeewind-uur-voorspelling*.csv",
}

# Codes by which landed rows are selected.
TYPE_CODES = {"mix": 27, "sun": 2, "land_wind": 1, "sea_wind": 17}
CLASSIFICATION = {"forecast": 1, "history": 2}

# Window lengths in days.
FORECAST_DAYS = 7
RUNUP_DAYS = 28
HISTORY_DAYS = 4 * 365

MEMBER_SCHEMA = "validfrom STRING, volume STRING, emissionfactor DOUBLE"


def _scan(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """CSV files, each by its own header, all text; `_file` is the path."""
    return read_csv_set(spark, paths).drop("_file", "_modified").withColumnRenamed("_path", "_file")


def _newest(rows: DataFrame) -> DataFrame:
    """One row per hour; the file with the latest dated name wins."""
    values = [c for c in rows.columns if c not in ("ts", "_file")]
    return align.keep_last(rows, ["ts"], [F.col("_file"), *map(F.col, values)]).drop("_file")


def read_mix(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Mix files as (ts, total_volume, emissionfactor)."""
    rows = _scan(spark, paths).select(
        parse_timestamp(F.col(f"`{TIME_HEADER}`")).alias("ts"),
        F.col(f"`{VOLUME_HEADER}`").cast("double").alias("total_volume"),
        F.col(f"`{FACTOR_HEADER}`").cast("double").alias("emissionfactor"),
        "_file",
    )
    return _newest(rows)


def read_production(spark: SparkSession, paths: str | list[str], which: str) -> DataFrame:
    """Production files of one source as (ts, volume_{which})."""
    rows = _scan(spark, paths).select(
        parse_timestamp(F.col(f"`{TIME_HEADER}`")).alias("ts"),
        F.col(f"`{VOLUME_HEADER}`").cast("double").alias(f"volume_{which}"),
        "_file",
    )
    return _newest(rows)


def read_source(spark: SparkSession, paths: str | list[str], which: str) -> DataFrame:
    """All files of one source."""
    return read_mix(spark, paths) if which == "mix" else read_production(spark, paths, which)


def read_history(spark: SparkSession, directory: str) -> DataFrame:
    """The four sources side by side by hour; a source without files is an error."""
    frames = [
        read_source(spark, f"{directory}/{glob}", which) for which, glob in HISTORY_GLOBS.items()
    ]
    return align.outer_align(frames, ["ts"])


def read_forecast(spark: SparkSession, directory: str) -> DataFrame:
    """The three production forecasts side by side by hour."""
    frames = [
        read_source(spark, f"{directory}/{glob}", which) for which, glob in FORECAST_GLOBS.items()
    ]
    return align.outer_align(frames, ["ts"])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON pages cut at every closing brace, as (member, last, _file).

    A member of a page is an object without objects inside, so what lies between two
    closing braces holds one member at most. Spark cuts the files into byte ranges as it
    does with lines, so a page of any size is read by several tasks and none holds it
    whole. A piece that names a `validfrom` but does not read as an object (a brace inside
    a text) is an error. `last` is the last page's address where a piece announces it.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    body = F.concat(F.lit("{"), F.substring_index("value", "{", -1), F.lit("}"))
    named = F.col("value").contains('"validfrom"')
    member = F.when(named, F.from_json(body, MEMBER_SCHEMA, {"mode": "FAILFAST"}))
    last = F.regexp_extract("value", r'"hydra:last"\s*:\s*"([^"]*)"', 1)
    return pieces.select(member.alias("member"), F.nullif(last, F.lit("")).alias("last"), "_file")


def page_members(pages: DataFrame, which: str) -> DataFrame:
    """Members of all pages as hourly rows of one source, newest copy of an hour kept."""
    known = pages.where("member IS NOT NULL")
    ts = parse_timestamp(F.col("member.validfrom")).alias("ts")
    volume = F.col("member.volume").cast("double")
    if which == "mix":
        columns = [volume.alias("total_volume"), F.col("member.emissionfactor").alias("emissionfactor")]
    else:
        columns = [volume.alias(f"volume_{which}")]
    return _newest(known.select(ts, *columns, "_file"))


def page_check(pages: DataFrame) -> DataFrame:
    """Number of landed pages against the last page number the source announced."""
    last = F.regexp_extract("last", r"page=(\d+)", 1).try_cast("bigint")
    return pages.agg(
        F.max(last).alias("expected_pages"), F.count_distinct("_file").alias("landed_pages")
    ).withColumn("is_complete", F.col("expected_pages") == F.col("landed_pages"))


def page_manifest(pages: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """(day, files, members): which files hold a day's members, and how many there are.

    Grows by the day: with an earlier manifest as `days`, only pages that it does not name
    have to be read.
    """
    known = pages.where("member IS NOT NULL")
    day = F.to_date(parse_timestamp(F.col("member.validfrom"))).alias("day")
    found = known.groupBy(day, "_file").agg(F.count("*").alias("n")).groupBy("day").agg(
        F.sort_array(F.collect_list("_file")).alias("files"), F.sum("n").alias("members")
    )
    if days is None:
        return found
    both = days.unionByName(found).groupBy("day")
    files = F.array_sort(F.array_distinct(F.flatten(F.collect_list("files"))))
    return both.agg(files.alias("files"), F.sum("members").alias("members"))


def read_feed(spark: SparkSession, directories: dict[str, str]) -> DataFrame:
    """Several landed sources, given as name to directory, side by side by hour."""
    frames = [page_members(read_pages(spark, path), which) for which, path in directories.items()]
    return align.outer_align(frames, ["ts"])


def select_landed(
    landed: DataFrame, which: str, kind: str, start: date, end: date, ts: str = "ts"
) -> DataFrame:
    """Rows of one source and class in the half-open window [start, end).

    On a table partitioned by type, classification and date only the matching
    partitions are listed.
    """
    keep = (
        (F.col("type") == TYPE_CODES[which])
        & (F.col("classification") == CLASSIFICATION[kind])
        & (F.col(ts) >= F.lit(start).cast("timestamp"))
        & (F.col(ts) < F.lit(end).cast("timestamp"))
    )
    if "date" in landed.columns:
        keep = keep & (F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(end))
    return landed.filter(keep)


def window_of(kind: str, today: date) -> tuple[date, date]:
    """Half-open date window of a request: forecast, runup or history."""
    if kind == "forecast":
        return today, today + timedelta(days=FORECAST_DAYS)
    length = {"runup": RUNUP_DAYS, "history": HISTORY_DAYS}[kind]
    return today - timedelta(days=length), today


def lookback(df: DataFrame, n_days: int | None, item: str = "item_id", ts: str = "ts") -> DataFrame:
    """Rows of the last n_days before each series' last row; None keeps all."""
    if n_days is None:
        return df
    ends = df.groupBy(item).agg(F.max(ts).alias("_end"))
    return align.join_summary(df, ends, [item]).filter(F.col(ts) >= F.col("_end") - days(n_days)).drop("_end")
