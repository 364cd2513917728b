"""Writers. Parquet is the default; CSV is there for files other tools expect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogrid.sources import utilisation

# Internal names that carry hyphens outside.
OUTSIDE_NAMES = {"volume_land_wind": "volume_land-wind", "volume_sea_wind": "volume_sea-wind"}
# File stem of each source's split file.
FILE_STEMS = {"mix": "electriciteitsmix", "sun": "zon", "land_wind": "wind", "sea_wind": "zeewind"}


def write_table(
    df: DataFrame,
    path: str,
    form: str = "parquet",
    partition_by: list[str] = (),
    sort_by: list[str] = (),
) -> str:
    """Write a table; `sort_by` orders the rows across the files by range.

    A partitioned table replaces only the partitions written, so a repeated run
    leaves no second copy.
    """
    out = df.orderBy(*sort_by) if sort_by else df
    writer = out.write.mode("overwrite").partitionBy(*partition_by)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if form == "csv":
        writer.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    else:
        writer.format(form).save(path)
    return path


def outside(df: DataFrame, ts_name: str = "time") -> DataFrame:
    """Column names as other tools expect them."""
    renames = {k: v for k, v in OUTSIDE_NAMES.items() if k in df.columns}
    return df.withColumnsRenamed({**renames, "ts": ts_name})


def write_history(df: DataFrame, path: str, form: str = "csv") -> str:
    """Combined history, sorted by time."""
    return write_table(outside(df), path, form, sort_by=["time"])


def split_sources(df: DataFrame) -> dict[str, DataFrame]:
    """One frame per source with the headers of the split files."""
    ts = F.col("ts").alias(utilisation.TIME_HEADER)
    parts: dict[str, DataFrame] = {}
    if "total_volume" in df.columns:
        parts["mix"] = df.select(
            ts,
            F.col("total_volume").alias(utilisation.VOLUME_HEADER),
            F.col("emissionfactor").alias(utilisation.FACTOR_HEADER),
        )
    for which in ("sun", "land_wind", "sea_wind"):
        if f"volume_{which}" in df.columns:
            parts[which] = df.select(ts, F.col(f"volume_{which}").alias(utilisation.VOLUME_HEADER))
    return parts


def write_split(df: DataFrame, directory: str, stamp: str) -> list[str]:
    """One CSV folder per source, named as the history reader expects."""
    return [
        write_table(part, f"{directory}/{FILE_STEMS[which]}-{stamp}-uur-data.csv", "csv")
        for which, part in split_sources(df).items()
    ]


def long_sources(df: DataFrame) -> DataFrame:
    """Volumes as (ts, source, volume) rows for a table partitioned by source."""
    volumes = [c for c in df.columns if c.startswith("volume_")]
    return (
        df.unpivot("ts", volumes, "source", "volume")
        .withColumn("source", F.regexp_replace("source", "^volume_", ""))
        .filter(F.col("volume").isNotNull())
    )


def write_snapshot(df: DataFrame, path: str, snapshot: str, form: str = "parquet") -> str:
    """A dated snapshot as a partition of one table, instead of a file in two folders."""
    stamped = df.withColumn("snapshot_date", F.lit(snapshot).cast("date"))
    return write_table(stamped, path, form, partition_by=["snapshot_date"])


def write_predictions(df: DataFrame, path: str, run: str, form: str = "parquet") -> str:
    """Predictions, run-up or covariates as a partition by run."""
    stamped = df.withColumn("run_ts", F.lit(run))
    return write_table(stamped, path, form, partition_by=["run_ts"])
