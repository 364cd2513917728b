"""Regular hourly grids: spine, gaps, upsampling, frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogrid.functions.timeparts import days, hours
from chronogrid.operators import chunks
from chronogrid.operators.chunks import CHUNK, CHUNK_HOURS, GHOST


def bounds(df: DataFrame, item: str = "item_id", ts: str = "ts") -> DataFrame:
    """First and last hour of each series."""
    return df.groupBy(item).agg(
        F.date_trunc("hour", F.min(ts)).alias("lo"), F.date_trunc("hour", F.max(ts)).alias("hi")
    )


def spine(
    ranges: DataFrame,
    item: str = "item_id",
    ts: str = "ts",
    halo: int = 0,
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """Every hour of every series, generated chunk by chunk.

    `ranges` has (item, lo, hi). A series is first split into its chunks, then each
    chunk into hours, so that no row ever holds the hours of a whole series.
    """
    in_chunks = ranges.select(
        item,
        "lo",
        "hi",
        F.explode(
            F.sequence(
                chunks.chunk_of(F.col("lo"), chunk_hours),
                chunks.chunk_of(F.col("hi"), chunk_hours),
            )
        ).alias(CHUNK),
    )
    start = chunks.chunk_start(F.col(CHUNK), chunk_hours)
    last = chunks.chunk_start(F.col(CHUNK) + 1, chunk_hours) - hours(1)
    with_hours = in_chunks.select(
        item,
        CHUNK,
        F.explode(
            F.sequence(
                F.greatest(F.col("lo"), start - hours(halo)),
                F.least(F.col("hi"), last),
                hours(1),
            )
        ).alias(ts),
    )
    return with_hours.withColumn(GHOST, F.col(ts) < start)


def hourly_grid(
    df: DataFrame,
    values: list[str],
    item: str = "item_id",
    ts: str = "ts",
    halo: int = 0,
    chunk_hours: int = CHUNK_HOURS,
    ranges: DataFrame | None = None,
    keep_chunk: bool = False,
) -> DataFrame:
    """One row per series and hour; hours without data carry NULL values.

    `df` is unique by (item, ts). Spine and data are merged by a grouping that
    clusters on (item, chunk), which is the layout the chunk windows need, so the
    windows that follow add no shuffle. With a halo the chunk columns are kept for
    `chunks.windowed`; without one `keep_chunk` keeps the chunk for
    `chunks.neighbours`.
    """
    ranges = bounds(df, item, ts) if ranges is None else ranges
    empty = [F.lit(None).cast(df.schema[v].dataType).alias(v) for v in values]
    frame = spine(ranges, item, ts, halo, chunk_hours).select(item, CHUNK, GHOST, ts, *empty)
    data = chunks.with_halo(df.select(item, ts, *values), halo, ts, chunk_hours)
    merged = (
        frame.unionByName(data)
        .repartition(item, CHUNK)
        .groupBy(item, CHUNK, ts)
        .agg(F.max(GHOST).alias(GHOST), *[F.max(v).alias(v) for v in values])
    )
    if halo:
        return merged
    return merged.drop(GHOST) if keep_chunk else merged.drop(CHUNK, GHOST)


def missing_hours(df: DataFrame, item: str = "item_id", ts: str = "ts") -> DataFrame:
    """Hours of the spine without a row."""
    full = spine(bounds(df, item, ts), item, ts).select(item, ts)
    return full.join(df.select(item, ts), [item, ts], "left_anti")


def missing_report(df: DataFrame, item: str = "item_id", ts: str = "ts") -> DataFrame:
    """Number, first and last missing hour of each series that has gaps."""
    return (
        missing_hours(df, item, ts)
        .groupBy(item)
        .agg(
            F.count("*").alias("n_missing"),
            F.min(ts).alias("first_missing"),
            F.max(ts).alias("last_missing"),
        )
    )


def hourly_from_daily(
    daily: DataFrame, values: list[str], item: str = "item_id", ts: str = "ts"
) -> DataFrame:
    """Each hour from the first to the last day's midnight takes the latest day's value.

    A day expands to its own 24 hours and, where the next day is absent, up to it.
    """
    marked = daily.select(item, ts, *values).withColumn("_mark", F.lit(1))
    known = chunks.neighbours(marked, ["_mark"], item, ts)
    until = F.coalesce(F.col("_mark__next.ts") - hours(1), F.col(ts))
    return known.select(
        item, F.explode(F.sequence(F.col(ts), until, hours(1))).alias(ts), *values
    )


def day_spine(ranges: DataFrame, item: str = "item_id", day: str = "day") -> DataFrame:
    """Every day between `lo` and `hi` of each series."""
    return ranges.select(
        item,
        F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"), days(1))).alias(day),
    )


def daily_mean(
    df: DataFrame, values: list[str], item: str = "item_id", ts: str = "ts"
) -> DataFrame:
    """Mean per day; days without data are kept with NULL."""
    means = (
        df.withColumn("day", F.to_date(ts))
        .groupBy(item, "day")
        .agg(*[F.avg(v).alias(v) for v in values])
    )
    return day_spine(bounds(df, item, ts), item).join(means, [item, "day"], "left")


def inferred_step(df: DataFrame, item: str = "item_id", ts: str = "ts") -> DataFrame:
    """Most common spacing of each series, and whether it is the only one."""
    marked = chunks.neighbours(df.select(item, ts).withColumn("_mark", F.lit(1)), ["_mark"], item, ts)
    gap = marked.withColumn("step", F.unix_seconds("_mark__next.ts") - F.unix_seconds(ts))
    steps = gap.filter("step IS NOT NULL").groupBy(item, "step").count()
    return steps.groupBy(item).agg(
        F.max_by("step", F.struct(F.col("count"), -F.col("step"))).alias("step_seconds"),
        (F.count("*") == 1).alias("is_regular"),
    )
