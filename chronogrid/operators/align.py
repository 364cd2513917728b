"""Joins, unions and de-duplication on time keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogrid.session import materialise

from chronogrid.operators import ordered

# Rows up to which a summary joined to a panel travels to every task.
BROADCAST_ROWS = 500_000


def join_summary(df: DataFrame, summary: DataFrame, keys: list[str], limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join a table of one row per key to the rows it summarises.

    A join by key alone would put a whole hot series into one task. The summary is
    written and counted; up to `limit` rows it is broadcast and the rows stay where they
    are. Beyond that keys are many, and the rows are joined by key.
    """
    stored = materialise(summary, "summary")
    few = stored.count() <= limit
    return df.join(F.broadcast(stored) if few else stored, keys)


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows, failing at run time when a key occurs twice.

    The grouping leaves the rows clustered by the keys, so a join on them that
    follows needs no further shuffle.
    """
    others = [c for c in df.columns if c not in keys]
    message = F.concat(
        F.lit("key is not unique: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    )
    return (
        df.groupBy(*keys)
        .agg(*[F.any_value(c).alias(c) for c in others], F.count("*").alias("_n"))
        .filter(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(True))
        .drop("_n")
        .select(*df.columns)
    )


def left_join_one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join that fails when either side repeats a key."""
    return assert_unique(left, keys).join(assert_unique(right, keys), keys, "left")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    A grouped minimum merges map-side, so a key repeated very often is reduced
    before the shuffle; a ranking window would move all its copies to one task.
    """
    others = [c for c in df.columns if c not in keys]
    row = F.min_by(F.struct(*others), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the last in the given order (map-side, like `keep_first`)."""
    others = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*others), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def outer_align(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of frames that are each unique by the keys, in one shuffle.

    Fails at run time when a frame repeats a key, and while planning when two frames share
    a column that is no key; either would have to be merged without saying how.
    """
    columns: list[str] = []
    for frame in frames:
        own = [c for c in frame.columns if c not in keys]
        if shared := sorted(set(own) & set(columns)):
            raise ValueError(f"columns in more than one frame: {shared}")
        columns += own
    marked = [frame.withColumn("_from", F.lit(i)) for i, frame in enumerate(frames)]
    stacked = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), marked)
    twice = F.greatest(F.lit(0), *(F.count_if(F.col("_from") == i) for i in range(len(frames)))) > 1
    message = F.concat(F.lit("key is not unique: "), F.concat_ws(",", *(F.col(k).cast("string") for k in keys)))
    values = [F.max(c).alias(c) for c in columns]
    joined = stacked.groupBy(*keys).agg(*values, twice.alias("_twice"))
    unique = F.when(F.col("_twice"), F.raise_error(message).cast("boolean")).otherwise(True)
    return joined.where(unique).drop("_twice")


def union_with_priority(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of all frames; where keys collide the earlier frame wins."""
    ranked = [frame.withColumn("_rank", F.lit(i)) for i, frame in enumerate(frames)]
    stacked = ranked[0]
    for frame in ranked[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return keep_first(stacked, keys, [F.col("_rank")]).drop("_rank")


def carry_daily(
    df: DataFrame, daily: DataFrame, values: list[str], ts: str = "ts"
) -> DataFrame:
    """Each row with the values of its day, or of the latest earlier day that has them.

    The as-of look-up runs over the distinct days; the rows themselves only join by
    equality on the day. The broadcast holds at most one row per calendar day.
    """
    day = F.date_trunc("day", F.col(ts)).alias("_day")
    asked = df.select(day).distinct().select("_day", *[F.lit(None).cast("double").alias(v) for v in values])
    known = daily.select(day, *[F.col(v).cast("double").alias(v) for v in values])
    days = (
        asked.unionByName(known)
        .groupBy("_day")
        .agg(*[F.max(v).alias(v) for v in values])
        .withColumn("_series", F.lit(0))
    )
    carried = ordered.forward_fill(days, values, item="_series", ts="_day").drop("_series")
    return df.withColumn("_day", day).join(F.broadcast(carried), "_day", "left").drop("_day")


def labelled_metrics(df: DataFrame, dimensions: list[str], value: str) -> DataFrame:
    """Mean and root mean square by several dimensions in one pass.

    Rows come out as (dimension, key, mean_value, rms_value).
    """
    pairs = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("bigint").alias("key")) for d in dimensions]
    )
    return (
        df.select(F.explode(pairs).alias("p"), F.col(value).alias("_v"))
        .groupBy("p.dimension", "p.key")
        .agg(
            F.avg("_v").alias("mean_value"),
            F.sqrt(F.avg(F.col("_v") * F.col("_v"))).alias("rms_value"),
        )
    )


def label_alignment(long: DataFrame, dimensions: list[str]) -> DataFrame:
    """Metrics of several dimensions side by side on their common integer label."""
    cells = []
    for d in dimensions:
        here = F.col("dimension") == d
        cells.append(F.max(F.when(here, F.col("mean_value"))).alias(f"{d}_mean"))
        cells.append(F.max(F.when(here, F.col("rms_value"))).alias(f"{d}_rms"))
    return long.groupBy(F.col("key").alias("label")).agg(*cells)
