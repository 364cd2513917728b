"""Bootstrap bands of a regression line from one pass over the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPLICAS = 200
LEVEL = 0.95  # share of the replicas inside the band
BLOCK_ROWS = 4096  # rows weighted together

# Chances that a Poisson number with mean one is at most 0, 1, 2, ...
POISSON = np.cumsum([np.exp(-1.0) / float(np.prod(np.arange(1, k + 1))) for k in range(16)])


def poisson_weights(keys: np.ndarray, replicas: int) -> np.ndarray:
    """How often each row (by the hash of its key) takes part in each replica.

    The numbers depend on the row's key and the replica alone, so a task that is run again
    draws the same ones, and any partitioning gives the same sample.
    """
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64)[:, None] + np.arange(1, replicas + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return np.searchsorted(POISSON, (x >> np.uint64(11)) * 2.0**-53, side="right")


def bootstrap_lines(
    df: DataFrame, x: str, y: str, key: list[str], replicas: int = REPLICAS, seed: int = 42
) -> DataFrame:
    """Least-squares lines of resampled rows, as (replica, n, slope, intercept).

    In a sample with replacement a row of a large table occurs a Poisson number of times;
    here that number is drawn for each row and replica from the row's key, so all replicas
    come from one pass, and each task sends one row of sums per replica. Values are taken
    from the means of all rows, which keeps large levels from costing digits. Rows with a
    NULL or NaN value take no part; a replica without spread in `x` has a NULL line.
    """
    good = F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    pairs = df.where(good).select(
        F.xxhash64(F.lit(seed), *key).alias("key"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    )
    middle = pairs.agg(F.struct(F.avg("x").alias("x"), F.avg("y").alias("y"))).scalar()
    moved = pairs.withColumn("m", middle).select("key", (F.col("x") - F.col("m.x")).alias("x"), (F.col("y") - F.col("m.y")).alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((replicas, 5))
        for batch in batches:
            keys, a, b = (batch.column(i).to_numpy() for i in range(3))
            for begin in range(0, len(keys), BLOCK_ROWS):
                part = slice(begin, begin + BLOCK_ROWS)
                u, v = a[part], b[part]
                terms = np.stack([np.ones(len(u)), u, v, u * u, u * v], axis=1)
                sums += poisson_weights(keys[part], replicas).T @ terms
        names = ["n", "x", "y", "xx", "xy"]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(replicas)), *(pa.array(c) for c in sums.T)], ["replica", *names])

    parts = moved.mapInArrow(run, "replica long, n double, x double, y double, xx double, xy double")
    total = parts.groupBy("replica").agg(*(F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "xy")))
    spread = F.col("xx") * F.col("n") - F.col("x") * F.col("x")
    slope = F.try_divide(F.col("xy") * F.col("n") - F.col("x") * F.col("y"), spread)
    lines = total.withColumn("m", middle).withColumn("slope", slope)
    intercept = F.col("m.y") + F.try_divide(F.col("y"), F.col("n")) - F.col("slope") * (F.col("m.x") + F.try_divide(F.col("x"), F.col("n")))
    return lines.select("replica", F.col("n").cast("long").alias("n"), "slope", intercept.alias("intercept"))


def bootstrap_band(
    df: DataFrame,
    x: str,
    y: str,
    key: list[str],
    points: int = 5,
    replicas: int = REPLICAS,
    level: float = LEVEL,
    seed: int = 42,
) -> DataFrame:
    """The middle `level` of the replicas' lines at evenly spaced x, as (i, x, low, high)."""
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y))
    ends = known.agg(F.struct(F.min(x).cast("double").alias("low"), F.max(x).cast("double").alias("high"))).scalar()
    lines = bootstrap_lines(df, x, y, key, replicas, seed).where("slope IS NOT NULL").withColumn("ends", ends)
    step = (F.col("ends.high") - F.col("ends.low")) / F.lit(max(1, points - 1))
    at = lines.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    at = at.withColumn("x", F.col("ends.low") + step * F.col("i"))
    fit = F.col("intercept") + F.col("slope") * F.col("x")
    sides = F.percentile(fit, [(1 - level) / 2, (1 + level) / 2])  # of `replicas` numbers
    band = at.groupBy(F.col("i").cast("long").alias("i"), "x").agg(sides.alias("s"))
    return band.select("i", "x", F.col("s")[0].alias("low"), F.col("s")[1].alias("high"))
