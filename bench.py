"""Time the headline queries and print one JSON line.

Every query runs once cold and then twice warm; the better warm run counts. Extra
keys give the cold times, the row rate of the feature job, and how much faster the
chunked windows are than one window over a single long series.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronogrid import session
from chronogrid.operators import chunks, ordered
from chronogrid.plans.catalog import QUERIES

HEADLINE = [
    "p3_feature_registry",
    "t15_target_features",
    "t17_weather_features",
    "t18_price_features",
    "t3_impute_linear",
    "j1_full_outer_by_time",
    "j12_as_of_daily",
    "j7_vacation_range_join",
    "w4_rolling_mean",
    "w7_forward_fill",
    "a5_grouping_sets",
    "a23_lagged_correlation",
    "x14_quantile_bins",
    "x8_utc_to_local",
    "c2_welch_test",
    "e1_metrics",
    "e12_feature_profile",
    "m4_backtest_windows",
    "m6_seasonal_naive_week",
    "v9_daily_with_regime",
]


def seconds(df: DataFrame) -> float:
    begin = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def timed(spark: SparkSession, name: str, folder: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def long_series(spark: SparkSession, folder: str) -> DataFrame:
    """One hourly series as long as the order table."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    series = orders.select(
        F.lit("a").alias("item_id"),
        F.timestamp_seconds(F.col("o_orderkey") * 3600).alias("ts"),
        F.col("o_totalprice").alias("y"),
    )
    return session.materialise(series, "long-series")


def chunk_speedup(spark: SparkSession, folder: str) -> dict[str, float]:
    """Rolling mean and deviation over a week: one window against chunks."""
    series = long_series(spark, folder)
    frame = Window.partitionBy("item_id").orderBy("ts").rowsBetween(-167, 0)
    whole = series.select("ts", F.avg("y").over(frame).alias("m"), F.stddev_samp("y").over(frame).alias("s"))
    cut = chunks.windowed(
        series,
        168,
        lambda w: {"m": ordered.rolling_mean("y", 168), "s": ordered.rolling_std("y", 168)},
        spread={"y": [168]},
    )
    cut_time = min(seconds(cut) for _ in range(2))
    whole_time = min(seconds(whole) for _ in range(2))
    return {"single_window_sec": round(whole_time, 3), "chunked_sec": round(cut_time, 3), "speedup": round(whole_time / cut_time, 2)}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.local_session(cpus, "bench")
    cold, warm = {}, {}
    for name in HEADLINE:
        cold[name] = round(timed(spark, name, folder), 3)
        warm[name] = round(min(timed(spark, name, folder) for _ in range(2)), 3)
    rows = spark.read.parquet(f"{folder}/events.parquet").count()
    result = {
        "metric": "headline queries, warm wall time",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cold": cold,
        "feature_job_events_per_sec": round(rows / warm["p3_feature_registry"]),
        "long_series": chunk_speedup(spark, folder),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
