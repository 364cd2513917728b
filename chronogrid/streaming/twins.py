"""Incremental forms of the batch operators on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronogrid.functions.numbers import exact_mean
from chronogrid.functions.timeparts import as_utc
from chronogrid.operators import align


def read_stream(spark: SparkSession, folder: str, pattern: str, schema: StructType, ts: str = "ts") -> DataFrame:
    """Parquet files of a folder as a stream, with the time column in UTC."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .parquet(folder)
        .withColumn(ts, as_utc(F.col(ts)))
    )


def windowed_mean(
    stream: DataFrame,
    value: Column,
    item: str,
    length: str,
    hop: str | None = None,
    late: str = "1 day",
    ts: str = "ts",
) -> DataFrame:
    """Mean and count per series and time window; tumbling, or sliding with a hop.

    The mean is kept as an exact sum and a count, so late rows merge in any order.
    """
    window = F.window(ts, length, hop) if hop else F.window(ts, length)
    sums = (
        stream.withWatermark(ts, late)
        .groupBy(item, window.alias("w"))
        .agg(exact_mean(value).alias("mean"), F.count(value).alias("n"))
    )
    return sums.select(
        item,
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "mean",
        "n",
    )


def sessions(stream: DataFrame, item: str, gap: str, late: str = "1 day", ts: str = "ts") -> DataFrame:
    """Runs of rows separated by pauses of at least the gap."""
    grouped = stream.withWatermark(ts, late).groupBy(item, F.session_window(ts, gap).alias("w"))
    return grouped.agg(F.count("*").alias("n")).select(
        item, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n"
    )


def first_delivery(stream: DataFrame, keys: list[str], late: str = "1 day", ts: str = "ts") -> DataFrame:
    """Re-delivered rows dropped while the watermark covers them."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def append_to(stream: DataFrame, path: str) -> DataFrame:
    """Run over the input at hand, appending finished rows to a parquet folder."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", f"{path}-progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def append_to_end(
    stream: DataFrame,
    make: Callable[[DataFrame], DataFrame],
    path: str,
    item: str,
    quiet_seconds: int,
    late_seconds: int,
    ts: str = "ts",
) -> DataFrame:
    """Run `make(stream)` over input that has ended, appending every result once.

    Append mode holds back what the watermark has not passed. So after the input a closing
    row without an item is sent, later than the last row by what may come late and by
    `quiet_seconds` (a session's gap, a window's length). It moves the watermark past all
    that is open, which is then written and leaves the state; only the closing row stays, and
    results without an item are no results.
    Meanwhile the state holds open results alone, and finished ones are never written
    again. `make` sets a watermark of `late_seconds` on `ts` and keeps the item.
    """
    spark = stream.sparkSession
    closing = f"{path}-closing"
    spark.createDataFrame([], stream.schema).write.parquet(closing)
    ended = spark.readStream.schema(stream.schema).parquet(closing)
    found = make(stream.unionByName(ended))  # a filter on the item here would move below the watermark

    def run() -> str | None:
        query = (
            found.writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", f"{path}-progress")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return (query.lastProgress or {}).get("eventTime", {}).get("watermark")

    if reached := run():
        seconds = int(datetime.fromisoformat(reached).timestamp()) + 2 * late_seconds + quiet_seconds + 2
        row = spark.range(1).select(F.timestamp_seconds(F.lit(seconds)).alias(ts))
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema if f.name != ts]
        row.select(ts, *others).select(*stream.columns).write.mode("append").parquet(closing)
        run()
    return spark.read.schema(found.schema).parquet(path).where(F.col(item).isNotNull())


def update_to(stream: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Run over the input at hand and return the latest state of every key.

    Each batch writes its changes to its own folder, so a repeated batch replaces
    itself.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{path}-progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    changes = stream.sparkSession.read.parquet(path)
    return align.keep_last(changes, keys, [F.col("epoch")]).drop("epoch")
