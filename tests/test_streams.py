"""Streams that end: every result once, in append mode, over several batches."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from chronogrid.streaming import twins

START = datetime(2024, 1, 1)


def run(spark, tmp_path, batches, gap=1800, late=3600):
    """Sessions of rows given as batches of (item, minute); one file and one batch each."""
    folder = tmp_path / "in"
    schema = "item string, ts timestamp"
    for i, rows in enumerate(batches):
        made = spark.createDataFrame([(item, START + timedelta(minutes=m)) for item, m in rows], schema)
        made.coalesce(1).write.parquet(str(folder / f"b{i}.parquet"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(folder))
    make = lambda s: twins.sessions(s, "item", f"{gap} seconds", f"{late} seconds")
    out = twins.append_to_end(stream, make, str(tmp_path / "out"), "item", gap, late)
    assert out.count() == out.distinct().count()
    found = {(r["item"], int((r["session_start"] - START).total_seconds() / 60)): r["n"] for r in out.collect()}
    return found, tmp_path / "out-progress"


def state_rows(spark, progress):
    """Rows left in the state of the last batch."""
    return spark.read.format("statestore").load(str(progress)).count()


def test_open_sessions_are_written_at_the_end(spark, tmp_path):
    found, progress = run(spark, tmp_path, [[("a", 0), ("a", 10), ("a", 100), ("b", 5)]])
    assert found == {("a", 0): 2, ("a", 100): 1, ("b", 5): 1}
    assert state_rows(spark, progress) == 1  # the closing row


def test_batches_with_late_rows(spark, tmp_path):
    """Rows up to an hour late join their session; older ones come too late."""
    batches = [[("a", 0), ("b", 0)], [("a", 20), ("a", 600)], [("a", 590), ("b", 570)], [("a", 5), ("b", 1200)], [(None, 1300)]]
    found, progress = run(spark, tmp_path, batches)
    assert found == {("a", 0): 2, ("b", 0): 1, ("a", 590): 2, ("b", 570): 1, ("b", 1200): 1}
    assert state_rows(spark, progress) == 1


def test_state_holds_open_sessions_only(spark, tmp_path):
    """A thousand sessions one after the other; the state never holds more than a few."""
    batches = [[("a", 120 * k + 10 * b) for k in range(b * 50, b * 50 + 50)] for b in range(4)]
    found, progress = run(spark, tmp_path, batches)
    assert len(found) == 200 and set(found.values()) == {1}
    assert state_rows(spark, progress) == 1


def test_no_input(spark, tmp_path):
    schema = "item string, ts timestamp"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "none"))
    out = twins.append_to_end(stream, lambda s: twins.sessions(s, "item", "30 minutes"), str(tmp_path / "out"), "item", 1800, 86400)
    assert out.where(F.col("item").isNotNull()).count() == 0
