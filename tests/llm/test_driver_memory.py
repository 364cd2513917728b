"""What finished steps leave on the driver goes before its heap is full."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from chronogrid.llm import components, simhash


def collections(spark):
    """How often the whole heap of the driver was collected on request so far."""
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(bean.getCollectionCount() for bean in beans if "Old" in bean.getName() or "MarkSweep" in bean.getName())


def through_components(spark, folder):
    links = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components.components(links).count() == 41


def through_the_pipeline(spark, folder):
    corpus_pipeline.run(spark, folder)


@pytest.mark.parametrize("work", [through_components, through_the_pipeline])
def test_heap_is_collected_between_steps(spark, tmp_path, monkeypatch, work):
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", lambda spark, docs, folder: docs)] * 2)
    spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    before = collections(spark)
    work(spark, str(tmp_path))
    assert collections(spark) > before


def test_a_round_of_links_shuffles_no_more_than_it_must(spark):
    """Each shuffle of a round is as many tasks for the driver as there are partitions."""
    links = spark.range(40).select((F.col("id") + 1).alias("up"), F.col("id").alias("down"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = components._upper(components._lower(links))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") <= 7


def test_groups_of_near_copies_are_sized_without_their_texts(spark, monkeypatch):
    seen = []
    plain = simhash.split_buckets

    def watching(rows, key, item, limit):
        seen.append(rows.columns)
        return plain(rows, key, item, limit)

    monkeypatch.setattr(simhash, "split_buckets", watching)
    words = " ".join(f"v{i}" for i in range(90))
    rows = [(1, words), (1, words), (2, words + " x"), (3, "another text"), (4, words + " x")]
    kept = simhash.first_of_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3]
    assert seen == [["node", "component"]]
