"""Ranked search against a plain version that scores every document."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from chronogrid.llm import lexical, queries

FOLDER = "/root/testdata/sf0.001"
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return PATTERN.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, top):
    counted = [(key, Counter(terms(text))) for key, text in docs]
    counted = [(key, c) for key, c in counted if c]
    n_docs, size = len(counted), sum(sum(c.values()) for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    asked = {}
    for key, text in items:
        asked.setdefault(key, set()).update(terms(text))
    out = set()
    for item, own in asked.items():
        scores = []
        for key, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // size
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
            score = sum(weight(t) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score:
                scores.append((-score, key is None, key or 0, key))
        out |= {(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)}
    return out


def corpus(rng, count):
    """Texts of words with a steep frequency, copies of one text, and odd ones."""
    word = lambda: f"w{int(rng.paretovariate(0.6))}" if rng.random() < 0.9 else rng.choice(["Ünï", "ABC", "a-b", "日本", "é\x85x", "x\x7fy"])
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(count)]
    rows += [(1000 + i, "w1 w2 w3 rare w1 copied text") for i in range(count // 3)]
    rows += [(5000, None), (5001, ""), (5002, " .,- "), (5003, "w1 " * 30000 + "deep"), (7, "w1 w2 second row"), (None, "w1 w2 w3 rare w1 copied text")]
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 25)))) for i in range(40)]
    items += [(100, "rare"), (101, "w1 W1 w2"), (102, None), (103, "absent"), (104, ""), (105, "copied rare"), (105, "w9"), (None, "deep w1")]
    return rows, items


@pytest.mark.parametrize("block, words, top", [(8192, 1 << 18, 10), (16, 1 << 18, 3), (50, 100, 10), (16, 40, 1)])
def test_against_all_scores(spark, monkeypatch, block, words, top):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "PASS_TERMS", words)
    rows, items = corpus(random.Random(block + top), 300)
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, n int, score int, item int").repartition(5)
    asked = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc string")
    got = lexical.search(docs, asked, top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, items, top)


def test_accumulators_are_limited():
    """Once the rest cannot lift a new document to the top, none gets an accumulator."""
    import numpy as np
    import pyarrow as pa

    rows = 500
    places = [[0, 1] if i < 5 else [1] for i in range(rows)]
    times = [[3, 1] if i < 5 else [1] for i in range(rows)]
    batch = pa.table({"places": pa.array(places, pa.list_(pa.int32())), "times": pa.array(times, pa.list_(pa.int64())), "n": pa.array([4] * rows)})
    block = lexical.Block.of(batch, np.array([4000, 10]), rows, 4 * rows)
    score = np.zeros(rows, np.int64)
    at = block.search(np.array([0, 1]), score, 5, 0)
    assert sorted(at.tolist()) == [0, 1, 2, 3, 4] and (score[:5] > 0).all() and not score[5:].any()


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs, items.selectExpr("item_id", "CAST(NULL AS STRING) AS text")).collect() == []
    assert len(lexical.search(docs, items).collect()) == 1


def test_query_against_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    want = con.execute(queries.ORACLES["op12_lexical_search"]).fetchall()
    got = queries.QUERIES["op12_lexical_search"](spark, FOLDER)
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
