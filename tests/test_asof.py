"""As-of join against DuckDB, over many ranges, with ties, gaps, NULLs and one hot key."""

import random
from datetime import datetime, timedelta

import duckdb
import pandas as pd
import pytest

from chronogrid.operators import asof

START = datetime(2024, 1, 1)
LEFT, RIGHT = "i long, k string, g int, ts timestamp", "k string, g int, seen timestamp, a double, b string"


def rows(seed, n):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot"] * 8 + ["x", "y", "only left", None])
    time = lambda: None if rng.random() < 0.02 else START + timedelta(seconds=rng.choice([rng.randrange(4000), 1000, 2000]))
    left = [(i, key(), rng.randrange(2), time()) for i in range(n)]
    right = [(key(), rng.randrange(2), time(), rng.choice([None, 1.0, 2.0, 3.0]), rng.choice("pq")) for _ in range(n // 3)]
    return left, [r for r in right if r[0] != "only left"]


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("tolerance", [None, 30])
def test_against_duckdb(spark, exact, tolerance):
    left, right = rows(7, 3000)
    one, two = spark.createDataFrame(left, LEFT).repartition(5), spark.createDataFrame(right, RIGHT).repartition(3)
    got = asof.asof_join(one, two, ["k", "g"], "ts", "seen", ["a", "b"], tolerance, exact)
    assert got.columns == ["i", "k", "g", "ts", "seen", "a", "b"]
    con = duckdb.connect()
    con.register("l", pd.DataFrame(left, columns=["i", "k", "g", "ts"]))
    con.register("r", pd.DataFrame(right, columns=["k", "g", "seen", "a", "b"]))
    want = con.execute(
        f"""WITH d AS (SELECT k, g, CAST(seen AS TIMESTAMP) AS seen, a, b FROM r WHERE seen IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY k, g, seen ORDER BY a DESC NULLS LAST, b DESC) = 1)
        SELECT l.i, d.seen, d.a, d.b FROM (SELECT * REPLACE (CAST(ts AS TIMESTAMP) AS ts) FROM l) l
        ASOF LEFT JOIN d ON l.k = d.k AND l.g = d.g AND l.ts {'>=' if exact else '>'} d.seen"""
    ).fetchall()
    when = {i: ts for i, _, _, ts in left}
    expected = {}
    for i, at, a, b in want:
        fresh = at is not None and (tolerance is None or at >= when[i] - timedelta(seconds=tolerance))
        expected[i] = (at, None if a != a else a, b) if fresh else (None, None, None)
    assert {r["i"]: (r["seen"], r["a"], r["b"]) for r in got.collect()} == expected
    assert got.count() == len(left)


def test_empty_sides(spark):
    left, right = rows(1, 50)
    one, two = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    join = lambda a, b: asof.asof_join(a, b, ["k", "g"], "ts", "seen", ["a"]).collect()
    assert join(one.limit(0), two) == []
    assert {r["seen"] for r in join(one, two.limit(0))} == {None}
