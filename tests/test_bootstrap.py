"""Bootstrap bands: repeatable, right per replica, and close to the closed form."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronogrid.operators import bootstrap, stats


@pytest.fixture(scope="module")
def rows(spark):
    noise = (F.pmod(F.xxhash64(F.lit("n"), "id"), F.lit(2001)) - 1000) / 300.0
    x = F.pmod(F.xxhash64(F.lit("x"), "id"), F.lit(1000)) / 100.0 + 1e6
    return spark.range(3000).select("id", x.alias("x"), (x * 2 - 5 + noise).alias("y")).cache()


def test_lines_of_weighted_rows(spark, rows):
    """Each replica is the line of its rows, every row as often as its weight says."""
    got = {r["replica"]: r for r in bootstrap.bootstrap_lines(rows, "x", "y", ["id"], 7).collect()}
    data = rows.select(F.xxhash64(F.lit(42), "id").alias("key"), "x", "y").toPandas()
    weights = bootstrap.poisson_weights(data["key"].to_numpy(), 7)
    assert abs(weights.mean() - 1) < 0.02 and abs(weights.var() - 1) < 0.05
    for k in range(7):
        slope, level = np.polyfit(data["x"] - 1e6, data["y"], 1, w=np.sqrt(weights[:, k]))
        assert got[k]["n"] == weights[:, k].sum()
        assert got[k]["slope"] == pytest.approx(slope, rel=1e-8)
        assert got[k]["intercept"] + got[k]["slope"] * 1e6 == pytest.approx(level, rel=1e-8)


def test_band_is_repeatable_and_close_to_the_closed_form(spark, rows):
    one = bootstrap.bootstrap_band(rows, "x", "y", ["id"], 5, 400).orderBy("i").collect()
    two = bootstrap.bootstrap_band(rows.repartition(3, "y"), "x", "y", ["id"], 5, 400).orderBy("i").collect()
    line = stats.ols_band(rows, "x", "y", 5).orderBy("i").collect()
    for a, b, c in zip(one, two, line, strict=True):
        assert (a["low"], a["high"]) == pytest.approx((b["low"], b["high"]), rel=1e-12)
        assert a["x"] == pytest.approx(c["x"]) and a["low"] < c["fit"] < a["high"]
        assert a["high"] - a["low"] == pytest.approx(2 * 1.96 * c["std_error"], rel=0.25)


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 1.0), (3, 2.0, 1.0)], "id long, x double, y double")
    assert bootstrap.bootstrap_band(frame, "x", "y", ["id"], 3, 5).collect() == []
    assert {r["slope"] for r in bootstrap.bootstrap_lines(frame, "x", "y", ["id"], 5).collect()} == {None}
    assert bootstrap.bootstrap_band(frame.limit(0), "x", "y", ["id"], 3, 5).collect() == []
