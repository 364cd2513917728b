"""Quantile regression: the best lines, coverage on rows not seen, levels that do not cross."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronogrid.operators import evaluate, model, quantreg


def loss(y, line, level):
    left = y - line
    return np.maximum(left * level, left * (level - 1)).sum()


def test_lines_against_all_pairs_of_points(spark):
    """A best line goes through two of the points, so trying all pairs finds it."""
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 10, 90)
    y = 1e4 + 3 * x + rng.standard_exponential(90) * (1 + x)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    fitted = quantreg.fit(df, "y", ["x"], [0.1, 0.5, 0.9])
    got = quantreg.predict(fitted, df).toPandas()
    for level, name in ((0.1, "q10"), (0.5, "q50"), (0.9, "q90")):
        best = min(
            loss(y, y[i] + (y[j] - y[i]) / (x[j] - x[i]) * (x - x[i]), level) for i, j in combinations(range(90), 2)
        )
        assert loss(got["y"].to_numpy(), got[name].to_numpy(), level) == pytest.approx(best, rel=2e-3)


def uneven(spark, first, last):
    """Rows whose spread grows with x; the ids tell the samples apart."""
    u = (F.pmod(F.xxhash64(F.lit("u"), "id"), F.lit(99991)) + 0.5) / 99991.0
    x = F.pmod(F.xxhash64(F.lit("x"), "id"), F.lit(1000)) / 100.0
    rows = spark.range(first, last).select("id", x.alias("x"), u.alias("u"))
    noise = -F.log(F.lit(1.0) - F.col("u")) * (F.col("x") + 0.5)
    return rows.select("id", "x", (F.col("x") * 2).alias("predicted"), (F.col("x") * 2 + noise).alias("actual"))


def test_coverage_on_rows_not_seen(spark):
    """Every level covers its share within 3 points, at a smaller loss than fixed bands."""
    past, future = uneven(spark, 0, 6000), uneven(spark, 6000, 10000)
    fitted = quantreg.fit(past, "actual", ["predicted"])
    made = quantreg.predict(fitted, future).cache()
    shares = made.agg(*(F.avg((F.col("actual") <= F.col(q)).cast("double")) for q in model.quantile_names())).first()
    assert np.abs(np.array(shares) - model.QUANTILES).max() < 0.03
    bands = model.residual_bands(past.withColumn("all", F.lit(1)), ["all"], few_groups=True)
    fixed = model.quantile_forecast(future.withColumn("all", F.lit(1)), bands, ["all"])
    ours, theirs = (evaluate.band_check(f).first() for f in (made, fixed))
    assert ours["pinball_high"] < 0.9 * theirs["pinball_high"] and ours["pinball_low"] < theirs["pinball_low"]


def test_levels_do_not_cross(spark):
    fitted = quantreg.fit(uneven(spark, 0, 300), "actual", ["x"])
    names = model.quantile_names()
    far = spark.createDataFrame([(-100.0,), (0.0,), (1e4,), (None,), (float("nan"),)], "x double")
    for row in quantreg.predict(fitted, far).select(*names).collect():
        assert list(row) == sorted(row)


def test_odd_tables(spark):
    """Unknown targets are left out, unknown features are means, equal rows are exact."""
    rows = [(None, 1.0, None), (float("nan"), 1.0, None), *[(5.0, 2.0, None)] * 4, (5.0, None, None)]
    df = spark.createDataFrame(rows, "y double, x double, empty double")
    fitted = quantreg.fit(df, "y", ["x", "empty"], [0.9, 0.1])
    got = quantreg.predict(fitted, df.withColumn("q10", F.lit("old")))
    assert {(r["q10"], r["q90"]) for r in got.collect()} == {(5.0, 5.0)}
    assert got.columns == ["y", "x", "empty", "q10", "q90"]
    with pytest.raises(ValueError, match="known y"):
        quantreg.fit(df.limit(0), "y", ["x"])
    twice = df.withColumn("again", F.col("x"))
    assert quantreg.predict(quantreg.fit(twice, "y", ["x", "again"], [0.5]), twice).first()["q50"] == 5.0


def test_partitions_do_not_matter(spark):
    df = uneven(spark, 0, 2000)
    one, two = (quantreg.fit(d, "actual", ["x"], [0.2, 0.8]) for d in (df, df.repartition(13, "x")))
    assert np.allclose(one.slopes, two.slopes, rtol=1e-4) and np.allclose(one.intercepts, two.intercepts, rtol=1e-4)
