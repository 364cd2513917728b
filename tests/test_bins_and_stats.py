"""Exact quantiles, bins, p-values, autocorrelation and summaries."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronogrid.functions.tails import t_tail
from chronogrid.operators import bins, evaluate, selection, stats


def values(spark, xs, name="v"):
    return spark.createDataFrame([(None if x is None else float(x),) for x in xs], f"{name} double")


def test_quartile_edges_and_bins(spark):
    df = values(spark, range(1, 7))
    edges = bins.exact_quantiles(df, [], ["v"], [0, 0.25, 0.5, 0.75, 1]).first()["edges"]
    assert edges == [1, 2.25, 3.5, 4.75, 6]
    got = [r["bin"] for r in bins.quantile_bins(df, "v", 4).orderBy("v").collect()]
    assert got == [0, 0, 1, 2, 3, 3]


def test_tied_edges_give_no_bins(spark):
    df = values(spark, [0, 0, 0, 0, 0, 1, 2, 3, 4])
    assert {r["bin"] for r in bins.quantile_bins(df, "v", 4).collect()} == {None}


def test_equal_width_bins(spark):
    df = values(spark, [0, 0, 5, 10])
    low, high = F.lit(0.0), F.lit(10.0)
    got = [r[0] for r in df.orderBy("v").select(bins.equal_width_bin(F.col("v"), low, high, 3)).collect()]
    assert got == [0, 0, 1, 2]
    edges = df.select(bins.equal_width_edges(low, high, 3)).first()[0]
    assert edges == pytest.approx([-0.01, 10 / 3, 20 / 3, 10])


@pytest.mark.parametrize("few_groups", [True, False])
def test_quantiles_match_numpy_with_hot_group_and_ties(spark, few_groups):
    """A group of two thirds of the rows, ties, NULL and NaN values and a NULL group."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": np.where(rng.random(9000) < 0.67, "hot", "cold"), "v": rng.lognormal(1, 2, 9000).round(1)})
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 0.9, 1.0]
    more = spark.createDataFrame([("hot", None), ("cold", float("nan")), ("empty", None)], "k string, v double")
    out = bins.exact_quantiles(spark.createDataFrame(pdf).unionByName(more), ["k"], ["v"], probs, few_groups).collect()
    assert {row["k"] for row in out} == {"hot", "cold"}
    for row in out:
        want = np.quantile(pdf.loc[pdf.k == row["k"], "v"], probs)
        np.testing.assert_allclose(row["edges"], want, rtol=1e-12)
        assert row["n"] == (pdf.k == row["k"]).sum()


ODD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1e-310, 1.0, 1.0 - 2**-53, 1 + 2**-52]
ODD += [-1.5, 3.0, 2.0**500, 2.0**500 - 2.0**447, 1.7976931348623157e308, -1.7976931348623157e308, float("inf"), -float("inf"), 0.1, 1e23]


def test_bits_keep_order_and_value(spark):
    rng = np.random.default_rng(4)
    xs = [*ODD, *(rng.integers(-(2**63), 2**63, 3000).view(float))]
    xs = [float(x) for x in xs if x == x] + [2.0**k for k in range(-1074, 1024)] + [float(np.nextafter(2.0**k, 0)) for k in range(-1060, 1024)]
    made = selection.with_bits(values(spark, xs), "v", "b")
    rows = made.select("v", "b", selection.double_of(F.col("b")).alias("again")).collect()
    for r in rows:
        want = int(np.float64(abs(r["v"])).view(np.int64)) * (-1 if r["v"] < 0 else 1)
        assert r["b"] == want and r["again"] == r["v"]
    none = selection.with_bits(values(spark, [float("nan"), None]), "v", "b").select("b")
    assert none.collect() == [(None,), (None,)]


def test_ranks_of_odd_numbers(spark):
    xs = ODD * 3
    wanted = F.transform(F.sequence(F.lit(0), F.lit(len(xs))), lambda i: F.struct(i.alias("name"), i.cast("long").alias("rank")))
    long = values(spark, xs).withColumn("g", F.lit("one"))
    for few in (True, False):
        got = selection.select_ranks(long, ["g"], wanted, few_groups=few).orderBy("name").collect()
        assert [r["v"] for r in got] == sorted(xs)


def test_quantiles_of_ten_million_rows_in_one_group(spark):
    """A permutation of 1..10^7, and half of the rows equal."""
    n = 10_000_000
    rows = spark.range(n).select(((F.col("id") * 7_368_787) % n + 1).cast("double").alias("v"))
    rows = rows.withColumn("w", F.when(F.col("v") <= n // 2, F.lit(3.25)).otherwise(F.col("v") / 7))
    got = {r["feature"]: r for r in bins.exact_quantiles(rows, [], ["v", "w"], [0.25, 0.5, 0.9999]).collect()}
    assert got["v"]["n"] == n
    assert got["v"]["edges"] == pytest.approx([1 + (n - 1) * p for p in (0.25, 0.5, 0.9999)], rel=1e-15)
    assert got["w"]["edges"][0] == 3.25 and got["w"]["edges"][1] == pytest.approx((3.25 + (n // 2 + 1) / 7) / 2)


def test_t_tail_known_values():
    assert t_tail(2.228138852, 10) == pytest.approx(0.05, abs=1e-9)
    assert t_tail(1.0, 1) == pytest.approx(0.5)
    assert t_tail(0.0, 5) == pytest.approx(1.0)
    assert t_tail(-12.706204736, 1) == pytest.approx(0.05, abs=1e-9)
    assert t_tail(None, 3) is None


def test_pearson_skips_null_and_nan_pairs(spark):
    rows = [(1.0, 2.0), (2.0, 4.1), (3.0, None), (float("nan"), 1.0), (4.0, 7.7)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = stats.pearson_test(df, "a", "b").first()
    assert got["n"] == 3 and got["corr"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4.1, 7.7])[0, 1])


def test_perfect_correlation_has_zero_p(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(9)], "a double, b double")
    got = stats.pearson_test(df, "a", "b").first()
    assert got["corr"] == pytest.approx(1.0) and got["p_value"] == pytest.approx(0.0, abs=1e-12)


def test_partial_autocorrelation_solves_yule_walker(spark, hourly):
    rng = np.random.default_rng(5)
    x = np.zeros(600)
    for i in range(2, 600):
        x[i] = 0.6 * x[i - 1] - 0.3 * x[i - 2] + rng.normal()
    got = {r["lag"]: r["pacf"] for r in stats.partial_autocorrelation(hourly(x), "y", 4).collect()}
    d = x - x.mean()
    rho = np.array([d[k:] @ d[: len(d) - k] for k in range(5)]) / (d @ d)
    for k in range(1, 5):
        toeplitz = np.array([[rho[abs(i - j)] for j in range(k)] for i in range(k)])
        assert got[k] == pytest.approx(np.linalg.solve(toeplitz, rho[1 : k + 1])[-1], abs=1e-9)


@pytest.mark.parametrize("chunk", [100, 8192])
@pytest.mark.parametrize("offset", [0.0, 1e8])
def test_autocorrelation_at_a_high_level(spark, hourly, chunk, offset):
    """A level of 10^8 costs no digits, and the chunk length does not matter."""
    rng = np.random.default_rng(6)
    x = np.sin(np.arange(900) / 3) + 0.3 * rng.normal(size=900) + offset
    holes = [None if i % 41 == 7 else v for i, v in enumerate(x)]
    got = {r["lag"]: r["acf"] for r in stats.autocorrelation(hourly(holes), "y", 30, chunk_hours=chunk).collect()}
    kept = np.array([v for v in holes if v is not None])
    d = kept - kept.mean()
    want = [d[k:] @ d[: len(d) - k] / (d @ d) for k in range(31)]
    assert got[0] == pytest.approx(1.0, abs=1e-12)
    # A mean near 10^8 is itself only known to 1.5e-8.
    assert [got[k] for k in range(31)] == pytest.approx(want, abs=1.5e-8 if offset else 1e-9)


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [3.0, 1.0, 4.0, 1.0, 5.0], "b": [2.0, 7.0, 1.0, 8.0, 2.0]})
    got = {r["feature"]: r for r in stats.describe(spark.createDataFrame(pdf), ["a", "b"]).collect()}
    for name, want in pdf.describe().items():
        row = got[name]
        assert [row[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(list(want))


def test_welch_test_matches_formula(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 6.0, 9.0]
    df = spark.createDataFrame([(x, 0) for x in a] + [(x, 1) for x in b], "v double, f int")
    got = stats.welch_test(df, "v", "f").first()
    va, vb = np.var(a, ddof=1) / 4, np.var(b, ddof=1) / 3
    assert got["t_stat"] == pytest.approx((2.5 - 17 / 3) / np.sqrt(va + vb))
    assert got["freedom"] == pytest.approx((va + vb) ** 2 / (va**2 / 3 + vb**2 / 2))


def test_profile_chooses_a_method_per_feature(spark):
    pdf = pd.DataFrame({"one": 3.0, "two": [0.0, 1.0] * 20, "ties": [0.0] * 30 + list(range(1, 11)), "many": range(40), "error": 1.0})
    out = evaluate.feature_profile(spark.createDataFrame(pdf), ["one", "two", "ties", "many"])
    methods = {(r["feature"], r["method"]): r["n"] for r in out.groupBy("feature", "method").agg(F.sum("n").alias("n")).collect()}
    assert methods == {
        ("one", "single"): 40,
        ("two", "equal_width"): 40,
        ("ties", "counts"): 34,
        ("many", "quantile"): 40,
    }


def test_sample_is_repeatable(spark):
    df = spark.range(1000).repartition(7)
    first = {r["id"] for r in stats.hashed_sample(df, ["id"], 50, 1).collect()}
    again = {r["id"] for r in stats.hashed_sample(df.repartition(3), ["id"], 50, 1).collect()}
    assert first == again and len(first) == 50


def test_metrics_on_a_known_case(spark):
    rows = [(3.0, 2.5), (-0.5, 0.0), (2.0, 2.0), (7.0, 8.0)]
    df = spark.createDataFrame(rows, "actual double, predicted double")
    got = evaluate.metrics(df).first()
    assert got["mae"] == pytest.approx(0.5) and got["rmse"] == pytest.approx(np.sqrt(0.375))
    assert got["r2"] == pytest.approx(0.9486081370449679)
    assert got["mape"] == pytest.approx(32.73809523809524)
