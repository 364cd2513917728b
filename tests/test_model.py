"""Splits, forecasters, bands, ensembles, importance and the full run."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronogrid.operators import features, model
from chronogrid.plans import forecasting


@pytest.fixture(scope="module")
def panel(spark):
    """Two series of 60 days with a daily and a weekly cycle."""
    hours = spark.sql("SELECT explode(sequence(timestamp'2024-01-01', timestamp'2024-02-29 23:00', interval 1 hour)) AS ts")
    pair = F.expr("explode(array(struct('a' AS item_id, 1.0D AS k), struct('b' AS item_id, 2.0D AS k)))")
    both = hours.select("ts", pair.alias("s")).select("ts", "s.*")
    noise = (F.pmod(F.xxhash64("item_id", "ts"), F.lit(1000)) / 1000.0 - 0.5) * 2
    wave = F.sin(F.hour("ts") * np.pi / 12) * 5 + F.when(F.weekday("ts") >= 5, -3).otherwise(0)
    return both.select("item_id", "ts", (F.col("k") * 20 + wave + noise).alias("load_value")).cache()


def test_holdout_covers_every_row_once(panel):
    split = model.holdout(panel)
    assert split.count() == panel.count()
    assert split.filter("is_test").groupBy("item_id").agg(F.count("*"), F.min("step"), F.max("step")).drop("item_id").distinct().first()[:] == (168, 1, 168)


def test_windows_expand_and_do_not_overlap(panel):
    got = {
        (r["window"], r["part"]): r["n"]
        for r in model.backtest_windows(panel).filter("item_id = 'a'").groupBy("window", "part").agg(F.count("*").alias("n")).collect()
    }
    total = 60 * 24
    assert got == {(k, "train"): total - (3 - k) * 168 for k in range(3)} | {(k, "validation"): 168 for k in range(3)}


def test_naive_forecast_of_a_pure_cycle_is_exact(spark, hourly):
    out = model.seasonal_naive(hourly([float(i % 24) for i in range(24 * 20)]), "y", season=24)
    assert out.filter("actual <> predicted OR predicted IS NULL").count() == 0 and out.count() == 168


def test_weights_cover_the_simplex():
    options = model.simplex(["a", "b", "c"], 4)
    assert len(options) == 15 and all(sum(w) == pytest.approx(1) for w in options)


def test_permutation_keeps_the_values_and_moves_them(spark):
    df = spark.range(500).withColumn("x", F.col("id") * 1.0)
    out = model.permuted(df, ["x"], ["id"]).collect()
    assert sorted(r["x__perm"] for r in out) == [float(i) for i in range(500)]
    assert sum(r["x__perm"] == r["x"] for r in out) < 10


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_permutation_is_one_shift_of_the_hashed_order(spark, monkeypatch, partitions):
    """Whatever the number of ranges: each value moves one place along the whole order."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(300).select("id", (F.col("id") * 2.0).alias("x"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("s"))
        out = {r["id"]: r for r in model.permuted(df, ["x", "s"], ["id"], seed=9).collect()}
        order = [r["id"] for r in df.orderBy(F.xxhash64(F.lit(9), "id")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for here, there in zip(order, order[1:] + order[:1]):
        assert (out[here]["x__perm"], out[here]["s__perm"]) == (there * 2.0, str(there) if there % 7 else None)
    assert model.permuted(df.limit(0), ["x"], ["id"]).count() == 0
    assert [r["x__perm"] for r in model.permuted(df.where("id = 5"), ["x"], ["id"]).collect()] == [10.0]


def test_importance_by_hand(spark):
    """Errors of a linear model under the known shift."""
    df = spark.range(200).select("id", F.rand(3).alias("a"), F.rand(4).alias("b")).withColumn("y", F.col("a") * 3 - F.col("b"))
    df = df.cache()
    fitted = model.fit(df, "y", ["a", "b"], "linear")
    moved = model.permuted(df, ["a", "b"], ["id"]).collect()
    got = {r["feature"]: r["importance"] for r in model.permutation_importance(fitted, df, "y", ["a", "b"], ["id"]).collect()}
    want = {"a": np.sqrt(np.mean([(3 * (r["a__perm"] - r["a"])) ** 2 for r in moved])), "b": np.sqrt(np.mean([(r["b__perm"] - r["b"]) ** 2 for r in moved]))}
    assert got == pytest.approx(want, abs=1e-6)


def test_importance_ranks_the_informative_feature_first(spark):
    df = spark.range(2000).select("id", F.rand(1).alias("signal"), F.rand(2).alias("noise")).withColumn("y", F.col("signal") * 3)
    fitted = model.fit(df, "y", ["signal", "noise"], "linear")
    got = {r["feature"]: r["importance"] for r in model.permutation_importance(fitted, df, "y", ["signal", "noise"], ["id"]).collect()}
    assert got["signal"] > 0.5 and abs(got["noise"]) < 0.01


def test_train_predict_and_bands(spark, panel):
    roles = model.Roles(target="load_value", known=list(features.TEMPORAL))
    cfg = forecasting.ForecastConfig(
        roles=roles,
        inputs=features.FeatureInputs(target="load_value"),
        sets=frozenset({"temporal"}),
        training_days=None,
        candidates=("linear",),
        windows=2,
        ensemble_steps=4,
    )
    split = model.holdout(panel)
    past = split.filter("NOT is_test").select("item_id", "ts", "load_value")
    future = split.filter("is_test").select("item_id", "ts", "load_value")
    trained = forecasting.train(past, cfg)
    scores = {r["model"]: r["rmse"] for r in trained.leaderboard.collect()}
    assert scores["weighted_ensemble"] <= min(scores["linear"], scores["seasonal_naive"]) + 1e-9
    out = forecasting.predict(trained, past, future, cfg).cache()
    assert out.count() == 2 * 168 and out.filter("mean IS NULL").count() == 0
    names = model.quantile_names()
    crossed = F.lit(False)
    for low, high in zip(names, names[1:]):
        crossed = crossed | (F.col(low) > F.col(high))
    assert out.filter(crossed).count() == 0
    joined = out.join(future, ["item_id", "ts"])
    rmse = joined.agg(F.sqrt(F.avg((F.col("mean") - F.col("load_value")) ** 2))).first()[0]
    assert rmse < 2
    assert forecasting.predict(trained, past, future, cfg, per_slice=True).count() == 2 * 168


def test_quantiles_by_regression(spark, panel):
    """A run with regression quantiles gives the same columns, and bands that hold the week not seen."""
    cfg = forecasting.ForecastConfig(
        roles=model.Roles(target="load_value", known=list(features.TEMPORAL)),
        inputs=features.FeatureInputs(target="load_value"),
        sets=frozenset({"temporal"}),
        training_days=None,
        candidates=("linear",),
        windows=1,
        ensemble_steps=2,
        quantiles="regression",
    )
    split = model.holdout(panel)
    past, future = (split.filter(part).select("item_id", "ts", "load_value") for part in ("NOT is_test", "is_test"))
    out = forecasting.predict(forecasting.train(past, cfg), past, future, cfg).cache()
    names = model.quantile_names()
    assert out.columns == ["item_id", "ts", "mean", *names] and out.count() == 2 * 168
    assert all(list(r) == sorted(r) for r in out.select(*names).collect())
    inside = F.avg(F.col("load_value").between(F.col("q10"), F.col("q90")).cast("double"))
    assert out.join(future, ["item_id", "ts"]).agg(inside).first()[0] == pytest.approx(0.8, abs=0.1)
    with pytest.raises(ValueError, match="quantiles"):
        forecasting.ForecastConfig(quantiles="bands")


def test_target_derived_covariates_are_refused(panel):
    roles = model.Roles(target="load_value", known=["load_value_lag_1h"])
    with pytest.raises(ValueError, match="derived"):
        roles.covariates(panel.withColumn("load_value_lag_1h", F.lit(1.0)))
