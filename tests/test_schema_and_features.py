"""Name look-ups, guards, the feature registry, joins and unions."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronogrid.functions import schema
from chronogrid.operators import align, features, model
from tests.conftest import column


def test_time_column_is_found_by_name_then_by_type(spark):
    named = spark.range(1).select(F.current_timestamp().alias("validfrom (UTC)"), F.lit(1).alias("date"))
    assert schema.normalise_time(named).columns == ["ts", "date"]
    typed = spark.range(1).select("id", F.current_timestamp().alias("moment"))
    assert schema.normalise_time(typed).columns == ["id", "ts"]
    with pytest.raises(ValueError):
        schema.normalise_time(spark.range(1))


def test_find_column_and_family_counts(spark):
    assert schema.find_column(["a", "My_Time"], "time") == "My_Time"
    names = ["wind_speed", "hour", "is_holiday", "y_lag_24h", "rain"]
    got = {r["family"]: r["n"] for r in schema.family_counts(spark, names).collect()}
    assert (got["wind"], got["temporal"], got["calendar"], got["lag"], got["precipitation"]) == (1, 1, 1, 1, 1)


def test_guards_fail_at_plan_time(spark):
    df = spark.range(1).select("id", F.lit(1).alias("emissionfactor_lag_1h"))
    with pytest.raises(ValueError, match="missing"):
        schema.require_columns(df, ["id", "nope"])
    with pytest.raises(ValueError, match="derived"):
        schema.forbid_derived(df, "emissionfactor")
    assert schema.column_difference(df, spark.range(1)) == ["emissionfactor_lag_1h"]


def test_registry_rejects_unknown_sets(hourly):
    with pytest.raises(ValueError, match="unknown"):
        features.add_features(hourly([1]), features.FeatureInputs(), {"temporal", "nope"})
    with pytest.raises(ValueError, match="set"):
        features.add_features(hourly([1]), features.FeatureInputs(), ["temporal"])


def test_seasonal_alone_adds_no_temporal_columns(hourly):
    out = features.add_features(hourly([1]), features.FeatureInputs(), {"seasonal"})
    assert "hour" not in out.columns and "hour_sin" in out.columns and len(out.columns) == 3 + 15


def test_target_set_is_skipped_without_the_target(hourly):
    use = features.FeatureInputs(target="emissionfactor")
    assert features.add_features(hourly([1]), use, {"emission"}).columns == ["item_id", "ts", "y"]


def test_weather_set_has_120_columns_and_tolerates_a_missing_temperature(hourly):
    base = hourly([1, 2, 3]).select("item_id", "ts")
    names = ["temperature", *features.WEATHER_VARIABLES]
    weather = hourly([1, 2, 3]).select("ts", *[F.col("y").alias(n) for n in names])
    out = features.add_features(base, features.FeatureInputs(weather=weather), {"weather"})
    assert len(out.columns) == 2 + 120
    less = features.add_features(base, features.FeatureInputs(weather=weather.drop("temperature")), {"weather"})
    assert len(less.columns) == 2 + 106 and less.count() == 3


def test_price_set_needs_all_columns(hourly):
    use = features.FeatureInputs(prices=hourly([1]).withColumnRenamed("y", "elec_price"))
    with pytest.raises(ValueError, match="missing columns"):
        features.add_features(hourly([1]), use, {"price"})


def test_known_covariates_are_the_published_67():
    assert len(model.KNOWN_COVARIATES) == 67 == len(set(model.KNOWN_COVARIATES))


def test_duplicate_keys_fail_a_one_to_one_join(spark, hourly):
    twice = hourly([1]).unionByName(hourly([2]))
    with pytest.raises(Exception, match="key is not unique"):
        align.left_join_one_to_one(twice, hourly([1]), ["item_id", "ts"]).collect()


def test_outer_align_and_label_alignment(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "ts int, a double")
    b = spark.createDataFrame([(2, 5.0), (3, 6.0)], "ts int, b double")
    got = [tuple(r) for r in align.outer_align([a, b], ["ts"]).orderBy("ts").collect()]
    assert got == [(1, 1.0, None), (2, 2.0, 5.0), (3, None, 6.0)]
    long = spark.createDataFrame(
        [("hour", 0, 1.0, 1.0), ("hour", 1, 2.0, 2.0), ("hour", 2, 3.0, 3.0), ("flag", 0, 7.0, 7.0), ("flag", 1, 8.0, 8.0)],
        "dimension string, key bigint, mean_value double, rms_value double",
    )
    rows = align.label_alignment(long, ["hour", "flag"]).orderBy("label").collect()
    assert [r["flag_mean"] for r in rows] == [7.0, 8.0, None]


def test_a_key_with_most_rows_is_deduplicated(spark):
    hot = spark.range(20000).select(F.lit("k").alias("key"), F.col("id").alias("rank"), (F.col("id") * 2).alias("v"))
    some = spark.range(100).select(F.col("id").cast("string").alias("key"), F.lit(0).alias("rank"), F.lit(1).alias("v"))
    out = align.keep_first(hot.unionByName(some), ["key"], [F.col("rank")])
    assert out.count() == 101 and out.filter("key = 'k'").first()["v"] == 0


def test_history_wins_over_forecast(hourly):
    old, new = hourly([1, 2]), hourly([9, 9, 9])
    assert column(align.union_with_priority([old, new], ["item_id", "ts"]), "y") == [1, 2, 9]


def test_carry_daily_uses_the_latest_day(spark):
    day = datetime(2024, 1, 1)
    daily = spark.createDataFrame([(day, 1.0), (day + timedelta(days=2), 3.0)], "ts timestamp, p double")
    rows = spark.createDataFrame([(day + timedelta(hours=h),) for h in (-5, 5, 30, 50, 500)], "ts timestamp")
    assert column(align.carry_daily(rows, daily, ["p"]), "p") == [None, 1.0, 1.0, 3.0, 3.0]


def test_price_features_leak_only_when_asked(hourly):
    price = hourly([5.0] * 30).withColumnRenamed("y", "elec_price")
    gas = hourly([1.0]).withColumnRenamed("y", "gas_price")
    safe = features.prepare_prices(price, gas).orderBy("ts").first()
    filled = features.prepare_prices(price, gas, leak_safe=False).orderBy("ts").first()
    assert safe["elec_price_lag_1h"] is None and filled["elec_price_lag_1h"] == 5.0
    assert {f"phase_{p}" for p in features.Regime().phases} <= set(safe.asDict())
