"""Results that must not depend on how a series is cut, on rows with gaps."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronogrid.operators import align, chunks, features, model, ordered, stats
from chronogrid.session import clear_scratch, materialise, scratch_path


@pytest.fixture(scope="module")
def gapped(spark):
    """Two series of 900 hours with half the hours missing, one in long pauses."""
    rng = np.random.default_rng(5)
    start = datetime(2024, 1, 1)
    rows = []
    for item in "ab":
        a, b = rng.normal(size=900).cumsum(), rng.normal(size=900)
        for hour in range(900):
            pause = item == "b" and (hour // 130) % 2
            if rng.random() < 0.5 and not pause:
                rows.append((item, start + timedelta(hours=hour), float(a[hour]), float(b[hour])))
    return spark.createDataFrame(rows, "item_id string, ts timestamp, y double, z double")


def table(df, *keys):
    return df.toPandas().sort_values(list(keys), ignore_index=True)


@pytest.mark.parametrize("chunk_hours", [100, 333])
def test_row_look_backs_do_not_depend_on_the_chunk(gapped, chunk_hours):
    for make, keys in (
        (lambda n: stats.autocorrelation(gapped, "y", 30, chunk_hours=n), ["item_id", "lag"]),
        (lambda n: stats.lagged_correlation(gapped, "y", "z", 24, chunk_hours=n), ["item_id", "lag"]),
        (lambda n: features.stationary(gapped, ["y", "z"], chunk_hours=n), ["item_id", "ts"]),
    ):
        pd.testing.assert_frame_equal(table(make(chunk_hours), *keys), table(make(8192), *keys), rtol=1e-9)


def test_autocorrelation_matches_numpy(gapped):
    got = table(stats.autocorrelation(gapped, "y", 30, chunk_hours=100), "item_id", "lag")
    for item, part in gapped.toPandas().sort_values("ts").groupby("item_id"):
        x = part["y"].to_numpy() - part["y"].mean()
        want = [1.0] + [(x[k:] * x[:-k]).sum() / (x * x).sum() for k in range(1, 31)]
        np.testing.assert_allclose(got.loc[got.item_id == item, "acf"], want, rtol=1e-8, atol=1e-10)


@pytest.mark.parametrize("chunk_hours", [100, 8192])
def test_rolling_values_forget_a_spike(hourly, chunk_hours):
    df = hourly([1e17] + [1.0] * 300)
    out = chunks.windowed(
        df,
        48,
        lambda w: {"m": ordered.rolling_mean("y", 24), "s": ordered.rolling_std("y", 48)},
        chunk_hours=chunk_hours,
        means={"y": [24]},
        spread={"y": [48]},
    )
    rows = out.orderBy("ts").collect()
    assert [r["m"] for r in rows[24:]] == [1.0] * 277 and [r["s"] for r in rows[48:]] == [0.0] * 253


def test_infinite_values_stay_in_their_frames(hourly):
    out = chunks.windowed(
        hourly([1.0, 2.0, float("inf"), 4.0, 6.0, 8.0]), 2, lambda w: {"m": ordered.rolling_mean("y", 2)}, means={"y": [2]}
    )
    assert [r["m"] for r in out.orderBy("ts").collect()] == [1.0, 1.5, float("inf"), float("inf"), 5.0, 7.0]


def test_means_keep_small_and_large_values(spark):
    from chronogrid.functions.numbers import exact_mean

    def mean(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(exact_mean(F.col("v"))).first()[0]

    assert mean(0.001, 0.002) == pytest.approx(0.0015) and mean(1e20, 3e20) == 2e20 and mean(None) is None


@pytest.mark.parametrize("limit", [0, 100])
def test_summaries_join_both_ways(gapped, limit):
    ends = gapped.groupBy("item_id").agg(F.max("ts").alias("end"))
    out = align.join_summary(gapped, ends, ["item_id"], limit)
    assert out.count() == gapped.count() and out.where("ts > end").count() == 0


def test_blend_errors_follow_from_their_products(spark):
    rng = np.random.default_rng(2)
    data = pd.DataFrame(rng.normal(size=(50, 4)), columns=["actual", "a", "b", "c"])
    out = model.ensemble_weights(spark.createDataFrame(data), ["a", "b", "c"], steps=4).toPandas()
    for row in out.itertuples():
        blend = row.w_a * data.a + row.w_b * data.b + row.w_c * data.c
        assert row.rmse == pytest.approx(np.sqrt(((blend - data.actual) ** 2).mean()))


def test_scratch_is_cleared(spark):
    kept = materialise(spark.range(3).toDF("n"), "test")
    assert kept.count() == 3
    path = scratch_path(spark, "test")
    assert spark.sparkContext.applicationId in path
    clear_scratch(spark)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        kept.collect()
