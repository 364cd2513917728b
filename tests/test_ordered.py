"""Chunked windows equal plain windows; fills, rolling statistics, runs and imputation."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chronogrid.operators import chunks, grid, impute, ordered
from tests.conftest import column

N = None


def random_panel(spark, n=1500, items=3, missing=0.3, seed=1):
    rng = np.random.default_rng(seed)
    frames = []
    for k in range(items):
        y = rng.normal(50, 10, n)
        y[rng.random(n) < missing] = np.nan
        y[200:900] = np.nan if k == 1 else y[200:900]
        frames.append(
            pd.DataFrame({"item_id": f"s{k}", "ts": pd.date_range("2023-11-01", periods=n, freq="h"), "y": y})
        )
    pdf = pd.concat(frames, ignore_index=True)
    df = spark.createDataFrame(pdf).withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    return pdf, df.withColumn("ts", F.col("ts").cast("timestamp"))


def to_pandas(df):
    return df.toPandas().sort_values(["item_id", "ts"]).reset_index(drop=True)


def test_chunked_window_equals_plain_window(spark):
    _, df = random_panel(spark)
    plain = Window.partitionBy("item_id").orderBy("ts")

    def build(w):
        return {"l1": F.lag("y", 1).over(w), "l168": F.lag("y", 168).over(w)}

    cut = to_pandas(chunks.windowed(df, 168, build, chunk_hours=200))
    whole = to_pandas(df.withColumns(build(plain)))
    pd.testing.assert_frame_equal(cut, whole)


@pytest.mark.parametrize("rows", [2, 24, 168])
def test_rolling_statistics_match_pandas(spark, rows):
    pdf, df = random_panel(spark)
    out = to_pandas(
        chunks.windowed(
            df,
            168,
            lambda w: {
                "mean": ordered.rolling_mean("y", rows),
                "std": ordered.rolling_std("y", rows),
                "full": ordered.rolling_mean("y", rows, full=True),
                "full_std": ordered.rolling_std("y", rows, full=True),
            },
            chunk_hours=170,
            spread={"y": [rows]},
        )
    )
    group = pdf.groupby("item_id")["y"]
    for name, want in {
        "mean": group.transform(lambda x: x.rolling(rows, min_periods=1).mean()),
        "std": group.transform(lambda x: x.rolling(rows, min_periods=1).std()),
        "full": group.transform(lambda x: x.rolling(rows).mean()),
        "full_std": group.transform(lambda x: x.rolling(rows).std()),
    }.items():
        np.testing.assert_allclose(out[name].to_numpy(float), want.to_numpy(), rtol=1e-9, atol=1e-9)


def test_deviation_of_equal_values_is_zero(hourly):
    df = hourly([1e9 + 0.1] * 100 + [3.7] * 100)
    out = chunks.windowed(df, 24, lambda w: {"s": ordered.rolling_std("y", 24)}, spread={"y": [24]})
    got = column(out, "s")
    assert got[0] is None and set(got[1:100]) == {0.0} and set(got[124:]) == {0.0}


def test_rolling_micro_fixtures(hourly):
    df = hourly([1, N, 3, 4])
    out = chunks.windowed(
        df,
        2,
        lambda w: {
            "m": ordered.rolling_mean("y", 2),
            "s": ordered.rolling_std("y", 2),
            "f": ordered.rolling_mean("y", 2, full=True),
        },
        spread={"y": [2]},
    )
    assert column(out, "m") == [1, 1, 3, 3.5]
    assert column(out, "s")[:3] == [N, N, N] and column(out, "s")[3] == pytest.approx(0.70710678)
    assert column(out, "f") == [N, N, N, 3.5]


@pytest.mark.parametrize("partitions", ["3", "64"])
def test_fills_across_chunks_match_pandas(spark, partitions):
    pdf, df = random_panel(spark, missing=0.6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        forth = to_pandas(ordered.forward_fill(df, ["y"], chunk_hours=50))
        back = to_pandas(ordered.backward_fill(df, ["y"], chunk_hours=50))
        both = to_pandas(ordered.fill_both_ways(df, ["y"], chunk_hours=50))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    group = pdf.groupby("item_id")["y"]
    np.testing.assert_array_equal(forth["y"].to_numpy(), group.ffill().to_numpy())
    np.testing.assert_array_equal(back["y"].to_numpy(), group.bfill().to_numpy())
    np.testing.assert_array_equal(both["y"].to_numpy(), group.transform(lambda x: x.ffill().bfill()).to_numpy())


def test_fill_is_idempotent_and_keeps_other_columns(hourly):
    df = hourly([N, 1, N, N, 2, N]).withColumn("z", F.lit(7))
    once = ordered.forward_fill(df, ["y"])
    assert column(once, "y") == [N, 1, 1, 1, 2, 2]
    assert column(ordered.forward_fill(once, ["y"]), "y") == [N, 1, 1, 1, 2, 2]
    assert column(once, "z") == [7] * 6


def test_probe_decides_whether_a_series_is_filled(hourly):
    gap = hourly([N, 1, 2], item="a").withColumn("z", F.when(F.col("y") == 2, 5))
    whole = hourly([1, 1, 2], item="b").withColumn("z", F.when(F.col("y") == 2, 5))
    out = ordered.fill_when_probe_missing(gap.unionByName(whole), ["y", "z"], "y")
    assert column(out.filter("item_id = 'a'"), "z") == [5, 5, 5]
    assert column(out.filter("item_id = 'b'"), "z") == [N, N, 5]


def test_impute_linear_fixture(hourly):
    values = [N, 1, N, N, N, N, 6, N, N, N]
    want = [N, 1, 2, 3, 4.5, 4.5, 6, 6, 6, N]
    assert column(impute.impute(hourly(values), ["y"]), "y") == want


def test_impute_direction_is_linear_or_circular(hourly):
    df = hourly([N, 350, N, 10, N, N, N, N, 40])
    plain = column(impute.impute(df, [], ["y"]), "y")
    assert plain == pytest.approx([350, 350, 180, 10, 16, 22, 22, 22, 40])
    around = column(impute.impute(df, [], ["y"], circular=True), "y")
    assert around[2] == pytest.approx(0)


def test_runs_break_on_a_pause(spark):
    start = datetime(2024, 1, 1)
    hours = [0, 24, 48, 96, 120, 400]
    df = spark.createDataFrame([("a", start + timedelta(hours=h)) for h in hours], "item_id string, ts timestamp")
    got = [(r["run_start"], r["n_rows"]) for r in ordered.runs(df, 24).orderBy("run_start").collect()]
    assert got == [(start, 3), (start + timedelta(hours=96), 2), (start + timedelta(hours=400), 1)]


def test_grid_is_gap_free_in_every_chunk(spark):
    rows = [("a", datetime(2024, 1, 1)), ("a", datetime(2024, 1, 5, 7)), ("b", datetime(2024, 1, 2, 3))]
    df = spark.createDataFrame(rows, "item_id string, ts timestamp").withColumn("y", F.lit(1.0))
    out = grid.hourly_grid(df, ["y"], chunk_hours=10)
    assert out.count() == 4 * 24 + 8 + 1 and out.filter("y = 1").count() == 3
    assert grid.missing_hours(df).count() == 4 * 24 + 8 - 2


def test_daily_to_hourly_ends_at_the_last_midnight(spark):
    rows = [("a", datetime(2024, 1, 1), 1.0), ("a", datetime(2024, 1, 2), 2.0)]
    df = spark.createDataFrame(rows, "item_id string, ts timestamp, gas double")
    out = grid.hourly_from_daily(df, ["gas"])
    assert out.count() == 25 and column(out, "gas")[-2:] == [1.0, 2.0]


def test_halo_must_fit_the_chunk(hourly):
    with pytest.raises(ValueError):
        chunks.with_halo(hourly([1]), 11, chunk_hours=10)
