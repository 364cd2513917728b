"""The data behind each chart, one function per chart."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogrid.functions import numbers, timeparts
from chronogrid.operators import grid, model, ordered, stats

# Fixed value: production is shown in units of a million.
PRODUCTION_UNIT = 1e6


def stacked_production(df: DataFrame) -> DataFrame:
    """Cumulative layers sea wind, land wind, sun in chart units."""
    sea, land, sun = F.col("volume_sea_wind"), F.col("volume_land_wind"), F.col("volume_sun")
    return df.withColumns(
        {
            "layer_sea_wind": sea / F.lit(PRODUCTION_UNIT),
            "layer_land_wind": (sea + land) / F.lit(PRODUCTION_UNIT),
            "layer_sun": (sea + land + sun) / F.lit(PRODUCTION_UNIT),
        }
    )


def forecast_band(production: DataFrame, prediction: DataFrame) -> DataFrame:
    """Forecast mean and band beside the production layers, by time."""
    band = prediction.select("ts", "mean", "q10", "q90")
    return stacked_production(production).join(band, "ts").select(
        "ts", "mean", "q10", "q90", "layer_sea_wind", "layer_land_wind", "layer_sun"
    )


def error_panel(errors: DataFrame, columns: list[str], item: str = "item_id") -> DataFrame:
    """Actual, predicted and error beside columns normalised by their series maximum."""
    return stats.max_normalised(errors, columns, item).select(
        item, "ts", "actual", "predicted", "error", *[f"{c}_norm" for c in columns]
    )


def phase_extents(df: DataFrame, ts: str = "ts") -> DataFrame:
    """First and last time of each phase, with a display label."""
    extents = df.groupBy("crisis_phase").agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    return extents.withColumn("label", numbers.title_label(F.col("crisis_phase")))


def price_trend(df: DataFrame, item: str = "item_id") -> DataFrame:
    """Both prices normalised by their maximum."""
    return stats.max_normalised(df, ["elec_price", "gas_price"], item).select(
        item, "ts", "elec_price_norm", "gas_price_norm", "crisis_phase"
    )


def year_month_matrix(df: DataFrame, value: str, ts: str = "ts") -> DataFrame:
    """Mean by month with one column for every year in the data."""
    parts = timeparts.calendar_parts(F.col(ts))
    found = df.select(parts["year"].alias("year")).where("year IS NOT NULL").distinct().orderBy("year")
    years = [row["year"] for row in found.collect()]
    return (
        df.select(parts["month"].alias("month"), parts["year"].alias("year"), value)
        .groupBy("month")
        .pivot("year", years)
        .agg(F.avg(value))
        .withColumnsRenamed({str(y): f"y{y}" for y in years})
    )


def hour_profile(df: DataFrame, value: str, ts: str = "ts") -> DataFrame:
    """Mean by hour for weekdays and weekends side by side."""
    parts = timeparts.calendar_parts(F.col(ts))
    weekend = parts["is_weekend"] == 1
    return df.groupBy(parts["hour"].alias("hour")).agg(
        F.avg(F.when(~weekend, F.col(value))).alias("weekday_mean"),
        F.avg(F.when(weekend, F.col(value))).alias("weekend_mean"),
    )


def daily_volatility(df: DataFrame, value: str, start: date, ts: str = "ts") -> DataFrame:
    """Spread within each day and the periods the day belongs to.

    The boundary is the first row at or after `start`; a day that starts exactly at
    the boundary belongs to both periods.
    """
    boundary = df.agg(F.min(F.when(F.col(ts) >= F.lit(start).cast("timestamp"), F.col(ts)))).scalar()
    days = df.groupBy(F.to_date(ts).alias("day")).agg(F.stddev_samp(value).alias("volatility"))
    midnight = F.col("day").cast("timestamp")
    return days.withColumns(
        {
            "pre_crisis": F.coalesce(midnight <= boundary, F.lit(True)).cast("bigint"),
            "in_crisis": F.coalesce(midnight >= boundary, F.lit(False)).cast("bigint"),
        }
    )


def price_scatter(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Price pairs without missing values, with the date as a number."""
    return df.dropna(subset=["elec_price", "gas_price"]).select(
        ts, "gas_price", "elec_price", timeparts.date_ordinal(F.col(ts)).alias("date_ordinal")
    )


def daily_with_flag(df: DataFrame, values: list[str], flag: str, item: str = "item_id") -> DataFrame:
    """Daily means, empty days included, and whether more than half the day is in the regime."""
    daily = grid.daily_mean(df, [*values, flag], item)
    return daily.withColumn("in_regime", (F.coalesce(F.col(flag), F.lit(0.0)) > 0.5).cast("bigint"))


def regime_spans(daily: DataFrame, item: str = "item_id") -> DataFrame:
    """Contiguous spans of regime days; a break of more than a day starts a new one."""
    days = daily.filter("in_regime = 1").select(item, F.col("day").cast("timestamp").alias("ts"))
    return ordered.runs(days, 24, item, "ts").select(
        item,
        F.to_date("run_start").alias("span_start"),
        F.to_date("run_end").alias("span_end"),
        F.col("n_rows").alias("n_days"),
    )


def month_profile(df: DataFrame, values: list[str], ts: str = "ts") -> DataFrame:
    """Mean of each value by month of the year."""
    return df.groupBy(timeparts.calendar_parts(F.col(ts))["month"].alias("month")).agg(
        *[F.avg(v).alias(v) for v in values]
    )


def hour_means(df: DataFrame, values: list[str], ts: str = "ts") -> DataFrame:
    """Mean of each value by hour of the day."""
    return df.groupBy(timeparts.calendar_parts(F.col(ts))["hour"].alias("hour")).agg(
        *[F.avg(v).alias(v) for v in values]
    )


def horizon_bounds(df: DataFrame, target: str, horizon: int = model.HORIZON, item: str = "item_id") -> DataFrame:
    """Where the forecast horizon lies and the value range it spans, per series."""
    split = model.holdout(df, horizon, item)
    train, test = ~F.col("is_test"), F.col("is_test")

    def when(condition: Column, value: str) -> Column:
        return F.when(condition, F.col(value))

    return split.groupBy(item).agg(
        F.max(when(train, "ts")).alias("train_end"),
        F.max(when(test, "ts")).alias("test_end"),
        F.min(target).alias("low"),
        F.max(target).alias("high"),
        F.count_if(train).alias("n_train"),
        F.count_if(test).alias("n_test"),
    )
