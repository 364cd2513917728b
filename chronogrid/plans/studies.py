"""Price, price-emission, correlation, weather and download jobs."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogrid import session
from chronogrid.functions import numbers, timeparts
from chronogrid.operators import bins, charts, evaluate, features, stats
from chronogrid.sources import prices, sinks, utilisation, weather

# Groups this small get no correlation, and the study's first hour.
MIN_PAIRS = 10
STUDY_START = "2021-01-01 01:00:00"
STUDY_VARIABLES = ["temperature_celsius", "emissionfactor", "volume_sun", "volume_total_wind"]


@dataclass(frozen=True)
class StudyConfig:
    """Crisis bounds and the steps to leave out."""

    regime: features.Regime = field(default_factory=features.Regime)
    skip_analysis: bool = False
    skip_relation: bool = False


def download_job(spark: SparkSession, landed: dict[str, str], out: str, stamp: str) -> DataFrame:
    """Landed pages to the combined history and the split files; incomplete feeds fail."""
    for which, path in landed.items():
        check = utilisation.page_check(utilisation.read_pages(spark, path)).first()
        if not check["is_complete"]:
            raise ValueError(f"{which}: {check['landed_pages']} of {check['expected_pages']} pages landed")
    combined = utilisation.read_feed(spark, landed)
    sinks.write_history(combined, f"{out}/historical_combined_{stamp}.csv")
    sinks.write_split(combined, out, stamp)
    return combined


def table_summary(tables: dict[str, DataFrame], ts: str = "ts") -> DataFrame:
    """Rows and time range of each table."""
    parts = [
        df.agg(
            F.lit(name).alias("table"),
            F.count("*").alias("n_rows"),
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def price_analysis(merged: DataFrame, cfg: StudyConfig) -> dict[str, DataFrame]:
    """Price reports over hourly prices; gas reports only where gas is present.

    The hourly table is written once, since every report reads it again.
    """
    hourly = session.materialise(
        merged.withColumns(features.regime_columns(F.col("ts"), cfg.regime)), "prices"
    )
    have = [c for c in ("elec_price", "gas_price") if c in merged.columns]
    reports = {
        "describe": stats.describe(hourly, have),
        "year_month": charts.year_month_matrix(hourly, "elec_price"),
        "hour_profile": charts.hour_profile(hourly, "elec_price"),
        "volatility": charts.daily_volatility(hourly, "elec_price", cfg.regime.start),
        "phase_extents": charts.phase_extents(hourly),
        "phase_statistics": phase_statistics(hourly, have),
    }
    if "gas_price" in have:
        reports |= {
            "rolling": features.rolling_price_analysis(hourly),
            "trend": charts.price_trend(hourly),
            "scatter": charts.price_scatter(hourly),
            "correlation": stats.pearson(hourly, "elec_price", "gas_price"),
            "regime_correlation": stats.pearson(hourly, "elec_price", "gas_price", ["energy_crisis"]),
        }
    return reports


def phase_statistics(df: DataFrame, values: list[str]) -> DataFrame:
    """Mean and deviation of each price by phase."""
    return df.groupBy("crisis_phase").agg(
        *[F.avg(v).alias(f"{v}_mean") for v in values],
        *[F.stddev_samp(v).alias(f"{v}_std") for v in values],
    )


def quartile_report(df: DataFrame, by: str = "elec_price", value: str = "emission_factor") -> DataFrame:
    """Price range and emission statistics by price quartile."""
    names = F.array(*[F.lit(x) for x in evaluate.PRICE_QUARTILES])
    return (
        bins.quantile_bins(df, by, 4)
        .groupBy("bin")
        .agg(
            F.avg(by).alias("price_mean"),
            F.min(by).alias("price_min"),
            F.max(by).alias("price_max"),
            F.avg(value).alias("value_mean"),
            F.stddev_samp(value).alias("value_std"),
            F.count(value).alias("value_count"),
        )
        .withColumn("quartile", F.get(names, F.col("bin").cast("int")))
    )


def price_emission(joined: DataFrame, price: str = "elec_price", value: str = "emission_factor") -> dict[str, DataFrame]:
    """The price-emission report: overall, by quartile, hour and regime.

    The joined table is written once, since every report reads it again.
    """
    hourly = session.materialise(
        joined.withColumn("hour", timeparts.calendar_parts(F.col("ts"))["hour"]), "price-emission"
    )
    by_hour = stats.pearson_test(hourly, price, value, ["hour"], MIN_PAIRS)
    reports = {
        "overall": stats.pearson_test(hourly, price, value),
        "line": stats.ols_line(hourly, price, value),
        "band": stats.ols_band(hourly, price, value),
        "quartiles": quartile_report(hourly, price, value),
        "hours": by_hour,
        "top_hours": by_hour.orderBy(F.desc("corr"), "hour").limit(3),
        "bottom_hours": by_hour.orderBy("corr", "hour").limit(3),
        "months": charts.month_profile(hourly, [price, value]),
        "month_correlation": stats.pearson_test(charts.month_profile(hourly, [price, value]), price, value),
    }
    if "energy_crisis" in joined.columns:
        flagged = hourly.withColumn("energy_crisis", numbers.flag_or_zero(F.col("energy_crisis").cast("string")))
        daily = charts.daily_with_flag(flagged, [price, value], "energy_crisis")
        reports |= {
            "regimes": stats.pearson_test(flagged, price, value, ["energy_crisis"], MIN_PAIRS),
            "test": stats.welch_test(flagged, value, "energy_crisis"),
            "box": stats.box_numbers(flagged, value, "energy_crisis"),
            "daily": daily,
            "spans": charts.regime_spans(daily),
        }
    return reports


def price_study(
    spark: SparkSession,
    price_dir: str,
    gas_dir: str,
    out: str,
    cfg: StudyConfig | None = None,
    emissions: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Read prices, analyse, prepare features, relate them to emissions, summarise.

    Crisis bounds are applied once. Without gas files only the price reports that
    need no gas are made.
    """
    cfg = cfg or StudyConfig()
    electricity = prices.read_electricity(spark, price_dir).withColumn("item_id", F.lit("0"))
    tables = {"electricity": electricity}
    results: dict[str, DataFrame] = {}
    try:
        gas = prices.read_gas(spark, gas_dir).withColumn("item_id", F.lit("0"))
    except FileNotFoundError:
        gas = None
    if gas is None:
        if not cfg.skip_analysis:
            results |= price_analysis(electricity, cfg)
    else:
        tables["gas"] = gas
        if not cfg.skip_analysis:
            results |= price_analysis(features.merge_prices(electricity, gas), cfg)
        prepared = features.prepare_prices(electricity, gas, cfg.regime)
        path = sinks.write_table(prepared, f"{out}/price_features.parquet")
        table = spark.read.parquet(path)
        tables["price_features"] = table
        if emissions is not None and not cfg.skip_relation:
            joined = table.join(emissions.select("ts", "emission_factor"), "ts")
            results |= {f"relation_{k}": v for k, v in price_emission(joined).items()}
    results["summary"] = table_summary(tables)
    return results


def correlation_study(
    joined: DataFrame,
    lead: str = "temperature_celsius",
    follow: str = "emissionfactor",
    variables: list[str] = STUDY_VARIABLES,
    start: str = STUDY_START,
    max_lag: int = 24,
    item: str = "item_id",
) -> dict[str, DataFrame]:
    """Correlations between the hourly changes of the variables."""
    recent = joined.filter(F.col("ts") >= F.lit(start).cast("timestamp"))
    if "volume_total_wind" in variables and "volume_total_wind" not in joined.columns:
        recent = recent.withColumn("volume_total_wind", F.col("volume_land_wind") + F.col("volume_sea_wind"))
    changes = session.materialise(features.stationary(recent, variables, item), "changes")
    hourly = changes.withColumn("hour", timeparts.calendar_parts(F.col("ts"))["hour"])
    by_hour = stats.pearson(hourly, lead, follow, ["hour"])
    by_lag = stats.lagged_correlation(changes, lead, follow, max_lag, item)
    return {
        "hour_means": charts.hour_means(changes, variables),
        "hours": by_hour,
        "lags": by_lag,
        "overall": stats.pearson(changes, lead, follow),
        "strongest_hour": stats.strongest(by_hour, "hour"),
        "strongest_lag": stats.strongest(by_lag, "lag", [item]),
        "matrix": stats.correlation_matrix(changes, variables),
    }


def weather_job(spark: SparkSession, history: str, forecast: str, out: str, form: str = "parquet") -> DataFrame:
    """Combine landed weather history and forecast and write the result."""
    combined = weather.combine(weather.read_weather(spark, history), weather.read_weather(spark, forecast))
    sinks.write_table(combined, out, form, sort_by=["item_id", "ts"])
    return combined
