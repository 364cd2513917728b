"""Chart tables and study jobs over the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from chronogrid.functions import numbers
from chronogrid.functions.numbers import tidy
from chronogrid.operators import charts, features
from chronogrid.plans import studies
from chronogrid.plans.catalog.aggregates import HOUR_CORR, bin_sql, edges_sql, tidied
from chronogrid.plans.catalog.alignment import FILL_TAIL, MEAN_TAIL, impute_sql
from chronogrid.plans.catalog.base import Tables, query, with_views
from chronogrid.plans.catalog.calendars import CHANGES, JANUARY, JANUARY_FLAG, JANUARY_PHASE, STUDY
from chronogrid.plans.catalog.files import HISTORY_SQL, landed_pages, written_prices
from chronogrid.plans.catalog.models import ENDS
from chronogrid.plans.catalog.scalars import DAILY_CUTS
from chronogrid.plans.catalog.statistics import PAIR_T, p_sql
from chronogrid.sources import utilisation, weather


def flagged(t: Tables):
    return t.wide.withColumn("energy_crisis", numbers.regime_flag(F.col("ts"), JANUARY.start, JANUARY.end))


@query(
    "v1_forecast_band_and_production",
    with_views("wide", "grid")
    + """SELECT w.ts, tidy(g.y) AS mean, tidy(g.y - 1) AS q10, tidy(g.y + 1) AS q90, tidy(gas_price / 1e3) AS layer_sea_wind,
    tidy((gas_price + humidity) / 1e3) AS layer_land_wind, tidy((gas_price + humidity + temperature) / 1e3) AS layer_sun
    FROM wide w JOIN grid g ON g.ts = w.ts AND g.item_id = 'signup'""",
)
def band_and_production(t: Tables):
    production = t.wide.select(
        "ts",
        (F.col("gas_price") * 1e3).alias("volume_sea_wind"),
        (F.col("humidity") * 1e3).alias("volume_land_wind"),
        (F.col("temperature") * 1e3).alias("volume_sun"),
    )
    y = F.col("y")
    prediction = t.grid().filter("item_id = 'signup'").select("ts", y.alias("mean"), (y - 1).alias("q10"), (y + 1).alias("q90"))
    return tidied(charts.forecast_band(production, prediction))


@query(
    "v2_error_panel",
    with_views("err")
    + """SELECT item_id, ts, tidy(actual) AS actual, tidy(predicted) AS predicted, tidy(error) AS error,
    tidy(temperature / max(temperature) OVER (PARTITION BY item_id)) AS temperature_norm,
    tidy(humidity / max(humidity) OVER (PARTITION BY item_id)) AS humidity_norm FROM err""",
)
def error_panel(t: Tables):
    return tidied(charts.error_panel(t.errors(), ["temperature", "humidity"]))


@query(
    "v3_price_trend",
    with_views("wide")
    + f"""SELECT item_id, ts, tidy(elec_price / (SELECT max(elec_price) FROM wide)) AS elec_price_norm,
    tidy(gas_price / (SELECT max(gas_price) FROM wide)) AS gas_price_norm, {JANUARY_PHASE} AS crisis_phase FROM wide""",
)
def price_trend(t: Tables):
    hourly = t.wide.withColumns(features.regime_columns(F.col("ts"), JANUARY))
    return tidied(charts.price_trend(hourly))


@query(
    "v4_year_month_matrix",
    "SELECT month(l_shipdate) AS month, "
    + ", ".join(f"tidy2(avg(l_extendedprice) FILTER (year(l_shipdate) = {y})) AS y{y}" for y in range(1995, 2002))
    + " FROM lineitem GROUP BY 1",
)
def year_month_matrix(t: Tables):
    out = charts.year_month_matrix(t.read("lineitem"), "l_extendedprice", "l_shipdate")
    return tidied(out, 2)


@query(
    "v5_hour_profile",
    """SELECT hour(ts) AS hour, tidy(avg(value) FILTER (isodow(ts) < 6)) AS weekday_mean,
    tidy(avg(value) FILTER (isodow(ts) > 5)) AS weekend_mean FROM events GROUP BY 1""",
)
def hour_profile(t: Tables):
    return tidied(charts.hour_profile(t.events, "value"))


@query(
    "v6_daily_volatility",
    with_views("wide")
    + """, b AS (SELECT min(ts) AS b FROM wide WHERE ts >= DATE '2024-01-08')
    SELECT CAST(ts AS DATE) AS day, tidy(stddev_samp(elec_price)) AS volatility, CAST(CAST(ts AS DATE) <= min(b) AS BIGINT) AS pre_crisis,
    CAST(CAST(ts AS DATE) >= min(b) AS BIGINT) AS in_crisis FROM wide, b GROUP BY CAST(ts AS DATE)""",
)
def daily_volatility(t: Tables):
    return tidied(charts.daily_volatility(t.wide, "elec_price", JANUARY.start))


@query(
    "v7_price_scatter",
    with_views("wide")
    + """SELECT ts, tidy(gas_price) AS gas_price, tidy(elec_price) AS elec_price,
    date_diff('day', DATE '0001-01-01', CAST(ts AS DATE)) + 1 AS date_ordinal FROM wide
    WHERE gas_price IS NOT NULL AND elec_price IS NOT NULL""",
)
def price_scatter(t: Tables):
    return tidied(charts.price_scatter(t.wide))


def relation(t: Tables, name: str):
    joined = flagged(t).withColumnRenamed("emissionfactor", "emission_factor").dropna(
        subset=["elec_price", "emission_factor"]
    )
    return studies.price_emission(joined)[name]


JOINED = f"""j AS (SELECT ts, elec_price, emissionfactor AS emission_factor, {JANUARY_FLAG} AS energy_crisis FROM wide
    WHERE elec_price IS NOT NULL AND emissionfactor IS NOT NULL)"""


@query(
    "v8_price_emission_fit",
    with_views("wide", more=JOINED)
    + """SELECT tidy(regr_slope(emission_factor, elec_price)) AS slope, tidy(regr_intercept(emission_factor, elec_price)) AS intercept,
    tidy(regr_r2(emission_factor, elec_price)) AS r2, tidy(avg(elec_price)) AS mean_x, tidy3(regr_sxx(emission_factor, elec_price)) AS sxx,
    tidy3(regr_syy(emission_factor, elec_price)) AS syy, count(*) AS n, tidy(min(elec_price)) AS min_x, tidy(max(elec_price)) AS max_x FROM j""",
)
def price_emission_fit(t: Tables):
    out = relation(t, "line")
    return out.withColumns(
        {c: tidy(F.col(c), 3 if c in ("sxx", "syy") else 6) for c, kind in out.dtypes if kind == "double"}
    )


@query(
    "v9_daily_with_regime",
    with_views("wide", more=JOINED)
    + """, d AS (SELECT CAST(unnest(generate_series(min(date_trunc('day', ts)), max(date_trunc('day', ts)), INTERVAL 1 DAY)) AS DATE) AS day FROM j)
    SELECT '0' AS item_id, day, tidy(avg(elec_price)) AS elec_price, tidy(avg(emission_factor)) AS emission_factor,
    tidy(avg(energy_crisis)) AS energy_crisis, CAST(coalesce(avg(energy_crisis), 0) > 0.5 AS BIGINT) AS in_regime
    FROM d LEFT JOIN j ON CAST(j.ts AS DATE) = day GROUP BY day""",
)
def daily_with_regime(t: Tables):
    return tidied(relation(t, "daily"))


@query(
    "v9_regime_spans",
    """WITH o AS (SELECT CAST(ts AS DATE) AS day, avg(CASE WHEN isodow(ts) < 6 THEN 1.0 ELSE 0.0 END) AS f FROM events GROUP BY 1),
    d AS (SELECT day FROM o WHERE f > 0.5),
    m AS (SELECT day, CASE WHEN day - lag(day) OVER (ORDER BY day) <= 1 THEN 0 ELSE 1 END AS brk FROM d),
    r AS (SELECT day, sum(brk) OVER (ORDER BY day) AS run FROM m)
    SELECT '0' AS item_id, min(day) AS span_start, max(day) AS span_end, count(*) AS n_days FROM r GROUP BY run""",
)
def regime_spans(t: Tables):
    rows = t.events.select(
        F.lit("0").alias("item_id"), "ts", "value", (F.weekday("ts") < 5).cast("double").alias("energy_crisis")
    )
    return charts.regime_spans(charts.daily_with_flag(rows, ["value"], "energy_crisis"))


@query(
    "v10_regime_box_numbers",
    with_views("wide", more=JOINED)
    + """, q AS (SELECT energy_crisis, quantile_cont(emission_factor, 0.25) AS q1, quantile_cont(emission_factor, 0.5) AS median,
      quantile_cont(emission_factor, 0.75) AS q3 FROM j GROUP BY 1),
    b AS (SELECT j.*, q1, median, q3, emission_factor BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS near FROM j JOIN q USING (energy_crisis))
    SELECT energy_crisis, tidy(q1) AS q1, tidy(median) AS median, tidy(q3) AS q3, tidy(min(emission_factor) FILTER (near)) AS whisker_low,
    tidy(max(emission_factor) FILTER (near)) AS whisker_high, count(*) FILTER (NOT near) AS n_outliers FROM b GROUP BY ALL""",
)
def regime_box(t: Tables):
    return tidied(relation(t, "box"))


@query(
    "v11_month_profile",
    """SELECT month(o_orderdate) AS month, tidy2(avg(o_totalprice)) AS o_totalprice FROM orders GROUP BY 1""",
)
def month_profile(t: Tables):
    return tidied(charts.month_profile(t.read("orders"), ["o_totalprice"], "o_orderdate"), 2)


def correlation(t: Tables, name: str):
    return studies.correlation_study(t.wide, "temperature", "emissionfactor", STUDY)[name]


@query(
    "v12_hourly_change_profile",
    with_views("wide", more=CHANGES)
    + "SELECT hour(ts) AS hour, "
    + ", ".join(f"tidy(avg({c})) AS {c}" for c in STUDY)
    + " FROM stationary GROUP BY 1",
)
def change_profile(t: Tables):
    return tidied(correlation(t, "hour_means"))


@query(
    "v13_horizon_bounds",
    with_views("grid", more=ENDS)
    + """SELECT item_id, max(ts) FILTER (ts <= hi - INTERVAL 168 HOUR) AS train_end, max(ts) AS test_end, tidy(min(y)) AS low, tidy(max(y)) AS high,
    count(*) FILTER (ts <= hi - INTERVAL 168 HOUR) AS n_train, count(*) FILTER (ts > hi - INTERVAL 168 HOUR) AS n_test
    FROM grid JOIN ends USING (item_id) GROUP BY 1""",
)
def horizon_bounds(t: Tables):
    return tidied(charts.horizon_bounds(t.grid(), "y"))


@query(
    "v14_price_emission_quartiles",
    with_views("wide", more=JOINED + ", " + edges_sql("j", "elec_price"))
    + f"""SELECT CAST({bin_sql('elec_price')} AS BIGINT) AS bin, tidy(avg(elec_price)) AS price_mean, tidy(min(elec_price)) AS price_min,
    tidy(max(elec_price)) AS price_max, tidy(avg(emission_factor)) AS value_mean, tidy(stddev_samp(emission_factor)) AS value_std,
    count(*) AS value_count FROM j, edges GROUP BY 1""",
)
def price_emission_quartiles(t: Tables):
    return tidied(relation(t, "quartiles").drop("quartile"))


@query(
    "v14_price_emission_top_hours",
    with_views("wide", more=HOUR_CORR)
    + """, d AS (SELECT hour, corr AS r, CAST(n AS DOUBLE) AS n FROM c ORDER BY corr DESC, hour LIMIT 3)
    SELECT hour, tidy(r) AS corr, CAST(n AS BIGINT) AS n, tidy("""
    + p_sql(f"({PAIR_T})", "n - 2")
    + ") AS p_value FROM d",
)
def price_emission_top_hours(t: Tables):
    return tidied(relation(t, "top_hours"))


@query("g1_download_job", with_views("wide") + f"SELECT ts, {HISTORY_SQL} FROM wide")
def download_job(t: Tables):
    out = t.scratch("g1")
    landed = {which: landed_pages(t, f"g1-{which}", which) for which in utilisation.TYPE_CODES}
    studies.download_job(t.spark, landed, out, "20240131")
    return utilisation.read_history(t.spark, out)


def _gas_folder(t: Tables, label: str) -> str:
    folder = t.scratch(label)
    rows = t.daily.select(
        F.date_format("ts", "dd-MM-yyyy HH:mm").alias("datum"),
        F.replace((F.col("price") / 1000).cast("string"), F.lit("."), F.lit(",")).alias("prijs"),
    )
    rows.write.option("header", True).option("sep", ";").csv(f"{folder}/dynamische_gasprijzen_alltime.csv")
    return folder


STUDY_REGIME = features.Regime(start=date(1996, 10, 1), cuts=DAILY_CUTS)


@query(
    "g5_price_study_summary",
    with_views("daily")
    + """SELECT 'electricity' AS "table", count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts FROM daily WHERE day(ts) <> 31
    UNION ALL SELECT 'gas', count(*), min(ts), max(ts) FROM daily
    UNION ALL SELECT 'price_features', CAST(date_diff('hour', min(ts), max(ts)) AS BIGINT) + 1, min(ts), max(ts) FROM daily""",
)
def price_study(t: Tables):
    cfg = studies.StudyConfig(regime=STUDY_REGIME)
    results = studies.price_study(t.spark, written_prices(t, "g5-price"), _gas_folder(t, "g5-gas"), t.scratch("g5"), cfg)
    return results["summary"]


@query(
    "g5_price_study_without_gas",
    with_views("daily")
    + """, p AS (SELECT ts, CASE WHEN day(ts) <> 30 THEN round(price, 4) END AS p FROM daily WHERE day(ts) <> 31),
    f AS (SELECT ts, coalesce(p, (SELECT avg(p) FROM p)) AS price FROM p)
    SELECT CASE WHEN ts >= DATE '1998-01-01' THEN 'stabilization' WHEN ts >= DATE '1997-09-01' THEN 'peak_crisis'
      WHEN ts >= DATE '1997-02-24' THEN 'acute_crisis' WHEN ts >= DATE '1996-10-01' THEN 'early_crisis' ELSE 'pre_crisis' END AS crisis_phase,
    tidy2(avg(price)) AS elec_price_mean, tidy2(stddev_samp(price)) AS elec_price_std FROM f GROUP BY 1""",
)
def price_study_without_gas(t: Tables):
    cfg = studies.StudyConfig(regime=STUDY_REGIME)
    results = studies.price_study(t.spark, written_prices(t, "g5b-price"), t.scratch("g5b-none"), t.scratch("g5b"), cfg)
    return tidied(results["phase_statistics"], 2)


@query(
    "g6_price_emission_regimes",
    with_views("wide", more=JOINED)
    + """, c AS (SELECT energy_crisis, corr(elec_price, emission_factor) AS r, CAST(count(*) AS DOUBLE) AS n FROM j GROUP BY 1)
    SELECT energy_crisis, tidy(r) AS corr, CAST(n AS BIGINT) AS n, tidy("""
    + p_sql(f"({PAIR_T})", "n - 2")
    + ") AS p_value FROM c",
)
def price_emission_regimes(t: Tables):
    return tidied(relation(t, "regimes"))


@query(
    "g7_correlation_study_strongest_lag",
    with_views(
        "wide",
        more=CHANGES
        + ", lagged AS (SELECT emissionfactor, "
        + ", ".join(f"lag(temperature, {k}) OVER (ORDER BY ts) AS l{k}" for k in range(25))
        + " FROM stationary), c AS ("
        + " UNION ALL ".join(f"SELECT CAST({k} AS BIGINT) AS lag, corr(l{k}, emissionfactor) AS corr FROM lagged" for k in range(25))
        + ")",
    )
    + "SELECT '0' AS item_id, lag, tidy(corr) AS corr FROM c ORDER BY abs(c.corr) DESC, lag LIMIT 1",
)
def strongest_lag(t: Tables):
    return tidied(correlation(t, "strongest_lag"))


# Eighths times whole numbers up to 23 are exact in the single precision of a payload.
SNAPPED = "snapped AS (SELECT item_id, ts, round(y * 8) / 8 AS y FROM grid)"
FILLED_CELLS = ", ".join(
    f"tidy3({i + 1} * {'d' if name == 'wind_direction' else 'm'}.y) AS {name}" for i, name in enumerate(weather.VARIABLES.values())
)


@query(
    "g8_weather_job",
    with_views("grid", more=SNAPPED + ", " + impute_sql("snapped", "y", MEAN_TAIL) + ", " + impute_sql("snapped", "y", FILL_TAIL).replace("n_y", "n2_y").replace("l_y", "l2_y").replace("f_y", "f2_y"))
    + f"SELECT item_id, ts, {FILLED_CELLS} FROM f_y m JOIN f2_y d USING (item_id, ts)",
)
def weather_job(t: Tables):
    """All variables of the payloads, history and forecast landed apart, as the job stores them."""
    folders = {}
    cut = F.lit("2024-01-20").cast("timestamp")
    y = F.round(F.col("y") * 8) / 8
    for name, keep in (("history", F.col("ts") < cut), ("forecast", F.col("ts") >= cut)):
        folders[name] = t.scratch(f"g8-{name}")
        rows = t.series.filter(keep).select(
            "item_id",
            F.unix_seconds("ts").alias("time_start"),
            (F.unix_seconds("ts") + 3600).alias("time_end"),
            F.lit(3600).alias("interval"),
            *[F.array(y * (i + 1)).alias(landed) for i, landed in enumerate(weather.VARIABLES)],
        )
        rows.write.json(folders[name])
    out = t.scratch("g8")
    studies.weather_job(t.spark, folders["history"], folders["forecast"], out)
    stored = t.spark.read.parquet(out)
    return stored.select("item_id", "ts", *[tidy(F.col(c), 3).alias(c) for c in weather.VARIABLES.values()])


@query(
    "g9_run_summary",
    """SELECT 'events' AS "table", count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts FROM events
    UNION ALL SELECT 'orders', count(*), min(o_orderdate), max(o_orderdate) FROM orders
    UNION ALL SELECT 'lineitem', count(*), min(l_shipdate), max(l_shipdate) FROM lineitem""",
)
def run_summary(t: Tables):
    def timed(name: str, column: str):
        return t.read(name).select(F.col(column).cast("timestamp").alias("ts"))

    return studies.table_summary(
        {"events": timed("events", "ts"), "orders": timed("orders", "o_orderdate"), "lineitem": timed("lineitem", "l_shipdate")}
    )


