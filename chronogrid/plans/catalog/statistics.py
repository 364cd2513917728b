"""Bins, tests, regressions, autocorrelation and error reports over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronogrid.functions import numbers, timeparts
from chronogrid.functions.numbers import tidy
from chronogrid.operators import bins, bootstrap, calendar, charts, evaluate, features, model, quantreg, stats
from chronogrid.plans.catalog.aggregates import HOUR_CORR, bin_sql, edges_sql, tidied
from chronogrid.plans.catalog.base import Tables, query, with_views
from chronogrid.plans.catalog.calendars import HOLIDAY_SQL, JANUARY, JANUARY_FLAG
from chronogrid.plans.catalog.ordered import BY_TIME

STEPS = 4000


def p_sql(t: str, freedom: str) -> str:
    """Two-sided t tail by Simpson's rule on the density, as an independent check."""
    density = f"pow(1 + pow(abs({t}) * i / {STEPS}.0, 2) / ({freedom}), -(({freedom}) + 1) / 2.0)"
    weight = f"CASE WHEN i = 0 OR i = {STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    scale = f"exp(lgamma((({freedom}) + 1) / 2.0) - lgamma(({freedom}) / 2.0)) / sqrt(pi() * ({freedom}))"
    area = f"list_sum([{weight} * {density} FOR i IN range(0, {STEPS + 1})]) * abs({t}) / {STEPS}.0 / 3"
    return f"greatest(0, 1 - 2 * {scale} * {area})"


PAIR_T = "r * sqrt((n - 2) / (1 - r * r))"


@query(
    "c1_pearson_test",
    with_views("wide")
    + """, c AS (SELECT corr(elec_price, gas_price) AS r, CAST(count(*) AS DOUBLE) AS n FROM wide
      WHERE elec_price IS NOT NULL AND gas_price IS NOT NULL)
    SELECT tidy(r) AS corr, CAST(n AS BIGINT) AS n, tidy("""
    + p_sql(f"({PAIR_T})", "n - 2")
    + ") AS p_value FROM c",
)
def pearson_test(t: Tables):
    return tidied(stats.pearson_test(t.wide, "elec_price", "gas_price"))


@query(
    "c1_pearson_test_by_hour",
    with_views("wide", more=HOUR_CORR)
    + ", d AS (SELECT hour, corr AS r, CAST(n AS DOUBLE) AS n FROM c) SELECT hour, tidy(r) AS corr, CAST(n AS BIGINT) AS n, tidy("
    + p_sql(f"({PAIR_T})", "n - 2")
    + ") AS p_value FROM d",
)
def pearson_test_by_hour(t: Tables):
    return tidied(stats.pearson_test(features.temporal(t.wide), "elec_price", "emissionfactor", ["hour"], 10))


@query(
    "c2_welch_test",
    with_views("wide")
    + f""", w AS (SELECT emissionfactor AS v, {JANUARY_FLAG} AS f FROM wide WHERE emissionfactor IS NOT NULL),
    m AS (SELECT avg(v) FILTER (f = 0) AS m0, avg(v) FILTER (f = 1) AS m1, var_samp(v) FILTER (f = 0) / count(*) FILTER (f = 0) AS a,
      var_samp(v) FILTER (f = 1) / count(*) FILTER (f = 1) AS b, count(*) FILTER (f = 0) AS n0, count(*) FILTER (f = 1) AS n1 FROM w),
    s AS (SELECT *, (m0 - m1) / sqrt(a + b) AS t, pow(a + b, 2) / (a * a / (n0 - 1) + b * b / (n1 - 1)) AS df FROM m)
    SELECT tidy(m0) AS mean_before, n0 AS n_before, tidy(m1) AS mean_during, n1 AS n_during, tidy(100 * (m1 - m0) / m0) AS pct_change,
    tidy(t) AS t_stat, tidy(df) AS freedom, tidy("""
    + p_sql("t", "df")
    + ") AS p_value FROM s",
)
def welch(t: Tables):
    flagged = t.wide.withColumn("f", numbers.regime_flag(F.col("ts"), JANUARY.start, JANUARY.end))
    return tidied(stats.welch_test(flagged, "emissionfactor", "f"))


@query(
    "c3_regression_line",
    """SELECT tidy(regr_slope(l_extendedprice, l_quantity)) AS slope, tidy3(regr_intercept(l_extendedprice, l_quantity)) AS intercept,
    tidy(regr_r2(l_extendedprice, l_quantity)) AS r2, count(*) AS n FROM lineitem""",
)
def regression_line(t: Tables):
    out = stats.ols_line(t.read("lineitem"), "l_quantity", "l_extendedprice")
    return out.select(
        tidy(F.col("slope")).alias("slope"), tidy(F.col("intercept"), 3).alias("intercept"), tidy(F.col("r2")).alias("r2"), "n"
    )


@query(
    "c3_regression_band",
    with_views("wide")
    + """, l AS (SELECT regr_slope(emissionfactor, elec_price) AS b, regr_intercept(emissionfactor, elec_price) AS a,
      regr_r2(emissionfactor, elec_price) AS r2, regr_avgx(emissionfactor, elec_price) AS mx, regr_sxx(emissionfactor, elec_price) AS sxx,
      regr_syy(emissionfactor, elec_price) AS syy, count(*) AS n, min(elec_price) AS lo, max(elec_price) AS hi FROM wide
      WHERE emissionfactor IS NOT NULL AND elec_price IS NOT NULL),
    p AS (SELECT *, i, lo + (hi - lo) / 4 * i AS x FROM l, (SELECT unnest(range(0, 5)) AS i))
    SELECT i, tidy(x) AS x, tidy(a + b * x) AS fit, tidy(sqrt(syy * (1 - r2) / (n - 2)) * sqrt(1.0 / n + (x - mx) * (x - mx) / sxx)) AS std_error FROM p""",
)
def regression_band(t: Tables):
    return tidied(stats.ols_band(t.wide, "elec_price", "emissionfactor"))


@query(
    "c4_box_numbers",
    with_views("wide")
    + f""", w AS (SELECT emissionfactor AS v, {JANUARY_FLAG} AS f FROM wide WHERE emissionfactor IS NOT NULL),
    q AS (SELECT f, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM w GROUP BY 1)
    SELECT f, tidy(q1) AS q1, tidy(median) AS median, tidy(q3) AS q3,
    tidy(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1))) AS whisker_low,
    tidy(max(v) FILTER (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1))) AS whisker_high,
    count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_outliers FROM w JOIN q USING (f) GROUP BY ALL""",
)
def box_numbers(t: Tables):
    flagged = t.wide.withColumn("f", numbers.regime_flag(F.col("ts"), JANUARY.start, JANUARY.end))
    return tidied(stats.box_numbers(flagged, "emissionfactor", "f"))


@query("c5_repeatable_sample")
def repeatable_sample(t: Tables):
    return stats.hashed_sample(t.events, ["event_id"], 5000, 42).select("event_id", "event_type", "value")


ACF_LAGS = list(range(49))
PACF_LAGS = list(range(61))


@query(
    "c6_partial_autocorrelation",
    with_views("series").replace("WITH ", "WITH RECURSIVE ", 1)
    + ", x AS (SELECT item_id, ts, y - avg(y) OVER (PARTITION BY item_id) AS d FROM series), l AS (SELECT item_id, d, "
    + ", ".join(f"lag(d, {k}) {BY_TIME} AS l{k}" for k in PACF_LAGS)
    + " FROM x), r AS (SELECT item_id, count(*) AS n, ["
    + ", ".join(f"sum(d * l{k}) / sum(d * d)" for k in PACF_LAGS)
    + """] AS rho FROM l GROUP BY 1),
    dl AS (
      SELECT item_id, n, rho, 1 AS k, [rho[2]] AS phi FROM r
      UNION ALL
      SELECT item_id, n, rho, k + 1, list_append([phi[j] - z * phi[k + 1 - j] FOR j IN range(1, k + 1)], z)
      FROM (SELECT *, (rho[k + 2] - list_sum([phi[j] * rho[k + 2 - j] FOR j IN range(1, k + 1)]))
        / (1 - list_sum([phi[j] * rho[j + 1] FOR j IN range(1, k + 1)])) AS z FROM dl WHERE k < 60))
    SELECT item_id, CAST(k AS BIGINT) AS lag, tidy(phi[k]) AS pacf, tidy(1.959963984540054 / sqrt(n)) AS band FROM dl
    UNION ALL SELECT item_id, 0, 1.0, tidy(1.959963984540054 / sqrt(n)) FROM r""",
)
def partial_autocorrelation(t: Tables):
    return tidied(stats.partial_autocorrelation(t.series, "y", 60))


@query(
    "c7_autocorrelation",
    with_views("series")
    + ", x AS (SELECT item_id, ts, y - avg(y) OVER (PARTITION BY item_id) AS d FROM series), l AS (SELECT item_id, d, "
    + ", ".join(f"lag(d, {k}) {BY_TIME} AS l{k}" for k in ACF_LAGS)
    + " FROM x) "
    + " UNION ALL ".join(
        f"SELECT item_id, count(*) AS n, CAST({k} AS BIGINT) AS lag, tidy(sum(d * l{k}) / sum(d * d)) AS acf FROM l GROUP BY 1" for k in ACF_LAGS
    ),
)
def autocorrelation(t: Tables):
    return tidied(stats.autocorrelation(t.series, "y", 48))


@query(
    "c7_autocorrelation_of_days",
    with_views("daily")
    + ", x AS (SELECT item_id, ts, price - avg(price) OVER (PARTITION BY item_id) AS d FROM daily), l AS (SELECT item_id, d, "
    + ", ".join(f"lag(d, {k}) {BY_TIME} AS l{k}" for k in ACF_LAGS)
    + " FROM x) "
    + " UNION ALL ".join(
        f"SELECT item_id, count(*) AS n, CAST({k} AS BIGINT) AS lag, tidy(sum(d * l{k}) / sum(d * d)) AS acf FROM l GROUP BY 1" for k in ACF_LAGS
    ),
)
def autocorrelation_of_days(t: Tables):
    """A series of several chunks whose rows lie a day or more apart."""
    return tidied(stats.autocorrelation(t.daily, "price", 48))


@query(
    "c8_monthly_correlation",
    """WITH m AS (SELECT month(l_shipdate) AS month, avg(l_extendedprice) AS a, avg(l_quantity) AS b FROM lineitem GROUP BY 1),
    c AS (SELECT corr(a, b) AS r, CAST(count(*) AS DOUBLE) AS n FROM m)
    SELECT tidy(r) AS corr, CAST(n AS BIGINT) AS n, tidy("""
    + p_sql(f"({PAIR_T})", "n - 2")
    + ") AS p_value FROM c",
)
def monthly_correlation(t: Tables):
    months = charts.month_profile(t.read("lineitem"), ["l_extendedprice", "l_quantity"], "l_shipdate")
    return tidied(stats.pearson_test(months, "l_extendedprice", "l_quantity"))


@query(
    "c9_step_error_correlation",
    with_views("err")
    + """SELECT tidy(avg(abs(actual_diff))) AS mean_abs_diff,
    tidy(corr(actual_diff, error)) AS corr_diff_error FROM err""",
)
def step_error(t: Tables):
    return tidied(evaluate.step_analysis(t.errors(False)))


@query(
    "x14_quantile_bins",
    "WITH " + edges_sql("lineitem", "l_extendedprice")
    + f"""SELECT l_orderkey, l_linenumber, l_extendedprice, CAST({bin_sql('l_extendedprice')} AS BIGINT) AS bin FROM lineitem, edges""",
)
def quantile_bins(t: Tables):
    rows = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return bins.quantile_bins(rows, "l_extendedprice", 4)


@query(
    "x14_quantile_bins_by_series",
    with_views("series")
    + """, l AS (SELECT item_id, list_sort(list(y)) AS l FROM series GROUP BY 1),
    e AS (SELECT item_id, [l[CAST(floor(p) AS BIGINT) + 1] + (l[CAST(ceil(p) AS BIGINT) + 1] - l[CAST(floor(p) AS BIGINT) + 1]) * (p - floor(p))
      FOR p IN [0.0, (len(l) - 1) * 0.25, (len(l) - 1) * 0.5, (len(l) - 1) * 0.75, len(l) - 1.0]] AS e FROM l)
    SELECT item_id, ts, CAST("""
    + bin_sql("y")
    + " AS BIGINT) AS bin FROM series JOIN e USING (item_id)",
)
def quantile_bins_by_series(t: Tables):
    return bins.quantile_bins(t.series, "y", 4, ["item_id"]).select("item_id", "ts", "bin")


@query(
    "x15_bin_ranges",
    "WITH " + edges_sql("lineitem", "l_extendedprice")
    + f""", b AS (SELECT CAST({bin_sql('l_extendedprice')} AS BIGINT) AS bin, l_extendedprice AS v FROM lineitem, edges)
    SELECT bin, min(v) AS low, max(v) AS high, count(*) AS n FROM b GROUP BY 1""",
)
def bin_ranges(t: Tables):
    binned = bins.quantile_bins(t.read("lineitem").select("l_extendedprice"), "l_extendedprice", 4)
    return binned.groupBy("bin").agg(
        F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"), F.count("*").alias("n")
    )


@query(
    "x15_quantile_edges",
    with_views("series")
    + "SELECT item_id, count(y) AS n, "
    + ", ".join(f"tidy(quantile_cont(y, {p})) AS p{int(p * 100)}" for p in (0.1, 0.25, 0.5, 0.75, 0.9))
    + " FROM series GROUP BY 1",
)
def quantile_edges(t: Tables):
    names = {f"p{int(p * 100)}": p for p in (0.1, 0.25, 0.5, 0.75, 0.9)}
    return tidied(bins.quantile_columns(t.series, ["item_id"], "y", names))


@query(
    "x16_tied_edges_fallback",
    """WITH c AS (SELECT floor(round(l_discount * 100) / 3) AS v FROM lineitem),
    top AS (SELECT v, count(*) AS n FROM c GROUP BY 1 ORDER BY n DESC, v LIMIT 5)
    SELECT 'v' AS feature, v AS value, n FROM top""",
)
def tied_edges(t: Tables):
    rows = t.read("lineitem").select(F.floor(F.round(F.col("l_discount") * 100) / 3).cast("double").alias("v"))
    edges = bins.exact_quantiles(rows, [], ["v"], [0, 0.25, 0.5, 0.75, 1.0])
    tied = edges.select(bins.has_tied_edges(F.col("edges"))).scalar()
    counts = stats.value_counts(rows, "v", 5)
    return counts.filter(tied).select(F.lit("v").alias("feature"), "value", "n")


@query(
    "x17_equal_width_bins",
    """WITH r AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
    SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_quantity <= lo + (hi - lo) / 3 THEN 0 WHEN l_quantity <= lo + (hi - lo) / 3 * 2 THEN 1
    ELSE 2 END AS BIGINT) AS bin FROM lineitem, r""",
)
def equal_width(t: Tables):
    rows = t.read("lineitem")
    ends = rows.agg(F.struct(F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"))).scalar()
    number = bins.equal_width_bin(F.col("l_quantity"), F.col("ends.low"), F.col("ends.high"), 3)
    return rows.withColumn("ends", ends).select("l_orderkey", "l_linenumber", number.alias("bin"))


METRIC_SQL = """tidy(sqrt(avg(error * error))) AS rmse, tidy(avg(abs_error)) AS mae,
    tidy(avg(abs_error / greatest(abs(actual), 2.220446049250313e-16)) * 100) AS mape,
    tidy(1 - sum(error * error) / (var_pop(actual) * count(*))) AS r2, tidy(avg(error)) AS mean_error,
    tidy(avg(pct_error)) AS mean_pct_error, count(*) AS n"""


@query("e1_metrics", with_views("err") + f"SELECT {METRIC_SQL} FROM err")
def metrics(t: Tables):
    return tidied(evaluate.metrics(t.errors(False)))


@query("e2_metrics_by_series", with_views("err") + f"SELECT item_id, {METRIC_SQL} FROM err GROUP BY 1")
def metrics_by_series(t: Tables):
    return tidied(evaluate.metrics(t.errors(False), ["item_id"]))


@query(
    "e3_mape_by_weekday",
    with_views("err")
    + """SELECT dayofweek, tidy(avg(abs_error / greatest(abs(actual), 2.220446049250313e-16)) * 100) AS mape,
    count(*) AS n FROM err GROUP BY 1""",
)
def mape(t: Tables):
    return tidied(evaluate.metrics(t.errors(False), ["dayofweek"]).select("dayofweek", "mape", "n"))


@query(
    "e4_r2_by_series",
    with_views("err")
    + """, m AS (SELECT *, avg(actual) OVER (PARTITION BY item_id) AS mean FROM err)
    SELECT item_id, tidy(1 - sum(error * error) / sum((actual - mean) * (actual - mean))) AS r2 FROM m GROUP BY 1""",
)
def r_squared(t: Tables):
    return tidied(evaluate.metrics(t.errors(False), ["item_id"]).select("item_id", "r2"))


@query(
    "e5_mean_percentage_error",
    with_views("err") + "SELECT item_id, tidy(avg(pct_error)) AS mean_pct_error FROM err GROUP BY 1",
)
def mean_percentage_error(t: Tables):
    return tidied(evaluate.metrics(t.errors(False), ["item_id"]).select("item_id", "mean_pct_error"))


@query(
    "e6_explained_error_table",
    with_views("err", more=HOLIDAY_SQL)
    + """SELECT item_id, ts, tidy(actual) AS actual, tidy(predicted) AS predicted, tidy(error) AS error, hour, dayofweek,
    is_weekend, CAST(h.name IS NOT NULL AS BIGINT) AS is_holiday, tidy(temperature) AS temperature, tidy(humidity) AS humidity,
    tidy(elec_price) AS elec_price, tidy(gas_price) AS gas_price FROM err LEFT JOIN all_holidays h ON CAST(ts AS DATE) = h.date""",
)
def explained_errors(t: Tables):
    columns = ["actual", "predicted", "error", "temperature", "humidity", "elec_price", "gas_price"]
    out = calendar.add_holidays(t.errors())
    return out.select(
        "item_id", "ts", "hour", "dayofweek", "is_weekend", "is_holiday", *[tidy(F.col(c)).alias(c) for c in columns]
    )


@query(
    "e7_temporal_error_patterns",
    with_views("err")
    + " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d} AS key, tidy(avg(error)) AS mean_value, tidy(sqrt(avg(error * error))) AS rms_value FROM err GROUP BY 2"
        for d in ("hour", "dayofweek", "is_weekend")
    ),
)
def error_patterns(t: Tables):
    return tidied(evaluate.temporal_patterns(t.errors(False)))


@query(
    "e8_conditional_mae",
    with_views("err")
    + """SELECT tidy(avg(abs_error) FILTER (is_weekend = 1)) AS weekend_mae, tidy(avg(abs_error) FILTER (is_weekend = 0)) AS weekday_mae,
    tidy(avg(abs_error) FILTER (hour BETWEEN 8 AND 17)) AS office_mae, count(*) FILTER (is_weekend = 1) AS weekend_n,
    count(*) FILTER (is_weekend = 0) AS weekday_n, count(*) FILTER (hour BETWEEN 8 AND 17) AS office_n FROM err""",
)
def conditional(t: Tables):
    conditions = {
        "weekend": F.col("is_weekend") == 1,
        "weekday": F.col("is_weekend") == 0,
        "office": F.col("hour").between(8, 17),
    }
    return tidied(evaluate.conditional_mae(t.errors(False), conditions))


def quartile_sql(column: str, labels: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(labels))
    return (
        with_views("err", more=edges_sql("err", column))
        + f""", b AS (SELECT CAST({bin_sql(column)} AS BIGINT) AS bin, {column} AS v, error FROM err, edges WHERE {column} IS NOT NULL)
        SELECT bin, CASE bin {cases} END AS label, tidy(min(v)) AS low, tidy(max(v)) AS high, tidy(avg(error)) AS mean_error,
        tidy(stddev_samp(error)) AS std_error, count(*) AS n FROM b GROUP BY 1, 2"""
    )


@query("e9_error_by_temperature", quartile_sql("temperature", evaluate.TEMPERATURE_LABELS))
def error_by_temperature(t: Tables):
    return tidied(evaluate.by_quartile(t.stored_errors(), "temperature", evaluate.TEMPERATURE_LABELS))


@query("e10_error_by_price", quartile_sql("elec_price", evaluate.PRICE_LABELS))
def error_by_price(t: Tables):
    return tidied(evaluate.by_quartile(t.stored_errors(), "elec_price", evaluate.PRICE_LABELS))


@query(
    "e11_error_by_regime",
    with_views("err")
    + f"""SELECT {JANUARY_FLAG} AS energy_crisis, tidy(avg(error)) AS mean_error, tidy(avg(abs_error)) AS mae, count(*) AS n
    FROM err GROUP BY 1""",
)
def error_by_regime(t: Tables):
    flagged = t.errors(False).withColumn("energy_crisis", numbers.regime_flag(F.col("ts"), JANUARY.start, JANUARY.end))
    return tidied(evaluate.by_flag(flagged, "energy_crisis"))


PROFILE_SQL = (
    with_views(
        "err",
        more="""p AS (SELECT temperature, is_weekend, hour % 3 AS third, 7 AS constant,
      CASE WHEN temperature > 60 THEN floor(temperature / 5) WHEN temperature <= 60 THEN 0 END AS mostly_zero, error FROM err), """
        + edges_sql("p", "temperature"),
    )
    + f""", t AS (SELECT CAST({bin_sql('temperature')} AS BIGINT) AS bin, temperature AS v, error FROM p, edges WHERE temperature IS NOT NULL),
    z AS (SELECT mostly_zero AS v, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, mostly_zero) - 1 AS bin FROM p
      WHERE mostly_zero IS NOT NULL GROUP BY 1),
    every AS (SELECT 'temperature' AS feature, 'quantile' AS method, bin, v, error FROM t
      UNION ALL SELECT 'is_weekend', 'equal_width', is_weekend, is_weekend, error FROM p
      UNION ALL SELECT 'third', 'equal_width', third, third, error FROM p
      UNION ALL SELECT 'constant', 'single', 0, constant, error FROM p
      UNION ALL SELECT 'mostly_zero', 'counts', z.bin, p.mostly_zero, p.error FROM p JOIN z ON z.v = p.mostly_zero WHERE z.bin < 5)
    SELECT feature, method, bin, tidy(min(v)) AS low, tidy(max(v)) AS high, tidy(avg(error)) AS mean_error,
    tidy(stddev_samp(error)) AS std_error, count(*) AS n FROM every GROUP BY 1, 2, 3"""
)


@query("e12_feature_profile", PROFILE_SQL)
def feature_profile(t: Tables):
    x = F.col("temperature")
    errors = t.stored_errors().withColumns(
        {
            "third": F.col("hour") % 3,
            "constant": F.lit(7),
            "mostly_zero": F.when(x > 60, F.floor(x / 5)).when(x <= 60, F.lit(0)),
        }
    )
    names = ["temperature", "is_weekend", "third", "constant", "mostly_zero"]
    return tidied(evaluate.feature_profile(errors, names))


@query(
    "e13_target_steps",
    with_views("err")
    + """SELECT item_id, tidy(avg(abs(actual_diff))) AS mean_abs_diff, tidy(corr(actual_diff, error)) AS corr_diff_error
    FROM err GROUP BY 1""",
)
def target_steps(t: Tables):
    x, y = stats.pair("actual_diff", "error")
    out = t.errors(False).groupBy("item_id").agg(
        F.avg(F.abs("actual_diff")).alias("mean_abs_diff"), F.corr(x, y).alias("corr_diff_error")
    )
    return tidied(out)


BAND_SQL = (
    with_views("err")
    + """, res AS (SELECT hour, quantile_cont(actual - predicted, 0.1) AS d10, quantile_cont(actual - predicted, 0.9) AS d90 FROM err GROUP BY 1),
    b AS (SELECT item_id, ts, actual, predicted, predicted + d10 AS q10, predicted + d90 AS q90 FROM err JOIN res USING (hour))
    """
)


@query(
    "e14_band_check",
    BAND_SQL
    + """SELECT tidy(avg(CAST(actual BETWEEN q10 AND q90 AS DOUBLE))) AS coverage, tidy(avg(q90 - q10)) AS mean_width,
    tidy(avg(greatest((actual - q10) * 0.1, (actual - q10) * (0.1 - 1)))) AS pinball_low,
    tidy(avg(greatest((actual - q90) * 0.9, (actual - q90) * (0.9 - 1)))) AS pinball_high, count(*) AS n FROM b""",
)
def band_check(t: Tables):
    e = t.stored_errors()
    bands = model.residual_bands(e, ["hour"], [0.1, 0.9], few_groups=True)
    forecast = model.quantile_forecast(e.select("item_id", "ts", "hour", "actual", "predicted"), bands, ["hour"], [0.1, 0.9])
    return tidied(evaluate.band_check(forecast))


@query(
    "m8_quantile_forecast",
    BAND_SQL + "SELECT item_id, ts, tidy(predicted) AS mean, tidy(q10) AS q10, tidy(q90) AS q90 FROM b",
)
def quantile_forecast(t: Tables):
    e = t.stored_errors()
    bands = model.residual_bands(e, ["hour"], [0.1, 0.9], few_groups=True)
    out = model.quantile_forecast(e.select("item_id", "ts", "hour", "predicted"), bands, ["hour"], [0.1, 0.9])
    return tidied(out.drop("hour"))


HOUR_COVARIATES = ["hour_sin", "hour_cos", "is_weekend", "temperature", "humidity", "elec_price", "gas_price"]


@query("m8_quantile_regression")
def quantile_regression(t: Tables):
    """The last week of each series, by lines fitted to the weeks before it."""
    circle = dict(zip(["hour_sin", "hour_cos"], timeparts.cyclic(F.col("hour"), 24)))
    rows = model.holdout(t.stored_errors().withColumns(circle))
    fitted = quantreg.fit(rows.where("NOT is_test"), "actual", ["predicted", *HOUR_COVARIATES])
    out = quantreg.predict(fitted, rows.where("is_test")).withColumnRenamed("predicted", "mean")
    return tidied(out.select("item_id", "ts", "step", "mean", *model.quantile_names()))


@query("c3_bootstrap_band")
def bootstrap_band(t: Tables):
    """The regression band of `c3_regression_band` by resampling."""
    return tidied(bootstrap.bootstrap_band(t.wide, "elec_price", "emissionfactor", ["ts"]))
