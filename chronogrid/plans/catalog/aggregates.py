"""Grouped aggregates, summaries and ordering over the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from chronogrid.functions import numbers, timeparts
from chronogrid.functions.numbers import tidy
from chronogrid.operators import align, calendar, charts, evaluate, features, grid, stats
from chronogrid.plans import studies
from chronogrid.plans.catalog.base import Tables, query, with_views
from chronogrid.plans.catalog.calendars import CHANGES, JANUARY, JANUARY_FLAG, JANUARY_PHASE, STUDY
from chronogrid.plans.catalog.ordered import BY_TIME
from chronogrid.plans.catalog.scalars import DAILY_CUTS, PHASE_SQL
from chronogrid.sources import prices, weather


def tidied(df, digits: int = 6):
    """All double columns rounded for comparison."""
    return df.withColumns({c: tidy(F.col(c), digits) for c, kind in df.dtypes if kind == "double"})


@query(
    "a1_mean_by_calendar_part",
    """WITH e AS (SELECT value, hour(ts) AS hour, isodow(ts) - 1 AS dow, CAST(isodow(ts) > 5 AS BIGINT) AS we FROM events)
    SELECT 'hour' AS dimension, hour AS key, tidy(avg(value)) AS mean_value, tidy(sqrt(avg(value * value))) AS rms_value FROM e GROUP BY 2
    UNION ALL SELECT 'dayofweek', dow, tidy(avg(value)), tidy(sqrt(avg(value * value))) FROM e GROUP BY 2
    UNION ALL SELECT 'is_weekend', we, tidy(avg(value)), tidy(sqrt(avg(value * value))) FROM e GROUP BY 2""",
)
def mean_by_part(t: Tables):
    out = align.labelled_metrics(features.temporal(t.events), ["hour", "dayofweek", "is_weekend"], "value")
    return tidied(out)


@query(
    "a2_year_month_pivot",
    "SELECT month(o_orderdate) AS month, "
    + ", ".join(f"tidy2(avg(o_totalprice) FILTER (year(o_orderdate) = {y})) AS y{y}" for y in range(1995, 2002))
    + " FROM orders GROUP BY 1",
)
def year_month(t: Tables):
    out = charts.year_month_matrix(t.read("orders"), "o_totalprice", "o_orderdate")
    return tidied(out, 2)


@query(
    "a3_root_mean_square",
    "SELECT event_type, tidy(sqrt(avg(value * value))) AS rms FROM events GROUP BY 1",
)
def root_mean_square(t: Tables):
    return t.events.groupBy("event_type").agg(tidy(F.sqrt(F.avg(F.col("value") * F.col("value")))).alias("rms"))


@query(
    "a4_intraday_std",
    "SELECT CAST(ts AS DATE) AS day, tidy(stddev_samp(value)) AS volatility FROM events GROUP BY 1",
)
def intraday_std(t: Tables):
    return tidied(t.events.groupBy(F.to_date("ts").alias("day")).agg(F.stddev_samp("value").alias("volatility")))


@query(
    "a5_grouping_sets",
    with_views("err")
    + """SELECT hour, dayofweek, is_weekend, tidy(avg(error)) AS mean_error, tidy(sqrt(avg(error * error))) AS rms_error,
    count(*) AS n FROM err GROUP BY GROUPING SETS ((hour), (dayofweek), (is_weekend))""",
)
def grouping_sets(t: Tables):
    e = t.errors(False)
    sets = [[F.col("hour")], [F.col("dayofweek")], [F.col("is_weekend")]]
    out = e.groupingSets(sets, "hour", "dayofweek", "is_weekend").agg(
        F.avg("error").alias("mean_error"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rms_error"),
        F.count("*").alias("n"),
    )
    return tidied(out)


EDGES_SQL = """edges AS (SELECT [l[CAST(floor(p) AS BIGINT) + 1] + (l[CAST(ceil(p) AS BIGINT) + 1] - l[CAST(floor(p) AS BIGINT) + 1])
      * (p - floor(p)) FOR p IN [(len(l) - 1) * 0.0, (len(l) - 1) * 0.25, (len(l) - 1) * 0.5, (len(l) - 1) * 0.75, (len(l) - 1) * 1.0]] AS e
    FROM (SELECT list_sort(list({column})) AS l FROM {source} WHERE {column} IS NOT NULL))"""
BIN_SQL = "CASE WHEN {column} <= e[2] THEN 0 WHEN {column} <= e[3] THEN 1 WHEN {column} <= e[4] THEN 2 ELSE 3 END"


def edges_sql(source: str, column: str) -> str:
    """Quartile edges by linear interpolation as a one-row CTE `edges(e)`."""
    return EDGES_SQL.format(source=source, column=column)


def bin_sql(column: str) -> str:
    """Number of the quartile bin from the edges."""
    return BIN_SQL.format(column=column)


@query(
    "a6_stats_by_bin",
    with_views("err", more=edges_sql("err", "temperature"))
    + f"""SELECT CAST({bin_sql('temperature')} AS BIGINT) AS bin, tidy(avg(error)) AS mean_error,
    tidy(stddev_samp(error)) AS std_error, count(error) AS n FROM err, edges WHERE temperature IS NOT NULL GROUP BY 1""",
)
def stats_by_bin(t: Tables):
    out = evaluate.by_quartile(t.stored_errors(), "temperature", evaluate.TEMPERATURE_LABELS)
    return tidied(out.select("bin", "mean_error", "std_error", "n"))


@query(
    "a7_price_quartiles",
    with_views("wide", more="j AS (SELECT * FROM wide WHERE elec_price IS NOT NULL), " + edges_sql("j", "elec_price"))
    + f"""SELECT CAST({bin_sql('elec_price')} AS BIGINT) AS bin,
    CASE {bin_sql('elec_price')} WHEN 0 THEN 'Q1 (Low)' WHEN 1 THEN 'Q2' WHEN 2 THEN 'Q3' ELSE 'Q4 (High)' END AS quartile,
    tidy(avg(elec_price)) AS price_mean, tidy(min(elec_price)) AS price_min, tidy(max(elec_price)) AS price_max,
    tidy(avg(emissionfactor)) AS value_mean, tidy(stddev_samp(emissionfactor)) AS value_std,
    count(emissionfactor) AS value_count FROM j, edges GROUP BY 1, 2""",
)
def price_quartiles(t: Tables):
    return tidied(studies.quartile_report(t.wide, "elec_price", "emissionfactor"))


@query(
    "a8_stats_by_phase",
    with_views("wide")
    + f"""SELECT {JANUARY_PHASE} AS crisis_phase, tidy(avg(elec_price)) AS elec_price_mean, tidy(avg(gas_price)) AS gas_price_mean,
    tidy(stddev_samp(elec_price)) AS elec_price_std, tidy(stddev_samp(gas_price)) AS gas_price_std FROM wide GROUP BY 1""",
)
def stats_by_phase(t: Tables):
    hourly = t.wide.withColumns(features.regime_columns(F.col("ts"), JANUARY))
    return tidied(studies.phase_statistics(hourly, ["elec_price", "gas_price"]))


@query(
    "a9_mean_by_month",
    """SELECT month(l_shipdate) AS month, tidy2(avg(l_extendedprice)) AS l_extendedprice, tidy(avg(l_quantity)) AS l_quantity
    FROM lineitem GROUP BY 1""",
)
def mean_by_month(t: Tables):
    out = charts.month_profile(t.read("lineitem"), ["l_extendedprice", "l_quantity"], "l_shipdate")
    return out.select("month", tidy(F.col("l_extendedprice"), 2).alias("l_extendedprice"), tidy(F.col("l_quantity")).alias("l_quantity"))


@query(
    "a10_daily_mean",
    """WITH o AS (SELECT o_orderstatus || ' ' || o_orderpriority AS item_id, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders),
    d AS (SELECT item_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM o GROUP BY 1)
    SELECT item_id, day, tidy3(avg(o_totalprice)) AS price FROM d LEFT JOIN o USING (item_id, day) GROUP BY 1, 2""",
)
def daily_mean(t: Tables):
    """One series per status and priority; the rarer ones have days without orders."""
    rows = t.read("orders").select(
        F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("item_id"), F.col("o_orderdate").cast("timestamp").alias("ts"), F.col("o_totalprice").alias("price")
    )
    return tidied(grid.daily_mean(rows, ["price"]), 3)


RANGED = ["elec_price", "gas_price", "temperature", "humidity"]


@query(
    "a11_ranges",
    with_views("wide")
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", min({c}) AS "min", max({c}) AS "max", count({c}) AS n, count(*) - count({c}) AS n_null FROM wide"""
        for c in RANGED
    ),
)
def ranges(t: Tables):
    return weather.ranges(t.wide, RANGED)


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "a12_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS "count", tidy3(avg({c})) AS mean, tidy3(stddev_samp({c})) AS std, min({c}) AS "min",
        tidy3(quantile_cont({c}, 0.25)) AS p25, tidy3(quantile_cont({c}, 0.5)) AS p50, tidy3(quantile_cont({c}, 0.75)) AS p75,
        max({c}) AS "max" FROM lineitem"""
        for c in DESCRIBED
    ),
)
def describe(t: Tables):
    out = stats.describe(t.read("lineitem"), DESCRIBED)
    return out.withColumns({c: tidy(F.col(c), 3) for c in ("mean", "std", "p25", "p50", "p75")})


PROFILED = ["temperature", "humidity", "elec_price", "gas_price"]


@query(
    "a13_feature_statistics",
    with_views("err")
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, tidy(avg({c})) AS mean, tidy(stddev_samp({c})) AS std, tidy(min({c})) AS "min", tidy(max({c})) AS "max",
        count(*) FILTER ({c} = 0) AS n_zero, tidy(100.0 * count(*) FILTER ({c} = 0) / count(*)) AS pct_zero,
        tidy(corr({c}, error)) AS corr_error FROM err WHERE {c} IS NOT NULL"""
        for c in PROFILED
    ),
)
def feature_statistics(t: Tables):
    return tidied(evaluate.feature_statistics(t.errors(), PROFILED))


@query(
    "a14_distinct_count",
    """SELECT count(DISTINCT l_quantity) AS n_quantity, count(DISTINCT l_discount) AS n_discount, count(DISTINCT l_shipdate) AS n_days
    FROM lineitem""",
)
def distinct_count(t: Tables):
    return t.read("lineitem").agg(
        F.count_distinct("l_quantity").alias("n_quantity"),
        F.count_distinct("l_discount").alias("n_discount"),
        F.count_distinct("l_shipdate").alias("n_days"),
    )


@query(
    "a15_value_counts",
    "SELECT l_quantity AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 5",
)
def value_counts(t: Tables):
    return stats.value_counts(t.read("lineitem"), "l_quantity", 5)


@query(
    "a16_null_counts",
    with_views("grid", "wide")
    + """, j AS (SELECT g.y, w.temperature FROM grid g LEFT JOIN wide w ON w.ts = g.ts)
    SELECT count(*) - count(y) AS y, count(*) - count(temperature) AS temperature FROM j""",
)
def null_counts(t: Tables):
    joined = t.grid().join(t.wide.select("ts", "temperature"), "ts", "left")
    return joined.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("y", "temperature")])


@query(
    "a17_duplicate_times",
    """SELECT CAST(count(*) AS BIGINT) AS n_rows, count(DISTINCT date_trunc('hour', ts)) AS n_times,
    count(*) - count(DISTINCT date_trunc('hour', ts)) AS n_duplicates FROM events""",
)
def duplicate_times(t: Tables):
    return prices.duplicate_times(t.events.select(F.date_trunc("hour", "ts").alias("ts")))


@query(
    "a18_pearson",
    with_views("wide")
    + """SELECT tidy(corr(elec_price, gas_price)) AS corr, count(*) AS n FROM wide
    WHERE elec_price IS NOT NULL AND gas_price IS NOT NULL""",
)
def pearson(t: Tables):
    return tidied(stats.pearson(t.wide, "elec_price", "gas_price"))


@query(
    "a18_pearson_with_nan",
    """SELECT event_type, tidy(corr(value, k)) AS corr, count(*) AS n FROM
    (SELECT event_type, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events) WHERE k <> 0 AND value > 1 GROUP BY 1""",
)
def pearson_nan(t: Tables):
    k = F.get_json_object("props", "$.k").cast("double")
    rows = t.events.select(
        "event_type",
        F.when(F.col("value") > 1, F.col("value")).otherwise(F.lit(float("nan"))).alias("value"),
        F.when(k != 0, k).alias("k"),
    )
    return tidied(stats.pearson(rows, "value", "k", ["event_type"]))


@query(
    "a19_corr_by_hour",
    with_views("wide", more=CHANGES)
    + "SELECT hour(ts) AS hour, tidy(corr(temperature, emissionfactor)) AS corr, count(*) AS n FROM stationary GROUP BY 1",
)
def corr_by_hour(t: Tables):
    changes = features.temporal(features.stationary(t.wide, STUDY))
    return tidied(stats.pearson(changes, "temperature", "emissionfactor", ["hour"]))


@query(
    "a20_corr_by_hour_having",
    with_views("wide")
    + """SELECT hour(ts) AS hour, tidy(corr(elec_price, emissionfactor)) AS corr, count(*) AS n FROM wide
    WHERE elec_price IS NOT NULL AND emissionfactor IS NOT NULL GROUP BY 1 HAVING count(*) > 24""",
)
def corr_having(t: Tables):
    return tidied(stats.pearson(features.temporal(t.wide), "elec_price", "emissionfactor", ["hour"], 24))


@query(
    "a21_corr_by_regime",
    with_views("wide")
    + f"""SELECT {JANUARY_FLAG} AS energy_crisis, tidy(corr(elec_price, gas_price)) AS corr, count(*) AS n FROM wide
    WHERE elec_price IS NOT NULL AND gas_price IS NOT NULL GROUP BY 1""",
)
def corr_by_regime(t: Tables):
    flagged = t.wide.withColumn("energy_crisis", numbers.regime_flag(F.col("ts"), JANUARY.start, JANUARY.end))
    return tidied(stats.pearson(flagged, "elec_price", "gas_price", ["energy_crisis"]))


@query(
    "a22_correlation_matrix",
    with_views("wide", more=CHANGES)
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, tidy(corr({a}, {b})) AS corr FROM stationary"
        for a in STUDY
        for b in STUDY
        if a != b
    )
    + "".join(f" UNION ALL SELECT '{a}', '{a}', CAST(1.0 AS DOUBLE)" for a in STUDY),
)
def correlation_matrix(t: Tables):
    return tidied(stats.correlation_matrix(features.stationary(t.wide, STUDY), STUDY))


@query(
    "a23_lagged_correlation",
    with_views(
        "wide",
        more=CHANGES
        + ", lagged AS (SELECT emissionfactor, "
        + ", ".join(f"lag(temperature, {k}) {BY_TIME} AS l{k}" for k in range(25))
        + " FROM stationary)",
    )
    + " UNION ALL ".join(
        f"SELECT '0' AS item_id, CAST({k} AS BIGINT) AS lag, tidy(corr(l{k}, emissionfactor)) AS corr FROM lagged" for k in range(25)
    ),
)
def lagged(t: Tables):
    changes = features.stationary(t.wide, STUDY)
    return tidied(stats.lagged_correlation(changes, "temperature", "emissionfactor", 24))


# Two daily series over several chunks, by the days that both have.
BOTH_DAILY = """shipped AS (SELECT date_trunc('day', l_shipdate) AS ts,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(28,10))) AS DOUBLE) / count(l_extendedprice) AS shipped FROM lineitem GROUP BY 1),
    both_daily AS (SELECT item_id, d.ts, price, shipped FROM daily d JOIN shipped s ON s.ts = d.ts)"""
DAILY_CHANGES = (
    BOTH_DAILY
    + f""", daily_changes AS (SELECT item_id, ts, price - lag(price) {BY_TIME} AS price, shipped - lag(shipped) {BY_TIME} AS shipped
    FROM both_daily), daily_stationary AS (SELECT * FROM daily_changes WHERE price IS NOT NULL AND shipped IS NOT NULL)"""
)


def both_daily(t: Tables):
    day = F.date_trunc("day", timeparts.as_utc(F.col("l_shipdate"))).alias("ts")
    shipped = t.read("lineitem").groupBy(day).agg(numbers.exact_mean(F.col("l_extendedprice")).alias("shipped"))
    return t.daily.select("item_id", "ts", "price").join(shipped, "ts")


@query(
    "t20_stationary_days",
    with_views("daily", more=DAILY_CHANGES)
    + "SELECT item_id, ts, tidy(price) AS price, tidy(shipped) AS shipped FROM daily_stationary",
)
def stationary_days(t: Tables):
    return tidied(features.stationary(both_daily(t), ["price", "shipped"]))


@query(
    "a23_lagged_correlation_of_days",
    with_views(
        "daily",
        more=DAILY_CHANGES
        + ", lagged AS (SELECT item_id, shipped, "
        + ", ".join(f"lag(price, {k}) {BY_TIME} AS l{k}" for k in range(25))
        + " FROM daily_stationary)",
    )
    + " UNION ALL ".join(
        f"SELECT item_id, CAST({k} AS BIGINT) AS lag, tidy(corr(l{k}, shipped)) AS corr FROM lagged GROUP BY 1" for k in range(25)
    ),
)
def lagged_days(t: Tables):
    changes = features.stationary(both_daily(t), ["price", "shipped"])
    return tidied(stats.lagged_correlation(changes, "price", "shipped", 24))


@query(
    "a24_two_sample_change",
    with_views("wide")
    + f""", w AS (SELECT emissionfactor AS v, {JANUARY_FLAG} AS f FROM wide)
    SELECT tidy(avg(v) FILTER (f = 0)) AS mean_before, tidy(avg(v) FILTER (f = 1)) AS mean_during,
    tidy(100 * (avg(v) FILTER (f = 1) - avg(v) FILTER (f = 0)) / avg(v) FILTER (f = 0)) AS pct_change FROM w""",
)
def two_sample(t: Tables):
    flagged = t.wide.withColumn("f", numbers.regime_flag(F.col("ts"), JANUARY.start, JANUARY.end))
    out = stats.welch_test(flagged, "emissionfactor", "f")
    return tidied(out.select("mean_before", "mean_during", "pct_change"))


@query(
    "a27_max_normalised",
    with_views("series")
    + "SELECT item_id, ts, tidy(y / max(y) OVER (PARTITION BY item_id)) AS y_norm FROM series",
)
def max_normalised(t: Tables):
    out = stats.max_normalised(t.series, ["y"])
    return tidied(out.select("item_id", "ts", "y_norm"))


@query(
    "a29_period_extents",
    """SELECT event_type AS type, CAST(user_id AS VARCHAR) AS region, year(ts) AS year, min(CAST(ts AS DATE)) AS start_date,
    max(CAST(ts AS DATE)) AS end_date FROM events GROUP BY 1, 2, 3""",
)
def period_extents(t: Tables):
    days = t.events.select(
        F.col("event_type").alias("type"),
        F.col("user_id").cast("string").alias("region"),
        F.year("ts").cast("bigint").alias("year"),
        F.to_date("ts").alias("date"),
    )
    return calendar.vacation_envelope(days)


@query(
    "a30_phase_extents",
    with_views("daily")
    + f"""SELECT {PHASE_SQL} AS crisis_phase, min(ts) AS first_ts, max(ts) AS last_ts,
    CASE {PHASE_SQL} WHEN 'pre_crisis' THEN 'Pre Crisis' WHEN 'early_crisis' THEN 'Early Crisis' WHEN 'acute_crisis'
      THEN 'Acute Crisis' WHEN 'peak_crisis' THEN 'Peak Crisis' ELSE 'Stabilization' END AS label FROM daily GROUP BY ALL""",
)
def phase_extents(t: Tables):
    phase = numbers.phase_label(F.col("ts"), "pre_crisis", DAILY_CUTS)
    return charts.phase_extents(t.daily.withColumn("crisis_phase", phase))


@query("o1_sorted_by_time", with_views("daily") + "SELECT ts, tidy3(price) AS price FROM daily ORDER BY ts")
def sorted_by_time(t: Tables):
    return t.daily.select("ts", tidy(F.col("price"), 3).alias("price")).orderBy("ts")


@query(
    "o2_multi_key_sort",
    """SELECT o_orderstatus AS type, o_orderpriority AS region, min(CAST(o_orderdate AS DATE)) AS start_date
    FROM orders GROUP BY 1, 2 ORDER BY 3, 1, 2""",
)
def multi_key_sort(t: Tables):
    return (
        t.read("orders")
        .groupBy(F.col("o_orderstatus").alias("type"), F.col("o_orderpriority").alias("region"))
        .agg(F.min(F.to_date("o_orderdate")).alias("start_date"))
        .orderBy("start_date", "type", "region")
    )


HOUR_CORR = """c AS (SELECT hour(ts) AS hour, corr(elec_price, emissionfactor) AS corr, count(*) AS n FROM wide
    WHERE elec_price IS NOT NULL AND emissionfactor IS NOT NULL GROUP BY 1 HAVING count(*) > 10)"""


@query(
    "o3_top_and_bottom_hours",
    with_views("wide", more=HOUR_CORR)
    + """SELECT 'top' AS side, hour, tidy(corr) AS corr, n FROM (SELECT * FROM c ORDER BY corr DESC, hour LIMIT 3)
    UNION ALL SELECT 'bottom', hour, tidy(corr), n FROM (SELECT * FROM c ORDER BY corr, hour LIMIT 3)""",
)
def top_and_bottom(t: Tables):
    by_hour = stats.pearson(features.temporal(t.wide), "elec_price", "emissionfactor", ["hour"], 10)
    top = by_hour.orderBy(F.desc("corr"), "hour").limit(3).withColumn("side", F.lit("top"))
    bottom = by_hour.orderBy("corr", "hour").limit(3).withColumn("side", F.lit("bottom"))
    return tidied(top.unionByName(bottom))


@query(
    "o4_strongest_hour",
    with_views("wide", more=HOUR_CORR)
    + "SELECT hour, tidy(corr) AS corr FROM c ORDER BY abs(corr) DESC, hour LIMIT 1",
)
def strongest_hour(t: Tables):
    by_hour = stats.pearson(features.temporal(t.wide), "elec_price", "emissionfactor", ["hour"], 10)
    return tidied(stats.strongest(by_hour, "hour"))


@query("o5_preview", "SELECT event_id, ts, event_type, value FROM events ORDER BY ts, event_id LIMIT 5")
def preview(t: Tables):
    return t.events.select("event_id", "ts", "event_type", "value").orderBy("ts", "event_id").limit(5)


@query(
    "p9_time_predicates",
    with_views("daily")
    + """SELECT ts, tidy3(price) AS price FROM daily WHERE ts >= DATE '1996-10-01' AND ts < DATE '1997-02-24'""",
)
def time_predicates(t: Tables):
    start, end = F.lit(date(1996, 10, 1)).cast("timestamp"), F.lit(date(1997, 2, 24)).cast("timestamp")
    return tidied(t.daily.filter((F.col("ts") >= start) & (F.col("ts") < end)).select("ts", "price"), 3)


@query(
    "p10_drop_incomplete",
    with_views("wide")
    + "SELECT ts, tidy(elec_price) AS elec_price, tidy(gas_price) AS gas_price FROM wide WHERE elec_price IS NOT NULL AND gas_price IS NOT NULL",
)
def drop_incomplete(t: Tables):
    return tidied(t.wide.dropna(subset=["elec_price", "gas_price"]).select("ts", "elec_price", "gas_price"))


@query(
    "p11_masked_means",
    """SELECT tidy(avg(value) FILTER (isodow(ts) < 6)) AS weekday_mean, tidy(avg(value) FILTER (isodow(ts) > 5)) AS weekend_mean,
    count(*) FILTER (isodow(ts) < 6) AS weekday_n FROM events""",
)
def masked_means(t: Tables):
    weekend = timeparts.calendar_parts(F.col("ts"))["is_weekend"] == 1
    return tidied(
        t.events.agg(
            F.avg(F.when(~weekend, F.col("value"))).alias("weekday_mean"),
            F.avg(F.when(weekend, F.col("value"))).alias("weekend_mean"),
            F.count_if(~weekend).alias("weekday_n"),
        )
    )
