"""Scalar functions over the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from chronogrid.functions import numbers, timeparts
from chronogrid.functions.numbers import tidy
from chronogrid.operators import charts
from chronogrid.plans.catalog.base import Tables, query, with_views
from chronogrid.sources import files

# Regime cut-offs on the years the order table spans.
DAILY_CUTS = [
    (date(1996, 10, 1), "early_crisis"),
    (date(1997, 2, 24), "acute_crisis"),
    (date(1997, 9, 1), "peak_crisis"),
    (date(1998, 1, 1), "stabilization"),
]
PHASE_SQL = """CASE WHEN ts >= DATE '1998-01-01' THEN 'stabilization' WHEN ts >= DATE '1997-09-01' THEN 'peak_crisis'
    WHEN ts >= DATE '1997-02-24' THEN 'acute_crisis' WHEN ts >= DATE '1996-10-01' THEN 'early_crisis'
    ELSE 'pre_crisis' END"""
PHASES = ["pre_crisis", *[name for _, name in DAILY_CUTS]]


@query(
    "x1_hour_weekday_month",
    """SELECT event_id, hour(ts) AS hour, isodow(ts) - 1 AS dayofweek, month(ts) AS month,
    CAST(isodow(ts) IN (6, 7) AS BIGINT) AS is_weekend FROM events""",
)
def basic_parts(t: Tables):
    parts = timeparts.calendar_parts(F.col("ts"))
    return t.events.select("event_id", *[parts[p].alias(p) for p in ("hour", "dayofweek", "month", "is_weekend")])


@query("x2_year_day", "SELECT o_orderkey, year(o_orderdate) AS year, day(o_orderdate) AS day FROM orders")
def year_day(t: Tables):
    parts = timeparts.calendar_parts(F.col("o_orderdate"))
    return t.read("orders").select("o_orderkey", parts["year"].alias("year"), parts["day"].alias("day"))


@query(
    "x3_year_parts",
    """SELECT o_orderkey, dayofyear(o_orderdate) AS day_of_year, weekofyear(o_orderdate) AS week_of_year,
    quarter(o_orderdate) AS quarter FROM orders""",
)
def year_parts(t: Tables):
    parts = timeparts.calendar_parts(F.col("o_orderdate"))
    return t.read("orders").select(
        "o_orderkey", *[parts[p].alias(p) for p in ("day_of_year", "week_of_year", "quarter")]
    )


CYCLE_SQL = {
    "day_of_year": "dayofyear(ts)",
    "week_of_year": "weekofyear(ts)",
    "hour": "hour(ts)",
    "dayofweek": "isodow(ts) - 1",
    "month": "month(ts)",
    "quarter": "quarter(ts)",
}


@query(
    "x4_cyclic_encoding",
    "SELECT event_id, "
    + ", ".join(
        f"tidy(sin(2 * pi() * ({CYCLE_SQL[p]}) / {n})) AS {p}_sin, tidy(cos(2 * pi() * ({CYCLE_SQL[p]}) / {n})) AS {p}_cos"
        for p, n in timeparts.CYCLE_PERIODS.items()
    )
    + " FROM events",
)
def cyclic_encoding(t: Tables):
    parts = timeparts.calendar_parts(F.col("ts"))
    columns = []
    for name, period in timeparts.CYCLE_PERIODS.items():
        sine, cosine = timeparts.cyclic(parts[name], period)
        columns += [tidy(sine).alias(f"{name}_sin"), tidy(cosine).alias(f"{name}_cos")]
    return t.events.select("event_id", *columns)


@query("x5_date_truncation", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def date_truncation(t: Tables):
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


TEXT_SQL = """CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%d-%m-%Y %H:%M')
    WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE '31-02-' || year(o_orderdate) || ' 10:00' END"""


@query(
    "x6_parse_several_formats",
    "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderdate END AS ts FROM orders",
)
def parse_formats(t: Tables):
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "dd-MM-yyyy HH:mm"))
        .when(F.col("o_orderstatus") == "O", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.concat(F.lit("31-02-"), F.year(day).cast("string"), F.lit(" 10:00")))
    )
    return t.read("orders").select("o_orderkey", timeparts.parse_timestamp(text).alias("ts"))


@query(
    "x7_format_timestamp",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS full_text, strftime(ts, '%Y%m%d') AS stamp,
    strftime(ts, '%Y-%m-%d_%H%M') AS run FROM events""",
)
def format_timestamp(t: Tables):
    return t.events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("full_text"),
        F.date_format("ts", "yyyyMMdd").alias("stamp"),
        F.date_format("ts", "yyyy-MM-dd_HHmm").alias("run"),
    )


@query(
    "x8_utc_to_local",
    with_views("ship")
    + """SELECT l_orderkey, l_linenumber, ts, timezone('Europe/Amsterdam', timezone('UTC', ts)) AS ts_local FROM ship""",
)
def utc_to_local(t: Tables):
    return t.ship.select("l_orderkey", "l_linenumber", "ts", timeparts.to_local(F.col("ts")).alias("ts_local"))


@query(
    "x8_local_to_utc",
    """WITH night AS (SELECT l_orderkey, l_linenumber, l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) AS ts FROM lineitem),
    late AS (SELECT *, timezone('UTC', timezone('Europe/Amsterdam', ts)) AS u FROM night)
    SELECT l_orderkey, l_linenumber, CASE WHEN timezone('Europe/Amsterdam', timezone('UTC', u - INTERVAL 1 HOUR)) = ts
      THEN u - INTERVAL 1 HOUR ELSE u END AS ts_utc FROM late""",
)
def local_to_utc(t: Tables):
    """Hours 1 to 7 of every day: the hour that the clock repeats is its first run, the
    one that it skips counts on from the hour before."""
    ts = timeparts.as_utc(F.col("l_shipdate")) + F.make_interval(hours=F.col("l_linenumber"))
    return t.read("lineitem").select("l_orderkey", "l_linenumber", timeparts.to_utc(ts).alias("ts_utc"))


@query(
    "x9_numeric_coercion",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events",
)
def numeric_coercion(t: Tables):
    text = F.concat(F.col("value").cast("string"), F.when(F.col("event_type") == "error", F.lit(" n/a")).otherwise(F.lit("")))
    return t.events.select("event_id", numbers.to_number(text).alias("value"))


@query(
    "x10_null_to_zero",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 0
    ELSE CAST(trunc(value) AS BIGINT) END AS flag FROM events""",
)
def null_to_zero(t: Tables):
    text = F.when(F.col("event_type") == "error", F.lit("bad")).when(
        F.col("event_type") != "view", F.col("value").cast("string")
    )
    return t.events.select("event_id", numbers.flag_or_zero(text).alias("flag"))


@query(
    "x11_ratio",
    "SELECT event_id, tidy(value / nullif(CAST(json_extract(props, '$.k') AS BIGINT) % 7, 0)) AS ratio FROM events",
)
def ratio(t: Tables):
    k = F.get_json_object("props", "$.k").cast("bigint") % 7
    return t.events.select("event_id", tidy(numbers.ratio(F.col("value"), k)).alias("ratio"))


@query(
    "x12_error_columns",
    """SELECT l_orderkey, l_linenumber, tidy3(l_quantity * 1000 - l_extendedprice) AS error,
    tidy3(abs(l_quantity * 1000 - l_extendedprice)) AS abs_error,
    tidy(100 * (l_quantity * 1000 - l_extendedprice) / nullif(l_extendedprice, 0)) AS pct_error FROM lineitem""",
)
def error_columns(t: Tables):
    made = numbers.error_columns(F.col("l_extendedprice"), F.col("l_quantity") * 1000)
    return t.read("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        tidy(made["error"], 3).alias("error"),
        tidy(made["abs_error"], 3).alias("abs_error"),
        tidy(made["pct_error"]).alias("pct_error"),
    )


@query(
    "x13_stacked_layers",
    with_views("wide")
    + """SELECT ts, tidy(gas_price / 1e6 * 1e3) AS layer_sea_wind, tidy((gas_price + humidity) / 1e6 * 1e3) AS layer_land_wind,
    tidy((gas_price + humidity + temperature) / 1e6 * 1e3) AS layer_sun, tidy(humidity + gas_price) AS total_wind FROM wide""",
)
def stacked_layers(t: Tables):
    volumes = t.wide.select(
        "ts",
        F.col("gas_price").alias("volume_sea_wind"),
        F.col("humidity").alias("volume_land_wind"),
        F.col("temperature").alias("volume_sun"),
    )
    out = charts.stacked_production(volumes)
    layers = [tidy(F.col(f"layer_{c}") * 1e3).alias(f"layer_{c}") for c in ("sea_wind", "land_wind", "sun")]
    total = tidy(F.col("volume_land_wind") + F.col("volume_sea_wind")).alias("total_wind")
    return out.select("ts", *layers, total)


@query("x18_phase_label", with_views("daily") + f"SELECT ts, {PHASE_SQL} AS crisis_phase FROM daily")
def phase_label(t: Tables):
    return t.daily.select("ts", numbers.phase_label(F.col("ts"), "pre_crisis", DAILY_CUTS).alias("crisis_phase"))


@query(
    "x19_regime_flag",
    with_views("daily")
    + """SELECT ts, CAST(ts >= DATE '1996-10-01' AND ts <= DATE '1998-06-30' AS BIGINT) AS closed,
    CAST(ts >= DATE '1996-10-01' AS BIGINT) AS open_ended FROM daily""",
)
def regime_flag(t: Tables):
    start = date(1996, 10, 1)
    return t.daily.select(
        "ts",
        numbers.regime_flag(F.col("ts"), start, date(1998, 6, 30)).alias("closed"),
        numbers.regime_flag(F.col("ts"), start).alias("open_ended"),
    )


@query(
    "x20_one_hot",
    with_views("daily")
    + f", p AS (SELECT ts, {PHASE_SQL} AS phase FROM daily) SELECT ts, "
    + ", ".join(f"CAST(phase = '{p}' AS BIGINT) AS phase_{p}" for p in PHASES)
    + " FROM p",
)
def one_hot(t: Tables):
    phase = numbers.phase_label(F.col("ts"), "pre_crisis", DAILY_CUTS)
    return t.daily.select("ts", *[c.alias(n) for n, c in numbers.one_hot(phase, PHASES, "phase").items()])


@query(
    "x22_date_in_file_name",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS stamp FROM orders",
)
def date_in_name(t: Tables):
    form = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "yyyyMMdd")
    )
    name = F.concat(F.lit("historical_combined_"), form, F.lit(".csv"))
    return t.read("orders").select("o_orderkey", files.name_date(name).alias("stamp"))


@query(
    "x23_vacation_name",
    "SELECT p_partkey, CASE WHEN p_size > 25 THEN lower(p_name) END AS vacation_type FROM part",
)
def vacation_name(t: Tables):
    text = F.when(F.col("p_size") > 25, F.concat(F.initcap("p_name"), F.lit(" Holiday"))).otherwise(F.col("p_name"))
    return t.read("part").select("p_partkey", numbers.vacation_name(text).alias("vacation_type"))


@query(
    "x24_set_membership",
    "SELECT event_id FROM events WHERE isodow(ts) IN (6, 7) AND event_type IN ('click', 'view')",
)
def set_membership(t: Tables):
    return t.events.filter(F.weekday("ts").isin(5, 6) & F.col("event_type").isin("click", "view")).select("event_id")


@query(
    "x25_title_label",
    """SELECT p_partkey, array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN string_split(p_name, ' ')], ' ') AS label
    FROM part""",
)
def title_label(t: Tables):
    return t.read("part").select("p_partkey", numbers.title_label(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("label"))


@query("x26_json_scalar", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_scalar(t: Tables):
    return t.events.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query(
    "x27_date_ordinal",
    "SELECT o_orderkey, date_diff('day', DATE '0001-01-01', CAST(o_orderdate AS DATE)) + 1 AS date_ordinal FROM orders",
)
def date_ordinal(t: Tables):
    return t.read("orders").select("o_orderkey", timeparts.date_ordinal(F.col("o_orderdate")).alias("date_ordinal"))


@query(
    "x28_abs_sqrt_square",
    """SELECT event_id, abs(value - 50) AS dist, tidy(sqrt(value)) AS root, tidy(value * value) AS square FROM events""",
)
def abs_sqrt_square(t: Tables):
    v = F.col("value")
    return t.events.select(
        "event_id", F.abs(v - 50).alias("dist"), tidy(F.sqrt(v)).alias("root"), tidy(v * v).alias("square")
    )


@query(
    "x29_time_arithmetic",
    """SELECT event_id, ts - INTERVAL 28 DAY AS runup_start, ts + INTERVAL 7 DAY AS horizon_end,
    ts - INTERVAL 168 HOUR AS week_ago FROM events""",
)
def time_arithmetic(t: Tables):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        (ts - timeparts.days(28)).alias("runup_start"),
        (ts + timeparts.days(7)).alias("horizon_end"),
        (ts - timeparts.hours(168)).alias("week_ago"),
    )


@query("x30_epoch", "SELECT event_id, epoch_us(ts) AS micros, epoch_us(ts) // 3600000000 AS hour_number FROM events")
def epoch(t: Tables):
    return t.events.select(
        "event_id", F.unix_micros("ts").alias("micros"), timeparts.epoch_hour(F.col("ts")).alias("hour_number")
    )
