"""Holidays, vacations and feature sets over the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from chronogrid.functions.numbers import tidy
from chronogrid.functions.timeparts import CYCLE_PERIODS, to_local
from chronogrid.operators import calendar, chunks, features, model
from chronogrid.plans.catalog.alignment import UPSAMPLED
from chronogrid.plans.catalog.base import Tables, query, with_views
from chronogrid.plans.catalog.ordered import BACK, BY_TIME, FORTH, _frame
from chronogrid.plans.catalog.scalars import CYCLE_SQL
from chronogrid.session import materialise

# Easter Sundays of the years in the tables, as an independent list.
EASTER_SQL = """easter AS (SELECT CAST(d AS DATE) AS d, year(CAST(d AS DATE)) AS year FROM (VALUES ('1995-04-16'), ('1996-04-07'),
    ('1997-03-30'), ('1998-04-12'), ('1999-04-04'), ('2000-04-23'), ('2001-04-15'), ('2024-03-31')) v(d))"""
HOLIDAY_SQL = (
    EASTER_SQL
    + """, all_holidays AS (
    SELECT d + CAST(shift AS INTEGER) AS date, name, year FROM easter, (VALUES (-2, 'Good Friday'), (0, 'Easter Sunday'),
      (1, 'Easter Monday'), (39, 'Ascension Thursday'), (49, 'Whit Sunday'), (50, 'Whit Monday')) e(shift, name)
    UNION ALL SELECT make_date(year, m, dd), name, year FROM easter, (VALUES (1, 1, 'New year'), (4, 27, 'King''s day'),
      (5, 5, 'Liberation Day'), (12, 25, 'Christmas Day'), (12, 26, 'Boxing Day')) f(m, dd, name))"""
)


@query(
    "t8_holiday_calendar",
    "WITH "
    + HOLIDAY_SQL
    + """ SELECT date, name, year FROM all_holidays
    WHERE year IN (SELECT DISTINCT year(o_orderdate) FROM orders)""",
)
def holiday_calendar(t: Tables):
    return calendar.holidays(calendar.years_of(t.daily))


@query(
    "t9_holiday_features",
    with_views("daily", more=HOLIDAY_SQL)
    + """SELECT ts, CAST(h.name IS NOT NULL AS BIGINT) AS is_holiday, coalesce(h.name, '') AS holiday_name
    FROM daily LEFT JOIN all_holidays h ON CAST(ts AS DATE) = h.date""",
)
def holiday_features(t: Tables):
    return calendar.add_holidays(t.daily).select("ts", "is_holiday", "holiday_name")


@query(
    "t9_holiday_table_join",
    with_views("ship", more=HOLIDAY_SQL)
    + """SELECT coalesce(h.name, '') AS holiday_name, CAST(h.name IS NOT NULL AS BIGINT) AS is_holiday, count(*) AS n
    FROM ship LEFT JOIN all_holidays h ON CAST(ts AS DATE) = h.date GROUP BY 1, 2""",
)
def holiday_table_join(t: Tables):
    table = calendar.holidays(calendar.years_of(t.ship)).select("date", "name")
    flagged = calendar.add_holidays(t.ship, table=table)
    return flagged.groupBy("holiday_name", "is_holiday").agg(F.count("*").alias("n"))


@query(
    "t10_working_days",
    with_views("ship", more=HOLIDAY_SQL)
    + """SELECT CAST(ts AS DATE) AS day, CAST(isodow(ts) < 6 AND h.name IS NULL AS BIGINT) AS is_working_day, count(*) AS n
    FROM ship LEFT JOIN all_holidays h ON CAST(ts AS DATE) = h.date GROUP BY 1, 2""",
)
def working_days(t: Tables):
    return (
        calendar.add_holidays(t.ship)
        .groupBy(F.to_date("ts").alias("day"), "is_working_day")
        .agg(F.count("*").alias("n"))
    )


@query(
    "j6_rows_on_holidays",
    with_views("ship", more=HOLIDAY_SQL)
    + "SELECT l_orderkey, l_linenumber, ts FROM ship WHERE CAST(ts AS DATE) IN (SELECT date FROM all_holidays)",
)
def rows_on_holidays(t: Tables):
    return calendar.on_holidays(t.ship, calendar.holidays(calendar.years_of(t.ship))).select("l_orderkey", "l_linenumber", "ts")


# Vacation periods by type and region as (month, day) bounds, applied to every year.
PERIODS = [
    ("spring", "south", (2, 18), (2, 26)),
    ("spring", "middle", (2, 25), (3, 5)),
    ("spring", "north", (2, 25), (3, 5)),
    ("may", "middle", (4, 29), (5, 7)),
    ("may", "north", (4, 29), (5, 7)),
    ("may", "south", (4, 29), (5, 7)),
    ("summer", "middle", (7, 8), (8, 20)),
    ("summer", "south", (7, 15), (8, 27)),
    ("summer", "north", (7, 22), (9, 3)),
    ("fall", "middle", (10, 14), (10, 22)),
    ("fall", "south", (10, 14), (10, 22)),
    ("fall", "north", (10, 21), (10, 29)),
    ("christmas", "north", (8, 25), (9, 10)),
]
PERIOD_SQL = (
    "periods AS (SELECT type, region, year, make_date(year, m1, d1) AS start_date, make_date(year, m2, d2) AS end_date "
    "FROM (SELECT DISTINCT year(ts) AS year FROM daily), (VALUES "
    + ", ".join(f"('{k}', '{r}', {a[0]}, {a[1]}, {b[0]}, {b[1]})" for k, r, a, b in PERIODS)
    + ") v(type, region, m1, d1, m2, d2))"
)


def yearly_periods(t: Tables):
    """The periods for every year of the order table."""
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("type"),
                F.lit(r).alias("region"),
                F.make_date(F.col("year"), F.lit(a[0]), F.lit(a[1])).alias("start_date"),
                F.make_date(F.col("year"), F.lit(b[0]), F.lit(b[1])).alias("end_date"),
            )
            for k, r, a, b in PERIODS
        ]
    )
    return calendar.years_of(t.daily).select("year", F.explode(rows).alias("p")).select("year", "p.*")


VACATION_RANK = "CASE type WHEN 'summer' THEN 1 WHEN 'christmas' THEN 2 WHEN 'spring' THEN 3 WHEN 'may' THEN 4 ELSE 5 END"


@query(
    "j7_vacation_range_join",
    with_views("daily", more=PERIOD_SQL)
    + f"""SELECT ts, arg_min(type, {VACATION_RANK}) AS vacation_type, count(*) > 0 AS in_period
    FROM daily JOIN periods ON CAST(ts AS DATE) BETWEEN start_date AND end_date GROUP BY ts""",
)
def vacation_range_join(t: Tables):
    flagged = calendar.add_vacations(t.daily, yearly_periods(t)).filter("is_school_vacation = 1")
    return flagged.select("ts", "vacation_type", F.lit(True).alias("in_period"))


@query(
    "t12_vacation_features",
    with_views("ship", "daily", more=PERIOD_SQL)
    + f""", d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM ship),
    hit AS (SELECT day, arg_min(type, {VACATION_RANK}) AS vacation_type, max(CAST(type = 'summer' AS BIGINT)) AS s
      FROM d JOIN periods ON day BETWEEN start_date AND end_date GROUP BY day)
    SELECT day, CAST(h.s IS NOT NULL AS BIGINT) AS is_school_vacation, coalesce(h.s, 0) AS is_summer_vacation,
    coalesce(h.vacation_type, 'none') AS vacation_type, count(*) AS n
    FROM (SELECT CAST(ts AS DATE) AS day FROM ship) LEFT JOIN hit h USING (day) GROUP BY ALL""",
)
def vacation_features(t: Tables):
    flags = ["is_school_vacation", "is_summer_vacation", "vacation_type"]
    return (
        calendar.add_vacations(t.ship, yearly_periods(t))
        .groupBy(F.to_date("ts").alias("day"), *flags)
        .agg(F.count("*").alias("n"))
    )


@query(
    "t11_vacation_envelope",
    """SELECT o_orderstatus AS type, o_orderpriority AS region, year(o_orderdate) AS year,
    min(CAST(o_orderdate AS DATE)) AS start_date, max(CAST(o_orderdate AS DATE)) AS end_date FROM orders GROUP BY 1, 2, 3""",
)
def vacation_envelope(t: Tables):
    days = t.read("orders").select(
        F.col("o_orderstatus").alias("type"),
        F.col("o_orderpriority").alias("region"),
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.to_date("o_orderdate").alias("date"),
    )
    return calendar.vacation_envelope(days)


@query(
    "a28_day_counts",
    with_views("ship", "daily", more=HOLIDAY_SQL + ", " + PERIOD_SQL)
    + """, d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM ship)
    SELECT count(*) AS total_days, count(*) FILTER (day IN (SELECT date FROM all_holidays)) AS is_holiday_days,
    count(*) FILTER (isodow(day) < 6 AND day NOT IN (SELECT date FROM all_holidays)) AS is_working_day_days,
    count(*) FILTER (EXISTS (SELECT 1 FROM periods p WHERE day BETWEEN p.start_date AND p.end_date)) AS is_school_vacation_days,
    count(*) FILTER (EXISTS (SELECT 1 FROM periods p WHERE p.type = 'summer' AND day BETWEEN p.start_date AND p.end_date))
      AS is_summer_vacation_days FROM d""",
)
def day_counts(t: Tables):
    flagged = calendar.add_vacations(calendar.add_holidays(t.ship), yearly_periods(t))
    return calendar.day_counts(
        flagged, ["is_holiday", "is_working_day", "is_school_vacation", "is_summer_vacation"]
    )


@query(
    "t13_temporal_features",
    with_views("series")
    + """SELECT item_id, ts, hour(ts) AS hour, isodow(ts) - 1 AS dayofweek, month(ts) AS month,
    CAST(isodow(ts) > 5 AS BIGINT) AS is_weekend FROM series""",
)
def temporal_features(t: Tables):
    return features.temporal(t.series.select("item_id", "ts"))


@query(
    "t14_seasonal_features",
    with_views("daily")
    + "SELECT ts, dayofyear(ts) AS day_of_year, weekofyear(ts) AS week_of_year, quarter(ts) AS quarter, "
    + ", ".join(
        f"tidy(sin(2 * pi() * ({CYCLE_SQL[p]}) / {n})) AS {p}_sin, tidy(cos(2 * pi() * ({CYCLE_SQL[p]}) / {n})) AS {p}_cos"
        for p, n in CYCLE_PERIODS.items()
    )
    + " FROM daily",
)
def seasonal_features(t: Tables):
    out = features.seasonal(t.daily.select("ts"))
    waves = [c for c in out.columns if c.endswith(("_sin", "_cos"))]
    return out.withColumns({c: tidy(F.col(c)) for c in waves})


def target_sql(y: str, name: str) -> str:
    """Target feature set as SQL columns."""
    columns = [f"tidy({y} - lag({y}) {BY_TIME}) AS {name}_diff"]
    columns += [f"tidy(lag({y}, {k}) {BY_TIME}) AS {name}_lag_{k}h" for k in features.TARGET_LAGS]
    columns += [f"tidy(avg({y}) {_frame(n)}) AS {name}_rolling_mean_{n}h" for n in features.TARGET_WINDOWS]
    return ", ".join(columns)


@query("t15_target_features", with_views("grid") + f"SELECT item_id, ts, {target_sql('y', 'y')} FROM grid")
def target_features(t: Tables):
    out = chunks.windowed(t.grid(168), 168, lambda w: features.target_columns("y", w), means={"y": features.TARGET_WINDOWS})
    made = [c for c in out.columns if c not in ("item_id", "ts", "y")]
    return out.select("item_id", "ts", *[tidy(F.col(c)).alias(c) for c in made])


# January cut-offs, so that every phase occurs in the event table.
JANUARY = features.Regime(
    start=date(2024, 1, 8),
    end=date(2024, 1, 26),
    cuts=[
        (date(2024, 1, 8), "early_crisis"),
        (date(2024, 1, 13), "acute_crisis"),
        (date(2024, 1, 18), "peak_crisis"),
        (date(2024, 1, 23), "stabilization"),
    ],
)
JANUARY_PHASE = """CASE WHEN ts >= DATE '2024-01-23' THEN 'stabilization' WHEN ts >= DATE '2024-01-18' THEN 'peak_crisis'
    WHEN ts >= DATE '2024-01-13' THEN 'acute_crisis' WHEN ts >= DATE '2024-01-08' THEN 'early_crisis' ELSE 'pre_crisis' END"""
JANUARY_FLAG = "CAST(ts >= DATE '2024-01-08' AND ts <= DATE '2024-01-26' AS BIGINT)"
MERGED = f"""raw_prices AS (SELECT '0' AS item_id, ts, w.elec_price, h.gas_price
      FROM (SELECT ts, elec_price FROM wide) w FULL JOIN hourly_gas h USING (ts)),
    prices AS (SELECT item_id, ts,
      coalesce(elec_price, last_value(elec_price IGNORE NULLS) {FORTH}, first_value(elec_price IGNORE NULLS) {BACK}) AS elec_price,
      coalesce(gas_price, last_value(gas_price IGNORE NULLS) {FORTH}, first_value(gas_price IGNORE NULLS) {BACK}) AS gas_price
      FROM raw_prices)"""


def price_sql() -> list[tuple[str, str]]:
    """Price feature set as (name, SQL expression)."""
    out = [(f"elec_price_lag_{k}h", f"lag(elec_price, {k}) {BY_TIME}") for k in features.ELECTRICITY_LAGS]
    for n in features.ELECTRICITY_WINDOWS:
        out.append((f"elec_price_roll_mean_{n}h", f"avg(elec_price) {_frame(n)}"))
        out.append((f"elec_price_roll_std_{n}h", f"stddev_samp(elec_price) {_frame(n)}"))
    out += [(f"gas_price_lag_{k}h", f"lag(gas_price, {k}) {BY_TIME}") for k in features.GAS_LAGS]
    out += [(f"gas_price_roll_mean_{n}h", f"avg(gas_price) {_frame(n)}") for n in features.GAS_WINDOWS]
    out.append(("gas_to_elec_ratio", "gas_price / nullif(elec_price, 0)"))
    out.append(("elec_price_diff_1d", f"elec_price - lag(elec_price, 24) {BY_TIME}"))
    out.append(("elec_price_diff_1w", f"elec_price - lag(elec_price, 168) {BY_TIME}"))
    return out


PRICE_SQL = price_sql()
PHASE_FLAGS = ", ".join(f"CAST({JANUARY_PHASE} = '{p}' AS BIGINT) AS phase_{p}" for p in JANUARY.phases)


@query(
    "t18_price_features",
    with_views("wide", "gas_daily", more=UPSAMPLED + ", " + MERGED)
    + "SELECT item_id, ts, tidy(elec_price) AS elec_price, tidy(gas_price) AS gas_price, "
    + ", ".join(f"tidy({e}) AS {n}" for n, e in PRICE_SQL)
    + f", {JANUARY_FLAG} AS energy_crisis, {JANUARY_PHASE} AS crisis_phase, {PHASE_FLAGS} FROM prices",
)
def price_features(t: Tables):
    out = features.prepare_prices(t.wide, t.gas_daily, JANUARY)
    doubles = [c for c, kind in out.dtypes if kind == "double"]
    return out.withColumns({c: tidy(F.col(c)) for c in doubles})


@query(
    "t18_price_features_filled",
    with_views("wide", "gas_daily", more=UPSAMPLED + ", " + MERGED)
    + ", made AS (SELECT item_id, ts, "
    + ", ".join(f"{e} AS {n}" for n, e in PRICE_SQL)
    + " FROM prices) SELECT item_id, ts, "
    + ", ".join(
        f"tidy(coalesce({n}, last_value({n} IGNORE NULLS) {FORTH}, first_value({n} IGNORE NULLS) {BACK})) AS {n}"
        for n, _ in PRICE_SQL
    )
    + " FROM made",
)
def price_features_filled(t: Tables):
    out = features.prepare_prices(t.wide, t.gas_daily, JANUARY, leak_safe=False)
    return out.select("item_id", "ts", *[tidy(F.col(n)).alias(n) for n, _ in PRICE_SQL])


@query(
    "t19_rolling_price_analysis",
    with_views("wide", "gas_daily", more=UPSAMPLED + ", " + MERGED)
    + "SELECT item_id, ts, "
    + ", ".join(
        f"CASE WHEN count({c}_price) {_frame(n)} = {n} THEN tidy({f}({c}_price) {_frame(n)}) END AS {c}_price_{d}d_{s}"
        for c, n, d, f, s in (
            ("elec", 168, 7, "avg", "mean"),
            ("elec", 168, 7, "stddev_samp", "std"),
            ("elec", 720, 30, "avg", "mean"),
            ("gas", 168, 7, "avg", "mean"),
            ("gas", 720, 30, "avg", "mean"),
        )
    )
    + ", tidy(gas_price / nullif(elec_price, 0)) AS gas_to_elec_ratio FROM prices",
)
def rolling_price_analysis(t: Tables):
    out = features.rolling_price_analysis(features.merge_prices(t.wide, t.gas_daily))
    made = [c for c in out.columns if c not in ("item_id", "ts", "elec_price", "gas_price")]
    return out.select("item_id", "ts", *[tidy(F.col(c)).alias(c) for c in made])


STUDY = ["temperature", "emissionfactor", "humidity"]
CHANGES = (
    "changes AS (SELECT item_id, ts, "
    + ", ".join(f"{c} - lag({c}) {BY_TIME} AS {c}" for c in STUDY)
    + " FROM wide), stationary AS (SELECT * FROM changes WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in STUDY)
    + ")"
)


@query(
    "t20_stationary",
    with_views("wide", more=CHANGES)
    + "SELECT item_id, ts, "
    + ", ".join(f"tidy({c}) AS {c}" for c in STUDY)
    + " FROM stationary",
)
def stationary(t: Tables):
    out = features.stationary(t.wide, STUDY)
    return out.select("item_id", "ts", *[tidy(F.col(c)).alias(c) for c in STUDY])


# All weather variables as multiples of one measured column.
WEATHER_NAMES = ["temperature", *features.WEATHER_VARIABLES]


def _weather_sql() -> str:
    base = "SELECT ts, " + ", ".join(f"temperature * {i + 1} AS {n}" for i, n in enumerate(WEATHER_NAMES)) + " FROM wide"
    columns = [f"tidy({n}) AS {n}" for n in WEATHER_NAMES]
    for n in WEATHER_NAMES:
        if n == "is_day":
            continue
        columns += [f"tidy({n} - lag({n}, {k}) {BY_TIME}) AS {n}_change_{k}h" for k in (1, 24)]
        if n == "temperature":
            columns += [f"tidy(lag({n}, {k}) {BY_TIME}) AS {n}_lag_{k}h" for k in features.TEMPERATURE_LAGS]
        columns += [f"tidy(avg({n}) {_frame(k)}) AS {n}_rolling_mean_{k}h" for k in features.WEATHER_WINDOWS]
    return (
        with_views("grid", "wide", more=f"weather AS ({base}), joined AS (SELECT g.item_id, g.ts, w.* EXCLUDE (ts) FROM grid g LEFT JOIN weather w ON w.ts = g.ts)")
        + "SELECT item_id, ts, " + ", ".join(columns) + " FROM joined"
    )


@query("t17_weather_features", _weather_sql())
def weather_features(t: Tables):
    weather = t.wide.select("ts", *[(F.col("temperature") * (i + 1)).alias(n) for i, n in enumerate(WEATHER_NAMES)])
    use = features.FeatureInputs(target="y", weather=weather)
    out = features.add_features(t.grid().select("item_id", "ts"), use, {"weather"})
    return out.select("item_id", "ts", *[tidy(F.col(c)).alias(c) for c in out.columns if c not in ("item_id", "ts")])


@query(
    "t16_price_join",
    with_views("series", "grid", "wide", "gas_daily", more=UPSAMPLED + ", " + MERGED)
    + ", made AS (SELECT ts, elec_price, gas_price, "
    + ", ".join(f"{e} AS {n}" for n, e in PRICE_SQL if n in features.PRICE_COLUMNS)
    + f", {JANUARY_FLAG} AS energy_crisis, {PHASE_FLAGS} FROM prices)"
    + """, made2 AS (SELECT * FROM made WHERE hour(ts) <> 5), joined AS (SELECT g.item_id, g.ts, m.* EXCLUDE (ts) FROM grid g LEFT JOIN made2 m ON m.ts = g.ts)
    SELECT item_id, ts, """
    + ", ".join(
        (f"tidy(coalesce({n}, last_value({n} IGNORE NULLS) {FORTH}, first_value({n} IGNORE NULLS) {BACK})) AS {n}")
        if not n.startswith(("phase_", "energy"))
        else f"coalesce({n}, last_value({n} IGNORE NULLS) {FORTH}, first_value({n} IGNORE NULLS) {BACK}) AS {n}"
        for n in features.PRICE_COLUMNS
    )
    + " FROM joined",
)
def price_join(t: Tables):
    stored = materialise(features.prepare_prices(t.wide, t.gas_daily, JANUARY), "price-table")
    prepared = stored.drop("item_id").filter(F.hour("ts") != 5)
    use = features.FeatureInputs(target="y", prices=prepared)
    out = features.add_features(t.grid().select("item_id", "ts"), use, {"price"})
    doubles = [c for c, kind in out.dtypes if kind == "double"]
    return out.withColumns({c: tidy(F.col(c)) for c in doubles})


@query(
    "p3_feature_registry",
    with_views("grid", more=HOLIDAY_SQL)
    + f"""SELECT item_id, ts, hour(ts) AS hour, isodow(ts) - 1 AS dayofweek, month(ts) AS month,
    CAST(isodow(ts) > 5 AS BIGINT) AS is_weekend, CAST(h.name IS NOT NULL AS BIGINT) AS is_holiday,
    coalesce(h.name, '') AS holiday_name, CAST(isodow(ts) < 6 AND h.name IS NULL AS BIGINT) AS is_working_day,
    {target_sql('y', 'y')} FROM grid LEFT JOIN all_holidays h ON CAST(ts AS DATE) = h.date""",
)
def feature_registry(t: Tables):
    out = features.add_features(t.grid(), features.FeatureInputs(target="y"), {"temporal", "holiday", "emission"})
    made = [c for c in out.columns if c.startswith("y_")]
    return out.withColumns({c: tidy(F.col(c)) for c in made}).drop("y")


# Vacations in the month of the event table: (type, first day, last day).
JANUARY_VACATIONS = [("christmas", "2024-01-01", "2024-01-07"), ("spring", "2024-01-20", "2024-01-24"), ("summer", "2024-01-23", "2024-01-25")]


def january_vacations(t: Tables):
    rows = [
        F.struct(F.lit(2024).cast("bigint").alias("year"), F.lit(k).alias("type"), F.lit("all").alias("region"),
                 F.lit(a).cast("date").alias("start_date"), F.lit(b).cast("date").alias("end_date"))
        for k, a, b in JANUARY_VACATIONS
    ]
    return t.spark.range(1).select(F.inline(F.array(*rows)))


def all_weather(t: Tables):
    return t.wide.select("ts", *[(F.col("temperature") * (i + 1)).alias(n) for i, n in enumerate(WEATHER_NAMES)])


VOLUMES = {"volume_sun": 1, "volume_land_wind": 2, "volume_sea_wind": 3}
ALL_SETS = (
    with_views(
        "series", "grid", "wide", "gas_daily",
        more=UPSAMPLED + ", " + MERGED + ", " + HOLIDAY_SQL
        + ", made AS (SELECT ts, elec_price, gas_price, "
        + ", ".join(f"{e} AS {n}" for n, e in PRICE_SQL if n in features.PRICE_COLUMNS)
        + f", {JANUARY_FLAG} AS energy_crisis, {PHASE_FLAGS} FROM prices), "
        + "joined_p AS (SELECT g.item_id, g.ts, m.* EXCLUDE (ts) FROM grid g LEFT JOIN made m ON m.ts = g.ts), priced AS (SELECT item_id, ts, "
        + ", ".join(
            ("tidy({0})" if not n.startswith(("phase_", "energy")) else "{0}").format(
                f"CASE WHEN bool_or(elec_price IS NULL) OVER (PARTITION BY item_id) "
                f"THEN coalesce({n}, last_value({n} IGNORE NULLS) {FORTH}, first_value({n} IGNORE NULLS) {BACK}) ELSE {n} END"
            ) + f" AS {n}"
            for n in features.PRICE_COLUMNS
        )
        + " FROM joined_p), weather AS (SELECT ts, "
        + ", ".join(f"temperature * {i + 1} AS {n}" for i, n in enumerate(WEATHER_NAMES))
        + " FROM wide), joined AS (SELECT g.item_id, g.ts, w.* EXCLUDE (ts) FROM grid g LEFT JOIN weather w ON w.ts = g.ts), "
        + "weathered AS (SELECT item_id, ts, " + _weather_sql().rpartition("SELECT item_id, ts, ")[2]
        + "), vac(type, a, b) AS (VALUES "
        + ", ".join(f"('{k}', DATE '{a}', DATE '{b}')" for k, a, b in JANUARY_VACATIONS)
        + f"""), hit AS (SELECT day, arg_min(type, {VACATION_RANK}) AS vacation_type, max(CAST(type = 'summer' AS BIGINT)) AS s
          FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM grid) JOIN vac ON day BETWEEN a AND b GROUP BY day),
        core AS (SELECT item_id, ts, y, """
        + ", ".join(f"tidy(y * {k}) AS {n}" for n, k in VOLUMES.items())
        + """, hour(ts) AS hour, isodow(ts) - 1 AS dayofweek, month(ts) AS month, CAST(isodow(ts) > 5 AS BIGINT) AS is_weekend,
          CAST(h.name IS NOT NULL AS BIGINT) AS is_holiday, coalesce(h.name, '') AS holiday_name,
          CAST(isodow(ts) < 6 AND h.name IS NULL AS BIGINT) AS is_working_day, CAST(v.s IS NOT NULL AS BIGINT) AS is_school_vacation,
          coalesce(v.s, 0) AS is_summer_vacation, coalesce(v.vacation_type, 'none') AS vacation_type,
          dayofyear(ts) AS day_of_year, weekofyear(ts) AS week_of_year, quarter(ts) AS quarter, """
        + ", ".join(f"tidy({f}(2 * pi() * ({CYCLE_SQL[p]}) / {n})) AS {p}_{f}" for p, n in CYCLE_PERIODS.items() for f in ("sin", "cos"))
        + f", {target_sql('y', 'y')} FROM grid LEFT JOIN all_holidays h ON CAST(ts AS DATE) = h.date LEFT JOIN hit v ON v.day = CAST(ts AS DATE))",
    )
)


@query(
    "p3_all_feature_sets",
    ALL_SETS + f"SELECT * EXCLUDE (y, {', '.join(VOLUMES)}) FROM core JOIN priced USING (item_id, ts) JOIN weathered USING (item_id, ts)",
)
def all_feature_sets(t: Tables):
    prices = materialise(features.prepare_prices(t.wide, t.gas_daily, JANUARY), "price-table").drop("item_id")
    use = features.FeatureInputs(target="y", vacations=january_vacations(t), prices=prices, weather=all_weather(t))
    out = features.add_features(t.grid(), use, "all").drop("y")
    return out.withColumns({c: tidy(F.col(c)) for c, kind in out.dtypes if kind in ("double", "float")})


def known_table(t: Tables):
    """The series with three volumes, and the sets that the known covariates come from."""
    rows = t.grid().select("item_id", "ts", *[(F.col("y") * k).alias(n) for n, k in VOLUMES.items()])
    use = features.FeatureInputs(target="emissionfactor", vacations=january_vacations(t), weather=all_weather(t))
    return features.add_features(rows, use, {"temporal", "holiday", "vacation", "seasonal", "weather"})


@query(
    "p5_all_known_covariates",
    ALL_SETS + f"SELECT item_id, ts, {', '.join(model.KNOWN_COVARIATES)} FROM core JOIN weathered USING (item_id, ts)",
)
def all_known_covariates(t: Tables):
    out = model.Roles().covariates(known_table(t))
    return out.withColumns({c: tidy(F.col(c)) for c, kind in out.dtypes if kind in ("double", "float")})


@query(
    "p4_seasonal_without_temporal",
    with_views("series")
    + "SELECT item_id, ts, dayofyear(ts) AS day_of_year, weekofyear(ts) AS week_of_year, quarter(ts) AS quarter, "
    + ", ".join(
        f"tidy({f}(2 * pi() * ({CYCLE_SQL[p]}) / {n})) AS {p}_{f}" for p, n in CYCLE_PERIODS.items() for f in ("sin", "cos")
    )
    + " FROM series",
)
def seasonal_only(t: Tables):
    out = features.add_features(t.series.select("item_id", "ts"), features.FeatureInputs(), {"seasonal"})
    return out.select(*[tidy(F.col(c)).alias(c) if c.endswith(("_sin", "_cos")) else F.col(c) for c in out.columns])


@query(
    "p5_known_covariates",
    with_views("grid")
    + """SELECT item_id, ts, hour(ts) AS hour, isodow(ts) - 1 AS dayofweek, month(ts) AS month,
    CAST(isodow(ts) > 5 AS BIGINT) AS is_weekend FROM grid""",
)
def known_covariates(t: Tables):
    roles = model.Roles(target="emissionfactor", known=list(features.TEMPORAL))
    return roles.covariates(features.temporal(t.grid()))


@query(
    "p13_constant_series",
    with_views("daily") + "SELECT item_id, ts, tidy3(price) AS price FROM daily",
)
def constant_series(t: Tables):
    raw = t.daily.select(F.col("ts").alias("date"), tidy(F.col("price"), 3).alias("price"))
    return model.to_panel(raw)


@query(
    "x8_local_hour_profile",
    with_views("ship")
    + """SELECT hour(timezone('Europe/Amsterdam', timezone('UTC', ts))) AS hour, count(*) AS n,
    tidy(avg(l_quantity)) AS mean_quantity FROM ship GROUP BY 1""",
)
def local_hour_profile(t: Tables):
    return t.ship.groupBy(F.hour(to_local(F.col("ts"))).cast("bigint").alias("hour")).agg(
        F.count("*").alias("n"), tidy(F.avg("l_quantity")).alias("mean_quantity")
    )
