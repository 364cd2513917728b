"""Joins, set operations, spines, upsampling and gap imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronogrid.functions import schema
from chronogrid.functions.numbers import tidy
from chronogrid.functions.timeparts import as_utc
from chronogrid.operators import align, asof, evaluate, features, grid, impute, model, ordered
from chronogrid.plans.catalog.base import Tables, query, with_views
from chronogrid.plans.catalog.ordered import BACK, FORTH
from chronogrid.sources import weather

SOURCES = {"purchase": "volume_mix", "click": "volume_sun", "view": "volume_land_wind", "error": "volume_sea_wind"}


def _sources(t: Tables):
    return [t.series.filter(F.col("item_id") == k).select("ts", F.col("y").alias(v)) for k, v in SOURCES.items()]


@query(
    "j1_full_outer_by_time",
    with_views("series")
    + "SELECT ts, "
    + ", ".join(f"tidy({v}) AS {v}" for v in SOURCES.values())
    + " FROM "
    + " FULL JOIN ".join(
        f"(SELECT ts, y AS {v} FROM series WHERE item_id = '{k}') {v}_t" + (" USING (ts)" if i else "")
        for i, (k, v) in enumerate(SOURCES.items())
    ),
)
def full_outer(t: Tables):
    out = align.outer_align(_sources(t), ["ts"])
    return out.select("ts", *[tidy(F.col(v)).alias(v) for v in SOURCES.values()])


@query(
    "j2_inner_by_time",
    with_views("series")
    + """SELECT ts, tidy(a.y) AS elec_price, tidy(b.y) AS emissionfactor FROM series a JOIN series b USING (ts)
    WHERE a.item_id = 'purchase' AND b.item_id = 'signup'""",
)
def inner(t: Tables):
    price = t.series.filter("item_id = 'purchase'").select("ts", tidy(F.col("y")).alias("elec_price"))
    factor = t.series.filter("item_id = 'signup'").select("ts", tidy(F.col("y")).alias("emissionfactor"))
    return price.join(factor, "ts")


@query(
    "j3_left_one_to_one",
    with_views("grid") + "SELECT item_id, ts, s.n FROM grid LEFT JOIN series s USING (item_id, ts)",
)
def left_one_to_one(t: Tables):
    return align.left_join_one_to_one(
        t.grid().select("item_id", "ts"), t.series.select("item_id", "ts", "n"), ["item_id", "ts"]
    )


@query(
    "j4_wide_left_join",
    with_views("grid", "wide")
    + """SELECT g.item_id, g.ts, tidy(g.y) AS y, tidy(temperature) AS temperature, tidy(humidity) AS humidity,
    tidy(elec_price) AS elec_price FROM grid g LEFT JOIN wide w ON w.ts = g.ts""",
)
def wide_left_join(t: Tables):
    names = ["temperature", "humidity", "elec_price"]
    out = t.grid().join(align.assert_unique(t.wide.select("ts", *names), ["ts"]), "ts", "left")
    return out.select("item_id", "ts", *[tidy(F.col(c)).alias(c) for c in ["y", *names]])


UPSAMPLED = """hourly_gas AS (SELECT h.ts, g.gas_price FROM
    (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM gas_daily) h
    ASOF JOIN gas_daily g ON h.ts >= g.ts)"""


@query(
    "j5_hourly_with_upsampled_daily",
    with_views("wide", "gas_daily", more=UPSAMPLED)
    + """SELECT ts, tidy(w.elec_price) AS elec_price, tidy(h.gas_price) AS gas_price
    FROM (SELECT ts, elec_price FROM wide) w FULL JOIN hourly_gas h USING (ts)""",
)
def hourly_with_daily(t: Tables):
    gas = grid.hourly_from_daily(t.gas_daily, ["gas_price"])
    out = align.outer_align([t.wide.select("ts", "elec_price"), gas.select("ts", "gas_price")], ["ts"])
    return out.select("ts", *[tidy(F.col(c)).alias(c) for c in ("elec_price", "gas_price")])


@query(
    "j8_join_forecast_to_prediction",
    with_views("wide", "grid")
    + """SELECT g.item_id, g.ts, tidy(g.y) AS prediction, tidy(w.temperature) AS volume_sun
    FROM grid g JOIN wide w ON w.ts = g.ts WHERE g.item_id = 'signup'""",
)
def forecast_to_prediction(t: Tables):
    prediction = t.grid().filter("item_id = 'signup'").withColumnRenamed("y", "prediction")
    forecast = t.wide.select("ts", tidy(F.col("temperature")).alias("volume_sun"))
    return prediction.join(forecast, "ts").withColumn("prediction", tidy(F.col("prediction")))


ERROR_COLUMNS = ["actual", "predicted", "error", "abs_error", "pct_error", "actual_diff"]


@query(
    "j9_error_table",
    with_views("err")
    + "SELECT item_id, ts, hour, dayofweek, is_weekend, "
    + ", ".join(f"tidy({c}) AS {c}" for c in [*ERROR_COLUMNS, "temperature", "humidity"])
    + " FROM err",
)
def error_table(t: Tables):
    series = t.grid()
    forecast = model.shifted_forecast(series, "y", 168)
    errors = evaluate.error_table(series, forecast, "y")
    return errors.join(t.wide.select("ts", "temperature", "humidity"), "ts", "left").select(
        "item_id", "ts", "hour", "dayofweek", "is_weekend",
        *[tidy(F.col(c)).alias(c) for c in [*ERROR_COLUMNS, "temperature", "humidity"]],
    )


@query(
    "j10_label_alignment",
    with_views("err")
    + """, h AS (SELECT hour AS label, avg(error) AS m, sqrt(avg(error * error)) AS r FROM err GROUP BY 1),
    d AS (SELECT dayofweek AS label, avg(error) AS m, sqrt(avg(error * error)) AS r FROM err GROUP BY 1),
    e AS (SELECT is_weekend AS label, avg(error) AS m, sqrt(avg(error * error)) AS r FROM err GROUP BY 1)
    SELECT label, tidy(h.m) AS hour_mean, tidy(h.r) AS hour_rms, tidy(d.m) AS dayofweek_mean,
    tidy(d.r) AS dayofweek_rms, tidy(e.m) AS is_weekend_mean, tidy(e.r) AS is_weekend_rms
    FROM h FULL JOIN d USING (label) FULL JOIN e USING (label)""",
)
def label_alignment(t: Tables):
    dims = ["hour", "dayofweek", "is_weekend"]
    out = align.label_alignment(align.labelled_metrics(t.errors(False), dims, "error"), dims)
    return out.select("label", *[tidy(F.col(c)).alias(c) for c in out.columns if c != "label"])


@query(
    "j11_missing_hours",
    with_views("spine") + "SELECT item_id, ts FROM spine ANTI JOIN series USING (item_id, ts)",
)
def missing_hours(t: Tables):
    return grid.missing_hours(t.series)


@query(
    "j12_as_of_daily",
    with_views("ship", "daily")
    + """SELECT s.l_orderkey, s.l_linenumber, s.ts, tidy3(d.price) AS price
    FROM ship s ASOF LEFT JOIN daily d ON s.ts >= d.ts""",
)
def as_of_daily(t: Tables):
    out = align.carry_daily(t.ship, t.daily, ["price"])
    return out.select("l_orderkey", "l_linenumber", "ts", tidy(F.col("price"), 3).alias("price"))


@query(
    "j12_as_of_by_customer",
    """WITH prices AS (SELECT o_custkey, o_orderdate, max(o_totalprice) AS o_totalprice FROM orders GROUP BY 1, 2),
    found AS (SELECT e.event_id, e.user_id, e.ts, o.o_orderdate, o.o_totalprice
      FROM events e ASOF LEFT JOIN prices o ON e.user_id = o.o_custkey AND e.ts >= o.o_orderdate)
    SELECT event_id, user_id, ts, o_orderdate, o_totalprice FROM found""",
)
def as_of_by_customer(t: Tables):
    """Each event with its customer's latest order."""
    orders = t.read("orders").select("o_custkey", as_utc(F.col("o_orderdate")).alias("o_orderdate"), "o_totalprice")
    rows = t.events.select("event_id", "user_id", "ts")
    orders = orders.withColumnRenamed("o_custkey", "user_id")
    return asof.asof_join(rows, orders, ["user_id"], "ts", "o_orderdate", ["o_totalprice"])


@query(
    "j12_as_of_within_days",
    """WITH prices AS (SELECT o_custkey, o_orderdate, max(o_totalprice) AS o_totalprice FROM orders GROUP BY 1, 2),
    found AS (SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_shipdate, o.o_orderdate, o.o_totalprice
      FROM lineitem l ASOF LEFT JOIN prices o ON l.l_suppkey = o.o_custkey AND l.l_shipdate > o.o_orderdate)
    SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate,
      CASE WHEN o_orderdate >= l_shipdate - INTERVAL 90 DAY THEN o_orderdate END AS o_orderdate,
      CASE WHEN o_orderdate >= l_shipdate - INTERVAL 90 DAY THEN o_totalprice END AS o_totalprice FROM found""",
)
def as_of_within_days(t: Tables):
    """Each shipment with the latest order before it, under the same number, of 90 days at most."""
    orders = t.read("orders").select(F.col("o_custkey").alias("l_suppkey"), as_utc(F.col("o_orderdate")).alias("o_orderdate"), "o_totalprice")
    rows = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", as_utc(F.col("l_shipdate")).alias("l_shipdate"))
    return asof.asof_join(rows, orders, ["l_suppkey"], "l_shipdate", "o_orderdate", ["o_totalprice"], 90 * 86400, exact=False)


@query(
    "u1_union_all",
    """SELECT 'events' AS source, ts, value FROM events
    UNION ALL SELECT 'orders', o_orderdate, o_totalprice FROM orders""",
)
def union_all(t: Tables):
    orders = t.read("orders").select(
        F.lit("orders").alias("source"), F.col("o_orderdate").cast("timestamp").alias("ts"), F.col("o_totalprice").alias("value")
    )
    return t.events.select(F.lit("events").alias("source"), "ts", "value").unionByName(orders)


@query(
    "u3_except_timestamps",
    with_views("series", more="hours AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM series)")
    + "SELECT ts FROM hours EXCEPT SELECT ts FROM series WHERE item_id = 'view'",
)
def except_timestamps(t: Tables):
    every = t.events.select(F.lit(0).alias("item_id"), "ts")
    hours = grid.spine(grid.bounds(every)).select("ts")
    return hours.exceptAll(t.series.filter("item_id = 'view'").select("ts"))


@query(
    "u5_columnwise_concat",
    with_views("daily")
    + """SELECT ts, tidy3(price) AS price, month(ts) AS month, year(ts) AS year,
    CAST(price > 250000 AS BIGINT) AS is_high FROM daily""",
)
def columnwise_concat(t: Tables):
    parts = {
        "month": F.month("ts").cast("bigint"),
        "year": F.year("ts").cast("bigint"),
        "is_high": (F.col("price") > 250000).cast("bigint"),
    }
    return t.daily.withColumns(parts).select("ts", tidy(F.col("price"), 3).alias("price"), *parts)


@query("t1_hourly_grid", with_views("grid") + "SELECT item_id, ts, tidy(y) AS y FROM grid")
def hourly_grid(t: Tables):
    return t.grid().select("item_id", "ts", tidy(F.col("y")).alias("y"))


@query(
    "t2_missing_report",
    with_views("spine")
    + """SELECT item_id, count(*) AS n_missing, min(ts) AS first_missing, max(ts) AS last_missing
    FROM spine ANTI JOIN series USING (item_id, ts) GROUP BY 1""",
)
def missing_report(t: Tables):
    return grid.missing_report(t.series)


def impute_sql(source: str, column: str, tail: str, keep: str = "item_id, ts") -> str:
    """Two-pass limited interpolation as CTEs `n_`, `l_` and `f_{column}`."""
    point = f"CASE WHEN {column} IS NOT NULL THEN ts END"
    return f"""n_{column} AS (SELECT {keep}, {column}, last_value({point} IGNORE NULLS) {FORTH} AS pt,
      last_value({column} IGNORE NULLS) {FORTH} AS pv, first_value({point} IGNORE NULLS) {BACK} AS nt,
      first_value({column} IGNORE NULLS) {BACK} AS nv FROM {source}),
    l_{column} AS (SELECT {keep}, CASE WHEN {column} IS NOT NULL THEN {column}
      WHEN epoch(ts) - epoch(pt) <= 7200
      THEN coalesce(pv + (nv - pv) * (epoch(ts) - epoch(pt)) / (epoch(nt) - epoch(pt)), pv) END AS lin FROM n_{column}),
    f_{column} AS (SELECT {keep}, coalesce(lin, {tail}) AS {column} FROM l_{column})"""


MEAN_TAIL = f"(last_value(lin IGNORE NULLS) {FORTH} + first_value(lin IGNORE NULLS) {BACK}) / 2"
FILL_TAIL = f"last_value(lin IGNORE NULLS) {FORTH}, first_value(lin IGNORE NULLS) {BACK}"


@query(
    "t3_impute_linear",
    with_views("grid", more=impute_sql("grid", "y", MEAN_TAIL)) + "SELECT item_id, ts, tidy(y) AS y FROM f_y",
)
def impute_linear(t: Tables):
    return impute.impute(t.grid(keep_chunk=True), ["y"]).select("item_id", "ts", tidy(F.col("y")).alias("y"))


@query(
    "t3_impute_long_gaps",
    with_views(
        "series",
        "spine",
        more="sparse AS (SELECT item_id, ts, CASE WHEN n >= 5 THEN y END AS y FROM spine LEFT JOIN series USING (item_id, ts)),\n"
        + impute_sql("sparse", "y", MEAN_TAIL),
    )
    + "SELECT item_id, ts, tidy(y) AS y FROM f_y",
)
def impute_long_gaps(t: Tables):
    ranges = grid.bounds(t.events.withColumnRenamed("event_type", "item_id"))
    sparse = grid.hourly_grid(t.series.filter("n >= 5"), ["y"], ranges=ranges, keep_chunk=True)
    return impute.impute(sparse, ["y"]).select("item_id", "ts", tidy(F.col("y")).alias("y"))


@query(
    "t4_upsample_daily",
    with_views("gas_daily", more=UPSAMPLED) + "SELECT ts, tidy(gas_price) AS gas_price FROM hourly_gas",
)
def upsample_daily(t: Tables):
    out = grid.hourly_from_daily(t.gas_daily, ["gas_price"])
    return out.select("ts", tidy(F.col("gas_price")).alias("gas_price"))


SPARSE = """sparse AS (SELECT item_id, ts, CASE WHEN n >= 4 THEN y * 3.6 END AS y
    FROM spine LEFT JOIN series USING (item_id, ts))"""


def _sparse_direction(t: Tables):
    ranges = grid.bounds(t.events.withColumnRenamed("event_type", "item_id"))
    rows = t.series.filter("n >= 4").withColumn("y", F.col("y") * 3.6)
    return grid.hourly_grid(rows, ["y"], ranges=ranges, keep_chunk=True)


@query(
    "t5_impute_direction",
    with_views("series", "spine", more=SPARSE + ",\n" + impute_sql("sparse", "y", FILL_TAIL))
    + "SELECT item_id, ts, tidy(y) AS y FROM f_y",
)
def impute_direction(t: Tables):
    out = impute.impute(_sparse_direction(t), [], ["y"])
    return out.select("item_id", "ts", tidy(F.col("y")).alias("y"))


@query(
    "t6_null_report",
    with_views("wide")
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null FROM wide" for c in ("elec_price", "gas_price", "temperature")
    ),
)
def null_report(t: Tables):
    return impute.null_counts(t.wide, ["elec_price", "gas_price", "temperature"])


COMBINED = """stacked AS (
      SELECT ts, temperature, gas_price * 3.6 AS wind_direction, 0 AS prio FROM wide
        WHERE ts < TIMESTAMP '2024-01-20' AND emissionfactor IS NOT NULL
      UNION ALL SELECT ts, humidity, elec_price * 3.6, 1 FROM wide
        WHERE ts >= TIMESTAMP '2024-01-18' AND emissionfactor > 20),
    first AS (SELECT * FROM stacked QUALIFY row_number() OVER (PARTITION BY ts ORDER BY prio) = 1),
    full_grid AS (SELECT '0' AS item_id, h.ts, temperature, wind_direction FROM
      (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM first) h LEFT JOIN first USING (ts)),
    """


@query(
    "t7_combine_weather",
    with_views(
        "wide",
        more=COMBINED
        + impute_sql("full_grid", "temperature", MEAN_TAIL)
        + ",\n"
        + impute_sql("full_grid", "wind_direction", FILL_TAIL),
    )
    + """SELECT item_id, ts, tidy(temperature) AS temperature, tidy(wind_direction) AS wind_direction
    FROM f_temperature JOIN f_wind_direction USING (item_id, ts)""",
)
def combine_weather(t: Tables):
    start = F.lit("2024-01-18").cast("timestamp")
    end = F.lit("2024-01-20").cast("timestamp")
    history = t.wide.filter((F.col("ts") < end) & F.col("emissionfactor").isNotNull()).select(
        "item_id", "ts", "temperature", (F.col("gas_price") * 3.6).alias("wind_direction")
    )
    forecast = t.wide.filter((F.col("ts") >= start) & (F.col("emissionfactor") > 20)).select(
        "item_id", "ts", F.col("humidity").alias("temperature"), (F.col("elec_price") * 3.6).alias("wind_direction")
    )
    out = weather.combine(history, forecast)
    return out.select("item_id", "ts", *[tidy(F.col(c)).alias(c) for c in ("temperature", "wind_direction")])


@query(
    "t18_merge_prices",
    with_views(
        "wide",
        "gas_daily",
        more=UPSAMPLED
        + """, both_prices AS (SELECT '0' AS item_id, ts, w.elec_price, h.gas_price
        FROM (SELECT ts, elec_price FROM wide) w FULL JOIN hourly_gas h USING (ts))""",
    )
    + f"""SELECT item_id, ts,
    tidy(coalesce(elec_price, last_value(elec_price IGNORE NULLS) {FORTH}, first_value(elec_price IGNORE NULLS) {BACK})) AS elec_price,
    tidy(coalesce(gas_price, last_value(gas_price IGNORE NULLS) {FORTH}, first_value(gas_price IGNORE NULLS) {BACK})) AS gas_price
    FROM both_prices""",
)
def merge_prices(t: Tables):
    out = features.merge_prices(t.wide, t.gas_daily)
    return out.select("item_id", "ts", *[tidy(F.col(c)).alias(c) for c in ("elec_price", "gas_price")])


@query(
    "a25_inferred_step",
    """WITH d AS (SELECT DISTINCT date_trunc('day', o_orderdate) AS ts FROM orders),
    g AS (SELECT epoch(lead(ts) OVER (ORDER BY ts)) - epoch(ts) AS step FROM d),
    c AS (SELECT CAST(step AS BIGINT) AS step, count(*) AS n FROM g WHERE step IS NOT NULL GROUP BY 1)
    SELECT '0' AS item_id, arg_max(step, (n, -step)) AS step_seconds, count(*) = 1 AS is_regular FROM c""",
)
def inferred_step(t: Tables):
    return grid.inferred_step(t.daily)


@query(
    "a26_mean_imputation",
    with_views("wide") + "SELECT ts, tidy(coalesce(elec_price, (SELECT avg(elec_price) FROM wide))) AS elec_price FROM wide",
)
def mean_imputation(t: Tables):
    out = impute.impute_mean(t.wide.select("ts", "elec_price"), "elec_price")
    return out.select("ts", tidy(F.col("elec_price")).alias("elec_price"))


@query(
    "w7_forward_fill_daily",
    with_views("daily", more="x AS (SELECT ts, CASE WHEN n >= 4 THEN price END AS price FROM daily)")
    + """SELECT ts, tidy3(last_value(price IGNORE NULLS) OVER (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING
    AND CURRENT ROW)) AS price FROM x""",
)
def forward_fill_daily(t: Tables):
    sparse = t.daily.withColumn("price", F.when(F.col("n") >= 4, F.col("price")))
    out = ordered.forward_fill(sparse.select("item_id", "ts", "price"), ["price"])
    return out.select("ts", tidy(F.col("price"), 3).alias("price"))


@query(
    "u2_union_with_priority",
    """WITH e AS (SELECT event_id, value, 0 AS prio FROM events WHERE event_type IN ('click', 'view')
      UNION ALL SELECT event_id, -value, 1 FROM events WHERE event_type <> 'click')
    SELECT event_id, value FROM e QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY prio) = 1""",
)
def union_with_priority(t: Tables):
    rows = t.events.select("event_id", "event_type", "value")
    first = rows.filter(F.col("event_type").isin("click", "view")).drop("event_type")
    second = rows.filter("event_type <> 'click'").drop("event_type")
    return align.union_with_priority([first, second.withColumn("value", -F.col("value"))], ["event_id"])


@query(
    "u4_column_difference",
    with_views("daily") + "SELECT ts, tidy3(price) AS price, n FROM daily",
)
def column_difference(t: Tables):
    extra = schema.column_difference(t.daily, t.gas_daily)
    return t.daily.select("ts", *extra).withColumn("price", tidy(F.col("price"), 3))


@query("p1_column_subset", "SELECT l_orderkey, l_shipdate AS ts, l_quantity FROM lineitem")
def column_subset(t: Tables):
    return t.read("lineitem").select("l_orderkey", F.col("l_shipdate").cast("timestamp").alias("ts"), "l_quantity")


@query(
    "p2_rename_map",
    "SELECT o_orderkey AS order_id, o_totalprice AS elec_price, o_orderdate AS ts FROM orders",
)
def rename_map(t: Tables):
    names = {"o_orderkey": "order_id", "o_totalprice": "elec_price", "o_orderdate": "ts"}
    renamed = t.read("orders").select(*names).withColumnsRenamed(names)
    return renamed.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "p6_leakage_guard",
    with_views("wide") + "SELECT ts, tidy(temperature) AS temperature, tidy(humidity) AS humidity FROM wide",
)
def leakage_guard(t: Tables):
    covariates = schema.forbid_derived(t.wide.select("ts", "temperature", "humidity"), "emissionfactor")
    return covariates.withColumns({c: tidy(F.col(c)) for c in ("temperature", "humidity")})


@query(
    "p7_missing_feature_guard",
    with_views("wide") + "SELECT ts, tidy(elec_price) AS elec_price, tidy(gas_price) AS gas_price FROM wide",
)
def missing_feature_guard(t: Tables):
    wanted = ["elec_price", "gas_price"]
    return schema.require_columns(t.wide, wanted).select("ts", *[tidy(F.col(c)).alias(c) for c in wanted])


@query(
    "p12_time_column_normaliser",
    "SELECT event_id, ts, value FROM events",
)
def time_column_normaliser(t: Tables):
    raw = t.events.select("event_id", F.col("ts").alias("validfrom (UTC)"), "value")
    return schema.normalise_time(raw)


@query("x21_column_by_substring", "SELECT o_orderkey, o_orderdate AS ts FROM orders")
def column_by_substring(t: Tables):
    orders = t.read("orders")
    found = schema.find_column(orders.columns, *schema.TIME_WORDS)
    return orders.select("o_orderkey", F.col(found).cast("timestamp").alias("ts"))
