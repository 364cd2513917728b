"""Ordered operators: differences, lags, rolling statistics, fills, runs, de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronogrid.functions.numbers import tidy
from chronogrid.operators import align, chunks, evaluate, features, ordered
from chronogrid.plans.catalog.base import Tables, query, with_views

BY_TIME = "OVER (PARTITION BY item_id ORDER BY ts)"


def _frame(rows: int) -> str:
    return f"OVER (PARTITION BY item_id ORDER BY ts ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


@query(
    "w1_first_difference",
    with_views("grid") + f"SELECT item_id, ts, tidy(y - lag(y) {BY_TIME}) AS y_diff FROM grid",
)
def first_difference(t: Tables):
    out = chunks.windowed(t.grid(24), 24, lambda w: {"y_diff": ordered.difference(F.col("y"), 1, w)})
    return out.select("item_id", "ts", tidy(F.col("y_diff")).alias("y_diff"))


@query(
    "w2_seasonal_difference",
    with_views("grid")
    + f"""SELECT item_id, ts, tidy(y - lag(y, 24) {BY_TIME}) AS diff_24h,
    tidy(y - lag(y, 168) {BY_TIME}) AS diff_168h FROM grid""",
)
def seasonal_difference(t: Tables):
    out = chunks.windowed(
        t.grid(168), 168, lambda w: {f"diff_{k}h": ordered.difference(F.col("y"), k, w) for k in (24, 168)}
    )
    return out.select("item_id", "ts", *[tidy(F.col(c)).alias(c) for c in ("diff_24h", "diff_168h")])


ALL_LAGS = sorted(
    {*features.TARGET_LAGS, *features.TEMPERATURE_LAGS, *features.ELECTRICITY_LAGS, *features.GAS_LAGS}
)


@query(
    "w3_lags",
    with_views("grid")
    + "SELECT item_id, ts, "
    + ", ".join(f"tidy(lag(y, {k}) {BY_TIME}) AS lag_{k}h" for k in ALL_LAGS)
    + " FROM grid",
)
def lags(t: Tables):
    out = chunks.windowed(
        t.grid(168), 168, lambda w: {f"lag_{k}h": tidy(ordered.lag(F.col("y"), k, w)) for k in ALL_LAGS}
    )
    return out.drop("y")


@query(
    "w4_rolling_mean",
    with_views("grid")
    + "SELECT item_id, ts, "
    + ", ".join(f"tidy(avg(y) {_frame(n)}) AS mean_{n}h" for n in (24, 48, 168, 336))
    + " FROM grid",
)
def rolling_mean(t: Tables):
    out = chunks.windowed(
        t.grid(336),
        336,
        lambda w: {f"mean_{n}h": tidy(ordered.rolling_mean("y", n)) for n in (24, 48, 168, 336)},
        means={"y": [24, 48, 168, 336]},
    )
    return out.drop("y")


FILLED = """filled AS (SELECT item_id, ts, last_value(y IGNORE NULLS) OVER (PARTITION BY item_id ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y FROM grid)"""


@query(
    "w5_rolling_mean_full",
    with_views("grid", more=FILLED)
    + "SELECT item_id, ts, "
    + ", ".join(f"CASE WHEN count(y) {_frame(n)} = {n} THEN tidy(avg(y) {_frame(n)}) END AS full_{n}h" for n in (168, 720))
    + " FROM filled",
)
def rolling_mean_full(t: Tables):
    filled = ordered.forward_fill(t.grid(keep_chunk=True), ["y"])
    out = chunks.windowed(
        filled,
        720,
        lambda w: {f"full_{n}h": tidy(ordered.rolling_mean("y", n, full=True)) for n in (168, 720)},
        means={"y": [168, 720]},
    )
    return out.drop("y")


@query(
    "w6_rolling_std",
    with_views("grid", more=FILLED)
    + f"""SELECT item_id, ts, tidy(stddev_samp(y) {_frame(24)}) AS std_24h,
    tidy(stddev_samp(y) {_frame(168)}) AS std_168h,
    CASE WHEN count(y) {_frame(168)} = 168 THEN tidy(stddev_samp(y) {_frame(168)}) END AS full_std_168h
    FROM filled""",
)
def rolling_std(t: Tables):
    filled = ordered.forward_fill(t.grid(keep_chunk=True), ["y"])
    out = chunks.windowed(
        filled,
        168,
        lambda w: {
            "std_24h": tidy(ordered.rolling_std("y", 24)),
            "std_168h": tidy(ordered.rolling_std("y", 168)),
            "full_std_168h": tidy(ordered.rolling_std("y", 168, full=True)),
        },
        spread={"y": [24, 168]},
    )
    return out.drop("y")


@query("w7_forward_fill", with_views("grid", more=FILLED) + "SELECT item_id, ts, tidy(y) AS y FROM filled")
def forward_fill(t: Tables):
    out = ordered.forward_fill(t.grid(keep_chunk=True), ["y"])
    return out.select("item_id", "ts", tidy(F.col("y")).alias("y"))


BACK = """OVER (PARTITION BY item_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
FORTH = """OVER (PARTITION BY item_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query(
    "w8_backward_fill",
    with_views("grid") + f"SELECT item_id, ts, tidy(first_value(y IGNORE NULLS) {BACK}) AS y FROM grid",
)
def backward_fill(t: Tables):
    out = ordered.backward_fill(t.grid(keep_chunk=True), ["y"])
    return out.select("item_id", "ts", tidy(F.col("y")).alias("y"))


PROBED = ["elec_price", "gas_price", "humidity"]


@query(
    "w9_fill_when_probe_missing",
    with_views("wide")
    + "SELECT ts, "
    + ", ".join(
        f"tidy(CASE WHEN (SELECT count(*) - count(elec_price) FROM wide) > 0 THEN "
        f"coalesce({c}, last_value({c} IGNORE NULLS) {FORTH}, first_value({c} IGNORE NULLS) {BACK}) ELSE {c} END) AS {c}"
        for c in PROBED
    )
    + " FROM wide",
)
def probe_fill(t: Tables):
    out = ordered.fill_when_probe_missing(t.wide.select("item_id", "ts", *PROBED), PROBED, "elec_price")
    return out.select("ts", *[tidy(F.col(c)).alias(c) for c in PROBED])


@query(
    "w10_tail_slices",
    with_views("grid", more="ends AS (SELECT item_id, max(ts) AS hi FROM grid GROUP BY 1)")
    + """SELECT item_id, 'last_168' AS slice, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts
    FROM grid JOIN ends USING (item_id) WHERE ts > hi - INTERVAL 168 HOUR GROUP BY 1
    UNION ALL SELECT item_id, 'weeks_2_3', count(*), min(ts), max(ts)
    FROM grid JOIN ends USING (item_id) WHERE ts <= hi - INTERVAL 168 HOUR AND ts > hi - INTERVAL 504 HOUR GROUP BY 1
    UNION ALL SELECT item_id, 'all_but_last_168', count(*), min(ts), max(ts)
    FROM grid JOIN ends USING (item_id) WHERE ts <= hi - INTERVAL 168 HOUR GROUP BY 1""",
)
def tail_slices(t: Tables):
    g = t.grid()
    parts = {"last_168": (0, 168), "weeks_2_3": (168, 336), "all_but_last_168": (168, None)}
    out = None
    for name, (skip, take) in parts.items():
        part = ordered.tail(g, skip, take).groupBy("item_id").agg(
            F.lit(name).alias("slice"),
            F.count("*").alias("n_rows"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "w11_shift_alignment",
    with_views("wide", more=f"d AS (SELECT ts, emissionfactor - lag(emissionfactor) {BY_TIME} AS change FROM wide)")
    + "SELECT ts, tidy(change) AS change, hour(ts) AS hour FROM d WHERE change IS NOT NULL",
)
def shift_alignment(t: Tables):
    out = features.temporal(features.stationary(t.wide, ["emissionfactor"]))
    return out.select("ts", tidy(F.col("emissionfactor")).alias("change"), "hour")


@query(
    "w12_runs",
    with_views("series")
    + f""", busy AS (SELECT item_id, ts FROM series WHERE n >= 2),
    marked AS (SELECT item_id, ts, CASE WHEN ts - lag(ts) {BY_TIME} <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS brk FROM busy),
    named AS (SELECT item_id, ts, sum(brk) {BY_TIME} AS run FROM marked)
    SELECT item_id, min(ts) AS run_start, max(ts) AS run_end, count(*) AS n_rows FROM named GROUP BY item_id, run""",
)
def runs(t: Tables):
    return ordered.runs(t.series.filter("n >= 2").select("item_id", "ts"), 1)


@query(
    "w13_best_and_worst_hour",
    with_views("err", more="m AS (SELECT hour, avg(error) AS m FROM err GROUP BY 1)")
    + """SELECT arg_min(hour, (round(m, 9), hour)) AS best_hour, tidy(min(m)) AS best_mean,
    arg_max(hour, (round(m, 9), -hour)) AS worst_hour, tidy(max(m)) AS worst_mean FROM m""",
)
def best_and_worst(t: Tables):
    out = evaluate.best_and_worst_hour(t.errors(False))
    return out.select(
        "best_hour", tidy(F.col("best_mean")).alias("best_mean"), "worst_hour", tidy(F.col("worst_mean")).alias("worst_mean")
    )


@query(
    "w14_priority_dedupe",
    with_views("series")
    + """, merged AS (SELECT item_id, ts, y, 0 AS prio FROM series WHERE ts < TIMESTAMP '2024-01-20'
      UNION ALL SELECT item_id, ts, -y, 1 FROM series WHERE ts >= TIMESTAMP '2024-01-15')
    SELECT item_id, ts, tidy(y) AS y FROM merged QUALIFY row_number() OVER (PARTITION BY item_id, ts ORDER BY prio) = 1""",
)
def priority_dedupe(t: Tables):
    s = t.series.select("item_id", "ts", "y")
    history = s.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    forecast = s.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp")).withColumn("y", -F.col("y"))
    out = align.union_with_priority([history, forecast], ["item_id", "ts"])
    return out.select("item_id", "ts", tidy(F.col("y")).alias("y"))


@query(
    "w15_keep_first_by_time",
    """SELECT event_type AS item_id, date_trunc('hour', ts) AS hour_ts, ts, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts, event_id) = 1""",
)
def keep_first(t: Tables):
    rows = t.events.select(
        F.col("event_type").alias("item_id"), F.date_trunc("hour", "ts").alias("hour_ts"), "ts", "event_id", "value"
    )
    return align.keep_first(rows, ["item_id", "hour_ts"], [F.col("ts"), F.col("event_id")])
