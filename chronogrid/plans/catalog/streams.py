"""Streaming forms run to the end of the given event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronogrid.plans.catalog.aggregates import tidied
from chronogrid.plans.catalog.base import Tables, query
from chronogrid.streaming import twins


def event_stream(t: Tables):
    return twins.read_stream(t.spark, t.folder, "events.parquet", t.read("events").schema)


MEAN_SQL = "tidy(CAST(sum(CAST(value AS DECIMAL(28,10))) AS DOUBLE) / count(value)) AS mean, count(value) AS n"


@query(
    "r1_tumbling_hour_mean",
    f"""SELECT event_type, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, {MEAN_SQL}
    FROM events GROUP BY 1, 2, 3""",
)
def tumbling(t: Tables):
    means = twins.windowed_mean(event_stream(t), F.col("value"), "event_type", "1 hour")
    return tidied(twins.update_to(means, ["event_type", "window_start", "window_end"], t.scratch("r1")))


@query(
    "r2_sliding_day_mean",
    f"""WITH e AS (SELECT event_type, value, unnest(generate_series(date_trunc('hour', ts) - INTERVAL 23 HOUR, date_trunc('hour', ts),
      INTERVAL 1 HOUR)) AS window_start FROM events)
    SELECT event_type, window_start, window_start + INTERVAL 24 HOUR AS window_end, {MEAN_SQL} FROM e GROUP BY 1, 2""",
)
def sliding(t: Tables):
    means = twins.windowed_mean(event_stream(t), F.col("value"), "event_type", "24 hours", "1 hour")
    return tidied(twins.update_to(means, ["event_type", "window_start", "window_end"], t.scratch("r2")))


@query(
    "r3_sessions",
    """WITH m AS (SELECT event_type, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) < INTERVAL 30 MINUTE
      THEN 0 ELSE 1 END AS brk FROM events),
    r AS (SELECT event_type, ts, sum(brk) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM m),
    s AS (SELECT event_type, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM r GROUP BY event_type, run)
    SELECT * FROM s""",
)
def sessions(t: Tables):
    found = lambda stream: twins.sessions(stream, "event_type", "30 minutes", "1 day")
    return twins.append_to_end(event_stream(t), found, t.scratch("r3"), "event_type", 1800, 86400)


@query("r4_redelivered_rows", "SELECT event_id, event_type, ts, value FROM events")
def redelivered(t: Tables):
    twice = event_stream(t).union(event_stream(t)).select("event_id", "event_type", "ts", "value")
    return twins.append_to(twins.first_delivery(twice, ["event_id"]), t.scratch("r4"))
