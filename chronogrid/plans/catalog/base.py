"""Named queries over the given tables, each with the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogrid.functions.numbers import exact_mean
from chronogrid.functions.timeparts import as_utc
from chronogrid.operators import evaluate, grid
from chronogrid.session import configure, materialise, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Event types standing in for the columns of one hourly series.
WIDE_COLUMNS = {
    "purchase": "elec_price",
    "error": "gas_price",
    "click": "temperature",
    "view": "humidity",
    "signup": "emissionfactor",
}

# The same views as SQL; a name may use the ones before it.
VIEWS = {
    "series": """SELECT event_type AS item_id, date_trunc('hour', ts) AS ts,
        CAST(sum(CAST(value AS DECIMAL(28,10))) AS DOUBLE) / count(value) AS y, count(*) AS n
        FROM events GROUP BY 1, 2""",
    "spine": """SELECT item_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts
        FROM series GROUP BY item_id""",
    "grid": "SELECT p.item_id, p.ts, s.y FROM spine p LEFT JOIN series s USING (item_id, ts)",
    "wide": "SELECT '0' AS item_id, ts, "
    + ", ".join(f"max(CASE WHEN item_id = '{k}' THEN y END) AS {v}" for k, v in WIDE_COLUMNS.items())
    + " FROM series GROUP BY ts",
    "daily": """SELECT '0' AS item_id, date_trunc('day', o_orderdate) AS ts,
        CAST(sum(CAST(o_totalprice AS DECIMAL(28,10))) AS DOUBLE) / count(o_totalprice) AS price,
        count(*) AS n FROM orders GROUP BY 2""",
    "ship": """SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity,
        l_shipdate + to_hours(3 * CAST(l_linenumber AS BIGINT)) AS ts FROM lineitem""",
    "gas_daily": """SELECT date_trunc('day', ts) AS ts,
        CAST(sum(CAST(value AS DECIMAL(28,10))) AS DOUBLE) / count(value) AS gas_price
        FROM events WHERE event_type = 'error' GROUP BY 1""",
    "step": """SELECT item_id, ts, y, y - lag(y) OVER (PARTITION BY item_id ORDER BY ts) AS actual_diff
        FROM grid""",
    "err": """SELECT a.item_id, a.ts, a.y AS actual, b.y AS predicted, b.y - a.y AS error,
        abs(b.y - a.y) AS abs_error, 100 * (b.y - a.y) / nullif(a.y, 0) AS pct_error, a.actual_diff,
        hour(a.ts) AS hour, isodow(a.ts) - 1 AS dayofweek,
        CAST(isodow(a.ts) >= 6 AS BIGINT) AS is_weekend, w.temperature, w.humidity, w.elec_price,
        w.gas_price
        FROM step a JOIN step b ON a.item_id = b.item_id AND a.ts = b.ts + INTERVAL 168 HOUR
        LEFT JOIN wide w ON w.ts = a.ts
        WHERE a.y IS NOT NULL AND b.y IS NOT NULL""",
}
USES = {
    "spine": ["series"],
    "grid": ["series", "spine"],
    "wide": ["series"],
    "step": ["series", "spine", "grid"],
    "err": ["series", "spine", "grid", "wide", "step"],
}


def with_views(*names: str, more: str = "") -> str:
    """The WITH clause defining the named views, what they use, and further ones."""
    needed = {v for name in names for v in [*USES.get(name, []), name]}
    parts = [f"{v} AS ({text})" for v, text in VIEWS.items() if v in needed]
    if more:
        parts.append(more)
    return "WITH " + ",\n".join(parts) + "\n"


def expand(sql: str) -> str:
    """Write out `tidy(x)` and `tidy3(x)`: x rounded half up to 6 or 3 digits, with slack."""
    while match := re.search(r"\btidy(\d?)\(", sql):
        depth, end = 1, match.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        digits = int(match[1] or 6)
        inner = sql[match.end() : end - 1]
        rounded = f"(round(({inner}) + 1e-{digits + 3}, {digits}) + 0.0)"
        sql = sql[: match.start()] + rounded + sql[end:]
    return sql


@dataclass
class Tables:
    """The given tables and the views over them."""

    spark: SparkSession
    folder: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events").withColumn("ts", as_utc(F.col("ts")))

    @cached_property
    def series(self) -> DataFrame:
        """Hourly mean per event type."""
        return self.events.groupBy(
            F.col("event_type").alias("item_id"), F.date_trunc("hour", "ts").alias("ts")
        ).agg(exact_mean(F.col("value")).alias("y"), F.count("*").alias("n"))

    def grid(self, halo: int = 0, keep_chunk: bool = False) -> DataFrame:
        """`series` with every hour present."""
        ranges = grid.bounds(self.events.withColumnRenamed("event_type", "item_id"))
        return grid.hourly_grid(self.series, ["y"], halo=halo, ranges=ranges, keep_chunk=keep_chunk)

    @cached_property
    def wide(self) -> DataFrame:
        """One series with a column per event type; hours with any event."""
        cells = [
            exact_mean(F.when(F.col("event_type") == k, F.col("value"))).alias(v)
            for k, v in WIDE_COLUMNS.items()
        ]
        known = self.events.filter(F.col("event_type").isin(*WIDE_COLUMNS))
        hourly = known.groupBy(F.date_trunc("hour", "ts").alias("ts")).agg(
            *[F.when(c.isNotNull(), c).alias(n) for c, n in zip(cells, WIDE_COLUMNS.values())]
        )
        return hourly.select(F.lit("0").alias("item_id"), "ts", *WIDE_COLUMNS.values())

    @cached_property
    def daily(self) -> DataFrame:
        """Mean order price per day, as one series."""
        orders = self.read("orders").select(as_utc(F.col("o_orderdate")).alias("o_orderdate"), "o_totalprice")
        return (
            orders.groupBy(F.date_trunc("day", "o_orderdate").alias("ts"))
            .agg(exact_mean(F.col("o_totalprice")).alias("price"), F.count("*").alias("n"))
            .select(F.lit("0").alias("item_id"), "ts", "price", "n")
        )

    @cached_property
    def ship(self) -> DataFrame:
        """Shipments at hours of the day spread by line number."""
        return self.read("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_extendedprice",
            "l_quantity",
            (as_utc(F.col("l_shipdate")) + F.make_interval(hours=F.col("l_linenumber") * 3)).alias("ts"),
        )

    @cached_property
    def gas_daily(self) -> DataFrame:
        """Daily mean of one event type."""
        return (
            self.events.filter("event_type = 'error'")
            .groupBy(F.date_trunc("day", "ts").alias("ts"))
            .agg(exact_mean(F.col("value")).alias("gas_price"))
            .select(F.lit("0").alias("item_id"), "ts", "gas_price")
        )

    def scratch(self, label: str) -> str:
        """A fresh folder in the shared scratch space."""
        return scratch_path(self.spark, label)

    def errors(self, covariates: bool = True) -> DataFrame:
        """Error table of the value one week earlier as forecast."""
        table = evaluate.naive_error_table(self.grid(168), "y", 168)
        if not covariates:
            return table
        weather = self.wide.select("ts", "temperature", "humidity", "elec_price", "gas_price")
        return table.join(weather, "ts", "left")

    def stored_errors(self) -> DataFrame:
        """The error table, written once for reports that read it several times."""
        return materialise(self.errors(), "errors")


def query(name: str, sql: str | None = None):
    """Register a query `fn(tables)` under a name, with the SQL that checks it."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = expand(sql)
        return fn

    return register
