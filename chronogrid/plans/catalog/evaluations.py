"""Every report of the evaluation job, over one error table with holidays and a regime."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronogrid.functions import numbers
from chronogrid.operators import calendar
from chronogrid.plans import forecasting
from chronogrid.plans.catalog.aggregates import bin_sql, edges_sql, tidied
from chronogrid.plans.catalog.base import ORACLES, Tables, query, with_views
from chronogrid.plans.catalog.calendars import HOLIDAY_SQL, JANUARY, JANUARY_FLAG
from chronogrid.plans.catalog.statistics import METRIC_SQL, quartile_sql

PROFILE = ["temperature", "humidity", "elec_price", "gas_price"]


def job_reports(t: Tables):
    """The job on the value one week earlier, with every column that its reports ask for."""
    errors = calendar.add_holidays(t.errors())
    errors = errors.withColumn("energy_crisis", numbers.regime_flag(F.col("ts"), JANUARY.start, JANUARY.end))
    return forecasting.evaluate(errors, PROFILE, "temperature", "elec_price", "energy_crisis")


def profile_sql() -> str:
    """Quartile bins of every profiled feature; each has more than four values and no tied edges."""
    edges = [edges_sql("err", c).replace("edges", f"edges_{c}", 1) for c in PROFILE]
    parts = [
        f"""SELECT '{c}' AS feature, CAST({bin_sql(c)} AS BIGINT) AS bin, {c} AS v, error FROM err, edges_{c} WHERE {c} IS NOT NULL"""
        for c in PROFILE
    ]
    return (
        with_views("err", more=", ".join([*edges, "b AS (" + " UNION ALL ".join(parts) + ")"]))
        + """SELECT feature, 'quantile' AS method, bin, tidy(min(v)) AS low, tidy(max(v)) AS high, tidy(avg(error)) AS mean_error,
    tidy(stddev_samp(error)) AS std_error, count(*) AS n FROM b GROUP BY 1, 3"""
    )


def correlation_sql(column: str) -> str:
    return with_views("err") + f"SELECT tidy(corr({column}, error)) AS corr, count(*) AS n FROM err WHERE {column} IS NOT NULL"


CONDITIONS = {"is_weekend": "is_weekend = 1", "is_holiday": "is_holiday", "not_is_weekend": "is_weekend = 0", "not_is_holiday": "NOT is_holiday"}

# The SQL of each report; those that are also a query of their own share its SQL.
REPORTS = {
    "metrics": with_views("err") + f"SELECT {METRIC_SQL} FROM err",
    "patterns": ORACLES["j10_label_alignment"],
    "hours": ORACLES["w13_best_and_worst_hour"],
    "steps": with_views("err")
    + "SELECT tidy(avg(abs(actual_diff))) AS mean_abs_diff, tidy(corr(actual_diff, error)) AS corr_diff_error FROM err",
    "profile": profile_sql(),
    "statistics": ORACLES["a13_feature_statistics"],
    "conditional": with_views("err", more=HOLIDAY_SQL)
    + ", marked AS (SELECT err.*, h.name IS NOT NULL AS is_holiday FROM err LEFT JOIN all_holidays h ON CAST(ts AS DATE) = h.date) SELECT "
    + ", ".join(
        f"tidy(avg(abs_error) FILTER ({c})) AS {name}_mae, count(*) FILTER ({c}) AS {name}_n" for name, c in CONDITIONS.items()
    )
    + " FROM marked",
    "temperature": quartile_sql("temperature", forecasting.ev.TEMPERATURE_LABELS),
    "temperature_corr": correlation_sql("temperature"),
    "price": quartile_sql("elec_price", forecasting.ev.PRICE_LABELS),
    "price_correlation": correlation_sql("elec_price"),
    "crisis": ORACLES["e11_error_by_regime"],
}
RESULT_NAMES = {"price_correlation": "price_corr"}


def register(name: str, sql: str) -> None:
    @query(f"g4_evaluation_{name}", sql)
    def report(t: Tables):
        return tidied(job_reports(t)[RESULT_NAMES.get(name, name)])


for _name, _sql in REPORTS.items():
    register(_name, _sql)
