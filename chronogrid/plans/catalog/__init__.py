"""All registered queries and their checking SQL."""

from chronogrid.plans.catalog import aggregates, alignment, calendars, evaluations, files, models, ordered, reports, scalars, statistics, streams  # noqa: F401
from chronogrid.plans.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
