"""Hourly panel analytics on Spark: align, derive features, forecast, evaluate."""
