"""Numeric coercion, ratios, error columns and labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_comma(text: Column) -> Column:
    """Number text with a decimal comma or point; anything else is NULL."""
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


def to_number(text: Column) -> Column:
    """Numeric coercion, unreadable text is NULL."""
    return text.try_cast("double")


def flag_or_zero(text: Column) -> Column:
    """Numeric coercion with NULL as 0, then whole number."""
    return F.coalesce(text.try_cast("double"), F.lit(0.0)).cast("bigint")


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient; a zero denominator gives NULL."""
    return F.try_divide(top, bottom)


def null_if_nan(value: Column) -> Column:
    """NaN as NULL, so that aggregates skip it."""
    return F.when(~F.isnan(value), value)


def exact_sum(value: Column, scale: int = 10) -> Column:
    """Sum of measurements with `scale` digits after the point, added as decimals.

    It does not depend on the order in which partial sums are merged, so a recomputed
    task gives the same bits as the lost one. NULL if a value has over 28 - scale digits
    before the point or is not finite.
    """
    fixed = value.try_cast(f"decimal(28,{scale})")
    whole = F.count(value) == F.count(fixed)
    return F.when(whole, F.sum(fixed).cast("double"))


def exact_mean(value: Column, scale: int = 10) -> Column:
    """Mean through `exact_sum`; values that it cannot hold give the plain mean."""
    return F.coalesce(F.try_divide(exact_sum(value, scale), F.count(value)), F.avg(value))


def tidy(value: Column, digits: int = 6) -> Column:
    """Rounded half up, with slack for floating noise and without a negative zero.

    A mean that lies exactly between two rounded values may come out a bit below
    or above it, depending on the order of addition; the slack settles it upwards.
    """
    return F.round(value + F.lit(10.0 ** -(digits + 3)), digits) + F.lit(0.0)


def title_label(text: Column) -> Column:
    """`early_crisis` to `Early Crisis`."""
    return F.initcap(F.replace(text, F.lit("_"), F.lit(" ")))


def vacation_name(text: Column) -> Column:
    """`Fall holiday` to `fall`; names that are not a school holiday give NULL."""
    lowered = F.lower(text)
    return F.when(
        lowered.contains("holiday"), F.replace(lowered, F.lit(" holiday"), F.lit(""))
    )


def error_columns(actual: Column, predicted: Column) -> dict[str, Column]:
    """Signed error, absolute error and percentage error."""
    error = predicted - actual
    return {
        "error": error,
        "abs_error": F.abs(error),
        "pct_error": F.try_divide(error * 100, actual),
    }


def regime_flag(ts: Column, start: date, end: date | None = None) -> Column:
    """1 inside the regime, 0 outside; the end is inclusive and optional."""
    inside = ts >= F.lit(start).cast("timestamp")
    if end is not None:
        inside = inside & (ts <= F.lit(end).cast("timestamp"))
    return F.when(inside, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def phase_label(ts: Column, first: str, cuts: list[tuple[date, str]]) -> Column:
    """Label by time: `first` before the first cut, then the latest cut reached."""
    label = F.lit(first)
    for start, name in sorted(cuts):
        label = F.when(ts >= F.lit(start).cast("timestamp"), F.lit(name)).otherwise(label)
    return label


def one_hot(value: Column, names: list[str], prefix: str) -> dict[str, Column]:
    """One 0/1 column per known name, observed or not."""
    return {
        f"{prefix}_{name}": F.coalesce((value == F.lit(name)).cast("bigint"), F.lit(0).cast("bigint"))
        for name in names
    }
