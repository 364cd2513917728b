"""Exact quantiles, quantile bins and equal-width bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogrid.operators import selection

def to_long(df: DataFrame, keys: list[str], values: list[str], extra: list[str] = ()) -> DataFrame:
    """Value columns as (keys, extra, feature, v) rows, without NULL and NaN."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in values]
    )
    return (
        df.select(*keys, *extra, F.explode(cells).alias("_c"))
        .select(*keys, *extra, "_c.feature", "_c.v")
        .filter(F.col("v").isNotNull() & ~F.isnan("v"))
    )


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    values: list[str],
    probs: list[float],
    few_groups: bool = False,
) -> DataFrame:
    """Quantiles with linear interpolation, as (keys, feature, n, edges).

    Ranks are found by refinement over the bits of the numbers (see `selection`), so no
    group is gathered or sorted whatever its size. The frame is read three times; write it
    first where it is expensive to compute. `few_groups` states that the keys are few by
    construction (flags, hours); without keys the groups are the columns.
    """
    long = to_long(df, keys, values)
    return selection.quantiles(long, [*keys, "feature"], probs, few_groups=few_groups or not keys)


def quantile_columns(
    df: DataFrame, keys: list[str], value: str, names: dict[str, float], few_groups: bool = False
) -> DataFrame:
    """Exact quantiles of one column as one named column each."""
    edges = exact_quantiles(df, keys, [value], list(names.values()), few_groups)
    return edges.select(*keys, "n", *[F.col("edges")[i].alias(c) for i, c in enumerate(names)])


def right_closed(value: Column, edges: Column, n: int) -> Column:
    """Number of the right-closed bin, from 0; the lowest edge belongs to bin 0."""
    chosen = F.lit(None).cast("bigint")
    for i in reversed(range(n)):
        chosen = F.when(value <= edges[i + 1], F.lit(i).cast("bigint")).otherwise(chosen)
    return F.when(value >= edges[0], chosen)


def has_tied_edges(edges: Column) -> Column:
    """True when quantile edges coincide, so that labelled bins do not exist."""
    return F.size(F.array_distinct(edges)) < F.size(edges)


def quantile_bins(
    df: DataFrame,
    value: str,
    q: int,
    keys: list[str] = (),
    name: str = "bin",
    few_groups: bool = False,
) -> DataFrame:
    """Rows with a known value plus the number of their quantile bin.

    The bin is NULL in a group whose edges coincide.
    """
    keys = list(keys)
    probs = [i / q for i in range(q + 1)]
    edges = exact_quantiles(df, keys, [value], probs, few_groups).withColumnRenamed("edges", "_edges")
    known = df.filter(F.col(value).isNotNull())
    if keys:
        small = edges.select(*keys, "_edges")
        tagged = known.join(F.broadcast(small) if few_groups else small, keys)
    else:
        tagged = known.withColumn("_edges", edges.select("_edges").scalar())
    number = right_closed(F.col(value), F.col("_edges"), q)
    return tagged.withColumn(name, F.when(~has_tied_edges(F.col("_edges")), number)).drop("_edges")


def equal_width_bin(value: Column, low: Column, high: Column, n: int) -> Column:
    """Number of the right-closed equal-width bin, from 0.

    The lowest edge is widened by 0.1 % of the range so that the minimum falls in.
    """
    width = (high - low) / F.lit(n)
    chosen = F.lit(n - 1).cast("bigint")
    for i in reversed(range(n - 1)):
        chosen = F.when(value <= low + width * F.lit(i + 1), F.lit(i).cast("bigint")).otherwise(chosen)
    return F.when(value >= low - (high - low) * F.lit(0.001), chosen)


def equal_width_edges(low: Column, high: Column, n: int) -> Column:
    """Edges of the equal-width bins, the lowest widened by 0.1 % of the range."""
    width = (high - low) / F.lit(n)
    inner = [low + width * F.lit(i) for i in range(1, n)]
    return F.array(low - (high - low) * F.lit(0.001), *inner, high)
