"""Gap imputation on a gap-free grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogrid.operators import chunks

# Fixed value: how many steps a straight line reaches into a gap.
LINEAR_REACH = 2


def _line(
    column: str, ts: str, step: Column | None = None, circular: bool = False
) -> tuple[Column, Column]:
    """Value on the line between the known neighbours, here or `step` hours in.

    Without a later neighbour the line is flat. Also returns the distance in hours
    from the earlier neighbour.
    """
    prev, nxt = F.col(f"{column}__prev"), F.col(f"{column}__next")
    into = (F.unix_seconds(ts) - F.unix_seconds(prev["ts"])) / F.lit(3600)
    span = (F.unix_seconds(nxt["ts"]) - F.unix_seconds(prev["ts"])) / F.lit(3600)
    rise = nxt["v"] - prev["v"]
    if circular:
        rise = F.pmod(rise + F.lit(540.0), F.lit(360.0)) - F.lit(180.0)
    at = into if step is None else step
    value = F.coalesce(prev["v"] + rise * at / span, prev["v"])
    return (F.pmod(value, F.lit(360.0)) if circular else value), into


def impute(
    df: DataFrame,
    columns: list[str],
    directions: list[str] = (),
    circular: bool = False,
    item: str = "item_id",
    ts: str = "ts",
) -> DataFrame:
    """Fill the gaps of all columns in one pass.

    A plain column follows a straight line up to two steps into a gap; the rest of
    the hole gets the mean of the last point of the line and the next known value.
    Leading NULLs stay, a trailing gap gets two repeats only.

    A direction follows the line as far, then keeps its last point, and leading
    NULLs take the first known value. With `circular`, degrees take the shorter way
    around.
    """
    every = [*columns, *directions]
    near = chunks.neighbours(df, every, item, ts)
    filled = {}
    for c in every:
        turn = circular and c in directions
        line, into = _line(c, ts, circular=turn)
        edge, _ = _line(c, ts, F.lit(float(LINEAR_REACH)), circular=turn)
        later = F.col(f"{c}__next.v")
        rest = F.coalesce(edge, later) if c in directions else (edge + later) / 2
        filled[c] = F.coalesce(F.col(c), F.when(into <= LINEAR_REACH, line).otherwise(rest))
    return chunks.drop_neighbours(near.withColumns(filled), every)


def impute_mean(df: DataFrame, column: str) -> DataFrame:
    """NULL becomes the mean of the whole column."""
    mean = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column in one pass, as (column, n_null)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns])
        ).alias("r")
    ).select("r.*")
