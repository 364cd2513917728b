"""Lags, differences, rolling statistics, fills and runs over time-ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from chronogrid.operators import align, chunks


def lag(value: Column, k: int, w: WindowSpec) -> Column:
    """Value k rows earlier."""
    return F.lag(value, k).over(w)


def difference(value: Column, k: int, w: WindowSpec) -> Column:
    """Change over k rows; k = 24 or 168 gives the seasonal difference."""
    return value - F.lag(value, k).over(w)


def rolling_mean(column: str, rows: int, full: bool = False) -> Column:
    """Mean of the last rows; with `full`, NULL until every row in the frame is known.

    Needs the column and length in `means` or `spread` of `chunks.windowed`.
    """
    value = F.col(chunks.rolling_average(column, rows))
    return F.when(F.col(chunks.rolling_known(column, rows)) == rows, value) if full else value


def rolling_std(column: str, rows: int, full: bool = False) -> Column:
    """Sample standard deviation of the last rows; a single value gives NULL.

    Needs the column and length in `spread` of `chunks.windowed`. With `full`, NULL
    until every row in the frame is known.
    """
    value = F.col(chunks.rolling_spread(column, rows))
    return F.when(F.col(chunks.rolling_known(column, rows)) == rows, value) if full else value


def forward_fill(df: DataFrame, columns: list[str], **keys: str) -> DataFrame:
    """Replace NULL by the latest earlier value."""
    near = chunks.neighbours(df, columns, **keys)
    filled = {c: F.coalesce(F.col(c), F.col(f"{c}__prev.v")) for c in columns}
    return chunks.drop_neighbours(near.withColumns(filled), columns)


def backward_fill(df: DataFrame, columns: list[str], **keys: str) -> DataFrame:
    """Replace NULL by the earliest later value."""
    near = chunks.neighbours(df, columns, **keys)
    filled = {c: F.coalesce(F.col(c), F.col(f"{c}__next.v")) for c in columns}
    return chunks.drop_neighbours(near.withColumns(filled), columns)


def fill_both_ways(df: DataFrame, columns: list[str], **keys: str) -> DataFrame:
    """Forward fill, then backward fill for what leads the first value."""
    near = chunks.neighbours(df, columns, **keys)
    filled = {
        c: F.coalesce(F.col(c), F.col(f"{c}__prev.v"), F.col(f"{c}__next.v")) for c in columns
    }
    return chunks.drop_neighbours(near.withColumns(filled), columns)


def fill_when_probe_missing(
    df: DataFrame, columns: list[str], probe: str, item: str = "item_id", ts: str = "ts"
) -> DataFrame:
    """Fill both ways in the series whose probe column has a NULL somewhere.

    Other series are returned untouched, also where a non-probe column has NULLs.
    """
    near = chunks.neighbours(
        df, columns, item, ts, anywhere={"_fill": F.col(probe).isNull()}
    )
    filled = {
        c: F.when(
            F.col("_fill"),
            F.coalesce(F.col(c), F.col(f"{c}__prev.v"), F.col(f"{c}__next.v")),
        ).otherwise(F.col(c))
        for c in columns
    }
    return chunks.drop_neighbours(near.withColumns(filled), columns).drop("_fill")


def runs(
    df: DataFrame, gap_hours: int, item: str = "item_id", ts: str = "ts"
) -> DataFrame:
    """Contiguous runs of rows: a new run starts after a pause of more than gap_hours.

    A run start is a row with no earlier row within the gap, which the halo shows;
    the start is then carried forward as the run's name.
    """
    starts = chunks.windowed(
        df.select(item, ts),
        gap_hours,
        lambda w: {"_prev": F.lag(ts).over(w)},
        item,
        ts,
    ).withColumn(
        "_start",
        F.when(
            F.col("_prev").isNull()
            | (F.unix_seconds(ts) - F.unix_seconds("_prev") > gap_hours * 3600),
            F.col(ts),
        ),
    )
    named = forward_fill(starts.select(item, ts, "_start"), ["_start"], item=item, ts=ts)
    return (
        named.groupBy(item, F.col("_start").alias("run_start"))
        .agg(F.max(ts).alias("run_end"), F.count("*").alias("n_rows"))
    )


def tail(
    df: DataFrame, skip: int, take: int | None, item: str = "item_id", ts: str = "ts"
) -> DataFrame:
    """Rows by hours from the end of a gap-free series.

    `skip` hours are left out at the end; `take` of the hours before are kept, or
    all of them when it is None.
    """
    ends = df.groupBy(item).agg(F.max(ts).alias("_end"))
    back = (F.unix_seconds("_end") - F.unix_seconds(ts)) / F.lit(3600)
    keep = back >= skip
    if take is not None:
        keep = keep & (back < skip + take)
    return align.join_summary(df, ends, [item]).filter(keep).drop("_end")


