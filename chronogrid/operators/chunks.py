"""Ordered work on long series, split by time.

A window over a whole series would sort it in one task. Here every series is cut
into chunks of `chunk_hours`; rows near the end of a chunk are repeated in the
next one as its halo, so a bounded look-back sees exactly the rows it would see
in the uncut series. Unbounded look-ups (nearest known value) stay inside the
chunk and take what lies beyond from a one-row-per-chunk summary.

All functions expect at most one row per series and hour (`to_panel`, a grouping by
hour, or `keep_first` see to that), which bounds a chunk whatever the series.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

CHUNK_HOURS = 8192
# Deviations below this share of the mean are rounding noise of equal values.
ROUNDING = 4 * 2.220446049250313e-16
CHUNK = "_chunk"
GHOST = "_ghost"


def chunk_of(ts: Column, chunk_hours: int = CHUNK_HOURS) -> Column:
    """Number of the time chunk a timestamp falls into."""
    return F.floor(F.unix_seconds(ts) / F.lit(chunk_hours * 3600)).cast("bigint")


def chunk_start(chunk: Column, chunk_hours: int = CHUNK_HOURS) -> Column:
    """First instant of a chunk."""
    return F.timestamp_seconds(chunk * F.lit(chunk_hours * 3600))


def with_halo(
    df: DataFrame, halo: int, ts: str = "ts", chunk_hours: int = CHUNK_HOURS
) -> DataFrame:
    """Add the chunk number, repeating the last `halo` hours in the next chunk."""
    if halo > chunk_hours:
        raise ValueError(f"look-back {halo} h exceeds the chunk of {chunk_hours} h")
    own = chunk_of(F.col(ts), chunk_hours)
    if halo == 0:
        return df.withColumns({CHUNK: own, GHOST: F.lit(False)})
    into = F.unix_seconds(F.col(ts)) - own * F.lit(chunk_hours * 3600)
    near_end = into >= F.lit((chunk_hours - halo) * 3600)
    return df.withColumn(
        CHUNK, F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own)))
    ).withColumn(GHOST, F.col(CHUNK) != own)


def chunk_window(item: str = "item_id", ts: str = "ts") -> WindowSpec:
    """Time order inside one chunk of one series."""
    return Window.partitionBy(item, CHUNK).orderBy(ts)


def rolling_average(column: str, rows: int) -> str:
    """Name of the rolling mean `windowed` keeps for a column."""
    return f"{column}__mn{rows}"


def rolling_spread(column: str, rows: int) -> str:
    """Name of the rolling sample deviation `windowed` keeps for a column."""
    return f"{column}__sd{rows}"


def rolling_known(column: str, rows: int) -> str:
    """Name of the number of known values behind a rolling mean or deviation."""
    return f"{column}__sn{rows}"


def _field(column: str, rows: int, name: str) -> str:
    return f"_{column}_{rows}_{name}"


def _merged(near: dict[str, Column], far: dict[str, Column]) -> dict[str, Column]:
    """Moments of two neighbouring frames together: counts, sums or means, squares."""
    n = near["n"] + far["n"]
    if "s" in near:
        return {"n": n, "s": near["s"] + far["s"]}
    gap = far["m"] - near["m"]
    share = F.coalesce(F.try_divide(far["n"], n), F.lit(0.0))
    return {
        "n": n,
        "m": F.when(near["n"] > 0, near["m"] + gap * share).otherwise(far["m"]),
        "q": near["q"] + far["q"] + gap * gap * near["n"] * share,
    }


def _with_rolling(
    df: DataFrame, means: dict[str, list[int]], spread: dict[str, list[int]], item: str, ts: str
) -> DataFrame:
    """Add mean, count and (for `spread`) sample deviation over the last rows of a chunk.

    Moments over a short frame come from the rows; those over twice the rows merge a
    frame with the one before it, and any length is a sum of such frames. So the cost
    per row grows with the logarithm of the length, all steps share one sort, and no
    large value leaves a trace outside the frames that hold it, as it would in a
    difference of running sums. NaN counts as missing; an infinite value makes the
    results of its own frames infinite or NaN.
    """
    w = chunk_window(item, ts)
    lengths = {c: sorted({*means.get(c, []), *spread.get(c, [])}) for c in [*means, *spread]}
    base = {c: 24 if all(n % 24 == 0 for n in rows) else 1 for c, rows in lengths.items()}
    fields = {c: ["n", "m", "q"] if c in spread else ["n", "s"] for c in lengths}
    kept = df.columns

    def state(c: str, rows: int) -> dict[str, Column]:
        return {f: F.col(_field(c, rows, f)) for f in fields[c]}

    def step(out: DataFrame, wanted: list[tuple[str, int, int, int]]) -> DataFrame:
        """Merge, for each (column, rows, part, name), the frame of `rows` rows with the
        frame of `part` rows before it."""
        lagged = {
            f"_lag{i}_{f}": F.coalesce(F.lag(value, rows).over(w), F.lit(0).cast("double"))
            for i, (c, rows, part, _) in enumerate(wanted)
            for f, value in state(c, part).items()
        }
        made = {}
        for i, (c, rows, _, name) in enumerate(wanted):
            far = {f: F.col(f"_lag{i}_{f}") for f in fields[c]}
            made |= {_field(c, name, f): v for f, v in _merged(state(c, rows), far).items()}
        return out.withColumns(lagged).withColumns(made).drop(*lagged)

    first = {}
    for c in lengths:
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        if base[c] == 1:
            made = {"n": x.isNotNull().cast("double"), "s": F.coalesce(x, F.lit(0.0)), "m": F.coalesce(x, F.lit(0.0)), "q": F.lit(0.0)}
        else:
            frame = w.rowsBetween(1 - base[c], 0)
            n = F.count(x).over(frame).cast("double")
            made = {"n": n, "s": F.coalesce(F.sum(x).over(frame), F.lit(0.0))}
            if c in spread:
                made |= {"m": F.coalesce(F.avg(x).over(frame), F.lit(0.0)), "q": F.coalesce(F.var_pop(x).over(frame) * n, F.lit(0.0))}
        first |= {_field(c, base[c], f): made[f] for f in fields[c]}
    out = df.withColumns(first)
    power = 1
    while wide := [(c, power * base[c], power * base[c], 2 * power * base[c]) for c in lengths if 2 * power * base[c] <= lengths[c][-1]]:
        out = step(out, wide)
        power *= 2
    # Each length as frames of falling powers of two, one behind the other.
    todo = []
    for c, all_rows in lengths.items():
        for rows in all_rows:
            units = rows // base[c]
            parts = [base[c] << k for k in reversed(range(units.bit_length())) if units >> k & 1]
            todo.append((c, parts))
    place = 1
    while wide := [(c, sum(parts[:place]), parts[place], sum(parts[: place + 1])) for c, parts in todo if len(parts) > place]:
        seen = {(c, name): (c, rows, part, name) for c, rows, part, name in wide if _field(c, name, "n") not in out.columns}
        if seen:
            out = step(out, list(seen.values()))
        place += 1
    results = {}
    for c, all_rows in lengths.items():
        for rows in all_rows:
            got = state(c, rows)
            mean = got["m"] if "m" in got else F.try_divide(got["s"], got["n"])
            results[rolling_average(c, rows)] = F.when(got["n"] > 0, mean)
            results[rolling_known(c, rows)] = got["n"].cast("bigint")
            if c in spread:
                noise = F.abs(got["m"]) * F.lit(ROUNDING) * F.lit(float(max(rows, 16)) ** 0.5)
                deviation = F.when(got["q"] > got["n"] * noise * noise, F.sqrt(got["q"] / (got["n"] - 1))).otherwise(F.when(F.isnan(got["q"]), got["q"]).otherwise(0.0))
                results[rolling_spread(c, rows)] = F.when(got["n"] > 1, deviation)
    return out.select(*kept, *[v.alias(k) for k, v in results.items()])


def windowed(
    df: DataFrame,
    halo: int,
    build: Callable[[WindowSpec], dict[str, Column]],
    item: str = "item_id",
    ts: str = "ts",
    chunk_hours: int = CHUNK_HOURS,
    means: dict[str, list[int]] | None = None,
    spread: dict[str, list[int]] | None = None,
) -> DataFrame:
    """Add the columns `build` makes from the chunk window.

    Frames that already carry a halo (see `hourly_grid`) are used as they are, so
    gap filling and windows share one shuffle. `means` and `spread` name the columns
    and frame lengths for which rolling means, and means with deviations, are at hand
    for `build` (see `_with_rolling`).
    """
    source = df if GHOST in df.columns else with_halo(df.drop(CHUNK), halo, ts, chunk_hours)
    before = source.columns
    if means or spread:
        source = _with_rolling(source, means or {}, spread or {}, item, ts)
    made = [c for c in source.columns if c not in before]
    out = source.withColumns(build(chunk_window(item, ts)))
    return out.filter(~F.col(GHOST)).drop(CHUNK, GHOST, *made)


def with_row_halo(
    df: DataFrame, halo: int, item: str = "item_id", ts: str = "ts", chunk_hours: int = CHUNK_HOURS
) -> DataFrame:
    """Cut series by row number instead of time, for look-backs that count rows.

    Where hours are missing, `halo` rows may reach back any number of hours. Rows are
    numbered by chunk first; the chunk sizes (one row each) give what lies before a
    chunk. Blocks of `chunk_hours` rows then get the last `halo` rows of the block
    before. `windowed` takes the frame as it is.
    """
    if halo > chunk_hours:
        raise ValueError(f"look-back of {halo} rows exceeds the block of {chunk_hours} rows")
    chunked = df.drop(CHUNK, GHOST).withColumn(CHUNK, chunk_of(F.col(ts), chunk_hours)).repartition(item, CHUNK)
    earlier = Window.partitionBy(item).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    sizes = chunked.groupBy(item, CHUNK).agg(F.count("*").alias("_size"))
    sizes = sizes.select(item, CHUNK, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = chunked.withColumn("_row", F.row_number().over(chunk_window(item, ts)) - 1)
    at = F.col("_before") + F.col("_row")
    own = F.floor(at / F.lit(chunk_hours)).cast("bigint")
    near_end = at % chunk_hours >= chunk_hours - halo
    copies = F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own)))
    numbered = inside.join(sizes, [item, CHUNK]).withColumn("_own", own).withColumn("_block", copies)
    return numbered.withColumns({CHUNK: F.col("_block"), GHOST: F.col("_block") != F.col("_own")}).drop(
        "_before", "_row", "_own", "_block"
    )


def neighbours(
    df: DataFrame,
    columns: list[str],
    item: str = "item_id",
    ts: str = "ts",
    chunk_hours: int = CHUNK_HOURS,
    anywhere: dict[str, Column] | None = None,
) -> DataFrame:
    """Nearest known value at or before, and after, each row, however far away.

    Adds `{c}__prev` and `{c}__next`, each a struct (ts, v) or NULL. What lies
    beyond a chunk reaches it as one extra row, sorted before the chunk's own rows.
    The rows are shuffled once, by (item, chunk): the summary reuses that exchange
    where `columns` covers the frame, and the union keeps the layout, which a join
    with its NULL filters on one side would not. A frame that still carries its
    chunk (see `hourly_grid`) is not shuffled again.

    `anywhere` adds named flags that tell whether a condition holds in any row of
    the series.
    """
    anywhere = anywhere or {}
    kept = [c for c in df.columns if c != CHUNK]
    chunked = df
    if CHUNK not in df.columns:
        chunked = df.withColumn(CHUNK, chunk_of(F.col(ts), chunk_hours)).repartition(item, CHUNK)
    known_ts = {c: F.when(F.col(c).isNotNull(), F.col(ts)) for c in columns}
    summary = chunked.groupBy(item, CHUNK).agg(
        *[F.min(known_ts[c]).alias(f"{c}__first_ts") for c in columns],
        *[F.min_by(c, known_ts[c]).alias(f"{c}__first_v") for c in columns],
        *[F.max(known_ts[c]).alias(f"{c}__last_ts") for c in columns],
        *[F.max_by(c, known_ts[c]).alias(f"{c}__last_v") for c in columns],
        *[F.max(condition).alias(name) for name, condition in anywhere.items()],
    )

    def point(c: str, side: str) -> Column:
        at = F.col(f"{c}__{side}_ts")
        return F.when(at.isNotNull(), F.struct(at.alias("ts"), F.col(f"{c}__{side}_v").alias("v")))

    ends = summary.select(
        item,
        CHUNK,
        *[point(c, side).alias(f"{c}__{side}") for c in columns for side in ("first", "last")],
        *anywhere,
    )
    before = Window.partitionBy(item).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        item,
        CHUNK,
        F.lit(0).alias("_own"),
        *[F.last(f"{c}__last", ignorenulls=True).over(before).alias(f"{c}__in_prev") for c in columns],
        *[
            F.expr(
                f"lead(`{c}__first`) IGNORE NULLS OVER (PARTITION BY `{item}` ORDER BY {CHUNK})"
            ).alias(f"{c}__in_next")
            for c in columns
        ],
        *[F.max(name).over(Window.partitionBy(item)).alias(name) for name in anywhere],
    )
    own = chunked.select(
        *kept,
        CHUNK,
        F.lit(1).alias("_own"),
        *[
            F.when(F.col(c).isNotNull(), F.struct(F.col(ts).alias("ts"), F.col(c).alias("v"))).alias(f"{c}__pt")
            for c in columns
        ],
    )
    rows = own.unionByName(carry.repartition(item, CHUNK), allowMissingColumns=True)
    upto = (
        Window.partitionBy(item, CHUNK)
        .orderBy("_own", ts)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = {}
    for c in columns:
        found[f"{c}__prev"] = F.coalesce(
            F.last(f"{c}__pt", ignorenulls=True).over(upto), F.first(f"{c}__in_prev").over(upto)
        )
        found[f"{c}__next"] = F.coalesce(
            F.expr(
                f"lead(`{c}__pt`) IGNORE NULLS OVER (PARTITION BY `{item}`, {CHUNK} ORDER BY _own, `{ts}`)"
            ),
            F.first(f"{c}__in_next").over(upto),
        )
    for name in anywhere:
        found[name] = F.first(name).over(upto)
    return rows.withColumns(found).filter("_own = 1").select(*kept, *found)


def drop_neighbours(df: DataFrame, columns: list[str]) -> DataFrame:
    """Remove the columns `neighbours` added."""
    return df.drop(*[f"{c}__{side}" for c in columns for side in ("prev", "next")])
