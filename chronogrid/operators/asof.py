"""As-of join: each row with the latest earlier row of another table, for irregular times."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronogrid.operators import align
from chronogrid.session import materialise


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    ts: str,
    right_ts: str,
    values: list[str],
    tolerance_seconds: int | None = None,
    exact: bool = True,
) -> DataFrame:
    """Every row of `left` with `right_ts` and `values` of the latest row of `right` that has
    the same keys and is not later (earlier, if not `exact`).

    Rows of both tables are sorted by key and time and cut into ranges of about equal size,
    so neither a long series nor one very common key or instant stays in one task. What a
    range has to know of the ones before it is one row per key: the last row of `right`.

    Several rows of `right` at one key and time are one: the one with the largest values,
    compared in the order named (NULL is smallest). A match older than `tolerance_seconds`
    is none. Rows of `left` with a NULL key or time, and those without a match, stay, with
    NULLs; rows of `right` with a NULL key or time match nothing. Neither an empty `left`
    nor an empty `right` is special.
    """
    spark = left.sparkSession
    columns = left.columns
    known = F.lit(True)
    for name in [*on, ts]:
        known &= F.col(name).isNotNull()
    match = F.struct(F.col(right_ts).alias("at"), *(F.col(v).alias(f"v{i}") for i, v in enumerate(values)))
    keys = {name: f"_k{i}" for i, name in enumerate(on)}
    own = left.where(known).select(
        *(F.col(name).alias(k) for name, k in keys.items()), F.col(ts).alias("_ts"),
        F.lit(1 if exact else -1).alias("_side"), F.monotonically_increasing_id().alias("_row"),
        F.struct(*columns).alias("_left"),
    )
    given = right.where(F.col(right_ts).isNotNull()).select(
        *(F.col(name).alias(k) for name, k in keys.items()), F.col(right_ts).alias("_ts"), match.alias("_right")
    )
    given = given.dropna(subset=[*keys.values()])
    given = align.keep_last(given, [*keys.values(), "_ts"], [F.col("_right")]).withColumns(
        {"_side": F.lit(0), "_row": F.lit(0).cast("long")}
    )
    order = [*keys.values(), "_ts", "_side", "_row"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = own.unionByName(given, allowMissingColumns=True).repartitionByRange(ranges, *order)
    dealt = materialise(both.withColumn("_range", F.spark_partition_id()), "asof-rows")
    place = ["_range", *keys.values()]
    ends = dealt.groupBy(*place).agg(F.max_by("_right", F.when(F.col("_right").isNotNull(), F.col("_ts"))).alias("_end"))
    before = Window.partitionBy(*keys.values()).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*place, F.last("_end", ignorenulls=True).over(before).alias("_right")).where("_right IS NOT NULL")
    rows = dealt.unionByName(carried.withColumn("_first", F.lit(True)), allowMissingColumns=True)
    upto = Window.partitionBy(*place).orderBy(F.col("_first").isNull(), "_ts", "_side", "_row")
    upto = upto.rowsBetween(Window.unboundedPreceding, 0)
    met = rows.withColumn("_right", F.last("_right", ignorenulls=True).over(upto)).where("_left IS NOT NULL")
    if tolerance_seconds is not None:
        old = F.col("_right.at") < F.col("_ts") - F.make_interval(secs=F.lit(tolerance_seconds))
        met = met.withColumn("_right", F.when(~old, F.col("_right")))
    out = [F.col("_left")[c].alias(c) for c in columns]
    found = met.select(*out, F.col("_right.at").alias(right_ts), *(F.col(f"_right.v{i}").alias(v) for i, v in enumerate(values)))
    return found.unionByName(left.where(~known), allowMissingColumns=True)
