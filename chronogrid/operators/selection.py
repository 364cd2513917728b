"""Exact order statistics by radix refinement over the bits of a double.

A double becomes a whole number of the same order (its bits). Each pass counts, for every
group, how many numbers share a wanted prefix and have each next digit, and follows the
wanted ranks into one digit; after the last pass a rank's number is known bit by bit. No
group is gathered or sorted, and every group of any size goes the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bits of a digit in each pass. A histogram has at most 2^22 rows per prefix, whatever the
# number of rows.
DIGITS = (22, 21, 21)
SALTS = 16  # tasks that the rows of one group and prefix spread over in a join

MANTISSA = 1 << 52
LEAST_NORMAL = 2.0**-1022
LARGEST = 1.7976931348623157e308
HALF_SUBNORMAL = 2.0**537  # two of these factors lift the least subnormal to 1


def with_bits(df: DataFrame, value: str, name: str = "bits") -> DataFrame:
    """Add the bits of a double as a long of the same order; -0 equals 0, NaN is NULL.

    Exact: scaling by a power of two loses nothing, and the exponent that a logarithm
    suggests is corrected by comparison. The steps are columns of their own, so that none
    is computed twice.
    """
    size = F.abs(F.col(value).cast("double"))
    finite = F.least(F.greatest(size, F.lit(LEAST_NORMAL)), F.lit(LARGEST))  # NaN is above infinity here
    guess = F.least(F.floor(F.log2(finite)).cast("int"), F.lit(1023))
    steps = df.withColumn("_exponent", guess).withColumn("_fraction", size / F.pow(F.lit(2.0), F.col("_exponent")))
    low, high = F.col("_fraction") < 1, F.col("_fraction") >= 2
    steps = steps.withColumns(
        {
            "_exponent": F.col("_exponent") + F.when(low, -1).when(high, 1).otherwise(0),
            "_fraction": F.col("_fraction") * F.when(low, 2.0).when(high, 0.5).otherwise(1.0),
        }
    )
    fraction = ((F.col("_fraction") - 1) * float(MANTISSA)).cast("long")
    normal = (F.col("_exponent") + 1023).cast("long") * MANTISSA + fraction
    tiny = (size * HALF_SUBNORMAL * HALF_SUBNORMAL).cast("long")
    bits = (
        F.when(size == float("inf"), F.lit(2047 * MANTISSA))
        .when(size >= LEAST_NORMAL, normal)
        .otherwise(tiny)
    )
    known = steps.withColumn(name, F.when(~F.isnan(value), bits)).drop("_exponent", "_fraction")
    return known.withColumn(name, F.when(F.col(value) < 0, -F.col(name)).otherwise(F.col(name)))


def double_of(bits: Column) -> Column:
    """The double whose bits `with_bits` gives."""
    size = F.abs(bits)
    exponent = F.shiftright(size, 52).cast("int")
    fraction = size.bitwiseAND(F.lit(MANTISSA - 1)).cast("double")
    normal = (fraction / float(MANTISSA) + 1) * F.pow(F.lit(2.0), exponent - 1023)
    tiny = fraction / HALF_SUBNORMAL / HALF_SUBNORMAL
    value = F.when(exponent == 2047, F.lit(float("inf"))).when(exponent > 0, normal).otherwise(tiny)
    return F.when(bits < 0, -value).otherwise(value)


def _digit(shift: int, width: int, bits: str) -> Column:
    """The digit of `width` bits above the lowest `shift`; the first one carries the sign."""
    high = F.shiftright(F.col(bits), shift)
    return high if shift + width == 64 else high.bitwiseAND(F.lit((1 << width) - 1))


def _follow(counts: DataFrame, by: list[str], width: int) -> DataFrame:
    """Which digit each wanted rank falls into, and its rank among the numbers there.

    `counts` has one row per group, prefix and digit, with `c` and the wanted `ranks` of
    the prefix as structs (name, rank).
    """
    upto = F.sum("c").over(Window.partitionBy(*by, "prefix").orderBy("digit"))
    cut = counts.withColumn("upto", upto).withColumn("under", F.col("upto") - F.col("c"))
    inside = F.filter("ranks", lambda r: (r["rank"] >= F.col("under")) & (r["rank"] < F.col("upto")))
    moved = F.transform(inside, lambda r: F.struct(r["name"].alias("name"), (r["rank"] - F.col("under")).alias("rank")))
    prefix = F.shiftleft(F.col("prefix"), width) + F.col("digit")
    return cut.select(*by, "n", prefix.alias("prefix"), moved.alias("ranks")).where(F.size("ranks") > 0)


def select_ranks(long: DataFrame, by: list[str], wanted: Column, value: str = "v", few_groups: bool = False) -> DataFrame:
    """The numbers at the wanted ranks of each group, as (by, n, name, v).

    `wanted` is an array of structs (name int, rank long) made from the group's number of
    rows `n`; rank 0 is the smallest. NULL and NaN are not counted, equal numbers each
    have a rank of their own, and a rank outside the group gives no row. `few_groups`
    states that the groups are few by construction (columns, flags, hours): the wanted
    prefixes then travel to the rows. Otherwise rows and prefixes are joined by group,
    prefix and a salt.
    """
    known = long.select(*by, F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    rows = with_bits(known, "v").select(*by, "bits")
    shift = 64 - DIGITS[0]
    counts = rows.groupBy(*by, _digit(shift, DIGITS[0], "bits").alias("digit")).agg(F.count("*").alias("c"))
    whole = Window.partitionBy(*by, "prefix")
    counts = counts.withColumn("prefix", F.lit(0).cast("long")).withColumn("n", F.sum("c").over(whole))
    found = _follow(counts.withColumn("ranks", wanted), by, DIGITS[0])
    for width in DIGITS[1:]:
        own = F.shiftright("bits", shift)
        shift -= width
        digit = _digit(shift, width, "bits").alias("digit")
        if few_groups:
            met = rows.withColumn("prefix", own).join(F.broadcast(found), [*by, "prefix"])
        else:
            salt = F.pmod(F.xxhash64("bits"), F.lit(SALTS)).cast("int")
            spread = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            met = rows.withColumns({"prefix": own, "salt": salt}).join(spread, [*by, "prefix", "salt"])
        counts = met.groupBy(*by, "prefix", digit).agg(
            F.count("*").alias("c"), F.any_value("n").alias("n"), F.any_value("ranks").alias("ranks")
        )
        found = _follow(counts, by, width)
    return found.select(*by, "n", F.explode("ranks.name").alias("name"), double_of(F.col("prefix")).alias("v"))


def quantiles(long: DataFrame, by: list[str], probs: list[float], value: str = "v", few_groups: bool = False) -> DataFrame:
    """Quantiles with linear interpolation, as (by, n, edges); see `select_ranks`."""
    place = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    sides = [F.floor(at) for at in place] + [F.ceil(at) for at in place]
    wanted = F.array(*(F.struct(F.lit(i).alias("name"), at.cast("long").alias("rank")) for i, at in enumerate(sides)))
    picked = select_ranks(long, by, wanted, value, few_groups)
    got = picked.groupBy(*by, "n").agg(F.map_from_entries(F.collect_list(F.struct("name", "v"))).alias("at"))

    def edge(i: int) -> Column:
        low, high = F.col("at")[i], F.col("at")[len(probs) + i]
        part = place[i] - F.floor(place[i])
        return F.when(low == high, low).otherwise(low + (high - low) * part)

    return got.select(*by, "n", F.array(*(edge(i) for i in range(len(probs)))).alias("edges"))
