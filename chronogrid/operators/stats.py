"""Correlation, regression, tests, autocorrelation, describe and box-plot numbers."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogrid.functions.numbers import null_if_nan
from chronogrid.functions.tails import pearson_p, two_sided_p
from chronogrid.operators import align, bins, chunks


def pair(a: str, b: str) -> tuple[Column, Column]:
    """Both values where both are known, else NULL for both."""
    x, y = null_if_nan(F.col(a).cast("double")), null_if_nan(F.col(b).cast("double"))
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x), F.when(both, y)


def pearson(df: DataFrame, a: str, b: str, keys: list[str] = (), min_n: int = 0) -> DataFrame:
    """Correlation and number of pairs, by group; groups of min_n pairs or fewer go."""
    x, y = pair(a, b)
    out = df.groupBy(*keys).agg(F.corr(x, y).alias("corr"), F.count(x).alias("n"))
    return out.filter(F.col("n") > min_n) if min_n else out


def pearson_test(df: DataFrame, a: str, b: str, keys: list[str] = (), min_n: int = 0) -> DataFrame:
    """`pearson` plus the two-sided p-value."""
    return pearson(df, a, b, keys, min_n).withColumn("p_value", pearson_p(F.col("corr"), F.col("n")))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """All pairwise correlations in one pass, as (a, b, corr) with both triangles."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(*pair(a, b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("corr")) for c in columns]
    for i, (a, b) in enumerate(pairs):
        for left, right in ((a, b), (b, a)):
            cells.append(
                F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), F.col(f"c{i}").alias("corr"))
            )
    return one.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def lagged_correlation(
    df: DataFrame,
    lead: str,
    follow: str,
    max_lag: int,
    item: str = "item_id",
    ts: str = "ts",
    chunk_hours: int = chunks.CHUNK_HOURS,
) -> DataFrame:
    """Correlation of `lead` k rows earlier with `follow`, k = 0..max_lag, per series."""
    shifted = chunks.windowed(
        chunks.with_row_halo(df.select(item, ts, lead, follow), max_lag, item, ts, chunk_hours),
        max_lag,
        lambda w: {f"l{k}": F.lag(lead, k).over(w) for k in range(max_lag + 1)},
        item,
        ts,
        chunk_hours,
    )
    one = shifted.groupBy(item).agg(
        *[F.corr(*pair(f"l{k}", follow)).alias(f"c{k}") for k in range(max_lag + 1)]
    )
    cells = [F.struct(F.lit(k).cast("bigint").alias("lag"), F.col(f"c{k}").alias("corr")) for k in range(max_lag + 1)]
    return one.select(item, F.explode(F.array(*cells)).alias("r")).select(item, "r.*")


def strongest(df: DataFrame, key: str, keys: list[str] = ()) -> DataFrame:
    """The key with the largest absolute correlation; the smaller key wins a tie."""
    best = F.max_by(F.struct(key, "corr"), F.struct(F.abs("corr"), -F.col(key)))
    known = df.filter(F.col("corr").isNotNull())
    return known.groupBy(*keys).agg(best.alias("r")).filter("r IS NOT NULL").select(*keys, "r.*")


def autocorrelation(
    df: DataFrame,
    value: str,
    max_lag: int,
    item: str = "item_id",
    ts: str = "ts",
    chunk_hours: int = chunks.CHUNK_HOURS,
) -> DataFrame:
    """Autocorrelation per series: lagged products over the total variation.

    Rows are taken in time order. For each lag the pairs' means and co-moment come from
    one pass; they are merged between tasks as such, never as sums of raw products, so a
    large level of the series costs no digits: the product about the series mean is the
    co-moment plus what the pairs' means lie off it.
    """
    lags = range(max_lag + 1)
    known = df.select(item, ts, F.col(value).cast("double").alias("x")).filter("x IS NOT NULL")
    shifted = chunks.windowed(
        chunks.with_row_halo(known, max_lag, item, ts, chunk_hours),
        max_lag,
        lambda w: {f"l{k}": F.lag("x", k).over(w) for k in lags},
        item,
        ts,
        chunk_hours,
    )
    sums = shifted.groupBy(item).agg(
        F.avg("x").alias("m"),
        F.count("x").alias("n"),
        *[F.covar_pop("x", f"l{k}").alias(f"c{k}") for k in lags],
        *[F.avg(F.when(F.col(f"l{k}").isNotNull(), F.col("x"))).alias(f"x{k}") for k in lags],
        *[F.avg(f"l{k}").alias(f"y{k}") for k in lags],
    )
    m, n = F.col("m"), F.col("n")
    product = [F.col(f"c{k}") + (F.col(f"x{k}") - m) * (F.col(f"y{k}") - m) for k in lags]
    acf = [F.try_divide((n - k) * product[k], n * product[0]) for k in lags]
    cells = [F.struct(F.lit(k).cast("bigint").alias("lag"), acf[k].alias("acf")) for k in lags]
    return sums.select(item, "n", F.explode(F.array(*cells)).alias("r")).select(item, "n", "r.*")


def _durbin_levinson(rho: np.ndarray) -> np.ndarray:
    """Partial autocorrelations from autocorrelations with rho[0] = 1."""
    out = np.zeros(len(rho))
    out[0] = 1.0
    phi = np.zeros(0)
    for k in range(1, len(rho)):
        top = rho[k] - phi @ rho[k - 1 : 0 : -1] if k > 1 else rho[1]
        bottom = 1.0 - phi @ rho[1:k] if k > 1 else 1.0
        last = top / bottom
        phi = np.append(phi - last * phi[::-1], last)
        out[k] = last
    return out


def partial_autocorrelation(
    df: DataFrame, value: str, max_lag: int, item: str = "item_id", ts: str = "ts"
) -> DataFrame:
    """Partial autocorrelation (Yule-Walker) with a 95 % band, per series.

    Only max_lag + 1 numbers per series reach Python.
    """
    acf = autocorrelation(df, value, max_lag, item, ts)
    item_type = df.schema[item].dataType.simpleString()

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("lag")
        band = 1.959963984540054 / np.sqrt(rows["n"].iloc[0])
        return pd.DataFrame(
            {
                item: rows[item].to_numpy(),
                "lag": rows["lag"].to_numpy(),
                "pacf": _durbin_levinson(rows["acf"].to_numpy()),
                "band": band,
            }
        )

    return acf.groupBy(item).applyInPandas(
        solve, f"{item} {item_type}, lag bigint, pacf double, band double"
    )


def welch_test(df: DataFrame, value: str, flag: str, keys: list[str] = ()) -> DataFrame:
    """Unequal-variance t-test of flag = 0 against flag = 1, with the change in percent."""
    def part(f: int, name: str) -> list[Column]:
        x = F.when(F.col(flag) == f, F.col(value).cast("double"))
        return [F.avg(x).alias(f"mean_{name}"), F.var_samp(x).alias(f"var_{name}"), F.count(x).alias(f"n_{name}")]

    one = df.groupBy(*keys).agg(*part(0, "before"), *part(1, "during"))
    a = F.try_divide(F.col("var_before"), F.col("n_before"))
    b = F.try_divide(F.col("var_during"), F.col("n_during"))
    t = F.try_divide(F.col("mean_before") - F.col("mean_during"), F.sqrt(a + b))
    freedom = F.try_divide(
        (a + b) * (a + b),
        F.try_divide(a * a, F.col("n_before") - 1) + F.try_divide(b * b, F.col("n_during") - 1),
    )
    change = F.try_divide((F.col("mean_during") - F.col("mean_before")) * 100, F.col("mean_before"))
    return (
        one.withColumns({"pct_change": change, "t_stat": t, "freedom": freedom})
        .withColumn("p_value", two_sided_p(F.col("t_stat"), F.col("freedom")))
        .drop("var_before", "var_during")
    )


def ols_line(df: DataFrame, x: str, y: str, keys: list[str] = ()) -> DataFrame:
    """Least-squares line with what its confidence band needs."""
    a, b = pair(x, y)
    return df.groupBy(*keys).agg(
        F.regr_slope(b, a).alias("slope"),
        F.regr_intercept(b, a).alias("intercept"),
        F.regr_r2(b, a).alias("r2"),
        F.regr_avgx(b, a).alias("mean_x"),
        F.regr_sxx(b, a).alias("sxx"),
        F.regr_syy(b, a).alias("syy"),
        F.count(a).alias("n"),
        F.min(a).alias("min_x"),
        F.max(a).alias("max_x"),
    )


def ols_band(df: DataFrame, x: str, y: str, points: int = 5) -> DataFrame:
    """The fitted line at evenly spaced x with the standard error of the fit."""
    line = ols_line(df, x, y)
    step = (F.col("max_x") - F.col("min_x")) / F.lit(points - 1)
    at = line.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(
        "x", F.col("min_x") + step * F.col("i")
    )
    residual = F.sqrt(F.col("syy") * (1 - F.col("r2")) / (F.col("n") - 2))
    off = F.col("x") - F.col("mean_x")
    return at.select(
        F.col("i").cast("bigint").alias("i"),
        "x",
        (F.col("intercept") + F.col("slope") * F.col("x")).alias("fit"),
        (residual * F.sqrt(1 / F.col("n") + off * off / F.col("sxx"))).alias("std_error"),
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    long = bins.to_long(df, [], columns)
    basic = long.groupBy("feature").agg(
        F.count("v").alias("count"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    edges = bins.exact_quantiles(df, [], columns, [0.25, 0.5, 0.75])
    return basic.join(edges.drop("n"), "feature").select(
        "feature",
        "count",
        "mean",
        "std",
        "min",
        F.col("edges")[0].alias("p25"),
        F.col("edges")[1].alias("p50"),
        F.col("edges")[2].alias("p75"),
        "max",
    )


def box_numbers(df: DataFrame, value: str, flag: str) -> DataFrame:
    """Quartiles, whiskers at the extreme values within 1.5 IQR, and outlier count.

    Groups are the values of a flag, so their number is bounded.
    """
    keys = [flag]
    q = bins.quantile_columns(df, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, True)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    v = F.col(value).cast("double")
    near = (v >= F.col("q1") - reach) & (v <= F.col("q3") + reach)
    return (
        df.filter(F.col(value).isNotNull())
        .join(F.broadcast(q.drop("n")), keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(near, v)).alias("whisker_low"),
            F.max(F.when(near, v)).alias("whisker_high"),
            F.count_if(~near).alias("n_outliers"),
        )
    )


def hashed_sample(df: DataFrame, key: list[str], n: int, seed: int) -> DataFrame:
    """A repeatable sample of n rows: the smallest seeded key hashes."""
    order = F.xxhash64(F.lit(seed), *key)
    return df.orderBy(order, *key).limit(n)


def max_normalised(df: DataFrame, columns: list[str], item: str = "item_id") -> DataFrame:
    """Columns divided by their series maximum, as `{c}_norm`."""
    tops = df.groupBy(item).agg(*[F.max(c).alias(f"_{c}") for c in columns])
    return (
        align.join_summary(df, tops, [item])
        .withColumns({f"{c}_norm": F.try_divide(F.col(c), F.col(f"_{c}")) for c in columns})
        .drop(*[f"_{c}" for c in columns])
    )


def value_counts(df: DataFrame, column: str, top: int) -> DataFrame:
    """Most frequent values; the smaller value wins a tie."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
        .limit(top)
    )
