"""Error tables, point metrics and error reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronogrid.functions import numbers
from chronogrid.operators import align, bins, chunks, features, stats

# Smallest denominator of the mean absolute percentage error (double epsilon).
EPSILON = 2.220446049250313e-16

# Weather features of the error profile, and the quartile labels.
PROFILE_FEATURES = [
    "temperature", "humidity", "precipitation", "wind_speed", "cloud_cover",
    "solar_radiation", "direct_radiation", "diffuse_radiation",
    "direct_normal_irradiance", "global_irradiance", "terrestrial_radiation",
]
TEMPERATURE_LABELS = ["Very Cold", "Cold", "Warm", "Very Warm"]
PRICE_LABELS = ["Very Low", "Low", "High", "Very High"]
PRICE_QUARTILES = ["Q1 (Low)", "Q2", "Q3", "Q4 (High)"]


def with_errors(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Error and calendar columns on the rows where `actual` and `predicted` are known."""
    both = df.filter(F.col("actual").isNotNull() & F.col("predicted").isNotNull())
    return features.temporal(
        both.withColumns(numbers.error_columns(F.col("actual"), F.col("predicted"))), ts
    )


def error_table(
    actual: DataFrame,
    forecast: DataFrame,
    target: str,
    covariates: list[str] = (),
    item: str = "item_id",
    ts: str = "ts",
) -> DataFrame:
    """Actual beside forecast by (item, ts), with errors, target step and covariates.

    `actual` is a gap-free series; `forecast` has `predicted`.
    """
    with_step = chunks.windowed(
        actual.select(item, ts, F.col(target).alias("actual"), *covariates),
        24,
        lambda w: {"actual_diff": F.col("actual") - F.lag("actual").over(w)},
        item,
        ts,
    )
    return with_errors(with_step.join(forecast.select(item, ts, "predicted"), [item, ts]), ts)


def naive_error_table(
    series: DataFrame, target: str, shift: int, item: str = "item_id", ts: str = "ts"
) -> DataFrame:
    """Errors of the value `shift` hours earlier as forecast.

    On a gap-free series that value is a lag, so forecast and target step come from
    one window and need no join.
    """
    y = F.col(target)
    both = chunks.windowed(
        series,
        shift,
        lambda w: {"predicted": F.lag(y, shift).over(w), "actual_diff": y - F.lag(y).over(w)},
        item,
        ts,
    )
    return with_errors(both.withColumnRenamed(target, "actual"), ts)


def metric_columns(actual: Column, predicted: Column) -> dict[str, Column]:
    """RMSE, MAE, MAPE, R2, mean error and mean percentage error as aggregates."""
    e = predicted - actual
    return {
        "rmse": F.sqrt(F.avg(e * e)),
        "mae": F.avg(F.abs(e)),
        "mape": F.avg(F.abs(e) / F.greatest(F.abs(actual), F.lit(EPSILON))) * 100,
        "r2": 1 - F.try_divide(F.sum(e * e), F.var_pop(actual) * F.count(actual)),
        "mean_error": F.avg(e),
        "mean_pct_error": F.avg(F.try_divide(e * 100, actual)),
        "n": F.count(e),
    }


def metrics(errors: DataFrame, keys: list[str] = ()) -> DataFrame:
    """All point metrics, by group."""
    columns = metric_columns(F.col("actual"), F.col("predicted"))
    return errors.groupBy(*keys).agg(*[c.alias(name) for name, c in columns.items()])


def temporal_patterns(errors: DataFrame, value: str = "error") -> DataFrame:
    """Mean and root mean square of the error by hour, weekday and weekend flag."""
    return align.labelled_metrics(errors, ["hour", "dayofweek", "is_weekend"], value)


def pattern_table(errors: DataFrame, value: str = "error") -> DataFrame:
    """`temporal_patterns` side by side on the integer label."""
    dimensions = ["hour", "dayofweek", "is_weekend"]
    return align.label_alignment(temporal_patterns(errors, value), dimensions)


def best_and_worst_hour(errors: DataFrame, value: str = "error") -> DataFrame:
    """Hour with the smallest and the largest mean; the earlier hour wins a tie."""
    by_hour = errors.groupBy("hour").agg(F.avg(value).alias("m"))
    m = F.round("m", 9)
    return by_hour.agg(
        F.min_by("hour", F.struct(m, "hour")).alias("best_hour"),
        F.min("m").alias("best_mean"),
        F.max_by("hour", F.struct(m, -F.col("hour"))).alias("worst_hour"),
        F.max("m").alias("worst_mean"),
    )


def conditional_mae(errors: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Mean absolute error under each named condition, all in one pass."""
    return errors.agg(
        *[F.avg(F.when(c, F.abs("error"))).alias(f"{name}_mae") for name, c in conditions.items()],
        *[F.count_if(c).alias(f"{name}_n") for name, c in conditions.items()],
    )


def by_quartile(
    errors: DataFrame, column: str, labels: list[str], value: str = "error"
) -> DataFrame:
    """Error by quartile of a column: label, range, mean, deviation, count."""
    binned = bins.quantile_bins(errors, column, len(labels))
    names = F.array(*[F.lit(x) for x in labels])
    return (
        binned.groupBy("bin")
        .agg(
            F.min(column).alias("low"),
            F.max(column).alias("high"),
            F.avg(value).alias("mean_error"),
            F.stddev_samp(value).alias("std_error"),
            F.count(value).alias("n"),
        )
        .withColumn("label", F.get(names, F.col("bin").cast("int")))
    )


def by_flag(errors: DataFrame, flag: str) -> DataFrame:
    """Signed and absolute mean error by regime flag."""
    return errors.filter(F.col(flag).isNotNull()).groupBy(flag).agg(
        F.avg("error").alias("mean_error"), F.avg(F.abs("error")).alias("mae"), F.count("*").alias("n")
    )


def step_analysis(errors: DataFrame) -> DataFrame:
    """Size of the target's steps and their correlation with the error."""
    x, y = stats.pair("actual_diff", "error")
    return errors.agg(
        F.avg(F.abs("actual_diff")).alias("mean_abs_diff"), F.corr(x, y).alias("corr_diff_error")
    )


def band_check(forecast: DataFrame, low: str = "q10", high: str = "q90") -> DataFrame:
    """Coverage of the band, its mean width and the pinball loss of both edges."""
    a = F.col("actual")

    def pinball(q: str, level: float) -> Column:
        d = a - F.col(q)
        return F.avg(F.greatest(d * level, d * (level - 1)))

    return forecast.filter(a.isNotNull() & F.col(low).isNotNull()).agg(
        F.avg(a.between(F.col(low), F.col(high)).cast("double")).alias("coverage"),
        F.avg(F.col(high) - F.col(low)).alias("mean_width"),
        pinball(low, int(low[1:]) / 100).alias("pinball_low"),
        pinball(high, int(high[1:]) / 100).alias("pinball_high"),
        F.count("*").alias("n"),
    )


def value_range(long: DataFrame) -> DataFrame:
    """Distinct values and range of each feature; copies of a value merge map-side."""
    distinct = long.groupBy("feature", "v").agg(F.count("*").alias("c"))
    return distinct.groupBy("feature").agg(
        F.count("*").alias("n_distinct"), F.min("v").alias("low"), F.max("v").alias("high")
    )


def feature_profile(
    errors: DataFrame, names: list[str], value: str = "error", q: int = 4
) -> DataFrame:
    """Error by bin for many features in one job.

    A feature with one value is reported as `single`; with fewer than q values it
    gets as many equal-width bins; with tied quantile edges each of its five most
    frequent values is a row (`counts`); otherwise it gets quantile bins. Rows are
    (feature, method, bin, low, high, mean_error, std_error, n). The binning plan has
    one row per feature name given, which bounds the broadcast.
    """
    long = bins.to_long(errors, [], names, [value]).withColumnRenamed(value, "_e")
    sizes = value_range(long)
    edges = bins.exact_quantiles(errors, [], names, [i / q for i in range(q + 1)]).drop("n")
    method = (
        F.when(F.col("n_distinct") <= 1, "single")
        .when(F.col("n_distinct") < q, "equal_width")
        .when(bins.has_tied_edges(F.col("edges")), "counts")
        .otherwise("quantile")
    )
    plan = sizes.join(edges, "feature").withColumn("method", method)
    tagged = long.join(F.broadcast(plan), "feature")
    number = F.when(F.col("method") == "quantile", bins.right_closed(F.col("v"), F.col("edges"), q))
    for n in range(2, q):
        number = number.when(
            (F.col("method") == "equal_width") & (F.col("n_distinct") == n),
            bins.equal_width_bin(F.col("v"), F.col("low"), F.col("high"), n),
        )
    number = number.when(F.col("method") == "single", F.lit(0).cast("bigint"))
    report = [
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.avg("_e").alias("mean_error"),
        F.stddev_samp("_e").alias("std_error"),
        F.count("*").alias("n"),
    ]
    binned = (
        tagged.filter(F.col("method") != "counts")
        .withColumn("bin", number)
        .groupBy("feature", "method", "bin")
        .agg(*report)
    )
    frequent = tagged.filter(F.col("method") == "counts").groupBy("feature", "method", "v").agg(*report)
    rank = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "v"))
    top = (
        frequent.withColumn("rank", rank)
        .filter("rank <= 5")
        .withColumn("bin", (F.col("rank") - 1).cast("bigint"))
        .drop("rank", "v")
    )
    return binned.unionByName(top)


def feature_statistics(errors: DataFrame, names: list[str], value: str = "error") -> DataFrame:
    """Mean, deviation, range, zero share and correlation with the error per feature."""
    long = bins.to_long(errors, [], names, [value]).withColumnRenamed(value, "_e")
    return long.groupBy("feature").agg(
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.count_if(F.col("v") == 0).alias("n_zero"),
        (F.avg((F.col("v") == 0).cast("double")) * 100).alias("pct_zero"),
        F.corr("v", "_e").alias("corr_error"),
    )

