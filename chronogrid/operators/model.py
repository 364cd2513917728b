"""Panel contract, splits, forecasters, ensembles, bands and model scoring."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronogrid.functions.schema import forbid_derived, normalise_time, require_columns
from chronogrid.functions.timeparts import hours
from chronogrid.operators import align, bins, chunks
from chronogrid.session import materialise

# Forecast length in hours, validation windows, quantile levels.
HORIZON = 168
VALIDATION_WINDOWS = 3
RIDGE = 1e-6  # penalty of a linear fit with several covariates, some of which may be dependent
QUANTILES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]

# Covariates known in the forecast horizon.
KNOWN_COVARIATES = [
    "volume_sun", "volume_land_wind", "volume_sea_wind",
    "hour", "dayofweek", "month", "is_weekend",
    "day_of_year_sin", "day_of_year_cos", "week_of_year_sin", "week_of_year_cos",
    "hour_sin", "hour_cos", "dayofweek_sin", "dayofweek_cos",
    "month_sin", "month_cos", "quarter_sin", "quarter_cos",
    "temperature", "temperature_change_1h", "temperature_change_24h",
    "temperature_lag_1h", "temperature_lag_8h", "temperature_lag_9h",
    "temperature_lag_10h", "temperature_lag_20h", "temperature_lag_21h",
    "temperature_lag_22h", "temperature_lag_23h", "temperature_lag_24h",
    "temperature_rolling_mean_24h", "temperature_rolling_mean_168h",
    "is_holiday", "is_working_day",
    "is_school_vacation", "is_summer_vacation", "vacation_type",
    "wind_speed", "wind_speed_change_1h",
    "wind_speed_rolling_mean_24h", "wind_speed_rolling_mean_168h",
    "wind_direction", "wind_direction_change_1h",
    "wind_direction_rolling_mean_24h", "wind_direction_rolling_mean_168h",
    "cloud_cover", "cloud_cover_change_1h", "cloud_cover_change_24h",
    "cloud_cover_rolling_mean_24h", "cloud_cover_rolling_mean_168h",
    "solar_radiation", "solar_radiation_rolling_mean_24h", "solar_radiation_rolling_mean_168h",
    "direct_radiation", "direct_radiation_rolling_mean_24h", "direct_radiation_rolling_mean_168h",
    "humidity", "humidity_change_1h", "humidity_change_24h",
    "humidity_rolling_mean_24h", "humidity_rolling_mean_168h",
    "precipitation", "precipitation_change_1h", "precipitation_change_24h",
    "precipitation_rolling_mean_24h", "precipitation_rolling_mean_168h",
]


@dataclass(frozen=True)
class Roles:
    """Which columns are target, known ahead, or known only in the past."""

    target: str = "emissionfactor"
    known: list[str] = field(default_factory=lambda: list(KNOWN_COVARIATES))
    past: list[str] = field(default_factory=list)
    item: str = "item_id"
    ts: str = "ts"
    horizon: int = HORIZON

    def covariates(self, df: DataFrame) -> DataFrame:
        """Keys and known covariates; fails on missing or target-derived columns."""
        require_columns(df, [self.item, self.ts, *self.known])
        return forbid_derived(df.select(self.item, self.ts, *self.known), self.target)


def to_panel(df: DataFrame, item: str = "item_id", series: str = "0") -> DataFrame:
    """Long panel (item_id, ts, ...); a missing item column becomes one constant series."""
    named = normalise_time(df)
    if item not in named.columns:
        named = named.withColumn(item, F.lit(series))
    rest = [c for c in named.columns if c not in (item, "ts")]
    return align.assert_unique(named.select(item, "ts", *rest), [item, "ts"])


def with_end(df: DataFrame, item: str = "item_id", ts: str = "ts") -> DataFrame:
    """Add each series' last time as `series_end`."""
    return align.join_summary(df, df.groupBy(item).agg(F.max(ts).alias("series_end")), [item])


def holdout(df: DataFrame, horizon: int = HORIZON, item: str = "item_id", ts: str = "ts") -> DataFrame:
    """Add is_test (the last `horizon` hours) and step (1..horizon there, else NULL)."""
    cut = F.col("series_end") - hours(horizon)
    step = (F.unix_seconds(ts) - F.unix_seconds(cut)) / F.lit(3600)
    return (
        with_end(df, item, ts)
        .withColumn("is_test", F.col(ts) > cut)
        .withColumn("step", F.when(F.col("is_test"), step.cast("bigint")))
        .drop("series_end")
    )


def context(
    df: DataFrame,
    horizon: int = HORIZON,
    context_hours: int | None = 2 * HORIZON,
    item: str = "item_id",
    ts: str = "ts",
) -> DataFrame:
    """The hours before the horizon; None takes everything before it."""
    cut = F.col("series_end") - hours(horizon)
    keep = F.col(ts) <= cut
    if context_hours is not None:
        keep = keep & (F.col(ts) > cut - hours(context_hours))
    return with_end(df, item, ts).filter(keep).drop("series_end")


def backtest_windows(
    df: DataFrame,
    n: int = VALIDATION_WINDOWS,
    horizon: int = HORIZON,
    item: str = "item_id",
    ts: str = "ts",
) -> DataFrame:
    """Expanding windows: each row with every window it takes part in, and its part.

    Window n - 1 validates on the last horizon, the ones before step back by one
    horizon each. Rows after a window's end are not part of it.
    """
    def cut(k: int) -> Column:
        return F.col("series_end") - hours((n - k) * horizon)

    roles = [
        F.struct(
            F.lit(k).cast("bigint").alias("window"),
            F.when(F.col(ts) <= cut(k), "train")
            .when(F.col(ts) <= cut(k) + hours(horizon), "validation")
            .alias("part"),
        )
        for k in range(n)
    ]
    return (
        with_end(df, item, ts)
        .withColumn("_r", F.explode(F.array(*roles)))
        .filter(F.col("_r.part").isNotNull())
        .withColumns({"window": F.col("_r.window"), "part": F.col("_r.part")})
        .drop("_r", "series_end")
    )


def seasonal_naive(
    df: DataFrame,
    target: str,
    season: int = HORIZON,
    horizon: int = HORIZON,
    item: str = "item_id",
    ts: str = "ts",
) -> DataFrame:
    """Forecast of the last horizon from the latest known value at the same season phase.

    Returns (item, ts, step, actual, predicted).
    """
    test = holdout(df.select(item, ts, target), horizon, item, ts).filter("is_test")
    back = F.ceil(F.col("step") / F.lit(season)) * F.lit(season * 3600)
    wanted = test.select(
        item,
        ts,
        "step",
        F.col(target).alias("actual"),
        F.timestamp_seconds(F.unix_seconds(ts) - back).alias("_from"),
    )
    known = df.select(item, F.col(ts).alias("_from"), F.col(target).alias("predicted"))
    return wanted.join(known, [item, "_from"], "left").drop("_from")


def shifted_forecast(
    df: DataFrame, target: str, shift: int, item: str = "item_id", ts: str = "ts"
) -> DataFrame:
    """Every row with the value `shift` hours earlier as its forecast."""
    earlier = df.select(item, (F.col(ts) + hours(shift)).alias(ts), F.col(target).alias("predicted"))
    return df.join(earlier, [item, ts])


def direct_features(
    df: DataFrame,
    target: str,
    horizon: int = HORIZON,
    item: str = "item_id",
    ts: str = "ts",
    chunk_hours: int = chunks.CHUNK_HOURS,
) -> DataFrame:
    """Target history that is still known `horizon` hours ahead."""
    y = F.col(target)
    mean = F.col(chunks.rolling_average(target, horizon))

    def build(w: WindowSpec) -> dict[str, Column]:
        return {
            f"{target}_lag_{horizon}h": F.lag(y, horizon).over(w),
            f"{target}_lag_{2 * horizon}h": F.lag(y, 2 * horizon).over(w),
            f"{target}_mean_before_{horizon}h": F.lag(mean, horizon).over(w),
        }

    return chunks.windowed(df, 2 * horizon, build, item, ts, chunk_hours, means={target: [horizon]})


def _stages(df: DataFrame, features: list[str]) -> tuple[list, str]:
    """Imputation, text indexing and vector assembly for the given columns."""
    text = [c for c in features if isinstance(df.schema[c].dataType, T.StringType)]
    numeric = [c for c in features if c not in text]
    filled = [f"{c}__imp" for c in numeric]
    stages: list = [Imputer(inputCols=numeric, outputCols=filled)]
    if text:
        stages.append(
            StringIndexer(inputCols=text, outputCols=[f"{c}__ix" for c in text], handleInvalid="keep")
        )
    stages.append(VectorAssembler(inputCols=[*filled, *[f"{c}__ix" for c in text]], outputCol="__x"))
    return stages, "__x"


def regressors(seed: int = 42, ridge: float = 0.0) -> dict:
    """The candidate regressors by name; a little `ridge` keeps dependent covariates apart."""
    return {
        "linear": LinearRegression(regParam=ridge, solver="normal"),
        "boosted_trees": GBTRegressor(maxIter=20, maxDepth=5, seed=seed),
    }


def fit(df: DataFrame, target: str, features: list[str], name: str, seed: int = 42) -> PipelineModel:
    """Fit one candidate on the rows with a known target.

    Features without any known value in these rows are left out of the fit.
    """
    numeric = [c for c in features if not isinstance(df.schema[c].dataType, T.StringType)]
    rows = df.filter(F.col(target).isNotNull()).withColumns(
        {c: F.col(c).cast("double") for c in [*numeric, target]}
    )
    known = rows.agg(*[F.count(c).alias(c) for c in features]).first()
    stages, vector = _stages(df, [c for c in features if known[c]])
    ridge = RIDGE if len(features) > 1 else 0.0
    regressor = regressors(seed, ridge)[name].setFeaturesCol(vector).setLabelCol(target).setPredictionCol("predicted")
    return Pipeline(stages=[*stages, regressor]).fit(rows)


def predict(model: PipelineModel, df: DataFrame, features: list[str]) -> DataFrame:
    """Add `predicted`."""
    numeric = [c for c in features if not isinstance(df.schema[c].dataType, T.StringType)]
    typed = df.withColumns({c: F.col(c).cast("double") for c in numeric})
    scored = model.transform(typed)
    return scored.select(*df.columns, "predicted")


def save(model: PipelineModel, path: str) -> None:
    """Write a fitted model, replacing an earlier one."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """Read a fitted model."""
    return PipelineModel.load(path)


def simplex(models: list[str], steps: int) -> list[list[float]]:
    """All weight vectors that are multiples of 1 / steps and sum to 1."""
    grid = product(range(steps + 1), repeat=len(models))
    return [[k / steps for k in ks] for ks in grid if sum(ks) == steps]


def ensemble_weights(
    df: DataFrame, models: list[str], actual: str = "actual", steps: int = 10
) -> DataFrame:
    """Error of every weight vector on a frame with one prediction column per model.

    Returns (id, w_{model}..., rmse). Weights sum to one, so the error of a blend is the
    blend of the errors, and its mean square follows from the mean products of every
    two models' errors: one aggregate over the rows, whatever the number of vectors.
    """
    names = [f"w_{m}" for m in models]
    pairs = [(i, j) for i in range(len(models)) for j in range(i, len(models))]
    error = [F.col(m) - F.col(actual) for m in models]
    products = df.dropna(subset=[actual, *models]).agg(
        *[F.avg(error[i] * error[j]).alias(f"p{i}_{j}") for i, j in pairs]
    )
    cells = F.array(
        *[
            F.struct(F.lit(i).cast("bigint").alias("id"), *[F.lit(w).alias(n) for n, w in zip(names, ws)])
            for i, ws in enumerate(simplex(models, steps))
        ]
    )
    square = sum(
        (F.col(f"p{i}_{j}") * F.col(names[i]) * F.col(names[j]) * (1 if i == j else 2) for i, j in pairs), F.lit(0.0)
    )
    wide = products.select("*", F.inline(cells))
    return wide.select("id", *names, F.sqrt(F.greatest(square, F.lit(0.0))).alias("rmse")).where("rmse IS NOT NULL")


def best_weights(scored: DataFrame) -> DataFrame:
    """The weight vector with the smallest error; the earlier one wins a tie."""
    return scored.agg(
        F.min_by(F.struct(*scored.columns), F.struct(F.round("rmse", 9), "id")).alias("b")
    ).select("b.*")


def blend(df: DataFrame, models: list[str], weights: dict[str, float]) -> DataFrame:
    """Add the weighted prediction as `predicted`."""
    total = sum((F.col(m) * F.lit(float(weights[m])) for m in models), F.lit(0.0))
    return df.withColumn("predicted", total)


def quantile_names(levels: Iterable[float] = QUANTILES) -> list[str]:
    """q10 for 0.1 and so on."""
    return [f"q{int(round(level * 100)):02d}" for level in levels]


def residual_bands(
    history: DataFrame, keys: list[str], levels: list[float] = QUANTILES, few_groups: bool = False
) -> DataFrame:
    """Quantiles of actual - predicted by the keys, one column per level."""
    residual = history.select(*keys, (F.col("actual") - F.col("predicted")).alias("residual"))
    names = dict(zip(quantile_names(levels), levels))
    return bins.quantile_columns(residual, keys, "residual", names, few_groups).drop("n")


def quantile_forecast(
    point: DataFrame, bands: DataFrame, keys: list[str], levels: list[float] = QUANTILES
) -> DataFrame:
    """Point forecast as `mean` plus one column per quantile level."""
    names = quantile_names(levels)
    shifted = bands.withColumnsRenamed({n: f"_{n}" for n in names})
    return (
        point.join(shifted, keys, "left")
        .withColumns({n: F.col("predicted") + F.col(f"_{n}") for n in names})
        .withColumnRenamed("predicted", "mean")
        .drop(*[f"_{n}" for n in names])
    )


def leaderboard(predictions: DataFrame) -> DataFrame:
    """Error of each model over (model, actual, predicted) rows, best first."""
    e = F.col("predicted") - F.col("actual")
    return (
        predictions.filter(e.isNotNull())
        .groupBy("model")
        .agg(
            F.sqrt(F.avg(e * e)).alias("rmse"),
            F.avg(F.abs(e)).alias("mae"),
            F.count("*").alias("n"),
        )
        .orderBy("rmse", "model")
    )


def permuted(df: DataFrame, columns: list[str], key: list[str], seed: int = 42) -> DataFrame:
    """Add `{c}__perm`: the columns' values moved one place along a hashed order of the rows.

    Rows are ordered by a hash of their key; every value moves to the row before, that of
    the first to the last. The order is cut into ranges of about equal size; all that a
    range needs of the next one is that one's first row. So the result does not depend on
    the number of ranges, and no task holds a growing share of the table. `key` identifies
    a row.
    """
    order = ["_order", *key]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_order", F.xxhash64(F.lit(seed), *key)).repartitionByRange(ranges, *order)
    dealt = materialise(placed.withColumn("_range", F.spark_partition_id()), "permuted")
    values = F.struct(*columns)
    heads = dealt.groupBy("_range").agg(F.min_by(values, F.struct(*order)).alias("_head"))
    along = Window.orderBy("_range")  # one row per range
    first = F.first("_head").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    last = F.lead("_range").over(along).isNull()
    heads = heads.select("_range", F.when(last, first).otherwise(F.lead("_head").over(along)).alias("_next"))
    w = Window.partitionBy("_range").orderBy(*order)
    moved = dealt.join(F.broadcast(heads), "_range").withColumn("_value", F.coalesce(F.lead(values).over(w), F.col("_next")))
    return moved.withColumns({f"{c}__perm": F.col("_value")[c] for c in columns}).drop("_order", "_range", "_next", "_value")


def permutation_importance(
    model: PipelineModel,
    df: DataFrame,
    target: str,
    features: list[str],
    key: list[str],
    seed: int = 42,
) -> DataFrame:
    """Rise of the error when one feature is permuted, as (feature, importance).

    Every row is scored as it is and once with each feature's moved value, side by side;
    one aggregate over the rows then has all errors.
    """
    rows = permuted(df.select(*key, target, *features), features, key, seed).drop(*key)
    scored = predict(model, rows, features).withColumnRenamed("predicted", "_plain")
    for i, c in enumerate(features):
        swapped = scored.withColumnsRenamed({c: f"{c}__own", f"{c}__perm": c})
        scored = predict(model, swapped, features).withColumnsRenamed({c: f"{c}__perm", f"{c}__own": c, "predicted": f"_moved{i}"})
    error = lambda name: F.sqrt(F.avg((F.col(name) - F.col(target)) ** 2))
    errors = scored.agg(error("_plain").alias("base"), *(error(f"_moved{i}").alias(f"e{i}") for i in range(len(features))))
    cells = [F.struct(F.lit(c).alias("feature"), (F.col(f"e{i}") - F.col("base")).alias("importance")) for i, c in enumerate(features)]
    return errors.select(F.inline(F.array(*cells))).orderBy("importance", "feature")
