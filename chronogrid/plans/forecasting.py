"""Train, predict and evaluate as jobs over one panel."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogrid import session
from chronogrid.operators import evaluate as ev
from chronogrid.operators import features as ft
from chronogrid.operators import model as md
from chronogrid.operators import quantreg, stats
from chronogrid.sources import sinks, utilisation

# Days of history used for training and the feature sets of a model.
TRAINING_DAYS = 180
MODEL_SETS = frozenset({"temporal", "holiday", "vacation", "seasonal", "emission", "weather"})


@dataclass(frozen=True)
class ForecastConfig:
    """What a forecasting run needs besides the panel.

    `quantiles` is `residuals` (bands of the residuals by step) or `regression` (lines
    over the point forecast and the step).
    """

    roles: md.Roles = field(default_factory=md.Roles)
    inputs: ft.FeatureInputs = field(default_factory=ft.FeatureInputs)
    sets: frozenset[str] = MODEL_SETS
    training_days: int | None = TRAINING_DAYS
    candidates: tuple[str, ...] = ("linear", "boosted_trees")
    windows: int = md.VALIDATION_WINDOWS
    ensemble_steps: int = 10
    fits_at_once: int = 4
    quantiles: str = "residuals"

    def __post_init__(self):
        if self.quantiles not in ("residuals", "regression"):
            raise ValueError(f"quantiles: residuals or regression, not {self.quantiles}")


@dataclass
class Trained:
    """Fitted candidates, ensemble weights, quantiles and scores."""

    models: dict[str, PipelineModel]
    features: list[str]
    weights: dict[str, float]
    bands: DataFrame | quantreg.QuantileModel
    leaderboard: DataFrame
    backtest: DataFrame


def feature_table(panel: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Chosen feature sets plus the target history that reaches past the horizon."""
    roles = cfg.roles
    wide = ft.add_features(panel, cfg.inputs, set(cfg.sets))
    return md.direct_features(wide, roles.target, roles.horizon, roles.item, roles.ts)


def model_columns(table: DataFrame, roles: md.Roles) -> list[str]:
    """Known covariates and target history; fails when a covariate is missing."""
    roles.covariates(table)
    h, y = roles.horizon, roles.target
    return [*roles.known, f"{y}_lag_{h}h", f"{y}_lag_{2 * h}h", f"{y}_mean_before_{h}h"]


def _naive(table: DataFrame, roles: md.Roles) -> DataFrame:
    """The value one horizon earlier as a prediction column."""
    return table.withColumn("seasonal_naive", F.col(f"{roles.target}_lag_{roles.horizon}h"))


def _score(table: DataFrame, models: dict[str, PipelineModel], columns: list[str], roles: md.Roles) -> DataFrame:
    """One prediction column per model."""
    out = _naive(table, roles)
    for name, fitted in models.items():
        out = md.predict(fitted, out, columns).withColumnRenamed("predicted", name)
    return out


def _long(scored: DataFrame, names: list[str], target: str) -> DataFrame:
    """(model, actual, predicted) rows."""
    cells = [F.struct(F.lit(n).alias("model"), F.col(n).alias("predicted")) for n in names]
    return scored.select(F.col(target).alias("actual"), F.explode(F.array(*cells)).alias("p")).select(
        "actual", "p.*"
    )


def train(panel: DataFrame, cfg: ForecastConfig) -> Trained:
    """Fit the candidates and score them on windows they were not fitted on.

    Every validation window refits on the rows before it; the final models see all rows
    but the last horizon. The feature table is written once, since each fit reads it again.
    """
    roles = cfg.roles
    recent = utilisation.lookback(panel, cfg.training_days, roles.item, roles.ts)
    table = session.materialise(feature_table(recent, cfg), "features")
    columns = model_columns(table, roles)
    names = ["seasonal_naive", *cfg.candidates]
    parts = md.backtest_windows(table, cfg.windows, roles.horizon, roles.item, roles.ts)
    training = md.holdout(table, roles.horizon, roles.item, roles.ts).filter("NOT is_test")
    wanted = [
        (k, name, parts.filter((F.col("window") == k) & (F.col("part") == "train")) if k >= 0 else training)
        for k in [*range(cfg.windows), -1]
        for name in cfg.candidates
    ]
    # The fits do not depend on each other; Spark runs the jobs of several at a time.
    with ThreadPoolExecutor(cfg.fits_at_once) as pool:
        models = list(pool.map(lambda w: md.fit(w[2], roles.target, columns, w[1]), wanted))
    fitted = {(k, name): found for (k, name, _), found in zip(wanted, models, strict=True)}
    windows = []
    for k in range(cfg.windows):
        here = parts.filter((F.col("window") == k) & (F.col("part") == "validation"))
        windows.append(_score(here, {name: fitted[k, name] for name in cfg.candidates}, columns, roles))
    scored = reduce(DataFrame.unionByName, windows)
    kept = scored.select(roles.item, roles.ts, "window", roles.target, *names)
    kept = session.materialise(kept, "backtest")
    best = md.best_weights(
        md.ensemble_weights(kept, names, roles.target, cfg.ensemble_steps)
    ).first()
    weights = {n: best[f"w_{n}"] for n in names}
    blended = md.blend(kept, names, weights).withColumnRenamed(roles.target, "actual")
    history = (
        blended.join(
            blended.groupBy(roles.item, "window").agg(F.min(roles.ts).alias("_from")),
            [roles.item, "window"],
        )
        .withColumn("step", ((F.unix_seconds(roles.ts) - F.unix_seconds("_from")) / 3600 + 1).cast("bigint"))
        .filter("actual IS NOT NULL AND predicted IS NOT NULL")
    )
    if cfg.quantiles == "regression":
        bands = quantreg.fit(history, "actual", ["predicted", "step"])
    else:
        bands = md.residual_bands(history, ["step"], few_groups=True)
    everything = _long(kept, names, roles.target).unionByName(
        blended.select(F.lit("weighted_ensemble").alias("model"), "actual", "predicted")
    )
    by_window = ev.metrics(blended.filter("actual IS NOT NULL AND predicted IS NOT NULL"), ["window"])
    final = {name: fitted[-1, name] for name in cfg.candidates}
    return Trained(final, columns, weights, bands, md.leaderboard(everything), by_window)


def predict(
    trained: Trained,
    past: DataFrame,
    future: DataFrame,
    cfg: ForecastConfig,
    per_slice: bool = False,
    context_days: int = utilisation.RUNUP_DAYS,
) -> DataFrame:
    """Mean and quantiles for the rows of `future`.

    Features are computed over past and future together, so that lags reach back
    into the past. With `per_slice` the known covariates of the future see only
    future rows, as when both tables are prepared separately.
    """
    roles = cfg.roles
    recent = utilisation.lookback(past, context_days, roles.item, roles.ts)
    ahead = future.drop(roles.target).withColumn(roles.target, F.lit(None).cast("double"))
    both = recent.withColumn("_ahead", F.lit(False)).unionByName(
        ahead.withColumn("_ahead", F.lit(True)), allowMissingColumns=True
    )
    table = feature_table(both, cfg).filter("_ahead").drop("_ahead")
    if per_slice:
        alone = ft.add_features(ahead, cfg.inputs, set(cfg.sets))
        history = [c for c in trained.features if c not in roles.known]
        table = alone.join(table.select(roles.item, roles.ts, *history), [roles.item, roles.ts])
    scored = _score(table, trained.models, trained.features, roles)
    point = md.blend(scored, list(trained.weights), trained.weights)
    starts = point.groupBy(roles.item).agg(F.min(roles.ts).alias("_from"))
    stepped = point.join(starts, roles.item).withColumn(
        "step", ((F.unix_seconds(roles.ts) - F.unix_seconds("_from")) / 3600 + 1).cast("bigint")
    )
    stepped = stepped.select(roles.item, roles.ts, "step", "predicted")
    if isinstance(trained.bands, quantreg.QuantileModel):
        named = quantreg.predict(trained.bands, stepped).withColumnRenamed("predicted", "mean")
    else:
        named = md.quantile_forecast(stepped, trained.bands, ["step"])
    return named.drop("step")


def save_prediction(prediction: DataFrame, past: DataFrame, future: DataFrame, path: str, run: str) -> list[str]:
    """Prediction, run-up and covariates, each as a partition by run."""
    return [
        sinks.write_predictions(prediction, f"{path}/prediction", run),
        sinks.write_predictions(past, f"{path}/runup", run),
        sinks.write_predictions(future, f"{path}/covariates", run),
    ]


def evaluate(
    errors: DataFrame,
    profile: list[str],
    temperature: str | None = None,
    price: str | None = None,
    crisis: str | None = None,
) -> dict[str, DataFrame]:
    """All error reports over one error table; a report whose column is absent is left out.

    The table is written once, since every report reads it again.
    """
    errors = session.materialise(errors, "errors")
    reports = {
        "metrics": ev.metrics(errors),
        "patterns": ev.pattern_table(errors),
        "hours": ev.best_and_worst_hour(errors),
        "steps": ev.step_analysis(errors),
        "profile": ev.feature_profile(errors, profile),
        "statistics": ev.feature_statistics(errors, profile),
    }
    flags = {c: F.col(c) == 1 for c in ("is_weekend", "is_holiday", "is_school_vacation", "is_summer_vacation") if c in errors.columns}
    flags |= {f"not_{c}": F.col(c) == 0 for c in flags}
    reports["conditional"] = ev.conditional_mae(errors, flags)
    if temperature in errors.columns:
        reports["temperature"] = ev.by_quartile(errors, temperature, ev.TEMPERATURE_LABELS)
        reports["temperature_corr"] = stats.pearson(errors, temperature, "error")
    if price in errors.columns:
        reports["price"] = ev.by_quartile(errors, price, ev.PRICE_LABELS)
        reports["price_corr"] = stats.pearson(errors, price, "error")
        if crisis in errors.columns:
            reports["crisis"] = ev.by_flag(errors, crisis)
    return reports
