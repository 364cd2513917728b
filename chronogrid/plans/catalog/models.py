"""Panel contract, splits, forecasters and training over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronogrid.functions.numbers import tidy
from chronogrid.operators import chunks, features, model
from chronogrid.plans import forecasting
from chronogrid.plans.catalog.aggregates import tidied
from chronogrid.plans.catalog.base import Tables, query, with_views
from chronogrid.plans.catalog.calendars import VOLUMES, all_weather, january_vacations
from chronogrid.plans.catalog.ordered import BY_TIME

ENDS = "ends AS (SELECT item_id, max(ts) AS hi FROM grid GROUP BY 1)"


@query(
    "m1_panel",
    with_views("wide") + "SELECT '0' AS item_id, ts, tidy(emissionfactor) AS emissionfactor FROM wide",
)
def panel(t: Tables):
    raw = t.wide.select(F.col("ts").alias("validfrom (UTC)"), tidy(F.col("emissionfactor")).alias("emissionfactor"))
    return model.to_panel(raw)


@query(
    "m2_role_contract",
    with_views("grid", "wide")
    + """SELECT g.item_id, g.ts, hour(g.ts) AS hour, isodow(g.ts) - 1 AS dayofweek, tidy(w.temperature) AS temperature
    FROM grid g LEFT JOIN wide w ON w.ts = g.ts""",
)
def role_contract(t: Tables):
    roles = model.Roles(target="emissionfactor", known=["hour", "dayofweek", "temperature"])
    joined = features.temporal(t.grid()).join(t.wide.select("ts", tidy(F.col("temperature")).alias("temperature")), "ts", "left")
    return roles.covariates(joined)


@query(
    "m3_horizon_holdout",
    with_views("grid", more=ENDS)
    + """SELECT item_id, ts, ts > hi - INTERVAL 168 HOUR AS is_test,
    CASE WHEN ts > hi - INTERVAL 168 HOUR THEN CAST((epoch(ts) - epoch(hi)) / 3600 + 168 AS BIGINT) END AS step
    FROM grid JOIN ends USING (item_id)""",
)
def horizon_holdout(t: Tables):
    return model.holdout(t.grid()).drop("y")


@query(
    "m4_backtest_windows",
    with_views("grid", more=ENDS)
    + """SELECT item_id, "window", part, count(*) AS n_rows, count(y) AS n_known, min(ts) AS first_ts, max(ts) AS last_ts FROM (
      SELECT item_id, ts, y, CAST(k AS BIGINT) AS "window", CASE WHEN ts <= hi - to_hours(168 * (3 - k)) THEN 'train'
        WHEN ts <= hi - to_hours(168 * (2 - k)) THEN 'validation' END AS part
      FROM grid JOIN ends USING (item_id), (SELECT unnest(range(0, 3)) AS k)) WHERE part IS NOT NULL GROUP BY 1, 2, 3""",
)
def backtest_windows(t: Tables):
    return (
        model.backtest_windows(t.grid())
        .groupBy("item_id", "window", "part")
        .agg(
            F.count("*").alias("n_rows"),
            F.count("y").alias("n_known"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )


@query(
    "m5_linear_candidate",
    with_views("grid", more=ENDS)
    + f""", l AS (SELECT item_id, ts, y, lag(y, 168) {BY_TIME} AS x FROM grid),
    tr AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM l JOIN ends USING (item_id)
      WHERE ts <= hi - INTERVAL 168 HOUR AND x IS NOT NULL AND y IS NOT NULL)
    SELECT item_id, ts, tidy3(a + b * x) AS predicted FROM l JOIN ends USING (item_id), tr
    WHERE ts > hi - INTERVAL 168 HOUR AND x IS NOT NULL""",
)
def linear_candidate(t: Tables):
    lagged = chunks.windowed(t.grid(168), 168, lambda w: {"x": F.lag("y", 168).over(w)})
    split = model.holdout(lagged).filter("x IS NOT NULL")
    fitted = model.fit(split.filter("NOT is_test"), "y", ["x"], "linear")
    out = model.predict(fitted, split.filter("is_test"), ["x"])
    return out.select("item_id", "ts", tidy(F.col("predicted"), 3).alias("predicted"))


@query("m5_boosted_trees_candidate")
def boosted_trees(t: Tables):
    rows = features.temporal(model.direct_features(t.grid(), "y"))
    columns = [*features.TEMPORAL, *[c for c in rows.columns if c.startswith("y_")]]
    split = model.holdout(rows)
    fitted = model.fit(split.filter("NOT is_test"), "y", columns, "boosted_trees")
    scored = model.predict(fitted, split.filter("is_test"), columns)
    return tidied(scored.select("item_id", "ts", "step", F.col("y").alias("actual"), "predicted"))


def naive_sql(season: int) -> str:
    return f"""SELECT g.item_id, g.ts, CAST((epoch(g.ts) - epoch(hi)) / 3600 + 168 AS BIGINT) AS step, g.y AS actual, b.y AS predicted
    FROM grid g JOIN ends e ON e.item_id = g.item_id LEFT JOIN grid b ON b.item_id = g.item_id
      AND b.ts = g.ts - to_hours(CAST(ceil(((epoch(g.ts) - epoch(hi)) / 3600 + 168) / {season}) * {season} AS BIGINT))
    WHERE g.ts > hi - INTERVAL 168 HOUR"""


@query(
    "m6_seasonal_naive_week",
    with_views("grid", more=ENDS + f", f AS ({naive_sql(168)})")
    + "SELECT item_id, ts, step, tidy(actual) AS actual, tidy(predicted) AS predicted FROM f",
)
def naive_week(t: Tables):
    return tidied(model.seasonal_naive(t.grid(), "y", 168))


@query(
    "m6_seasonal_naive_day",
    with_views("grid", more=ENDS + f", f AS ({naive_sql(24)})")
    + "SELECT item_id, ts, step, tidy(actual) AS actual, tidy(predicted) AS predicted FROM f",
)
def naive_day(t: Tables):
    return tidied(model.seasonal_naive(t.grid(), "y", 24))


BOTH = ENDS + f""", n168 AS ({naive_sql(168)}), n24 AS ({naive_sql(24)}),
    p AS (SELECT item_id, ts, a.actual, a.predicted AS week, b.predicted AS day FROM n168 a JOIN n24 b USING (item_id, ts))"""


def _both(t: Tables):
    week = model.seasonal_naive(t.grid(), "y", 168).withColumnRenamed("predicted", "week")
    day = model.seasonal_naive(t.grid(), "y", 24).select("item_id", "ts", F.col("predicted").alias("day"))
    return week.join(day, ["item_id", "ts"])


@query(
    "m7_ensemble_weights",
    with_views("grid", more=BOTH)
    + """SELECT CAST(k AS BIGINT) AS id, k / 10.0 AS w_week, (10 - k) / 10.0 AS w_day,
    tidy(sqrt(avg(pow(week * k / 10.0 + day * (10 - k) / 10.0 - actual, 2)))) AS rmse
    FROM p, (SELECT unnest(range(0, 11)) AS k) WHERE actual IS NOT NULL AND week IS NOT NULL AND day IS NOT NULL GROUP BY k""",
)
def ensemble_weights(t: Tables):
    out = model.ensemble_weights(_both(t), ["week", "day"])
    return out.withColumn("rmse", tidy(F.col("rmse")))


@query(
    "m7_best_ensemble",
    with_views("grid", more=BOTH)
    + """, s AS (SELECT k, sqrt(avg(pow(week * k / 10.0 + day * (10 - k) / 10.0 - actual, 2))) AS rmse
      FROM p, (SELECT unnest(range(0, 11)) AS k) WHERE actual IS NOT NULL AND week IS NOT NULL AND day IS NOT NULL GROUP BY k)
    SELECT CAST(k AS BIGINT) AS id, k / 10.0 AS w_week, (10 - k) / 10.0 AS w_day, tidy(rmse) AS rmse FROM s
    ORDER BY round(s.rmse, 9), k LIMIT 1""",
)
def best_ensemble(t: Tables):
    out = model.best_weights(model.ensemble_weights(_both(t), ["week", "day"]))
    return out.withColumn("rmse", tidy(F.col("rmse")))


@query(
    "m9_leaderboard",
    with_views("grid", more=BOTH)
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS model, tidy(sqrt(avg(({m} - actual) * ({m} - actual)))) AS rmse, tidy(avg(abs({m} - actual))) AS mae,
        count({m} - actual) AS n FROM p"""
        for m in ("week", "day")
    ),
)
def leaderboard(t: Tables):
    cells = [F.struct(F.lit(m).alias("model"), F.col(m).alias("predicted")) for m in ("week", "day")]
    long = _both(t).select("actual", F.explode(F.array(*cells)).alias("p")).select("actual", "p.*")
    return tidied(model.leaderboard(long))


@query(
    "o7_ranked_leaderboard",
    with_views("grid", more=BOTH)
    + ", scores AS ("
    + " UNION ALL ".join(f"SELECT '{m}' AS model, sqrt(avg(({m} - actual) * ({m} - actual))) AS rmse FROM p" for m in ("week", "day"))
    + ") SELECT model, tidy(rmse) AS rmse, row_number() OVER (ORDER BY rmse, model) AS place FROM scores",
)
def ranked_leaderboard(t: Tables):
    cells = [F.struct(F.lit(m).alias("model"), F.col(m).alias("predicted")) for m in ("week", "day")]
    long = _both(t).select("actual", F.explode(F.array(*cells)).alias("p")).select("actual", "p.*")
    scores = model.leaderboard(long).select("model", "rmse")
    order = Window.orderBy("rmse", "model")  # one row a model
    return tidied(scores.withColumn("place", F.row_number().over(order).cast("bigint")))


@query("m10_permutation_importance")
def permutation_importance(t: Tables):
    rows = features.temporal(model.direct_features(t.grid(), "y")).dropna()
    columns = ["hour", "dayofweek", "y_lag_168h", "y_mean_before_168h"]
    fitted = model.fit(rows, "y", columns, "linear")
    return tidied(model.permutation_importance(fitted, rows, "y", columns, ["item_id", "ts"]))


@query("m11_saved_model")
def saved_model(t: Tables):
    rows = model.direct_features(t.grid(), "y").dropna()
    columns = [c for c in rows.columns if c.startswith("y_")]
    fitted = model.fit(rows, "y", columns, "linear")
    path = t.scratch("m11")
    model.save(fitted, path)
    same = model.predict(model.load(path), rows, columns).select("item_id", "ts", F.col("predicted").alias("loaded"))
    direct = model.predict(fitted, rows, columns).select("item_id", "ts", "predicted")
    return tidied(direct.join(same, ["item_id", "ts"]))


def _config(t: Tables) -> forecasting.ForecastConfig:
    """Both candidates, all validation windows and the sets and covariates of a full run."""
    inputs = features.FeatureInputs(target="target_value", vacations=january_vacations(t), weather=all_weather(t))
    return forecasting.ForecastConfig(roles=model.Roles(target="target_value"), inputs=inputs)


def _training_panel(t: Tables):
    return t.grid().select("item_id", "ts", F.col("y").alias("target_value"), *[(F.col("y") * k).alias(n) for n, k in VOLUMES.items()])


def _predicted(t: Tables):
    cfg = _config(t)
    split = model.holdout(_training_panel(t))
    columns = ["item_id", "ts", "target_value", *VOLUMES]
    past, future = (split.filter(part).select(*columns) for part in ("NOT is_test", "is_test"))
    trained = forecasting.train(past, cfg)
    return forecasting.predict(trained, past, future, cfg), past, future


@query("m12_operational_prediction")
def operational_prediction(t: Tables):
    return tidied(_predicted(t)[0])


@query("g3_prediction_job")
def prediction_job(t: Tables):
    """The prediction as the job leaves it: written by run and read back."""
    prediction, past, future = _predicted(t)
    folder = t.scratch("g3")
    forecasting.save_prediction(prediction, past, future, folder, "20240131")
    return tidied(t.spark.read.parquet(f"{folder}/prediction"))


@query(
    "m13_context_modes",
    with_views("grid", more=ENDS)
    + """SELECT item_id, 'full' AS mode, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM grid JOIN ends USING (item_id)
      WHERE ts <= hi - INTERVAL 168 HOUR GROUP BY 1
    UNION ALL SELECT item_id, 'short', count(*), min(ts), max(ts) FROM grid JOIN ends USING (item_id)
      WHERE ts <= hi - INTERVAL 168 HOUR AND ts > hi - INTERVAL 504 HOUR GROUP BY 1""",
)
def context_modes(t: Tables):
    g = t.grid()
    out = None
    for mode, length in (("full", None), ("short", 336)):
        part = model.context(g, context_hours=length).groupBy("item_id").agg(
            F.lit(mode).alias("mode"), F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query("g2_train_leaderboard")
def train_leaderboard(t: Tables):
    return tidied(forecasting.train(_training_panel(t), _config(t)).leaderboard)
