"""Queries of scaling, training, searching, forecasting and the champion gate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from hourloom.catalog.base import query
from hourloom.catalog.series import LEADS, clip_sql
from hourloom.catalog.sql import r, rounded, using
from hourloom.functions import fixed
from hourloom.models import attribution, baseline, focus, forecast, neighbours, regressors, search, selection, series_fit
from hourloom.models.registry import Registry, gate
from hourloom.operators import layout, metrics, profiles, splits, stats
from hourloom.plans import daily, training
from hourloom.session import cut_lineage, fresh_path
from hourloom.sources import frames, sinks

KEY = ["station_id", "ts"]
BY = "(PARTITION BY station_id ORDER BY ts)"
FEATURES = ["pm2_5", "pm10", "o3", "co", "no2", "temperature", "pressure", "hour_sin", "hour_cos", "pm2_5_lag_24h", "pm10_24h_mean", "o3_72h_mean"]
TARGETS = dict(zip(fixed.HORIZONS, fixed.TARGETS))
LABEL = fixed.TARGETS[0]


def table(spark, sf, trim=True):
    return daily.learning_table(frames.dense_hourly(spark, sf), FEATURES, trim=trim)


def small_boost(label, rounds=5, depth=3):
    return regressors.boosted(label, rounds=rounds, depth=depth)


SCALED = ["pm2_5", "pm10", "pressure"]


@query(
    "standardise",
    using(
        "dense",
        "SELECT station_id, ts, " + ", ".join(f"{r(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in SCALED) + ", 0.0::DOUBLE AS constant FROM dense, fit",
        fit="SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED) + " FROM dense",
    ),
)
def _(spark, sf):
    rows = frames.dense_hourly(spark, sf).select(*KEY, *SCALED, F.lit(3.0).alias("constant"))
    return stats.standardise(rows, [*SCALED, "constant"])


SPLIT = """CASE WHEN pos <= floor(len * 0.6::DOUBLE) THEN 'train' WHEN pos <= floor(len * 0.6::DOUBLE)
  + floor(len * 0.2::DOUBLE) THEN 'validation' ELSE 'test' END"""
PLACED = "SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts) AS pos, count(*) OVER (PARTITION BY station_id) AS len FROM dense"


@query(
    "standardise_target",
    using(
        "dense",
        f"SELECT station_id, ts, split, {r('(pm10 - m) / (s + 1e-8)')} AS scaled, {r('pm10')} AS restored FROM parts, fit",
        placed=PLACED,
        parts=f"SELECT *, {SPLIT} AS split FROM placed",
        fit="SELECT avg(pm10) AS m, stddev_pop(pm10) AS s FROM parts WHERE split = 'train'",
    ),
)
def _(spark, sf):
    """Scaled with the mean and deviation of the train rows, and back."""
    rows = splits.temporal_split(frames.dense_hourly(spark, sf).select(*KEY, "pm10"))
    fit = stats.moments(rows.where("split = 'train'"), ["pm10"])
    out = stats.with_one_row(rows, fit)
    scale = F.col("_s.pm10_std") + F.lit(1e-8)
    scaled = (F.col("pm10") - F.col("_s.pm10_mean")) / scale
    return out.select(*KEY, "split", scaled.alias("scaled"), (scaled * scale + F.col("_s.pm10_mean")).alias("restored"))


ASSEMBLED = ["pm2_5", "pm10", "o3"]


@query(
    "assemble_features",
    using("dense", " UNION ALL ".join(f"SELECT station_id, ts, {i} AS place, {r(c)} AS value FROM dense" for i, c in enumerate(ASSEMBLED))),
)
def _(spark, sf):
    """The vectors that the learners see, component by component."""
    from pyspark.ml.functions import vector_to_array

    rows = regressors.prepared(frames.dense_hourly(spark, sf), ASSEMBLED)
    out = regressors.assemble(ASSEMBLED).transform(rows)
    return out.select(*KEY, F.posexplode(vector_to_array("features")).alias("place", "value"))


@query(
    "linear_one_feature",
    using("dense", f"SELECT {r('regr_slope(pm10, pm2_5)')} AS slope, {r('regr_intercept(pm10, pm2_5)')} AS intercept FROM dense"),
)
def _(spark, sf):
    """Least squares by Spark ML on one feature."""
    rows = regressors.prepared(frames.dense_hourly(spark, sf), ["pm2_5"])
    fitted = regressors.fit(regressors.linear("pm10"), rows, ["pm2_5"]).stages[-1]
    one = [(float(fitted.coefficients[0]), float(fitted.intercept))]
    return spark.createDataFrame(one, "slope double, intercept double")


def scored(spark, sf, estimators, targets=None):
    rows = table(spark, sf)
    _, predictions = regressors.train_all(rows, FEATURES, targets or {24: LABEL}, estimators)
    return metrics.regression_metrics(predictions)


@query("linear_family")
def _(spark, sf):
    rows = table(spark, sf)
    train = rows.where("split = 'train'")
    _, predictions = regressors.train_all(rows, FEATURES, {24: LABEL}, lambda t: regressors.linear_family(train, t))
    return metrics.regression_metrics(predictions)


@query("tree_family")
def _(spark, sf):
    return scored(spark, sf, lambda t: regressors.tree_family(t, trees=8, depth=5))


@query("boosted_trees")
def _(spark, sf):
    return scored(spark, sf, lambda t: {"boosted": small_boost(t)})


NEAR = ["temperature", "relative_humidity", "pressure"]


@query(
    "knn_regress",
    using(
        "dense",
        f"""SELECT station_id, ts, {r('CASE WHEN count(*) FILTER (d = 0) > 0 THEN avg(y) FILTER (d = 0) ELSE sum(y / d) FILTER (d > 0) / sum(1 / d) FILTER (d > 0) END')} AS prediction
        FROM near WHERE n <= 15 GROUP BY 1, 2""",
        placed=PLACED,
        parts=f"SELECT *, {SPLIT} AS split FROM placed",
        pairs="""SELECT q.station_id, q.ts, t.pm10 AS y, t.station_id || '|' || strftime(t.ts, '%Y-%m-%d %H:%M:%S') AS t,
        sqrt((q.temperature - t.temperature) ** 2 + (q.relative_humidity - t.relative_humidity) ** 2
        + (q.pressure - t.pressure) ** 2) AS d FROM parts q, parts t WHERE q.split = 'test' AND t.split = 'train'""",
        near="SELECT *, row_number() OVER (PARTITION BY station_id, ts ORDER BY d, t) AS n FROM pairs",
    ),
)
def _(spark, sf):
    rows = splits.temporal_split(frames.dense_hourly(spark, sf).select(*KEY, *NEAR, "pm10"))
    return neighbours.knn_regress(rows.where("split = 'train'"), rows.where("split = 'test'"), NEAR, "pm10", KEY)


@query("param_search")
def _(spark, sf):
    settings = regressors.random_draws({"rounds": [2, 4], "depth": [2, 3]}, 2)
    return regressors.param_search(table(spark, sf), FEATURES, LABEL, small_boost, settings)[2]


@query("contiguous_cv")
def _(spark, sf):
    rows = splits.contiguous_folds(table(spark, sf), 2)
    return regressors.contiguous_cv(
        rows, FEATURES, LABEL, regressors.linear(LABEL), {"regParam": [0.0, 0.1], "elasticNetParam": [0.0]}
    )[1]


@query("train_all_leaderboard")
def _(spark, sf):
    rows = table(spark, sf)
    _, predictions = regressors.train_all(
        rows, FEATURES, TARGETS, lambda t: {"ols": regressors.linear(t), "tree": regressors.tree_family(t, depth=4)["tree"]}
    )
    return regressors.leaderboard(predictions)


def _trials(spark, sf):
    """Three cheap models of one horizon, with their predictions."""
    rows = table(spark, sf)
    make = lambda t: {
        "ols": regressors.linear(t),
        "lasso": regressors.linear(t, regParam=0.5, elasticNetParam=1.0),
        "tree": regressors.tree_family(t, depth=4)["tree"],
    }
    return rows, regressors.train_all(rows, FEATURES, {24: LABEL}, make)[1]


@query("tune_top_k")
def _(spark, sf):
    """The three best models are searched around, over ranges, by successive halving."""
    rows, predictions = _trials(spark, sf)
    spaces = {
        "ols": (lambda t, **o: regressors.linear(t, **o), {"regParam": search.LogUniform(1e-4, 10.0)}),
        "lasso": (lambda t, **o: regressors.linear(t, elasticNetParam=1.0, **o), {"regParam": search.LogUniform(1e-3, 10.0)}),
        "tree": (lambda t, **o: regressors.tree_family(t, **o)["tree"], {"depth": search.Integer(3, 12), "leaf": search.Integer(1, 10)}),
    }
    return search.tune_top(rows, FEATURES, LABEL, predictions, spaces, k=3, n=4)[2]


PER_SERIES = ["temperature", "wind_speed"]


@query(
    "linear_per_series",
    using(
        "users",
        f"""SELECT station_id, n, {r('my - b1 * m1 - b2 * m2')} AS intercept, {r('b1')} AS temperature, {r('b2')} AS wind_speed,
        {r('CASE WHEN vy > 0 THEN (2 * (b1 * c1 + b2 * c2) - (b1 * b1 * v1 + 2 * b1 * b2 * c12 + b2 * b2 * v2)) / vy END')} AS r2
        FROM (SELECT *, CASE WHEN v1 > 0 THEN (c1 - c12 * b2) / v1 ELSE 0 END AS b1 FROM second) WHERE n >= 10""",
        sums="""SELECT station_id, count(*) AS n, avg(temperature) AS m1, avg(wind_speed) AS m2, avg(pm10) AS my,
        var_pop(temperature) AS v1, var_pop(wind_speed) AS v2, var_pop(pm10) AS vy, covar_pop(temperature, wind_speed) AS c12,
        covar_pop(temperature, pm10) AS c1, covar_pop(wind_speed, pm10) AS c2 FROM users GROUP BY 1""",
        first="""SELECT *, CASE WHEN v1 > 0 THEN v2 - c12 * c12 / v1 ELSE v2 END AS u, CASE WHEN v1 > 0 THEN c2 - c12 * c1 / v1 ELSE c2 END AS t FROM sums""",
        second="SELECT *, CASE WHEN u > 1e-10 * v2 THEN t / u ELSE 0 END AS b2 FROM first",
    ),
)
def _(spark, sf):
    """A model for each user's series, all from one aggregate."""
    return series_fit.fit_per_series(frames.user_hourly(spark, sf), PER_SERIES, "pm10").where("n >= 10")


@query(
    "focus_weighted_fit",
    using(
        "numbered",
        f"""SELECT {r('slope')} AS slope, {', '.join(r(f'max(my - slope * mx) FILTER (h = {h})') + f' AS intercept_{h}' for h in fixed.HORIZONS)}
        FROM by_horizon, (SELECT sum(w * sxy) / sum(w * sxx) AS slope FROM by_horizon) GROUP BY slope""",
        led="SELECT *, " + ", ".join(f"lead(numerical_aqi, {h}) OVER {BY} AS t{h}" for h in fixed.HORIZONS) + f", {SPLIT} AS split FROM numbered",
        long=" UNION ALL ".join(f"SELECT {h} AS h, pm2_5 AS x, t{h}::DOUBLE AS y FROM led WHERE split = 'train' AND t{h} IS NOT NULL" for h in fixed.HORIZONS),
        by_horizon=f"""SELECT h, CASE WHEN h = 48 THEN {focus.FOCUS_WEIGHT} ELSE 1 END AS w, avg(x) AS mx, avg(y) AS my,
        covar_pop(x, y) * count(*) AS sxy, var_pop(x) * count(*) AS sxx FROM long GROUP BY 1""",
    ),
)
def _(spark, sf):
    """Least squares over all horizons with the errors of the 48 h one counted twice."""
    rows = cut_lineage(splits.temporal_split(splits.future_targets(frames.indexed(spark, sf))), "led")
    _, model, columns, _, _ = focus.focused_fit(rows, ["pm2_5"], 48, {"ols": regressors.linear(focus.LABEL)})
    fitted = model.stages[-1]
    slope, *rest = (float(c) for c in fitted.coefficients)
    first = float(fitted.intercept)
    names = ", ".join(f"intercept_{h} double" for h in fixed.HORIZONS)
    return spark.createDataFrame([(slope, first, *(first + c for c in rest))], f"slope double, {names}")


@query("linear_blend")
def _(spark, sf):
    _, predictions = _trials(spark, sf)
    return metrics.regression_metrics(regressors.linear_blend(predictions, ["ols", "lasso", "tree"])[2])


@query("feature_importance")
def _(spark, sf):
    rows = table(spark, sf)
    model = regressors.train_one(small_boost(LABEL), rows, FEATURES)
    gain = selection.model_importance(model, FEATURES, spark).withColumnRenamed("importance", "gain")
    return selection.permutation_importance(model, rows, FEATURES, LABEL).join(F.broadcast(gain), "feature")


@query("select_features")
def _(spark, sf):
    rows = table(spark, sf)
    chosen = selection.select_features(rows, FEATURES, LABEL, k=5, rounds=3)
    return training.final_table(rows, chosen, fit_on=rows.where("split = 'train'"))


@query("forecast_latest")
def _(spark, sf):
    everything = table(spark, sf, trim=False)
    known = everything.na.drop(subset=list(fixed.TARGETS))
    models = regressors.per_horizon(known, FEATURES, regressors.linear)
    return forecast.forecast_latest(everything, FEATURES, models)


# From hourly rows to least squares on one cleaned column, per horizon: what the closed forms share.
LEAD_COLUMNS = ", ".join(f"t{h}" for h in fixed.HORIZONS)
ONE_FEATURE = dict(
    leads=LEADS,
    fences="SELECT station_id, quantile_cont(pm2_5, 0.25) AS a_pm2_5, quantile_cont(pm2_5, 0.75) AS b_pm2_5 FROM numbered GROUP BY 1",
    ready=f"""SELECT n.station_id, n.ts, {clip_sql('pm2_5')} AS x, {LEAD_COLUMNS} FROM numbered n JOIN leads l ON n.station_id = l.station_id
    AND n.ts = l.ts JOIN fences f ON f.station_id = n.station_id""",
    known="SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts) AS pos, count(*) OVER (PARTITION BY station_id) AS len FROM ready "
    "WHERE " + " AND ".join(f"t{h} IS NOT NULL" for h in fixed.HORIZONS),
    parted=f"SELECT *, {SPLIT} AS split FROM known",
    long=" UNION ALL ".join(f"SELECT station_id, ts, pos, len, split, x, {h} AS horizon, t{h}::DOUBLE AS y FROM parted" for h in fixed.HORIZONS),
    fits="SELECT horizon, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, avg(y) AS mean FROM long WHERE split = 'train' GROUP BY 1",
    told="SELECT station_id, ts, pos, len, split, horizon, y, intercept + slope * x AS p, mean AS weak FROM long JOIN fits USING (horizon)",
    newest="SELECT station_id, max(ts) AS ts, arg_max(x, ts) AS x FROM ready GROUP BY 1",
)
FORECAST_SQL = "SELECT station_id, ts AS base_timestamp, ts + to_hours(horizon) AS target_timestamp, horizon"


def one_feature(spark, sf):
    """The learning table of one cleaned column with its newest rows, and a fit for each horizon."""
    everything = daily.learning_table(frames.dense_hourly(spark, sf), ["pm2_5"], trim=False)
    known = everything.where("split <> 'latest'")
    return everything, known, regressors.per_horizon(known, ["pm2_5"], regressors.linear)


@query(
    "forecast_one_feature",
    using("numbered", f"{FORECAST_SQL}, {r('intercept + slope * x')} AS prediction FROM newest, fits", **ONE_FEATURE),
)
def _(spark, sf):
    """From hourly rows to forecasts with a closed form."""
    everything, _, models = one_feature(spark, sf)
    return forecast.forecast_latest(everything, ["pm2_5"], models)


@query(
    "backtest_one_feature",
    using(
        "numbered",
        f"""SELECT horizon, count(*) AS n, {r('sqrt(avg((y - p) ** 2))')} AS rmse, {r('1 - sum((y - p) ** 2) / (var_pop(y) * count(*))')} AS r2
        FROM told WHERE len >= 6 AND pos % (len // 6) = 0 AND pos // (len // 6) <= 5 GROUP BY 1""",
        **ONE_FEATURE,
    ),
)
def _(spark, sf):
    """Least squares of the train rows at five rolling origins of each series."""
    _, known, models = one_feature(spark, sf)
    return forecast.backtest_metrics(forecast.backtest(known, ["pm2_5"], models))


BLENDED = ["carry", "carry_day"]


@query(
    "blend_persistence",
    using(
        "predictions",
        f"""SELECT station_id, ts, {r('y')} AS y, {r('my + b1 * (p1 - m1) + b2 * (p2 - m2)')} AS p FROM wide, weights WHERE split = 'test'""",
        wide="""SELECT a.station_id, a.ts, a.split, a.y, a.p AS p1, b.p AS p2 FROM predictions a JOIN predictions b ON a.station_id = b.station_id
        AND a.ts = b.ts AND a.horizon = 24 AND b.horizon = 24 AND a.model = 'carry' AND b.model = 'carry_day'""",
        sums="""SELECT avg(p1) AS m1, avg(p2) AS m2, avg(y) AS my, var_pop(p1) AS v1, var_pop(p2) AS v2, covar_pop(p1, p2) AS c12,
        covar_pop(p1, y) AS c1, covar_pop(p2, y) AS c2 FROM wide WHERE split = 'validation'""",
        weights="SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM sums",
    ),
)
def _(spark, sf):
    """Two persistence forecasts blended with weights from the validation rows."""
    known = frames.naive_predictions(spark, sf).where("horizon = 24")
    return regressors.linear_blend(known, BLENDED)[2].select(*KEY, "y", "p")


@query("feature_attribution")
def _(spark, sf):
    """Mean size of each feature's share in the predictions of a boosted model, over all rows."""
    rows = table(spark, sf)
    model = regressors.train_one(small_boost(LABEL), rows, FEATURES)
    return attribution.mean_attribution(model, rows, FEATURES, KEY)


@query(
    "write_forecast",
    using(
        "numbered",
        f"""{FORECAST_SQL}, {r('intercept + slope * x')} AS prediction,
        md5(CAST(CAST(round(x, 6) AS DECIMAL(38, 6)) AS VARCHAR)) AS snapshot, 2::BIGINT AS n_files FROM newest, fits""",
        **ONE_FEATURE,
    ),
)
def _(spark, sf):
    """What stands in the JSON and, again, in the CSV file."""
    everything, _, models = one_feature(spark, sf)
    rows = forecast.forecast_latest(everything, ["pm2_5"], models)
    as_json, as_csv = sinks.write_forecast(rows, everything, ["pm2_5"], fresh_path(spark, "forecast"))
    schema = "station_id STRING, base_timestamp TIMESTAMP, target_timestamp TIMESTAMP, horizon INT, prediction DOUBLE, snapshot STRING"
    names = [part.split()[0] for part in schema.split(", ")]
    columns = spark.read.option("header", True).csv(as_csv)
    text = columns.select(*[F.col(n).cast(kind).alias(n) for n, kind in (part.split() for part in schema.split(", "))])
    both = spark.read.schema(schema).json(as_json).unionByName(text).withColumn("prediction", F.round("prediction", 9))
    return both.groupBy(*names).agg(F.count(F.lit(1)).alias("n_files"))


@query("backtest")
def _(spark, sf):
    rows = table(spark, sf)
    models = regressors.per_horizon(rows, FEATURES, regressors.linear)
    return forecast.backtest_metrics(forecast.backtest(rows, FEATURES, models))


@query("persistence_baseline", using("predictions", f"SELECT station_id, ts, split, model, horizon, {r('y')} AS y, {r('p')} AS p FROM predictions"))
def _(spark, sf):
    return frames.naive_predictions(spark, sf)


@query(
    "backtest_persistence",
    using(
        "numbered",
        f"""SELECT horizon, count(*) AS n, {r('sqrt(avg((y - p) ** 2))')} AS rmse, {r('1 - sum((y - p) ** 2) / (var_pop(y) * count(*))')} AS r2
        FROM (SELECT unnest([24, 48, 72]) AS horizon, unnest([y24, y48, y72]) AS y, numerical_aqi AS p FROM led
        WHERE len >= 6 AND pos % (len // 6) = 0 AND pos // (len // 6) <= 5) WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY 1""",
        led=f"SELECT *, lead(numerical_aqi, 24) OVER {BY} AS y24, lead(numerical_aqi, 48) OVER {BY} AS y48, lead(numerical_aqi, 72) OVER {BY} AS y72 FROM numbered",
    ),
)
def _(spark, sf):
    return forecast.backtest_metrics(baseline.persistence_backtest(frames.indexed(spark, sf)))


@query(
    "champion_gate",
    using(
        "scored",
        f"""SELECT horizon, {r('cand')} AS cand_rmse, {r('champ')} AS champ_rmse, {r('gain')} AS rel_gain,
        gain >= 0.02 AND (SELECT count(*) >= 500 FROM dense) AS promoted,
        {r('CASE WHEN gain >= 0.02 AND (SELECT count(*) >= 500 FROM dense) THEN cand ELSE champ END')} AS rmse,
        {r('CASE WHEN gain >= 0.02 AND (SELECT count(*) >= 500 FROM dense) THEN cand_r2 ELSE champ_r2 END')} AS r2 FROM (
        SELECT a.horizon, b.rmse AS cand, b.r2 AS cand_r2, a.rmse AS champ, a.r2 AS champ_r2,
        (a.rmse - b.rmse) / greatest(1e-9, a.rmse) AS gain FROM
        (SELECT * FROM scored WHERE split = 'validation' AND model = 'carry_day') a JOIN
        (SELECT * FROM scored WHERE split = 'validation' AND model = 'carry') b ON a.horizon = b.horizon)""",
    ),
)
def _(spark, sf):
    scores = metrics.regression_metrics(frames.naive_predictions(spark, sf)).where("split = 'validation'")
    return forecast.champion_gate(
        scores.where("model = 'carry'"), scores.where("model = 'carry_day'"), frames.dense_hourly(spark, sf)
    )


@query("per_horizon_train")
def _(spark, sf):
    rows = table(spark, sf)
    models = regressors.per_horizon(rows, FEATURES, small_boost)
    out = None
    for h, label in TARGETS.items():
        part = regressors.predict(models[h], rows, f"boosted_{h}", label, h)
        out = part if out is None else out.unionByName(part)
    return metrics.regression_metrics(out)


@query(
    "sequence_model_input",
    using(
        "users",
        f"""SELECT station_id, ts, {', '.join(r(f'lag(pm10, {k}) OVER {BY}') + f' AS pm10_t{k}' for k in range(6))}, {r('pm2_5')} AS label
        FROM users QUALIFY row_number() OVER {BY} >= 6""",
    ),
)
def _(spark, sf):
    rows = frames.user_hourly(spark, sf).select(*KEY, "pm10", "pm2_5")
    return forecast.flattened_sequences(rows, ["pm10"], "pm2_5", 6)


@query(
    "persist_model_and_features",
    using(
        "numbered",
        f"""SELECT 'pm2_5' AS model, horizon, split, count(*) AS n, {r('sqrt(avg((y - p) ** 2))')} AS rmse, {r('avg(abs(y - p))')} AS mae,
        {r('CASE WHEN var_pop(y) > 0 THEN 1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) END')} AS r2,
        {r('avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16))')} AS mape FROM told WHERE horizon = 24 GROUP BY ALL""",
        **ONE_FEATURE,
    ),
)
def _(spark, sf):
    """A pipeline read back from its files, with its feature list, scores like the fit in closed form."""
    _, known, models = one_feature(spark, sf)
    path = sinks.persist_model(models[24], ["pm2_5"], fresh_path(spark, "model"), spark)
    loaded, names = sinks.load_model(path, spark)
    return metrics.regression_metrics(regressors.predict(loaded, known, ",".join(names), LABEL, 24))


@query(
    "daily_run",
    using(
        "numbered",
        f"{FORECAST_SQL}, {r('CASE WHEN promoted THEN intercept + slope * x ELSE mean END')} AS prediction, promoted FROM newest, fits JOIN gated USING (horizon)",
        **ONE_FEATURE,
        errors="SELECT horizon, sqrt(avg((y - weak) ** 2)) AS champ, sqrt(avg((y - p) ** 2)) AS cand FROM told WHERE split = 'test' GROUP BY 1",
        gated="SELECT horizon, (champ - cand) / greatest(1e-9, champ) >= 0.02 AND (SELECT count(*) >= 500 FROM known) AS promoted FROM errors",
    ),
)
def _(spark, sf):
    """Two runs: the first one's champions know only the mean, and the second one's candidates replace some of them."""
    registry = Registry(spark, fresh_path(spark, "registry"))
    rows = cut_lineage(frames.dense_hourly(spark, sf), "dense")
    daily.daily_run(rows, ["pm2_5"], lambda t: regressors.linear(t, regParam=1e6, elasticNetParam=1.0), registry, datetime(2024, 2, 1))
    run = daily.daily_run(rows, ["pm2_5"], regressors.linear, registry, datetime(2024, 2, 2))
    return run.forecast.join(run.decisions.select("horizon", "promoted"), "horizon")


STRENGTHS = {"first": ("carry_two_days", "2024-02-01"), "second": ("carry_day", "2024-02-02"), "third": ("carry", "2024-02-03")}


@query(
    "champion_history",
    using(
        "scored",
        f"""SELECT horizon, model || '-' || horizon AS path, {r('rmse')} AS rmse, {r('r2')} AS r2, valid_from,
        lead(valid_from) OVER (PARTITION BY horizon ORDER BY valid_from) AS valid_to FROM (
        SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three)""",
        tried="SELECT horizon, model, rmse, r2 FROM scored WHERE split = 'test'",
        one="SELECT horizon, model, rmse, r2, TIMESTAMP '2024-02-01' AS valid_from FROM tried WHERE model = 'carry_two_days'",
        two="""SELECT t.horizon, t.model, t.rmse, t.r2, TIMESTAMP '2024-02-02' AS valid_from FROM tried t JOIN one USING (horizon)
        WHERE t.model = 'carry_day' AND (one.rmse - t.rmse) / greatest(1e-9, one.rmse) >= 0.02 AND (SELECT count(*) >= 500 FROM dense)""",
        best="SELECT horizon, arg_max(rmse, valid_from) AS rmse FROM (SELECT * FROM one UNION ALL SELECT * FROM two) GROUP BY 1",
        three="""SELECT t.horizon, t.model, t.rmse, t.r2, TIMESTAMP '2024-02-03' AS valid_from FROM tried t JOIN best USING (horizon)
        WHERE t.model = 'carry' AND (best.rmse - t.rmse) / greatest(1e-9, best.rmse) >= 0.02 AND (SELECT count(*) >= 500 FROM dense)""",
    ),
)
def _(spark, sf):
    """The registry after three runs of the gate over the persistence forecasts."""
    return champion_runs(spark, sf).history()


def champion_runs(spark, sf):
    registry = Registry(spark, fresh_path(spark, "registry"))
    table = cut_lineage(frames.dense_hourly(spark, sf), "dense")
    scores = cut_lineage(metrics.regression_metrics(frames.naive_predictions(spark, sf)).where("split = 'test'"), "scores")
    for model, day in STRENGTHS.values():
        own = scores.where(F.col("model") == model).withColumn("path", F.concat_ws("-", "model", "horizon"))
        registry.record(gate(own, registry, table), datetime.fromisoformat(day))
    return registry


@query(
    "champion_as_of",
    using(
        "scored",
        f"""SELECT horizon, CASE WHEN promoted THEN 'carry_day-' ELSE 'carry_two_days-' END || horizon AS path,
        {r('CASE WHEN promoted THEN cand ELSE champ END')} AS rmse FROM (
        SELECT a.horizon, a.rmse AS champ, b.rmse AS cand, (a.rmse - b.rmse) / greatest(1e-9, a.rmse) >= 0.02
        AND (SELECT count(*) >= 500 FROM dense) AS promoted FROM
        (SELECT * FROM scored WHERE split = 'test' AND model = 'carry_two_days') a JOIN
        (SELECT * FROM scored WHERE split = 'test' AND model = 'carry_day') b ON a.horizon = b.horizon)""",
    ),
)
def _(spark, sf):
    """Which model forecast at noon after the second run."""
    return champion_runs(spark, sf).champions(datetime(2024, 2, 2, 12)).select("horizon", "path", "rmse")
