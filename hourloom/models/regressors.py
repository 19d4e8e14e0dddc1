"""Spark ML regressors on the training table: fitting, scoring, searching, blending."""

from __future__ import annotations

import math
import random
from collections.abc import Iterable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions import fixed
from hourloom.operators import metrics

FEATURES = "features"


def assemble(features: list[str], invalid: str = "keep") -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=FEATURES, handleInvalid=invalid)


def prepared(df: DataFrame, features: list[str]) -> DataFrame:
    """NULL, NaN and infinite feature values become 0."""
    from hourloom.functions.air import finite

    return df.withColumns({c: F.coalesce(finite(F.col(c).cast("double")), F.lit(0.0)) for c in features})


def linear(label: str, **options) -> LinearRegression:
    return LinearRegression(
        featuresCol=FEATURES, labelCol=label, predictionCol="prediction", standardization=False, **options
    )


def linear_family(train: DataFrame, label: str, ridge: float = 5.0, lasso: float = 0.01) -> dict:
    """Least squares, ridge and lasso.

    Spark scales the label inside the solver, so a ridge penalty ``a`` on the sum of
    squared errors is ``a * std(y) / n`` here; a lasso penalty maps directly.
    """
    n, std = train.agg(F.count(label), F.stddev_pop(label)).first()
    return {
        "ols": linear(label),
        "ridge": linear(label, regParam=ridge * (std or 1.0) / max(n, 1), elasticNetParam=0.0),
        "lasso": linear(label, regParam=lasso, elasticNetParam=1.0),
    }


def tree_family(label: str, trees: int = 500, depth: int = 12, leaf: int = 5, seed: int = 42) -> dict:
    common = {"featuresCol": FEATURES, "labelCol": label, "seed": seed}
    return {
        "forest": RandomForestRegressor(numTrees=trees, maxDepth=depth, subsamplingRate=0.8, **common),
        "tree": DecisionTreeRegressor(maxDepth=depth, minInstancesPerNode=leaf, **common),
    }


def boosted(label: str, rounds: int = 200, depth: int = 6, step: float = 0.05, seed: int = 42, early: bool = True):
    """Gradient-boosted trees; with ``early`` rows flagged ``is_val`` decide when to stop."""
    model = GBTRegressor(
        featuresCol=FEATURES, labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step,
        subsamplingRate=0.8, seed=seed,
    )
    return model.setValidationIndicatorCol("is_val") if early else model


def fit(estimator, df: DataFrame, features: list[str]) -> PipelineModel:
    return Pipeline(stages=[assemble(features), estimator]).fit(df)


def predict(model: PipelineModel, df: DataFrame, name: str, label: str, horizon: int, keep=("station_id", "ts")):
    """Long predictions (keys, model, horizon, split, y, p)."""
    out = model.transform(df)
    split = F.col("split") if "split" in df.columns else F.lit("all")
    return out.select(
        *keep,
        F.lit(name).alias("model"),
        F.lit(horizon).alias("horizon"),
        split.alias("split"),
        F.col(label).cast("double").alias("y"),
        F.col("prediction").alias("p"),
    )


def by_split(df: DataFrame) -> DataFrame:
    """Rows models learn from, with the validation rows flagged for early stopping."""
    return df.where(F.col("split").isin("train", "validation")).withColumn("is_val", F.col("split") == "validation")


def train_one(estimator, df: DataFrame, features: list[str]) -> PipelineModel:
    """Fit on the train rows; an estimator that stops early also sees the validation rows."""
    stops_early = estimator.hasParam("validationIndicatorCol") and estimator.isSet("validationIndicatorCol")
    return fit(estimator, by_split(df) if stops_early else df.where("split = 'train'"), features)


def train_all(df: DataFrame, features: list[str], targets: dict[int, str], estimators) -> tuple[dict, DataFrame]:
    """Fit every estimator for every horizon. ``estimators(label)`` gives name -> estimator.

    Returns the models by (name, horizon) and all predictions in long form. The loop is over
    models; each fit and each scoring is a distributed job.
    """
    models, scored = {}, None
    for horizon, label in targets.items():
        for name, estimator in estimators(label).items():
            model = train_one(estimator, df, features)
            models[name, horizon] = model
            part = predict(model, df, name, label, horizon)
            scored = part if scored is None else scored.unionByName(part)
    return models, scored


def leaderboard(predictions: DataFrame, split: str = "validation") -> DataFrame:
    scores = metrics.regression_metrics(predictions.where(F.col("split") == split))
    return metrics.leaderboard(scores)


def grid(space: dict[str, Iterable]) -> list[dict]:
    out = [{}]
    for name, values in space.items():
        out = [{**one, name: v} for one in out for v in values]
    return out


def random_draws(space: dict[str, Iterable], n: int, seed: int = 42) -> list[dict]:
    """n distinct settings of the grid, drawn with a seed."""
    every = grid(space)
    return random.Random(seed).sample(every, min(n, len(every)))


def validation_rmse(model: PipelineModel, df: DataFrame, label: str) -> float:
    rows = model.transform(df.where("split = 'validation'"))
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse").evaluate(rows)


def param_search(df, features, label, make, settings: list[dict]):
    """Best setting by validation RMSE. ``make(label, **setting)`` builds the estimator.

    Returns (model, setting, results table).
    """
    best, rows = None, []
    for i, setting in enumerate(settings):
        model = train_one(make(label, **setting), df, features)
        error = validation_rmse(model, df, label)
        rows.append((i, str(sorted(setting.items())), float(error)))
        if best is None or error < best[2]:
            best = (model, setting, error)
    table = df.sparkSession.createDataFrame(rows, "trial int, setting string, rmse double")
    return best[0], best[1], table


def contiguous_cv(df, features, label, estimator, settings: dict[str, list], folds: int = 2, parallelism: int = 2):
    """Cross-validation over unshuffled folds (column ``fold``), by squared error."""
    builder = ParamGridBuilder()
    for name, values in settings.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    maps = builder.build()
    vectors = assemble(features).transform(df)
    judge = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="mse")
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, evaluator=judge, numFolds=folds, foldCol="fold",
        parallelism=parallelism,
    )
    fitted = search.fit(vectors)
    rows = [
        (str(sorted((p.name, v) for p, v in m.items())), float(e)) for m, e in zip(maps, fitted.avgMetrics)
    ]
    return fitted, df.sparkSession.createDataFrame(rows, "setting string, mse double")


def linear_blend(predictions: DataFrame, names: list[str], keys=("station_id", "ts")) -> tuple[dict, float, DataFrame]:
    """Least squares over validation predictions of the named models, applied to the test rows.

    Returns weights, intercept and the blended predictions of one horizon.
    """
    wide = (
        predictions.where(F.col("model").isin(names))
        .groupBy(*keys, "horizon", "split")
        .pivot("model", names)
        .agg(F.first("p"))
        .na.drop(subset=names)
    )
    truth = predictions.where(F.col("model") == names[0]).select(*keys, "horizon", "split", "y")
    rows = wide.join(truth, [*keys, "horizon", "split"])
    model = fit(linear("y"), rows.where("split = 'validation'"), names)
    weights = dict(zip(names, (float(w) for w in model.stages[-1].coefficients)))
    out = predict_blend(rows.where("split = 'test'"), weights, float(model.stages[-1].intercept), keys)
    return weights, float(model.stages[-1].intercept), out


def predict_blend(wide: DataFrame, weights: dict, intercept: float, keys=("station_id", "ts")) -> DataFrame:
    from hourloom.functions.air import blend

    return wide.select(
        *keys, F.lit("blend").alias("model"), "horizon", "split", "y", blend(weights, intercept).alias("p")
    )


def per_horizon(df: DataFrame, features: list[str], make, targets=fixed.TARGETS, horizons=fixed.HORIZONS) -> dict:
    """One model per horizon, each fitted to its own target."""
    return {h: train_one(make(t), df, features) for h, t in zip(horizons, targets)}
