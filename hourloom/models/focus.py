"""One model for all horizons that counts errors of one of them more: rows are copied once for each horizon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions import fixed
from hourloom.models import regressors
from hourloom.operators import metrics
from hourloom.operators.layout import KEYS, TIME

LABEL, WEIGHT = "y", "row_weight"
FOCUS_WEIGHT = 2.0


def horizon_columns(horizons=fixed.HORIZONS) -> list[str]:
    return [f"is_{h}h" for h in horizons[1:]]


def horizon_rows(df: DataFrame, focus: int, weight: float = FOCUS_WEIGHT, horizons=fixed.HORIZONS, targets=fixed.TARGETS) -> DataFrame:
    """Rows (…, horizon, y, row_weight) with a flag for each horizon but the first; unknown targets drop out."""
    each = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(t).cast("double").alias(LABEL)) for h, t in zip(horizons, targets)])
    long = df.withColumn("_h", F.explode(each)).select("*", "_h.*").drop("_h").where(F.col(LABEL).isNotNull())
    flags = {name: (F.col("horizon") == h).cast("double") for name, h in zip(horizon_columns(horizons), horizons[1:])}
    return long.withColumns({WEIGHT: F.when(F.col("horizon") == focus, F.lit(float(weight))).otherwise(F.lit(1.0)), **flags})


def weighted(estimator):
    return estimator.copy().setWeightCol(WEIGHT)


def focused_fit(df: DataFrame, features: list[str], focus: int, estimators: dict, weight: float = FOCUS_WEIGHT, keys=KEYS, ts=TIME):
    """Fit every estimator (name -> estimator of label ``y``) on the weighted rows, and choose by the error that counts
    the focus horizon as often on the validation rows.

    Returns (name of the best, its model, its columns, errors by model, predictions in long form).
    """
    columns = [*features, *horizon_columns()]
    rows = horizon_rows(df, focus, weight)
    models, scored = {}, None
    for name, estimator in estimators.items():
        models[name] = regressors.train_one(weighted(estimator), rows, columns)
        part = models[name].transform(rows).select(
            *keys, ts, F.lit(name).alias("model"), "horizon", "split", F.col(LABEL), F.col("prediction").alias("p")
        )
        scored = part if scored is None else scored.unionByName(part)
    errors = metrics.weighted_horizon_error(scored.where("split = 'validation'"), focus, weight)
    best = errors.orderBy("weighted_mse", "model").first()
    name = best.model if best else next(iter(models))
    return name, models[name], columns, errors, scored
