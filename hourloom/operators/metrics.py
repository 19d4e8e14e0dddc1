"""Forecast errors, rankings and verdicts on metric tables.

Predictions come in long form: (model, horizon, split, y, p).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPSILON = 2.220446049250313e-16


def regression_metrics(predictions: DataFrame, by=("model", "horizon", "split")) -> DataFrame:
    """RMSE, MAE, R2, MAPE (a fraction) per group, in one aggregation.

    ``n * var_pop(y)`` is the total sum of squares, computed by Spark's mergeable moments.
    """
    error = F.col("y") - F.col("p")
    known = predictions.where(F.col("y").isNotNull() & F.col("p").isNotNull())
    out = known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(error * error).alias("_sse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop("y").alias("_var"),
        F.avg(F.abs(error) / F.greatest(F.abs(F.col("y")), F.lit(EPSILON))).alias("mape"),
    )
    total = F.col("_var") * F.col("n")
    return out.select(
        *by,
        "n",
        F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"),
        "mae",
        F.when(total > 0, 1 - F.col("_sse") / total).alias("r2"),
        "mape",
    )


def macro_average(metrics: DataFrame, by=("model",)) -> DataFrame:
    return metrics.groupBy(*by).agg(*[F.avg(m).alias(m) for m in ("rmse", "mae", "r2", "mape")])


def weighted_horizon_error(predictions: DataFrame, focus: int, weight: float = 2.0) -> DataFrame:
    """Mean squared error with the focus horizon counted ``weight`` times."""
    error = F.col("y") - F.col("p")
    factor = F.when(F.col("horizon") == focus, F.lit(weight)).otherwise(F.lit(1.0))
    return predictions.groupBy("model").agg(F.avg(factor * error * error).alias("weighted_mse"))


def best_per_horizon(metrics: DataFrame) -> DataFrame:
    """Model with the smallest RMSE; the name decides a tie."""
    key = F.struct("rmse", "model")
    return metrics.groupBy("horizon").agg(F.min(key).alias("_b")).select(
        "horizon", F.col("_b.model").alias("model"), F.col("_b.rmse").alias("rmse")
    )


def leaderboard(metrics: DataFrame, by=("horizon",)) -> DataFrame:
    return metrics.withColumn("rank", F.rank().over(Window.partitionBy(*by).orderBy("rmse")))


def top_models(metrics: DataFrame, k: int = 3, by=("horizon",)) -> DataFrame:
    w = Window.partitionBy(*by).orderBy("rmse", "model")
    return metrics.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def improvement_rate(compared: DataFrame) -> DataFrame:
    """Share of comparable models that improved, with a verdict."""
    known = F.count_if(F.col("status") != "new")
    better = F.count_if(F.col("status") == "better")
    rate = F.try_divide(better * 100.0, known.cast("double"))
    out = compared.agg(better.alias("n_improved"), known.alias("n_comparable"), rate.alias("rate_pct"))
    verdict = (
        F.when(F.col("rate_pct").isNull(), "none")
        .when(F.col("rate_pct") >= 60, "excellent")
        .when(F.col("rate_pct") >= 40, "good")
        .when(F.col("rate_pct") >= 20, "moderate")
        .otherwise("poor")
    )
    return out.withColumn("verdict", verdict)


def leak_verdict(r2: Column) -> Column:
    return F.when(r2 > 0.95, "suspicious").when(r2 > 0.8, "realistic").when(r2.isNotNull(), "moderate")
