"""Forecasts from the newest rows, backtests, and the champion gate."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions import clock, fixed
from hourloom.models import regressors
from hourloom.operators import guards, joins, metrics, splits
from hourloom.operators.layout import KEYS, TIME


def forecast_latest(
    table: DataFrame, features: list[str], models: dict[int, PipelineModel | None], keys=KEYS, ts: str = TIME
) -> DataFrame:
    """One row per series and horizon from the newest feature row.

    A horizon without a model gives NULL, except that a missing longer horizon carries the
    24 h value when no longer-horizon model exists at all.
    """
    latest = splits.latest_rows(regressors.prepared(table, features), 1, keys, ts)
    wide = latest.select(*keys, ts, *features)
    for h in fixed.HORIZONS:
        if models.get(h) is not None:
            scored = models[h].transform(wide)
            wide = scored.withColumn(f"_p{h}", F.col("prediction")).drop("prediction", regressors.FEATURES)
        else:
            wide = wide.withColumn(f"_p{h}", F.lit(None).cast("double"))
    if all(models.get(h) is None for h in fixed.HORIZONS[1:]):
        wide = wide.withColumns({f"_p{h}": F.col(f"_p{fixed.HORIZONS[0]}") for h in fixed.HORIZONS[1:]})
    value = F.coalesce(*[F.when(F.col("horizon") == h, F.col(f"_p{h}")) for h in fixed.HORIZONS])
    long = clock.explode_horizons(wide, ts)
    return long.select(*keys, F.col(ts).alias("base_timestamp"), "target_timestamp", "horizon", value.alias("prediction"))


def backtest(
    table: DataFrame,
    features: list[str],
    models: dict[int, PipelineModel],
    folds: int = 5,
    min_rows: int = 0,
    keys=KEYS,
    ts: str = TIME,
) -> DataFrame:
    """Truth and prediction at every rolling origin, long by horizon."""
    origins = splits.fold_origins(regressors.prepared(table, features), folds, min_rows, keys, ts)
    out = None
    for h, model in models.items():
        part = model.transform(origins).select(
            *keys,
            "fold",
            F.lit(h).alias("horizon"),
            F.col(f"target_aqi_{h}h").cast("double").alias("y"),
            F.col("prediction").alias("p"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def backtest_metrics(results: DataFrame) -> DataFrame:
    return metrics.regression_metrics(results, by=("horizon",)).select("horizon", "n", "rmse", "r2")


def champion_gate(
    candidates: DataFrame,
    champions: DataFrame | None,
    table: DataFrame,
    threshold: float = 0.02,
    min_rows: int = 500,
) -> DataFrame:
    """Registry after the gate: candidates replace champions that they beat by the threshold.

    Without a registry nothing is promoted; the registry is seeded with the candidates' own
    metrics, against which the next run competes. A table that fails the quality
    check blocks promotion.
    """
    if champions is None:
        return candidates.select(
            "horizon",
            F.col("rmse").alias("cand_rmse"),
            F.lit(None).cast("double").alias("champ_rmse"),
            F.lit(None).cast("double").alias("rel_gain"),
            F.lit(False).alias("promoted"),
            *([F.col("path").alias("cand_path")] if "path" in candidates.columns else []),
            "rmse",
            "r2",
            *(["path"] if "path" in candidates.columns else []),
        )
    allowed = guards.quality_gate(table, min_rows).select("passed").scalar()
    return joins.promotion_join(candidates, champions, threshold, allowed)


def flattened_sequences(df: DataFrame, features: list[str], label: str, length: int, keys=KEYS, ts: str = TIME) -> DataFrame:
    """History windows as lag columns ``{feature}_t{k}`` (k rows back), for tree models."""
    windows = splits.sequence_windows(df, features, label, length, keys=keys, ts=ts)
    lags = [
        F.col("seq")[length - 1 - k][f].alias(f"{f}_t{k}") for f in features for k in range(length)
    ]
    return windows.select(*keys, ts, *lags, "label")

