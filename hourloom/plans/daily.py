"""PL5: quality gate, one model per horizon, champion gate, forecast from the newest rows with the valid champions."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions import fixed
from hourloom.models import forecast, regressors
from hourloom.models.registry import Registry, gate
from hourloom.operators import layout, metrics, splits
from hourloom.plans import training
from hourloom.session import cut_lineage
from hourloom.sources import sinks


@dataclass(frozen=True)
class DailyRun:
    decisions: DataFrame
    forecast: DataFrame
    scores: DataFrame


def learning_table(df: DataFrame, features: list[str], keys=layout.KEYS, ts=layout.TIME, trim: bool = True) -> DataFrame:
    """The chosen features with targets and split, stored once for the many passes of training.

    The split is taken over the rows whose targets are known; without ``trim`` the newest rows, whose targets are not,
    are there as split ``latest``.
    """
    table = training.training_table(df, keys, ts, trim, only=features).select(*keys, ts, *features, *fixed.TARGETS)
    ready = regressors.prepared(table, features)
    if trim:
        return cut_lineage(splits.temporal_split(ready, keys=keys, ts=ts), "learning")
    ready = cut_lineage(ready, "prepared")
    known = ready.na.drop(subset=list(fixed.TARGETS))
    unknown = ready.where(" OR ".join(f"{t} IS NULL" for t in fixed.TARGETS)).withColumn("split", F.lit("latest"))
    return cut_lineage(splits.temporal_split(known, keys=keys, ts=ts).unionByName(unknown), "learning")


def daily_run(
    hourly: DataFrame, features: list[str], make, registry: Registry, at: datetime | None = None, keys=layout.KEYS, ts=layout.TIME
) -> DailyRun:
    """``make(label)`` builds the estimator of a horizon.

    The candidates are stored below the registry, scored on the test rows and set against the present champions. What
    the gate decides is recorded, and the forecast comes from the models that are valid after it: a candidate that
    failed is never used.
    """
    at = at or datetime.now(timezone.utc)
    everything = learning_table(hourly, features, keys, ts, trim=False)
    known = everything.where("split <> 'latest'")
    models = regressors.per_horizon(known, features, make)
    run = f"{registry.root}/models/run={at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"
    paths = {h: sinks.persist_model(m, features, f"{run}/horizon={h}", hourly.sparkSession) for h, m in models.items()}
    predictions = None
    for h, label in zip(fixed.HORIZONS, fixed.TARGETS):
        part = regressors.predict(models[h], known.where("split = 'test'"), "candidate", label, h, (*keys, ts))
        predictions = part if predictions is None else predictions.unionByName(part)
    scores = cut_lineage(metrics.regression_metrics(predictions, by=("horizon",)), "scores")
    path = F.coalesce(*[F.when(F.col("horizon") == h, F.lit(p)) for h, p in paths.items()])
    decisions = cut_lineage(gate(scores.withColumn("path", path), registry, known), "decisions")
    registry.record(decisions, at)
    valid = registry.models(fresh={paths[h]: m for h, m in models.items()})
    return DailyRun(decisions, forecast.forecast_latest(everything, features, valid, keys, ts), scores)
