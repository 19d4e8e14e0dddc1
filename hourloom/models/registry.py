"""Champions as a history: which model of each horizon was valid when, with its path and scores.

A row is an interval. Recording a run closes the interval of every horizon whose champion is replaced and opens a new
one; nothing is overwritten, so the state at any time can be read again, and a forecast can be traced to its model. The
history (a row for each promotion) and the log of decisions are written as a new version each time, in one file that
appears whole or not at all.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.models import forecast

HISTORY = "horizon int, path string, rmse double, r2 double, valid_from timestamp, valid_to timestamp"
DECISIONS = (
    "run_at timestamp, horizon int, cand_path string, cand_rmse double, champ_rmse double, rel_gain double, promoted boolean"
)


def moment(at) -> Column:
    """A time as a column; one without a zone is in the session's."""
    return at if isinstance(at, Column) else F.lit(str(at)).cast("timestamp")


def recorded(history: DataFrame, decisions: DataFrame, at: datetime) -> DataFrame:
    """The history after a run: ``decisions`` are (horizon, promoted, path, rmse, r2), one row for each horizon, where
    path and scores are those of the champion after the gate. A horizon without a champion so far gets its first one."""
    now = moment(at)
    current = history.where("valid_to IS NULL").select("horizon", F.lit(True).alias("_has"))
    news = decisions.join(current, "horizon", "left").where(F.col("promoted") | F.col("_has").isNull())
    news = news.where(F.col("path").isNotNull()).select("horizon", "path", "rmse", "r2")
    closed = history.join(news.select("horizon", F.lit(True).alias("_new")), "horizon", "left").select(
        *[F.col(c) for c in ("horizon", "path", "rmse", "r2", "valid_from")],
        F.when(F.col("valid_to").isNull() & F.col("_new"), now).otherwise(F.col("valid_to")).alias("valid_to"),
    )
    return closed.unionByName(news.withColumn("valid_from", now).withColumn("valid_to", F.lit(None).cast("timestamp")))


def valid_at(history: DataFrame, at=None) -> DataFrame:
    """The champion of each horizon at a time (a moment or a column); by default the present one."""
    if at is None:
        return history.where("valid_to IS NULL")
    at = moment(at)
    return history.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def with_champion(rows: DataFrame, history: DataFrame, ts: str) -> DataFrame:
    """rows of (ts, horizon, …) with the path of the model that was valid then; NULL before the first one. The history
    is small and joined by horizon, its intervals do not overlap."""
    spans = history.select(F.col("horizon").alias("_h"), "path", "valid_from", "valid_to")
    when = (F.col(ts) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(ts) < F.col("valid_to")))
    return rows.join(spans, (F.col("horizon") == F.col("_h")) & when, "left").drop("_h", "valid_from", "valid_to")


@dataclass(frozen=True)
class Registry:
    spark: SparkSession
    root: str

    def _read(self, name: str, schema: str, version: int | None = None) -> tuple[DataFrame, int]:
        try:
            rows = self.spark.read.schema(f"{schema}, version int").option("basePath", f"{self.root}/{name}").parquet(f"{self.root}/{name}/version=*")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema), 0
        newest = rows.agg(F.max("version")).first()[0] or 0
        return rows.where(F.col("version") == (newest if version is None else version)).drop("version"), newest

    def history(self) -> DataFrame:
        return self._read("history", HISTORY)[0]

    def decisions(self) -> DataFrame:
        """What the gate decided in every run, promoted or not."""
        return self._read("decisions", DECISIONS)[0]

    def champions(self, at=None) -> DataFrame:
        return valid_at(self.history(), at)

    def record(self, gated: DataFrame, at: datetime) -> None:
        """Add a run. ``gated`` is the result of the champion gate with paths."""
        history, version = self._read("history", HISTORY)
        # read whole before anything is written: a few rows for each run
        rows = recorded(history, gated, at).select("horizon", "path", "rmse", "r2", "valid_from", "valid_to").collect()
        told, _ = self._read("decisions", DECISIONS)
        log = told.unionByName(gated.select(moment(at).alias("run_at"), "horizon", "cand_path", "cand_rmse", "champ_rmse", "rel_gain", "promoted"))
        log = log.collect()
        for name, kept, schema in (("decisions", log, DECISIONS), ("history", rows, HISTORY)):
            self.spark.createDataFrame(kept, schema).coalesce(1).write.parquet(f"{self.root}/{name}/version={version + 1}")

    def models(self, at=None, fresh: dict[str, PipelineModel] | None = None) -> dict[int, PipelineModel]:
        """The valid model of each horizon; those in ``fresh`` (by path) need not be read."""
        fresh = fresh or {}
        return {
            r.horizon: fresh[r.path] if r.path in fresh else PipelineModel.load(f"{r.path}/model") for r in self.champions(at).collect()
        }


def gate(candidates: DataFrame, registry: Registry, table: DataFrame, threshold: float = 0.02, min_rows: int = 500) -> DataFrame:
    """The champion gate against the present champions. ``candidates`` are (horizon, rmse, r2, path). A horizon without
    a champion takes its candidate as the first one, without a promotion."""
    champions = registry.champions()
    seeded = forecast.champion_gate(candidates.join(champions, "horizon", "left_anti"), None, table)
    return seeded.unionByName(forecast.champion_gate(candidates, champions, table, threshold, min_rows))
