"""Nearest-neighbour regression without forming all pairs across the cluster.

Training rows belong to the cell of their nearest pivot. From the distances to the pivots
and the cell radii a query knows which cells can hold one of its k neighbours and visits
only those; the triangle inequality makes that exact. Cells are cut into chunks of bounded
size on both sides, so a cell that holds a third of all rows is many small tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.session import cut_lineage

MAX_PIVOTS = 2048
CHUNK_ROWS = 20_000


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, 0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise Euclidean distances, summed dimension by dimension in bounded slices."""
    out = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        out += (a[:, d, None] - b[None, :, d]) ** 2
    return np.sqrt(out)


def knn_regress(
    train: DataFrame, queries: DataFrame, features: list[str], label: str, key: list[str], k: int = 15
) -> DataFrame:
    """Prediction per query row: mean of the k nearest labels weighted by 1 / distance.

    If neighbours coincide with the query, only those count. Equal distances are taken in
    the order of the training key. Returns (key, prediction).
    """
    vector = F.array(*[F.col(c).cast("double") for c in features])
    ident = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    base = train.select(ident.alias("t"), vector.alias("v"), F.col(label).cast("double").alias("y"))
    asked = queries.select(*key, ident.alias("q"), vector.alias("v"))
    n = base.count()
    wanted = max(1, min(MAX_PIVOTS, math.isqrt(n)))
    # the pivots steer the work, not the result; their number is bounded
    pivots = np.array([r.v for r in base.orderBy(F.xxhash64("t", F.lit(42))).limit(wanted).select("v").collect()])

    def assign(batches):
        for rows in batches:
            d = _distances(_matrix(rows["v"]), pivots) if len(rows) else np.empty((0, 1))
            rows = rows.assign(cell=d.argmin(axis=1).astype("int32"), away=d.min(axis=1))
            yield rows

    celled = cut_lineage(base.mapInPandas(assign, "t string, v array<double>, y double, cell int, away double"), "cells")
    stats = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect()
    cells = np.array([s.cell for s in stats])
    sizes, radii = np.array([s.n for s in stats]), np.array([s.r for s in stats])
    chunks = np.maximum(1, -(-sizes // CHUNK_ROWS))
    enough = min(k, int(sizes.sum()))

    def visit(batches):
        for rows in batches:
            if not len(rows):
                continue
            d = _distances(_matrix(rows["v"]), pivots[cells])
            reach = d + radii
            order = np.argsort(reach, axis=1)
            filled = np.cumsum(sizes[order], axis=1) >= enough
            bound = np.take_along_axis(reach, order, axis=1)[np.arange(len(rows)), filled.argmax(axis=1)]
            row, cell = np.nonzero(d - radii <= bound[:, None] * (1 + 1e-9))
            out = rows.iloc[row][["q", "v"]].assign(cell=cells[cell].astype("int32"))
            yield out

    visits = cut_lineage(asked.select("q", "v").mapInPandas(visit, "q string, v array<double>, cell int"), "visits")
    per_cell = {r.cell: r["count"] for r in visits.groupBy("cell").count().collect()}
    plan = [
        (int(c), int(n), max(1, -(-per_cell.get(int(c), 0) // CHUNK_ROWS))) for c, n in zip(cells, chunks)
    ]
    # at most MAX_PIVOTS rows
    parts = F.broadcast(train.sparkSession.createDataFrame(plan, "cell int, chunks int, slices int"))
    left = celled.join(parts, "cell").select(
        "cell",
        "t",
        "v",
        "y",
        F.pmod(F.xxhash64("t"), F.col("chunks")).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
    )
    right = visits.join(parts, "cell").select(
        "cell",
        "q",
        "v",
        F.pmod(F.xxhash64("q"), F.col("slices")).cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
    )

    def search(near: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(near) or not len(ask):
            return pd.DataFrame({"q": [""], "t": [""], "d": [0.0], "y": [0.0]}).iloc[:0]
        near = near.sort_values("t", kind="stable")
        points, names, labels = _matrix(near["v"]), near["t"].to_numpy(), near["y"].to_numpy()
        asked_names, vectors = ask["q"].to_numpy(), _matrix(ask["v"])
        found = {"q": [], "t": [], "d": [], "y": []}
        for start in range(0, len(ask), 256):
            d = _distances(vectors[start : start + 256], points)
            best = np.argsort(d, axis=1, kind="stable")[:, :k]
            found["q"].append(np.repeat(asked_names[start : start + 256], best.shape[1]))
            found["t"].append(names[best].ravel())
            found["d"].append(np.take_along_axis(d, best, axis=1).ravel())
            found["y"].append(labels[best].ravel())
        return pd.DataFrame({name: np.concatenate(parts) for name, parts in found.items()})

    by = ["cell", "chunk", "slice"]
    local = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(search, "q string, t string, d double, y double")
    nearest = local.withColumn("_n", F.row_number().over(Window.partitionBy("q").orderBy("d", "t"))).where(F.col("_n") <= k)
    hit = F.col("d") == 0
    weight = F.when(hit, F.lit(None)).otherwise(1 / F.col("d"))
    answer = nearest.groupBy("q").agg(
        F.coalesce(
            F.avg(F.when(hit, F.col("y"))), F.try_divide(F.sum(weight * F.col("y")), F.sum(weight))
        ).alias("prediction")
    )
    return asked.select(*key, "q").join(answer, "q").drop("q")
