"""Rows of vectors: which of them count, and their integer components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Beyond this magnitude (of a component after scaling) integers are counted in Python's own, which have no limit.
PLAIN = float(1 << 26)


def whole_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not null and holds no null, NaN or infinite component, and no fewer than the longest such
    vector: a missing component counts as null. Column ``vector`` is made an array of doubles."""
    values = F.col(f"`{vector}`").cast("array<double>")
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    sound = rows.where(values.isNotNull() & ~odd).withColumn(vector, values)
    longest = sound.agg(F.max(F.size(vector))).first()[0] or 0
    return sound.where(F.size(vector) == longest) if longest else sound.where(F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """An array column without nulls and of one length as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def floors(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * value), for a scale that is a power of two: 64-bit integers, or Python's own if some are too large
    to be squared and summed so."""
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * values)
    if not scaled.size or np.abs(scaled).max() < PLAIN:
        return scaled.astype(np.int64)
    # a product that overflows is that of a value without a fraction
    exact = [int(s) if abs(s) < float("inf") else int(scale) * int(v) for v, s in zip(values.ravel().tolist(), scaled.ravel().tolist())]
    return np.array(exact, dtype=object).reshape(values.shape)
