"""Schema-aligned unions and keep-last upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions import clock
from hourloom.operators.layout import KEYS, TIME

BATCH = "batch_seq"


def union_schema(*frames: DataFrame) -> DataFrame:
    """Union of rows under the sorted union of the column names; absent columns are NULL."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out.select(*sorted(out.columns))


def keep_last(df: DataFrame, keys=KEYS, ts: str = TIME, order=(BATCH,)) -> DataFrame:
    """The last row per (series, time) under an explicit order.

    Filtering ``row_number() = 1`` lets Spark keep one row per key in every map task before
    the shuffle, so a key repeated many times costs one row per task.
    """
    newest = Window.partitionBy(*keys, ts).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_r", F.row_number().over(newest)).where("_r = 1").drop("_r")


def upsert_keep_last(
    existing: DataFrame, incoming: DataFrame, keys=KEYS, ts: str = TIME, order=(BATCH,)
) -> DataFrame:
    """Both sides floored to the hour and aligned; stored hours are replaced by newer ones."""
    both = union_schema(existing, incoming)
    floored = both.withColumn(ts, clock.floor_hour(F.col(ts)))
    return keep_last(floored, keys, ts, order)
