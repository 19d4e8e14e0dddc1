"""Registration of the checked queries: a Spark callable and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions import air

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def published(df: DataFrame) -> DataFrame:
    """Comparable form: doubles at 6 decimals, times without zone."""
    columns = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind in ("double", "float"):
            c = air.six_decimals(c.cast("double"))
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    """Register a query under its operator name."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return published(fn(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
