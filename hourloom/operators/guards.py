"""Checks that a training table holds no look-ahead and is fit for use."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hourloom.functions import fixed
from hourloom.operators import layout, rolling
from hourloom.operators.layout import KEYS, TIME


class LeakageError(ValueError):
    """A feature name points at the target or the future."""


def suspicious_names(names, parts=fixed.FORBIDDEN_NAME_PARTS) -> list[str]:
    return [n for n in names if any(p in n.lower() for p in parts)]


def check_names(names) -> None:
    bad = suspicious_names(names)
    if bad:
        raise LeakageError(f"features carry target information: {bad}")


def drop_leakage(df: DataFrame) -> DataFrame:
    return df.drop(*fixed.LEAKAGE_COLUMNS)


def all_but(df: DataFrame, excluded) -> list[str]:
    return [c for c in df.columns if c not in set(excluded)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def feature_columns(df: DataFrame, keys=KEYS, ts: str = TIME) -> list[str]:
    """Numeric columns that are neither key, time nor target nor named like the index."""
    skip = {*keys, ts, *fixed.TARGETS, layout.POS, layout.LEN, "primary_pollutant", "target_timestamp"}
    names = [c for c in numeric_columns(df) if c not in skip]
    bad = set(suspicious_names(names))
    return [c for c in names if c not in bad]


def name_report(df: DataFrame, name: str) -> DataFrame:
    """The feature names in column ``name`` of a long table, their rows, and the verdict on each."""
    bad = reduce(lambda a, b: a | b, [F.contains(F.lower("name"), F.lit(p)) for p in fixed.FORBIDDEN_NAME_PARTS])
    return df.groupBy(F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("suspicious", bad)


def temporal_order(df: DataFrame, keys=KEYS, ts: str = TIME) -> DataFrame:
    """Smallest step, gaps over an hour, and the verdict, per series."""
    steps = layout.over_series(
        df, lambda w: {"_step": rolling.hours_since_previous(ts, w)}, back=1, keys=keys, ts=ts
    )
    out = steps.groupBy(*keys).agg(F.min("_step").alias("min_step"), F.count_if(F.col("_step") > 1).alias("n_gaps"))
    return out.withColumn("ordered", F.coalesce(F.col("min_step") >= 0, F.lit(True)))


def quality_gate(df: DataFrame, min_rows: int = 500, nulls_per_row: float = 10) -> DataFrame:
    """One row: rows, nulls over all columns, and whether the table passes."""
    per_row = sum([F.col(c).isNull().cast("int") for c in df.columns], F.lit(0))
    out = df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(per_row), F.lit(0)).alias("n_nulls")
    )
    passed = (F.col("n_rows") >= min_rows) & (F.col("n_nulls") <= F.col("n_rows") * nulls_per_row)
    return out.withColumn("passed", passed)


def align_to_schema(df: DataFrame, names: list[str]) -> DataFrame:
    """Exactly these columns in this order; absent ones are 0.0."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in names])
