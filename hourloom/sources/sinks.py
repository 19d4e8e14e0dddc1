"""Writing tables. Every write goes to a new path; nothing is replaced in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.operators import profiles
from hourloom.session import fresh_path


def write_table(df: DataFrame, path: str, kind: str = "parquet", partition_by=(), bucket_rows: int | None = None) -> str:
    """Write as parquet, ORC, JSON or headered CSV, optionally partitioned."""
    writer = df.write.mode("errorifexists")
    if kind == "csv":
        writer = writer.option("header", True)
    if bucket_rows:
        writer = writer.option("maxRecordsPerFile", bucket_rows)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(kind).save(path)
    return path


def write_sidecar(df: DataFrame, numeric: list[str], path: str, ts: str = "ts") -> str:
    return write_table(profiles.profile_sidecar(df, numeric, ts), path, "json")


def write_forecast(forecast: DataFrame, features: DataFrame, columns: list[str], path: str) -> tuple[str, str]:
    """Forecast rows with generation time and the hash of the feature row, as JSON and CSV."""
    stamped = forecast.join(profiles.snapshot_hash(features, columns), "station_id", "left").withColumn(
        "generated_at", F.current_timestamp()
    )
    return write_table(stamped, f"{path}/json", "json"), write_table(stamped, f"{path}/csv", "csv")


def write_leaderboard(metrics: DataFrame, path: str) -> tuple[str, str]:
    return write_table(metrics, f"{path}/json", "json"), write_table(metrics, f"{path}/csv", "csv")


def persist_model(model, features: list[str], path: str, spark: SparkSession) -> str:
    """A fitted pipeline with its ordered feature list beside it."""
    model.write().overwrite().save(f"{path}/model")
    rows = [(i, f) for i, f in enumerate(features)]
    write_table(spark.createDataFrame(rows, "position int, feature string"), f"{path}/features")
    return path


def load_model(path: str, spark: SparkSession):
    from pyspark.ml import PipelineModel

    listed = spark.read.parquet(f"{path}/features").orderBy("position")
    return PipelineModel.load(f"{path}/model"), [row.feature for row in listed.collect()]


def export_summary(df: DataFrame, columns: list[str], ts: str = "ts") -> DataFrame:
    """The report beside an export: rows, range, nulls, completeness, and column ranges."""
    n = F.count(F.lit(1))
    nulls = sum([F.count_if(F.col(c).isNull()) for c in columns], F.lit(0))
    complete = sum([100.0 * F.count(c) / n for c in columns], F.lit(0.0)) / len(columns)
    ranges = [
        e.alias(f"{c}_{name}")
        for c in columns
        for name, e in (("mean", F.avg(c)), ("min", F.min(c)), ("max", F.max(c)))
    ]
    return df.agg(
        n.alias("n_rows"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.lit(len(columns)).alias("n_columns"),
        nulls.alias("n_nulls"),
        complete.alias("completeness_pct"),
        *ranges,
    )


def export_and_report(df: DataFrame, path: str, columns: list[str], ts: str = "ts") -> DataFrame:
    """Write the rows as headered CSV and report on what was written."""
    df.write.option("header", True).csv(path)
    return export_summary(df.sparkSession.read.schema(df.schema).option("header", True).csv(path), columns, ts)


def roundtrip(df: DataFrame, kind: str = "parquet", label: str = "table") -> DataFrame:
    """Write to a fresh path below the shared folder and read it back with the same schema."""
    spark = df.sparkSession
    path = write_table(df, fresh_path(spark, label), kind)
    reader = spark.read.schema(df.schema)
    return (reader.option("header", True) if kind == "csv" else reader).format(kind).load(path)
