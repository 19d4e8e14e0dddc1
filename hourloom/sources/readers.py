"""Reading tables: typed scans, path choice, nested payloads, name and time-column repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

from hourloom.functions import clock, fixed
from hourloom.functions.air import finite
from hourloom.session import utc

PAYLOAD = (
    "STRUCT<list: ARRAY<STRUCT<dt: BIGINT, main: STRUCT<aqi: INT>, components: STRUCT<co: DOUBLE, no: DOUBLE, "
    "no2: DOUBLE, o3: DOUBLE, so2: DOUBLE, pm2_5: DOUBLE, pm10: DOUBLE, nh3: DOUBLE>>>>"
)
FORECAST = "STRUCT<forecast_data: ARRAY<STRUCT<timestamp: STRING, aqi_forecast: DOUBLE, confidence: DOUBLE>>>"


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN sorts above every number in Spark; inside the engine missing means NULL."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: finite(F.col(c)) for c in doubles}) if doubles else df


def scan_series(
    spark: SparkSession, path: str, schema: StructType | str | None = None, kind: str = "parquet", ts: str | None = None
) -> DataFrame:
    """Parquet, ORC, JSON or headered CSV with an explicit schema; ``ts`` is parsed if it is text."""
    reader = utc(spark).read
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        reader = reader.option("header", True)
    df = reader.format(kind).load(path)
    if ts and dict(df.dtypes)[ts] != "timestamp":
        text = dict(df.dtypes)[ts] == "string"
        df = df.withColumn(ts, clock.parse_iso(F.col(ts)) if text else F.col(ts).cast("timestamp"))
    return nan_to_null(df)


def scan_first_available(spark: SparkSession, paths: list[str], kind: str = "parquet") -> DataFrame:
    """The first path that exists, chosen while the plan is built."""
    for path in paths:
        try:
            return utc(spark).read.format(kind).load(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    raise FileNotFoundError(f"none of {paths} exists")


def flatten_pollution(df: DataFrame, payload: str, keep=()) -> DataFrame:
    """Payload text ``{"list": [{dt, main, components}]}`` to one row per reading."""
    parsed = df.select(*keep, F.from_json(payload, PAYLOAD).alias("_p"))
    items = parsed.select(*keep, F.explode("_p.list").alias("_i"))
    return items.select(
        *keep,
        clock.epoch_to_ts(F.col("_i.dt")).alias("ts"),
        F.col("_i.main.aqi").alias("aqi_category"),
        "_i.components.*",
    )


def flatten_forecast(df: DataFrame, payload: str, keep=()) -> DataFrame:
    """Forecast payload text to rows; entries whose time cannot be parsed are skipped."""
    parsed = df.select(*keep, F.from_json(payload, FORECAST).alias("_p"))
    items = parsed.select(*keep, F.explode("_p.forecast_data").alias("_i"))
    out = items.select(*keep, clock.parse_iso(F.col("_i.timestamp")).alias("ts"), "_i.aqi_forecast", "_i.confidence")
    return out.where("ts IS NOT NULL")


def rename_source_columns(df: DataFrame, names: dict[str, str] = fixed.HOURLY_NAMES) -> DataFrame:
    return df.withColumnsRenamed(names)


def detect_time_column(df: DataFrame, name: str = "timestamp", known=fixed.TIME_COLUMN_NAMES) -> DataFrame:
    """Rename the first known time column to ``name``."""
    lower = {c.lower(): c for c in df.columns}
    for candidate in known:
        if candidate in lower:
            return df.withColumnRenamed(lower[candidate], name)
    raise ValueError(f"no time column among {df.columns}")


def synthesize_missing(df: DataFrame) -> DataFrame:
    """Columns the daily source lacks, estimated as fixed defaults."""
    have = set(df.columns)
    span = F.col("tmax") - F.col("tmin") if {"tmin", "tmax"} <= have else F.lit(0.0)
    out = df.withColumns(
        {
            "temperature_range": span,
            "dew_point": F.col("temperature") - 5,
            "relative_humidity": F.lit(60.0),
        }
    )
    return out if "coco" in have else out.withColumn("coco", F.lit(0))


def latest_artifact(registry: DataFrame, by: list[str], path: str, created: str, tie: str) -> DataFrame:
    """Newest path per family; the tie column decides between equal times."""
    return registry.groupBy(*by).agg(F.max_by(path, F.struct(created, tie)).alias(path))
