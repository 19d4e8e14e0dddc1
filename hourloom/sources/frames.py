"""Sensor frames that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourloom.functions import air, clock
from hourloom.operators import layout
from hourloom.session import utc

DENSE_COLUMNS = (
    "pm2_5",
    "pm10",
    "o3",
    "co",
    "no2",
    "so2",
    "temperature",
    "relative_humidity",
    "wind_speed",
    "wind_direction",
    "pressure",
)
SPARSE_COLUMNS = ("pm2_5", "pm10", "o3", "no2", "temperature")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sensor readings: UTC time, hour, value and the integer ``k`` of ``props``."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"),
        F.col("user_id").cast("string").alias("user"),
        "event_type",
        F.col("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def hourly(source: DataFrame, station: Column) -> DataFrame:
    """Readings aggregated to one row per (station, hour); combined map-side."""
    value, k = F.col("value"), F.col("k")
    return source.groupBy(station.alias("station_id"), F.col("hour").alias("ts")).agg(
        air.six_decimals(F.avg(value)).alias("pm2_5"),
        F.max(value).alias("pm10"),
        (F.min(value) * 2).alias("o3"),
        air.six_decimals(F.sum(value) * 60).alias("co"),
        air.six_decimals(F.avg(k) * 2).alias("no2"),
        F.max(k).cast("double").alias("so2"),
        air.six_decimals(F.avg(k) / 2).alias("temperature"),
        F.least(F.lit(100), F.count(F.lit(1)) * 5).cast("double").alias("relative_humidity"),
        F.min(value).alias("wind_speed"),
        F.pmod(F.sum(k) * 7, F.lit(360)).cast("double").alias("wind_direction"),
        air.six_decimals(F.lit(1000) + F.avg(value) / 10).alias("pressure"),
    )


def dense_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per event type, one row per hour with events, no NULLs."""
    return hourly(readings(spark, sf_dir), F.col("event_type"))


def user_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per user: many series whose number grows with the data."""
    return hourly(readings(spark, sf_dir), F.col("user"))


def sparse_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user a full hourly grid between its first and last hour; NULL where a quantity
    (one per event type) has no events."""

    def mean_of(kind):
        return air.six_decimals(F.avg(F.when(F.col("event_type") == kind, F.col("value"))))

    seen = (
        readings(spark, sf_dir)
        .groupBy(F.col("user").alias("station_id"), F.col("hour").alias("ts"))
        .agg(
            mean_of("view").alias("pm2_5"),
            mean_of("click").alias("pm10"),
            mean_of("purchase").alias("o3"),
            mean_of("signup").alias("no2"),
            mean_of("error").alias("temperature"),
        )
    )
    return on_hourly_grid(seen)


def on_hourly_grid(seen: DataFrame, cell_seconds: int = layout.CELL_SECONDS) -> DataFrame:
    """Every hour between the first and last one of each station; NULL where ``seen`` (station_id, ts, ...; one row an hour)
    has no row, and everywhere for a NULL station.

    Only the rows of ``seen`` are shuffled, by station and span of time: each is stretched to the hour before the next
    one of its span, and a mark at the start of every span is stretched to its first row.
    """
    values = [c for c in seen.columns if c not in ("station_id", "ts")]
    rows = seen.where(F.col("ts").isNotNull()).withColumn("_t", F.unix_timestamp("ts"))

    def cell(t: Column) -> Column:
        return F.floor(t / F.lit(cell_seconds))

    ends = rows.groupBy("station_id").agg(F.min("_t").alias("_a"), F.max("_t").alias("_b"))
    spans = ends.withColumn("_cell", F.explode(F.sequence(cell(F.col("_a")), cell(F.col("_b")))))
    marks = spans.select(
        "station_id",
        "_cell",
        F.greatest(F.col("_a"), F.col("_cell") * cell_seconds).alias("_t"),
        F.least(F.col("_b") + 3600, (F.col("_cell") + 1) * cell_seconds).alias("_end"),
        F.lit(False).alias("_seen"),
    )
    own = rows.select("station_id", cell(F.col("_t")).alias("_cell"), "_t", F.lit(True).alias("_seen"), *values)
    within = Window.partitionBy("station_id", "_cell")
    following = F.lead("_t").over(within.orderBy("_t", "_seen"))
    until = F.coalesce(following, F.max("_end").over(within))
    both = marks.unionByName(own, allowMissingColumns=True).withColumn("_hours", (until - F.col("_t")).cast("bigint") / 3600)
    spread = both.where("_hours > 0").withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_hours").cast("int") - 1)))
    kept = F.col("_seen") & (F.col("_i") == 0) & F.col("station_id").isNotNull()
    return spread.select(
        "station_id",
        F.timestamp_seconds(F.col("_t") + F.col("_i") * 3600).alias("ts"),
        *[F.when(kept, F.col(c)).alias(c) for c in values],
    )


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense frame with its index."""
    from hourloom.plans.index import compute_index

    return compute_index(dense_hourly(spark, sf_dir))


def pollution_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly pollution per user from views, clicks and purchases."""
    kinds = readings(spark, sf_dir).where(F.col("event_type").isin("view", "click", "purchase"))
    return kinds.groupBy(F.col("user").alias("station_id"), F.col("hour").alias("ts")).agg(
        air.six_decimals(F.avg("value")).alias("pm2_5"), F.max("value").alias("pm10")
    )


def weather_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather per user from purchases, signups and errors."""
    kinds = readings(spark, sf_dir).where(F.col("event_type").isin("purchase", "signup", "error"))
    return kinds.groupBy(F.col("user").alias("station_id"), F.col("hour").alias("ts")).agg(
        air.six_decimals(F.avg("k")).alias("temperature"), F.max("k").cast("double").alias("relative_humidity")
    )


def stored_and_corrections(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A stored batch of all readings and a later batch that corrects every error reading."""
    r = readings(spark, sf_dir)
    columns = [F.col("user").alias("station_id"), "ts", "event_id"]
    stored = r.select(*columns, "value", F.lit(1).alias("batch_seq"))
    fixes = r.where("event_type = 'error'").select(
        *columns, (F.col("value") + 1).alias("value"), F.col("k"), F.lit(2).alias("batch_seq")
    )
    return stored, fixes


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean order price per priority: a daily source to upsample."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(
        F.col("o_orderpriority").alias("station_id"), F.col("o_orderdate").cast("timestamp").alias("ts")
    ).agg(air.six_decimals(F.avg("o_totalprice")).alias("price"))


def naive_predictions(spark: SparkSession, sf_dir: str, index: DataFrame | None = None) -> DataFrame:
    """Persistence forecasts as named models: (model, horizon, split, y, p) on the dense frame."""
    from hourloom.models.baseline import persistence_predictions

    base = index if index is not None else indexed(spark, sf_dir)
    return persistence_predictions(base)
