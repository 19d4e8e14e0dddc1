"""Structured Streaming forms of the incremental steps.

Sinks write one directory per micro-batch below the shared folder. A batch that is run again
after a failure replaces its own directory, and readers keep the last value per key, so a
restart neither loses nor doubles rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hourloom.operators import upsert
from hourloom.session import fresh_path, utc

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def reading_stream(
    spark: SparkSession,
    folder: str,
    files: str = "events*.parquet",
    per_trigger: int = 1000,
    station: Column | None = None,
) -> DataFrame:
    """Readings as they land as files. Watermarks need a zoned time, so NTZ is cast (UTC). No result depends on
    ``per_trigger``, which only sets the size of a micro-batch."""
    raw = (
        utc(spark)
        .readStream.schema(EVENTS)
        .option("pathGlobFilter", files)
        .option("maxFilesPerTrigger", per_trigger)
        .parquet(folder)
    )
    return raw.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_type") if station is None else station).alias("station_id"),
        "value",
    )


def run_to_table(stream: DataFrame, schema: str, mode: str = "update") -> DataFrame:
    """Run a stream over everything available into a batch-partitioned table, and read it."""
    spark = stream.sparkSession
    root = fresh_path(spark, "stream")
    table = f"{root}/table"

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/state").foreachBatch(store)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(f"{schema}, batch INT").option("basePath", table).parquet(f"{table}/batch=*")


def newest(table: DataFrame, keys: list[str]) -> DataFrame:
    """The last emitted row per key of an update-mode table."""
    return upsert.keep_last(table, keys[:-1], keys[-1], ("batch",)).drop("batch")


def partial_hours(readings: DataFrame) -> DataFrame:
    """What a set of readings adds to its hours: rows, values, their sum and maximum. Partial hours of
    several sets merge into those of all readings, in whatever order and grouping the sets come."""
    return readings.groupBy("station_id", F.date_trunc("hour", "ts").alias("ts")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("value").alias("n_values"),
        F.sum("value").alias("total"),
        F.max("value").alias("peak"),
    )


def stream_hours(stream: DataFrame) -> DataFrame:
    """Run a stream into a table of partial hours, one directory per micro-batch, and merge it.

    Nothing is too late for it: there is no watermark, and no state but the stored table.
    """
    spark = stream.sparkSession
    root = fresh_path(spark, "hours")

    def store(batch: DataFrame, batch_id: int) -> None:
        partial_hours(batch).write.mode("overwrite").parquet(f"{root}/table/batch={batch_id}")

    writer = stream.writeStream.option("checkpointLocation", f"{root}/state").foreachBatch(store)
    writer.trigger(availableNow=True).start().awaitTermination()
    return merge_hours(spark.read.option("basePath", f"{root}/table").parquet(f"{root}/table/batch=*"))


def merge_hours(partials: DataFrame) -> DataFrame:
    return partials.groupBy("station_id", "ts").agg(
        F.sum("n").alias("n"),
        F.sum("n_values").alias("n_values"),
        F.sum("total").alias("total"),
        F.max("peak").alias("peak"),
    )


def hourly_tumbling(hours: DataFrame) -> DataFrame:
    """Rows, mean and maximum per station and hour, of merged hours."""
    return hours.select("station_id", "ts", "n", (F.col("total") / F.col("n_values")).alias("mean"), "peak")


def sliding_mean(hours: DataFrame, span: int, least: int) -> DataFrame:
    """Mean over the last ``span`` hours at every full hour, NULL below ``least`` values, of merged hours:
    an hour, not each of its readings, is copied to the windows it lies in."""
    ends = F.transform(F.sequence(F.lit(1), F.lit(span)), lambda i: F.timestamp_add("HOUR", i, F.col("ts")))
    out = hours.withColumn("ts", F.explode(ends)).groupBy("station_id", "ts").agg(
        F.sum("n_values").alias("n"), (F.sum("total") / F.sum("n_values")).alias("m")
    )
    return out.select("station_id", "ts", "n", F.when(F.col("n") >= least, F.col("m")).alias("mean"))


def current_values(readings: DataFrame) -> DataFrame:
    """Latest known value per station; the state is one row per station."""
    order = F.struct("ts", "event_id")
    return readings.groupBy("station_id").agg(F.max("ts").alias("ts"), F.max_by("value", order).alias("value"))


CURRENT_SCHEMA = "station_id STRING, ts TIMESTAMP, value DOUBLE"


TTL_SCHEMA = "station_id STRING, part INT, ts TIMESTAMP, event_id BIGINT, value DOUBLE, expired BOOLEAN"


def _newest_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """The last row of every station; a NULL event number comes before all others."""
    rows = rows.sort_values(["ts", "event_id"], na_position="first")
    return rows.drop_duplicates("station_id", keep="last")


def current_values_with_ttl(readings: DataFrame, ttl_hours: int = 48, parts: int = 256) -> DataFrame:
    """The same with an expiry: state that is ``ttl_hours`` of event time behind the newest reading of all is
    reported as expired and dropped. The watermark lies as far back, so the rows it drops as late are those
    that have expired already, and the order in which files land does not matter.

    Stations are dealt over ``parts`` groups, each with the live rows of its stations as its state: the function is
    called once for a group of stations, not for each of them. Rows are cut down to the last one of each station
    before they are shuffled, so a station with much of the traffic is no large task. Rows without a time are left out.
    """

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield _newest_rows(rows)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        columns = ["station_id", "ts", "event_id", "value"]
        seen = [] if state.hasTimedOut else [rows[columns] for rows in batches]
        touched = {s for rows in seen for s in rows["station_id"].tolist()}
        if state.exists:
            stored = pd.DataFrame(dict(zip(columns, map(list, state.get))), columns=columns)
            seen.append(stored.astype({"ts": "datetime64[us]", "event_id": "Int64", "value": "Float64"}))
        kinds = {"station_id": "object", "ts": "datetime64[us]", "event_id": "Int64", "value": "Float64"}
        best = _newest_rows(pd.concat([rows.astype(kinds) for rows in seen], ignore_index=True))
        at = best["ts"].astype("int64") // 1000
        expired = at <= state.getCurrentWatermarkMs()
        live = best[~expired]
        if len(live):
            cells = live.astype("object").where(live.notna(), None)
            times = [t.to_pydatetime() for t in live["ts"]]
            state.update((cells["station_id"].tolist(), times, cells["event_id"].tolist(), cells["value"].tolist()))
            state.setTimeoutTimestamp(int(at[~expired].min()))
        elif state.exists:
            state.remove()
        told = best.assign(part=key[0], expired=expired)[expired | best["station_id"].isin(touched)]
        yield told[["station_id", "part", "ts", "event_id", "value", "expired"]]

    return (
        readings.where(F.col("ts").isNotNull())
        .mapInPandas(reduced, readings.schema)
        .withWatermark("ts", f"{ttl_hours} hours")
        .withColumn("part", F.pmod(F.xxhash64("station_id"), F.lit(parts)).cast("int"))
        .groupBy("part")
        .applyInPandasWithState(
            step,
            TTL_SCHEMA,
            "station_id ARRAY<STRING>, ts ARRAY<TIMESTAMP>, event_id ARRAY<BIGINT>, value ARRAY<DOUBLE>",
            "update",
            GroupStateTimeout.EventTimeTimeout,
        )
    )


def live_values(table: DataFrame) -> DataFrame:
    """The newest value of every live station: of each station the last row counts, be it a mark of expiry or a value."""
    last = table.groupBy("station_id", "part").agg(
        F.max_by(F.struct("ts", "event_id", "value", "expired"), F.struct("batch", "expired", "ts", "event_id")).alias("l")
    )
    live = last.select("station_id", "l.*").where("not expired")
    order = F.struct("ts", "event_id")
    return live.groupBy("station_id").agg(F.max("ts").alias("ts"), F.max_by("value", order).alias("value"))


def deduplicated(stream: DataFrame) -> DataFrame:
    """Run a stream into a table and read each event once: repeats are dropped in the batch they arrive in, and
    those of different batches when the table is read, however far apart they are."""
    spark = stream.sparkSession
    root = fresh_path(spark, "dedup")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.dropDuplicates(["event_id"]).write.mode("overwrite").parquet(f"{root}/table/batch={batch_id}")

    writer = stream.writeStream.option("checkpointLocation", f"{root}/state").foreachBatch(store)
    writer.trigger(availableNow=True).start().awaitTermination()
    stored = spark.read.option("basePath", f"{root}/table").parquet(f"{root}/table/batch=*")
    first = stored.groupBy("event_id").agg(F.min_by(F.struct("ts", "station_id", "value"), "batch").alias("f"))
    return first.select("event_id", "f.*")


def upsert_batch(root: str, keys=("station_id",), ts: str = "ts", order=("event_id",)) -> Callable:
    """A ``foreachBatch`` function: reduce a micro-batch to its last row per hour and add it.

    Only the batch is written, whatever the size of the stored table; the merge happens on
    read, and ``compact`` folds the batches into one when there are many.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        hourly = batch.withColumn(ts, F.date_trunc("hour", ts))
        last = upsert.keep_last(hourly, keys, ts, order)
        last.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return add


def read_upserted(
    spark: SparkSession, root: str, keys=("station_id",), ts: str = "ts", order=("event_id",)
) -> DataFrame:
    """Stored hours. The same order decides as within a batch, so the result does not depend on how rows were
    grouped into batches; only between rows equal in it the later batch wins."""
    table = spark.read.option("basePath", root).parquet(f"{root}/batch=*")
    return upsert.keep_last(table, keys, ts, (*order, "batch"))


def compact(
    spark: SparkSession, root: str, target: str, keys=("station_id",), ts: str = "ts", order=("event_id",)
) -> str:
    """Fold all batches of ``root`` into batch 0 of a new table; a stream goes on there when it is restarted
    with ``upsert_batch(target)``, whose batches must be numbered from 1."""
    read_upserted(spark, root, keys, ts, order).drop("batch").write.parquet(f"{target}/batch=0")
    return target


def late_upsert(stream: DataFrame, keys=("station_id",), ts: str = "ts", order=("event_id",)) -> DataFrame:
    """Run a stream of possibly late and corrected rows into an hourly table, and read it."""
    spark = stream.sparkSession
    root = fresh_path(spark, "upsert")
    writer = stream.writeStream.option("checkpointLocation", f"{root}/state").trigger(availableNow=True)
    writer.foreachBatch(upsert_batch(f"{root}/table", keys, ts, order)).start().awaitTermination()
    return read_upserted(spark, f"{root}/table", keys, ts, order)


def refresh_due(last_seen: DataFrame, now: Column, collect_after: int = 600, forecast_after: int = 1800) -> DataFrame:
    """Per station: is the data old enough to collect again, and to forecast again?"""
    age = F.unix_timestamp(now) - F.unix_timestamp("ts")
    return last_seen.withColumns(
        {"age_seconds": age, "collect": age > collect_after, "forecast": age > forecast_after}
    )


def start_every(stream: DataFrame, interval: str, root: str, step: Callable) -> StreamingQuery:
    """Refresh on a fixed processing-time interval."""
    return (
        stream.writeStream.option("checkpointLocation", f"{root}/state")
        .foreachBatch(step)
        .trigger(processingTime=interval)
        .start()
    )
