import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hourloom.session import fresh_path
from hourloom.streaming import jobs


@pytest.fixture(scope="module")
def landed(spark):
    """Four files that arrive one after the other; the later ones begin with a late repeat."""
    rnd = random.Random(11)
    t0 = datetime(2024, 1, 1)
    rows = [
        (i, t0 + timedelta(minutes=7 * i), 1, rnd.choice(["view", "click"]), round(rnd.random() * 100, 2), "{}")
        for i in range(400)
    ]
    folder = fresh_path(spark, "landed")
    for part in range(4):
        chunk = rows[max(0, part * 100 - 1) : part * 100 + 100]
        df = spark.createDataFrame(chunk, jobs.EVENTS.replace("TIMESTAMP_NTZ", "TIMESTAMP"))
        df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream(spark, folder):
    return jobs.reading_stream(spark, folder, files="*.parquet", per_trigger=1)


def batch(spark, folder):
    raw = spark.read.schema(jobs.EVENTS).parquet(folder)
    return raw.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("station_id"), "value")


def rows(df, digits=9):
    return sorted(tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def shuffled(spark, landed):
    """The same rows in files that each span the whole time, so most rows arrive out of order."""
    folder = fresh_path(spark, "shuffled")
    raw = spark.read.schema(jobs.EVENTS).parquet(landed).distinct()
    for part in range(4):
        raw.where(F.col("event_id") % 4 == (part * 3) % 4).coalesce(1).write.mode("append").parquet(folder)
    return folder


@pytest.mark.parametrize("per_trigger", [1, 1000])
def test_windows_do_not_depend_on_batches(spark, shuffled, per_trigger):
    hours = jobs.stream_hours(jobs.reading_stream(spark, shuffled, "*.parquet", per_trigger))
    want = jobs.partial_hours(batch(spark, shuffled))
    assert rows(jobs.hourly_tumbling(hours)) == rows(jobs.hourly_tumbling(want))
    assert rows(jobs.sliding_mean(hours, 8, 6)) == rows(jobs.sliding_mean(want, 8, 6))
    raw = batch(spark, shuffled)
    spans = raw.groupBy("station_id", F.window("ts", "8 hours", "1 hour").alias("w")).agg(F.count("value").alias("n"), F.avg("value").alias("m"))
    plain = spans.select("station_id", F.col("w.end").alias("ts"), "n", F.when(F.col("n") >= 6, F.col("m")).alias("mean"))
    for got, expected in zip(rows(jobs.sliding_mean(hours, 8, 6)), rows(plain), strict=True):
        assert got[:3] == expected[:3] and got[3] == pytest.approx(expected[3])


@pytest.mark.parametrize("per_trigger", [1, 1000])
def test_upsert_and_dedup_do_not_depend_on_batches(spark, shuffled, per_trigger):
    source = jobs.reading_stream(spark, shuffled, "*.parquet", per_trigger)
    merged = jobs.late_upsert(source).select("station_id", "ts", "event_id", "value")
    hourly = batch(spark, shuffled).withColumn("ts", F.date_trunc("hour", "ts"))
    want = hourly.groupBy("station_id", "ts").agg(F.max("event_id").alias("event_id"), F.max_by("value", "event_id").alias("value"))
    assert rows(merged) == rows(want)
    twice = source.withColumn("_c", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_c")
    assert rows(jobs.deduplicated(twice)) == rows(batch(spark, shuffled).select("event_id", "ts", "station_id", "value"))


def test_late_rows_replace_stored_hours(spark, landed):
    merged = jobs.late_upsert(stream(spark, landed))
    # one row per station and hour, from the newest batch that touched the hour
    hours = batch(spark, landed).select("station_id", F.date_trunc("hour", "ts").alias("ts")).distinct()
    assert merged.count() == hours.count()
    root = fresh_path(spark, "compact")
    source = fresh_path(spark, "source")
    add = jobs.upsert_batch(source)
    all_rows = batch(spark, landed)
    add(all_rows.withColumn("value", F.lit(0.0)), 0)
    add(all_rows.where("station_id = 'view'").withColumn("value", F.lit(1.0)), 1)
    add(all_rows.where("station_id = 'view'").withColumn("value", F.lit(1.0)), 1)
    jobs.compact(spark, source, root)
    got = jobs.read_upserted(spark, root).groupBy("station_id").agg(F.min("value"), F.max("value")).collect()
    assert sorted(map(tuple, got)) == [("click", 0.0, 0.0), ("view", 1.0, 1.0)]


def test_repeats_are_dropped(spark, landed):
    got = jobs.deduplicated(stream(spark, landed))
    assert got.count() == batch(spark, landed).select("event_id").distinct().count() < batch(spark, landed).count()


def test_current_values(spark, landed):
    table = jobs.run_to_table(jobs.current_values(stream(spark, landed)), jobs.CURRENT_SCHEMA)
    newest = jobs.newest(table.withColumn("k", F.lit(1)), ["station_id", "k"]).drop("k")
    assert rows(newest) == rows(jobs.current_values(batch(spark, landed)))


def test_silent_stations_expire(spark, landed):
    """Also when one part of a station goes on and another is silent; null values are values."""
    key = F.when(F.col("event_id") < 50, F.lit("gone")).otherwise(F.col("event_type"))
    source = jobs.reading_stream(spark, landed, "*.parquet", 1, key)
    source = source.withColumn("value", F.when(F.col("event_id") % 7 > 0, F.col("value")))
    table = jobs.run_to_table(jobs.current_values_with_ttl(source, ttl_hours=12, parts=3), jobs.TTL_SCHEMA)
    assert table.select("batch").distinct().count() > 2
    marks = {r[0] for r in table.where("expired").select("station_id").distinct().collect()}
    assert "gone" in marks
    live = jobs.live_values(table)
    every = batch(spark, landed).withColumn("station_id", F.when(F.col("event_id") < 50, F.lit("gone")).otherwise(F.col("station_id")))
    every = every.withColumn("value", F.when(F.col("event_id") % 7 > 0, F.col("value")))
    assert rows(live) == rows(jobs.current_values(every.where("station_id <> 'gone'")))


def test_refresh_runs_at_intervals(spark, landed):
    import time

    root, seen = fresh_path(spark, "every"), []

    def step(batch_rows, batch_id):
        seen.append((batch_id, batch_rows.count()))

    running = jobs.start_every(stream(spark, landed), "200 milliseconds", root, step)
    try:
        until = time.time() + 60
        while len(seen) < 4 and time.time() < until:
            time.sleep(0.2)
    finally:
        running.stop()
    assert [b for b, _ in seen[:4]] == [0, 1, 2, 3] and sum(n for _, n in seen[:4]) == batch(spark, landed).count()


def test_refresh_policy(spark):
    df = spark.createDataFrame([("a", 0), ("b", 700), ("c", 2000)], "station_id string, age int")
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    seen = df.withColumn("ts", F.timestamp_seconds(F.unix_timestamp(now) - F.col("age"))).drop("age")
    got = [(r.collect_, r.forecast) for r in jobs.refresh_due(seen, now).withColumnRenamed("collect", "collect_").collect()]
    assert got == [(False, False), (True, False), (True, True)]


def test_expiry_is_kept_for_groups_of_stations(spark, landed):
    """A group holds many stations, and a busy station or one without values gives one row a micro-batch."""
    key = F.when(F.col("event_id") % 2 == 0, F.lit("busy")).when(F.col("event_id") % 5 > 0, F.col("event_id").cast("string"))
    source = jobs.reading_stream(spark, landed, "*.parquet", 1, key)
    source = source.withColumn("value", F.when(F.col("event_id") % 7 > 0, F.col("value")))
    table = jobs.run_to_table(jobs.current_values_with_ttl(source, ttl_hours=6, parts=2), jobs.TTL_SCHEMA)
    assert table.groupBy("station_id", "batch").count().where("count > 1").isEmpty()
    assert table.select("part").distinct().count() == 2 and table.select("station_id").distinct().count() == 162
    last = batch(spark, landed).agg(F.max("ts")).first()[0]
    every = batch(spark, landed).withColumn("station_id", key).withColumn("value", F.when(F.col("event_id") % 7 > 0, F.col("value")))
    want = jobs.current_values(every).where(F.col("ts") > last - timedelta(hours=6))
    assert {tuple(r) for r in jobs.live_values(table).collect()} == {tuple(r) for r in want.collect()}
