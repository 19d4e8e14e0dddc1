"""Queries of the incremental and streaming steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.catalog.base import query
from hourloom.catalog.sql import r, using
from hourloom.plans import master
from hourloom.session import fresh_path
from hourloom.sources import frames
from hourloom.streaming import jobs

KEY = ["station_id", "ts"]


@query(
    "high_watermark_window",
    using("users", 'SELECT max(ts) + INTERVAL 1 HOUR AS "start", max(ts) + INTERVAL 1 HOUR + INTERVAL 3 DAY AS "end" FROM users'),
)
def _(spark, sf):
    return master.next_window(frames.user_hourly(spark, sf).select(*KEY))


@query(
    "backfill_range",
    using("readings", f"SELECT event_id, ts, {r('value')} AS value FROM readings WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-25 23:59:59'"),
)
def _(spark, sf):
    """The ends are given in the wrong order and swapped."""
    rows = frames.readings(spark, sf).select("event_id", "ts", "value")
    return master.backfill_range(rows, "2024-01-25 23:59:59", "2024-01-10 00:00:00")


FILES = 5


def landing(spark, sf, key=None):
    """The events as a stream of files that land one by one, each with rows of all hours."""
    folder = fresh_path(spark, "landing")
    frames.table(spark, sf, "events").repartition(FILES, "event_id").write.parquet(folder)
    return jobs.reading_stream(spark, folder, "*.parquet", 1, key)


@query(
    "hourly_tumbling",
    f"SELECT event_type AS station_id, date_trunc('hour', ts) AS ts, count(*) AS n, {r('avg(value)')} AS mean, {r('max(value)')} AS peak FROM events GROUP BY 1, 2",
)
def _(spark, sf):
    return jobs.hourly_tumbling(jobs.stream_hours(landing(spark, sf)))


def _sliding_sql(hours, least):
    return f"""SELECT station_id, ts, n, CASE WHEN n >= {least} THEN {r('m')} END AS mean FROM (
    SELECT event_type AS station_id, date_trunc('hour', ts) + (i + 1) * INTERVAL 1 HOUR AS ts, count(*) AS n, avg(value) AS m
    FROM events, range({hours}) t(i) GROUP BY 1, 2)"""


@query("sliding_24h", _sliding_sql(24, 18))
def _(spark, sf):
    return jobs.sliding_mean(jobs.stream_hours(landing(spark, sf)), 24, 18)


@query("sliding_8h", _sliding_sql(8, 6))
def _(spark, sf):
    """The batch form of the same windows."""
    rows = frames.readings(spark, sf).select(F.col("event_type").alias("station_id"), "ts", "value")
    return jobs.sliding_mean(jobs.partial_hours(rows), 8, 6)


@query(
    "late_upsert",
    using(
        "readings",
        f"""SELECT event_type AS station_id, hour AS ts, arg_max(event_id, event_id) AS event_id,
        {r('arg_max(value, event_id)')} AS value FROM readings GROUP BY 1, 2""",
    ),
)
def _(spark, sf):
    return jobs.late_upsert(landing(spark, sf)).select(*KEY, "event_id", "value")


@query("stream_dedup", "SELECT event_type AS station_id, count(*) AS n FROM (SELECT DISTINCT * FROM events) GROUP BY 1")
def _(spark, sf):
    """Every reading arrives twice and is kept once."""
    twice = landing(spark, sf).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    return jobs.deduplicated(twice).groupBy("station_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "periodic_refresh",
    using(
        "users",
        """SELECT station_id, ts, (epoch(m) - epoch(ts))::BIGINT AS age_seconds, epoch(m) - epoch(ts) > 600 AS collect,
        epoch(m) - epoch(ts) > 1800 AS forecast FROM (SELECT station_id, max(ts) AS ts FROM users GROUP BY 1),
        (SELECT max(ts) AS m FROM users)""",
    ),
)
def _(spark, sf):
    seen = frames.user_hourly(spark, sf)
    now = seen.agg(F.max("ts").alias("m")).scalar()
    return jobs.refresh_due(seen.groupBy("station_id").agg(F.max("ts").alias("ts")), now)


CURRENT = f"SELECT event_type AS station_id, max(ts) AS ts, {r('arg_max(value, (ts, event_id))')} AS value FROM events GROUP BY 1"


@query("current_value_state", CURRENT)
def _(spark, sf):
    table = jobs.run_to_table(jobs.current_values(landing(spark, sf)), jobs.CURRENT_SCHEMA)
    return jobs.newest(table.withColumn("_one", F.lit(1)), ["station_id", "_one"]).drop("_one")


TTL_HOURS = 24


@query(
    "current_value_ttl",
    f"""SELECT CAST(user_id AS VARCHAR) AS station_id, max(ts) AS ts, {r('arg_max(value, (ts, event_id))')} AS value
    FROM events GROUP BY 1
    HAVING max(ts) + INTERVAL {TTL_HOURS} HOUR > (SELECT max(ts) FROM events)""",
)
def _(spark, sf):
    """Users as stations; those silent for a day at the end have expired."""
    landed = landing(spark, sf, key=F.col("user_id").cast("string"))
    return jobs.live_values(jobs.run_to_table(jobs.current_values_with_ttl(landed, TTL_HOURS), jobs.TTL_SCHEMA))
