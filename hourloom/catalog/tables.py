"""Queries of sources, sinks, filters, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.catalog.base import query
from hourloom.catalog.sql import r, rounded, using
from hourloom.functions import air, fixed
from hourloom.operators import guards, joins, metrics, profiles, stats, upsert
from hourloom.session import fresh_path
from hourloom.sources import frames, readers, sinks
from hourloom.sources.versions import VersionedTable

KEY = ["station_id", "ts"]
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

# --- sources --------------------------------------------------------------------------


@query("scan_series", f"SELECT event_id, ts, user_id, event_type, {r('value')} AS value, props FROM events")
def _(spark, sf):
    return readers.scan_series(spark, f"{sf}/events.parquet", EVENTS, ts="ts")


@query("scan_pruned", "SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM events")
def _(spark, sf):
    return readers.scan_series(spark, f"{sf}/events.parquet", EVENTS).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query("scan_first_available", f"SELECT o_orderkey, {r('o_totalprice')} AS price FROM orders")
def _(spark, sf):
    df = readers.scan_first_available(spark, [f"{sf}/no_such_table.parquet", f"{sf}/orders.parquet"])
    return df.select("o_orderkey", F.col("o_totalprice").alias("price"))


@query(
    "scan_nested_json",
    using(
        "readings",
        f"""SELECT event_id, date_trunc('second', ts) AS ts, k AS aqi_category, {r('value')} AS co,
        {r('value * 2')} AS pm2_5, NULL::DOUBLE AS nh3 FROM readings""",
    ),
)
def _(spark, sf):
    """Each reading as the JSON payload of a pollution service, parsed back to rows."""
    item = F.struct(
        F.unix_timestamp("ts").alias("dt"),
        F.struct(F.col("k").alias("aqi")).alias("main"),
        F.struct(F.col("value").alias("co"), (F.col("value") * 2).alias("pm2_5")).alias("components"),
    )
    payloads = frames.readings(spark, sf).select(
        "event_id", F.to_json(F.struct(F.array(item).alias("list"))).alias("payload")
    )
    flat = readers.flatten_pollution(payloads, "payload", keep=["event_id"])
    return flat.select("event_id", "ts", "aqi_category", "co", "pm2_5", "nh3")


@query(
    "scan_forecast_json",
    using(
        "readings",
        f"""SELECT event_id, date_trunc('second', ts) AS ts, {r('value')} AS aqi_forecast,
        {r('k / 100.0::DOUBLE')} AS confidence FROM readings""",
    ),
)
def _(spark, sf):
    """Forecast payloads of two entries, one of them with a time nobody can parse."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")

    def entry(text):
        return F.struct(
            text.alias("timestamp"), F.col("value").alias("aqi_forecast"), (F.col("k") / 100.0).alias("confidence")
        )

    listed = F.array(entry(F.concat(stamp, F.lit("Z"))), entry(F.lit("soon")))
    payloads = frames.readings(spark, sf).select(
        "event_id", F.to_json(F.struct(listed.alias("forecast_data"))).alias("payload")
    )
    return readers.flatten_forecast(payloads, "payload", keep=["event_id"])


@query(
    "rename_source_columns",
    using("dense", f"SELECT station_id, ts AS timestamp, {rounded(['temperature', 'relative_humidity', 'wind_direction', 'wind_speed', 'pressure'])} FROM dense"),
)
def _(spark, sf):
    source = frames.dense_hourly(spark, sf).select(
        "station_id",
        F.col("ts").alias("time"),
        F.col("temperature").alias("temp"),
        F.col("relative_humidity").alias("rhum"),
        F.col("wind_direction").alias("wdir"),
        F.col("wind_speed").alias("wspd"),
        F.col("pressure").alias("pres"),
    )
    return readers.rename_source_columns(source)


@query("detect_time_column", f"SELECT o_orderkey, o_orderdate AS timestamp, {r('o_totalprice')} AS price FROM orders")
def _(spark, sf):
    source = frames.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("Date"), F.col("o_totalprice").alias("price")
    )
    return readers.detect_time_column(source)


IMPORTANCE = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, pm2_5)) AS importance FROM dense"
    for c in frames.DENSE_COLUMNS
    if c != "pm2_5"
)


def importance_table(spark, sf):
    """A feature ranking computed from the data: absolute correlation with pm2_5."""
    columns = [c for c in frames.DENSE_COLUMNS if c != "pm2_5"]
    corr = stats.corr_with_target(frames.dense_hourly(spark, sf), columns, "pm2_5")
    return corr.select(F.col("column").alias("feature"), F.abs("corr").alias("importance"))


@query("read_importance", using("dense", f"SELECT feature, {r('importance')} AS importance FROM ranked", ranked=IMPORTANCE))
def _(spark, sf):
    return sinks.roundtrip(importance_table(spark, sf), "csv", "importance")


def candidate_metrics(spark, sf):
    return metrics.regression_metrics(frames.naive_predictions(spark, sf))


@query("read_registry", using("scored", f"SELECT model, horizon, split, n, {rounded(['rmse', 'mae', 'r2', 'mape'])} FROM scored"))
def _(spark, sf):
    return sinks.roundtrip(candidate_metrics(spark, sf), "json", "registry")


@query(
    "latest_artifact",
    """SELECT o_orderpriority AS family, arg_max('model-' || o_orderkey, (o_orderdate, o_orderkey)) AS path
    FROM orders GROUP BY 1""",
)
def _(spark, sf):
    registry = frames.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("family"),
        F.concat(F.lit("model-"), F.col("o_orderkey").cast("string")).alias("path"),
        F.col("o_orderdate").alias("created_at"),
        "o_orderkey",
    )
    return readers.latest_artifact(registry, ["family"], "path", "created_at", "o_orderkey")


@query(
    "synthesize_missing_columns",
    using(
        "dense",
        f"""SELECT station_id, {r('temperature')} AS temperature, {r('pm10')} AS tmax, {r('o3')} AS tmin,
        {r('pm10 - o3')} AS temperature_range, {r('temperature - 5')} AS dew_point,
        60.0::DOUBLE AS relative_humidity, 0 AS coco FROM dense""",
    ),
)
def _(spark, sf):
    daily = frames.dense_hourly(spark, sf).select(
        "station_id", "temperature", F.col("pm10").alias("tmax"), F.col("o3").alias("tmin")
    )
    return readers.synthesize_missing(daily)


# --- sinks ----------------------------------------------------------------------------


@query("write_table", using("dense", f"SELECT station_id, ts, {rounded(frames.DENSE_COLUMNS)} FROM dense"))
def _(spark, sf):
    return sinks.roundtrip(frames.dense_hourly(spark, sf), "parquet", "dense")


def corrected_table(spark, sf):
    """Two versions: all readings, then those with every error reading corrected."""
    stored, fixes = frames.stored_and_corrections(spark, sf)
    table = VersionedTable(spark, fresh_path(spark, "master"), order=("batch_seq", "event_id"), period="week")
    table.upsert(stored)
    table.upsert(fixes)
    return table


@query(
    "upsert_keep_last",
    using(
        "both_batches",
        f"""SELECT station_id, hour AS ts, batch_seq, event_id, k, {r('value')} AS value FROM (
        SELECT *, date_trunc('hour', ts) AS hour, row_number() OVER (PARTITION BY station_id, date_trunc('hour', ts)
        ORDER BY batch_seq DESC, event_id DESC) AS n FROM both_batches) WHERE n = 1""",
    ),
)
def _(spark, sf):
    table = corrected_table(spark, sf)
    return table.read()


@query(
    "upsert_keep_last_raw",
    using(
        "both_batches",
        f"""SELECT station_id, ts, batch_seq, event_id, k, {r('value')} AS value FROM (SELECT *, row_number() OVER (
        PARTITION BY station_id, ts ORDER BY batch_seq DESC) AS n FROM both_batches) WHERE n = 1""",
    ),
)
def _(spark, sf):
    """Per source at its own resolution: each corrected reading replaces the stored one."""
    stored, fixes = frames.stored_and_corrections(spark, sf)
    return upsert.keep_last(upsert.union_schema(stored, fixes))


@query(
    "snapshot_before_write",
    using(
        "both_batches",
        f"""SELECT 1 AS snapshot, count(*) AS n_rows, {r('sum(value)')} AS total FROM first_version UNION ALL
        SELECT 2, count(*), {r('sum(value)')} FROM second_version""",
        first_version="""SELECT arg_max(value, (batch_seq, event_id)) AS value FROM both_batches
        WHERE batch_seq = 1 GROUP BY station_id, date_trunc('hour', ts)""",
        second_version="""SELECT arg_max(value, (batch_seq, event_id)) AS value FROM both_batches
        GROUP BY station_id, date_trunc('hour', ts)""",
    ),
)
def _(spark, sf):
    """Two versions of the master table side by side; the first is still whole after the second."""
    table = corrected_table(spark, sf)

    def version(n):
        return table.read(n).agg(F.lit(n).alias("snapshot"), F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total"))

    return version(1).unionByName(version(2))


RECENT = "ts >= (SELECT max(date_trunc('day', ts)) FROM both_batches) - INTERVAL 2 DAY"


@query(
    "upsert_touched_periods",
    using(
        "both_batches",
        """SELECT strftime(date_trunc('day', hour), '%Y-%m-%d') AS period, CASE WHEN bool_or(recent) THEN 2 ELSE 1 END::BIGINT AS written_in,
        count(*) AS n_rows, min(hour) AS first_ts, max(hour) AS last_ts FROM kept GROUP BY date_trunc('day', hour)""",
        kept=f"""SELECT station_id, date_trunc('hour', ts) AS hour, bool_or(batch_seq = 2 AND {RECENT}) AS recent
        FROM both_batches GROUP BY 1, 2""",
    ),
)
def _(spark, sf):
    """The manifest after corrections of the newest three days: only folders of their days were written anew."""
    stored, fixes = frames.stored_and_corrections(spark, sf)
    newest = stored.agg(F.max(F.date_trunc("day", "ts")) - F.expr("INTERVAL 2 DAYS")).scalar()
    table = VersionedTable(spark, fresh_path(spark, "master"), order=("batch_seq", "event_id"), period="day")
    table.upsert(stored)
    table.upsert(fixes.where(F.col("ts") >= newest))
    entries = table.manifests().where("version = 2")
    return entries.select("period", "written_in", "n_rows", "first_ts", "last_ts")


@query(
    "restored_version",
    using(
        "both_batches",
        f"""SELECT station_id, date_trunc('hour', ts) AS ts, {r('arg_max(value, event_id)')} AS value, max(event_id) AS event_id
        FROM both_batches WHERE batch_seq = 1 GROUP BY 1, 2""",
    ),
)
def _(spark, sf):
    """The first version again, after a second one and the removal of all older ones."""
    table = corrected_table(spark, sf)
    table.restore(1)
    table.expire(1)
    return table.read().select(*KEY, "value", "event_id")


@query(
    "profile_sidecar",
    using(
        "sparse",
        f"""SELECT count(*) AS records, min(ts) AS first_ts, max(ts) AS last_ts, 7 AS n_columns,
        count(*) FILTER (pm2_5 IS NULL) AS pm2_5_nulls, {r('min(pm2_5)')} AS pm2_5_min, {r('max(pm2_5)')} AS pm2_5_max,
        count(*) FILTER (no2 IS NULL) AS no2_nulls, {r('min(no2)')} AS no2_min, {r('max(no2)')} AS no2_max
        FROM sparse""",
    ),
)
def _(spark, sf):
    side = profiles.profile_sidecar(frames.sparse_hourly(spark, sf), ["pm2_5", "no2"])
    parts = [
        F.col("profile")[i][name].alias(f"{c}_{name}")
        for i, c in enumerate(("pm2_5", "no2"))
        for name in ("nulls", "min", "max")
    ]
    return side.select("records", "first_ts", "last_ts", "n_columns", *parts)


@query("write_leaderboard", using("scored", f"SELECT model, horizon, split, n, {rounded(['rmse', 'mae', 'r2', 'mape'])} FROM scored"))
def _(spark, sf):
    scores = candidate_metrics(spark, sf)
    as_json, _ = sinks.write_leaderboard(scores, fresh_path(spark, "leaderboard"))
    return spark.read.schema(scores.schema).json(as_json)


@query(
    "export_and_report",
    using(
        "sparse",
        f"""SELECT count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts, 2 AS n_columns,
        count(*) FILTER (pm2_5 IS NULL) + count(*) FILTER (pm10 IS NULL) AS n_nulls,
        {r('(100.0::DOUBLE * count(pm2_5) / count(*) + 100.0::DOUBLE * count(pm10) / count(*)) / 2')} AS completeness_pct,
        {r('avg(pm2_5)')} AS pm2_5_mean, {r('min(pm2_5)')} AS pm2_5_min, {r('max(pm2_5)')} AS pm2_5_max,
        {r('avg(pm10)')} AS pm10_mean, {r('min(pm10)')} AS pm10_min, {r('max(pm10)')} AS pm10_max FROM sparse""",
    ),
)
def _(spark, sf):
    """Exported as CSV, and summed up from what was exported."""
    rows = frames.sparse_hourly(spark, sf).select(*KEY, "pm2_5", "pm10")
    return sinks.export_and_report(rows, fresh_path(spark, "export"), ["pm2_5", "pm10"])


# --- filters and validation -----------------------------------------------------------


@query(
    "time_range_filter",
    using("readings", "SELECT event_id, ts FROM readings WHERE ts BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-22'"),
)
def _(spark, sf):
    between = F.col("ts").between(F.lit("2024-01-08").cast("timestamp"), F.lit("2024-01-22").cast("timestamp"))
    return frames.readings(spark, sf).where(between).select("event_id", "ts")


@query("drop_null_rows", using("sparse", f"SELECT station_id, ts, {rounded(['pm2_5', 'pm10'])} FROM sparse WHERE pm2_5 IS NOT NULL AND pm10 IS NOT NULL"))
def _(spark, sf):
    return frames.sparse_hourly(spark, sf).select(*KEY, "pm2_5", "pm10").na.drop(subset=["pm2_5", "pm10"])


@query(
    "inf_to_null_to_zero",
    using("readings", f"SELECT event_id, CASE WHEN k % 10 = 0 THEN 0.0::DOUBLE ELSE {r('value / (k % 10)')} END AS cleaned FROM readings"),
)
def _(spark, sf):
    """Ratios whose denominator may be zero: infinities are replaced by 0."""
    digit = F.col("k") % 10
    raw = F.when(digit == 0, F.lit(float("inf"))).otherwise(F.try_divide(F.col("value"), digit))
    return frames.readings(spark, sf).select(
        "event_id", F.coalesce(air.finite(raw), F.lit(0.0)).alias("cleaned")
    )


@query(
    "valid_ratio",
    using("dense", f"SELECT station_id, ts, {r('pm2_5 / pm10')} AS pm_ratio FROM dense WHERE pm2_5 > 0 AND pm10 > 0"),
)
def _(spark, sf):
    return profiles.pm_ratio(frames.dense_hourly(spark, sf)).select(*KEY, "pm_ratio")


@query(
    "fixed_clip",
    using(
        "readings",
        f"SELECT event_id, {r('greatest(-10, least(50, value - 20))')} AS temperature, "
        f"{r('greatest(0, least(500, value * 3 - 30))')} AS numerical_aqi FROM readings",
    ),
)
def _(spark, sf):
    rows = frames.readings(spark, sf).select(
        "event_id", (F.col("value") - 20).alias("temperature"), (F.col("value") * 3 - 30).alias("numerical_aqi")
    )
    return stats.fixed_clip(rows, {"temperature": (-10, 50), "numerical_aqi": (0, 500)})


@query(
    "out_of_range_counts",
    using(
        "readings",
        """SELECT 'temperature' AS "column", count(*) FILTER (value - 20 < -10) AS n_below, count(*) FILTER (value - 20 > 50) AS n_above FROM readings
        UNION ALL SELECT 'numerical_aqi', count(*) FILTER (value * 3 - 30 < 0), count(*) FILTER (value * 3 - 30 > 500) FROM readings""",
    ),
)
def _(spark, sf):
    rows = frames.readings(spark, sf).select(
        (F.col("value") - 20).alias("temperature"), (F.col("value") * 3 - 30).alias("numerical_aqi")
    )
    return stats.out_of_range(rows, {"temperature": (-10, 50), "numerical_aqi": (0, 500)})


CLIPPED = ("l_quantity", "l_extendedprice", "l_discount")
FENCES = ", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in CLIPPED)


@query(
    "iqr_clip",
    f"WITH q AS (SELECT {FENCES} FROM lineitem) SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        r(f"greatest(a_{c} - 1.5 * (b_{c} - a_{c}), least(b_{c} + 1.5 * (b_{c} - a_{c}), {c}))") + f" AS {c}"
        for c in CLIPPED
    )
    + " FROM lineitem, q",
)
def _(spark, sf):
    rows = frames.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *CLIPPED)
    return stats.iqr_clip(rows, list(CLIPPED))


@query(
    "iqr_outlier_counts",
    using(
        "dense",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) FILTER ({c} < a_{c} - 1.5 * (b_{c} - a_{c})
            OR {c} > b_{c} + 1.5 * (b_{c} - a_{c})) AS n_outliers FROM dense, q"""
            for c in ("pm2_5", "pm10", "o3", "co")
        ),
        q="SELECT "
        + ", ".join(
            f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in ("pm2_5", "pm10", "o3", "co")
        )
        + " FROM dense",
    ),
)
def _(spark, sf):
    return stats.outlier_counts(frames.dense_hourly(spark, sf), ["pm2_5", "pm10", "o3", "co"])


@query(
    "change_sign_split",
    using(
        "dense",
        f"""SELECT station_id, ts, {r('change')} AS change, CASE WHEN change < 0 THEN 'improving' ELSE 'worsening' END AS move
        FROM (SELECT station_id, ts, pm10 - lag(pm10) OVER (PARTITION BY station_id ORDER BY ts) AS change FROM dense)
        WHERE change <> 0""",
    ),
)
def _(spark, sf):
    from hourloom.operators import layout, rolling

    moved = layout.over_series(frames.dense_hourly(spark, sf), lambda w: {"change": rolling.change("pm10", 1, w)}, back=1)
    return profiles.change_split(moved, "change").select(*KEY, "change", "move")


@query(
    "name_guard",
    using(
        "readings",
        """SELECT name, count(*) AS n, contains(lower(name), 'target') OR contains(lower(name), 'aqi')
        OR contains(lower(name), 'future') OR contains(lower(name), 'ahead') OR contains(lower(name), 'next')
        OR contains(lower(name), 'forward') AS suspicious FROM (SELECT event_type || CASE k % 5 WHEN 0 THEN '_mean'
        WHEN 1 THEN '_Next_day' WHEN 2 THEN '_lag_24h' WHEN 3 THEN '_AQI_24h' ELSE '_trend' END AS name
        FROM readings WHERE k IS NOT NULL) GROUP BY name""",
    ),
)
def _(spark, sf):
    """Readings as a long feature table whose names come from the data, some of them forbidden."""
    endings = F.element_at(F.array(*map(F.lit, ("_mean", "_Next_day", "_lag_24h", "_AQI_24h", "_trend"))), F.col("k") % 5 + 1)
    long = frames.readings(spark, sf).where("k IS NOT NULL").select(F.concat("event_type", endings).alias("feature"))
    return guards.name_report(long, "feature")


@query(
    "temporal_order_check",
    using(
        "users",
        f"""SELECT station_id, {r('min(step)')} AS min_step, count(*) FILTER (step > 1) AS n_gaps,
        coalesce(min(step) >= 0, true) AS ordered FROM (SELECT station_id,
        (epoch(ts) - epoch(lag(ts) OVER (PARTITION BY station_id ORDER BY ts))) / 3600.0::DOUBLE AS step FROM users)
        GROUP BY station_id""",
    ),
)
def _(spark, sf):
    return guards.temporal_order(frames.user_hourly(spark, sf))


@query(
    "data_quality_gate",
    using(
        "sparse",
        """SELECT n_rows, n_nulls, n_rows >= 500 AND n_nulls <= n_rows * 10 AS passed FROM (SELECT count(*) AS n_rows,
        (count(*) * 5 - count(pm2_5) - count(pm10) - count(o3) - count(no2) - count(temperature))::BIGINT AS n_nulls
        FROM sparse)""",
    ),
)
def _(spark, sf):
    return guards.quality_gate(frames.sparse_hourly(spark, sf))


@query(
    "leak_heuristic",
    using(
        "scored",
        """SELECT model, horizon, split, CASE WHEN r2 > 0.95 THEN 'suspicious' WHEN r2 > 0.8 THEN 'realistic'
        WHEN r2 IS NOT NULL THEN 'moderate' END AS verdict FROM scored""",
    ),
)
def _(spark, sf):
    return candidate_metrics(spark, sf).select(
        "model", "horizon", "split", metrics.leak_verdict(F.col("r2")).alias("verdict")
    )


@query("min_group_size", using("users", "SELECT station_id, count(*) AS n FROM users GROUP BY 1 HAVING count(*) >= 60"))
def _(spark, sf):
    return frames.user_hourly(spark, sf).groupBy("station_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 60")


# --- joins ----------------------------------------------------------------------------


@query(
    "hour_aligned_join",
    using(
        ["pollution", "weather"],
        f"SELECT station_id, ts, {rounded(['pm2_5', 'pm10', 'temperature', 'relative_humidity'])} "
        "FROM pollution JOIN weather USING (station_id, ts)",
    ),
)
def _(spark, sf):
    return joins.hour_aligned(frames.pollution_source(spark, sf), frames.weather_source(spark, sf))


@query(
    "nearest_time_lookup",
    using(
        "readings",
        f"""SELECT p.event_id, {r('m.value')} AS value, {r('m.gap / 1e6')} AS gap_seconds FROM probes p LEFT JOIN (
        SELECT event_id, value, gap FROM (SELECT p.event_id, q.value, abs(epoch_us(p.ts) - epoch_us(q.ts)) AS gap,
        row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(p.ts) - epoch_us(q.ts)), q.ts) AS n
        FROM probes p JOIN given q ON p.usr = q.usr AND q.ts > p.ts - INTERVAL 1 HOUR AND q.ts < p.ts + INTERVAL 1 HOUR)
        WHERE n = 1) m ON p.event_id = m.event_id""",
        probes="SELECT * FROM readings WHERE event_type = 'error'",
        given="SELECT * FROM readings WHERE event_type <> 'error'",
    ),
)
def _(spark, sf):
    """For every error, the user's reading of another kind nearest in time, within the hour."""
    rows = frames.readings(spark, sf).select("event_id", F.col("user").alias("station_id"), "ts", "value", "event_type")
    probes = rows.where("event_type = 'error'").select("event_id", *KEY)
    given = rows.where("event_type <> 'error'").select(*KEY, "value")
    return joins.nearest_in_time(probes, given, ["value"]).select("event_id", "value", "gap_seconds")


@query(
    "stats_broadcast",
    using(
        "dense",
        f"SELECT d.station_id, d.ts, {r('d.pm2_5 - m.a')} AS from_mean, {r('d.pm2_5 - s.a')} AS from_station_mean "
        "FROM dense d, m JOIN s ON d.station_id = s.station_id",
        m="SELECT avg(pm2_5) AS a FROM dense",
        s="SELECT station_id, avg(pm2_5) AS a FROM dense GROUP BY 1",
    ).replace("FROM dense d, m JOIN", "FROM dense d CROSS JOIN m JOIN"),
)
def _(spark, sf):
    df = frames.dense_hourly(spark, sf)
    both = stats.with_stats(df, df.agg(F.avg("pm2_5").alias("a"))).withColumn("from_mean", F.col("pm2_5") - F.col("_s.a"))
    per = df.groupBy("station_id").agg(F.avg("pm2_5").alias("a"))
    both = stats.with_stats(both.drop("_s"), per, ["station_id"])
    return both.select(*KEY, "from_mean", (F.col("pm2_5") - F.col("_s.a")).alias("from_station_mean"))


@query(
    "select_by_importance",
    using(
        "dense",
        "SELECT feature, count(*) AS n FROM long WHERE feature IN (SELECT feature FROM ranked ORDER BY importance DESC, feature LIMIT 5) "
        "OR (SELECT count(*) FROM (SELECT feature FROM ranked ORDER BY importance DESC, feature LIMIT 5)) < 5 GROUP BY 1",
        ranked=IMPORTANCE,
        long="UNPIVOT (SELECT station_id, ts, "
        + ", ".join(frames.DENSE_COLUMNS)
        + " FROM dense) ON "
        + ", ".join(frames.DENSE_COLUMNS)
        + " INTO NAME feature VALUE v",
    ),
)
def _(spark, sf):
    long = (
        frames.dense_hourly(spark, sf)
        .select(*KEY, *frames.DENSE_COLUMNS)
        .unpivot(KEY, list(frames.DENSE_COLUMNS), "feature", "value")
    )
    ranked = importance_table(spark, sf).orderBy(F.desc("importance"), "feature").limit(5)
    chosen = joins.select_by_importance(long, ranked, least=5)
    return chosen.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


COMPARE = """compared AS (SELECT c.model, c.rmse, b.rmse AS baseline_rmse, b.rmse - c.rmse AS improvement,
  (b.rmse - c.rmse) * 100 / b.rmse AS improvement_pct, CASE WHEN b.rmse IS NULL THEN 'new' WHEN b.rmse > c.rmse THEN 'better'
  WHEN b.rmse < c.rmse THEN 'worse' ELSE 'same' END AS status FROM
  (SELECT model || '_' || horizon AS model, rmse FROM scored WHERE split = 'test') c LEFT JOIN
  (SELECT model || '_' || horizon AS model, rmse FROM scored WHERE split = 'validation' AND horizon < 72) b ON c.model = b.model)"""


def compared(spark, sf):
    """Test errors against validation errors of the same forecasts; 72 h has no earlier result."""
    scores = candidate_metrics(spark, sf).withColumn("name", F.concat_ws("_", "model", "horizon"))
    now = scores.where("split = 'test'").select(F.col("name").alias("model"), "rmse")
    then = scores.where("split = 'validation' AND horizon < 72").select(F.col("name").alias("model"), "rmse")
    return joins.baseline_compare(now, then)


@query(
    "baseline_compare",
    using("scored", f"SELECT model, status, {rounded(['rmse', 'baseline_rmse', 'improvement', 'improvement_pct'])} FROM compared").replace(
        " SELECT model, status", f", {COMPARE} SELECT model, status"
    ),
)
def _(spark, sf):
    return compared(spark, sf)


@query(
    "promotion_join",
    using(
        "scored",
        f"""SELECT horizon, {r('cand')} AS cand_rmse, {r('champ')} AS champ_rmse, {r('gain')} AS rel_gain, gain >= 0.02 AS promoted,
        {r('CASE WHEN gain >= 0.02 THEN cand ELSE champ END')} AS rmse,
        {r('CASE WHEN gain >= 0.02 THEN cand_r2 ELSE champ_r2 END')} AS r2, 'carry-' || horizon AS cand_path,
        CASE WHEN gain >= 0.02 THEN 'carry-' ELSE 'carry_two_days-' END || horizon AS path FROM (
        SELECT a.horizon, b.rmse AS cand, b.r2 AS cand_r2, a.rmse AS champ, a.r2 AS champ_r2,
        (a.rmse - b.rmse) / greatest(1e-9, a.rmse) AS gain FROM
        (SELECT * FROM scored WHERE split = 'test' AND model = 'carry_two_days') a JOIN
        (SELECT * FROM scored WHERE split = 'test' AND model = 'carry') b ON a.horizon = b.horizon)""",
    ),
)
def _(spark, sf):
    scores = candidate_metrics(spark, sf).where("split = 'test'").withColumn("path", F.concat_ws("-", "model", "horizon"))
    return joins.promotion_join(
        scores.where("model = 'carry'"), scores.where("model = 'carry_two_days'")
    )


@query(
    "key_assembly",
    using("dense", f"SELECT station_id, ts, {rounded(['pm2_5', 'pm10', 'o3'])} FROM dense"),
)
def _(spark, sf):
    df = frames.dense_hourly(spark, sf)
    return joins.key_assembly([df.select(*KEY, "pm2_5", "pm10"), df.select(*KEY, "o3")])


# --- sets -----------------------------------------------------------------------------


@query("union_rows", using("both_batches", f"SELECT station_id, ts, batch_seq, {r('value')} AS value FROM both_batches"))
def _(spark, sf):
    stored, fixes = frames.stored_and_corrections(spark, sf)
    columns = [*KEY, "batch_seq", "value"]
    return stored.select(*columns).unionByName(fixes.select(*columns))


@query("union_schema", using("both_batches", f"SELECT batch_seq, event_id, k, station_id, ts, {r('value')} AS value FROM both_batches"))
def _(spark, sf):
    return upsert.union_schema(*frames.stored_and_corrections(spark, sf))
