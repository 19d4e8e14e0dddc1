"""Queries of profiles, statistics, rankings and the composite reports."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from hourloom.catalog.base import query
from hourloom.catalog.sql import FRAMES, frame, r, rounded, using
from hourloom.catalog.tables import COMPARE, IMPORTANCE, candidate_metrics, compared, importance_table
from hourloom.functions import air, fixed
from hourloom.operators import metrics, profiles, splits, stats
from hourloom.plans import reports, sections
from hourloom.sources import frames

KEY = ["station_id", "ts"]
SHOWN = ["numerical_aqi", "pm2_5", "pm10", "o3"]


def means(columns=SHOWN):
    return ", ".join(f"{r(f'avg({c})')} AS {c}_mean" for c in columns)


HOURLY_SQL = using(
    "indexed",
    f"""SELECT h.hour, {r('h.a')} AS numerical_aqi_mean, n, d.primary_pollutant FROM
    (SELECT hour(ts)::INTEGER AS hour, avg(numerical_aqi) AS a, count(numerical_aqi) AS n FROM indexed GROUP BY 1) h JOIN
    (SELECT hour, arg_min(primary_pollutant, (-c, primary_pollutant)) AS primary_pollutant FROM
    (SELECT hour(ts)::INTEGER AS hour, primary_pollutant, count(*) AS c FROM indexed
    WHERE primary_pollutant IS NOT NULL GROUP BY ALL) GROUP BY 1) d ON h.hour = d.hour""",
)


@query("index_by_hour", HOURLY_SQL)
def _(spark, sf):
    return reports.index_by_hour(frames.indexed(spark, sf))


@query("daily_profile", using("indexed", f"SELECT ts::DATE AS day, {means()} FROM indexed GROUP BY 1"))
def _(spark, sf):
    return profiles.daily(frames.indexed(spark, sf), SHOWN)


@query("hour_of_day_profile", using("indexed", f"SELECT hour(ts)::INTEGER AS hour, {means()} FROM indexed GROUP BY 1"))
def _(spark, sf):
    return profiles.hour_of_day(frames.indexed(spark, sf), SHOWN)


@query(
    "month_profile",
    f"SELECT month(o_orderdate)::INTEGER AS month, strftime(o_orderdate, '%b') AS month_label, {means(['o_totalprice'])} "
    "FROM orders GROUP BY 1, 2",
)
def _(spark, sf):
    return profiles.by_month(frames.table(spark, sf, "orders"), ["o_totalprice"], ts="o_orderdate")


DAYS = ", ".join(f"({i}, '{d}')" for i, d in enumerate(fixed.WEEKDAYS))


@query(
    "weekday_profile",
    using(
        "indexed",
        f"SELECT v.place, v.day_name, {means()} FROM (VALUES {DAYS}) v(place, day_name) LEFT JOIN indexed i "
        "ON dayname(i.ts) = v.day_name GROUP BY 1, 2",
    ),
)
def _(spark, sf):
    return profiles.weekday(frames.indexed(spark, sf), SHOWN)


@query(
    "reindex_domain",
    f"""SELECT v.place, v.day_name, n FROM (VALUES {DAYS}) v(place, day_name) LEFT JOIN
    (SELECT dayname(ts) AS day_name, count(*) AS n FROM events WHERE isodow(ts) < 6 GROUP BY 1) e ON e.day_name = v.day_name""",
)
def _(spark, sf):
    """Counts of working days only: Saturday and Sunday appear, without a value."""
    from hourloom.operators.joins import reindex_domain

    counted = (
        frames.readings(spark, sf)
        .where(F.weekday("ts") < 5)
        .groupBy(F.date_format("ts", "EEEE").alias("day_name"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return reindex_domain(counted, "day_name", list(fixed.WEEKDAYS))


@query(
    "peak_hour_stats",
    using(
        "indexed",
        f"""SELECT hour, {r('m')} AS mean, {r('s')} AS std, n, {r('m + s')} AS upper, {r('m - s')} AS lower FROM
        (SELECT hour(ts)::INTEGER AS hour, avg(numerical_aqi) AS m, stddev_samp(numerical_aqi) AS s,
        count(numerical_aqi) AS n FROM indexed GROUP BY 1) WHERE n >= 5""",
    ),
)
def _(spark, sf):
    return profiles.peak_hours(frames.indexed(spark, sf), "numerical_aqi")


@query(
    "season_values",
    using(
        "indexed",
        f"""SELECT season, n, {rounded(['min', 'max', 'q25', 'q50', 'q75'])}, {r('min(v) FILTER (v BETWEEN lo AND hi)')} AS whisker_low,
        {r('max(v) FILTER (v BETWEEN lo AND hi)')} AS whisker_high, count(*) FILTER (NOT (v BETWEEN lo AND hi)) AS n_outliers
        FROM seasons JOIN box USING (season) GROUP BY season, n, min, max, q25, q50, q75""",
        seasons="""SELECT CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) IN (3, 4, 5) THEN 'Spring'
        WHEN month(ts) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season, numerical_aqi AS v FROM indexed
        WHERE numerical_aqi IS NOT NULL""",
        box="""SELECT *, q25 - 1.5 * (q75 - q25) AS lo, q75 + 1.5 * (q75 - q25) AS hi FROM (SELECT season, count(*) AS n,
        min(v) AS min, max(v) AS max, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50,
        quantile_cont(v, 0.75) AS q75 FROM seasons GROUP BY 1)""",
    ).replace("min(v) FILTER", "min(v) FILTER"),
)
def _(spark, sf):
    return profiles.season_box(frames.indexed(spark, sf), "numerical_aqi")


@query("value_counts", using("indexed", "SELECT primary_pollutant, count(*) AS n FROM indexed WHERE primary_pollutant IS NOT NULL GROUP BY 1"))
def _(spark, sf):
    return profiles.value_counts(frames.indexed(spark, sf), "primary_pollutant")


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std,
        {r(f'min({c})')} AS min, {r(f'quantile_cont({c}, 0.25)')} AS q25, {r(f'quantile_cont({c}, 0.5)')} AS q50,
        {r(f'quantile_cont({c}, 0.75)')} AS q75, {r(f'max({c})')} AS max FROM lineitem"""
        for c in NUMBERS
    ),
)
def _(spark, sf):
    return stats.describe(frames.table(spark, sf, "lineitem"), NUMBERS)


@query(
    "quantile",
    " UNION ALL ".join(
        f"""SELECT l_shipmode AS flag, '{c}' AS "column", {p}::DOUBLE AS prob, {r(f'quantile_cont({c}, {p})')} AS value
        FROM lineitem GROUP BY 1""".replace("l_shipmode", "l_returnflag")
        for c in NUMBERS
        for p in (0.1, 0.5, 0.95)
    ),
)
def _(spark, sf):
    rows = frames.table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "flag")
    return stats.exact_quantiles(rows, NUMBERS, [0.1, 0.5, 0.95], keys=("flag",))


@query(
    "null_counts",
    using(
        "sparse",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS nulls, count(*) AS rows FROM sparse"""
            for c in (*KEY, *frames.SPARSE_COLUMNS)
        ),
    ),
)
def _(spark, sf):
    return stats.null_counts(frames.sparse_hourly(spark, sf))


@query(
    "completeness_pct",
    using(
        "sparse",
        "SELECT "
        + r("(200.0::DOUBLE + " + " + ".join(f"100.0::DOUBLE * count({c}) / count(*)" for c in frames.SPARSE_COLUMNS) + ") / 7")
        + " AS completeness_pct FROM sparse",
    ),
)
def _(spark, sf):
    return stats.completeness_pct(frames.sparse_hourly(spark, sf))


@query("time_range", using("dense", "SELECT min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows, 13 AS n_columns FROM dense"))
def _(spark, sf):
    return stats.time_range(frames.dense_hourly(spark, sf))


MIXED = ["pm2_5", "pm10", "o3", "no2", "temperature"]


@query(
    "corr_matrix",
    using(
        "sparse",
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})')} AS corr FROM sparse" for a in MIXED for b in MIXED
        ),
    ),
)
def _(spark, sf):
    return stats.corr_matrix(frames.sparse_hourly(spark, sf), MIXED)


@query("corr_with_target", using("dense", f"SELECT feature AS \"column\", {r('importance')} AS corr FROM ranked", ranked=IMPORTANCE.replace("abs(", "(")))
def _(spark, sf):
    columns = [c for c in frames.DENSE_COLUMNS if c != "pm2_5"]
    return stats.corr_with_target(frames.dense_hourly(spark, sf), columns, "pm2_5")


def _bins(column, n, source):
    return f"""SELECT CASE WHEN hi > lo THEN least({n}, floor(({column} - lo) / (hi - lo) * {n}) + 1)::BIGINT ELSE 1 END AS bin,
    count(*) AS n FROM {source}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) WHERE {column} IS NOT NULL GROUP BY 1"""


@query("histogram", _bins("l_extendedprice", 30, "lineitem"))
def _(spark, sf):
    return stats.histogram(frames.table(spark, sf, "lineitem"), "l_extendedprice", 30)


@query(
    "ratio_histogram",
    using("dense", _bins("ratio", 25, "ratios"), ratios="SELECT pm2_5 / pm10 AS ratio FROM dense WHERE pm2_5 > 0 AND pm10 > 0"),
)
def _(spark, sf):
    return stats.histogram(profiles.pm_ratio(frames.dense_hourly(spark, sf)), "pm_ratio", 25)


@query(
    "exceedance_pct",
    using(
        "dense",
        " UNION ALL ".join(
            f"SELECT '{p}' AS pollutant, '{a}' AS authority, {r(f'100.0::DOUBLE * count(*) FILTER ({p} > {limit}) / count(*) FILTER ({p} > 0)')} AS pct FROM dense"
            for p, a, limit in fixed.EXCEEDANCE_LIMITS
        ),
    ),
)
def _(spark, sf):
    return profiles.exceedance(frames.dense_hourly(spark, sf))


@query(
    "forecast_summary",
    using("indexed", f"SELECT {r('avg(numerical_aqi)')} AS avg, {r('min(numerical_aqi)')} AS min, {r('max(numerical_aqi)')} AS max, count(numerical_aqi) AS n_valid, count(*) AS n_rows FROM indexed"),
)
def _(spark, sf):
    return profiles.forecast_summary(frames.indexed(spark, sf), "numerical_aqi")


FIRST_LAST = f"""SELECT station_id, {r('fm')} AS first_mean, {r('lm')} AS last_mean, {r('fs')} AS first_std, {r('ls')} AS last_std,
  {r('lm - fm')} AS change, CASE WHEN lm > fm THEN 'Worsening' WHEN lm < fm THEN 'Improving' ELSE 'Stable' END AS direction,
  CASE WHEN ls > fs THEN 'More Variable' WHEN ls < fs THEN 'Less Variable' ELSE 'Same Variability' END AS volatility
  FROM (SELECT station_id, avg(pm10) FILTER (pos <= 24) AS fm, avg(pm10) FILTER (pos > len - 24) AS lm,
  stddev_samp(pm10) FILTER (pos <= 24) AS fs, stddev_samp(pm10) FILTER (pos > len - 24) AS ls
  FROM placed WHERE len >= 48 GROUP BY 1)"""


@query(
    "first_last_compare",
    using(
        "users",
        FIRST_LAST,
        placed="SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts) AS pos, count(*) OVER (PARTITION BY station_id) AS len FROM users",
    ),
)
def _(spark, sf):
    return profiles.first_last_compare(frames.user_hourly(spark, sf), "pm10").drop("first_n", "last_n")


@query("regression_metrics", using("scored", f"SELECT model, horizon, split, n, {rounded(['rmse', 'mae', 'r2', 'mape'])} FROM scored"))
def _(spark, sf):
    return candidate_metrics(spark, sf)


@query(
    "macro_average",
    using("scored", "SELECT model, split, " + ", ".join(f"{r(f'avg({m})')} AS {m}" for m in ("rmse", "mae", "r2", "mape")) + " FROM scored GROUP BY 1, 2"),
)
def _(spark, sf):
    return metrics.macro_average(candidate_metrics(spark, sf), by=("model", "split"))


@query(
    "weighted_horizon_error",
    using("predictions", f"SELECT model, {r('avg(CASE WHEN horizon = 48 THEN 2 ELSE 1 END * (y - p) * (y - p))')} AS weighted_mse FROM predictions GROUP BY 1"),
)
def _(spark, sf):
    return metrics.weighted_horizon_error(frames.naive_predictions(spark, sf), focus=48)


@query(
    "best_per_horizon",
    using("scored", f"SELECT horizon, arg_min(model, (rmse, model)) AS model, {r('min(rmse)')} AS rmse FROM scored WHERE split = 'test' GROUP BY 1"),
)
def _(spark, sf):
    return metrics.best_per_horizon(candidate_metrics(spark, sf).where("split = 'test'"))


@query(
    "improvement_rate",
    using(
        "scored",
        f"""SELECT n_improved, n_comparable, {r('rate')} AS rate_pct, CASE WHEN rate >= 60 THEN 'excellent' WHEN rate >= 40 THEN 'good'
        WHEN rate >= 20 THEN 'moderate' WHEN rate IS NULL THEN 'none' ELSE 'poor' END AS verdict FROM (SELECT
        count(*) FILTER (status = 'better') AS n_improved, count(*) FILTER (status <> 'new') AS n_comparable,
        100.0::DOUBLE * count(*) FILTER (status = 'better') / count(*) FILTER (status <> 'new') AS rate FROM compared)""",
    ).replace(" SELECT n_improved", f", {COMPARE} SELECT n_improved"),
)
def _(spark, sf):
    return metrics.improvement_rate(compared(spark, sf))


HASHED = ["pm2_5", "pm10", "o3"]


@query(
    "snapshot_hash",
    using(
        "users",
        "SELECT station_id, md5(concat_ws(',', "
        + ", ".join(f"CAST(CAST(round({c}, 6) AS DECIMAL(38, 6)) AS VARCHAR)" for c in HASHED)
        + ")) AS snapshot FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC) AS n FROM users) WHERE n = 1",
    ),
)
def _(spark, sf):
    return profiles.snapshot_hash(frames.user_hourly(spark, sf), HASHED)


# --- order, limit, rank ---------------------------------------------------------------


@query("sort_by_time", using("dense", f"SELECT station_id, ts, {r('pm2_5')} AS pm2_5 FROM dense ORDER BY ts, station_id"))
def _(spark, sf):
    return frames.dense_hourly(spark, sf).select(*KEY, "pm2_5").orderBy("ts", "station_id")


@query(
    "head_tail",
    using(
        "dense",
        f"""SELECT * FROM (SELECT station_id, ts, {r('pm2_5')} AS pm2_5, 'head' AS part FROM dense ORDER BY ts, station_id LIMIT 5)
        UNION ALL SELECT * FROM (SELECT station_id, ts, {r('pm2_5')}, 'tail' FROM dense ORDER BY ts DESC, station_id DESC LIMIT 5)""",
    ),
)
def _(spark, sf):
    return profiles.head_tail(frames.dense_hourly(spark, sf).select(*KEY, "pm2_5"))


@query("top_features", using("dense", f"SELECT feature, {r('importance')} AS importance FROM ranked ORDER BY ranked.importance DESC, feature LIMIT 5", ranked=IMPORTANCE))
def _(spark, sf):
    from hourloom.models.selection import top_features

    return top_features(importance_table(spark, sf), 5)


@query(
    "leaderboard_rank",
    using("scored", f"SELECT model, horizon, split, {r('rmse')} AS rmse, rank() OVER (PARTITION BY horizon, split ORDER BY rmse)::INTEGER AS rank FROM scored"),
)
def _(spark, sf):
    ranked = metrics.leaderboard(candidate_metrics(spark, sf), by=("horizon", "split"))
    return ranked.select("model", "horizon", "split", "rmse", "rank")


@query(
    "top_k_models",
    using(
        "scored",
        "SELECT model, horizon, place FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY rmse, model)::INTEGER AS place "
        "FROM scored WHERE split = 'test') WHERE place <= 2",
    ),
)
def _(spark, sf):
    top = metrics.top_models(candidate_metrics(spark, sf).where("split = 'test'"), 2)
    return top.select("model", "horizon", "place")


@query(
    "top_counts",
    using("indexed", f"SELECT {r('numerical_aqi')} AS numerical_aqi, count(*) AS n FROM indexed WHERE numerical_aqi IS NOT NULL GROUP BY 1 ORDER BY 1 LIMIT 20"),
)
def _(spark, sf):
    return profiles.top_counts(frames.indexed(spark, sf), "numerical_aqi")


@query(
    "seeded_sample",
    using("users", f"SELECT station_id, ts, {r('pm2_5')} AS pm2_5 FROM users ORDER BY md5(station_id || '|' || epoch_us(ts)::VARCHAR || '|42') LIMIT 1000"),
)
def _(spark, sf):
    return profiles.seeded_sample(frames.user_hourly(spark, sf).select(*KEY, "pm2_5"), 1000)


# --- composite reports ----------------------------------------------------------------


@query(
    "historical_report",
    using(
        "indexed",
        f"""SELECT 'daily' AS section, strftime(ts, '%Y-%m-%d') AS label, count(numerical_aqi) AS n, {r('avg(numerical_aqi)')} AS mean,
        {r('max(numerical_aqi)')} AS peak FROM indexed GROUP BY 2
        UNION ALL SELECT 'hour', lpad(hour(ts)::VARCHAR, 2, '0'), count(numerical_aqi), {r('avg(numerical_aqi)')}, {r('max(numerical_aqi)')} FROM indexed GROUP BY 2
        UNION ALL SELECT 'month', strftime(ts, '%b'), count(numerical_aqi), {r('avg(numerical_aqi)')}, {r('max(numerical_aqi)')} FROM indexed GROUP BY 2
        UNION ALL SELECT 'weekday', dayname(ts), count(numerical_aqi), {r('avg(numerical_aqi)')}, {r('max(numerical_aqi)')} FROM indexed GROUP BY 2
        UNION ALL SELECT 'season', CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) IN (3, 4, 5) THEN 'Spring'
        WHEN month(ts) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END, count(numerical_aqi), {r('avg(numerical_aqi)')}, {r('max(numerical_aqi)')} FROM indexed GROUP BY 2
        UNION ALL SELECT 'pollutant', coalesce(primary_pollutant, 'unknown'), count(numerical_aqi), {r('avg(numerical_aqi)')}, {r('max(numerical_aqi)')} FROM indexed GROUP BY 2""",
    ),
)
def _(spark, sf):
    return reports.historical_report(frames.indexed(spark, sf))


@query(
    "forecast_report",
    using(
        "indexed",
        f"""SELECT station_id, {r('avg(f)')} AS avg, {r('min(f)')} AS min, {r('max(f)')} AS max, count(f) AS n_valid,
        {r('max(f * 1.1::DOUBLE)')} AS upper, {r('min(f * 0.9::DOUBLE)')} AS lower, count(*) FILTER (d > 0) AS n_worsening,
        count(*) FILTER (d < 0) AS n_improving FROM (SELECT station_id, numerical_aqi AS f,
        numerical_aqi - lag(numerical_aqi) OVER (PARTITION BY station_id ORDER BY ts) AS d FROM indexed) GROUP BY 1""",
    ),
)
def _(spark, sf):
    return reports.forecast_report(frames.indexed(spark, sf).withColumnRenamed("numerical_aqi", "aqi_forecast"))


LISTED = ["pm2_5", "pm10", "o3", "co", "no2", "so2", *sections.WEATHER]
LISTED_POLLUTANTS = [c for c in fixed.POLLUTANTS if c in LISTED]
MEASURED = ["numerical_aqi", *LISTED_POLLUTANTS, *sections.WEATHER, "pm_ratio"]
SEASON = """CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) IN (3, 4, 5) THEN 'Spring'
  WHEN month(ts) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"""
PROFILED = {
    "daily": "strftime(ts, '%Y-%m-%d')",
    "hour": "strftime(ts, '%H')",
    "month": "strftime(ts, '%b')",
    "weekday": "dayname(ts)",
    "season": SEASON,
    "component": "coalesce(primary_pollutant, 'unknown')",
    "all": "'all'",
}
NUMBER = "NULL::DOUBLE"


def _told(section, label, column, n, source, mean=NUMBER, std=NUMBER, lo=NUMBER, q=(NUMBER,) * 3, hi=NUMBER, value=NUMBER, tail=""):
    numbers = {"mean": mean, "std": std, "min": lo, "q25": q[0], "q50": q[1], "q75": q[2], "max": hi, "value": value}
    cells = ", ".join(f"{r(e)} AS {name}" for name, e in numbers.items())
    return f'SELECT {section} AS section, {label} AS label, {column} AS "column", ({n})::BIGINT AS n, {cells} FROM {source} {tail}'


def _sections_sql():
    parts = []
    for section, label in PROFILED.items():
        q = tuple(f"quantile_cont(v, {p}) FILTER (\"column\" <> 'pm_ratio')" if section == "all" else NUMBER for p in (0.25, 0.5, 0.75))
        parts.append(_told(f"'{section}'", label, '"column"', "count(v)", "long", "avg(v)", "stddev_samp(v)", "min(v)", q, "max(v)", tail="GROUP BY ALL"))
    hour = dict(mean="m", std="s", lo="m - s", hi="m + s")
    parts.append(_told("'peak_hour'", "hour", "'numerical_aqi'", "k", "peaks", **hour, tail=f"WHERE k >= {sections.LEAST_AN_HOUR}"))
    for a, b in [*combinations(LISTED_POLLUTANTS, 2), *combinations([*sections.WEATHER, "numerical_aqi"], 2)]:
        both = f"count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL)"
        parts.append(_told("'correlation'", f"'{b}'", f"'{a}'", both, "base", value=f"corr({a}, {b})"))
    for p, who, limit in fixed.EXCEEDANCE_LIMITS:
        valid = f"count(*) FILTER ({p} > 0)"
        parts.append(_told("'exceedance'", f"'{who}'", f"'{p}'", valid, "base", value=f"count(*) FILTER ({p} > {limit}) * 100.0 / {valid}"))
    for lo, hi, label in zip(fixed.PM25_BIN_EDGES, fixed.PM25_BIN_EDGES[1:], fixed.PM25_BIN_LABELS):
        parts.append(_told("'bin'", f"'{label}'", "'pm2_5'", f"count(*) FILTER (pm2_5 > {lo} AND pm2_5 <= {hi})", "base"))
    columns = [*KEY, *LISTED, "numerical_aqi", "primary_pollutant"]
    missing = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns)
    parts.append(_told("'overview'", "'rows'", "''", "count(*)", "base"))
    parts.append(_told("'overview'", "'columns'", "''", f"{len(columns)} + 0 * count(*)", "base"))
    parts.append(_told("'overview'", "'missing'", "''", missing, "base"))
    parts.append(_told("'overview'", "'complete_pct'", "''", "count(*)", "base", value=f"100.0 * (1 - ({missing}) / (count(*) * {len(columns)}.0::DOUBLE))"))
    inside = "v BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)"
    parts.append(
        _told("'season_box'", "season", "'numerical_aqi'", "count(v)", "seasons JOIN boxes USING (season)", lo=f"min(v) FILTER ({inside})",
              q=("q25", "q50", "q75"), hi=f"max(v) FILTER ({inside})", value=f"count(*) FILTER (NOT ({inside}))", tail="GROUP BY season, q25, q50, q75")
    )
    for k in sections.SMOOTHED:
        parts.append(_told(f"'smoothed_{k}'", "strftime(ts, '%Y-%m-%d %H:%M')", "'numerical_aqi'", "k", f"smooth_{k}", mean="m", value="w"))
    return " UNION ALL ".join(f"({p})" for p in parts)


@query(
    "historical_sections",
    using(
        "indexed",
        _sections_sql(),
        base=f"SELECT station_id, ts, {', '.join(LISTED)}, numerical_aqi, primary_pollutant, CASE WHEN pm2_5 > 0 AND pm10 > 0 THEN pm2_5 / pm10 END AS pm_ratio FROM indexed",
        wide=f"SELECT ts, primary_pollutant, {', '.join(f'{c}::DOUBLE AS {c}' for c in MEASURED)} FROM base",
        long=" UNION ALL ".join(f"SELECT ts, primary_pollutant, '{c}' AS \"column\", {c} AS v FROM wide" for c in MEASURED),
        peaks="SELECT strftime(ts, '%H') AS hour, count(numerical_aqi) AS k, avg(numerical_aqi) AS m, stddev_samp(numerical_aqi) AS s FROM base GROUP BY 1",
        seasons=f"SELECT {SEASON} AS season, numerical_aqi AS v FROM base WHERE numerical_aqi IS NOT NULL",
        boxes="SELECT season, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75 FROM seasons GROUP BY 1",
        hours="SELECT ts, count(numerical_aqi) AS k, avg(numerical_aqi) AS m FROM base GROUP BY 1",
        **{
            f"smooth_{k}": f"SELECT *, avg(m) OVER (ORDER BY ts ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS w FROM hours"
            for k in sections.SMOOTHED
        },
    ),
)
def _(spark, sf):
    """Every section of the history page from one table of cells."""
    columns = [*KEY, *LISTED, "numerical_aqi", "primary_pollutant"]
    return sections.historical_sections(frames.indexed(spark, sf).select(*columns))


@query(
    "forecast_sections",
    using(
        "numbered",
        f"""SELECT station_id, 'hour' AS section, strftime(ts, '%H') AS label, count(f) AS n, {r('avg(f)')} AS value FROM rows GROUP BY ALL
        UNION ALL SELECT station_id, 'bin', lpad(least(20, CASE WHEN hi > lo THEN floor((f - lo) / (hi - lo) * 20) + 1 ELSE 1 END)::INTEGER::VARCHAR, 2, '0'), count(*), NULL
        FROM rows JOIN ends USING (station_id) WHERE f IS NOT NULL GROUP BY ALL
        UNION ALL SELECT station_id, 'first_24', direction, a_n, {r('a')} FROM halves UNION ALL SELECT station_id, 'last_24', volatility, b_n, {r('b')} FROM halves""",
        rows="SELECT station_id, ts, pos, len, numerical_aqi AS f FROM numbered",
        ends="SELECT station_id, min(f) AS lo, max(f) AS hi FROM rows GROUP BY 1",
        halves="""SELECT station_id, a, b, a_n, b_n, CASE WHEN b > a THEN 'Worsening' WHEN b < a THEN 'Improving' ELSE 'Stable' END AS direction,
        CASE WHEN d > c THEN 'More Variable' WHEN d < c THEN 'Less Variable' ELSE 'Same Variability' END AS volatility FROM (
        SELECT station_id, avg(f) FILTER (pos <= 24) AS a, avg(f) FILTER (pos > len - 24) AS b, stddev_samp(f) FILTER (pos <= 24) AS c,
        stddev_samp(f) FILTER (pos > len - 24) AS d, count(f) FILTER (pos <= 24) AS a_n, count(f) FILTER (pos > len - 24) AS b_n
        FROM rows WHERE len >= 48 GROUP BY 1)""",
    ),
)
def _(spark, sf):
    """Hour profile, distribution, and first against last day of each series of a forecast."""
    return sections.forecast_sections(frames.indexed(spark, sf).withColumnRenamed("numerical_aqi", "aqi_forecast"))
