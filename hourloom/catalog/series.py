"""Queries of the series windows, fills, targets, splits and history windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hourloom.catalog.base import query
from hourloom.catalog.sql import NEEDS, frame, mean_min, r, rounded, trend, using
from hourloom.functions import air, fixed
from hourloom.operators import fill, layout, rolling, splits, upsert
from hourloom.plans import features, incremental, training
from hourloom.plans import index as index_plan
from hourloom.session import fresh_path
from hourloom.sources import frames
from hourloom.sources.versions import VersionedTable

KEY = ["station_id", "ts"]
BY = "(PARTITION BY station_id ORDER BY ts)"
PLACED = "SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts) AS pos, count(*) OVER (PARTITION BY station_id) AS len FROM {}"


def windowed(name, back, columns, sql_columns, ahead=0, source=frames.user_hourly, table="users"):
    """Register one window query over the per-user series."""
    body = ", ".join(f"{r(e)} AS {n}" for n, e in sql_columns.items())

    @query(name, using(table, f"SELECT station_id, ts, {body} FROM placed", placed=PLACED.format(table)))
    def _(spark, sf):
        out = layout.over_series(source(spark, sf), columns, back=back, ahead=ahead)
        return out.select(*KEY, *sql_columns)


@query(
    "rolling_mean_min",
    using("averaged", f"SELECT station_id, ts, {rounded(index_plan.AVERAGES)} FROM averaged"),
)
def _(spark, sf):
    converted = air.convert_units(frames.dense_hourly(spark, sf))
    out = layout.over_series(converted, lambda w: index_plan.averages(converted.columns, w), back=index_plan.REACH)
    return out.select(*KEY, *index_plan.AVERAGES)


SIZES = fixed.WINDOWS
MEANS = ("pm2_5", "temperature", "relative_humidity", "pressure", "wind_speed")
windowed(
    "rolling_mean",
    71,
    lambda w: {f"{c}_{n}": rolling.rolling_mean(c, n, w) for c in MEANS for n in SIZES},
    {f"{c}_{n}": f"avg({c}) OVER {frame(n)}" for c in MEANS for n in SIZES},
)
windowed(
    "rolling_std",
    71,
    lambda w: {f"{c}_{n}": rolling.rolling_std(c, n, w) for c in ("pm2_5", "no2") for n in SIZES},
    {f"{c}_{n}": f"stddev_samp({c}) OVER {frame(n)}" for c in ("pm2_5", "no2") for n in SIZES},
)
windowed(
    "rolling_trend",
    71,
    lambda w: {f"{c}_{n}": rolling.rolling_trend(c, n, w) for c in ("pm2_5", "pressure") for n in SIZES},
    {f"{c}_{n}": trend(c, n) for c in ("pm2_5", "pressure") for n in SIZES},
)
windowed(
    "rolling_max",
    71,
    lambda w: {f"wind_{n}": rolling.rolling_max("wind_speed", n, w) for n in SIZES},
    {f"wind_{n}": f"max(wind_speed) OVER {frame(n)}" for n in SIZES},
)
windowed(
    "rolling_with_gaps",
    11,
    lambda w: {
        f"{n}_{k}": f("pm2_5", k, w)
        for n, f in (
            ("mean", rolling.rolling_mean),
            ("std", rolling.rolling_std),
            ("trend", rolling.rolling_trend),
            ("max", rolling.rolling_max),
        )
        for k in (2, 12)
    },
    {
        f"{n}_{k}": f
        for k in (2, 12)
        for n, f in (
            ("mean", f"avg(pm2_5) OVER {frame(k)}"),
            ("std", f"stddev_samp(pm2_5) OVER {frame(k)}"),
            ("trend", trend("pm2_5", k)),
            ("max", f"max(pm2_5) OVER {frame(k)}"),
        )
    },
    source=frames.sparse_hourly,
    table="sparse",
)
windowed(
    "lag_features",
    72,
    lambda w: {f"{c}_lag_{k}": rolling.lag(c, k, w) for c in fixed.MODELLED for k in fixed.LAGS},
    {f"{c}_lag_{k}": f"lag({c}, {k}) OVER {BY}" for c in fixed.MODELLED for k in fixed.LAGS},
)
windowed(
    "change_features",
    48,
    lambda w: {f"{c}_change_{k}": rolling.change(c, k, w) for c in fixed.MODELLED for k in fixed.CHANGES},
    {f"{c}_change_{k}": f"{c} - lag({c}, {k}) OVER {BY}" for c in fixed.MODELLED for k in fixed.CHANGES},
)
windowed(
    "momentum_features",
    48,
    lambda w: {f"{c}_momentum_{k}": rolling.change(c, k, w) for c in fixed.MODELLED for k in fixed.MOMENTA},
    {f"{c}_momentum_{k}": f"{c} - lag({c}, {k}) OVER {BY}" for c in fixed.MODELLED for k in fixed.MOMENTA},
)
windowed(
    "smoothed_trend",
    167,
    lambda w: {f"smooth_{n}": rolling.rolling_mean("numerical_aqi", n, w) for n in (24, 168)},
    {f"smooth_{n}": f"avg(numerical_aqi) OVER {frame(n)}" for n in (24, 168)},
    source=frames.indexed,
    table="indexed",
)
windowed(
    "hourly_change",
    1,
    lambda w: {"change": rolling.change("pm10", 1, w)},
    {"change": f"pm10 - lag(pm10) OVER {BY}"},
)
windowed(
    "time_delta",
    1,
    lambda w: {"hours": rolling.hours_since_previous("ts", w)},
    {"hours": f"(epoch(ts) - epoch(lag(ts) OVER {BY})) / 3600.0::DOUBLE"},
)
windowed(
    "rolling_mean_time",
    71,
    lambda w: {f"mean_{n}": rolling.rolling_mean_time("pm2_5", n, "ts", w) for n in (24, 72)},
    {
        f"mean_{n}": f"avg(pm2_5) OVER (PARTITION BY station_id ORDER BY ts RANGE BETWEEN INTERVAL {n - 1} HOURS PRECEDING AND CURRENT ROW)"
        for n in (24, 72)
    },
)


@query(
    "halo_windows",
    using("users", f"SELECT station_id, ts, {r(f'avg(pm2_5) OVER {frame(24)}')} AS mean_24, {r(f'lead(pm2_5, 12) OVER {BY}')} AS ahead_12 FROM users"),
)
def _(spark, sf):
    """Small blocks, so that most frames reach into a neighbouring one."""
    out = layout.over_series(
        frames.user_hourly(spark, sf),
        lambda w: {"mean_24": rolling.rolling_mean("pm2_5", 24, w), "ahead_12": F.lead("pm2_5", 12).over(w)},
        back=23,
        ahead=12,
        rows=25,
    )
    return out.select(*KEY, "mean_24", "ahead_12")


@query("row_position", using("users", "SELECT station_id, ts, pos AS _pos, len AS _len FROM placed", placed=PLACED.format("users")))
def _(spark, sf):
    return layout.with_position(frames.user_hourly(spark, sf)).select(*KEY, layout.POS, layout.LEN)


@query(
    "future_targets",
    using(
        "indexed",
        "SELECT station_id, ts, "
        + ", ".join(f"{r(f'lead(numerical_aqi, {h}) OVER {BY}')} AS target_aqi_{h}h" for h in fixed.HORIZONS)
        + " FROM indexed",
    ),
)
def _(spark, sf):
    return splits.future_targets(frames.indexed(spark, sf)).select(*KEY, *fixed.TARGETS)


LEADS = "SELECT station_id, ts, pos, len, " + ", ".join(
    f"lead(numerical_aqi, {h}) OVER {BY} AS t{h}" for h in fixed.HORIZONS
) + " FROM numbered"
CUTS = "SELECT station_id, least(" + ", ".join(
    f"coalesce(max(pos) FILTER (t{h} IS NOT NULL), 1)" for h in fixed.HORIZONS
) + ") AS cut FROM leads GROUP BY 1"
TRIMMED = "SELECT leads.* FROM leads JOIN cuts_at USING (station_id) WHERE cut <= 1 OR pos <= cut"


@query(
    "trim_tail",
    using(
        "numbered",
        "SELECT station_id, ts, " + ", ".join(f"{r(f't{h}')} AS target_aqi_{h}h" for h in fixed.HORIZONS) + " FROM trimmed",
        leads=LEADS,
        cuts_at=CUTS,
        trimmed=TRIMMED,
    ),
)
def _(spark, sf):
    return splits.trim_tail(splits.future_targets(frames.indexed(spark, sf))).select(*KEY, *fixed.TARGETS)


@query(
    "valid_target_counts",
    using(
        "numbered",
        " UNION ALL ".join(
            f"""SELECT 'target_aqi_{h}h' AS "column", count(t{h}) AS n, {r(f'min(t{h})')} AS min, {r(f'max(t{h})')} AS max FROM leads"""
            for h in fixed.HORIZONS
        ),
        leads=LEADS,
    ),
)
def _(spark, sf):
    long = splits.future_targets(frames.indexed(spark, sf)).unpivot([], list(fixed.TARGETS), "column", "v")
    return long.groupBy("column").agg(F.count("v").alias("n"), F.min("v").alias("min"), F.max("v").alias("max"))


def _filled_sql(c):
    back = "(PARTITION BY station_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    on = "(PARTITION BY station_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"coalesce(last_value({c} IGNORE NULLS) OVER {back}, first_value({c} IGNORE NULLS) OVER {on})"


FILLED = ("pm2_5", "pm10", "o3", "no2")


@query(
    "ffill_bfill",
    using("sparse", "SELECT station_id, ts, " + ", ".join(f"{r(_filled_sql(c))} AS {c}" for c in FILLED) + " FROM sparse"),
)
def _(spark, sf):
    return fill.ffill_bfill(frames.sparse_hourly(spark, sf).select(*KEY, *FILLED), list(FILLED))


def _between_sql(c):
    back = "(PARTITION BY station_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    on = "(PARTITION BY station_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    known = f"CASE WHEN {c} IS NOT NULL THEN pos END"
    return (
        f"last_value({c} IGNORE NULLS) OVER {back} AS pv, last_value({known} IGNORE NULLS) OVER {back} AS pp, "
        f"first_value({c} IGNORE NULLS) OVER {on} AS nv, first_value({known} IGNORE NULLS) OVER {on} AS np"
    )


LINEAR = (
    "CASE WHEN {c} IS NOT NULL THEN {c} WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv "
    "ELSE pv + (nv - pv) / (np - pp) * (pos - pp) END"
)


@query(
    "interpolate_linear",
    using(
        "sparse",
        f"SELECT station_id, ts, {r(LINEAR.format(c='temperature'))} AS temperature FROM reached",
        placed=PLACED.format("sparse"),
        reached=f"SELECT *, {_between_sql('temperature')} FROM placed",
    ),
)
def _(spark, sf):
    return fill.interpolate_linear(frames.sparse_hourly(spark, sf).select(*KEY, "temperature"), ["temperature"])


@query(
    "gap_fill_policy",
    using(
        "sparse",
        f"""SELECT station_id, ts, {r(_filled_sql('pm2_5'))} AS pm2_5, {r(LINEAR.format(c='temperature'))} AS temperature,
        {r('coalesce(pm10, m)')} AS pressure, {r('coalesce(o3, 0)')} AS precipitation, hour(ts)::INTEGER AS hour,
        CASE WHEN no2 > 0 THEN 'seen' ELSE 'unknown' END AS note, {r('no2')} AS numerical_aqi
        FROM reached JOIN medians USING (station_id)""",
        placed=PLACED.format("sparse"),
        reached=f"SELECT *, {_between_sql('temperature')} FROM placed",
        medians="SELECT station_id, quantile_cont(pm10, 0.5) AS m FROM sparse GROUP BY 1",
    ),
)
def _(spark, sf):
    rows = frames.sparse_hourly(spark, sf).select(
        *KEY,
        "pm2_5",
        "temperature",
        F.col("pm10").alias("pressure"),
        F.col("o3").alias("precipitation"),
        F.when(F.col("pm2_5").isNotNull(), F.hour("ts")).alias("hour"),
        F.when(F.col("no2") > 0, F.lit("seen")).alias("note"),
        F.col("no2").alias("numerical_aqi"),
    )
    return fill.gap_fill_policy(rows)


@query(
    "upsample_ffill",
    using(
        "daily_orders",
        f"SELECT station_id, ts, {r('last_value(price IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY ts)')} AS price "
        "FROM hours LEFT JOIN daily_orders USING (station_id, ts)",
        hours="SELECT station_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM daily_orders GROUP BY 1",
    ),
)
def _(spark, sf):
    return fill.upsample_ffill(frames.daily_orders(spark, sf), ["price"])


@query(
    "dedup_keep_last",
    using(
        "both_batches",
        f"SELECT station_id, ts, {r('arg_max(value, batch_seq)')} AS value, max(batch_seq) AS batch_seq FROM both_batches GROUP BY ALL",
    ),
)
def _(spark, sf):
    stored, fixes = frames.stored_and_corrections(spark, sf)
    return upsert.keep_last(upsert.union_schema(stored, fixes)).select(*KEY, "value", "batch_seq")


@query(
    "temporal_split",
    using(
        "users",
        """SELECT station_id, ts, CASE WHEN pos <= floor(len * 0.6::DOUBLE) THEN 'train'
        WHEN pos <= floor(len * 0.6::DOUBLE) + floor(len * 0.2::DOUBLE) THEN 'validation' ELSE 'test' END AS split,
        CASE WHEN pos <= floor(len * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS two_way FROM placed""",
        placed=PLACED.format("users"),
    ),
)
def _(spark, sf):
    placed = layout.with_position(frames.user_hourly(spark, sf).select(*KEY))
    pos, length = F.col(layout.POS), F.col(layout.LEN)
    return placed.select(
        *KEY, splits.split_label(pos, length).alias("split"), splits.split_label(pos, length, 0.8, 0).alias("two_way")
    )


@query(
    "rolling_origin_folds",
    using(
        "users",
        f"""SELECT station_id, fold, count(*) AS n_rows, max(ts) AS origin_ts, {r('avg(pm2_5)')} AS mean
        FROM placed, (VALUES (1), (2), (3), (4), (5)) v(fold)
        WHERE pos <= fold * floor(len / 6) AND fold * floor(len / 6) > 10 GROUP BY ALL""",
        placed=PLACED.format("users"),
    ),
)
def _(spark, sf):
    folds = splits.rolling_origin_folds(frames.user_hourly(spark, sf), 5, min_rows=10)
    return folds.groupBy("station_id", "fold").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("ts").alias("origin_ts"), F.avg("pm2_5").alias("mean")
    )


@query(
    "fold_origins",
    using(
        "users",
        """SELECT station_id, ts, (pos // (len // 6))::INTEGER AS fold FROM placed
        WHERE len >= 6 AND pos % (len // 6) = 0 AND pos // (len // 6) <= 5""",
        placed=PLACED.format("users"),
    ),
)
def _(spark, sf):
    return splits.fold_origins(frames.user_hourly(spark, sf), 5).select(*KEY, "fold")


@query(
    "latest_row",
    using("users", f"SELECT station_id, ts, {r('pm2_5')} AS pm2_5 FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC) AS n FROM users) WHERE n = 1"),
)
def _(spark, sf):
    return splits.latest_rows(frames.user_hourly(spark, sf)).select(*KEY, "pm2_5")


@query(
    "latest_window",
    using("users", f"SELECT station_id, ts, {r('pm2_5')} AS pm2_5 FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC) AS n FROM users) WHERE n <= 24"),
)
def _(spark, sf):
    return splits.latest_rows(frames.user_hourly(spark, sf), 24).select(*KEY, "pm2_5")


SEQUENCE = f"SELECT *, list(pm10) OVER {frame(12)} AS seq FROM placed"


def _sequence(name, variant, label, bound):
    @query(
        name,
        using(
            "users",
            f"SELECT station_id, ts, {r('list_sum(seq)')} AS total, {r('seq[1]')} AS oldest, len(seq)::INTEGER AS length, {r('label')} AS label "
            f"FROM labelled WHERE pos >= 12 AND pos <= {bound}",
            placed=PLACED.format("users"),
            windows=SEQUENCE,
            labelled=f"SELECT * EXCLUDE (len), len AS n_rows, {label} AS label FROM windows",
        ).replace("pos <= len", "pos <= n_rows"),
    )
    def _(spark, sf):
        rows = frames.user_hourly(spark, sf).select(*KEY, "pm10", "pm2_5")
        out = splits.sequence_windows(rows, ["pm10"], "pm2_5", 12, variant)
        total = F.aggregate("seq", F.lit(0.0), lambda acc, x: acc + x["pm10"])
        return out.select(
            *KEY, total.alias("total"), F.col("seq")[0]["pm10"].alias("oldest"), F.size("seq").alias("length"), "label"
        )


_sequence("sequence_windows", "label_at_end", "pm2_5", "len")
_sequence("sequence_windows_next", "label_next", f"lead(pm2_5) OVER {BY}", "len - 1")
_sequence("sequence_windows_drop_last", "drop_last", "pm2_5", "len - 1")


# --- composites -----------------------------------------------------------------------

def window_sql(kind, c, n):
    frames_of = {"mean": f"avg({c}) OVER {frame(n)}", "std": f"stddev_samp({c}) OVER {frame(n)}", "max": f"max({c}) OVER {frame(n)}"}
    if kind == "trend":
        return trend(c, n)
    old = f"lag({c}, {n}) OVER {BY}"
    return frames_of.get(kind) or (old if kind == "lag" else f"{c} - {old}")


WINDOWED = {name: window_sql(*spec) for name, spec in features.window_feature_specs(list(frames.DENSE_COLUMNS)).items()}
ROWWISE = {
    "heat_index": "temperature * (1 + 0.01::DOUBLE * relative_humidity)",
    "hour_sin": "sin(2 * pi() * hour(ts) / 24)",
    "seasonal_48h_factor": "sin(2 * pi() * dayofyear(ts) / 365) * cos(2 * pi() * hour(ts) / 12)",
    "hour": "hour(ts)",
    "is_weekend": "(isodow(ts) >= 6)::INTEGER",
}


def thousandths(e):
    return f"round_even(({e})::DOUBLE * 1e3 + 0.0001::DOUBLE, 0) / 1e3"


def summed_sql(wide, names):
    """n, sum, min and max of every named column of each station, in long form."""
    numbers = ", ".join(f"{thousandths(f'{f}(v)')} AS {f}" for f in ("sum", "min", "max"))
    listed = ", ".join(names)
    return f"""SELECT station_id, feature, count(v) AS n, {numbers} FROM (UNPIVOT (SELECT station_id, {listed} FROM {wide}) ON {listed}
    INTO NAME feature VALUE v) GROUP BY ALL"""


def summed(df, names):
    """The same in Spark: a figure that every value of every feature goes into."""
    values = F.array(*[F.col(c).cast("double") for c in names])
    long = df.select("station_id", F.posexplode(values).alias("_at", "v"))
    numbers = {f.__name__: F.rint(f("v") * 1e3 + 1e-4) / 1e3 for f in (F.sum, F.min, F.max)}
    out = long.where("v IS NOT NULL").groupBy("station_id", "_at")
    out = out.agg(F.count("v").alias("n"), *[e.alias(n) for n, e in numbers.items()])
    feature = F.get(F.array(*[F.lit(c) for c in names]), F.col("_at"))
    return out.select("station_id", feature.alias("feature"), "n", *numbers)


@query(
    "build_features",
    using(
        "users",
        summed_sql("wide", [*WINDOWED, *ROWWISE]),
        placed=PLACED.format("users"),
        wide="SELECT station_id, " + ", ".join(f"({e})::DOUBLE AS {n}" for n, e in (WINDOWED | ROWWISE).items()) + " FROM placed",
    ),
)
def _(spark, sf):
    """All 338 window features and some of a row, over every value."""
    return summed(features.build_features(frames.user_hourly(spark, sf)), [*WINDOWED, *ROWWISE])


def clip_sql(c):
    low, high = f"a_{c} - 1.5 * (b_{c} - a_{c})", f"b_{c} + 1.5 * (b_{c} - a_{c})"
    return f"greatest({low}, least({high}, {c}))"


LEARNED = {
    **{name: f"coalesce({name}, 0)" for name in WINDOWED},
    **{c: clip_sql(c) for c in ("pm2_5", "co", "o3")},
    "temperature": "greatest(-10, least(50, temperature))",
    **{f"target_aqi_{h}h": f"t{h}" for h in fixed.HORIZONS},
}


@query(
    "training_table",
    using(
        "numbered",
        summed_sql("learned", LEARNED),
        leads=LEADS,
        cuts_at=CUTS,
        windows="SELECT station_id, ts, " + ", ".join(f"{e} AS {n}" for n, e in WINDOWED.items()) + " FROM numbered",
        wide="SELECT n.station_id, n.ts, n.pos, n.pm2_5, n.co, n.o3, n.temperature, l.t24, l.t48, l.t72, w.* EXCLUDE (station_id, ts) FROM numbered n "
        "JOIN leads l ON n.station_id = l.station_id AND n.ts = l.ts JOIN windows w ON n.station_id = w.station_id AND n.ts = w.ts",
        fences="SELECT station_id, "
        + ", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in ("pm2_5", "co", "o3"))
        + " FROM numbered GROUP BY 1",
        learned="SELECT station_id, " + ", ".join(f"({e})::DOUBLE AS {n}" for n, e in LEARNED.items()) + """ FROM wide JOIN fences USING (station_id)
        JOIN cuts_at USING (station_id) WHERE (cut <= 1 OR pos <= cut) AND t24 IS NOT NULL AND t48 IS NOT NULL AND t72 IS NOT NULL""",
    ),
)
def _(spark, sf):
    """Every window feature, clipped sources and the targets, over every row."""
    return summed(training.training_table(frames.dense_hourly(spark, sf)), list(LEARNED))


@query(
    "compute_index",
    using("indexed", f"SELECT station_id, ts, {rounded(['pm2_5_aqi', 'pm10_aqi', 'o3_aqi', 'co_aqi', 'so2_aqi', 'no2_aqi', 'numerical_aqi'])}, primary_pollutant FROM indexed"),
)
def _(spark, sf):
    return frames.indexed(spark, sf).select(*KEY, *[f"{p}_aqi" for p in fixed.DOMINANCE_ORDER], "numerical_aqi", "primary_pollutant")


# --- derived tables that follow a versioned master -------------------------------------

# The second version corrects the newest three days, the third one station's hours of the tenth day.
CORRECTED = """SELECT * REPLACE (CASE WHEN newest THEN pm2_5 + 5 ELSE pm2_5 END AS pm2_5, CASE WHEN tenth THEN co * 3 ELSE co END AS co)
  FROM (SELECT *, ts >= (SELECT max(date_trunc('day', ts)) FROM first_dense) - INTERVAL 2 DAY AS newest,
  station_id = 'click' AND date_trunc('day', ts) = (SELECT min(date_trunc('day', ts)) FROM first_dense) + INTERVAL 9 DAY AS tenth FROM first_dense)"""


def corrected_master(spark, sf, after):
    """Three versions of the dense frame; ``after(master)`` is called after each."""
    rows = frames.dense_hourly(spark, sf)
    days = rows.agg(F.max(F.date_trunc("day", "ts")) - F.expr("INTERVAL 2 DAYS"), F.min(F.date_trunc("day", "ts")) + F.expr("INTERVAL 9 DAYS"))
    newest, tenth = days.first()
    master = VersionedTable(spark, fresh_path(spark, "master"), period="week")
    tenth_day = (F.col("station_id") == "click") & (F.date_trunc("day", "ts") == F.lit(tenth))
    late = F.col("ts") >= F.lit(newest)
    # the last batch brings all hours of the station again, most of them unchanged
    changed_co = F.when(tenth_day, F.col("co") * 3).otherwise(F.col("co"))
    again = rows.where("station_id = 'click'").withColumns({"co": changed_co, "pm2_5": F.when(late, F.col("pm2_5") + 5).otherwise(F.col("pm2_5"))})
    for batch in (rows, rows.where(late).withColumn("pm2_5", F.col("pm2_5") + 5), again):
        master.upsert(batch)
        after(master)
    return master


def followed(spark, sf, refresh):
    """The derived table after each of the three versions was followed by a refresh."""
    derived = VersionedTable(spark, fresh_path(spark, "derived"), period="week")
    corrected_master(spark, sf, lambda master: refresh(master, derived))
    return derived.read()


def _reached(flag, back):
    return f"bool_or({flag}) OVER (PARTITION BY station_id ORDER BY ts ROWS BETWEEN {back} PRECEDING AND CURRENT ROW)"


SUBS = [f"{p}_aqi" for p in fixed.DOMINANCE_ORDER]


@query(
    "incremental_index",
    using(
        "indexed",
        f"""SELECT station_id, ts, {rounded([*SUBS, 'numerical_aqi'])}, primary_pollutant,
        CASE WHEN {_reached('tenth', index_plan.REACH)} THEN 3 WHEN {_reached('newest', index_plan.REACH)} THEN 2 ELSE 1 END AS written_in
        FROM indexed""",
        instead={"dense": CORRECTED},
    ),
)
def _(spark, sf):
    """Equal to the index of the final master; only hours within reach of a change were written again."""
    out = followed(spark, sf, incremental.refresh_index)
    return out.select(*KEY, *SUBS, "numerical_aqi", "primary_pollutant", F.col("batch_seq").alias("written_in"))


FOLLOWED_FEATURES = {
    "pm2_5_72h_mean": f"avg(pm2_5) OVER {frame(72)}",
    "co_24h_std": f"stddev_samp(co) OVER {frame(24)}",
    "pm2_5_lag_48h": "lag(pm2_5, 48) OVER " + BY,
    "co_12h_trend": trend("co", 12),
    "wind_speed_18h_max": f"max(wind_speed) OVER {frame(18)}",
}


@query(
    "incremental_features",
    using(
        "dense",
        "SELECT station_id, ts, " + ", ".join(f"{r(e)} AS {n}" for n, e in FOLLOWED_FEATURES.items())
        + f", CASE WHEN {_reached('tenth', features.REACH)} THEN 3 WHEN {_reached('newest', features.REACH)} THEN 2 ELSE 1 END AS written_in FROM placed",
        instead={"dense": CORRECTED},
        placed=PLACED.format("dense"),
    ),
)
def _(spark, sf):
    out = followed(spark, sf, lambda master, derived: incremental.refresh_features(master, derived, set(FOLLOWED_FEATURES)))
    return out.select(*KEY, *FOLLOWED_FEATURES, F.col("batch_seq").alias("written_in"))


@query(
    "build_master",
    using(
        ["pollution", "weather"],
        f"""SELECT station_id, ts, {rounded(['pm2_5', 'pm10', 'temperature', 'relative_humidity'])}, hour(ts)::INTEGER AS hour,
        (isodow(ts) - 1)::INTEGER AS day_of_week, (isodow(ts) >= 6)::INTEGER AS is_weekend,
        {r('sin(2 * pi() * weekofyear(ts) / 52)')} AS week_sin, 0 AS coco
        FROM pollution JOIN weather USING (station_id, ts)""",
    ),
)
def _(spark, sf):
    from hourloom.plans import master

    pollution = frames.pollution_source(spark, sf).withColumn("batch_seq", F.lit(1))
    weather = frames.weather_source(spark, sf).withColumn("batch_seq", F.lit(1))
    out = master.build_master(pollution, weather)
    return out.select(*KEY, "pm2_5", "pm10", "temperature", "relative_humidity", "hour", "day_of_week", "is_weekend", "week_sin", "coco")
