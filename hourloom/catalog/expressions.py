"""Queries of the column expressions: index arithmetic, calendar, strings, cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.catalog.base import query
from hourloom.catalog.sql import FRAMES, cut, double, lookup, r, rounded, using
from hourloom.functions import air, clock, fixed
from hourloom.operators import fill, guards, joins, stats
from hourloom.plans import index as index_plan
from hourloom.plans import training
from hourloom.sources import frames

KEY = ["station_id", "ts"]
FRACTIONS = ["pm2_5_24h_avg", "pm10_24h_avg", "o3_8h_avg", "co_8h_avg", "so2_1h_avg", "no2_1h_avg"]


@query("convert_units", using("converted", f"SELECT station_id, ts, {rounded(['o3_ppb', 'no2_ppb', 'so2_ppb', 'co_ppm'])} FROM converted"))
def _(spark, sf):
    return air.convert_units(frames.dense_hourly(spark, sf)).select(*KEY, "o3_ppb", "no2_ppb", "so2_ppb", "co_ppm")


@query(
    "epa_truncate",
    using(
        "readings",
        f"SELECT event_id, {cut('(value - 5)', 'pm2_5')} AS tenths, {cut('(value - 5)', 'pm10')} AS whole FROM readings",
    ),
)
def _(spark, sf):
    c = F.col("value") - 5
    return frames.readings(spark, sf).select(
        "event_id",
        air.truncate_concentration(c, "pm2_5").alias("tenths"),
        air.truncate_concentration(c, "pm10").alias("whole"),
    )


TABLES = {"pm2_5": "pm2_5", "pm10": "pm10", "o3_8h": "o3", "o3_1h": "o3", "co": "co", "so2": "so2", "no2": "no2"}
SCALED = "SELECT event_id, value * 3 - 5 AS c FROM readings"


def _cut_columns():
    return ", ".join(f"{cut('c', p)} AS c_{t}" for t, p in TABLES.items())


def _lookup_columns():
    return ", ".join(f"{lookup(f'c_{t}', t)} AS {t}_index" for t in TABLES)


@query(
    "breakpoint_index",
    using(
        ["readings", "segments"],
        f"SELECT event_id, {_lookup_columns()} FROM truncated",
        scaled=SCALED,
        truncated=f"SELECT event_id, {_cut_columns()} FROM scaled",
    ),
)
def _(spark, sf):
    c = F.col("value") * 3 - 5
    return frames.readings(spark, sf).select(
        "event_id",
        *[air.breakpoint_index(air.truncate_concentration(c, p), t).alias(f"{t}_index") for t, p in TABLES.items()],
    )


@query(
    "breakpoint_range_join",
    using(
        ["readings", "segments"],
        f"SELECT event_id, {lookup('c_pm2_5', 'pm2_5')} AS index FROM truncated",
        scaled=SCALED,
        truncated=f"SELECT event_id, {_cut_columns()} FROM scaled",
    ),
)
def _(spark, sf):
    cutoff = air.truncate_concentration(F.col("value") * 3 - 5, "pm2_5")
    rows = frames.readings(spark, sf).select("event_id", cutoff.alias("c"))
    return joins.breakpoint_join(rows, "c", "pm2_5").select("event_id", "index")


@query(
    "o3_select",
    using(
        ["readings", "segments"],
        "SELECT event_id, CASE WHEN c_o3_1h >= 125 AND i1 > i8 THEN i1 ELSE i8 END AS o3_index FROM both_tables",
        scaled=SCALED,
        truncated=f"SELECT event_id, {cut('c', 'o3')} AS c_o3_1h, {cut('(c / 2)', 'o3')} AS c_o3_8h FROM scaled",
        both_tables=f"SELECT *, {lookup('c_o3_1h', 'o3_1h')} AS i1, {lookup('c_o3_8h', 'o3_8h')} AS i8 FROM truncated",
    ),
)
def _(spark, sf):
    c = F.col("value") * 3 - 5
    hourly, eight = air.truncate_concentration(c, "o3"), air.truncate_concentration(c / 2, "o3")
    chosen = air.select_ozone(
        hourly, air.breakpoint_index(hourly, "o3_1h"), air.breakpoint_index(eight, "o3_8h")
    )
    return frames.readings(spark, sf).select("event_id", chosen.alias("o3_index"))


@query("overall_index", using("indexed", "SELECT station_id, ts, numerical_aqi FROM indexed"))
def _(spark, sf):
    return frames.indexed(spark, sf).select(*KEY, "numerical_aqi")


@query("primary_pollutant", using("indexed", "SELECT station_id, ts, primary_pollutant FROM indexed"))
def _(spark, sf):
    return frames.indexed(spark, sf).select(*KEY, "primary_pollutant")


def _line(c, knots):
    pieces = list(zip(knots, knots[1:]))
    text = "CASE"
    for i, ((x0, y0), (x1, y1)) in enumerate(pieces):
        line = f"{double(y0)} + {double(y1 - y0)} * (({c} - {double(x0)}) / {double(x1 - x0)})"
        text += f" ELSE {line} END" if i == len(pieces) - 1 else f" WHEN {c} <= {double(x1)} THEN {line}"
    return text


REGIONAL = (
    f"CASE WHEN pm2_5 IS NULL OR pm10 IS NULL THEN 120.0::DOUBLE ELSE greatest(90.0::DOUBLE, least(155.0::DOUBLE, "
    f"0.7::DOUBLE * ({_line('pm2_5', fixed.REGIONAL_PM25)}) + 0.3::DOUBLE * ({_line('pm10', fixed.REGIONAL_PM10)}))) END"
)


@query("regional_index", using("sparse", f"SELECT station_id, ts, {r(REGIONAL)} AS regional_index FROM sparse"))
def _(spark, sf):
    return frames.sparse_hourly(spark, sf).select(
        *KEY, air.regional_index(F.col("pm2_5"), F.col("pm10")).alias("regional_index")
    )


@query(
    "index_category",
    using(
        "readings",
        """SELECT event_id, CASE WHEN raw IS NULL THEN 'Unknown' WHEN v IS NULL THEN 'Invalid' WHEN v <= 100 THEN 'Good'
        WHEN v <= 120 THEN 'Moderate' WHEN v <= 140 THEN 'Unhealthy for Sensitive Groups'
        WHEN v <= 155 THEN 'Unhealthy' ELSE 'Very Unhealthy' END AS category FROM parsed""",
        raws="""SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN 'n/a'
        ELSE CAST(k * 2 AS VARCHAR) END AS raw FROM readings""",
        parsed="SELECT *, try_cast(raw AS DOUBLE) AS v FROM raws",
    ),
)
def _(spark, sf):
    return _raw_index(spark, sf).select("event_id", air.index_category(F.col("raw")).alias("category"))


@query(
    "index_color",
    using(
        "readings",
        """SELECT event_id, CASE WHEN v IS NULL THEN '#808080' WHEN v <= 100 THEN '#00E400' WHEN v <= 120 THEN '#FFA500'
        WHEN v <= 140 THEN '#FF7E00' WHEN v <= 155 THEN '#FF0000' ELSE '#8B0000' END AS color FROM parsed""",
        raws="""SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN 'n/a'
        ELSE CAST(k * 2 AS VARCHAR) END AS raw FROM readings""",
        parsed="SELECT *, try_cast(raw AS DOUBLE) AS v FROM raws",
    ),
)
def _(spark, sf):
    return _raw_index(spark, sf).select("event_id", air.index_color(F.col("raw")).alias("color"))


def _raw_index(spark, sf):
    """Index values as text: numbers, missing ones and one that is no number."""
    kind = F.col("event_type")
    raw = F.when(kind == "signup", F.lit("n/a")).when(kind != "error", (F.col("k") * 2).cast("string"))
    return frames.readings(spark, sf).select("event_id", raw.alias("raw"))


BINS = "CASE " + " ".join(
    f"WHEN value > {double(lo)} AND value <= {double(hi)} THEN '{label}'"
    for lo, hi, label in zip(fixed.PM25_BIN_EDGES, fixed.PM25_BIN_EDGES[1:], fixed.PM25_BIN_LABELS)
) + " END"


@query("cut_bins", using("readings", f"SELECT event_id, {BINS} AS bin FROM readings"))
def _(spark, sf):
    return frames.readings(spark, sf).select("event_id", air.cut_bins(F.col("value")).alias("bin"))


@query(
    "season_name",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter'
    WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer'
    ELSE 'Fall' END AS season FROM orders""",
)
def _(spark, sf):
    return frames.table(spark, sf, "orders").select("o_orderkey", clock.season_name(F.col("o_orderdate")).alias("season"))


SURVIVING = ["station_id", "ts", *frames.DENSE_COLUMNS, "o3_ppb", "no2_ppb", "so2_ppb", "co_ppm", "numerical_aqi"]
SURVIVING += [f"{p}_aqi" for p in fixed.DOMINANCE_ORDER]


@query(
    "drop_leakage_columns",
    using(
        "indexed",
        " UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS n FROM indexed" for c in SURVIVING),
    ),
)
def _(spark, sf):
    """The columns that are left of the index table, which is full of leakage columns, and their values."""
    indexed = frames.indexed(spark, sf)
    planted = indexed.withColumns({c: F.col("numerical_aqi") for c in fixed.LEAKAGE_COLUMNS if c not in indexed.columns})
    kept = guards.drop_leakage(planted)
    counts = F.array(*[F.struct(F.lit(c).alias("name"), F.count(c).alias("n")) for c in kept.columns])
    return kept.agg(counts.alias("rows")).select(F.inline("rows"))


@query("exclude_columns", using("dense", f"SELECT {rounded([c for c in frames.DENSE_COLUMNS if c != 'pressure'])} FROM dense"))
def _(spark, sf):
    df = frames.dense_hourly(spark, sf)
    return df.select(*guards.all_but(df, [*KEY, "pressure"]))


@query(
    "numeric_columns_only",
    "SELECT o_orderkey, o_custkey, " + r("o_totalprice") + " AS o_totalprice FROM orders",
)
def _(spark, sf):
    df = frames.table(spark, sf, "orders")
    return df.select(*guards.numeric_columns(df))


@query(
    "align_to_schema",
    using("dense", f"SELECT {rounded(['pressure', 'co'])}, 0.0::DOUBLE AS nh3, {r('pm10')} AS pm10 FROM dense"),
)
def _(spark, sf):
    return guards.align_to_schema(frames.dense_hourly(spark, sf), ["pressure", "co", "nh3", "pm10"])


@query(
    "target_timestamp",
    using(
        "dense",
        """SELECT station_id, ts, h AS horizon, ts + h * INTERVAL 1 HOUR AS target_timestamp,
        ts + INTERVAL 24 HOUR AS next_day FROM dense, (VALUES (24), (48), (72)) v(h)""",
    ),
)
def _(spark, sf):
    rows = frames.dense_hourly(spark, sf).select(*KEY, clock.hours_later(F.col("ts"), 24).alias("next_day"))
    return clock.explode_horizons(rows)


@query(
    "confidence_band_pct",
    using("readings", f"SELECT event_id, {r('value * 1.1::DOUBLE')} AS upper, {r('value * 0.9::DOUBLE')} AS lower FROM readings"),
)
def _(spark, sf):
    band = air.band_pct(F.col("value"))
    return frames.readings(spark, sf).select("event_id", *[e.alias(n) for n, e in band.items()])


@query(
    "confidence_band_abs",
    using(
        "readings",
        f"SELECT event_id, {r('value + coalesce(c, 0.5::DOUBLE) * 10')} AS upper, "
        f"{r('value - coalesce(c, 0.5::DOUBLE) * 10')} AS lower FROM given",
        given="SELECT event_id, value, CASE WHEN event_type <> 'error' THEN k / 100.0::DOUBLE END AS c FROM readings",
    ),
)
def _(spark, sf):
    confidence = F.when(F.col("event_type") != "error", F.col("k") / F.lit(100.0))
    band = air.band_abs(F.col("value"), confidence)
    return frames.readings(spark, sf).select("event_id", *[e.alias(n) for n, e in band.items()])


@query(
    "final_table_assembly",
    using(
        "dense",
        f"""SELECT d.station_id, d.ts, d.o3 AS target_aqi_24h, d.co AS target_aqi_48h, d.no2 AS target_aqi_72h,
        'unknown' AS primary_pollutant, d.ts + INTERVAL 24 HOUR AS target_timestamp,
        {r('(pm2_5 - s.m1) / s.s1')} AS pm2_5, {r('(pressure - s.m2) / s.s2')} AS pressure
        FROM dense d, fit s""",
        fit="""SELECT avg(pm2_5) AS m1, stddev_pop(pm2_5) AS s1, avg(pressure) AS m2, stddev_pop(pressure) AS s2
        FROM dense""",
    ).replace("d.o3 AS", r("d.o3") + " AS").replace("d.co AS", r("d.co") + " AS").replace("d.no2 AS", r("d.no2") + " AS"),
)
def _(spark, sf):
    df = frames.dense_hourly(spark, sf).select(
        *KEY,
        F.col("o3").alias("target_aqi_24h"),
        F.col("co").alias("target_aqi_48h"),
        F.col("no2").alias("target_aqi_72h"),
        "pm2_5",
        "pressure",
    )
    return training.final_table(df, ["pm2_5", "pressure"])


@query("blend_apply", using("dense", f"SELECT station_id, ts, {r('0.5 * pm2_5 + 0.3 * pm10 + 0.2 * o3 + 1.5')} AS blended FROM dense"))
def _(spark, sf):
    expression = air.blend({"pm2_5": 0.5, "pm10": 0.3, "o3": 0.2}, 1.5)
    return frames.dense_hourly(spark, sf).select(*KEY, expression.alias("blended"))


# --- time, strings, fills -------------------------------------------------------------


@query("floor_hour", "SELECT event_id, date_trunc('hour', ts) AS hour FROM events")
def _(spark, sf):
    return frames.readings(spark, sf).select("event_id", clock.floor_hour(F.col("ts")).alias("hour"))


CALENDAR = """hour({t})::INTEGER AS hour, day({t})::INTEGER AS day, month({t})::INTEGER AS month,
  (isodow({t}) - 1)::INTEGER AS day_of_week, dayofyear({t})::INTEGER AS day_of_year,
  weekofyear({t})::INTEGER AS week_of_year"""


@query("calendar_fields", f"SELECT o_orderkey, {CALENDAR.format(t='o_orderdate')} FROM orders")
def _(spark, sf):
    orders = frames.table(spark, sf, "orders")
    return orders.select("o_orderkey", *[e.alias(n) for n, e in clock.calendar_fields(F.col("o_orderdate")).items()])


def _wave(value, period):
    return f"2 * pi() * {value} / {double(period)}"


CYCLES = {"hour": ("hour(ts)", 24), "month": ("month(ts)", 12), "day_of_year": ("dayofyear(ts)", 365), "week": ("weekofyear(ts)", 52)}
CYCLE_SQL = ", ".join(
    f"{r(f'{fn}({_wave(v, p)})')} AS {n}_{fn}" for n, (v, p) in CYCLES.items() for fn in ("sin", "cos")
)


@query("cyclic_encode", f"SELECT event_id, {CYCLE_SQL} FROM events")
def _(spark, sf):
    fields = clock.cyclic_fields(F.col("ts"), weeks=True)
    return frames.readings(spark, sf).select("event_id", *[e.alias(n) for n, e in fields.items()])


@query(
    "season_flags",
    """SELECT o_orderkey, (month(o_orderdate) IN (6, 7, 8))::INTEGER AS is_summer,
    (month(o_orderdate) IN (7, 8, 9))::INTEGER AS is_monsoon, (month(o_orderdate) IN (12, 1, 2))::INTEGER AS is_winter,
    (month(o_orderdate) IN (3, 4, 5))::INTEGER AS is_spring FROM orders""",
)
def _(spark, sf):
    orders = frames.table(spark, sf, "orders")
    return orders.select("o_orderkey", *[e.alias(n) for n, e in clock.season_flags(F.col("o_orderdate")).items()])


@query(
    "day_flags",
    """SELECT o_orderkey, (d IN (5, 6))::INTEGER AS is_weekend, (d = 0)::INTEGER AS is_monday, (d = 4)::INTEGER AS is_friday,
    (d IN (5, 6))::INTEGER AS weekend_24h, ((d + 1) % 7 IN (5, 6))::INTEGER AS weekend_48h,
    ((d + 2) % 7 IN (5, 6))::INTEGER AS weekend_72h FROM (SELECT o_orderkey, isodow(o_orderdate) - 1 AS d FROM orders)""",
)
def _(spark, sf):
    t = F.col("o_orderdate")
    fields = {**clock.day_flags(t), **clock.weekend_ahead(t)}
    return frames.table(spark, sf, "orders").select("o_orderkey", *[e.alias(n) for n, e in fields.items()])


FACTORS = ", ".join(
    f"{r(f'sin({_wave('dayofyear(ts)', 365)}) * cos({_wave('hour(ts)', p)})')} AS seasonal_{h}h_factor"
    for h, p in ((24, 24), (48, 12), (72, 8))
)


@query("seasonal_factors", f"SELECT event_id, {FACTORS} FROM events")
def _(spark, sf):
    return frames.readings(spark, sf).select(
        "event_id", *[e.alias(n) for n, e in clock.seasonal_factors(F.col("ts")).items()]
    )


@query("heat_index", using("dense", f"SELECT station_id, ts, {r('temperature * (1 + 0.01::DOUBLE * relative_humidity)')} AS heat_index FROM dense"))
def _(spark, sf):
    value = air.heat_index(F.col("temperature"), F.col("relative_humidity"))
    return frames.dense_hourly(spark, sf).select(*KEY, value.alias("heat_index"))


@query(
    "wind_components",
    using(
        "dense",
        f"SELECT station_id, ts, {r('wind_speed * cos(radians(wind_direction))')} AS wind_east, "
        f"{r('wind_speed * sin(radians(wind_direction))')} AS wind_north FROM dense",
    ),
)
def _(spark, sf):
    speed, direction = F.col("wind_speed"), F.col("wind_direction")
    return frames.dense_hourly(spark, sf).select(
        *KEY, air.wind_east(speed, direction).alias("wind_east"), air.wind_north(speed, direction).alias("wind_north")
    )


@query(
    "safe_ratios",
    using(
        "dense",
        f"SELECT station_id, ts, {r('pm2_5 / (pm10 + 1e-6)')} AS pm_ratio, "
        f"CASE WHEN no2 = 0 THEN NULL ELSE {r('co / (no2 + 1e-6)')} END AS co_no2_ratio FROM dense",
    ),
)
def _(spark, sf):
    rows = frames.dense_hourly(spark, sf)
    ratio = air.safe_ratio(F.col("co"), F.col("no2"))
    # over a zero denominator only the offset is left; such ratios are not compared at 6 decimals
    return rows.select(
        *KEY,
        air.safe_ratio(F.col("pm2_5"), F.col("pm10")).alias("pm_ratio"),
        F.when(F.col("no2") != 0, ratio).alias("co_no2_ratio"),
    )


@query("epoch_to_ts", "SELECT event_id, make_timestamp(epoch(date_trunc('second', ts))::BIGINT * 1000000) AS at FROM events")
def _(spark, sf):
    seconds = frames.readings(spark, sf).select("event_id", F.unix_timestamp("ts").alias("dt"))
    return seconds.select("event_id", clock.epoch_to_ts(F.col("dt")).alias("at"))


@query(
    "parse_iso_ts",
    "SELECT event_id, date_trunc('second', ts) AS at FROM events WHERE event_type <> 'error'",
)
def _(spark, sf):
    """Texts with a Z, with an offset and with no suffix; error rows carry no time and drop out."""
    body = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(F.col("event_type") == "error", F.lit("not a time"))
        .when(F.col("event_type") == "view", F.concat(body, F.lit("Z")))
        .when(F.col("event_type") == "click", F.concat(body, F.lit("+00:00")))
        .otherwise(body)
    )
    parsed = frames.readings(spark, sf).select("event_id", clock.parse_iso(text).alias("at"))
    return parsed.where("at IS NOT NULL")


@query(
    "name_predicates",
    """SELECT o_orderkey, replace(o_orderpriority || '_aqi', '_aqi', '') AS stripped,
    contains(lower(o_orderpriority), 'high') AS is_high, starts_with(o_orderpriority, '1') AS is_first FROM orders""",
)
def _(spark, sf):
    name = F.col("o_orderpriority")
    return frames.table(spark, sf, "orders").select(
        "o_orderkey",
        F.regexp_replace(F.concat(name, F.lit("_aqi")), "_aqi", "").alias("stripped"),
        F.lower(name).contains("high").alias("is_high"),
        name.startswith("1").alias("is_first"),
    )


@query(
    "labels",
    """SELECT o_orderkey, dayname(o_orderdate) AS day_name, strftime(o_orderdate, '%b') AS month_label,
    strftime(o_orderdate, '%Y-%m-%d') AS date_text, upper(o_orderstatus) AS upper_text,
    upper(substr(o_orderpriority, 1, 0)) || 'Order ' || o_orderstatus AS title_text FROM orders""",
)
def _(spark, sf):
    titled = F.initcap(F.concat(F.lit("order "), F.col("o_orderstatus")))
    return frames.table(spark, sf, "orders").select(
        "o_orderkey",
        *[e.alias(n) for n, e in clock.labels(F.col("o_orderdate")).items()],
        F.upper("o_orderstatus").alias("upper_text"),
        titled.alias("title_text"),
    )


@query("round_n", f"SELECT l_orderkey, l_linenumber, {r('round_even(l_extendedprice / 8 * 100, 0) / 100')} AS rounded FROM lineitem")
def _(spark, sf):
    return frames.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", air.round_half_even(F.col("l_extendedprice") / 8, 2).alias("rounded")
    )


@query(
    "fill_constant",
    using(
        "sparse",
        f"SELECT station_id, ts, {', '.join(f'coalesce({r(c)}, 0) AS {c}' for c in frames.SPARSE_COLUMNS)}, "
        "CASE WHEN pm2_5 > 0 THEN 'seen' ELSE 'unknown' END AS note FROM sparse",
    ),
)
def _(spark, sf):
    rows = frames.sparse_hourly(spark, sf).withColumn("note", F.when(F.col("pm2_5") > 0, F.lit("seen")))
    return fill.fill_constant(rows, skip=KEY)


@query(
    "fill_median",
    using(
        "sparse",
        f"SELECT s.station_id, s.ts, {r('coalesce(s.pm2_5, m.a)')} AS pm2_5, {r('coalesce(s.temperature, m.b)')} AS temperature "
        "FROM sparse s JOIN medians m ON s.station_id = m.station_id",
        medians="""SELECT station_id, quantile_cont(pm2_5, 0.5) AS a, quantile_cont(temperature, 0.5) AS b
        FROM sparse GROUP BY station_id""",
    ),
)
def _(spark, sf):
    rows = frames.sparse_hourly(spark, sf).select(*KEY, "pm2_5", "temperature")
    return stats.fill_median(rows, ["pm2_5", "temperature"], keys=["station_id"])


@query(
    "refill_derived",
    using(
        "sparse",
        f"SELECT station_id, ts, hour(ts)::INTEGER AS hour, (isodow(ts) - 1)::INTEGER AS day_of_week, "
        f"(isodow(ts) >= 6)::INTEGER AS is_weekend, {r('sin(2 * pi() * hour(ts) / 24)')} AS hour_sin, "
        f"{r('pm10 - pm2_5')} AS temperature_range FROM sparse",
    ),
)
def _(spark, sf):
    """Calendar columns that are NULL wherever pm2_5 is missing come back from the time."""
    seen = F.col("pm2_5").isNotNull()
    t = F.col("ts")
    rows = frames.sparse_hourly(spark, sf).select(
        *KEY,
        F.when(seen, F.hour(t)).alias("hour"),
        F.when(seen, F.weekday(t)).alias("day_of_week"),
        F.when(seen, F.weekday(t).isin(5, 6).cast("int")).alias("is_weekend"),
        F.when(seen, clock.cyclic(F.hour(t), 24)[0]).alias("hour_sin"),
        F.lit(None).cast("double").alias("temperature_range"),
        F.col("pm2_5").alias("tmin"),
        F.col("pm10").alias("tmax"),
    )
    return fill.refill_derived(rows).drop("tmin", "tmax")
