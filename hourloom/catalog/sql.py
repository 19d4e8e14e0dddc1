"""SQL fragments of the oracles: the same frames, written for a single-node SQL engine."""

from __future__ import annotations

from hourloom.functions import fixed


def r(expression: str) -> str:
    """Six decimals, cut a little off the half so that noise does not flip decimal halves."""
    return f"round_even(({expression})::DOUBLE * 1e6 + 0.0001::DOUBLE, 0) / 1e6"


def rounded(columns, prefix: str = "") -> str:
    return ", ".join(f"{r(prefix + c)} AS {c}" for c in columns)


def double(x) -> str:
    """A literal that is a DOUBLE, not a DECIMAL."""
    return f"{float(x)!r}::DOUBLE"


def _hourly(key: str) -> str:
    return f"""SELECT {key} AS station_id, hour AS ts,
      {r('avg(value)')} AS pm2_5, max(value) AS pm10, min(value) * 2 AS o3,
      {r('sum(value) * 60')} AS co, {r('avg(k) * 2')} AS no2, max(k)::DOUBLE AS so2,
      {r('avg(k) / 2')} AS temperature, least(100, count(*) * 5)::DOUBLE AS relative_humidity,
      min(value) AS wind_speed, (sum(k) * 7 % 360)::DOUBLE AS wind_direction,
      {r('1000 + avg(value) / 10')} AS pressure
    FROM readings GROUP BY ALL"""


def _segments() -> str:
    rows = [
        f"('{name}', {double(lo)}, {double(hi)}, {double(base)}, {double(top)})"
        for name, segments in fixed.BREAKPOINTS.items()
        for lo, hi, base, top in segments
    ]
    return f"SELECT * FROM (VALUES {', '.join(rows)}) v(pollutant, c_low, c_high, i_low, i_high)"


def cut(c: str, pollutant: str) -> str:
    whole = f"floor({c} * 10) / 10.0::DOUBLE" if pollutant in fixed.TENTHS else f"floor({c})"
    return f"CASE WHEN {c} >= 0 THEN {whole} END"


def lookup(c: str, table: str) -> str:
    """Index of an expression by a lookup in the segment table."""
    low, high = fixed.BREAKPOINTS[table][0][0], fixed.BREAKPOINTS[table][-1][1]
    return f"""CASE WHEN {c} IS NULL OR {c} < 0 THEN NULL
      WHEN {c} > {double(high)} THEN 500.0::DOUBLE WHEN {c} < {double(low)} THEN 0.0::DOUBLE
      ELSE (SELECT max(round_even((s.i_high - s.i_low) / (s.c_high - s.c_low) * ({c} - s.c_low) + s.i_low, 0))
            FROM segments s WHERE s.pollutant = '{table}' AND {c} BETWEEN s.c_low AND s.c_high) END"""


def frame(n: int, order: str = "ts") -> str:
    return f"(PARTITION BY station_id ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def mean_min(c: str, n: int, least: int) -> str:
    return f"CASE WHEN count({c}) OVER {frame(n)} >= {least} THEN round(avg({c}) OVER {frame(n)}, 9) END"


def trend(c: str, n: int, pos: str = "pos") -> str:
    w = frame(n)
    return (
        f"CASE WHEN count({c}) OVER {w} >= 2 AND count({c}) OVER {w} = count(*) OVER {w} "
        f"THEN regr_slope({c}, {pos}) OVER {w} END"
    )


_PPB = {
    g: f"{g} * {double(fixed.MOLAR_VOLUME)} / {double(fixed.MOLAR_MASS[g])}" for g in ("o3", "no2", "so2")
}
CONVERTED = ", ".join(f"{e} AS {g}_ppb" for g, e in _PPB.items()) + (
    f", co * {double(fixed.MOLAR_VOLUME)} / {double(1000.0 * fixed.MOLAR_MASS['co'])} AS co_ppm"
)

FRAMES = {
    "readings": """SELECT event_id, ts, date_trunc('hour', ts) AS hour, CAST(user_id AS VARCHAR) AS usr,
      event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "dense": _hourly("event_type"),
    "users": _hourly("usr"),
    "seen": f"""SELECT usr AS station_id, hour AS ts,
      {r("avg(value) FILTER (event_type = 'view')")} AS pm2_5,
      {r("avg(value) FILTER (event_type = 'click')")} AS pm10,
      {r("avg(value) FILTER (event_type = 'purchase')")} AS o3,
      {r("avg(value) FILTER (event_type = 'signup')")} AS no2,
      {r("avg(value) FILTER (event_type = 'error')")} AS temperature
      FROM readings GROUP BY ALL""",
    "grid": """SELECT station_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts
      FROM seen GROUP BY station_id""",
    "sparse": """SELECT g.station_id, g.ts, s.pm2_5, s.pm10, s.o3, s.no2, s.temperature
      FROM grid g LEFT JOIN seen s ON g.station_id = s.station_id AND g.ts = s.ts""",
    "segments": _segments(),
    "converted": f"SELECT *, {CONVERTED} FROM dense",
    "averaged": f"""SELECT *, {mean_min('pm2_5', 24, 18)} AS pm2_5_24h_avg,
      {mean_min('pm10', 24, 18)} AS pm10_24h_avg, {mean_min('o3_ppb', 8, 6)} AS o3_8h_avg,
      {mean_min('co_ppm', 8, 6)} AS co_8h_avg, o3_ppb AS o3_1h_avg, no2_ppb AS no2_1h_avg,
      so2_ppb AS so2_1h_avg FROM converted""",
    "cuts": f"""SELECT *, {cut('pm2_5_24h_avg', 'pm2_5')} AS c_pm2_5, {cut('pm10_24h_avg', 'pm10')} AS c_pm10,
      {cut('o3_8h_avg', 'o3')} AS c_o3_8h, {cut('o3_1h_avg', 'o3')} AS c_o3_1h, {cut('co_8h_avg', 'co')} AS c_co,
      {cut('so2_1h_avg', 'so2')} AS c_so2, {cut('no2_1h_avg', 'no2')} AS c_no2 FROM averaged""",
    "sub": f"""SELECT *, {lookup('c_pm2_5', 'pm2_5')} AS pm2_5_aqi, {lookup('c_pm10', 'pm10')} AS pm10_aqi,
      {lookup('c_o3_8h', 'o3_8h')} AS i_o3_8h, {lookup('c_o3_1h', 'o3_1h')} AS i_o3_1h,
      {lookup('c_co', 'co')} AS co_aqi, {lookup('c_so2', 'so2')} AS so2_aqi,
      {lookup('c_no2', 'no2')} AS no2_aqi FROM cuts""",
    "chosen": """SELECT *, CASE WHEN c_o3_1h >= 125 AND i_o3_1h > i_o3_8h THEN i_o3_1h ELSE i_o3_8h END AS o3_aqi
      FROM sub""",
    "peak": """SELECT *, greatest(pm2_5_aqi, pm10_aqi, o3_aqi, co_aqi, so2_aqi, no2_aqi) AS numerical_aqi
      FROM chosen""",
    "indexed": """SELECT *, CASE WHEN pm2_5_aqi = numerical_aqi THEN 'pm2_5' WHEN pm10_aqi = numerical_aqi THEN 'pm10'
      WHEN o3_aqi = numerical_aqi THEN 'o3' WHEN co_aqi = numerical_aqi THEN 'co'
      WHEN so2_aqi = numerical_aqi THEN 'so2' WHEN no2_aqi = numerical_aqi THEN 'no2' END AS primary_pollutant
      FROM peak""",
    "numbered": """SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts) AS pos,
      count(*) OVER (PARTITION BY station_id) AS len FROM indexed""",
    "pollution": f"""SELECT usr AS station_id, hour AS ts, {r('avg(value)')} AS pm2_5, max(value) AS pm10
      FROM readings WHERE event_type IN ('view', 'click', 'purchase') GROUP BY ALL""",
    "weather": f"""SELECT usr AS station_id, hour AS ts, {r('avg(k)')} AS temperature,
      max(k)::DOUBLE AS relative_humidity
      FROM readings WHERE event_type IN ('purchase', 'signup', 'error') GROUP BY ALL""",
    "both_batches": """SELECT usr AS station_id, ts, event_id, value, NULL::INTEGER AS k, 1 AS batch_seq FROM readings
      UNION ALL SELECT usr, ts, event_id, value + 1, k, 2 FROM readings WHERE event_type = 'error'""",
    "daily_orders": f"""SELECT o_orderpriority AS station_id, o_orderdate AS ts, {r('avg(o_totalprice)')} AS price
      FROM orders GROUP BY ALL""",
    "aged": "SELECT *, "
    + ", ".join(
        f"lag(numerical_aqi, {k}) OVER (PARTITION BY station_id ORDER BY ts) AS l{k}" for k in (24, 48, 72, 96, 120)
    )
    + ", CASE WHEN pos <= floor(len * 0.6::DOUBLE) THEN 'train' WHEN pos <= floor(len * 0.6::DOUBLE) "
    "+ floor(len * 0.2::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM numbered",
    "predictions": " UNION ALL ".join(
        f"SELECT station_id, ts, split, numerical_aqi AS y, '{m}' AS model, {h} AS horizon, l{h + age} AS p FROM aged "
        f"WHERE numerical_aqi IS NOT NULL AND l{h + age} IS NOT NULL"
        for m, age in (("carry", 0), ("carry_day", 24), ("carry_two_days", 48))
        for h in (24, 48, 72)
    ),
    "scored": """SELECT model, horizon, split, count(*) AS n, sqrt(avg((y - p) * (y - p))) AS rmse,
      avg(abs(y - p)) AS mae,
      CASE WHEN var_pop(y) > 0 THEN 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END AS r2,
      avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) AS mape
      FROM predictions GROUP BY model, horizon, split""",
}

NEEDS = {
    "dense": ["readings"],
    "users": ["readings"],
    "seen": ["readings"],
    "grid": ["seen"],
    "sparse": ["grid"],
    "converted": ["dense"],
    "averaged": ["converted"],
    "cuts": ["averaged"],
    "sub": ["cuts", "segments"],
    "chosen": ["sub"],
    "peak": ["chosen"],
    "indexed": ["peak"],
    "numbered": ["indexed"],
    "pollution": ["readings"],
    "weather": ["readings"],
    "both_batches": ["readings"],
    "aged": ["numbered"],
    "predictions": ["aged"],
    "scored": ["predictions"],
}


def _ordered(names) -> list[str]:
    seen: list[str] = []

    def visit(name):
        for needed in NEEDS.get(name, []):
            visit(needed)
        if name not in seen:
            seen.append(name)

    for name in names:
        visit(name)
    return seen


def using(names, body: str, instead: dict[str, str] | None = None, **extra: str) -> str:
    """``body`` with the frames it names (and further ones given as keyword) in front. ``instead`` replaces frames;
    the replaced one is there as ``first_<name>``."""
    names = [names] if isinstance(names, str) else list(names)
    parts = []
    for n in _ordered(names):
        if instead and n in instead:
            parts.append(f"first_{n} AS MATERIALIZED ({FRAMES[n]})")
        parts.append(f"{n} AS MATERIALIZED ({(instead or {}).get(n, FRAMES[n])})")
    parts += [f"{n} AS ({e})" for n, e in extra.items()]
    return f"WITH {', '.join(parts)} {body}"
