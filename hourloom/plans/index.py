"""PL2: concentrations to the overall index and its dominant pollutant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from hourloom.functions import air, fixed
from hourloom.operators import layout, rolling

# averaged column: (source column, rows, least values); hourly ones are taken as they are
AVERAGES = {
    "pm2_5_24h_avg": ("pm2_5", 24, 18),
    "pm10_24h_avg": ("pm10", 24, 18),
    "o3_8h_avg": ("o3_ppb", 8, 6),
    "co_8h_avg": ("co_ppm", 8, 6),
}
HOURLY = {"o3_1h_avg": "o3_ppb", "no2_1h_avg": "no2_ppb", "so2_1h_avg": "so2_ppb"}
REACH = 23


def averages(columns: list[str], w: WindowSpec) -> dict[str, Column]:
    out = {
        name: rolling.rolling_mean_min(source, n, least, w)
        for name, (source, n, least) in AVERAGES.items()
        if source in columns
    }
    out.update({name: F.col(source) for name, source in HOURLY.items() if source in columns})
    return out


# truncated column: (averaged column, pollutant whose precision applies, breakpoint table)
CUTS = {
    "pm2_5": ("pm2_5_24h_avg", "pm2_5", "pm2_5"),
    "pm10": ("pm10_24h_avg", "pm10", "pm10"),
    "o3_8h": ("o3_8h_avg", "o3", "o3_8h"),
    "o3_1h": ("o3_1h_avg", "o3", "o3_1h"),
    "co": ("co_8h_avg", "co", "co"),
    "so2": ("so2_1h_avg", "so2", "so2"),
    "no2": ("no2_1h_avg", "no2", "no2"),
}


def add_index(averaged: DataFrame) -> DataFrame:
    """Sub-indices, overall index and dominant pollutant on a frame that has its averages."""
    used = {n: spec for n, spec in CUTS.items() if spec[0] in averaged.columns}
    cut = averaged.withColumns(
        {f"_c_{n}": air.truncate_concentration(F.col(avg), p) for n, (avg, p, _) in used.items()}
    )
    indices = {n: air.breakpoint_index(F.col(f"_c_{n}"), t) for n, (_, _, t) in used.items()}
    sub = layout.computed_once(cut, {f"{n}_aqi": e for n, e in indices.items()})
    if "o3_8h" in used:
        sub = sub.withColumn("o3_aqi", air.select_ozone(F.col("_c_o3_1h"), F.col("o3_1h_aqi"), F.col("o3_8h_aqi")))
    top = air.dominant({p: F.col(f"{p}_aqi") for p in fixed.DOMINANCE_ORDER if f"{p}_aqi" in sub.columns})
    out = sub.withColumns({"numerical_aqi": air.overall_index(top), "primary_pollutant": air.primary_pollutant(top)})
    return out.drop("aqi_category", "o3_8h_aqi", "o3_1h_aqi", *[f"_c_{n}" for n in used])


def compute_index(df: DataFrame, keep_position: bool = False, keys=layout.KEYS, ts=layout.TIME) -> DataFrame:
    converted = air.convert_units(df)
    averaged = layout.over_series(
        converted,
        lambda w: averages(converted.columns, w),
        back=REACH,
        keys=keys,
        ts=ts,
        keep_position=keep_position,
    )
    return add_index(averaged)
