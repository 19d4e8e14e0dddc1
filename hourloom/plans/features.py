"""PL3: the forecasting features, and which of them reach how far back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions import air, clock, fixed
from hourloom.operators import guards, layout, running

REACH = 72


def row_features(df: DataFrame, ts: str = layout.TIME) -> dict[str, Column]:
    """Features of a single row: calendar, cycles, flags, interactions."""
    t, have = F.col(ts), set(df.columns)
    out = {
        **clock.calendar_fields(t),
        **clock.cyclic_fields(t),
        **clock.season_flags(t),
        **clock.day_flags(t),
        **clock.seasonal_factors(t),
        **clock.weekend_ahead(t),
    }
    if {"temperature", "relative_humidity"} <= have:
        out["heat_index"] = air.heat_index(F.col("temperature"), F.col("relative_humidity"))
    if {"wind_speed", "wind_direction"} <= have:
        out["wind_east"] = air.wind_east(F.col("wind_speed"), F.col("wind_direction"))
        out["wind_north"] = air.wind_north(F.col("wind_speed"), F.col("wind_direction"))
    if {"pm2_5", "pm10"} <= have:
        out["pm_ratio"] = air.safe_ratio(F.col("pm2_5"), F.col("pm10"))
    if {"co", "no2"} <= have:
        out["co_no2_ratio"] = air.safe_ratio(F.col("co"), F.col("no2"))
    return out


WEATHER = {
    "temperature": ("temp", ("mean", "trend")),
    "relative_humidity": ("humidity", ("mean",)),
    "pressure": ("pressure", ("mean", "trend")),
    "wind_speed": ("wind_speed", ("mean", "max")),
}
POLLUTANT_STATS = ("mean", "std", "trend")


def window_feature_specs(columns: list[str], only=None) -> dict[str, running.Spec]:
    """Feature name -> (kind, source column, rows) for the columns present: the 338 lag, rolling, trend, change and
    momentum features, or those named in ``only``."""
    out: dict[str, running.Spec] = {}
    for p in [c for c in fixed.MODELLED if c in columns]:
        out |= {f"{p}_lag_{k}h": ("lag", p, k) for k in fixed.LAGS}
        out |= {f"{p}_{n}h_{kind}": (kind, p, n) for n in fixed.WINDOWS for kind in POLLUTANT_STATS}
        out |= {f"{p}_change_{k}h": ("change", p, k) for k in fixed.CHANGES}
        out |= {f"{p}_momentum_{k}h": ("change", p, k) for k in fixed.MOMENTA}
    for column, (prefix, kinds) in WEATHER.items():
        if column in columns:
            out |= {f"{prefix}_{n}h_{kind}": (kind, column, n) for n in fixed.WINDOWS for kind in kinds}
    return {name: spec for name, spec in out.items() if only is None or name in only}


def build_features(
    df: DataFrame, keys=layout.KEYS, ts=layout.TIME, keep_position=False, cell_seconds: int = layout.CELL_SECONDS, only=None
) -> DataFrame:
    """All features in one pass over the block layout: one exchange, one sort. ``only`` names the window features to
    build when not all of them are wanted."""
    clean = guards.drop_leakage(df)
    blocks = layout.in_blocks(clean.withColumns(row_features(clean, ts)), REACH, 0, keys, ts, cell_seconds=cell_seconds)
    out = blocks.native(running.with_windows(blocks.df, blocks.window, window_feature_specs(clean.columns, only)))
    return out if keep_position else out.drop(layout.POS, layout.LEN)
