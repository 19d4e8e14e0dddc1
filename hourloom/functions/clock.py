"""Time expressions: hours, calendar, cycles, seasons, parsing, labels."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions import fixed


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def calendar_fields(ts: Column) -> dict[str, Column]:
    """Monday is day 0; weeks are ISO weeks."""
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "month": F.month(ts),
        "day_of_week": F.weekday(ts),
        "day_of_year": F.dayofyear(ts),
        "week_of_year": F.weekofyear(ts),
    }


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def cyclic_fields(ts: Column, weeks: bool = False) -> dict[str, Column]:
    cycles = {"hour": (F.hour(ts), 24), "month": (F.month(ts), 12), "day_of_year": (F.dayofyear(ts), 365)}
    if weeks:
        cycles["week"] = (F.weekofyear(ts), 52)
    out = {}
    for name, (value, period) in cycles.items():
        out[f"{name}_sin"], out[f"{name}_cos"] = cyclic(value, period)
    return out


def _flag(test: Column) -> Column:
    return test.cast("int")


def season_flags(ts: Column) -> dict[str, Column]:
    month = F.month(ts)
    return {
        "is_summer": _flag(month.isin(6, 7, 8)),
        "is_monsoon": _flag(month.isin(7, 8, 9)),
        "is_winter": _flag(month.isin(12, 1, 2)),
        "is_spring": _flag(month.isin(3, 4, 5)),
    }


def day_flags(ts: Column) -> dict[str, Column]:
    dow = F.weekday(ts)
    return {
        "is_weekend": _flag(dow.isin(5, 6)),
        "is_monday": _flag(dow == 0),
        "is_friday": _flag(dow == 4),
    }


def weekend_ahead(ts: Column) -> dict[str, Column]:
    """Weekend pattern per horizon; the 48 h and 72 h flags shift by one and two days."""
    dow = F.weekday(ts)
    return {
        f"weekend_{h}h": _flag(F.pmod(dow + F.lit(shift), F.lit(7)).isin(5, 6))
        for shift, h in enumerate(fixed.HORIZONS)
    }


def seasonal_factors(ts: Column) -> dict[str, Column]:
    year_wave = cyclic(F.dayofyear(ts), 365)[0]
    return {
        f"seasonal_{h}h_factor": year_wave * cyclic(F.hour(ts), period)[1]
        for h, period in zip(fixed.HORIZONS, (24, 12, 8))
    }


def epoch_to_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def parse_iso(text: Column) -> Column:
    """Drop a UTC suffix and parse; text that is no time gives NULL."""
    bare = F.regexp_replace(text, r"(Z|\+00:00)", "")
    return F.try_to_timestamp(bare)


def season_name(ts: Column) -> Column:
    month = F.month(ts)
    return F.coalesce(
        *[F.when(month.isin(*months), F.lit(name)) for name, months in fixed.SEASON_MONTHS.items()]
    )


def labels(ts: Column) -> dict[str, Column]:
    return {
        "day_name": F.date_format(ts, "EEEE"),
        "month_label": F.date_format(ts, "MMM"),
        "date_text": F.substring(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), 1, 10),
    }


def hours_later(ts: Column, hours: int) -> Column:
    return ts + F.expr(f"INTERVAL {int(hours)} HOURS")


def explode_horizons(df: DataFrame, ts: str = "ts", horizons=fixed.HORIZONS) -> DataFrame:
    """One row per horizon with ``horizon`` and ``target_timestamp``."""
    out = df.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
    return out.withColumn(
        "target_timestamp", F.timestamp_seconds(F.unix_timestamp(ts) + F.col("horizon") * 3600)
    )
