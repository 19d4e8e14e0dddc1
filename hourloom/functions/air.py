"""Concentrations to index values: pure column expressions, no Python per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions import fixed


def convert_units(df: DataFrame) -> DataFrame:
    """Add ``o3_ppb``, ``no2_ppb``, ``so2_ppb`` and ``co_ppm`` for the gases present."""
    added = {
        f"{gas}_ppb": F.col(gas) * F.lit(fixed.MOLAR_VOLUME) / F.lit(fixed.MOLAR_MASS[gas])
        for gas in ("o3", "no2", "so2")
        if gas in df.columns
    }
    if "co" in df.columns:
        grams = 1000.0 * fixed.MOLAR_MASS["co"]
        added["co_ppm"] = F.col("co") * F.lit(fixed.MOLAR_VOLUME) / F.lit(grams)
    return df.withColumns(added)


def truncate_concentration(c: Column, pollutant: str) -> Column:
    """Cut (not round) to the table's precision; negative or missing gives NULL."""
    whole = F.floor(c * 10) / F.lit(10.0) if pollutant in fixed.TENTHS else F.floor(c).cast("double")
    return F.when(c >= 0, whole)


def breakpoint_index(c: Column, table: str) -> Column:
    """Piecewise linear index of a truncated concentration.

    Inside a segment: interpolate and round half to even. Above the last segment 500,
    below the first 0, in a gap between segments NULL.
    """
    segments = fixed.BREAKPOINTS[table]
    inside = [
        F.when(
            c.between(F.lit(float(lo)), F.lit(float(hi))),
            F.rint(F.lit((top - base) / (hi - lo)) * (c - F.lit(float(lo))) + F.lit(float(base))),
        )
        for lo, hi, base, top in segments
    ]
    above = F.when(c > F.lit(float(segments[-1][1])), F.lit(500.0))
    below = F.when((c >= 0) & (c < F.lit(float(segments[0][0]))), F.lit(0.0))
    return F.coalesce(*inside, above, below)


def select_ozone(conc_1h: Column, index_1h: Column, index_8h: Column) -> Column:
    """The hourly ozone index counts only from 125 ppb on and when it is the higher one."""
    hourly_wins = (conc_1h >= fixed.OZONE_HOURLY_FLOOR) & (index_1h > index_8h)
    return F.when(hourly_wins, index_1h).otherwise(index_8h)


def dominant(sub_indices: dict[str, Column]) -> Column:
    """Struct (index, name) of the largest sub-index; missing ones are skipped.

    The first in dominance order wins a tie. Each sub-index enters once: a plan that filters
    on the result inlines it, and repeated sub-indices would outgrow generated code.
    """
    ordered = [p for p in fixed.DOMINANCE_ORDER if p in sub_indices]
    ranked = [
        F.struct(sub_indices[p].alias("index"), F.lit(-place).alias("place"), F.lit(p).alias("name"))
        for place, p in enumerate(ordered)
    ]
    return F.greatest(*ranked) if len(ranked) > 1 else ranked[0]


def overall_index(top: Column) -> Column:
    return top["index"]


def primary_pollutant(top: Column) -> Column:
    return F.when(top["index"].isNotNull(), top["name"])


def _piecewise(c: Column, knots: tuple) -> Column:
    """Linear between knots; the outer pieces run on beyond their ends."""
    pieces = list(zip(knots, knots[1:]))

    def line(piece):
        (x0, y0), (x1, y1) = piece
        return F.lit(y0) + F.lit(y1 - y0) * ((c - F.lit(x0)) / F.lit(x1 - x0))

    chain = F.when(c <= pieces[0][1][0], line(pieces[0]))
    for piece in pieces[1:-1]:
        chain = chain.when(c <= piece[1][0], line(piece))
    return chain.otherwise(line(pieces[-1]))


def regional_index(pm2_5: Column, pm10: Column) -> Column:
    """Blend of two piecewise lines, clamped; 120 where either input is missing."""
    fine, coarse = fixed.REGIONAL_WEIGHTS
    low, high = fixed.REGIONAL_RANGE
    blend = F.lit(fine) * _piecewise(pm2_5, fixed.REGIONAL_PM25) + F.lit(coarse) * _piecewise(
        pm10, fixed.REGIONAL_PM10
    )
    clamped = F.greatest(F.lit(low), F.least(F.lit(high), blend))
    return F.when(pm2_5.isNull() | pm10.isNull(), F.lit(fixed.REGIONAL_DEFAULT)).otherwise(clamped)


def _by_category(value: Column, pick: int, above: str) -> Column:
    cuts = fixed.CATEGORIES
    chain = F.when(value <= cuts[0][0], F.lit(cuts[0][pick]))
    for row in cuts[1:]:
        chain = chain.when(value <= row[0], F.lit(row[pick]))
    return chain.otherwise(F.lit(above))


def index_category(raw: Column) -> Column:
    """Category of a numeric or text index value; Unknown if missing, Invalid if not a number."""
    value = raw.try_cast("double")
    return (
        F.when(raw.isNull(), F.lit("Unknown"))
        .when(value.isNull(), F.lit("Invalid"))
        .otherwise(_by_category(value, 1, fixed.CATEGORY_ABOVE[0]))
    )


def index_color(raw: Column) -> Column:
    value = raw.try_cast("double")
    return F.when(value.isNull(), F.lit(fixed.COLOR_MISSING)).otherwise(
        _by_category(value, 2, fixed.CATEGORY_ABOVE[1])
    )


def cut_bins(c: Column, edges=fixed.PM25_BIN_EDGES, labels=fixed.PM25_BIN_LABELS) -> Column:
    """Right-closed bins ``(lo, hi]``; outside all bins NULL."""
    bins = [
        F.when((c > float(lo)) & (c <= float(hi)), F.lit(label))
        for lo, hi, label in zip(edges, edges[1:], labels)
    ]
    return F.coalesce(*bins)


def heat_index(temperature: Column, humidity: Column) -> Column:
    return temperature * (F.lit(1) + F.lit(0.01) * humidity)


def wind_east(speed: Column, direction: Column) -> Column:
    return speed * F.cos(F.radians(direction))


def wind_north(speed: Column, direction: Column) -> Column:
    return speed * F.sin(F.radians(direction))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Ratio with a small offset in the denominator; NULL, not an error, at zero."""
    return F.try_divide(top, bottom + F.lit(1e-6))


def clip(c: Column, low, high) -> Column:
    """Clamp to [low, high] and keep NULL as NULL (``greatest`` alone would not)."""
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return F.when(c.isNotNull(), F.greatest(low, F.least(high, c)))


def finite(c: Column) -> Column:
    """NaN and infinities become NULL."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def band_pct(c: Column, share: float = 0.1) -> dict[str, Column]:
    return {"upper": c * F.lit(1 + share), "lower": c * F.lit(1 - share)}


def band_abs(c: Column, confidence: Column, width: float = 10.0, default: float = 0.5) -> dict[str, Column]:
    half = F.coalesce(confidence, F.lit(default)) * F.lit(width)
    return {"upper": c + half, "lower": c - half}


def blend(predictions: dict[str, float], intercept: float) -> Column:
    """``sum(weight * prediction column) + intercept``."""
    terms = [F.lit(float(w)) * F.col(name) for name, w in predictions.items()]
    return reduce(lambda a, b: a + b, terms) + F.lit(float(intercept))


def round_half_even(c: Column, digits: int = 2) -> Column:
    """Scale, round half to even, scale back: the rounding of the report matrices."""
    scale = F.lit(float(10**digits))
    return F.rint(c * scale) / scale


def six_decimals(c: Column) -> Column:
    """Cut noise beyond six decimals.

    The cut lies a little off the half, so a value that is a half in decimal (common for
    means of priced values) does not flip with the order in which its sum was added up. It is
    taken on doubles, so large values stay, and NaN and infinities are shown as they are.
    """
    return F.rint(c.cast("double") * F.lit(1e6) + F.lit(1e-4)) / F.lit(1e6)
