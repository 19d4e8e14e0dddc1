"""PL6 in full: every section of the history page reduced from one table of mergeable cells.

A cell is (hour, dominant component, index value). It holds, for each measured column, the number of values, their sum
and sum of squares about a fixed reference, and extremes; for each pair of columns whose correlation is shown, the sums of
products; and counts of limits exceeded and of bins. All of these add up, so one pass over the rows, combined in the map
tasks, makes the cells, and every section is a small aggregate of them: profiles, deviations, box statistics,
correlations, ratios, exceedance, bins, smoothed trend, overview. The index is a whole number from 0 to 500, so cells are
bounded by the hours of the history and not by the number of stations, and quartiles of the index are exact.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions import air, clock, fixed
from hourloom.operators import layout, rolling, stats
from hourloom.operators import profiles as aggregates
from hourloom.operators.layout import TIME
from hourloom.session import cut_lineage

WEATHER = ("temperature", "relative_humidity", "wind_speed", "pressure")
#: Sums are taken about these values, so that a large offset costs no digits.
REFERENCE = {"pressure": 1000.0, "relative_humidity": 50.0}
RATIO = "pm_ratio"
LEAST_AN_HOUR = 5
SMOOTHED = (24, 168)

RESULT = "section string, label string, column string, n bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double, value double"


class Cells:
    """The cells of a frame, and how each of their columns is merged."""

    def __init__(self, df: DataFrame, index: str = "numerical_aqi", ts: str = TIME):
        self.index, self.ts = index, ts
        pollutants = [c for c in fixed.POLLUTANTS if c in df.columns]
        weather = [c for c in WEATHER if c in df.columns]
        self.measures = [index, *pollutants, *weather]
        self.pairs = [*combinations(pollutants, 2), *combinations([*weather, index], 2)]
        self.limits = [(p, who, limit) for p, who, limit in fixed.EXCEEDANCE_LIMITS if p in pollutants]
        self.merge = {"rows": F.sum, "missing": F.sum}
        parts = {"rows": F.count(F.lit(1)), "missing": sum([F.count_if(F.col(c).isNull()) for c in df.columns], F.lit(0))}
        values = {c: F.col(c).cast("double") for c in self.measures}
        if {"pm2_5", "pm10"} <= set(pollutants):
            both = (values["pm2_5"] > 0) & (values["pm10"] > 0)
            values[RATIO] = F.when(both, F.try_divide(values["pm2_5"], values["pm10"]))
            self.measures.append(RATIO)

        def add(name: str, part: Column, merge=F.sum) -> None:
            parts[name], self.merge[name] = part, merge

        about = {c: v - F.lit(REFERENCE.get(c, 0.0)) for c, v in values.items()}
        for c in self.measures:
            add(f"{c}__n", F.count(values[c]))
            add(f"{c}__s", F.sum(about[c]))
            add(f"{c}__q", F.sum(about[c] * about[c]))
            add(f"{c}__lo", F.min(values[c]), F.min)
            add(f"{c}__hi", F.max(values[c]), F.max)
        for a, b in self.pairs:
            x, y = (F.when(about[a].isNotNull() & about[b].isNotNull(), about[c]) for c in (a, b))
            for name, e in {"n": F.count(x), "x": F.sum(x), "y": F.sum(y), "xx": F.sum(x * x), "yy": F.sum(y * y), "xy": F.sum(x * y)}.items():
                add(f"{a}__{b}__{name}", e)
        for p, who, limit in self.limits:
            add(f"{p}__over_{who}", F.count_if(values[p] > limit))
        for p in {p for p, _, _ in self.limits}:
            add(f"{p}__valid", F.count_if(values[p] > 0))
        if "pm2_5" in pollutants:
            found = air.cut_bins(values["pm2_5"])
            for i, label in enumerate(fixed.PM25_BIN_LABELS):
                add(f"bin__{i}", F.count_if(found == label))
        self.n_columns = len(df.columns)
        hour = F.date_trunc("hour", F.col(ts)).alias("hour")
        cells = df.groupBy(hour, F.col("primary_pollutant").alias("component"), F.col(index).alias("index"))
        self.table = cut_lineage(cells.agg(*[e.alias(name) for name, e in parts.items()]), "cells")

    def merged(self, rows: DataFrame, *by) -> DataFrame:
        return rows.groupBy(*by).agg(*[merge(name).alias(name) for name, merge in self.merge.items()])

    def statistics(self, rows: DataFrame) -> DataFrame:
        """(section, label) sums to one row for each measured column."""
        told = []
        for c in self.measures:
            n, s, q = (F.col(f"{c}__{k}") for k in "nsq")
            spread = F.greatest(q - F.try_divide(s * s, n), F.lit(0.0))
            told.append(
                F.struct(
                    F.lit(c).alias("column"),
                    n.alias("n"),
                    (F.try_divide(s, n) + F.lit(REFERENCE.get(c, 0.0))).alias("mean"),
                    F.when(n > 1, F.sqrt(spread / (n - 1))).alias("std"),
                    F.col(f"{c}__lo").cast("double").alias("min"),
                    F.col(f"{c}__hi").cast("double").alias("max"),
                )
            )
        return rows.select("section", "label", F.inline(F.array(*told)))


def _filled(rows: DataFrame) -> DataFrame:
    """The result's columns; those that a section has not are NULL."""
    wanted = [part.split() for part in RESULT.split(", ")]
    have = set(rows.columns)
    return rows.select(*[(F.col(c) if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in wanted])


def profiles(cells: Cells) -> DataFrame:
    """Number, mean, deviation and range of every column by day, hour, month, weekday, season and component, and over all."""
    t = F.col("hour")
    labels = {
        "daily": F.date_format(t, "yyyy-MM-dd"),
        "hour": F.date_format(t, "HH"),
        "month": F.date_format(t, "MMM"),
        "weekday": F.date_format(t, "EEEE"),
        "season": clock.season_name(t),
        "component": F.coalesce("component", F.lit("unknown")),
        "all": F.lit("all"),
    }
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("section"), e.alias("label")) for name, e in labels.items()]))
    spread = cells.table.withColumn("_cell", each).select("_cell.*", *cells.merge)
    return cells.statistics(cells.merged(spread, "section", "label"))


def correlations(cells: Cells, whole: DataFrame) -> DataFrame:
    told = []
    for a, b in cells.pairs:
        n, x, y, xx, yy, xy = (F.col(f"{a}__{b}__{k}").cast("double") for k in ("n", "x", "y", "xx", "yy", "xy"))
        spread = F.sqrt(F.greatest(n * xx - x * x, F.lit(0.0))) * F.sqrt(F.greatest(n * yy - y * y, F.lit(0.0)))
        told.append(
            F.struct(
                F.lit("correlation").alias("section"), F.lit(b).alias("label"), F.lit(a).alias("column"),
                F.col(f"{a}__{b}__n").alias("n"), F.try_divide(n * xy - x * y, spread).alias("value"),
            )
        )
    return whole.select(F.inline(F.array(*told)))


def limits_and_bins(cells: Cells, whole: DataFrame) -> DataFrame:
    """Share of positive values above each limit, the counts of the bins, and the overview."""

    def row(section, label, column, n, value):
        return F.struct(
            F.lit(section).alias("section"), F.lit(label).alias("label"), F.lit(column).alias("column"),
            n.cast("bigint").alias("n"), value.cast("double").alias("value"),
        )

    none = F.lit(None)
    told = [
        row("exceedance", who, p, F.col(f"{p}__valid"), F.try_divide(F.col(f"{p}__over_{who}") * 100.0, F.col(f"{p}__valid").cast("double")))
        for p, who, _ in cells.limits
    ]
    if "bin__0" in cells.merge:
        told += [row("bin", label, "pm2_5", F.col(f"bin__{i}"), none) for i, label in enumerate(fixed.PM25_BIN_LABELS)]
    cellular = F.col("rows") * F.lit(float(cells.n_columns))
    told += [
        row("overview", "rows", "", F.col("rows"), none),
        row("overview", "columns", "", F.lit(cells.n_columns), none),
        row("overview", "missing", "", F.col("missing"), none),
        row("overview", "complete_pct", "", F.col("rows"), 100.0 * (F.lit(1.0) - F.try_divide(F.col("missing"), cellular))),
    ]
    return whole.select(F.inline(F.array(*told)))


def season_boxes(cells: Cells) -> DataFrame:
    """Quartiles, whisker ends (min, max) and the number of outliers (value) of the index in each season."""
    counts = cells.table.where(F.col("index").isNotNull()).groupBy(clock.season_name(F.col("hour")).alias("label"), F.col("index").alias("v"))
    counts = counts.agg(F.sum(f"{cells.index}__n").alias("c"))
    quarter = {name: F.percentile("v", F.lit(p), F.col("c")) for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))}
    box = counts.groupBy("label").agg(F.sum("c").alias("n"), *[e.alias(name) for name, e in quarter.items()])
    reach = F.lit(1.5) * (F.col("q75") - F.col("q25"))
    inside = F.col("v").between(F.col("q25") - reach, F.col("q75") + reach)
    ends = counts.join(box, "label").groupBy("label", "n", *quarter).agg(
        F.min(F.when(inside, F.col("v"))).alias("min"),
        F.max(F.when(inside, F.col("v"))).alias("max"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("c"))).alias("value"),
    )
    return ends.withColumns({"section": F.lit("season_box"), "column": F.lit(cells.index)})


def peak_hours(profile: DataFrame, index: str) -> DataFrame:
    """Hours of the day with enough values; min and max are the band of one deviation."""
    hours = profile.where((F.col("section") == "hour") & (F.col("column") == index) & (F.col("n") >= LEAST_AN_HOUR))
    band = {"min": F.col("mean") - F.col("std"), "max": F.col("mean") + F.col("std"), "section": F.lit("peak_hour")}
    return hours.withColumns(band)


def smoothed(cells: Cells) -> DataFrame:
    """The index of each hour over all stations, and its means over the last day and week of hours."""
    n, s = f"{cells.index}__n", f"{cells.index}__s"
    hours = cells.table.groupBy(F.col("hour").alias(cells.ts)).agg(F.sum(n).alias("n"), F.sum(s).alias("_s"))
    hours = hours.where(F.col(cells.ts).isNotNull()).withColumn("mean", F.try_divide("_s", "n")).withColumn("_one", F.lit(1))
    names = {f"smoothed_{k}": k for k in SMOOTHED}
    out = layout.over_series(
        hours,
        lambda w: {name: rolling.rolling_mean("mean", k, w) for name, k in names.items()},
        back=max(SMOOTHED),
        keys=("_one",),
        ts=cells.ts,
    )
    label = F.date_format(cells.ts, "yyyy-MM-dd HH:mm").alias("label")
    long = out.unpivot([label, "n", "mean"], list(names), "section", "value")
    return long.withColumn("column", F.lit(cells.index))


def quartiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact quartiles of the measured columns, which no sums can give."""
    long = stats.exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    cells = [F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))]
    return long.groupBy("column").agg(*cells)


def historical_sections(df: DataFrame, index: str = "numerical_aqi", ts: str = TIME) -> DataFrame:
    """All sections as one long table (section, label, column, n, mean, std, min, q25, q50, q75, max, value)."""
    cells = Cells(df, index, ts)
    whole = cells.merged(cells.table)
    profile = cut_lineage(profiles(cells), "profile")
    # one row for each measured column
    quarters = quartiles(df, [c for c in cells.measures if c != RATIO]).withColumn("section", F.lit("all"))
    described = profile.join(F.broadcast(quarters), ["section", "column"], "left")
    parts = [
        described, peak_hours(profile, index), correlations(cells, whole), limits_and_bins(cells, whole), season_boxes(cells), smoothed(cells)
    ]
    return reduce(DataFrame.unionByName, [_filled(p) for p in parts])


def forecast_sections(df: DataFrame, value: str = "aqi_forecast", keys=layout.KEYS, ts: str = TIME, bins: int = 20) -> DataFrame:
    """PL7 beyond the summary, per series (section, label, n, value): the mean of each hour of the day, the distribution
    over equal bins, and the mean of the first and the last day with the direction and volatility between them."""
    hours = df.groupBy(*keys, F.date_format(ts, "HH").alias("label")).agg(F.count(value).alias("n"), F.avg(value).alias("value"))
    counts = stats.histogram(df, value, bins, keys).withColumn("label", F.lpad(F.col("bin").cast("string"), 2, "0"))
    ends = aggregates.first_last_compare(df, value, 24, keys, ts)
    placed = [("first_24", "direction", "first_mean", "first_n"), ("last_24", "volatility", "last_mean", "last_n")]
    halves = F.inline(
        F.array(*[F.struct(F.lit(s).alias("section"), F.col(a).alias("label"), F.col(n).alias("n"), F.col(m).alias("value")) for s, a, m, n in placed])
    )
    none = F.lit(None).cast("double")
    return (
        hours.select(*keys, F.lit("hour").alias("section"), "label", "n", "value")
        .unionByName(counts.select(*keys, F.lit("bin").alias("section"), "label", "n", none.alias("value")))
        .unionByName(ends.select(*keys, halves))
    )
