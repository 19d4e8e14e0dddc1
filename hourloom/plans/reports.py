"""PL6 and PL7: the tables behind the history and forecast pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions import air, clock
from hourloom.operators import layout, rolling
from hourloom.operators.layout import KEYS, TIME


def index_by_hour(df: DataFrame, index: str = "numerical_aqi", ts: str = TIME) -> DataFrame:
    """Mean index per hour of day with the most frequent dominant pollutant (first by name on
    a tie). One count per (hour, pollutant) serves both."""
    cells = df.groupBy(F.hour(ts).alias("hour"), "primary_pollutant").agg(
        F.count(F.lit(1)).alias("c"), F.count(index).alias("n"), F.sum(index).alias("s")
    )
    named = F.col("primary_pollutant").isNotNull()
    rank = F.when(named, F.struct((-F.col("c")).alias("c"), F.col("primary_pollutant").alias("p")))
    return cells.groupBy("hour").agg(
        F.try_divide(F.sum("s"), F.sum("n")).alias(f"{index}_mean"),
        F.sum("n").alias("n"),
        F.min(rank)["p"].alias("primary_pollutant"),
    )


def sections(ts: str = TIME) -> dict[str, Column]:
    t = F.col(ts)
    return {
        "daily": F.date_format(t, "yyyy-MM-dd"),
        "hour": F.date_format(t, "HH"),
        "month": F.date_format(t, "MMM"),
        "weekday": F.date_format(t, "EEEE"),
        "season": clock.season_name(t),
        "pollutant": F.coalesce("primary_pollutant", F.lit("unknown")),
    }


def historical_report(df: DataFrame, index: str = "numerical_aqi", ts: str = TIME) -> DataFrame:
    """Index by day, hour, month, weekday, season and pollutant in one long table.

    The rows are first reduced to (day-hour, pollutant) groups, which all sections share; only
    those partial sums are copied to the six sections, not the rows.
    """
    partial = df.groupBy(F.date_trunc("hour", ts).alias(ts), "primary_pollutant").agg(
        F.count(index).alias("n"), F.sum(index).alias("s"), F.max(index).alias("peak")
    )
    cells = F.array(
        *[F.struct(F.lit(name).alias("section"), label.alias("label")) for name, label in sections(ts).items()]
    )
    long = partial.select("n", "s", "peak", F.explode(cells).alias("cell")).select("cell.*", "n", "s", "peak")
    return long.groupBy("section", "label").agg(
        F.sum("n").alias("n"), F.try_divide(F.sum("s"), F.sum("n")).alias("mean"), F.max("peak").alias("peak")
    )


def forecast_report(df: DataFrame, value: str = "aqi_forecast", keys=KEYS, ts: str = TIME) -> DataFrame:
    """Per series: summary, confidence band ends, and how many hours rise and fall."""
    moved = layout.over_series(df, lambda w: {"_d": rolling.change(value, 1, w)}, back=1, keys=keys, ts=ts)
    band = air.band_pct(F.col(value))
    return moved.groupBy(*keys).agg(
        F.avg(value).alias("avg"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.count(value).alias("n_valid"),
        F.max(band["upper"]).alias("upper"),
        F.min(band["lower"]).alias("lower"),
        F.count_if(F.col("_d") > 0).alias("n_worsening"),
        F.count_if(F.col("_d") < 0).alias("n_improving"),
    )
