"""PL1: two hourly sources to the master table, and the collection window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions import clock
from hourloom.operators import joins, upsert
from hourloom.operators.layout import KEYS, TIME


def build_master(
    pollution: DataFrame,
    weather: DataFrame,
    stored: DataFrame | None = None,
    keys=KEYS,
    ts: str = TIME,
    batch: str = upsert.BATCH,
) -> DataFrame:
    """Keep-last per source, join by hour, add the calendar, merge into the stored master."""

    def hourly(df):
        return upsert.keep_last(df.withColumn(ts, clock.floor_hour(F.col(ts))), keys, ts, (batch,))

    left = hourly(pollution)
    joined = joins.hour_aligned(left, hourly(weather).drop(batch), keys, ts)
    t = F.col(ts)
    calendar = {**clock.calendar_fields(t), "is_weekend": clock.day_flags(t)["is_weekend"]}
    cycles = {k: v for k, v in clock.cyclic_fields(t, weeks=True).items() if k.startswith(("day_of_year", "week"))}
    out = joined.withColumns({**calendar, **cycles})
    if "coco" not in out.columns:
        out = out.withColumn("coco", F.lit(0))
    return out if stored is None else upsert.upsert_keep_last(stored, out, keys, ts, (batch,))


def next_window(master: DataFrame, fallbacks: list[DataFrame] = (), days: int = 3, ts: str = TIME) -> DataFrame:
    """One row (start, end): from the hour after the newest stored one, ``days`` long, at most now.

    The newest time comes from the first table of master and fallbacks that has rows; with
    none, the window is the last ``days`` days.
    """
    newest = [df.agg(F.max(ts).alias("m")).scalar() for df in (master, *fallbacks)]
    now = F.current_timestamp()
    span = F.expr(f"INTERVAL {days} DAYS")
    start = F.coalesce(*[m + F.expr("INTERVAL 1 HOUR") for m in newest], now - span)
    one = master.sparkSession.range(1)
    return one.select(start.alias("start"), F.least(start + span, now).alias("end"))


def backfill_range(df: DataFrame, start: str, end: str, ts: str = TIME) -> DataFrame:
    """Rows of a bounded range; reversed ends are swapped and the end is at most now."""
    a, b = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    return df.where(F.col(ts).between(F.least(a, b), F.least(F.greatest(a, b), F.current_timestamp())))
