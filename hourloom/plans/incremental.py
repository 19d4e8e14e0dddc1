"""Derived tables that follow a versioned master: only hours within reach of a change are computed again.

A row of a window result depends on the ``back`` rows before it and the ``ahead`` rows after it in its series. So a
changed hour makes the next ``back`` and the previous ``ahead`` rows dirty, however far away in time these lie. Which
periods hold them, and the rows that their windows need in turn, follows from the number of rows of each series in each
period, which the master keeps. Only those periods and series are read, and only the dirty hours are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.operators import layout, upsert
from hourloom.plans import features, index
from hourloom.session import cut_lineage
from hourloom.sources.versions import PERIOD, VersionedTable


def periods_needed(changed: DataFrame, counts: DataFrame, table: VersionedTable, reach: int) -> DataFrame:
    """(keys, period) that hold the rows up to ``reach`` before and after the changed ones of a series."""
    keys = list(table.keys)
    ends = changed.groupBy(*keys).agg(
        F.min(table.period_of(table.ts)).alias("_from"), F.max(table.period_of(table.ts)).alias("_to")
    )
    # one row for each series and period, of the changed series only
    own = counts.join(ends, keys)
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy(PERIOD).rowsBetween(Window.unboundedPreceding, 0))
    own = own.withColumn("_upto", upto)
    whole = Window.partitionBy(*keys)
    first = F.min(F.when(F.col(PERIOD) >= F.col("_from"), F.col("_upto") - F.col("n"))).over(whole)
    last = F.max(F.when(F.col(PERIOD) <= F.col("_to"), F.col("_upto"))).over(whole)
    near = (F.col("_upto") > first - reach) & (F.col("_upto") - F.col("n") < last + reach)
    return own.withColumn("_near", near).where("_near").select(*keys, PERIOD)


def rows_in_reach(master: VersionedTable, changed: DataFrame, back: int, ahead: int, version: int | None = None) -> DataFrame:
    """The rows that the windows of the dirty hours need, with ``_dirty``: 1 for the dirty ones."""
    keys = list(master.keys)
    needed = cut_lineage(periods_needed(changed, master.counts(version), master, back + ahead), "needed")
    periods = [r[0] for r in needed.select(PERIOD).distinct().collect()]  # as many as the history has periods, at most
    rows = master.read(version, periods).withColumn(PERIOD, master.period_of(master.ts))
    rows = rows.join(needed, [*keys, PERIOD], "left_semi").drop(PERIOD)
    marked = rows.join(changed.select(*keys, master.ts, F.lit(1).alias("_changed")), [*keys, master.ts], "left")

    def dirty(w):
        return {"_dirty": F.max("_changed").over(w.rowsBetween(-back, ahead))}

    return layout.over_series(marked, dirty, back, ahead, keys, master.ts).drop("_changed")


def refresh(
    master: VersionedTable,
    derived: VersionedTable,
    compute: Callable[[DataFrame], DataFrame],
    back: int,
    ahead: int = 0,
    compact_above: int = 8,
) -> int:
    """Bring ``derived`` up to the newest version of ``master``, and return the version of ``derived``.

    ``compute`` maps series rows to derived rows, and passes unknown columns on. The manifest of ``derived`` notes the
    version of ``master`` that it follows, so a refresh goes on where the last one ended, over any number of versions.
    """
    now, done = master.newest(), derived.followed()
    if now == done:
        return derived.newest()
    if done == 0:
        return derived.upsert(compute(master.read(now)).drop(upsert.BATCH), follows=now)
    changed = cut_lineage(master.changes(done, now), "changed")
    if changed.isEmpty():
        return derived.mark_followed(now)
    rows = rows_in_reach(master, changed, back, ahead, now)
    derived.add(compute(rows).where("_dirty = 1").drop("_dirty", upsert.BATCH), follows=now)
    return derived.compact(compact_above)


def refresh_index(master: VersionedTable, derived: VersionedTable) -> int:
    """PL2 on what changed: averages reach 23 rows back."""
    return refresh(master, derived, index.compute_index, index.REACH)


def refresh_features(master: VersionedTable, derived: VersionedTable, only=None) -> int:
    """PL3 on what changed: windows, lags and trends reach 72 rows back. ``only`` names the window features kept."""
    return refresh(master, derived, lambda rows: features.build_features(rows, master.keys, master.ts, only=only), features.REACH)
