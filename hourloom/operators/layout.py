"""Row positions and halo blocks: series windows that never put a whole series in one task.

A series window written as ``PARTITION BY station`` sends every row of a station to
one task, so one very long series would hold up the job. Here each series is cut into
blocks of consecutive rows. A row is copied into a neighbouring block only when a frame
of that block reaches it, so bounded frames give the same values as on the whole series,
and every block is small and independent.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEYS = ("station_id",)
TIME = "ts"
POS, LEN = "_pos", "_len"
REL = "_rel"  # position counted from the block start: small, so products with it stay exact
BLOCK_ROWS = 2048
CELL_SECONDS = 30 * 24 * 3600


def _running(keys, order) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def with_position(
    df: DataFrame,
    keys=KEYS,
    ts: str = TIME,
    tie: tuple = (),
    cell: Column | None = None,
    cell_seconds: int = CELL_SECONDS,
) -> DataFrame:
    """Add the 1-based row position ``_pos`` within the series and its length ``_len``.

    Rows are ranked inside (series, time cell) only. The rows before each cell come from
    cell counts, which are aggregated map-side and are tiny next to the data: a month
    of hourly rows makes one count. Pass shorter ``cell_seconds`` for series denser than hourly
    (3600 for one row a second), or a ``cell`` that grows with the order. Rows without a time have no position and are
    left out (as a series read drops rows with an invalid time).
    """
    cell = cell if cell is not None else F.floor(F.unix_timestamp(ts) / F.lit(cell_seconds))
    celled = df.where(F.col(ts).isNotNull()).withColumn("_cell", cell)
    counts = celled.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = _running(keys, "_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys,
        "_cell",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias(LEN),
    )
    in_cell = Window.partitionBy(*keys, "_cell").orderBy(ts, *tie)
    ranked = celled.withColumn("_rank", F.row_number().over(in_cell))
    return (
        ranked.join(offsets, [*keys, "_cell"])
        .withColumn(POS, F.col("_before") + F.col("_rank"))
        .drop("_cell", "_before", "_rank")
    )


@dataclass(frozen=True)
class Blocks:
    """Rows laid out in blocks with their halo, and the window that runs within a block."""

    df: DataFrame
    window: WindowSpec

    def native(self, df: DataFrame) -> DataFrame:
        """Drop the halo copies and the layout columns once the windows are computed."""
        return df.where("_native").drop("_block", "_native", REL)


def block_of(pos: Column, rows: int = BLOCK_ROWS) -> Column:
    return F.floor((pos - 1) / F.lit(rows))


def in_blocks(
    df: DataFrame, back: int, ahead: int = 0, keys=KEYS, ts: str = TIME, rows: int = BLOCK_ROWS, cell_seconds: int = CELL_SECONDS
) -> Blocks:
    """Lay a series out in blocks whose halo covers ``back`` rows before and ``ahead`` after.

    A block is never shorter than its halo, so one neighbour on each side suffices.
    The copies add ``(back + ahead) / rows`` of the data.
    """
    rows = max(rows, back, ahead)
    if POS not in df.columns:
        df = with_position(df, keys, ts, cell_seconds=cell_seconds)
    own = block_of(F.col(POS), rows)
    offset = F.pmod(F.col(POS) - 1, F.lit(rows))
    last = block_of(F.col(LEN), rows)
    to_next = F.when((offset >= rows - back) & (own < last), own + 1)
    to_previous = F.when((offset < ahead) & (own > 0), own - 1)
    spread = df.withColumn("_own", own).withColumn(
        "_block", F.explode(F.array_compact(F.array(F.col("_own"), to_next, to_previous)))
    )
    laid_out = spread.withColumns(
        {
            "_native": F.col("_block") == F.col("_own"),
            REL: (F.col(POS) - F.col("_block") * rows).cast("double"),
        }
    ).drop("_own")
    return Blocks(laid_out, Window.partitionBy(*keys, "_block").orderBy(POS))


def over_series(
    df: DataFrame,
    columns: Callable[[WindowSpec], dict[str, Column]],
    back: int,
    ahead: int = 0,
    keys=KEYS,
    ts: str = TIME,
    rows: int = BLOCK_ROWS,
    keep_position: bool = False,
    cell_seconds: int = CELL_SECONDS,
) -> DataFrame:
    """Add window columns whose frames reach at most ``back`` rows back and ``ahead`` ahead.

    All columns go into one ``select``, so Spark plans one exchange and one sort for them.
    """
    blocks = in_blocks(df, back, ahead, keys, ts, rows, cell_seconds)
    out = blocks.native(blocks.df.withColumns(columns(blocks.window)))
    return out if keep_position else out.drop(POS, LEN)


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns as a one-row ``inline``.

    Spark copies a projected expression into every filter and aggregate above that mentions
    it. For long expressions used many times the copies outgrow generated code; across a
    generator nothing is copied, so these are evaluated once per row.
    """
    row = F.struct(*[e.alias(name) for name, e in columns.items()])
    return df.select("*", F.inline(F.array(row)))
