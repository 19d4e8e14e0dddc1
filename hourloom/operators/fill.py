"""Gap filling. Fills look back without bound, so blocks exchange only their edge values."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions import clock, fixed
from hourloom.operators import layout, stats
from hourloom.operators.layout import KEYS, LEN, POS, TIME


def with_neighbours(
    df: DataFrame,
    columns: list[str],
    keys=KEYS,
    ts: str = TIME,
    rows: int = layout.BLOCK_ROWS,
    cell_seconds: int = layout.CELL_SECONDS,
    of_series: DataFrame | None = None,
) -> DataFrame:
    """Add ``_prev_c`` and ``_next_c``: the nearest non-null (position, value) at or before /
    at or after each row, and the row position where it is still missing.

    A series is cut into blocks: of positions if the rows have them, of ``cell_seconds`` otherwise.
    Inside a block this is a window. Across blocks, each block reports its row count and
    its first and last value per column (one row per block), which are carried along the
    series and joined back by (series, block). The rows themselves are shuffled once.
    ``of_series`` (keys, ...) travels with the blocks, so that its columns reach the rows without a shuffle of their own.
    """
    placed = POS in df.columns
    if placed:
        ranked = df.withColumn("_block", layout.block_of(F.col(POS), rows)).withColumn("_rank", F.col(POS))
    else:
        cell = F.floor(F.unix_timestamp(ts) / F.lit(cell_seconds))
        in_cell = Window.partitionBy(*keys, "_block").orderBy(ts)
        celled = df.where(F.col(ts).isNotNull()).withColumn("_block", cell)
        ranked = celled.withColumn("_rank", F.row_number().over(in_cell).cast("bigint"))

    # the join below drops NULL keys; dropped here, both of its sides read one shuffle of the rows
    ranked = ranked.where(reduce(and_, [F.col(c).isNotNull() for c in (*keys, "_block")]))

    def known(c):
        return F.when(F.col(c).isNotNull(), F.struct(F.col("_rank").alias("pos"), F.col(c).alias("value")))

    def moved(edge):
        at = F.col(edge)
        return F.when(
            at.isNotNull(), F.struct((at["pos"] + F.col("_before")).alias("pos"), at["value"].alias("value"))
        )

    edges = ranked.groupBy(*keys, "_block").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max_by(known(c), F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(f"_last_{c}") for c in columns],
        *[F.min_by(known(c), F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(f"_first_{c}") for c in columns],
    )
    # "the first one from here on" runs as "the last one so far" in reverse order: a frame that
    # is open at its end would be computed anew for every row
    strictly = (Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(*strictly)
    later = Window.partitionBy(*keys).orderBy(F.desc("_block")).rowsBetween(*strictly)
    before = F.lit(0) if placed else F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    shifted = edges.withColumn("_before", before.cast("bigint")).withColumns(
        {f"_{end}_{c}": moved(f"_{end}_{c}") for end in ("last", "first") for c in columns}
    )
    carried = shifted.select(
        *keys,
        "_block",
        "_before",
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_in_{c}") for c in columns],
        *[F.last(f"_first_{c}", ignorenulls=True).over(later).alias(f"_out_{c}") for c in columns],
    )
    if of_series is not None:
        carried = carried.join(of_series, list(keys), "left")
    inside = Window.partitionBy(*keys, "_block")
    so_far = (Window.unboundedPreceding, 0)
    upto = inside.orderBy("_rank").rowsBetween(*so_far)
    onward = inside.orderBy(F.desc("_rank")).rowsBetween(*so_far)
    local = ranked.select(
        "*",
        *[F.last(known(c), ignorenulls=True).over(upto).alias(f"_lp_{c}") for c in columns],
        *[F.last(known(c), ignorenulls=True).over(onward).alias(f"_ln_{c}") for c in columns],
    )
    joined = local.join(carried, [*keys, "_block"])
    near = {f"_prev_{c}": F.coalesce(moved(f"_lp_{c}"), F.col(f"_in_{c}")) for c in columns}
    near |= {f"_next_{c}": F.coalesce(moved(f"_ln_{c}"), F.col(f"_out_{c}")) for c in columns}
    if not placed:
        near |= {POS: F.col("_before") + F.col("_rank"), LEN: F.col("_total")}
    scratch = [f"{p}_{c}" for p in ("_lp", "_ln", "_in", "_out") for c in columns]
    return joined.withColumns(near).drop("_block", "_rank", "_before", "_total", *scratch)


def drop_neighbours(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*[f"{p}_{c}" for p in ("_prev", "_next") for c in columns])


def filled(c: str) -> Column:
    """Forward fill, then backward fill of what leads the series."""
    return F.coalesce(F.col(f"_prev_{c}")["value"], F.col(f"_next_{c}")["value"])


def interpolated(c: str) -> Column:
    """Linear by row; a trailing gap keeps the last value, a leading gap stays NULL."""
    p, n = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
    slope = (n["value"] - p["value"]) / (n["pos"] - p["pos"])
    between = p["value"] + slope * (F.col(POS) - p["pos"])
    return F.coalesce(F.col(c), F.when(n.isNull(), p["value"]).when(n["pos"] > p["pos"], between))


def _apply(df, columns, expression, keys, ts, keep_position, cell_seconds=layout.CELL_SECONDS):
    out = with_neighbours(df, columns, keys, ts, cell_seconds=cell_seconds)
    out = drop_neighbours(out.withColumns({c: expression(c) for c in columns}), columns)
    return out if keep_position else out.drop(POS, LEN)


def ffill_bfill(df, columns, keys=KEYS, ts=TIME, keep_position=False, cell_seconds=layout.CELL_SECONDS) -> DataFrame:
    return _apply(df, columns, filled, keys, ts, keep_position, cell_seconds)


def interpolate_linear(df, columns, keys=KEYS, ts=TIME, keep_position=False, cell_seconds=layout.CELL_SECONDS) -> DataFrame:
    return _apply(df, columns, interpolated, keys, ts, keep_position, cell_seconds)


def fill_constant(df: DataFrame, skip=()) -> DataFrame:
    """Numbers 0, text ``unknown``, for every column not in ``skip``."""
    numbers, texts = {}, {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if field.name in skip:
            continue
        if kind in ("double", "float", "integer", "long", "short", "byte"):
            numbers[field.name] = 0
        elif kind == "string":
            texts[field.name] = "unknown"
    return df.na.fill({**numbers, **texts}) if numbers or texts else df


def refill_derived(df: DataFrame, ts: str = TIME) -> DataFrame:
    """Recompute missing calendar, cyclic and range columns from their sources."""
    t = F.col(ts)
    source = {**clock.calendar_fields(t), "is_weekend": clock.day_flags(t)["is_weekend"]}
    source.update(clock.cyclic_fields(t))
    if {"tmin", "tmax"} <= set(df.columns):
        source["temperature_range"] = F.col("tmax") - F.col("tmin")
    return df.withColumns({c: F.coalesce(F.col(c), e) for c, e in source.items() if c in df.columns})


def gap_fill_policy(df: DataFrame, keys=KEYS, ts: str = TIME, skip=(), cell_seconds: int = layout.CELL_SECONDS) -> DataFrame:
    """Fill every column by its group; the index itself and its targets stay as they are.

    pollutants: forward then backward; weather: linear; precipitation 0; wind speed and pressure: series median; calendar: recomputed;
    anything else: 0 or ``unknown``. Columns in ``skip`` stay as they are.
    """
    present = set(df.columns) - set(skip)
    carry = [c for c in fixed.POLLUTANTS if c in present]
    linear = [c for c in fixed.INTERPOLATED if c in present]
    middle = [c for c in fixed.MEDIAN_FILLED if c in present]
    out = df
    if middle and not (keys and (carry or linear)):
        out = stats.fill_median(out, middle, keys)
    if carry or linear:
        medians = stats.quantiles_wide(df, middle, [0.5], keys) if middle and keys else None
        out = with_neighbours(out, carry + linear, keys, ts, cell_seconds=cell_seconds, of_series=medians)
        values = {c: filled(c) for c in carry} | {c: interpolated(c) for c in linear}
        if medians is not None:
            values |= {c: F.coalesce(F.col(c), F.col(f"{c}_q50")) for c in middle}
        out = drop_neighbours(out.withColumns(values), carry + linear).drop(*[f"{c}_q50" for c in middle])
        if POS not in df.columns:
            out = out.drop(POS, LEN)
    out = refill_derived(out, ts)
    untouched = {*skip, *keys, ts, POS, LEN, "numerical_aqi", *fixed.TARGETS, *carry, *linear, *middle}
    return fill_constant(out, skip=untouched)


def upsample_ffill(df: DataFrame, columns: list[str], keys=KEYS, ts: str = TIME) -> DataFrame:
    """Put each series on a full hourly grid between its ends and carry values forward.

    Each row is stretched to the hour before the next row, so no grid join is needed
    and the work is spread over the rows, not the series.
    """
    following = layout.over_series(
        df, lambda w: {"_following": F.lead(ts, 1).over(w)}, back=0, ahead=1, keys=keys, ts=ts
    )
    carried = ffill_only(following, columns, keys, ts)
    until = F.coalesce(F.col("_following") - F.expr("INTERVAL 1 HOUR"), F.col(ts))
    hours = F.sequence(F.col(ts), F.greatest(until, F.col(ts)), F.expr("INTERVAL 1 HOUR"))
    others = [c for c in carried.columns if c not in (ts, "_following")]
    return carried.select(*others, F.explode(hours).alias(ts))


def ffill_only(df, columns, keys=KEYS, ts=TIME) -> DataFrame:
    return _apply(df, columns, lambda c: F.col(f"_prev_{c}")["value"], keys, ts, False)
