"""Column statistics at scale: quantiles, describe, nulls, correlation, histogram, clipping.

Statistics of a known number of rows (one, or one per listed column) reach the data as a
scalar subquery or a broadcast of that plan-time size. Statistics per series grow with the
number of series and are joined by key; adaptive execution broadcasts them when they are
small and splits a hot key when they are not.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions import air
from hourloom.operators.layout import KEYS
from hourloom.session import cut_lineage

#: Values of a group that one task sorts, and ranges into which the values of a larger one are counted.
RANKED, BUCKETS = 1 << 16, 1 << 12


def long_form(df: DataFrame, columns: list[str], keys=()) -> DataFrame:
    """(keys, column, value) with the NULLs left out."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    wide = wide.where(F.coalesce(*columns).isNotNull())  # rows without a value, before they are copied for every column
    return wide.unpivot(list(keys), list(columns), "column", "value").where(F.col("value").isNotNull())


def _ends(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.count("value").alias("count"), F.min("value").alias("min"), F.max("value").alias("max")
    )


def _joined(rows: DataFrame, other: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join by group; a NULL key is a group too."""
    renamed = other.withColumnsRenamed({c: f"_by_{c}" for c in by})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    return rows.join(renamed, same, how).drop(*[f"_by_{c}" for c in by])


def _ranks(n: Column, p: float) -> Column:
    """The wanted place between two neighbouring ranks (counted from 1), and the share of the second one."""
    at = (n - 1) * F.lit(float(p))
    return F.struct(
        F.lit(float(p)).alias("prob"),
        (F.floor(at) + 1).alias("first"),
        (F.ceil(at) + 1).alias("second"),
        (at - F.floor(at)).alias("share"),
    )


def _by_size(value: Column) -> Column:
    """Rises with the value, by 1 for each power of two of its size, through zero."""
    return F.signum(value) * F.coalesce(F.log2(F.abs(value)) + 1075, F.lit(0.0))


def _bucket(value: Column, lo: Column, hi: Column, by_size: bool) -> Column:
    """The bucket of a value between lo and hi, rising with the value; lo and hi are never in the same one.

    Buckets are of equal width or, for values of very different sizes, of equal ratio.
    """
    a, b, c = (_by_size(x) if by_size else x / 2 for x in (lo, value, hi))
    place = F.floor((b - a) / (c - a) * BUCKETS)
    return F.when(c > a, F.least(place, F.lit(BUCKETS - 1))).otherwise((value > lo).cast("bigint"))


def _narrowed(rows: DataFrame, targets: DataFrame, by: list[str], by_size: bool) -> DataFrame:
    """Targets whose range [lo, hi], with ``below`` values before it and ``inside`` in it, is cut down to the bucket that
    holds the wanted ranks. Ranks in two neighbouring buckets are the last of one and the first of the other."""
    state = ["prob", "first", "second", "share", "lo", "hi", "below"]
    held = _joined(rows, targets.select(*by, *state), by).where(F.col("value").between(F.col("lo"), F.col("hi")))
    place = _bucket(F.col("value"), F.col("lo"), F.col("hi"), by_size).alias("_b")
    counted = held.groupBy(*by, *state, place).agg(
        F.count(F.lit(1)).alias("_n"), F.min("value").alias("_min"), F.max("value").alias("_max")
    )
    upto = F.sum("_n").over(Window.partitionBy(*by, "prob").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    reached = counted.withColumn("_upto", F.col("below") + upto).withColumn("_before", F.col("_upto") - F.col("_n"))
    has_first = (F.col("first") > F.col("_before")) & (F.col("first") <= F.col("_upto"))
    has_second = (F.col("second") > F.col("_before")) & (F.col("second") <= F.col("_upto"))
    ranks = ["prob", "first", "second", "share"]
    one = reached.where(has_first | has_second).groupBy(*by, *ranks).agg(
        F.min("_min").alias("_lowest"),
        F.max("_max").alias("_highest"),
        F.min("_max").alias("_a"),
        F.max("_min").alias("_b"),
        F.min("_before").alias("_before"),
        F.sum("_n").alias("_n"),
        F.count(F.lit(1)).alias("_buckets"),
    )
    apart = F.col("_buckets") > 1
    return one.select(
        *by,
        *ranks,
        F.when(apart, F.col("_a")).otherwise(F.col("_lowest")).alias("lo"),
        F.when(apart, F.col("_b")).otherwise(F.col("_highest")).alias("hi"),
        F.col("_before").alias("below"),
        F.when(apart, F.lit(2)).otherwise(F.col("_n")).alias("inside"),
        apart.alias("known"),
    )


def exact_quantiles(df: DataFrame, columns: list[str], probs, keys=(), ends: DataFrame | None = None, limit: int = RANKED) -> DataFrame:
    """Exact, linearly interpolated quantiles as (keys, column, prob, value); NULL and NaN are left out.

    A group of up to ``limit`` values is sorted in one task. For a larger one, the values in each of a few thousand
    ranges are counted, combined in the map tasks; the cumulative counts tell which range holds the wanted rank, and that
    range alone is divided again, until what is left fits the limit or is a single value. So no task ever holds more of a
    group than the limit, however the values are distributed or repeated, and only small tables of ranges are kept. The
    second round divides by size; what then remains is of one size, where doubles lie evenly and five rounds tell any
    two of them apart.
    ``ends`` are (keys, column, count, min, max) if known already.
    """
    by = [*keys, "column"]
    rows = long_form(df, columns, keys).where(~F.isnan("value"))
    ends = cut_lineage((_ends(rows, by) if ends is None else ends).select(*by, "count", "min", "max"), "ends")
    wanted = F.inline(F.array(*[_ranks(F.col("count"), p) for p in probs]))
    large = ends.where(F.col("count") > limit)
    if large.isEmpty():
        return _ranked_whole(rows, by, probs)
    targets = large.select(
        *by, wanted, F.col("min").alias("lo"), F.col("max").alias("hi"), F.lit(0).cast("bigint").alias("below"),
        F.col("count").alias("inside"), F.lit(False).alias("known"),
    )
    targets, settled, rounds = cut_lineage(targets, "targets"), None, 0
    still = (F.col("inside") > limit) & (F.col("lo") < F.col("hi")) & ~F.col("known")
    while True:
        done = targets.where(~still)
        settled = done if settled is None else settled.unionByName(done)
        wide = targets.where(still)
        if wide.isEmpty():
            break
        targets = cut_lineage(_narrowed(rows, wide, by, by_size=rounds == 1), "targets")
        rounds += 1
    small = _joined(rows, large.select(*by), by, "left_anti")
    return _ranked_whole(small, by, probs).unionByName(_ranked_within(rows, settled, by))


def _between(a: Column, b: Column, share: Column) -> Column:
    return F.when(share == 0, a).otherwise(a + (b - a) * share)


def _ranked_whole(rows: DataFrame, by: list[str], probs) -> DataFrame:
    """Quantiles of groups that fit the limit."""
    sorted_values = rows.groupBy(*by).agg(F.sort_array(F.collect_list("value")).alias("_v"))
    n = F.size("_v").cast("bigint")
    wanted = sorted_values.select(*by, "_v", F.inline(F.array(*[_ranks(n, p) for p in probs])))
    value = _between(F.get("_v", F.col("first") - 1), F.get("_v", F.col("second") - 1), F.col("share"))
    return wanted.select(*by, "prob", value.alias("value"))


def _ranked_within(rows: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """Quantiles of groups whose ranks were narrowed down to ranges that fit the limit, or to known values."""
    ranks = ["prob", "first", "second", "share", "below"]
    alone = targets.where(F.col("known") | (F.col("lo") == F.col("hi")))
    told = alone.select(*by, "prob", _between(F.col("lo"), F.col("hi"), F.col("share")).alias("value"))
    open_ = targets.where(~F.col("known") & (F.col("lo") < F.col("hi"))).select(*by, *ranks, "lo", "hi")
    held = _joined(rows, open_, by).where(F.col("value").between(F.col("lo"), F.col("hi")))
    held = held.groupBy(*by, *ranks).agg(F.sort_array(F.collect_list("value")).alias("_v"))
    first, second = (F.get("_v", F.col(c) - F.col("below") - 1) for c in ("first", "second"))
    return told.unionByName(held.select(*by, "prob", _between(first, second, F.col("share")).alias("value")))


def quantiles_wide(df: DataFrame, columns, probs, keys=()) -> DataFrame:
    """One row (per key) with ``{column}_q{percent}`` columns."""
    long = exact_quantiles(df, columns, probs, keys)
    cells = [
        F.max(F.when((F.col("column") == c) & (F.col("prob") == float(p)), F.col("value"))).alias(
            f"{c}_q{round(p * 100)}"
        )
        for c in columns
        for p in probs
    ]
    return long.groupBy(*keys).agg(*cells)


def with_one_row(df: DataFrame, one: DataFrame, name: str = "_s") -> DataFrame:
    """Make the single row of ``one`` available on every row as struct ``name``.

    A scalar subquery: it runs once and its row is put into the plan as a constant.
    """
    return df.withColumn(name, one.select(F.struct(*one.columns)).scalar())


def with_stats(df: DataFrame, stats: DataFrame, keys=()) -> DataFrame:
    """Attach statistics as struct ``_s``: per key by join, global ones as a constant."""
    if not keys:
        return with_one_row(df, stats)
    values = [c for c in stats.columns if c not in keys]
    return df.join(stats.select(*keys, F.struct(*values).alias("_s")), list(keys), "left")


def fill_median(df: DataFrame, columns: list[str], keys=()) -> DataFrame:
    medians = quantiles_wide(df, columns, [0.5], keys)
    out = with_stats(df, medians, keys)
    return out.withColumns({c: F.coalesce(F.col(c), F.col("_s")[f"{c}_q50"]) for c in columns}).drop("_s")


def quartiles(df: DataFrame, columns: list[str], keys=()) -> DataFrame:
    return quantiles_wide(df, columns, [0.25, 0.75], keys)


def iqr_clip(df: DataFrame, columns: list[str], keys=(), fences: DataFrame | None = None) -> DataFrame:
    """Clip to 1.5 interquartile ranges beyond the quartiles (``fences`` if known already)."""
    out = with_stats(df, fences if fences is not None else quartiles(df, columns, keys), keys)
    return out.withColumns({c: air.clip(F.col(c), *_fences(c)) for c in columns}).drop("_s")


def _fences(c: str) -> tuple[Column, Column]:
    q1, q3 = F.col("_s")[f"{c}_q25"], F.col("_s")[f"{c}_q75"]
    return q1 - F.lit(1.5) * (q3 - q1), q3 + F.lit(1.5) * (q3 - q1)


def outlier_counts(df: DataFrame, columns: list[str], keys=()) -> DataFrame:
    """Rows outside the fences, per column."""
    out = with_stats(df, quartiles(df, columns, keys), keys)
    counts = {}
    for c in columns:
        low, high = _fences(c)
        counts[c] = F.count_if((F.col(c) < low) | (F.col(c) > high))
    wide = out.groupBy(*keys).agg(*[e.alias(c) for c, e in counts.items()])
    return wide.unpivot(list(keys), list(columns), "column", "n_outliers")


def fixed_clip(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: air.clip(F.col(c), lo, hi) for c, (lo, hi) in limits.items() if c in df.columns})


def out_of_range(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """How many values of each column lie below and above its limits."""
    kept = {c: lim for c, lim in limits.items() if c in df.columns}
    counts = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c) < lo).alias("n_below"), F.count_if(F.col(c) > hi).alias("n_above")) for c, (lo, hi) in kept.items()]
    return df.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))


def moments(df: DataFrame, columns: list[str], keys=()) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
    )


def standardise(df: DataFrame, columns: list[str], keys=(), fit_on: DataFrame | None = None) -> DataFrame:
    """z-scores with the population deviation, fitted on ``fit_on`` (default: all rows).

    A constant column is only centred.
    """
    out = with_stats(df, moments(fit_on if fit_on is not None else df, columns, keys), keys)

    def score(c):
        std = F.col("_s")[f"{c}_std"]
        scale = F.when(std > 0, std).otherwise(F.lit(1.0))
        return (F.col(c).cast("double") - F.col("_s")[f"{c}_mean"]) / scale

    return out.withColumns({c: score(c) for c in columns}).drop("_s")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max; one row per column."""
    values = long_form(df, columns).where(~F.isnan("value"))
    basic = cut_lineage(
        values.groupBy("column").agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        ),
        "basic",
    )
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], ends=basic)
    wide = quartiles.groupBy("column").agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
            for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        ]
    )
    return basic.join(F.broadcast(wide), "column")


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls, rows) from one pass over all columns."""
    names = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names]
    )
    return wide.unpivot(["_rows"], names, "column", "nulls").withColumnRenamed("_rows", "rows")


def completeness_pct(df: DataFrame) -> DataFrame:
    """Mean over columns of the share of non-null values, in percent."""
    share = 100.0 * (F.col("rows") - F.col("nulls")) / F.col("rows")
    return null_counts(df).agg(F.avg(share).alias("completeness_pct"))


def time_range(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
    )


def correlation(a: str, b: str) -> Column:
    """Pearson correlation of the rows that have both values; NaN where one of them does not vary (``F.corr`` divides
    by zero there, which is an error in ANSI mode), NULL without such rows."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.when(spread == 0, F.lit(float("nan"))).otherwise(F.try_divide(F.covar_pop(x, y), spread))


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations as (a, b, corr), both triangles and the diagonal."""

    pairs = [*combinations(columns, 2), *[(c, c) for c in columns]]
    wide = df.agg(*[correlation(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), F.col(f"_{i}").alias("corr")))
    return wide.select(F.inline(F.array(*cells)))


def corr_with_target(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    wide = df.agg(*[correlation(c, target).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "corr")


def histogram(df: DataFrame, column: str, bins: int, keys=()) -> DataFrame:
    """Counts in exactly ``bins`` equal-width bins between the column's ends."""
    known = df.where(F.col(column).isNotNull())
    ends = known.groupBy(*keys).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    out = with_stats(known, ends, keys)
    width = F.col("_s.hi") - F.col("_s.lo")
    place = F.floor((F.col(column) - F.col("_s.lo")) / width * F.lit(bins)) + 1
    bucket = F.when(width > 0, F.least(F.lit(bins), place)).otherwise(F.lit(1))
    return out.groupBy(*keys, bucket.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
