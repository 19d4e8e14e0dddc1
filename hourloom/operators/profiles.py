"""Aggregates behind the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions import clock, fixed
from hourloom.operators import joins, layout
from hourloom.operators.layout import KEYS, LEN, POS, TIME


def _means(df: DataFrame, by: dict[str, Column], columns: list[str]) -> DataFrame:
    return df.groupBy(*[e.alias(n) for n, e in by.items()]).agg(*[F.avg(c).alias(f"{c}_mean") for c in columns])


def daily(df, columns, ts=TIME):
    return _means(df, {"day": F.to_date(ts)}, columns)


def hour_of_day(df, columns, ts=TIME):
    return _means(df, {"hour": F.hour(ts)}, columns)


def by_month(df, columns, ts=TIME):
    return _means(df, {"month": F.month(ts), "month_label": F.date_format(ts, "MMM")}, columns)


def weekday(df, columns, ts=TIME):
    """Means per day name, Monday to Sunday; days without rows are NULL."""
    means = _means(df, {"day_name": F.date_format(ts, "EEEE")}, columns)
    return joins.reindex_domain(means, "day_name", list(fixed.WEEKDAYS))


def peak_hours(df: DataFrame, column: str, least: int = 5, ts: str = TIME) -> DataFrame:
    """mean, deviation and band per hour of day; hours with fewer than ``least`` values drop out."""
    out = df.groupBy(F.hour(ts).alias("hour")).agg(
        F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.count(column).alias("n")
    )
    return out.where(F.col("n") >= least).withColumns(
        {"upper": F.col("mean") + F.col("std"), "lower": F.col("mean") - F.col("std")}
    )


def season_box(df: DataFrame, column: str, ts: str = TIME) -> DataFrame:
    """Quartiles, whiskers and outlier count per season.

    For index values: they are whole numbers from 0 to 500, so a group has at most 501
    distinct values and everything follows from its value counts.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(clock.season_name(F.col(ts)).alias("season"), F.col(column).alias("v"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    box = counts.groupBy("season").agg(
        F.sum("c").alias("n"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        *[F.percentile("v", F.lit(p), F.col("c")).alias(n) for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))],
    )
    reach = F.lit(1.5) * (F.col("q75") - F.col("q25"))
    fenced = counts.join(box, "season").withColumns({"lo": F.col("q25") - reach, "hi": F.col("q75") + reach})
    inside = F.col("v").between(F.col("lo"), F.col("hi"))
    whiskers = fenced.groupBy("season").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("c"))).alias("n_outliers"),
    )
    return box.join(whiskers, "season")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts of the non-null values."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def exceedance(df: DataFrame) -> DataFrame:
    """Share of valid (positive) values above each limit, in percent."""
    cells = []
    for name, authority, limit in fixed.EXCEEDANCE_LIMITS:
        if name in df.columns:
            over = F.count_if(F.col(name) > limit) * 100.0
            pct = F.try_divide(over, F.count_if(F.col(name) > 0).cast("double"))
            cells.append(
                F.struct(F.lit(name).alias("pollutant"), F.lit(authority).alias("authority"), pct.alias("pct"))
            )
    return df.agg(F.array(*cells).alias("_a")).select(F.inline("_a"))


def forecast_summary(df: DataFrame, column: str = "aqi_forecast") -> DataFrame:
    return df.agg(
        F.avg(column).alias("avg"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.count(column).alias("n_valid"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def first_last_compare(df: DataFrame, column: str, rows: int = 24, keys=KEYS, ts: str = TIME) -> DataFrame:
    """Mean and deviation of the first and last ``rows`` rows of each series of at least
    twice that length. A lower mean is an improvement."""
    placed = df if POS in df.columns else layout.with_position(df, keys, ts)
    early, late = F.col(POS) <= rows, F.col(POS) > F.col(LEN) - rows
    out = (
        placed.where((F.col(LEN) >= 2 * rows) & (early | late))
        .groupBy(*keys)
        .agg(
            F.avg(F.when(early, F.col(column))).alias("first_mean"),
            F.avg(F.when(late, F.col(column))).alias("last_mean"),
            F.stddev_samp(F.when(early, F.col(column))).alias("first_std"),
            F.stddev_samp(F.when(late, F.col(column))).alias("last_std"),
            F.count(F.when(early, F.col(column))).alias("first_n"),
            F.count(F.when(late, F.col(column))).alias("last_n"),
        )
    )

    def word(a, b, more, less, equal):
        return F.when(F.col(b) > F.col(a), more).when(F.col(b) < F.col(a), less).otherwise(equal)

    return out.withColumns(
        {
            "change": F.col("last_mean") - F.col("first_mean"),
            "direction": word("first_mean", "last_mean", "Worsening", "Improving", "Stable"),
            "volatility": word("first_std", "last_std", "More Variable", "Less Variable", "Same Variability"),
        }
    )


def pm_ratio(df: DataFrame, top: str = "pm2_5", bottom: str = "pm10") -> DataFrame:
    """Rows with both concentrations positive, and their ratio."""
    valid = df.where((F.col(top) > 0) & (F.col(bottom) > 0))
    return valid.withColumn("pm_ratio", F.try_divide(F.col(top), F.col(bottom))).where("pm_ratio IS NOT NULL")


def change_split(df: DataFrame, change: str) -> DataFrame:
    """Label rising and falling rows; unchanged and first rows drop out. Falling is improving."""
    moved = df.where((F.col(change) > 0) | (F.col(change) < 0))
    return moved.withColumn("move", F.when(F.col(change) < 0, "improving").otherwise("worsening"))


def profile_sidecar(df: DataFrame, numeric: list[str], ts: str = TIME) -> DataFrame:
    """One row: records, time range, columns, and per numeric column nulls and range."""
    per_column = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in numeric
    ]
    dtypes = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype")) for c, t in df.dtypes])
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.array(*per_column).alias("profile"),
    ).withColumn("dtypes", dtypes)


def snapshot_hash(df: DataFrame, columns: list[str], keys=KEYS, ts: str = TIME, decimals: int = 6) -> DataFrame:
    """md5 over the latest row of each series."""
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.col(ts)).alias("_r"))
    texts = [F.coalesce(F.round(F.col("_r")[c], decimals).cast("decimal(38,6)").cast("string"), F.lit("")) for c in columns]
    return latest.select(*keys, F.md5(F.concat_ws(",", *texts)).alias("snapshot"))


def top_counts(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The first k value counts in value order (a report of that length)."""
    return value_counts(df, column).orderBy(column).limit(k)


def head_tail(df: DataFrame, k: int = 5, keys=KEYS, ts: str = TIME) -> DataFrame:
    """The first and last k rows in time (a preview of that length)."""
    order = [F.col(c) for c in (ts, *keys)]
    head = df.orderBy(*order).limit(k).withColumn("part", F.lit("head"))
    tail = df.orderBy(*[c.desc() for c in order]).limit(k).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def seeded_sample(df: DataFrame, n: int, keys=KEYS, ts: str = TIME, seed: int = 42) -> DataFrame:
    """n rows in the order of a seeded hash of the row key: the same rows on every run."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.unix_micros(ts).cast("string"), F.lit(str(seed)))
    return df.withColumn("_h", F.md5(text)).orderBy("_h").limit(n).drop("_h")


def top_per_group(df: DataFrame, k: int, by, order: list[Column]) -> DataFrame:
    """k rows per group; each map task keeps only k rows of a group before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
