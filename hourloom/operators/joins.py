"""Joins of the series engine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions import fixed
from hourloom.operators.layout import KEYS, TIME


def hour_aligned(left: DataFrame, right: DataFrame, keys=KEYS, ts: str = TIME) -> DataFrame:
    """Inner join of two sources on (series, hour); both are floored first.

    Run it on keep-last sources: repeated hours multiply, as in any join. Skewed
    partitions are split by adaptive execution.
    """
    a = left.withColumn(ts, F.date_trunc("hour", F.col(ts)))
    b = right.withColumn(ts, F.date_trunc("hour", F.col(ts)))
    return a.join(b, [*keys, ts], "inner")


def nearest_in_time(
    probes: DataFrame,
    readings: DataFrame,
    values: list[str],
    tolerance_seconds: int = 3600,
    keys=KEYS,
    ts: str = TIME,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """For each probe time the reading closest in time, if nearer than the tolerance.

    No pairs are formed, and no reading is copied. Distinct probe times and readings are merged into one time-ordered
    stream per (series, bucket of time); each probe looks at the last reading before and the first one after it. What
    lies in other buckets is known from their edges: the first and last reading of each bucket, combined in the map
    tasks, are carried along the series, one row for each bucket. Buckets are as long as the tolerance unless
    ``bucket_seconds`` says otherwise; shorter ones split an hour with very many readings. The earlier reading wins a tie.
    Values must be unique per reading time (run ``keep_last`` first).
    """
    bucket = F.floor(F.unix_micros(F.col(ts)) / F.lit((bucket_seconds or tolerance_seconds) * 1_000_000))
    body = F.struct(F.col(ts).alias("at"), *[F.col(v) for v in values])
    none = F.lit(None).cast(_struct_type(readings, ts, values))
    asked = probes.select(*keys, ts).distinct().select(*keys, ts, bucket.alias("_b"), none.alias("_v"))
    merged = asked.unionByName(readings.select(*keys, ts, bucket.alias("_b"), body.alias("_v")))

    read = F.when(F.col("_v").isNotNull(), F.col(ts))
    edges = merged.groupBy(*keys, "_b").agg(F.max_by("_v", read).alias("_last"), F.min_by("_v", read).alias("_first"))
    strictly, so_far = (Window.unboundedPreceding, -1), (Window.unboundedPreceding, 0)
    ago = Window.partitionBy(*keys).orderBy("_b").rowsBetween(*strictly)
    to_come = Window.partitionBy(*keys).orderBy(F.desc("_b")).rowsBetween(*strictly)
    carried = edges.select(
        *keys,
        "_b",
        F.last("_last", ignorenulls=True).over(ago).alias("_in"),
        F.last("_first", ignorenulls=True).over(to_come).alias("_out"),
    )
    bucketed = Window.partitionBy(*keys, "_b")
    earlier = bucketed.orderBy(F.unix_micros(ts)).rangeBetween(*so_far)
    later = bucketed.orderBy(F.unix_micros(ts).desc()).rangeBetween(*so_far)
    near = merged.select(
        *keys,
        "_b",
        ts,
        F.col("_v").isNull().alias("_asked"),
        F.last("_v", ignorenulls=True).over(earlier).alias("_p"),
        F.last("_v", ignorenulls=True).over(later).alias("_n"),
    ).where("_asked")
    near = near.join(carried, [*keys, "_b"])
    near = near.withColumns({"_p": F.coalesce("_p", "_in"), "_n": F.coalesce("_n", "_out")})
    before = F.unix_micros(ts) - F.unix_micros("_p.at")
    after = F.unix_micros("_n.at") - F.unix_micros(ts)
    pick = F.when(F.col("_n").isNull() | (before <= after), F.col("_p")).otherwise(F.col("_n"))
    gap = F.least(before, after)
    found = near.where(gap < tolerance_seconds * 1_000_000).select(
        *keys, ts, *[pick[v].alias(v) for v in values], (gap / 1e6).alias("gap_seconds")
    )
    return probes.join(found, [*keys, ts], "left")


def _struct_type(df: DataFrame, ts: str, values: list[str]) -> str:
    fields = [("at", ts), *[(v, v) for v in values]]
    return "struct<" + ",".join(f"{n}:{df.schema[c].dataType.simpleString()}" for n, c in fields) + ">"


def breakpoint_table(spark) -> DataFrame:
    """The breakpoints as rows; a fixed table of some forty segments."""
    rows = [
        (name, float(lo), float(hi), float(base), float(top), position)
        for name, segments in fixed.BREAKPOINTS.items()
        for position, (lo, hi, base, top) in enumerate(segments)
    ]
    schema = "pollutant string, c_low double, c_high double, i_low double, i_high double, segment int"
    return spark.createDataFrame(rows, schema)


def breakpoint_join(df: DataFrame, value: str, table: str) -> DataFrame:
    """``breakpoint_index`` as a lookup: left range join with the fixed table.

    The broadcast side is the constant table above, whatever the data.
    """
    segments = breakpoint_table(df.sparkSession).where(F.col("pollutant") == table)
    c = F.col(value)
    hit = df.join(F.broadcast(segments), c.between(F.col("c_low"), F.col("c_high")), "left")
    slope = (F.col("i_high") - F.col("i_low")) / (F.col("c_high") - F.col("c_low"))
    limits = fixed.BREAKPOINTS[table]
    index = F.coalesce(
        F.rint(slope * (c - F.col("c_low")) + F.col("i_low")),
        F.when(c > float(limits[-1][1]), F.lit(500.0)),
        F.when((c >= 0) & (c < float(limits[0][0])), F.lit(0.0)),
    )
    return hit.withColumn("index", index).drop(*segments.columns)


def reindex_domain(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Every member of a fixed domain, in its order, with NULL where ``df`` has no row."""
    places = df.sparkSession.createDataFrame(
        [(i, name) for i, name in enumerate(domain)], f"place int, {column} string"
    )
    return places.join(df, column, "left")


def select_by_importance(long: DataFrame, ranked: DataFrame, least: int = 10) -> DataFrame:
    """Rows of the long feature table whose feature is ranked; all of them if fewer than
    ``least`` ranked names occur."""
    names = long.select("feature").distinct()
    matches = names.join(ranked.select("feature").distinct(), "feature", "left_semi")
    enough = matches.agg((F.count(F.lit(1)) >= least).alias("ok")).scalar()
    listed = long.join(
        ranked.select("feature").distinct().withColumn("_ranked", F.lit(True)), "feature", "left"
    )
    return listed.where(F.coalesce(F.col("_ranked"), F.lit(False)) | ~enough).drop("_ranked")


def baseline_compare(candidates: DataFrame, baseline: DataFrame, on: str = "model") -> DataFrame:
    """Absolute and relative RMSE gain over earlier results; unmatched models are new."""
    old = baseline.select(on, F.col("rmse").alias("baseline_rmse"))
    out = candidates.join(old, on, "left")
    gain = F.col("baseline_rmse") - F.col("rmse")
    status = (
        F.when(gain.isNull(), "new").when(gain > 0, "better").when(gain < 0, "worse").otherwise("same")
    )
    return out.withColumns(
        {
            "improvement": gain,
            "improvement_pct": F.try_divide(gain * 100.0, F.col("baseline_rmse")),
            "status": status,
        }
    )


def promotion_join(
    candidates: DataFrame, champions: DataFrame, threshold: float = 0.02, allowed: Column | bool = True
) -> DataFrame:
    """Champion per horizon after the gate.

    A candidate replaces the champion only if promotion is allowed, the champion's error is
    known and the relative gain reaches the threshold. A horizon that has no champion yet keeps none. With a column
    ``path`` on both sides the model of the champion is told too.
    """
    paths = "path" in candidates.columns and "path" in champions.columns
    told = ["rmse", "r2", *(["path"] if paths else [])]
    allowed = allowed if isinstance(allowed, Column) else F.lit(allowed)
    cand = candidates.select("horizon", *[F.col(c).alias(f"cand_{c}") for c in told])
    champ = champions.select("horizon", *[F.col(c).alias(f"champ_{c}") for c in told])
    gain = (F.col("champ_rmse") - F.col("cand_rmse")) / F.greatest(F.lit(1e-9), F.col("champ_rmse"))
    promote = F.coalesce(allowed & (gain >= threshold), F.lit(False))
    return champ.join(cand, "horizon", "left").select(
        "horizon",
        "cand_rmse",
        "champ_rmse",
        gain.alias("rel_gain"),
        promote.alias("promoted"),
        *(["cand_path"] if paths else []),
        *[F.when(promote, F.col(f"cand_{c}")).otherwise(F.col(f"champ_{c}")).alias(c) for c in told],
    )


def key_assembly(parts: list[DataFrame], keys=KEYS, ts: str = TIME) -> DataFrame:
    """Put the columns of several tables side by side by (series, time)."""
    return reduce(lambda a, b: a.join(b, [*keys, ts], "inner"), parts)
