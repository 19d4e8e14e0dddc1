"""Versioned tables of hourly rows, kept as one folder per touched period and a manifest per version.

A version is a list of (period, folder): which files hold the rows of a month. An upsert reads and rewrites only the
months that its batch touches; all other entries of the new manifest point at the folders of earlier versions. So a
batch of three days costs one or two months whatever the length of the history, every version stays readable, and a
reader of an old version is not disturbed by a writer. ``add`` does not even rewrite the months: its rows form a second
folder of them and are merged when read, until ``compact`` folds the folders together.

A manifest is a single file that Spark's committer renames into place at the end, so a version appears whole or not at
all; the data folder of a failed write is referenced by nothing. One writer at a time, as many readers as there are.
Rows without a time belong to no period and are left out.
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hourloom.functions import clock
from hourloom.operators import upsert
from hourloom.operators.layout import KEYS, TIME
from hourloom.session import cut_lineage

PERIOD = "_period"
ENTRY = (
    "period string, folder string, counts string, written_in long, n_rows long, first_ts timestamp, last_ts timestamp, "
    "written_at timestamp, columns string, follows long"
)


@dataclass(frozen=True)
class VersionedTable:
    """A table below ``root``. ``order`` decides between rows of one key and time: the greatest stays; a batch without
    the column ``batch_seq`` gets the number of the version that it makes. ``period`` is a unit of date_trunc."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...] = KEYS
    ts: str = TIME
    order: tuple[str, ...] = (upsert.BATCH,)
    period: str = "month"

    # what there is

    def manifests(self) -> DataFrame:
        """The entries of all versions, with column ``version``."""
        try:
            return self.spark.read.schema(f"{ENTRY}, version long").option("basePath", f"{self.root}/manifest").parquet(
                f"{self.root}/manifest/version=*"
            )
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], f"{ENTRY}, version long")

    def newest(self, as_of=None) -> int:
        """The number of the newest version (written up to ``as_of``); 0 before the first."""
        entries = self.manifests()
        entries = entries if as_of is None else entries.where(F.col("written_at") <= F.lit(str(as_of)).cast("timestamp"))
        return entries.agg(F.max("version")).first()[0] or 0

    def entries(self, version: int | None = None) -> list:
        """The manifest of a version: a row for each folder, at most a few for each period of its history."""
        version = self.newest() if version is None else version
        rows = self.manifests().where(F.col("version") == version).orderBy("period", "written_in").collect()
        if version and not rows:
            raise ValueError(f"{self.root} has no version {version}")
        return rows

    def period_of(self, ts: str) -> Column:
        return F.date_format(F.date_trunc(self.period, ts), "yyyy-MM-dd")

    # reading

    def schema(self, entries: list) -> StructType:
        """The newest schema among the entries; it covers all older ones."""
        return StructType.fromDDL(max(entries, key=lambda e: e.written_in).columns)

    def _rows(self, entries: list, schema: StructType) -> DataFrame:
        """Periods of one folder as they are; those of several folders merged, each on its own."""

        def folders(chosen: list) -> DataFrame:
            return self.spark.read.schema(schema).parquet(*[e.folder for e in chosen])

        several = {p for p, n in Counter(e.period for e in entries).items() if n > 1}
        alone, split = [e for e in entries if e.period not in several], [e for e in entries if e.period in several]
        parts = [folders(alone)] if alone else []
        parts += [upsert.keep_last(folders(split), self.keys, self.ts, self.order)] if split else []
        return reduce(DataFrame.unionByName, parts)

    def read(self, version: int | None = None, periods: list[str] | None = None) -> DataFrame | None:
        """The rows of a version, of the named periods only if given; None if there are none."""
        entries = self.entries(version)
        chosen = [e for e in entries if periods is None or e.period in set(periods)]
        return self._rows(chosen, self.schema(entries)) if chosen else None

    def counts(self, version: int | None = None) -> DataFrame | None:
        """Rows of each series in each period (keys, period, n), kept by every write; of the folders still in use."""
        entries = self.entries(version)
        if not entries:
            return None
        live = self.spark.createDataFrame([(e.period, e.written_in) for e in entries], f"{PERIOD} string, written_in long")
        found = self.spark.read.parquet(*{e.counts for e in entries})
        return found.join(F.broadcast(live), [PERIOD, "written_in"], "left_semi").groupBy(*self.keys, PERIOD).agg(F.sum("n").alias("n"))

    # writing

    def _prepared(self, incoming: DataFrame, version: int) -> DataFrame:
        rows = incoming.where(F.col(self.ts).isNotNull()).withColumn(self.ts, clock.floor_hour(F.col(self.ts)))
        return rows if upsert.BATCH in rows.columns else rows.withColumn(upsert.BATCH, F.lit(version))

    def _written(self, rows: DataFrame, version: int) -> list[tuple]:
        """Write rows by period, and give the manifest entries of what was written."""
        base = f"{self.root}/data/version={version:08d}-{uuid.uuid4().hex[:8]}"
        rows = rows.select(*sorted(rows.columns))
        # adaptive execution splits large periods and merges small ones into files of a good size
        rows.withColumn(PERIOD, self.period_of(self.ts)).hint("rebalance", PERIOD).write.partitionBy(PERIOD).parquet(f"{base}/rows")
        back = self.spark.read.schema(f"{rows.schema.toDDL()}, {PERIOD} string").parquet(f"{base}/rows")
        counts = back.groupBy(PERIOD, *self.keys).agg(F.count(F.lit(1)).alias("n"), F.min(self.ts).alias("a"), F.max(self.ts).alias("b"))
        counts = counts.withColumn("written_in", F.lit(version).cast("long"))
        counts.write.parquet(f"{base}/counts")
        sums = self.spark.read.schema(counts.schema).parquet(f"{base}/counts").groupBy(PERIOD)
        found = sums.agg(F.sum("n").alias("n"), F.min("a").alias("a"), F.max("b").alias("b"), F.current_timestamp().alias("t")).collect()
        columns = rows.schema.toDDL()
        return [(r[PERIOD], f"{base}/rows/{PERIOD}={r[PERIOD]}", f"{base}/counts", version, r.n, r.a, r.b, r.t, columns) for r in found]

    def _publish(self, entries: list, version: int, follows: int | None = None) -> int:
        if not entries:  # an empty batch into an empty table
            return version - 1
        rows = self.spark.createDataFrame([(*tuple(e)[:9], follows) for e in entries], ENTRY)
        rows.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/manifest/version={version}")
        return version

    def upsert(self, incoming: DataFrame, follows: int | None = None) -> int:
        """A new version in which the batch replaces stored hours, by rewriting the periods that it touches. A table
        that is derived from another one notes the version of that one in ``follows``."""
        old = self.entries()
        version = self.newest() + 1
        batch = cut_lineage(self._prepared(incoming, version), "batch")
        touched = {r[0] for r in batch.select(self.period_of(self.ts)).distinct().collect()}
        within = [e for e in old if e.period in touched]
        if within:
            merged = upsert.union_schema(self._rows(within, self.schema(old)), self._as_stored(batch, old))
        else:
            merged = self._as_stored(batch, old)
        last = upsert.keep_last(merged, self.keys, self.ts, self.order)
        return self._publish([e for e in old if e.period not in touched] + self._written(last, version), version, follows)

    def add(self, incoming: DataFrame, follows: int | None = None) -> int:
        """A new version that holds the batch beside what is stored; only the batch is written, merged when read."""
        old = self.entries()
        version = self.newest() + 1
        last = upsert.keep_last(self._as_stored(self._prepared(incoming, version), old), self.keys, self.ts, self.order)
        return self._publish([*old, *self._written(last, version)], version, follows)

    def compact(self, folders: int = 4) -> int:
        """A new version in which the periods of more than so many folders have one."""
        old = self.entries()
        many = {p for p, n in Counter(e.period for e in old).items() if n > folders}
        if not many:
            return self.newest()
        version = self.newest() + 1
        merged = self._rows([e for e in old if e.period in many], self.schema(old))
        return self._publish([e for e in old if e.period not in many] + self._written(merged, version), version, self.followed())

    def restore(self, version: int) -> int:
        """The content of an earlier version as the newest one; no rows are copied."""
        return self._publish(self.entries(version), self.newest() + 1, self.followed(version))

    def followed(self, version: int | None = None) -> int:
        """The version of another table that this one was brought up to; 0 if none."""
        return max((e.follows or 0 for e in self.entries(version)), default=0)

    def mark_followed(self, follows: int) -> int:
        """A new version of the same rows that follows a newer version of its source."""
        return self._publish(self.entries(), self.newest() + 1, follows)

    def expire(self, keep: int) -> list[int]:
        """Forget all but the newest ``keep`` versions, and remove the folders that only those used."""
        entries = self.manifests().select("version", "folder", "counts").distinct().collect()
        versions = sorted({e.version for e in entries})
        gone = versions[: max(0, len(versions) - keep)]
        used = {f for e in entries if e.version not in gone for f in (e.folder, e.counts)}
        for v in gone:
            self._remove(f"{self.root}/manifest/version={v}")
        for folder in {f for e in entries if e.version in gone for f in (e.folder, e.counts)} - used:
            self._remove(folder)
        return gone

    def _remove(self, folder: str) -> None:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

    def _as_stored(self, rows: DataFrame, entries: list) -> DataFrame:
        """Stored columns keep their type, absent ones are NULL, new ones are added, so that any set of folders can be
        read under the newest schema."""
        if not entries:
            return rows
        kinds = {f.name: f.dataType for f in self.schema(entries).fields}
        have = set(rows.columns)
        old = [(F.col(c).cast(k) if c in have else F.lit(None).cast(k)).alias(c) for c, k in kinds.items()]
        return rows.select(*old, *[c for c in rows.columns if c not in kinds])

    # differences

    def changes(self, before: int, after: int | None = None) -> DataFrame:
        """(keys, ts, kind) of the hours that are new or differ between two versions; only the periods whose folders
        differ are read. The batch number alone is no difference."""
        new, old = self.entries(after), self.entries(before) if before else []
        schema = self.schema(new)
        differ = {e.folder for e in new} ^ {e.folder for e in old}
        periods = {e.period for e in (*new, *old) if e.folder in differ}
        right = [e for e in new if e.period in periods]
        left = [e for e in old if e.period in periods]
        if not right:
            fields = [f for f in schema.fields if f.name in (*self.keys, self.ts)]
            return self.spark.createDataFrame([], StructType(fields).add("kind", "string"))
        values = [c for c in schema.names if c not in (*self.keys, self.ts, upsert.BATCH)]
        # a hash skips NULLs, so whether each value is one is hashed too
        digest = F.xxhash64(*values, *[F.col(c).isNull() for c in values])
        now = self._rows(right, schema).select(*self.keys, self.ts, digest.alias("_new"))
        if not left:
            return now.select(*self.keys, self.ts, F.lit("inserted").alias("kind"))
        was = self._rows(left, schema).select(*self.keys, self.ts, digest.alias("_old"))
        kind = F.when(F.col("_old").isNull(), F.lit("inserted")).when(F.col("_old") != F.col("_new"), F.lit("updated"))
        both = now.join(was, [*self.keys, self.ts], "left")
        return both.select(*self.keys, self.ts, kind.alias("kind")).where("kind IS NOT NULL")
