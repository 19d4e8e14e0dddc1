"""Exact duplicates by two passes over a counting Bloom filter.

Texts are equal when they are identical after every blank of ``[\\x20\\x09-\\x0D]`` is deleted. The first pass hashes every
whole text and counts the hashes in a filter of two-bit cells (none, once, more often). The second pass tests every row:
a hash of which some cell was met once only has no equal, and its row passes straight through. Only the rest, the
repeated rows and a few false alarms, is shuffled and grouped by the full digest, so a false alarm costs a little
shuffle and never changes the result.

At scale: what is kept of a row between the passes is its id, digest and length, never the text. Tasks send the filter
only the cells that they met, or the bitmaps of a segment where these are shorter, and each segment is merged by
itself, one at a time, in bounded memory. The finished filter is one bit a cell and bounded by ``most_bytes``; it grows
with the rows up to that bound (64 MB are 32 million rows at 16 cells each). Beyond it false alarms become more
frequent, until for many more rows all of them are shuffled, still without their texts: 50 bytes a row. Groups are
pre-aggregated; their result is joined by digest, where adaptive execution splits the rows of a very large group.

Defined cases: a null text counts as empty, so null, empty and blank texts are one group; of rows that tie in length, the
smallest id stays, null ids last; of rows that tie in id too, exactly one stays; an empty table gives no rows; further
columns are untouched by ``classes`` and carried along by ``deduplicated``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm.storage import discard, stored

BLANKS = r"[\x20\x09-\x0D]+"
#: Cells for each row, cells that a hash sets, cells of a segment, and hashes that a task gathers before it sends them on.
CELLS, PROBES, SEGMENT, GATHERED = 16, 4, 1 << 20, 1 << 19
MOST_BYTES = 64 << 20

PARTIAL = "segment int, once binary, more binary"


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return F.unhex(F.sha2(F.regexp_replace(whole, BLANKS, "").cast("binary"), 256))


def n_cells(rows: int, most_bytes: int) -> int:
    """A power of two, a segment at least, CELLS for each row as long as the finished bitmap stays within the bound."""
    most = max(SEGMENT, 8 * most_bytes)
    cells = SEGMENT
    while cells < CELLS * rows and 2 * cells <= most:
        cells *= 2
    return cells


def places(hashes: np.ndarray, cells: int, probes: int) -> np.ndarray:
    """The cells of each hash, one row for each probe (double hashing; the step is odd, so they differ)."""
    h = hashes.astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(i) * step) & np.uint64(cells - 1) for i in range(probes)])


def _counted(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct cells, and whether each was met more than once."""
    cells = np.sort(cells)
    first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, np.int64)
    return cells[first], np.diff(np.r_[first, len(cells)]) > 1


def _bits(cells: np.ndarray) -> np.ndarray:
    flags = np.zeros(SEGMENT, np.uint8)
    flags[cells] = 1
    return np.packbits(flags, bitorder="little")


def met_cells(batches: Iterator[pa.RecordBatch], cells: int, probes: int) -> Iterator[pa.RecordBatch]:
    """For each segment, the cells that these hashes met once or more, and more than once: as sorted 32-bit numbers, or
    as a bitmap where that is shorter."""
    gathered: list[np.ndarray] = []

    def sent() -> Iterator[pa.RecordBatch]:
        met, again = _counted(places(np.concatenate(gathered), cells, probes).ravel())
        gathered.clear()
        segments = (met // np.uint64(SEGMENT)).astype(np.int64)
        cut = np.searchsorted(segments, np.arange(cells // SEGMENT + 1))
        for s in np.flatnonzero(np.diff(cut)):
            part = slice(cut[s], cut[s + 1])
            inside = (met[part] % np.uint64(SEGMENT)).astype(np.uint32)
            forms = [x.tobytes() if 4 * len(x) < SEGMENT // 8 else _bits(x).tobytes() for x in (inside, inside[again[part]])]
            yield pa.RecordBatch.from_pydict(
                {"segment": pa.array([s], pa.int32()), "once": pa.array(forms[:1], pa.binary()), "more": pa.array(forms[1:], pa.binary())}
            )

    for batch in batches:
        gathered.append(batch.column(0).to_numpy())
        if sum(map(len, gathered)) >= GATHERED:
            yield from sent()
    if sum(map(len, gathered)):
        yield from sent()


def _bitmap(form: bytes) -> np.ndarray:
    return np.frombuffer(form, np.uint8) if len(form) == SEGMENT // 8 else _bits(np.frombuffer(form, np.uint32))


def merged_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by segment; one segment is held at a time. Gives the cells met more than once."""
    now, once, more = None, None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"segment": pa.array([now], pa.int32()), "more": pa.array([more.tobytes()], pa.binary())})

    for batch in batches:
        for s, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            if s != now:
                if now is not None:
                    yield done()
                now, once, more = s, np.zeros(SEGMENT // 8, np.uint8), np.zeros(SEGMENT // 8, np.uint8)
            met = _bitmap(a.as_py())
            more |= _bitmap(b.as_py()) | (once & met)
            once |= met
    if now is not None:
        yield done()


def repeated_cells(hashes: DataFrame, cells: int, probes: int = PROBES) -> np.ndarray:
    """Bitmap of the cells that the one column of 64-bit hashes met more than once."""
    partial = hashes.mapInArrow(lambda b: met_cells(b, cells, probes), PARTIAL)
    tasks = min(cells // SEGMENT, 256)
    dealt = partial.repartition(tasks, "segment").sortWithinPartitions("segment")
    found = np.zeros(cells // 8, np.uint8)
    for row in dealt.mapInArrow(merged_segments, "segment int, more binary").collect():
        found[row.segment * SEGMENT // 8 : (row.segment + 1) * SEGMENT // 8] = np.frombuffer(row.more, np.uint8)
    return found


def repeat_test(spark: SparkSession, bitmap: np.ndarray, probes: int = PROBES):
    """A column function: whether a 64-bit hash may be repeated; and the broadcast bitmap, to be destroyed after use."""
    shared = spark.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def may_repeat(hashes: pd.Series) -> pd.Series:
        bits = shared.value
        spots = places(hashes.to_numpy(), 8 * len(bits), probes)
        hit = (bits[(spots >> np.uint64(3)).astype(np.int64)] >> (spots & np.uint64(7)).astype(np.uint8)) & 1
        return pd.Series(hit.all(axis=0))

    return may_repeat, shared


def _length(text: str) -> Column:
    return F.length(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).cast("long")


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", most_bytes: int = MOST_BYTES) -> DataFrame:
    """One row for each row of docs: the key, keep_id (key of the row that stays), group_size, kept, digest."""
    rows = docs.select(F.col(f"`{key}`").alias("id"), digest(F.col(f"`{text}`")).alias("digest"), _length(text).alias("length"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    bitmap = repeated_cells(rows.select(F.xxhash64("digest")), n_cells(rows.count(), most_bytes))
    may_repeat, shared = repeat_test(docs.sparkSession, bitmap)
    flagged = stored(rows.withColumn("repeated", may_repeat(F.xxhash64("digest"))), "flagged")
    shared.destroy()
    discard(rows)
    alone = flagged.where("not repeated").select(
        F.col("id").alias(key), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    again = flagged.where("repeated")
    # ascending: the longest first, then the smallest id, nulls last, then the first row
    place = F.struct(-F.col("length"), F.col("id").isNull(), "id", "row")
    groups = again.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("group_size"))
    groups = groups.select("digest", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size")
    # written, so that both sides of the join are dealt out for it alone and a very large group can be split
    groups = stored(groups, "groups")
    judged = again.join(groups, "digest").select(
        F.col("id").alias(key), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest"
    )
    return alone.unionByName(judged)


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", most_bytes: int = MOST_BYTES) -> DataFrame:
    """The rows of docs that stay, with all their columns; a row without an equal is not shuffled."""
    whole_row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    rows = docs.select(whole_row, F.col(f"`{key}`").alias("id"), digest(F.col(f"`{text}`")).alias("digest"), _length(text).alias("length"))
    hashes = stored(rows.select(F.xxhash64("digest").alias("hash")), "hashes")
    may_repeat, _ = repeat_test(docs.sparkSession, repeated_cells(hashes, n_cells(hashes.count(), most_bytes)))
    discard(hashes)
    flagged = rows.withColumn("repeated", may_repeat(F.xxhash64("digest")))
    place = F.struct(-F.col("length"), F.col("id").isNull(), "id")
    best = flagged.where("repeated").groupBy("digest").agg(F.min_by("doc", place).alias("doc"))
    return flagged.where("not repeated").select("doc.*").unionByName(best.select("doc.*"))
