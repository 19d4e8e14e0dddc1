"""Compression of vectors to codes, one byte for each of several parts, with tries over the distinct parts.

Vectors of integers are cut into equal parts; each part position has a codebook, improved by rounds of assignment and
averaging. A task sorts the distinct parts of its block lexicographically, with their numbers of copies. Read from left
to right they form a trie: a node at depth k stands for a prefix of k components. The walk goes depth first and carries
for each open node the vector of squared distances from its prefix to the prefixes of all entries, so what parts have in
common is added up once. A leaf holds the finished distances: their argmin is its code, and its copies weigh its
components in the sums of the entry. Siblings are visited in runs of bounded size, so that a step is one array operation.

At scale: a block is a bounded number of rows, and tasks send one row for each entry that they used; those are summed
before and after the shuffle. Only the codebooks (parts x entries) reach the driver. Rounds read the vectors again and
shuffle none. All sums are whole numbers, so results do not depend on how the rows are dealt out.

Defined cases: vectors that are null, shorter than the longest, or hold null or non-finite components are dropped; a
length that the parts do not divide is filled up with zeros; with fewer rows than entries the codebook is that much
shorter; entries that nothing uses stay as they are; ties go to the lower index; null ids come last and rows of one id
are told apart by their components; null labels are one label; components so large that 64 bits cannot hold their
squares are counted exactly, and an error (or its sum) beyond 64 bits is null; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.storage import stored
from hourloom.llm.vectors import PLAIN, floors, matrix, whole_vectors

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256.0
#: Rows of a block, and trie nodes that one step of the walk visits.
BLOCK, RUN = 1 << 15, 1 << 12
#: Sums travel as two numbers, low and high, so that decimals hold them whatever their size.
LIMB = 1 << 60

SUMS = "position int, entry int, place int, uses long, low decimal(38,0), high decimal(38,0)"


class Trie:
    """The distinct rows of an integer matrix in lexicographic order, and where each prefix begins."""

    def __init__(self, parts: np.ndarray):
        width = parts.shape[1]
        order = np.lexsort(parts.T[::-1]) if parts.dtype != object else np.array(sorted(range(len(parts)), key=lambda i: tuple(parts[i])))
        rows = parts[order]
        # the first component in which a row differs from the one before it; width if in none
        differs = np.ones((len(rows), width), bool)
        differs[1:] = rows[1:] != rows[:-1]
        split = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        split[:1] = 0
        opens = split < width
        self.rows = rows[opens]
        leaf = np.cumsum(opens) - 1
        self.leaf_of = np.empty(len(rows), np.int64)
        self.leaf_of[order] = leaf
        self.copies = np.bincount(leaf, minlength=len(self.rows))
        split = split[opens]
        #: for each depth, the first leaf of each node, and one past the last leaf
        self.starts = [np.r_[np.flatnonzero(split <= d), len(self.rows)] for d in range(width)]
        #: for each depth but the last, the first child of each node, and one past the last child
        self.children = [np.searchsorted(b, a) for a, b in zip(self.starts, self.starts[1:])]

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each leaf the nearest entry (the lowest of several) and its squared distance."""
        n, width = self.rows.shape
        code, distance = np.zeros(n, np.int64), np.zeros(n, entries.dtype)
        none = np.zeros((1, len(entries)), entries.dtype)
        # a run of sibling nodes: depth, the first and one past the last, and the distances of the nodes above them
        open_ = [(0, i, min(i + RUN, len(self.starts[0]) - 1), none, None) for i in range(0, len(self.starts[0]) - 1, RUN)][::-1]
        while open_:
            depth, first, last, above, parent = open_.pop()
            value = self.rows[self.starts[depth][first:last], depth]
            carried = (above if parent is None else above[parent]) + (value[:, None] - entries[None, :, depth]) ** 2
            if depth == width - 1:
                best = carried.argmin(axis=1)
                code[first:last], distance[first:last] = best, carried[np.arange(last - first), best]
                continue
            child = self.children[depth]
            below, end = child[first], child[last]
            for i in range(below + (end - below - 1) // RUN * RUN, below - 1, -RUN):
                j = min(i + RUN, end)
                up = np.searchsorted(child[first : last + 1], np.arange(i, j), side="right") - 1
                low, high = up[0], up[-1] + 1
                open_.append((depth + 1, i, j, carried[low:high], up - low))
        return code, distance


def _fitting(*arrays: np.ndarray) -> list[np.ndarray]:
    """All as 64-bit integers if that is safe for squared distances, else all as Python's integers."""
    small = all(not a.size or np.abs(a).max() < PLAIN for a in arrays)
    return [a.astype(np.int64 if small else object) for a in arrays]


def blocks(batches: Iterator[pa.RecordBatch], at: int, parts: int, rows: int = BLOCK) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches joined to blocks of about so many rows, each with its integers, filled up to a multiple of ``parts``."""
    waiting: list[pa.RecordBatch] = []

    def joined():
        table = pa.Table.from_batches(waiting)
        waiting.clear()
        x = floors(matrix(table.column(at).combine_chunks()), SCALE)
        return table, np.pad(x, ((0, 0), (0, -x.shape[1] % parts)))

    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            waiting.append(batch.slice(start, rows))
            if sum(b.num_rows for b in waiting) >= rows:
                yield joined()
    if waiting:
        yield joined()


def entry_sums(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each entry used by these vectors and each place in it: how many parts use it, and the sum of their components."""
    parts, size, width = books.shape
    uses = np.zeros((parts, size), np.int64)
    sums = np.zeros((parts, size, width), object)
    for _, x in blocks(batches, 0, parts):
        for p in range(parts):
            own, book = _fitting(x[:, p * width : (p + 1) * width], books[p])
            trie = Trie(own)
            code, _ = trie.nearest(book)
            uses[p] += np.bincount(code, weights=trie.copies, minlength=size).astype(np.int64)
            total = np.zeros((size, width), own.dtype)
            np.add.at(total, code, trie.rows * trie.copies[:, None])
            sums[p] += total
    p, e, w = (a.ravel() for a in np.broadcast_arrays(*np.ix_(range(parts), range(size), range(width))))
    used = uses[p, e] > 0
    p, e, w = p[used], e[used], w[used]
    if len(p):
        total = sums[p, e, w].tolist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p, pa.int32()),
                pa.array(e, pa.int32()),
                pa.array(w, pa.int32()),
                pa.array(uses[p, e], pa.int64()),
                pa.array([t % LIMB for t in total], pa.decimal128(38, 0)),
                pa.array([t // LIMB for t in total], pa.decimal128(38, 0)),
            ],
            ["position", "entry", "place", "uses", "low", "high"],
        )


def first_books(vectors: DataFrame, key: str, vector: str, parts: int, entries: int) -> np.ndarray | None:
    """The parts of the rows with the smallest keys: (part, entry, place); none without rows."""
    rows = vectors.select(F.col(f"`{key}`").alias("k"), F.col(f"`{vector}`").alias("v"))
    rows = rows.orderBy(F.col("k").asc_nulls_last(), "v").limit(entries).collect()
    if not rows:
        return None
    x = floors(np.array([r.v for r in rows], np.float64), SCALE)
    x = np.pad(x, ((0, 0), (0, -x.shape[1] % parts)))
    return x.reshape(len(rows), parts, -1).transpose(1, 0, 2).copy()


def improved(vectors: DataFrame, vector: str, books: np.ndarray) -> np.ndarray:
    """One round: every part goes to its nearest entry, then every used entry to the floor of the mean of its parts."""
    partial = vectors.select(f"`{vector}`").mapInArrow(lambda batches: entry_sums(batches, books), SUMS)
    total = partial.groupBy("position", "entry", "place").agg(F.sum("uses").alias("uses"), F.sum("low").alias("low"), F.sum("high").alias("high"))
    new = books.astype(object)
    for r in total.collect():
        new[r.position, r.entry, r.place] = (int(r.high) * LIMB + int(r.low)) // r.uses
    return _fitting(new)[0]


def coded(batches: Iterator[pa.RecordBatch], at: int, books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The batches with columns code (a byte for each part) and error in place of the vector."""
    parts, _, width = books.shape
    for table, x in blocks(batches, at, parts):
        codes = np.zeros((len(x), parts), np.uint8)
        error = np.zeros(len(x), x.dtype)
        for p in range(parts):
            own, book = _fitting(x[:, p * width : (p + 1) * width], books[p])
            trie = Trie(own)
            code, distance = trie.nearest(book)
            codes[:, p] = code[trie.leaf_of]
            error = error + distance[trie.leaf_of]
        code = pa.array([c.tobytes() for c in codes], pa.binary())
        fits = pa.array([int(e) if e < 1 << 63 else None for e in error.tolist()], pa.int64())
        rest = table.remove_column(at)
        for batch in pa.Table.from_arrays([*rest.columns, code, fits], [*rest.column_names, "code", "error"]).to_batches():
            yield batch


def fitted(vectors: DataFrame, key: str, vector: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
    """Codebooks (part, entry, place) of whole vectors, or None without rows; at most 256 entries."""
    books = first_books(vectors, key, vector, parts, min(entries, 256))
    for _ in range(rounds if books is not None else 0):
        books = improved(vectors, vector, books)
    return books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def compressed(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray | None]:
    """(key, label, code as bytes, error) of every whole vector, written once; and the codebooks."""
    columns = [F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector")]
    vectors = whole_vectors(rows.select(*columns), "vector")
    books = fitted(vectors, "key", "vector", parts, entries, rounds)
    schema = vectors.drop("vector").schema.add("code", "binary").add("error", "long")
    if books is None:
        return rows.sparkSession.createDataFrame([], schema), None
    return stored(vectors.mapInArrow(lambda batches: coded(batches, 2, books), schema), "codes"), books


def decoded(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """codes with the vectors that they stand for, scaled back, in array column ``vector``."""
    parts = books.shape[0]
    table = F.array(*(F.array(*(F.array(*(F.lit(float(v) / SCALE) for v in entry)) for entry in book)) for book in books))
    byte = "cast(conv(hex(substring(code, p + 1, 1)), 16, 10) as int)"
    return codes.withColumn("_books", table).withColumn(
        "vector", F.expr(f"flatten(transform(sequence(0, {parts - 1}), p -> _books[p][{byte}]))")
    ).drop("_books")


def with_label_errors(codes: DataFrame) -> DataFrame:
    """codes with label_error: the error summed over the rows of the label, nulls together; joined by label."""
    per_label = codes.groupBy(F.col("label").alias("l")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("s"), F.count_if(F.col("error").isNull()).alias("lost")
    )
    total = F.when(F.col("lost") == 0, F.col("s")).cast("decimal(38,0)")
    per_label = per_label.select("l", F.when(total <= F.lit(2**63 - 1), total).cast("long").alias("label_error"))
    return codes.join(per_label, F.col("label").eqNullSafe(F.col("l"))).drop("l")
