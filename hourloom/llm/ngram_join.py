"""N-gram Jaccard join with adaptive multi-match prefixes.

Two texts link when their sets of n-word shingles have at least ``percent`` % Jaccard similarity. Shingles have one
global order, rare first, from a count sketch of fixed size. If two sets link, then for every k their prefixes of
``size - ceil(percent * size) + k`` shingles share k of them. Every text picks the k, and so the length of its
prefix, that costs least by the estimated number of candidates; a pair is verified if it shares the smaller k of the
two in its prefixes. Verification first bounds the overlap by the sets' counts per hash bucket, a byte for each, and
compares the whole sets of the pairs that may still link. Both are made from the texts of these pairs when they are
needed; of the other texts on shared lists only a bitmap is kept.

Only classes are asked for, so a pair inside one known component needs no verification. Texts with equal sets become
one vertex first. Rounds then compare each vertex with random leaders of its prefix lists, which joins large groups
of near copies by few pairs; at last every pair that is left between different components is looked at.

Defined cases: null or empty text, or text without words, has an empty set and links with nothing; fewer words than n
are one shingle; rows with a null id are classed by their text but never name a class; rows are compared by text, so an
id that is repeated with another text links nothing, and may name a class twice; ids are whole numbers, or text that reads
as one; an empty table gives no rows; other columns are not read. Shingles are 64-bit hashes, so
different shingles are taken as equal with a chance of 2**-64 a pair.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm import words
from hourloom.llm.components import components
from hourloom.llm.storage import bounded_batches, discard, stored

#: Counters of the sketch of shingle frequencies (2 bytes each): the size of what is broadcast, whatever the input.
SKETCH_BITS = 24
CHUNK_BITS = 18
FULL = (1 << 16) - 1
#: Longest multi-match that a text may choose.
DEEPEST = 6
#: Partial sketches that are added before the rest of them is.
ADDED = 16
#: Bits of each half of the filter that tells which texts a verification reads: by id, and by id and set.
FILTER_BITS = 24
#: Rounds of leaders at most; they end when one links less than this share of what the first did.
ROUNDS, WORTH = 6, 0.2
#: Leaders of a long list, the length from which it is one, and leaders that a vertex is compared with in a round.
LEADERS, LONG, TRIED = 8, 16, 16

#: Words of the bitmap of buckets that a set occupies, and of the narrow one that it is folded to for short lists.
WORDS, NARROW = 32, 8
#: A pair of vertices: the smallest id of equal texts, and a fingerprint of their set.
PAIR = ("id", "f1", "n", "id_b", "f1_b", "n_b")

_SEED_1, _SEED_2 = words.scrambled(2, 40)


def text_sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for block in words.blocks(batch.column("text"), lower=True):
        for row, own in block.rows():
            yield row, words.shingle_set(block.hashes[own], n)


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    both = (words.mix(s ^ seed).sum(dtype=np.uint64) for seed in (_SEED_1, _SEED_2))
    return tuple(int(x.astype(np.int64)) for x in both)


def slots(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def counted(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Counters of the partition, in compressed chunks."""
    total, waiting, held = np.zeros(1 << SKETCH_BITS, dtype=np.uint16), [], 0

    def count():
        slot, times = np.unique(np.concatenate(waiting), return_counts=True)
        total[slot] = np.minimum(total[slot] + times, FULL)  # counters stop at the top

    for batch in batches:
        for _, s in text_sets(batch, n):
            waiting.append(slots(s))
            held += len(s)
            if held > 1 << 20:
                count()
                waiting, held = [], 0
    if waiting:
        count()
    yield from chunk_rows({i: c for i, c in enumerate(np.split(total, 1 << (SKETCH_BITS - CHUNK_BITS))) if c.any()})


def chunk_rows(chunks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for i, c in chunks.items():
        data = zlib.compress(c.tobytes(), 1)
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([i], pa.int32()), "data": pa.array([data], pa.binary())})


def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunks: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, data in zip(batch.column("chunk").to_pylist(), batch.column("data").to_pylist()):
            c = np.frombuffer(zlib.decompress(data), dtype=np.uint16)
            chunks[i] = np.minimum(chunks[i].astype(np.uint32) + c, FULL).astype(np.uint16) if i in chunks else c
    yield from chunk_rows(chunks)


def frequencies(docs: DataFrame, n: int) -> np.ndarray:
    """The sketch: how many texts have a shingle of each slot. Partial sketches are added in two levels."""
    schema = "chunk int, data binary"
    part = docs.select("text").mapInArrow(lambda it: counted(it, n), schema)
    lanes = 1 << (SKETCH_BITS - CHUNK_BITS)
    part = part.withColumn("lane", F.floor(F.spark_partition_id() / ADDED)).repartition(lanes, "chunk", "lane")
    whole = part.select("chunk", "data").mapInArrow(summed, schema).repartition(lanes, "chunk").mapInArrow(summed, schema)
    out = np.zeros(1 << SKETCH_BITS, dtype=np.uint16)
    for row in whole.collect():
        out[row.chunk << CHUNK_BITS : (row.chunk + 1) << CHUNK_BITS] = np.frombuffer(zlib.decompress(row.data), np.uint16)
    return out


def median(counts: np.ndarray) -> float:
    """Of an even number of counters, without a copy of them."""
    held = np.zeros(FULL + 1, dtype=np.int64)
    for part in np.split(counts, 1 << (SKETCH_BITS - CHUNK_BITS)):
        held += np.bincount(part, minlength=FULL + 1)
    half = len(counts) // 2
    return float(np.searchsorted(np.cumsum(held), (half, half + 1)).mean())


def adaptive_prefix(s: np.ndarray, counts: np.ndarray, noise: float, percent: int) -> tuple[int, np.ndarray]:
    """How many prefix shingles a partner must share, and the prefix."""
    load = counts[slots(s)]
    order = np.argsort(load, kind="stable")
    need = -(-percent * len(s) // 100)
    depth = np.arange(1, min(DEEPEST, need) + 1)
    length = len(s) - need + depth
    others = np.cumsum(np.maximum(load[order[: length[-1]]] - noise, 0.0))[length - 1]
    # rows of pairs to count, and sets to compare: of texts met ``others`` times, others / depth at most are met depth times
    cost = others * (1 + len(s) / (5 * depth))
    k = int(np.argmin(cost))
    return int(depth[k]), s[order[: length[k]]]


def prefix_rows(batches: Iterable[pa.RecordBatch], sketch, n: int, percent: int) -> Iterator[pa.RecordBatch]:
    counts, noise = sketch.value
    kinds = {"n": pa.int64(), "f1": pa.int64(), "f2": pa.int64(), "k": pa.int32(), "prefix": pa.list_(pa.int64())}
    for batch in batches:
        rows: list[tuple] = []

        def flush():
            at, *values, there = zip(*rows)
            out = {c: batch.column(c).take(pa.array(at, pa.int64())) for c in ("doc_id", "text_hash")}
            out |= {c: pa.array(v, t) for (c, t), v in zip(kinds.items(), values)}
            return pa.RecordBatch.from_pydict(out | {f"b{i}": pa.array(v) for i, v in enumerate(np.stack(there, axis=1))})

        for row, s in text_sets(batch, n):
            k, prefix = adaptive_prefix(s, counts, noise, percent) if len(s) else (0, s)
            rows.append((row, len(s), *fingerprint(s), k, words.as_signed(prefix), presence(s)))
            if len(rows) == 1024:
                yield flush()
                rows = []
        if rows:
            yield flush()


def shared_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of their shingle, those whose shingle another row has too; held back is one row at most."""
    last = None  # the newest row, if it may still be alone
    token = None
    for batch in batches:
        t = batch.column("token").to_numpy()
        if not len(t):
            continue
        same = np.empty(len(t), dtype=bool)
        same[1:] = t[1:] == t[:-1]
        same[0] = token is not None and t[0] == token
        keep = same.copy()
        keep[:-1] |= same[1:]
        if last is not None and same[0]:
            yield last
        last = None if keep[-1] else batch.slice(len(t) - 1)
        token = t[-1]
        yield batch.filter(pa.array(keep))


def vertex_slots(ids: np.ndarray, f1: np.ndarray) -> np.ndarray:
    """1 .. 2**FILTER_BITS, as bitmap positions begin at 1."""
    hashed = words.mix(ids.view(np.uint64) * words.ODD ^ f1.view(np.uint64))
    return (hashed & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64) + 1


def id_slots(ids: np.ndarray) -> np.ndarray:
    """The half after that of vertices."""
    return vertex_slots(ids, np.zeros_like(ids)) + (1 << FILTER_BITS)


def inside(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[(slots - 1) >> 3] >> ((slots - 1) & 7)) & 1 > 0


def bucket_counts(s: np.ndarray) -> bytes:
    """How many shingles fall into each bucket, for at least as many buckets as shingles; 255 counts as unbounded."""
    bits = max(3, int(len(s) - 1).bit_length())
    return np.minimum(np.bincount((s & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def presence(s: np.ndarray) -> np.ndarray:
    """Which of ``64 * WORDS`` buckets the set occupies, as signed words."""
    there = np.zeros(64 * WORDS, dtype=bool)
    there[((s >> np.uint64(20)) % np.uint64(64 * WORDS)).astype(np.int64)] = True
    return np.packbits(there, bitorder="little").view(np.int64)


def overlap_bound(a: bytes, b: bytes) -> int:
    """No two sets with these bucket counts share more."""
    x, y = (np.frombuffer(v, dtype=np.uint8).astype(np.int64) for v in (a, b))
    for v in (x, y):
        v[v == 255] = 1 << 40
    while len(x) > len(y):
        x = x[: len(x) // 2] + x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] + y[len(y) // 2 :]
    return int(np.minimum(x, y).sum())


def set_rows(batches: Iterable[pa.RecordBatch], wanted, n: int, of, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """``of`` the sets of the vertices in the filter; no text is hashed whose id is not in it."""
    bits = wanted.value
    for batch in batches:
        batch = batch.filter(pa.array(inside(bits, id_slots(batch.column("doc_id").to_numpy()))))
        ids = batch.column("doc_id").to_numpy()
        rows: list[tuple] = []

        def flush():
            columns = zip(("id", "f1", "a"), zip(*rows), (pa.int64(), pa.int64(), kind))
            return pa.RecordBatch.from_pydict({c: pa.array(v, t) for c, v, t in columns})

        for row, s in text_sets(batch, n):
            if not len(s):
                continue
            f = fingerprint(s)[0]
            if inside(bits, vertex_slots(ids[row : row + 1], np.array([f])))[0]:
                rows.append((ids[row], f, of(s)))
            if len(rows) == 256:
                yield flush()
                rows = []
        if rows:
            yield flush()


def slot_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, f1 = batch.column("id").to_numpy(), batch.column("f1").to_numpy()
        for got in (vertex_slots(ids, f1), id_slots(ids)):
            yield pa.RecordBatch.from_pydict({"slot": pa.array(got, pa.int64())})


def hit_rows(batches: Iterable[pa.RecordBatch], wanted, hit: bool = True) -> Iterator[pa.RecordBatch]:
    """The rows whose vertex is in the filter, or those whose vertex is not."""
    for batch in batches:
        slots = vertex_slots(batch.column("id").to_numpy(), batch.column("f1").to_numpy())
        yield batch.filter(pa.array(inside(wanted.value, slots) == hit))


def possible_rows(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, m = batch.column("n").to_numpy(), batch.column("n_b").to_numpy()
        pairs = zip(batch.column("a"), batch.column("b"))
        most = np.array([overlap_bound(a.as_py(), b.as_py()) for a, b in pairs], dtype=np.int64)
        keep = pa.array(100 * most >= percent * (n + m - np.minimum(most, n + m)), pa.bool_())
        yield batch.select(["id", "f1", "id_b", "f1_b"]).filter(keep)


def filter_bits(vertices: DataFrame) -> np.ndarray:
    """A bitmap of the hashed vertices, of fixed size, put together on the executors."""
    slot = vertices.select("id", "f1").mapInArrow(slot_rows, "slot long")
    rows = slot.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    out = np.zeros(1 << (FILTER_BITS - 2), dtype=np.uint8)
    for row in rows.collect():
        lo = (row.bucket - 1) * 4096
        out[lo : lo + 4096] = np.frombuffer(bytes(row.bits), np.uint8)
    return out


class Join:
    """One run of the join: the stage tables and what is linked so far."""

    def __init__(self, docs: DataFrame, n: int, percent: int):
        bounded_batches(docs.sparkSession)
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.n, self.percent = n, percent
        spark = docs.sparkSession
        counts = frequencies(self.docs, n)
        # what unrelated shingles add to a counter, and the text itself
        sketch = spark.sparkContext.broadcast((counts, median(counts) + 1))
        del counts
        bits = [f"b{i}" for i in range(WORDS)]
        rows = self.docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
            lambda it: prefix_rows(it, sketch, n, percent),
            "doc_id long, text_hash long, n long, f1 long, f2 long, k int, prefix array<long>" + "".join(f", {b} long" for b in bits),
        )
        prefixes = stored(rows, "prefixes")
        sketch.destroy()
        self.signed = stored(prefixes.drop("k", "prefix", *bits), "signed")
        rows = prefixes.where("n > 0 and doc_id is not null")
        least = rows.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("id"), F.first("k").alias("k"), F.count("*").alias("copies"))
        self.vertices = stored(least, "vertices")
        shared = self.shared_entries(rows.select(F.lit(0).cast("long").alias("id"), "f1", "f2", "n", "prefix"))
        self.lists = stored(shared.join(self.vertices.select("id", "f1", "n", "k"), "f1"), "lists")
        discard(shared)
        wanted = spark.sparkContext.broadcast(filter_bits(self.lists))
        sets = rows.select(F.col("doc_id").alias("id"), "f1", *bits)
        self.sets = stored(sets.mapInArrow(lambda it: hit_rows(it, wanted), sets.schema), "sets")
        wanted.destroy()
        discard(prefixes)
        self.links: list[DataFrame] = []
        self.classes: DataFrame | None = None

    def shared_entries(self, rows: DataFrame) -> DataFrame:
        """(f1, token) of the prefixes, each set once, where another set has the token; id is no part of what is told apart."""
        copied = filter_bits(self.vertices.where("copies > 1").select(F.lit(0).cast("long").alias("id"), "f1"))
        copied = rows.sparkSession.sparkContext.broadcast(copied)
        # only sets that several rows may have are shuffled to be made one
        alone = rows.mapInArrow(lambda it: hit_rows(it, copied, False), rows.schema)
        several = rows.mapInArrow(lambda it: hit_rows(it, copied), rows.schema)
        several = several.groupBy("f1", "f2", "n").agg(F.first("prefix").alias("prefix"))
        entries = alone.select("f1", "prefix").union(several.select("f1", "prefix"))
        entries = entries.select("f1", F.explode("prefix").alias("token"))
        entries = entries.repartition("token").sortWithinPartitions("token")
        shared = stored(entries.mapInArrow(shared_lists, entries.schema), "shared")
        copied.destroy()
        return shared

    def size_fits(self, a: str, b: str):
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def open_lists(self) -> DataFrame:
        """The lists that span components, each row with its component and its list's size; a closed list never opens again."""
        rows = self.lists
        if self.classes is not None:
            rows = rows.join(self.classes, "f1", "left").withColumn("component", F.coalesce("component", "f1"))
        else:
            rows = rows.withColumn("component", F.col("f1"))
        span = rows.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"))
        before, rows = self.lists, stored(rows.join(span.where("lo < hi").select("token", "size"), "token"), "open")
        discard(before)
        self.lists = rows.drop("component", "size")
        return rows

    def leader_pairs(self, seed: int) -> DataFrame:
        """Each vertex with the leaders of other components that it shares most lists with."""
        rows = self.open_lists()
        if seed:  # the one pair of a list of two was tried in the first round, or is among the rest
            rows = rows.where("size > 2")
        drawn = [
            F.min(F.struct(F.xxhash64("id", F.lit(seed * LEADERS + i)), "id", "f1", "n", "component")).alias(f"l{i}")
            for i in range(LEADERS)
        ]
        # most lists are short and have one leader
        first = rows.where(F.col("size") <= LONG).groupBy("token").agg(drawn[0]).select("token", F.array("l0").alias("leaders"))
        many = rows.where(F.col("size") > LONG).groupBy("token").agg(*drawn)
        first = first.union(many.select("token", F.array(*(f"l{i}" for i in range(LEADERS)))))
        pairs = rows.join(first, "token").withColumn("l", F.explode("leaders")).drop("leaders")
        pairs = pairs.where("component <> l.component").where(self.size_fits("n", "l.n"))
        leader = [F.col(f"l.{c}").alias(f"{c}_b") for c in ("id", "f1", "n")]
        pairs = pairs.groupBy("id", "f1", "n", *leader).agg(F.count("*").alias("shared"))
        best = Window.partitionBy("id", "f1").orderBy(F.desc("shared"), "id_b", "f1_b")
        return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TRIED).select(*PAIR)

    def rest_pairs(self) -> DataFrame:
        """All pairs across components that share enough: one side is outside its list's largest component.

        Pairs are dropped before they are made if their bitmaps say so: a bucket that only one set occupies holds a
        shingle that the other lacks. The texts of a family meet on many long lists with nearly the same members. Long lists
        with one leader are therefore joined as one, each text once with all its shingles on them, and with a wider bitmap.
        """
        rows = self.open_lists()
        narrow = [F.expr("|".join(f"b{j}" for j in range(i, WORDS, NARROW))).alias(f"b{i}") for i in range(NARROW)]
        wide = F.array(*(f"b{i}" for i in range(WORDS))).alias("wide")
        sets = self.sets.select("id", "f1", *narrow, wide).dropDuplicates(["id", "f1"])
        short = rows.where(F.col("size") <= LONG).drop("size").join(sets.drop("wide"), ["id", "f1"])
        short = self.across(short, "token").withColumn("shared", F.lit(1))
        long = rows.where(F.col("size") > LONG).drop("size")
        drawn = F.min(F.struct(F.xxhash64("id"), F.col("f1"))).getField("f1")
        long = long.join(long.groupBy("token").agg(drawn.alias("lead")), "token")
        long = long.groupBy("lead", "id", "f1", "n", "k", "component")
        long = self.across(long.agg(F.collect_list("token").alias("tokens")).join(sets, ["id", "f1"]), "lead")
        lack = lambda x, y: f"aggregate(zip_with(wide{x}, wide{y}, (v, w) -> bit_count(v & ~w)), 0, (t, v) -> t + v)"
        long = self.may_link(long, lack).withColumn("shared", F.size(F.array_intersect("tokens", "tokens_b")))
        # the largest component differs from list to list, so one pair comes in both orders; it is counted in one
        ends = [F.struct(*(F.col(f"{c}{side}").alias(c) for c in ("id", "f1", "n"))) for side in ("", "_b")]
        ends = (F.least(*ends).alias("a"), F.greatest(*ends).alias("b"), F.least("k", "k_b").alias("k"), F.col("shared"))
        pairs = short.select(*ends).union(long.where("shared > 0").select(*ends))
        named = [F.col(f"{e}.{c}").alias(f"{c}{s}") for e, s in (("a", ""), ("b", "_b")) for c in ("id", "f1", "n")]
        pairs = pairs.select(*named, "k", "shared").groupBy(*PAIR).agg(F.sum("shared").alias("shared"), F.min("k").alias("k"))
        return pairs.where("shared >= k").select(*PAIR)

    def across(self, rows: DataFrame, key: str) -> DataFrame:
        """The pairs across components of the rows of each key that sizes and bitmaps do not rule out."""
        sizes = rows.groupBy(key, "component").agg(F.count("*").alias("size"))
        major = sizes.groupBy(key).agg(F.max_by("component", F.struct("size", "component")).alias("major"))
        rows = rows.join(major, key)
        names = [c for c in rows.columns if c not in (key, "major")]
        minor = rows.where("component <> major").select(key, *(F.col(c).alias(f"{c}_b") for c in names))
        pairs = minor.join(rows, key).where("component_b <> component")
        pairs = pairs.where("component = major or (id_b, f1_b) < (id, f1)").where(self.size_fits("n", "n_b"))
        return self.may_link(pairs, lambda x, y: "+".join(f"bit_count(b{i}{x} & ~b{i}{y})" for i in range(NARROW)))

    def may_link(self, pairs: DataFrame, lack) -> DataFrame:
        """``lack``: an expression of how many shingles of one side the other lacks at least."""
        same = F.least(F.expr(f"n - ({lack('', '_b')})"), F.expr(f"n_b - ({lack('_b', '')})"))
        return pairs.where(same * 100 >= (F.col("n") + F.col("n_b") - same) * self.percent)

    def sets_of(self, pairs: DataFrame, of, kind: pa.DataType, name: str) -> DataFrame:
        """(id, f1, a) of few more sets than those of the pairs, made from their texts."""
        ends = pairs.select("id", "f1").union(pairs.select("id_b", "f1_b"))
        wanted = pairs.sparkSession.sparkContext.broadcast(filter_bits(ends))
        texts, n = self.docs.where("doc_id is not null"), self.n
        sets = texts.mapInArrow(lambda it: set_rows(it, wanted, n, of, kind), f"id long, f1 long, a {name}")
        sets = stored(sets, "ends")
        wanted.destroy()
        return sets

    def verify(self, pairs: DataFrame) -> int:
        """Compare whole sets; returns how many pairs link."""
        near = stored(pairs, "near")
        if near.isEmpty():
            return 0
        counts = self.sets_of(near, bucket_counts, pa.binary(), "binary")
        both = near.join(counts, ["id", "f1"]).join(counts.toDF("id_b", "f1_b", "b"), ["id_b", "f1_b"])
        percent = self.percent
        pairs = both.select(*PAIR, "a", "b").mapInArrow(
            lambda it: possible_rows(it, percent), "id long, f1 long, id_b long, f1_b long"
        )
        pairs = stored(pairs.distinct(), "pairs")
        discard(near, counts)
        if pairs.isEmpty():
            return 0
        sets = self.sets_of(pairs, words.as_signed, pa.list_(pa.int64()), "array<long>")
        both = pairs.join(sets, ["id", "f1"])
        both = both.join(sets.toDF("id_b", "f1_b", "b"), ["id_b", "f1_b"])
        same = F.size(F.array_intersect("a", "b"))
        both = both.select("f1", "f1_b", same.alias("same"), (F.size("a") + F.size("b") - same).alias("either"))
        linked = both.where(F.col("same") * 100 >= F.col("either") * self.percent)
        linked = stored(linked.select(F.col("f1").alias("a"), F.col("f1_b").alias("b")).distinct(), "links")
        discard(pairs, sets)
        found = linked.count()
        if found:
            self.links.append(linked)
            # vertices are told apart by their fingerprint, as ids may be repeated
            self.classes = components(reduce(DataFrame.union, self.links)).withColumnRenamed("id", "f1")
        return found

    def run(self) -> DataFrame:
        most = 0
        for seed in range(ROUNDS):
            found = self.verify(self.leader_pairs(seed))
            most = most or found
            if found <= WORTH * most:
                break
        self.verify(self.rest_pairs())
        discard(self.sets, self.lists)
        own = self.vertices.select("f1", "f2", "n", "id")
        own = own.withColumns({"class": F.col("f1"), "component_id": F.col("id")})
        if self.classes is not None:
            own = own.join(self.classes, "f1", "left").withColumn("class", F.coalesce("component", "f1"))
            own = stored(own.drop("component", "component_id"), "own")
            # only classes of several vertices have another name than their vertex
            least = own.where("class <> f1").select("class").distinct().join(own, "class")
            least = least.groupBy("class").agg(F.min("id").alias("least"))
            own = own.join(least, "class", "left").withColumn("component_id", F.coalesce("least", "id"))
        out = self.signed.join(own.select("f1", "f2", "n", "class", "component_id"), ["f1", "f2", "n"], "left")
        return out.select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
            "text_hash",
            F.coalesce("class", "f1").alias("class"),
        )


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id that links reach) for every row of (doc_id, text)."""
    return row_classes(docs, n, percent).select("doc_id", "n_shingles", "component_id")


def row_classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Besides, text_hash (xxhash64 of the row's text), and class, which tells classes apart where ids are repeated."""
    return Join(docs, n, percent).run()
