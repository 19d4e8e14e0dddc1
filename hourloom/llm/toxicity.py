"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its words, word pairs and pairs with one or two words between, lower-cased and without
punctuation, each hashed to one of 2**24 slots. Coordinates are the slots that at least three rows of the sample fill, counted
by counters of fixed size; no number of them is kept or cut beyond that. The fit uses a bounded sample of labelled rows, dealt to
shards; in every round each shard runs FTRL (per-coordinate rates, L1) over its rows from the shared state, and the changes are
shuffled by parts of the state and averaged there; the driver holds the state and the average change of one part at a time.
L1 leaves few weights, which are broadcast; scoring reads every whole text once.

Defined cases: null or empty text scores the intercept; rows without a label or with a null label do not train;
an id with several labels counts as 1 if any is 1; without both labels the score is the smoothed share of label 1;
repeated rows score alike; an empty table gives no rows; no column but the text is an input of the score.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from hourloom.llm import words
from hourloom.llm.storage import bounded_batches, discard, stored

#: Distances of the words of a feature: words, pairs, pairs with a gap.
SHAPES = ((0,), (0, 1), (0, 2), (0, 3))
#: Labelled rows that the fit reads at most (about half of each label).
MAX_ROWS = 12_000
#: Features are hashed to 2**SLOT_BITS slots; their counters travel in chunks.
SLOT_BITS, CHUNK_BITS = 24, 18
#: Training rows that must have a feature.
LEAST_ROWS = 3
SHARDS, ROUNDS = 8, 5
ALPHA, BETA, L1, L2 = 4.0, 1.0, 1.0, 0.1


@dataclass
class Model:
    """Sorted slots of features, their weights, and the intercept."""

    keys: np.ndarray
    weights: np.ndarray
    intercept: float

    def gate(self) -> np.ndarray:
        """Whether each slot has a weight."""
        out = np.zeros(1 << SLOT_BITS, dtype=bool)
        out[self.keys] = True
        return out


def block_slots(block: words.Block, usual: np.ndarray | None, live: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row number within the block, slot of a feature), in order.

    usual: the slots of the words that pairs are made of, all words if None; live: the slots wanted, all if None.
    """
    row = np.repeat(np.arange(len(block.counts)), block.counts)
    known, got = None, []
    for shape in SHAPES:
        slot = (words.grams(block.hashes, shape) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        inside = row[: len(slot)] == row[shape[-1] : shape[-1] + len(slot)]
        if usual is not None:
            if known is None:
                known = usual[slot]
            for p in shape:
                inside &= known[p : p + len(slot)]
        if live is not None:
            inside &= live[slot]
        got.append((row[: len(slot)][inside] << SLOT_BITS) | slot[inside])
    both = np.unique(np.concatenate(got))
    return both >> SLOT_BITS, both & ((1 << SLOT_BITS) - 1)


def word_slots(block: words.Block) -> tuple[np.ndarray, np.ndarray]:
    """As block_slots, of words alone."""
    row = np.repeat(np.arange(len(block.counts)), block.counts)
    slot = (words.grams(block.hashes, SHAPES[0]) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    both = np.unique((row << SLOT_BITS) | slot)
    return both >> SLOT_BITS, both & ((1 << SLOT_BITS) - 1)


def counted(batches: Iterable[pa.RecordBatch], usual) -> Iterator[pa.RecordBatch]:
    """How many rows of the partition fill each slot, up to LEAST_ROWS, in compressed chunks."""
    total = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
    pairs_of = None if usual is None else unpacked(usual.value)
    for batch in batches:
        for block in words.blocks(batch.column("text"), words.LETTERS, lower=True):
            _, slot = word_slots(block) if usual is None else block_slots(block, pairs_of, None)
            slot, times = np.unique(slot, return_counts=True)
            total[slot] = np.minimum(total[slot] + times, LEAST_ROWS)
    yield from chunk_rows({i: c for i, c in enumerate(np.split(total, 1 << (SLOT_BITS - CHUNK_BITS))) if c.any()})


def chunk_rows(chunks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for i, c in chunks.items():
        data = zlib.compress(c.tobytes(), 1)
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([i], pa.int32()), "data": pa.array([data], pa.binary())})


def filled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of the slots whose counters add up to LEAST_ROWS."""
    chunks: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, data in zip(batch.column("chunk").to_pylist(), batch.column("data").to_pylist()):
            c = np.frombuffer(zlib.decompress(data), dtype=np.uint8)
            chunks[i] = np.minimum(chunks[i] + c, LEAST_ROWS) if i in chunks else c
    yield from chunk_rows({i: np.packbits(c >= LEAST_ROWS) for i, c in chunks.items()})


def frequent(texts: DataFrame, usual=None) -> np.ndarray:
    """A bitmap of the slots that at least LEAST_ROWS rows fill: 2 MB, whatever the texts."""
    schema = "chunk int, data binary"
    part = texts.select("text").mapInArrow(lambda it: counted(it, usual), schema)
    out = np.zeros(1 << (SLOT_BITS - 3), dtype=np.uint8)
    step = 1 << (CHUNK_BITS - 3)
    for row in part.repartition(SHARDS, "chunk").mapInArrow(filled, schema).collect():
        out[row.chunk * step : (row.chunk + 1) * step] = np.frombuffer(zlib.decompress(row.data), np.uint8)
    return out


def unpacked(bitmap: np.ndarray) -> np.ndarray:
    return np.unpackbits(bitmap).view(bool)


def labelled_sample(labels: DataFrame, max_rows: int) -> tuple[DataFrame, dict[int, tuple[int, float]]]:
    """At most about max_rows labelled ids, and for each label its rows and the share that is taken."""
    one = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    few = min(totals.values(), default=0) if len(totals) == 2 else 0
    room = max(max_rows // 2, max_rows - few)
    share = {k: (n, min(1.0, (few if n == few and few <= max_rows // 2 else room) / n)) for k, n in totals.items()}
    deal = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30))
    limit = F.lit(0)
    for k, (_, s) in share.items():
        limit = F.when(F.col("toxic") == k, int(s * (1 << 30))).otherwise(limit)
    return one.withColumn("deal", deal).where(F.col("deal") < limit), share


def ftrl(rows: list[tuple[int, np.ndarray]], z: np.ndarray, n: np.ndarray, bias: list[float]) -> None:
    """One pass; z, n and bias (its z and n) change in place."""
    for y, at in rows:
        zi, ni = z[at], n[at]
        root = np.sqrt(ni)
        w = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + root) / ALPHA + L2))
        b = -bias[0] / ((BETA + bias[1] ** 0.5) / ALPHA)
        g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - y
        z[at] = zi + g - (np.sqrt(ni + g * g) - root) / ALPHA * w
        n[at] = ni + g * g
        bias[0] += g - ((bias[1] + g * g) ** 0.5 - bias[1] ** 0.5) / ALPHA * b
        bias[1] += g * g


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Learn from labels (doc_id, toxic) on docs (doc_id, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sample, share = labelled_sample(labels, max_rows)
    if len(share) < 2:
        n, positive = sum(c for c, _ in share.values()), share.get(1, (0, 0))[0]
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log((positive + 0.5) / (n - positive + 0.5))))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # the sample has max_rows short rows at most
    texts = texts.join(F.broadcast(stored(sample, "sample")), "doc_id").select("text", "toxic", "deal")
    texts = texts.withColumn("shard", F.pmod(F.xxhash64("deal"), F.lit(SHARDS)))
    texts = stored(texts.repartition(SHARDS, "shard"), "texts")
    # a pair of words is no more frequent than either, so pairs are looked for among frequent words only
    usual = spark.sparkContext.broadcast(frequent(texts))
    live = spark.sparkContext.broadcast(frequent(texts, usual))

    def coordinates(batches):
        pairs_of, wanted = unpacked(usual.value), unpacked(live.value)
        known = np.flatnonzero(wanted)
        for batch in batches:
            for block in words.blocks(batch.column("text"), words.LETTERS, lower=True):
                row, slot = block_slots(block, pairs_of, wanted)
                edges = np.searchsorted(row, np.arange(len(block.counts) + 1))
                at = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.searchsorted(known, slot), pa.int32()))
                same = [batch.column(c).slice(block.lo, block.hi - block.lo) for c in ("shard", "deal", "toxic")]
                yield pa.RecordBatch.from_arrays([*same, at], names=["shard", "deal", "toxic", "at"])

    # a file for each shard, read again in every round without a shuffle
    rows = stored(texts.mapInArrow(coordinates, "shard long, deal long, toxic int, at array<int>"), "rows")
    wanted = live.value
    size = int(unpacked(wanted).sum())
    discard(texts)
    for shared in (usual, live):
        shared.destroy()

    # the coordinates of each part of the state, of which there are as many as shards
    edges = [size * i // SHARDS for i in range(SHARDS + 1)]
    z, n, bias = np.zeros(size, np.float32), np.zeros(size, np.float32), [0.0, 0.0]
    for _ in range(ROUNDS):
        state = spark.sparkContext.broadcast((z, n, bias))

        def one_pass(batches):
            shards = defaultdict(list)
            for batch in batches:
                at, deal, toxic = batch.column("at"), batch.column("deal").to_pylist(), batch.column("toxic").to_pylist()
                own = np.split(at.values.to_numpy(), at.offsets.to_numpy()[1:-1])
                for i, shard in enumerate(batch.column("shard").to_pylist()):
                    shards[shard].append((deal[i], toxic[i], own[i]))
            z0, n0, b0 = state.value
            for place, own in enumerate(shards.values()):
                z1, n1, b1 = z0.copy(), n0.copy(), list(b0)
                own.sort(key=lambda r: (*r[:2], r[2].tobytes()))
                ftrl([r[1:] for r in own], z1, n1, b1)
                moved = (z1 != z0) | (n1 != n0)
                for part, (lo, hi) in enumerate(zip(edges, edges[1:])):
                    at = moved[lo:hi]
                    parts = (np.packbits(at), (z1[lo:hi] - z0[lo:hi])[at], (n1[lo:hi] - n0[lo:hi])[at])
                    row = {k: pa.array([v.tobytes()], pa.binary()) for k, v in zip(("at", "dz", "dn"), parts)}
                    row |= {k: pa.array([b1[i] - b0[i]], pa.float64()) for i, k in enumerate(("bz", "bn"))}
                    order = (("part", part), ("task", TaskContext.get().partitionId()), ("place", place))
                    yield pa.RecordBatch.from_pydict(row | {k: pa.array([v], pa.int32()) for k, v in order})

        def averaged(batches):
            parts = defaultdict(list)
            for batch in batches:
                for row in batch.to_pylist():
                    parts[row["part"]].append(row)
            z0, n0, b0 = state.value
            for part, own in parts.items():
                lo, hi = edges[part], edges[part + 1]
                z1, n1, b1 = z0[lo:hi].copy(), n0[lo:hi].copy(), list(b0)
                for row in sorted(own, key=lambda r: (r["task"], r["place"])):  # sums of floats depend on the order
                    at = np.unpackbits(np.frombuffer(row["at"], np.uint8), count=hi - lo).view(bool)
                    z1[at] += np.frombuffer(row["dz"], np.float32) / len(own)
                    n1[at] += np.frombuffer(row["dn"], np.float32) / len(own)
                    b1 = [b1[0] + row["bz"] / len(own), b1[1] + row["bn"] / len(own)]
                # in doubles, the difference added to the old state gives the new one exactly
                sums = (np.subtract(v, u[lo:hi], dtype=np.float64) for v, u in ((z1, z0), (n1, n0)))
                row = {k: pa.array([v.tobytes()], pa.binary()) for k, v in zip(("dz", "dn"), sums)}
                row |= {"part": pa.array([part], pa.int32()), "bias": pa.array([b1], pa.list_(pa.float64()))}
                yield pa.RecordBatch.from_pydict(row)

        # every shard has a row for each part, with 8 bytes for each coordinate that its rows have
        schema = "at binary, dz binary, dn binary, bz double, bn double, part int, task int, place int"
        changes = rows.mapInArrow(one_pass, schema).repartition(SHARDS, "part")
        # a row for each part, however many the shards
        changes = stored(changes.mapInArrow(averaged, "dz binary, dn binary, part int, bias array<double>"), "changes")
        state.destroy()
        for part, (lo, hi) in enumerate(zip(edges, edges[1:])):
            for row in changes.where(F.col("part") == part).collect():
                z[lo:hi] += np.frombuffer(row["dz"], np.float64)
                n[lo:hi] += np.frombuffer(row["dn"], np.float64)
                bias = list(row["bias"])
        discard(changes)
    discard(rows)
    w = np.concatenate([weights(z[lo:hi], n[lo:hi]) for lo, hi in zip(edges, edges[1:])])
    intercept = -bias[0] / ((BETA + bias[1] ** 0.5) / ALPHA)
    intercept += float(np.log(share[0][1] / share[1][1]))  # the sample has more of the rare label than the corpus
    kept = np.flatnonzero(w)
    return Model(np.flatnonzero(unpacked(wanted))[kept], w[kept], float(intercept))


def score_batch(text, model: Model, gate: np.ndarray) -> np.ndarray:
    out = []
    for block in words.blocks(text, words.LETTERS, lower=True):
        total = np.full(len(block.counts), model.intercept)
        row, slot = block_slots(block, None, gate)
        np.add.at(total, row, model.weights[np.searchsorted(model.keys, slot)])
        out.append(total)
    return 1 / (1 + np.exp(-np.concatenate(out))) if out else np.zeros(0)


def with_scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with the score of every row's whole text; ``name`` must be new."""
    if name in docs.columns:
        raise ValueError(f"docs has a column {name} already")
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        gate = shared.value.gate()
        for batch in batches:
            values = score_batch(batch.column("text"), shared.value, gate)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(scored, StructType([*docs.schema.fields, StructField(name, DoubleType())]))
