"""Whitening of vectors along the leading eigenvectors of their covariance, found by Jacobi-Davidson.

The covariance is never formed. Its product with a block of columns is one Spark job: every task centres its integer
vectors exactly, multiplies them by the block and the result by their transpose, and the small partial products are
added up in a tree of tasks. On top of that, on the driver and only as large as the dimension times the block:

* Rayleigh-Ritz on the searched subspace gives approximate pairs and their residuals.
* Each unconverged pair gets a correction from the projected equation (I-QQ')(V - e I)(I-QQ') t = -r, with Q the
  wanted and locked vectors, by a few steps of MINRES. The pairs of a round step together, so one step of all is one job.
* Corrections extend the subspace; one that has grown too long starts again from its best Ritz vectors.
* The leading pair is locked as soon as its residual is at the rounding error of the products themselves, and the next
  ones are sought beside the locked. In the end all locked vectors and the rest of the subspace are set against each
  other once more, so none is passed over.

At scale: one pass writes the integers as packed blocks, and products read only these. The number of products depends on
the spectrum, not on the rows. Sums and squares are whole numbers in decimals, exact at any size.

Defined cases: vectors that are null, shorter than the longest, or hold null or non-finite components are dropped; with
fewer dimensions than components there are as many components as dimensions; a component without variance (below the
rounding error of the largest) has null ``whitened`` and is left out of ``identity_error``; without any variance
``explained`` is null; a deviation beyond 64 bits is null; components beyond 2^40 after scaling count as 2^40; null and
repeated ids give rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.llm.storage import discard, stored
from hourloom.llm.vectors import matrix, whole_vectors

SCALE, SHIFT, MOST = 1024.0, 100_000, float(1 << 40)
COMPONENTS = 8
#: Rows of a packed block, partial results that one task adds up, MINRES steps of a round, and columns beside the wanted.
BLOCK, FAN_IN, INNER, GUARD = 512, 64, 6, 4
EPS = float(np.finfo(np.float64).eps)


def integers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * values), -MOST, MOST).astype(np.int64) + SHIFT


def packed(vectors: DataFrame, vector: str) -> DataFrame:
    """The integer vectors alone, as stored blocks (width, x) of up to BLOCK rows in little-endian 64-bit integers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(matrix(batch.column(0)))
            cuts = [x[i : i + BLOCK].astype("<i8").tobytes() for i in range(0, len(x), BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]] * len(cuts), pa.int32()), pa.array(cuts, pa.binary())], ["width", "x"])

    return stored(vectors.select(f"`{vector}`").mapInArrow(pack, "width int, x binary"), "blocks")


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for width, x in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield np.frombuffer(x.as_buffer(), "<i8").reshape(-1, width)


@dataclass
class Moments:
    """Exact sums over all rows: the number, and per dimension the sum and the sum of squares."""

    n: int
    sums: list[int]
    squares: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sum, exact: 64-bit integers, or Python's own where these are too small."""
        most = max([*map(abs, self.sums), self.n * int(np.abs(x).max(initial=0))])
        kind = np.int64 if most < 1 << 61 else object
        return self.n * x.astype(kind) - np.array(self.sums, dtype=kind)

    @property
    def trace(self) -> float:
        """Of the covariance."""
        whole = sum(self.n * q - s * s for s, q in zip(self.sums, self.squares))
        return whole / (self.n * self.n) if self.n else 0.0


def moments(blocks: DataFrame) -> Moments:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares = 0, 0, 0
        for x in unpacked(batches):
            kind = np.int64 if np.abs(x).max(initial=0) < 1 << 26 else object
            n, total = n + len(x), total + x.sum(axis=0).astype(object)
            squares = squares + (x.astype(kind) ** 2).sum(axis=0).astype(object)
        if n:
            kind = pa.decimal128(38, 0)
            columns = [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(total), kind), pa.array(list(squares), kind)], ["place", "n", "s", "q"])

    rows = blocks.mapInArrow(partial, "place int, n long, s decimal(38,0), q decimal(38,0)")
    rows = rows.groupBy("place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect()
    rows.sort(key=lambda r: r.place)
    return Moments(rows[0].n if rows else 0, [int(r.s) for r in rows], [int(r.q) for r in rows])


def tree_sum(partial: DataFrame, tasks: int) -> np.ndarray | None:
    """The sum of the arrays of doubles in the one binary column: tasks add up FAN_IN of them each until one is left."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # in the order of their bytes, so that the sum does not depend on which arrived first
        terms = sorted(x for batch in batches for x in batch.column(0).to_pylist())
        if terms:
            total = np.sum([np.frombuffer(t, "<f8") for t in terms], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        partial = partial.repartition(tasks).mapInArrow(added, "part binary")
    rows = partial.collect()
    return np.frombuffer(rows[0].part, "<f8") if rows else None


class Covariance:
    """The covariance of stored blocks as an operator on columns; every product is one pass over the blocks."""

    def __init__(self, blocks: DataFrame, found: Moments):
        self.blocks, self.moments, self.width = blocks, found, len(found.sums)
        self.tasks = blocks.rdd.getNumPartitions()

    def product(self, columns: np.ndarray) -> np.ndarray:
        found, shape = self.moments, columns.shape

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for x in unpacked(batches):
                c = found.centred(x).astype(np.float64) / found.n
                total += c.T @ (c @ columns)
            yield pa.RecordBatch.from_arrays([pa.array([(total / found.n).tobytes()], pa.binary())], ["part"])

        return tree_sum(self.blocks.mapInArrow(partial, "part binary"), self.tasks).reshape(shape)


def orthonormal(columns: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to ``against``; what is only rounding error is left out."""
    kept: list[np.ndarray] = []
    for c in columns.T:
        size = np.linalg.norm(c)
        for _ in range(3):
            for basis in (against, np.array(kept).T.reshape(len(c), -1)):
                c = c - basis @ (basis.T @ c)
        left = np.linalg.norm(c)
        if left > 1e-10 * size and size > 0:
            kept.append(c / left)
    return np.array(kept).T.reshape(len(columns), -1)


def corrections(product, values: np.ndarray, residuals: np.ndarray, outside: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions t of (I-QQ')(V - value I)(I-QQ') t = -residual by MINRES; one column for each value. All
    columns take each step together, with one product of V; a column that is solved, or breaks down, stands still."""

    def projected(x: np.ndarray) -> np.ndarray:
        return x - outside @ (outside.T @ x)

    v = projected(projected(-residuals))
    beta = np.linalg.norm(v, axis=0)
    start = np.where(beta > 0, beta, 1.0)
    v, before = v / start, np.zeros_like(v)
    x, d1, d2 = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    left = beta.copy()
    cos1, sin1, cos2, sin2 = (np.full(v.shape[1], k) for k in (-1.0, 0.0, -1.0, 0.0))
    old = np.zeros_like(beta)
    live = beta > 0
    for _ in range(steps):
        if not live.any():
            break
        w = projected(product(v) - v * values) - old * before
        alpha = np.sum(w * v, axis=0)
        w = projected(w - alpha * v)
        new = np.linalg.norm(w, axis=0)
        # the two rotations before, then the new one that clears the entry below the diagonal
        eps, mid = sin2 * old, -cos2 * old
        delta, gamma = cos1 * mid + sin1 * alpha, sin1 * mid - cos1 * alpha
        root = np.hypot(gamma, new)
        ok = live & (root > EPS * np.abs(alpha).max(initial=1e-300))
        safe = np.where(ok, root, 1.0)
        cos, sin = gamma / safe, new / safe
        d = (v - delta * d1 - eps * d2) / safe
        x = np.where(ok, x + left * cos * d, x)
        left = np.where(ok, left * sin, left)
        d1, d2 = d, d1
        cos2, sin2, cos1, sin1 = cos1, sin1, cos, sin
        before, v, old = v, w / np.where(new > 0, new, 1.0), new
        live = ok & (np.abs(left) > tolerance * start) & (new > EPS * start)
    return projected(x)


def rayleigh_ritz(basis: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values in falling order, the Ritz vectors, and their images."""
    h = basis.T @ image
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], basis @ turn, image @ turn


@dataclass
class Pairs:
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    products: int


def leading_pairs(product, width: int, wanted: int, rows: int, inner: int = INNER, seed: int = 7) -> Pairs:
    """The ``wanted`` largest eigenpairs of the symmetric operator ``product`` on columns of length ``width``.

    A residual is taken as zero when it is no larger than the rounding error of a product: machine precision times the
    norm, times the longer of width and the square root of the rows that a product adds up.
    """
    made = 0

    def counted(columns: np.ndarray) -> np.ndarray:
        nonlocal made
        made += 1
        return product(columns)

    wanted = min(wanted, width)
    most = 6 * (wanted + GUARD)
    inner = inner if width > most else min(inner, 2)  # a subspace that can grow to the whole space needs no fine corrections
    start = np.random.default_rng(seed).standard_normal((width, min(width, wanted + GUARD)))
    locked, locked_image = np.zeros((width, 0)), np.zeros((width, 0))
    basis = orthonormal(start, locked)
    image = counted(basis)
    while True:
        values, vectors, images = rayleigh_ritz(basis, image)
        need = wanted - locked.shape[1]
        residuals = images[:, :need] - vectors[:, :need] * values[:need]
        residuals -= locked @ (locked.T @ residuals)
        norms = np.linalg.norm(residuals, axis=0)
        norm = max(values[0], *(np.sum(locked * locked_image, axis=0)), 0.0) if locked.shape[1] else max(values[0], 0.0)
        limit = EPS * norm * max(width, rows**0.5)
        done = int(np.argmin(np.r_[norms <= limit, False]))
        full = locked.shape[1] + basis.shape[1] == width  # the subspace is the whole space: Rayleigh-Ritz is exact
        if done == need or full:
            every, its_image = np.hstack([locked, vectors]), np.hstack([locked_image, images])
            values, vectors, images = rayleigh_ritz(every, its_image)
            values, vectors, images = values[:wanted], vectors[:, :wanted], images[:, :wanted]
            norms = np.linalg.norm(images - vectors * values, axis=0)
            if full or norms.max(initial=0.0) <= 4 * limit:
                return Pairs(values, vectors, norms, made)
            # a larger pair turned up beside the locked ones: seek on from all of them
            basis, image, locked, locked_image = every, its_image, every[:, :0], its_image[:, :0]
            continue
        locked = np.hstack([locked, vectors[:, :done]])
        locked_image = np.hstack([locked_image, images[:, :done]])
        basis, image = vectors[:, done:], images[:, done:]
        if min(basis.shape[1] + need, width - locked.shape[1]) > most:
            keep = min(need - done + GUARD, basis.shape[1])
            basis, image = basis[:, :keep], image[:, :keep]
        todo = [j for j in range(done, need) if norms[j] > limit]
        outside = np.hstack([locked, vectors[:, done:need]])
        t = corrections(counted, values[todo], residuals[:, todo], outside, inner, 1e-3)
        # a correction that came to nothing is replaced by the residual itself
        t = np.where(np.linalg.norm(t, axis=0) > 0, t, residuals[:, todo])
        new = orthonormal(t, np.hstack([locked, basis]))
        if not new.shape[1]:
            new = orthonormal(np.random.default_rng(made).standard_normal((width, 1)), np.hstack([locked, basis]))
        basis, image = np.hstack([basis, new]), np.hstack([image, counted(new)])


@dataclass
class Whitener:
    moments: Moments
    pairs: Pairs

    @property
    def sound(self) -> np.ndarray:
        """Components that vary at all."""
        top = max(self.pairs.values.max(initial=0.0), 0.0)
        return self.pairs.values > EPS * top * max(len(self.moments.sums), self.moments.n**0.5)

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sum of squares of n * x - sum of each row, exact, and its coordinates (zero where nothing varies)."""
        c = self.moments.centred(x)
        most = int(np.abs(c).max(initial=0))
        squares = (c.astype(np.int64 if most < 1 << 31 and most * most * c.shape[1] < 1 << 63 else object) ** 2).sum(axis=1)
        scale = np.where(self.sound, 1 / np.sqrt(np.where(self.sound, self.pairs.values, 1.0)), 0.0)
        return squares, (c.astype(np.float64) / self.moments.n) @ (self.pairs.vectors * scale)


def fitted(blocks: DataFrame, components: int = COMPONENTS) -> Whitener:
    found = moments(blocks)
    if not found.n:
        return Whitener(found, Pairs(np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0))
    v = Covariance(blocks, found)
    return Whitener(found, leading_pairs(v.product, v.width, components, found.n))


def identity_error(blocks: DataFrame, fit: Whitener) -> float | None:
    """The largest entry of the covariance of the whitened rows, less the identity."""
    sound = fit.sound
    k = int(sound.sum())
    if not k:
        return None

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for x in unpacked(batches):
            w = fit.of(x)[1][:, sound]
            total += np.column_stack([w.T @ w, w.sum(axis=0)]) / fit.moments.n
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    total = tree_sum(blocks.mapInArrow(partial, "part binary"), blocks.rdd.getNumPartitions()).reshape(k, k + 1)
    return float(np.abs(total[:, :k] - np.outer(total[:, k], total[:, k]) - np.eye(k)).max())


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each whole vector and component (from 1): key, n, deviation, whitened, explained, identity_error."""
    columns = [F.col(f"`{key}`").alias(key), F.col(f"`{vector}`").alias("_vector")]
    vectors = whole_vectors(rows.select(*columns), "_vector")
    blocks = packed(vectors, "_vector")
    fit = fitted(blocks, components)
    error = identity_error(blocks, fit)
    discard(blocks)
    schema = T.StructType([T.StructField(key, vectors.schema[key].dataType)])
    schema = schema.add("component", "integer").add("n", "long").add("deviation", "long").add("whitened", "double")
    schema = schema.add("explained", "double").add("identity_error", "double")
    k, n, trace, sound = len(fit.pairs.values), fit.moments.n, fit.moments.trace, fit.sound
    share = [float(e) / trace if trace > 0 else None for e in fit.pairs.values]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                squares, w = fit.of(integers(matrix(batch.column(1))))
                m = batch.num_rows
                place = pa.array(np.repeat(np.arange(m), k))
                deviation = pa.array([int(d) if d < 1 << 63 else None for d in squares.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(place),
                        pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                        pa.array(np.full(m * k, n), pa.int64()),
                        deviation.take(place),
                        pa.array(w.ravel(), pa.float64(), mask=~np.tile(sound, m)),
                        pa.array(share * m, pa.float64()),
                        pa.array([error] * (m * k), pa.float64()),
                    ],
                    schema.fieldNames(),
                )

    return vectors.mapInArrow(rows_of, schema)
