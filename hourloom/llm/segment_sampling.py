"""Sampled SentencePiece segmentations without replacement, and their decoding.

A text's lattice holds every way to write it in vocabulary pieces; a way is as likely as the product of its pieces'
probabilities. The k samples of a text are the k ways with the largest Gumbel-perturbed log-probabilities. They are
found by a best-first search from the top: the first way inherits the largest perturbed value of the root, at every
node passed the best value among the ways that turn off there is drawn (a Gumbel truncated at the way's own value),
and the largest of these open nodes is where the next way begins. Only the lattice of each distinct unit is
built; the search runs on all texts of a block at once.

All random numbers are hashes of the row key, the place in the text and the round: a rerun gives the same samples.
The inclusion score is the logarithm of the chance that a way exceeds the (k+1)-th perturbed value, the weight for
estimates from samples without replacement; it is 0 if the text has no more ways.

Probabilities: the vocabulary's scores are merge ranks, so a piece has probability proportional to 1 / (rank + 2.7);
a character without a piece of its own is spelled as bytes, each rarer than every piece.

Defined cases: null or empty text gives one sample without pieces; a text with fewer than k ways gives them all; rows
that repeat key and text get equal samples; a null key is a key; U+2581 in a text is a space, as to the tokenizer;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm import words
from hourloom.llm.storage import bounded_batches
from hourloom.llm.unigram import MARK, UnitTable, Vocabulary, unit_blocks

SAMPLES = 2


#: Units whose lattices a worker remembers.
REMEMBER = 120_000


class Pieces:
    """The vocabulary as hashes of the pieces' bytes, to look up very many strings at once."""

    GATE = 20

    def __init__(self, vocabulary: Vocabulary):
        weight = weights(vocabulary)
        ids = sorted(vocabulary.score)
        raw = [vocabulary.pieces[i].encode("utf-8") for i in ids]
        data, ends = np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([len(r) for r in raw])
        keys = substring_hashes(prefix_sums(data), np.concatenate([[0], ends[:-1]]), ends)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(ids)[order]
        self.log = np.log(np.array([weight[i] for i in ids]))[order]
        self.log_byte = math.log(weight[-1])
        self.byte_id = np.array([vocabulary.byte_id[b] for b in range(256)])
        self.longest = max(len(vocabulary.pieces[i]) for i in ids)
        self.gate = np.zeros(1 << self.GATE, dtype=bool)
        self.gate[(self.keys & np.uint64((1 << self.GATE) - 1)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the strings are pieces, and their places in the vocabulary."""
        near = np.flatnonzero(self.gate[(hashes & np.uint64((1 << self.GATE) - 1)).astype(np.int64)])
        at = np.searchsorted(self.keys, hashes[near])
        at[at == len(self.keys)] = 0
        same = self.keys[at] == hashes[near]
        return near[same], at[same]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(words.BYTE_VALUE[data] * words.powers(words.BASE, len(data)), out=sums[1:])
    return sums


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    value = (sums[ends] - sums[starts]) * words.powers(words.INVERSE, len(sums))[starts]
    return words.mix(value + (ends - starts).astype(np.uint64) * words.ODD)


def weights(vocabulary: Vocabulary) -> dict[int, float]:
    rank = {i: -s if s > -1e8 else float(vocabulary.size) for i, s in vocabulary.score.items()}
    out = {i: 1 / (r + 2.7) for i, r in rank.items()}
    total = sum(out.values())
    out = {i: w / total for i, w in out.items()}
    out[-1] = min(out.values()) / 10
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0] + lengths[0] - 1, starts[1] .."""
    upto = np.cumsum(lengths)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(starts - (upto - lengths), lengths)


def before(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


class Column:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.data, self.n = np.empty(1 << 12, dtype=kind), 0

    def extend(self, values) -> None:
        values = np.asarray(values, dtype=self.data.dtype)
        if self.n + len(values) > len(self.data):
            self.data = np.concatenate([self.data, np.empty(len(self.data) + len(values), self.data.dtype)])
        self.data[self.n : self.n + len(values)] = values
        self.n += len(values)


class Lattices:
    """The lattices of many units in one set of arrays: a node for every character of every unit."""

    def __init__(self):
        self.root, self.size = Column(np.int64), Column(np.int64)
        # of nodes
        self.first, self.degree = Column(np.int32), Column(np.int32)
        # of edges; those of a node lie together, longest first
        self.to, self.node, self.at, self.count = (Column(np.int32) for _ in range(4))
        self.chance, self.upto = Column(np.float64), Column(np.float64)
        self.ids = Column(np.int32)

    def add(self, units: list[str], pieces: Pieces) -> None:
        """Build the lattices of new units: all their pieces, and the chance of each edge by the sum over all ways
        from its end on. Characters are handled in order of their distance from the end of their unit."""
        if not units:
            return
        data = np.frombuffer("".join(units).encode("utf-8"), dtype=np.uint8)
        begins = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # bytes where characters begin
        sizes = np.array([len(u) for u in units], dtype=np.int64)
        root = before(sizes)
        n = int(root[-1])
        stop = np.repeat(root[1:], sizes)
        sums = prefix_sums(data)
        rest = stop - np.arange(n)
        node, length, piece = [], [], []
        for k in range(pieces.longest, 0, -1):
            inside = np.flatnonzero(rest >= k)
            hit, at = pieces.find(substring_hashes(sums, begins[inside], begins[inside + k]))
            node.append(inside[hit])
            length.append(np.full(len(hit), k))
            piece.append(at)
        alone = np.zeros(n, dtype=bool)
        alone[node[-1]] = True
        odd = np.flatnonzero(~alone)
        node.append(odd)
        length.append(np.ones(len(odd), np.int64))
        piece.append(np.full(len(odd), -1))
        node, length, piece = np.concatenate(node), np.concatenate(length), np.concatenate(piece)
        order = np.argsort(rest[node] * n + node, kind="stable")
        node, length, piece = node[order], length[order], piece[order]
        count = np.where(piece < 0, begins[node + 1] - begins[node], 1)
        log = np.where(piece < 0, pieces.log_byte * count, pieces.log[piece])
        to = node + length
        ahead = np.zeros(n)  # logarithm of the sum over all ways from a character to the end of its unit
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        level = np.searchsorted(rest[node[first]], np.arange(1, int(rest.max()) + 2))
        edge_of = np.append(first, len(node))
        for a, b in zip(level[:-1].tolist(), level[1:].tolist()):
            lo, hi = int(edge_of[a]), int(edge_of[b])
            at = first[a:b] - lo
            far = to[lo:hi]
            value = log[lo:hi] + np.where(far < stop[node[lo:hi]], ahead[np.minimum(far, n - 1)], 0.0)
            degree = np.diff(np.append(at, hi - lo))
            top = np.maximum.reduceat(value, at)
            total = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, degree)), at))
            ahead[node[first[a:b]]] = total
            log[lo:hi] = value - np.repeat(total, degree)
        chance = np.exp(log)
        degree = np.diff(edge_of)
        chance[first[degree == 1]] = 1.0
        sums = np.cumsum(chance)
        by_byte = piece < 0
        ids = np.repeat(np.where(by_byte, 0, pieces.ids[piece]), count)
        spelled = ragged(begins[node[by_byte]], count[by_byte])
        ids[np.repeat(by_byte, count)] = pieces.byte_id[data[spelled]]
        base, edges = self.degree.n, self.chance.n
        self.upto.extend(sums - np.repeat((sums - chance)[first], degree))
        self.node.extend(base + node)
        self.to.extend(base + to)
        self.at.extend(self.ids.n + before(count)[:-1])
        self.ids.extend(ids)
        self.count.extend(count)
        self.chance.extend(chance)
        place = np.empty((2, n), dtype=np.int64)
        place[:, node[first]] = edges + first, degree
        self.first.extend(place[0])
        self.degree.extend(place[1])
        self.root.extend(base + root[:-1])
        self.size.extend(sizes)

    def walk(self, node, end, seed, place, salt) -> tuple[np.ndarray, np.ndarray]:
        """From each node to its end by the edges' chances: the number of steps of each, and all edges in order."""
        first, degree, upto, to = (c.data for c in (self.first, self.degree, self.upto, self.to))
        node, steps, taken = node.copy(), np.zeros(len(node), np.int64), []
        live = np.flatnonzero(node < end)
        while len(live):
            u = uniform(seed[live], place[live], steps[live], salt)
            at = node[live]
            edge, last = first[at], first[at] + degree[at] - 1
            late = np.flatnonzero((upto[edge] < u) & (edge < last))
            while len(late):
                edge[late] += 1
                late = late[(upto[edge[late]] < u[late]) & (edge[late] < last[late])]
            taken.append((live, edge))
            node[live] = to[edge]
            steps[live] += 1
            live = live[node[live] < end[live]]
        out = np.empty(steps.sum(), dtype=np.int64)
        begin = before(steps)[:-1]
        for s, (who, edge) in enumerate(taken):
            out[begin[who] + s] = edge
        return steps, out


def uniform(seed: np.ndarray, place: np.ndarray, step: np.ndarray | int, salt: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on nothing but the arguments."""
    c = words.scrambled(2, 61)
    step = np.atleast_1d(np.asarray(step))
    x = seed + place.astype(np.uint64) * c[0] + step.astype(np.uint64) * c[1] + words.scrambled(salt + 1, 62)[-1]
    return ((words.mix(x) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def truncated(place: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel draws with location ``place`` that are at most ``top``; no mass gives -inf."""
    with np.errstate(all="ignore"):
        out = place - np.logaddexp(place - top, np.log(-np.log(u)))
    return np.where(np.isneginf(place), -np.inf, np.minimum(out, top))


class Path:
    """One way for each text of a block: edges in order, and where each text begins."""

    def __init__(self, edges: np.ndarray, units: np.ndarray, bounds: np.ndarray, lat: Lattices):
        self.edges, self.units, self.bounds = edges, units, bounds
        logs = np.log(lat.chance.data[edges])
        sums = before(logs)
        self.total = sums[bounds[1:]] - sums[bounds[:-1]]
        self.above = sums[:-1] - np.repeat(sums[bounds[:-1]], np.diff(bounds))

    def open(self, lat: Lattices, top: np.ndarray, since: np.ndarray, seeds: np.ndarray, number: int) -> None:
        """Draw the best value among the ways that turn off at each step from ``since`` on."""
        counts = np.diff(self.bounds)
        text = np.repeat(np.arange(len(counts)), counts)
        step = np.arange(len(self.edges)) - np.repeat(self.bounds[:-1], counts)
        fresh = np.flatnonzero((step >= since[text]) & (lat.degree.data[lat.node.data[self.edges]] > 1))
        self.value = np.full(len(self.edges), -np.inf)
        u = uniform(seeds[text[fresh]], step[fresh], 0, 4 * number + 2)
        with np.errstate(divide="ignore"):
            place = self.above[fresh] + np.log1p(-lat.chance.data[self.edges[fresh]])
        self.value[fresh] = truncated(place, top[text[fresh]], u)
        self.excluded: dict[int, set[int]] = {}

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """The largest open value of each text, and its step."""
        most, where = np.full(len(self.bounds) - 1, -np.inf), np.zeros(len(self.bounds) - 1, np.int64)
        full = np.flatnonzero(np.diff(self.bounds) > 0)
        if len(full):
            most[full] = np.maximum.reduceat(self.value, self.bounds[full])
            hits = np.flatnonzero(self.value == np.repeat(most, np.diff(self.bounds)))
            where[full] = hits[np.searchsorted(hits, self.bounds[full])]
        return most, where


def sampled(lat: Lattices, slots: np.ndarray, counts: np.ndarray, seeds: np.ndarray, k: int) -> Iterator[tuple]:
    """For each sample number the texts that have one, their edges and bounds, log-probability, value and inclusion."""
    n, bounds = len(counts), before(counts)
    units = np.arange(bounds[-1])
    seed, place = np.repeat(seeds, counts), units - np.repeat(bounds[:-1], counts)
    root, end = lat.root.data[slots], lat.root.data[slots] + lat.size.data[slots]
    steps, edges = lat.walk(root, end, seed, place, 0)
    paths = [Path(edges, np.repeat(units, steps), before(steps)[bounds], lat)]
    values = [-np.log(-np.log(uniform(seeds, np.zeros(n, np.int64), 0, 1)))]
    paths[0].open(lat, values[0], np.zeros(n, np.int64), seeds, 0)
    for number in range(1, k + 1):
        found = [p.best() for p in paths]
        values_of = np.stack([v for v, _ in found])
        source = values_of.argmax(axis=0)
        top = values_of[source, np.arange(n)]
        if number == k:
            break
        has = np.flatnonzero(top > -np.inf)
        draws = uniform(seeds, np.full(n, number), 0, 4 * number + 3), uniform(seeds, np.full(n, number), 1, 4 * number + 3)
        turn, branch, who, node, stop, own = {}, {}, [], [], [], []
        for i in has.tolist():
            path = paths[source[i]]
            at = int(found[source[i]][1][i])
            here = int(lat.node.data[path.edges[at]])
            gone = path.excluded.setdefault(at, {int(path.edges[at])})
            first = int(lat.first.data[here])
            choice = [(e, float(lat.chance.data[e])) for e in range(first, first + int(lat.degree.data[here])) if e not in gone]
            mark = draws[0][i] * sum(c for _, c in choice)
            for e, c in choice:
                mark -= c
                if mark <= 0:
                    break
            gone.add(e)
            left = sum(c for x, c in choice if x != e)
            loc = np.array([path.above[at] + math.log(left)]) if left > 0 else np.array([-np.inf])
            path.value[at] = truncated(loc, top[i : i + 1], draws[1][i : i + 1])[0]
            turn[i], branch[i] = at - int(path.bounds[i]), e
            unit = int(path.units[at])
            who.append(np.arange(unit, bounds[i + 1]))
            node.append(np.concatenate([lat.to.data[e : e + 1], root[unit + 1 : bounds[i + 1]]]))
        new_edges, new_units, lengths = [], [], np.zeros(n, np.int64)
        if len(has):
            who, node = np.concatenate(who), np.concatenate(node)
            steps, edges = lat.walk(node, end[who], seed[who], place[who], 4 * number)
            upto, spot = before(steps), 0
            for i in has.tolist():
                path = paths[source[i]]
                a, b = int(path.bounds[i]), int(path.bounds[i]) + turn[i]
                m = int(bounds[i + 1] - path.units[b])
                tail = slice(int(upto[spot]), int(upto[spot + m]))
                new_edges += [path.edges[a:b], [branch[i]], edges[tail]]
                new_units += [path.units[a : b + 1], np.repeat(who[spot : spot + m], steps[spot : spot + m])]
                lengths[i] = turn[i] + 1 + tail.stop - tail.start
                spot += m
        join = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        paths.append(Path(join(new_edges), join(new_units), before(lengths), lat))
        values.append(top)
        paths[-1].open(lat, top, np.array([turn.get(i, 0) + 1 for i in range(n)]), seeds, number)
    for number, (path, value) in enumerate(zip(paths, values)):
        x = path.total - top
        with np.errstate(all="ignore"):
            inclusion = np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.minimum(x, 700)))))
        yield number, np.flatnonzero(value > -np.inf), path, value, np.where(np.isneginf(top), 0.0, inclusion)


class Decoder:
    """Ids back to text: the pieces' bytes in a row, without the space put before the text."""

    def __init__(self, vocabulary: Vocabulary):
        known = {i: bytes([b]) for b, i in vocabulary.byte_id.items()}
        parts = [known.get(i) or p.replace(MARK, " ").encode("utf-8") for i, p in enumerate(vocabulary.pieces)]
        self.count = np.array([len(p) for p in parts])
        self.at = before(self.count)[:-1]
        self.flat = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ragged(self.at[ids], self.count[ids])][1:]


def sample_rows(batches, model: str, k: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    vocabulary = Vocabulary(model)
    pieces, decoder = Pieces(vocabulary), Decoder(vocabulary)
    fresh: list[str] = []
    table, lat = UnitTable(fresh.append), Lattices()
    for batch in batches:
        seeds = words.mix(batch.column("seed").to_numpy().astype(np.int64).view(np.uint64))
        for block in unit_blocks(batch.column("text")):
            if len(table.slots) > REMEMBER:
                table, lat = UnitTable(fresh.append), Lattices()
            slots = table.of(block)
            lat.add(fresh, pieces)
            fresh.clear()
            bytes_at = np.concatenate([[0], np.cumsum(block.counts)])
            for number, has, path, value, inclusion in sampled(lat, slots, block.counts, seeds[block.lo : block.hi], k):
                ids = lat.ids.data[ragged(lat.at.data[path.edges], lat.count.data[path.edges].astype(np.int64))]
                upto = before(lat.count.data[path.edges])[path.bounds]
                crc, same, kept = [], [], []
                for i in has.tolist():
                    own = ids[upto[i] : upto[i + 1]]
                    crc.append(zlib.crc32(own.astype("<u4").tobytes()))
                    a, b = bytes_at[i], bytes_at[i + 1]
                    whole = block.data[block.starts[a] : block.ends[b - 1]] if b > a else block.data[:0]
                    same.append(bool(np.array_equal(decoder(own), whole)) if len(own) else b == a)
                    if keep_ids:
                        kept.append(own)
                out = {
                    "doc_id": batch.column("doc_id").take(pa.array(has + block.lo)),
                    "sample": pa.array(np.full(len(has), number, np.int32)),
                    "n_pieces": pa.array(np.diff(upto)[has], pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "log_prob": pa.array(path.total[has], pa.float64()),
                    "perturbed": pa.array(value[has], pa.float64()),
                    "log_inclusion": pa.array(inclusion[has], pa.float64()),
                    "decodes": pa.array(same, pa.bool_()),
                }
                if keep_ids:
                    out["ids"] = pa.array(kept, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(out)


def sample_segmentations(docs: DataFrame, model: str, k: int = SAMPLES, seed: int = 0, keep_ids: bool = False) -> DataFrame:
    """k rows for each row of (doc_id, text): the samples in falling order of their perturbed values.

    ``decodes`` says that the ids give back the text; ``keep_ids`` adds the ids.
    """
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, sample int, n_pieces long, ids_crc32 long, log_prob double, perturbed double,"
        " log_inclusion double, decodes boolean" + ", ids array<int>" * keep_ids
    )
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("seed", F.xxhash64("doc_id", F.lit(seed)))
    return rows.mapInArrow(lambda batches: sample_rows(batches, model, k, keep_ids), schema)
