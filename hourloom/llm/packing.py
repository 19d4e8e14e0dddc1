"""Pack tokenised documents into as few fixed-length sequences as possible, by bin completion.

The pieces are dealt at random to groups of about ``GROUP`` pieces, and each group is packed by branch and
bound: around the largest open piece it enumerates undominated fillings of the rest of the sequence, drops
branches whose waste cannot beat the best packing so far, and starts from best fit as that packing. The
sequences that stayed open are dealt anew and packed once more across the first groups.

Defined cases: a null or empty text is the end token alone; repeated rows are documents of their own; a null
id is kept as null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm import words
from hourloom.llm.storage import bounded_batches, stored

CAPACITY = 4096
END = 1
#: Expected pieces in a group; a task holds one group at a time.
GROUP = 8192
#: Sequences tried by branch and bound in a group, beyond which the best packing so far stands.
NODES = 20_000
#: Steps of the enumeration of fillings around one piece.
STEPS = 300
#: Words whose ids a worker remembers.
REMEMBER = 300_000

#: A word of this scheme is tokenised alike wherever it stands: the tokenizer drops white space and always
#: cuts between an ASCII letter and ASCII punctuation, but for contractions and special tokens.
CHUNKS = words.Scheme.of(
    dict.fromkeys(words.BLANKS, 0)
    | {b: 1 for b in range(128) if chr(b).isalpha()}
    | {b: 2 for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "'<>|"},
    {(1, 2), (2, 1)},
)


class Lexicon:
    """Token ids by word hash; each distinct word is tokenised once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.slots: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.ends = np.zeros(1, dtype=np.int64)

    def learn(self, block: words.Block, at: np.ndarray, hashes: list[int]) -> None:
        """Tokenise the words at these places: many joined by a space, told apart by their offsets."""
        n = len(self.slots)
        for i in range(0, len(at), 512):
            texts = [block.word(j) for j in at[i : i + 512]]
            got = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
            where = np.array(got.offsets, dtype=np.int64).reshape(-1, 2)[:, 0]
            counts = np.bincount(np.searchsorted(begins, where, side="right") - 1, minlength=len(texts))
            first = self.ends[-1]
            new = first + np.cumsum(counts)
            while new[-1] > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[first : new[-1]] = got.ids
            self.ends = np.concatenate([self.ends, new])
        self.slots.update(zip(hashes, range(n, n + len(hashes))))

    def ids(self, block: words.Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block, and the ids of each of its rows."""
        if len(self.slots) > REMEMBER:
            self.clear()
        codes, distinct = pd.factorize(block.hashes)
        keys = distinct.tolist()
        new = [i for i, h in enumerate(keys) if h not in self.slots]
        if new:
            first = np.empty(len(keys), dtype=np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            self.learn(block, first[new], [keys[i] for i in new])
        slot = np.array([self.slots[h] for h in keys], dtype=np.int64)[codes] if keys else np.zeros(0, np.int64)
        begin, count = self.ends[slot], self.ends[slot + 1] - self.ends[slot]
        upto = np.concatenate([[0], np.cumsum(count)])
        place = np.arange(upto[-1]) + np.repeat(begin - upto[:-1], count)
        edges = np.concatenate([[0], np.cumsum(block.counts)])
        return self.flat[place], np.diff(upto[edges])


def piece_rows(batches: Iterable[pa.RecordBatch], path: str, capacity: int, end: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    lexicon = Lexicon(path)
    for batch in batches:
        for block in words.blocks(batch.column("text"), CHUNKS):
            ids, counts = lexicon.ids(block)
            row, piece, length, check, kept = [], [], [], [], []
            at = 0
            for r, n in zip(range(block.lo, block.hi), counts.tolist()):
                own = np.append(ids[at : at + n], np.uint32(end)).astype("<u4")
                at += n
                for k, i in enumerate(range(0, n + 1, capacity)):
                    part = own[i : i + capacity]
                    row.append(r)
                    piece.append(k)
                    length.append(len(part))
                    check.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        kept.append(part)
            out = {
                "doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(np.array(piece, dtype=np.int64) * capacity),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(check, pa.int64()),
            }
            if keep_ids:
                out["ids"] = pa.array(kept, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(out)


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids of every piece of every document."""
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        lambda batches: piece_rows(batches, tokenizer, capacity, end, keep_ids), schema
    )


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best fit over sizes that fall: each goes to the fullest sequence with room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for s in sizes:
        i = bisect_left(room, (s, -1))
        if i < len(room):
            left, b = room.pop(i)
        else:
            left, b = capacity, len(bins)
            bins.append([])
        bins[b].append(s)
        if left > s:
            insort(room, (left - s, b))
    return bins


class Stock:
    """The open pieces: sizes in rising order, and how many there are of each."""

    def __init__(self, sizes: Iterable[int]):
        self.count: dict[int, int] = {}
        for s in sizes:
            self.count[s] = self.count.get(s, 0) + 1
        self.sizes = sorted(self.count)

    def take(self, s: int) -> None:
        self.count[s] -= 1
        if not self.count[s]:
            del self.count[s]
            self.sizes.pop(bisect_left(self.sizes, s))

    def put(self, s: int) -> None:
        if s in self.count:
            self.count[s] += 1
        else:
            self.count[s] = 1
            insort(self.sizes, s)


def fillings(stock: Stock, room: int) -> list[tuple[int, tuple[int, ...]]]:
    """Undominated sets of open pieces for ``room``, least waste first.

    A set is maximal (nothing open fits beside it) and no member could give way to a larger open piece that
    still fits. The walk goes from large to small and ends at a set without waste, or after ``STEPS``.
    """
    found: dict[tuple[int, ...], int] = {}
    steps = 0
    sizes, count = stock.sizes, stock.count

    def undominated(chosen: list[int], waste: int) -> bool:
        for x in set(chosen):
            i = bisect_right(sizes, x)
            while i < len(sizes) and sizes[i] - x <= waste:
                if count[sizes[i]] > chosen.count(sizes[i]):
                    return False
                i += 1
        return True

    def walk(left: int, most: int, chosen: list[int]) -> bool:
        nonlocal steps
        steps += 1
        i = bisect_right(sizes, min(left, most)) - 1
        fits = False
        while i >= 0:
            s = sizes[i]
            if count[s] > chosen.count(s):
                fits = True
                chosen.append(s)
                done = walk(left - s, s, chosen)
                chosen.pop()
                if done or steps > STEPS:
                    return True
            i -= 1
        if not fits:
            smaller = any(count[s] > chosen.count(s) for s in sizes[: bisect_right(sizes, left)])
            if not smaller and undominated(chosen, left):
                found[tuple(chosen)] = left
                return left == 0
        return False

    walk(room, room, [])
    return sorted((w, c) for c, w in found.items()) or [(room, ())]


def complete(sizes: list[int], capacity: int, nodes: int = NODES) -> list[list[int]]:
    """Fewest sequences for these sizes that the bounded search finds; never more than best fit needs."""
    sizes = sorted(sizes, reverse=True)
    best = best_fit(sizes, capacity)
    total = sum(sizes)
    least = max(-(-total // capacity), sum(2 * s > capacity for s in sizes))
    if len(best) <= least:
        return best
    stock, path, waste, tried = Stock(sizes), [], 0, 0
    levels: list[list[tuple[int, tuple[int, ...]]]] = []

    def opened() -> list[tuple[int, tuple[int, ...]]]:
        top = stock.sizes[-1]
        stock.take(top)
        options = fillings(stock, capacity - top)
        stock.put(top)
        return [(w, (top, *c)) for w, c in reversed(options)]

    levels.append(opened())
    while levels and tried < nodes:
        if len(path) == len(levels):
            back, cost = path.pop()
            waste -= cost
            for s in back:
                stock.put(s)
        if not levels[-1]:
            levels.pop()
            continue
        cost, chosen = levels[-1].pop()
        tried += 1
        if waste + cost > (len(best) - 1) * capacity - total:
            levels[-1].clear()  # the others waste no less
            continue
        for s in chosen:
            stock.take(s)
        path.append((chosen, cost))
        waste += cost
        if stock.sizes:
            levels.append(opened())
        else:
            best = [list(c) for c, _ in path]
            if len(best) <= least:
                break
    return best


def placed(lengths: np.ndarray, bins: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, pieces of one length taken in order."""
    by_size: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        by_size.setdefault(int(lengths[i]), []).append(i)
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for b, members in enumerate(bins):
        at = 0
        for s in members:
            i = by_size[s].pop()
            where[i], offset[i] = b, at
            at += s
    return where, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The pieces with sequence_id, offset (gapless from 0) and fill, their sequence's tokens."""
    pieces = stored(pieces, "pieces")
    columns = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    schema += ", sequence_id long, offset long, fill long"

    def sequences(table: pa.Table, base: int, bins: list[list[int]]) -> pa.Table:
        lengths = table["length"].to_numpy()
        where, offset = placed(lengths, bins)
        fill = np.bincount(where, weights=lengths).astype(np.int64)
        out = table.select(columns)
        for name, values in (("sequence_id", base + where), ("offset", offset), ("fill", fill[where])):
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out

    def first(key, table):
        return sequences(table, key[0].as_py() << 32, complete(table["length"].to_pylist(), capacity))

    def again(key, table):
        bins = complete(table["length"].to_pylist(), capacity)
        if len(bins) >= len(set(table["sequence_id"].to_pylist())):
            return table.select([*columns, "sequence_id", "offset", "fill"])
        return sequences(table, (key[0].as_py() << 32) + (1 << 31), bins)

    def groups(n: int):
        return F.lit(max(1, -(-n // group)))

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), groups(pieces.count())))
    once = stored(dealt.groupBy("_group").applyInArrow(first, schema), "packed")
    # What a piece of average length would still fit into counts as open.
    slack = once.agg(F.avg("length")).first()[0] or 0
    loose = F.col("fill") + F.least(F.lit(slack), F.lit(capacity / 64)) <= capacity
    opened = once.where(loose)
    dealt = opened.withColumn("_group", F.pmod(F.xxhash64("sequence_id"), groups(opened.count())))
    return once.where(~loose).unionByName(dealt.groupBy("_group").applyInArrow(again, schema))
