"""Vectorised word hashing: every word of a text column gets a 64-bit hash, whole batch at a time.

Working memory is bounded by ``PART`` bytes of text and not by the length of a text: a long text is
hashed in parts that are cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PART = 1 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that close inputs give unrelated outputs."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def scrambled(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * ODD)


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


BYTE_VALUE = scrambled(256, 1)
BASE = int(scrambled(1, 2)[0]) | 1
INVERSE = pow(BASE, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

@dataclass(frozen=True)
class Scheme:
    """How bytes form words: each byte has a kind (0 to 3), kind 0 belongs to no word, and a word ends between two
    bytes whose kinds are in ``cut``."""

    kinds: np.ndarray
    cut: np.ndarray

    @classmethod
    def of(cls, kinds: dict[int, int], cut: set[tuple[int, int]]):
        """Bytes not named are of kind 3; kind 0 is cut from every other."""
        of_byte = np.full(256, 3, dtype=np.uint8)
        for byte, kind in kinds.items():
            of_byte[byte] = kind
        table = np.array([a == 0 or b == 0 or (a, b) in cut for a in range(4) for b in range(4)])
        return cls(of_byte, table)

    def edges(self, view: np.ndarray) -> np.ndarray:
        """Whether a word ends before each byte but the first."""
        kind = self.kinds[view]
        return self.cut[kind[:-1] * 4 + kind[1:]]


BLANKS = (0x20, *range(0x09, 0x0E))
#: Words end at space and the control characters 9 to 13.
SPACES = Scheme.of(dict.fromkeys(BLANKS, 0), set())
#: Words are runs of ASCII letters and digits and of all characters beyond ASCII.
LETTERS = Scheme.of({b: 0 for b in range(128) if not chr(b).isalnum()}, set())
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the table grows to the longest part met."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, PART + 1), dtype=np.uint64)
        have[1:] = np.uint64(base)
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


@dataclass
class Block:
    """Whole rows lo..hi and their words in order; offsets point into ``data``."""

    lo: int
    hi: int
    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray

    def rows(self) -> Iterator[tuple[int, slice]]:
        at = 0
        for i, n in enumerate(self.counts.tolist()):
            yield self.lo + i, slice(at, at + n)
            at += n

    def word(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "replace")


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def hash_part(data, lo, hi, breaks, scheme, lower):
    """Word hashes, starts and ends of data[lo:hi]; no word goes past a position in ``breaks``."""
    view = data[lo:hi]
    edge = np.ones(len(view) + 1, dtype=bool)
    edge[1:-1] = scheme.edges(view)
    edge[breaks - lo] = True
    solid = scheme.kinds[view] > 0
    starts = np.flatnonzero(solid & edge[:-1])
    ends = np.flatnonzero(solid & edge[1:]) + 1
    sums = np.zeros(len(view) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[LOWER[view] if lower else view] * powers(BASE, len(view)), out=sums[1:])
    value = (sums[ends] - sums[starts]) * powers(INVERSE, len(view))[starts]
    return mix(value + (ends - starts).astype(np.uint64) * ODD), starts + lo, ends + lo


def cuts(data, lo, hi, scheme):
    """Part limits inside one long text, each where a word ends."""
    at = [lo]
    while hi - at[-1] > PART:
        end = at[-1] + PART
        gaps = np.flatnonzero(scheme.edges(data[at[-1] : end]))
        while not len(gaps) and end < hi:  # one word longer than a part
            end = min(end + PART, hi)
            gaps = np.flatnonzero(scheme.edges(data[end - PART - 1 : end])) + (end - PART - 1 - at[-1])
        at.append(at[-1] + 1 + int(gaps[-1]) if len(gaps) else end)
    return [*at, hi] if at[-1] < hi else at


def blocks(column, scheme: Scheme = SPACES, lower: bool = False) -> Iterator[Block]:
    """Blocks of whole rows, about ``PART`` bytes each."""
    offsets, data = text_buffers(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PART, side="right")) - 1)
        hi = min(hi, n)
        at = cuts(data, int(offsets[lo]), int(offsets[hi]), scheme) if hi == lo + 1 else [int(offsets[lo]), int(offsets[hi])]
        got = []
        for a, b in zip(at, at[1:]):
            if b > a:
                inside = offsets[lo:hi][(offsets[lo:hi] >= a) & (offsets[lo:hi] < b)]
                got.append(hash_part(data, a, b, inside, scheme, lower))
        if got:
            hashes, starts, ends = (np.concatenate(x) if len(got) > 1 else x[0] for x in zip(*got))
        else:
            hashes, starts, ends = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        edges = np.searchsorted(starts, offsets[lo : hi + 1])
        yield Block(lo, hi, data, hashes, starts, ends, np.diff(edges))
        lo = hi


def grams(hashes: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    """One hash for each run of words at the given distances, in order of position."""
    n = len(hashes) - places[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors = scrambled(len(places), 7 + len(places) * 31 + places[-1]) | np.uint64(1)
    total = np.zeros(n, dtype=np.uint64)
    for p, f in zip(places, factors):
        total += hashes[p : p + n] * f
    return mix(total)


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; a shorter sequence is one shingle, no words none."""
    if not len(hashes):
        return hashes
    return np.unique(grams(hashes, tuple(range(min(n, len(hashes))))))
