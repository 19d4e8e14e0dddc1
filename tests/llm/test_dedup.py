"""Exact duplicates against plain grouping, and the counting filter by itself."""

import hashlib
import re

import numpy as np
import pytest

from hourloom.llm import exact_dedup
from tests.llm.helpers import awkward, document_frame, words


def plain_digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def plain_classes(rows):
    """(id, keep id, size, digest) of each row, sorted; and the number of rows that stay for each digest: one."""
    groups = {}
    for key, text in rows:
        groups.setdefault(plain_digest(text), []).append((-len(text or ""), key is None, key or 0, key))
    best = {h: min(g)[3] for h, g in groups.items()}
    return [(key, best[plain_digest(t)], len(groups[plain_digest(t)]), plain_digest(t)) for key, t in rows]


def rows_with_copies():
    rows = [(i, t) for i, t, _ in awkward()]
    rows += [(20, "a b"), (21, "ab"), (22, "a b"), (23, "a  b"), (19, "a\t\vb"), (24, "\r\n"), (None, "ab"), (None, None)]
    rows += [(100 + i, words(3, 7)) for i in range(300)]  # one text holds most rows
    rows += [(1000 + i, words(5, 1000 + i)) for i in range(300)]
    return rows


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("most_bytes", [exact_dedup.MOST_BYTES, 1])
def test_classes_equal_plain_grouping(spark, most_bytes):
    rows = rows_with_copies()
    docs = document_frame(spark, [(i, t, "en") for i, t in rows]).repartition(7)
    got = exact_dedup.classes(docs, most_bytes=most_bytes).collect()
    assert order((r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in got) == order(plain_classes(rows))
    kept = [r.digest for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({plain_digest(t) for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_deduplicated_keeps_whole_rows(spark):
    rows = rows_with_copies()
    docs = document_frame(spark, [(i, t, "en") for i, t in rows]).withColumnRenamed("score", "digest").withColumnRenamed("n", "id")
    got = exact_dedup.deduplicated(docs)
    assert got.schema == docs.schema
    got = got.collect()
    best = {(h, k) for _, k, _, h in plain_classes(rows)}
    assert order((plain_digest(r.text), r.doc_id) for r in got) == order(best)


def test_no_rows(spark):
    docs = document_frame(spark, [])
    assert exact_dedup.classes(docs).collect() == []
    assert exact_dedup.deduplicated(docs).collect() == []


def test_filter_finds_every_repeated_hash_and_few_others(spark):
    rng = np.random.default_rng(3)
    hashes = rng.integers(-(2**63), 2**63 - 1, 60_000)
    hashes[40_000:] = hashes[:20_000]
    cells = exact_dedup.n_cells(len(hashes), exact_dedup.MOST_BYTES)
    df = spark.createDataFrame([(int(h),) for h in hashes], "h long").repartition(9)
    bitmap = exact_dedup.repeated_cells(df, cells)
    spots = exact_dedup.places(hashes, cells, exact_dedup.PROBES).astype(np.int64)
    hit = ((bitmap[spots >> 3] >> (spots & 7)) & 1).all(axis=0)
    assert hit[:20_000].all() and hit[40_000:].all()
    assert hit[20_000:40_000].mean() < 0.02


def test_partial_counts_merge_like_one_count():
    """Dense and sparse forms, in any split of the hashes."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    hashes = rng.integers(-(2**63), 2**63 - 1, 50_000)
    hashes[::7] = hashes[0]
    cells = 2 * exact_dedup.SEGMENT
    places = exact_dedup.places(hashes, cells, 4).ravel()
    want = np.packbits(np.bincount(places.astype(np.int64), minlength=cells) > 1, bitorder="little")
    cuts = [hashes[:10], hashes[10:45_000], hashes[45_000:]]
    partial = [b for c in cuts for b in exact_dedup.met_cells(iter([pa.RecordBatch.from_arrays([pa.array(c)], ["h"])]), cells, 4)]
    partial.sort(key=lambda b: b.column(0)[0].as_py())
    got = np.zeros(cells // 8, np.uint8)
    for b in exact_dedup.merged_segments(iter(partial)):
        s = b.column(0)[0].as_py()
        got[s * exact_dedup.SEGMENT // 8 : (s + 1) * exact_dedup.SEGMENT // 8] = np.frombuffer(b.column(1)[0].as_py(), np.uint8)
    assert (got == want).all()
