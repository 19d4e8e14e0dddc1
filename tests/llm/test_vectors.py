"""Whitening and vector codes against plain versions."""

import math

import numpy as np
import pytest

from hourloom.llm import queries, vector_codes, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, key string, vector int, code string, n double, width int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "k", 1, "c", 0.5, 3) for i, v, label in rows], SCHEMA)


def sound_rows(width, n, seed, equal=0):
    rng = np.random.default_rng(seed)
    values = rng.standard_normal((n, width)) * (1 + 3 * (np.arange(width) < 4))
    values[: equal + 1] = values[0]
    return [(i, [float(np.float32(x)) for x in v], int(i % 3)) for i, v in enumerate(values)]


def odd_rows(width):
    one = [0.25] * width
    return [
        (None, one, 1),
        (3, one, None),
        (3, one, None),
        (900, None, 1),
        (901, [None, *one[1:]], 1),
        (902, [math.nan, *one[1:]], 1),
        (903, [math.inf, *one[1:]], 1),
        (904, [-math.inf, *one[1:]], None),
        (905, one[:-1], 1),
        (906, [], 1),
        (907, [0.0] * width, 2),
    ]


def is_sound(v, width):
    return v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)


# whitening


def plain_whitening(rows, width):
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v, _ in rows if is_sound(v, width)]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    c = np.array([[n * a - s for a, s in zip(r, sums)] for r in x], dtype=object)
    deviation = [sum(a * a for a in r) for r in c]
    centred = c.astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, values[::-1], (centred @ vectors)[:, ::-1]


@pytest.mark.parametrize("width", [16, 5, 1])
def test_whitening_equals_a_dense_solver(spark, width):
    rows = sound_rows(width, 400, width, equal=50) + odd_rows(width)
    got = whitening.whitened(frame(spark, rows).repartition(5)).collect()
    n, deviation, values, projected = plain_whitening(rows, width)
    k = min(8, width)
    ids = [i for i, v, _ in rows if is_sound(v, width)]
    assert len(got) == n * k and {r.n for r in got} == {n}
    assert sorted((str(r.vec_id), r.deviation) for r in got) == sorted((str(i), d) for i, d in zip(ids, deviation) for _ in range(k))
    for j in range(k):
        own = sorted((r.deviation, r.whitened) for r in got if r.component == j + 1)
        plain = projected[:, j] / math.sqrt(values[j])
        want = [sorted(zip(deviation, sign * plain)) for sign in (1, -1)]
        assert min(max(abs(a[1] - b[1]) for a, b in zip(own, w)) for w in want) < 1e-8
        assert all(abs(r.explained - values[j] / values.sum()) < 1e-10 for r in got if r.component == j + 1)
    assert max(r.identity_error for r in got) < 1e-9


def test_whitening_without_variance_or_rows(spark):
    same = [(i, [0.5, 0.25], 1) for i in range(4)]
    got = whitening.whitened(frame(spark, same)).collect()
    assert len(got) == 8 and {(r.whitened, r.explained, r.identity_error, r.deviation) for r in got} == {(None, None, None, 0)}
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [(1, None, 1), (2, [], 1)])).collect() == []


def test_one_direction_is_found_and_the_others_are_null(spark):
    rows = [(i, [i / 8, i / 4, 1.0], 1) for i in range(50)]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got)
    assert max(r.identity_error for r in got) < 1e-10


def test_huge_components_are_counted_exactly(spark):
    rows = [(i, [float(2**20) * (i - 2), 1.0], 1) for i in range(5)]
    got = {(r.vec_id, r.deviation) for r in whitening.whitened(frame(spark, rows)).collect()}
    assert got == {(i, d if (d := (5 * 1024 * 2**20 * (i - 2)) ** 2) < 2**63 else None) for i in range(5)}


@pytest.mark.parametrize("width,inner", [(30, 6), (200, 6), (200, 3)])
def test_leading_pairs(width, inner):
    rng = np.random.default_rng(width + inner)
    x = rng.standard_normal((2000, width)) * 0.98 ** np.arange(width)
    v = x.T @ x / len(x)
    found = whitening.leading_pairs(lambda q: v @ q, width, 8, len(x), inner)
    want = np.linalg.eigvalsh(v)[::-1][:8]
    assert np.abs(found.values - want).max() < 1e-12 * want[0]
    assert np.abs(v @ found.vectors - found.vectors * found.values).max() < 1e-12 * want[0]
    assert np.abs(found.vectors.T @ found.vectors - np.eye(8)).max() < 1e-12


def test_corrections_solve_the_projected_equation():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((40, 40))
    a = a @ a.T
    q = np.linalg.qr(rng.standard_normal((40, 3)))[0]
    p = np.eye(40) - q @ q.T
    r = p @ rng.standard_normal((40, 2))
    values = np.array([50.0, 7.0])
    t = whitening.corrections(lambda x: a @ x, values, r, q, 200, 1e-12)
    for j in range(2):
        assert np.linalg.norm(p @ (a @ t[:, j] - values[j] * t[:, j]) + r[:, j]) < 1e-6 * np.linalg.norm(r[:, j])


def test_registered_whitening(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = queries.QUERIES["op11_jacobi_davidson_whitening"](spark, SF).collect()
    n, deviation, values, projected = plain_whitening(rows, 64)
    place = {r[0]: i for i, r in enumerate(rows)}
    assert len(got) == 8 * n
    for j in range(8):
        own = [(place[r.vec_id], r) for r in got if r.component == j + 1]
        mine, plain = np.array([r.whitened for _, r in own]), np.array([projected[i, j] for i, _ in own]) / math.sqrt(values[j])
        assert min(np.abs(mine - plain).max(), np.abs(mine + plain).max()) < 1e-9
        assert all(r.deviation == deviation[i] for i, r in own)


# codes


def plain_codes(rows, width, parts=16, entries=64, rounds=2):
    kept = [(i, v, label) for i, v, label in rows if is_sound(v, width)]
    pad = -width % parts
    x = {k: [math.floor(256 * c) for c in v] + [0] * pad for k, (_, v, _) in enumerate(kept)}
    size = (width + pad) // parts
    cut = {k: [tuple(v[p * size : (p + 1) * size]) for p in range(parts)] for k, v in x.items()}
    first = sorted(cut, key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            uses = {}
            for k in cut:
                uses.setdefault(near(cut[k][p], books[p])[1], []).append(cut[k][p])
            books[p] = [tuple(sum(c) // len(uses[i]) for c in zip(*uses[i])) if i in uses else e for i, e in enumerate(books[p])]
    out = []
    for k in cut:
        found = [near(cut[k][p], books[p]) for p in range(parts)]
        out.append((kept[k][0], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), kept[k][2]))
    return out, ",".join(str(v) for book in books for e in book for v in e)


def by_text(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("width", [32, 20])
def test_codes_equal_plain_codes(spark, width):
    rows = sound_rows(width, 300, width, equal=100) + odd_rows(width)
    codes, books = vector_codes.compressed(frame(spark, rows).repartition(5))
    want, text = plain_codes(rows, width)
    got = codes.collect()
    assert by_text((r.key, r.code.hex(), r.error, r.label) for r in got) == by_text(want)
    assert ",".join(str(int(v)) for v in books.ravel()) == text
    sums = {}
    for _, _, error, label in want:
        sums[label] = sums.get(label, 0) + error
    assert {(r.label, r.label_error) for r in vector_codes.with_label_errors(codes).collect()} == set(sums.items())


def test_fewer_rows_than_entries_and_no_rows(spark):
    rows = sound_rows(16, 5, 1, equal=2)
    codes, _ = vector_codes.compressed(frame(spark, rows))
    assert by_text((r.key, r.code.hex(), r.error, r.label) for r in codes.collect()) == by_text(plain_codes(rows, 16)[0])
    for empty in ([], [(1, None, 2)], [(1, [], 2)]):
        codes, books = vector_codes.compressed(frame(spark, empty))
        assert books is None and vector_codes.with_label_errors(codes).collect() == []


def test_huge_components(spark):
    rows = [(i, [float(np.float32(3e38 if i == 2 else 2.0**30 * i)), 0.5 * i], i % 2) for i in range(6)]
    codes, books = vector_codes.compressed(frame(spark, rows), parts=2, entries=2)
    want, text = plain_codes(rows, 2, parts=2, entries=2)
    got = {r.key: r for r in codes.collect()}
    assert {(k, r.code.hex()) for k, r in got.items()} == {(k, c) for k, c, _, _ in want}
    assert all(got[k].error == (e if e < 2**63 else None) for k, _, e, _ in want)
    assert ",".join(str(int(v)) for v in books.ravel()) == text
    vector_codes.with_label_errors(codes).collect()


@pytest.mark.parametrize("run", [1, 3, 4096])
def test_trie_walk_in_runs_of_any_size(monkeypatch, run):
    monkeypatch.setattr(vector_codes, "RUN", run)
    rng = np.random.default_rng(run)
    parts, book = rng.integers(-3, 4, (500, 4)), rng.integers(-3, 4, (9, 4))
    trie = vector_codes.Trie(parts)
    assert (trie.rows[trie.leaf_of] == parts).all() and trie.copies.sum() == 500 and len(trie.rows) == len({tuple(p) for p in parts.tolist()})
    code, distance = trie.nearest(book)
    all_ = ((trie.rows[:, None] - book[None]) ** 2).sum(axis=2)
    assert (code == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()


def test_decoded_vectors_lie_as_far_off_as_the_error_says(spark):
    rows = sound_rows(16, 200, 3)
    codes, books = vector_codes.compressed(frame(spark, rows))
    vectors = {i: np.floor(256 * np.array(v)) for i, v, _ in rows}
    for r in vector_codes.decoded(codes, books).collect():
        assert ((vectors[r.key] - 256 * np.array(r.vector)) ** 2).sum() == r.error
