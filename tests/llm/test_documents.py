"""Operators on documents against plain versions."""

import random
import re
import zlib

import numpy as np
import pytest

from hourloom.llm import ngram_join, packing, quality_rules, queries, toxicity
from hourloom.llm.storage import stored
from tests.llm.helpers import DOC_SCHEMA, awkward, document_frame, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def shingles(text, n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def plain_classes(rows, n, percent):
    """Row position to (set size, smallest id of its class), by comparing all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [(key, len(s), least.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets))]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_near_duplicates_equal_all_pairs(spark, n, percent):
    rows = [(i, t) for i, t, _ in awkward()]
    base = words(120, 9).split()
    for k in range(40):  # a chain of near copies, and a passage that many texts share
        own = list(base)
        own[k : k + 1] = [f"w{k}"]
        rows.append((100 + k, " ".join(own)))
        rows.append((200 + k, " ".join(base[:30]) + " " + words(20, 500 + k)))
    got = ngram_join.near_duplicates(document_frame(spark, [(i, t, "en") for i, t in rows]), n, percent)
    assert in_order(tuple(r) for r in got.collect()) == in_order(plain_classes(rows, n, percent))


def test_rest_pairs_count_both_orders_of_a_pair(spark):
    """Two half-joined groups: each list has another largest component, and the pair needs both lists."""
    join = ngram_join.Join.__new__(ngram_join.Join)
    lists = [(1, 7), (1, 8), (1, 3), (2, 7), (2, 3), (2, 4)]
    join.lists = spark.createDataFrame([(i, i, t, 20, 2) for t, i in lists], "id long, f1 long, token long, n long, k int")
    bits = "".join(f", b{i} long" for i in range(ngram_join.WORDS))
    join.sets = spark.createDataFrame([(i, i, *[7] * ngram_join.WORDS) for i in (3, 4, 7, 8)], f"id long, f1 long{bits}")
    join.classes = spark.createDataFrame([(3, 3), (4, 3), (7, 7), (8, 7)], "f1 long, component long")
    join.percent = 80
    got = sorted((r["id"], r["id_b"]) for r in join.rest_pairs().collect())
    # (3, 7) by lists 1 and 2; every other pair across the groups has one list
    assert got == [(3, 7)]


def family(size):
    """Texts of one base, of which any two differ by about a fifth of their shingles."""
    base, out = words(300, 21).split(), []
    for i in range(size):
        own = list(base)
        for j in random.Random(i).sample(range(300), 8):
            own[j] = f"edit{i}x{j}"
        out.append((i + 1, " ".join(own)))
    return out


def test_a_family_below_the_threshold_makes_few_pairs(spark):
    rows = family(60)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert ngram_join.Join(frame, 4, 85).rest_pairs().count() < len(rows)
    # links on the edge of the threshold are not lost among them
    near = [(100 + i, t.rsplit(" ", 12 * i)[0] + f" end{i}" * (i > 0)) for i, (_, t) in enumerate(rows[:5])]
    rows += near
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n=4, percent=85)
    plain = plain_classes(rows, 4, 85)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain)


def test_the_join_leaves_no_broadcast_behind(spark, monkeypatch):
    made = []
    make = type(spark.sparkContext).broadcast

    def recorded(self, value):
        made.append(make(self, value))
        monkeypatch.setattr(made[-1], "destroy", lambda b=made[-1]: (gone.append(b), type(b).destroy(b)), raising=False)
        return made[-1]

    gone = []
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", recorded)
    frame = spark.createDataFrame(family(20) + [(50, family(1)[0][1] + " end")], "doc_id long, text string")
    ngram_join.near_duplicates(frame, n=4, percent=85).collect()
    assert made and len(gone) == len(made)


def test_only_texts_of_pairs_are_made_whole(spark, monkeypatch):
    """Texts that share a rare passage, but no more, are kept as bitmaps; whole sets are stored for the pairs alone."""
    tables = {}

    def recorded(df, label):
        out = stored(df, label)
        tables.setdefault(label, []).append((out.columns, out.count()))
        return out

    monkeypatch.setattr(ngram_join, "stored", recorded)
    passage = words(8, 77)
    rows = [(i, words(100, 900 + i) + " " + passage) for i in range(40)]
    rows += [(50, rows[0][1] + " end"), (51, rows[0][1])]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n=4, percent=85)
    assert in_order(tuple(r) for r in got.collect()) == in_order(plain_classes(rows, 4, 85))
    assert all(set(columns) == {"id", "f1", *(f"b{i}" for i in range(ngram_join.WORDS))} for columns, _ in tables["sets"])
    # once the counts and once the sets of the ends of a round's pairs: (0, 50), where 0 stands for its copy 51 as well
    assert tables["ends"][-1][1] < 10


def test_the_median_of_counters():
    rng = np.random.default_rng(3)
    for top in (1, 2, 7, ngram_join.FULL + 1):
        counts = rng.integers(0, top, 1 << ngram_join.SKETCH_BITS).astype(np.uint16)
        assert ngram_join.median(counts) == np.median(counts)


def test_near_duplicates_of_nothing(spark):
    assert ngram_join.near_duplicates(spark.createDataFrame([], DOC_SCHEMA)).collect() == []


def test_registered_join_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op1_ngram_jaccard_join"](spark, SF)
    assert in_order(tuple(r) for r in got.collect()) == in_order(plain_classes([tuple(d) for d in docs], 4, 85))


def test_adaptive_prefixes_keep_every_link():
    """Whatever depth two texts choose, linked sets share the smaller depth in their prefixes."""
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 50, 1 << ngram_join.SKETCH_BITS).astype(np.uint16)
    for _ in range(300):
        universe = rng.integers(0, 1 << 63, 60).astype(np.uint64)
        a = np.unique(rng.choice(universe, rng.integers(1, 60)))
        b = np.unique(np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.choice(universe, 3)]))
        same = len(np.intersect1d(a, b))
        bound = ngram_join.overlap_bound(ngram_join.bucket_counts(a), ngram_join.bucket_counts(b))
        assert bound >= same
        if 100 * same >= 80 * (len(a) + len(b) - same):
            (k, p), (m, q) = (ngram_join.adaptive_prefix(s, counts, 5.0, 80) for s in (a, b))
            assert len(np.intersect1d(p, q)) >= min(k, m)


def plain_base(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    places = {}
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_equal_plain_ones(spark):
    rows = awkward() + [(20, "a b c d e " * 9, "en"), (21, "x\n\nx\n y\nx#|", "en"), (22, words(60, 7) + " " + words(8, 8) * 2, "en")]
    got = quality_rules.with_features(document_frame(spark, rows)).select("text", *(f"_q.{c}" for c in BASE)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == plain_base(r["text"])


def test_registered_base_counts(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.QUERIES["op3_quality_rules"](spark, SF).collect():
        assert tuple(r)[1:7] == plain_base(docs[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_binomial_tail_is_exact(spark):
    from decimal import Decimal, getcontext
    from math import comb

    getcontext().prec = 60

    for k, n, p in ((0, 100, 0.01), (3, 1000, 0.01), (20, 3000, 0.02), (0, 1, 0.5), (150, 20_000, 0.01)):
        q = Decimal(p)
        want = float(sum(Decimal(comb(n, i)) * q**i * (1 - q) ** (n - i) for i in range(k + 1)))
        frame = spark.createDataFrame([(float(k), float(n))], "k double, n double")
        got = frame.select(quality_rules.binomial_at_most(frame.k, frame.n, p)).first()[0]
        assert got == pytest.approx(want, rel=1e-9)


def test_cutoffs_reject_junk_and_keep_good_texts(spark):
    rows, labels = [], []
    for i in range(4000):
        junk = i % 10 == 0
        text = words(40, i)
        rows.append((i, " ".join(w + "###" for w in text.split()) if junk else text, "en" if i % 4 else None))
        labels.append((i, 0 if junk else 1))
    docs = document_frame(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    features = quality_rules.with_features(docs)
    out = quality_rules.judged(features, marks)
    assert set(docs.columns) <= set(out.columns)
    got = {r["doc_id"]: r["_kept"] for r in out.select("doc_id", "_kept").collect()}
    assert all(got[i] for i in range(4000) if i % 10)
    assert not any(got[i] for i in range(0, 4000, 10) if i % 4)
    # without labels nothing but the base decides
    none = quality_rules.judged(features, marks.where("false"))
    assert none.where("_kept").count() == 4000


def toxic_frame(spark, n=1500):
    rows, labels = [], []
    for i in range(n):
        text = words(60, i).split()
        bad = i % 5 == 0
        if bad:
            text[10:10] = ["You", "idiot,", "awful"]
        rows.append((i, " ".join(text), "en"))
        labels.append((i, int(bad)))
    return document_frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_learns_and_stands_awkward_rows(spark):
    docs, labels = toxic_frame(spark)
    labels = labels.union(spark.createDataFrame([(None, 1), (3, None), (0, 0)], "doc_id long, toxic int"))
    model = toxicity.fit(docs, labels.where("doc_id is null or doc_id % 3 <> 1"))
    assert 0 < len(model.keys) < 5000
    out = toxicity.with_scores(docs.unionByName(document_frame(spark, awkward())), model, "_toxicity")
    assert out.count() == docs.count() + len(awkward())
    got = {r["doc_id"]: r["_toxicity"] for r in toxicity.with_scores(docs, model, "_toxicity").collect()}
    held = [i for i in got if i % 3 == 1]
    right = sum((got[i] >= 0.7) == (i % 5 == 0) for i in held)
    assert right >= 0.98 * len(held)
    with pytest.raises(ValueError):
        toxicity.with_scores(docs, model, "score")


def test_a_round_sends_the_changes_of_one_task_at_a_time(spark, monkeypatch):
    sent = []
    collect = type(spark.range(1)).collect

    def recorded(self):
        rows = collect(self)
        if "dz" in self.columns:
            sent.append(len(rows))
        return rows

    monkeypatch.setattr(type(spark.range(1)), "collect", recorded)
    docs, labels = toxic_frame(spark, 400)
    toxicity.fit(docs, labels)
    # several tasks share the shards of a round
    assert sum(sent) == toxicity.SHARDS * toxicity.ROUNDS and max(sent) < toxicity.SHARDS


def test_a_round_sends_one_change_a_coordinate_however_many_shards_have_it(spark, monkeypatch):
    sent, made = [], []
    collect, discard = type(spark.range(1)).collect, toxicity.discard

    def recorded(self):
        rows = collect(self)
        if "dz" in self.columns:
            sent.append(sum(len(r["dz"]) + len(r["dn"]) for r in rows))
        return rows

    def seen(*tables):
        made.extend(r["at"] for t in tables if "at" in t.columns for r in collect(t.select("at")))
        discard(*tables)

    monkeypatch.setattr(type(spark.range(1)), "collect", recorded)
    monkeypatch.setattr(toxicity, "discard", seen)
    rows = [(i, words(50, 1) + (" bad" if i % 2 else ""), "en") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.fit(document_frame(spark, rows), labels)
    size = 1 + max(max(at) for at in made)
    assert size > 4 * 45 and len(model.keys)
    assert sum(sent) == toxicity.ROUNDS * size * 2 * 8


def test_toxicity_fits_without_coordinates(spark):
    docs = document_frame(spark, [(i, words(5, i) if i else None, "en") for i in range(10)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert len(model.keys) == 0 and np.isfinite(model.intercept)


def test_toxicity_without_labels(spark):
    docs, labels = toxic_frame(spark, 20)
    model = toxicity.fit(docs, labels.where("false"))
    assert {r["_t"] for r in toxicity.with_scores(docs, model, "_t").collect()} == {0.5}
    only = toxicity.fit(docs, labels.where("toxic = 1"))
    assert toxicity.with_scores(docs.where("false"), only, "_t").collect() == []


def test_ftrl_is_the_published_update():
    z, n, bias = np.zeros(2), np.zeros(2), [0.0, 0.0]
    toxicity.ftrl([(1, np.array([0])), (0, np.array([0, 1]))], z, n, bias)
    # first row: p = 1/2, g = -1/2, weights still 0
    z0, n0, b = -0.5, 0.25, [-0.5, 0.25]
    w0 = 0.0 if abs(z0) <= toxicity.L1 else None
    intercept = -b[0] / ((toxicity.BETA + b[1] ** 0.5) / toxicity.ALPHA)
    g = 1 / (1 + np.exp(-(w0 + intercept)))
    assert z[1] == pytest.approx(g) and n[1] == pytest.approx(g * g)
    assert z[0] == pytest.approx(z0 + g) and n[0] == pytest.approx(n0 + g * g)


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))


def plain_pieces(rows, capacity):
    tok = tokenizer()
    out = []
    for key, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        for k, i in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[i : i + capacity], dtype="<u4")
            out.append((key, k, i, len(part), zlib.crc32(part.tobytes())))
    return out


def check_packing(rows, capacity):
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in used.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


def test_pieces_and_packing(spark):
    odd = ["", "it's 'til <|endoftext|> <|ENDOFTEXT|>", "a.b,c!d 'station x'.t (''s", "Éa.É é. — ’s", "x y　z\x1cq"]
    rows = [(i, t) for i, t, _ in awkward()] + [(50 + i, t) for i, t in enumerate(odd)] + [(60 + i, words(i, i)) for i in range(200)]
    pieces = packing.token_pieces(document_frame(spark, [(i, t, "en") for i, t in rows]), queries.tokenizer_file("word_bpe_49k.json"), 512)
    got = packing.pack(pieces, 512, group=64).collect()
    assert in_order(tuple(r)[:5] for r in got) == in_order(plain_pieces(rows, 512))
    check_packing(got, 512)
    assert packing.pack(pieces.where("false")).collect() == []


def test_registered_packing_is_as_tight_as_can_be(spark):
    got = queries.QUERIES["op10_best_fit_packing"](spark, SF).collect()
    n = check_packing(got, 4096)
    assert n <= -(-sum(r["length"] for r in got) // 4096) + 1


def optimum(sizes, capacity):
    """Fewest bins, by trying all."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def test_bin_completion_finds_the_optimum():
    rng = np.random.default_rng(2)
    better = 0
    for _ in range(150):
        sizes = rng.integers(8, 60, rng.integers(1, 10)).tolist()
        bins = packing.complete(sizes, 100)
        assert sorted(s for b in bins for s in b) == sorted(sizes) and max(map(sum, bins)) <= 100
        assert len(bins) == optimum(sizes, 100)
        better += len(bins) < len(packing.best_fit(sorted(sizes, reverse=True), 100))
    assert better
