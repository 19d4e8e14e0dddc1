"""Unigram operators against the tokenizer library and full enumeration."""

import math
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from hourloom.llm import segment_sampling, token_counts
from hourloom.llm.queries import tokenizer_file
from hourloom.llm.unigram import MARK, Vocabulary
from tests.llm.helpers import DOC_SCHEMA, awkward, document_frame

MODEL = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(MODEL)


@pytest.fixture(scope="module")
def library():
    """The tokenizer's own unigram search over the same pieces and scores.

    The file's score for runs of spaces, -1e9, would leave nothing of the others in the tokenizer's single-precision
    sums, so they get one just below all others; the units compared have no such runs.
    """
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    for piece in model.pieces:
        piece.score = max(piece.score, -40_000)
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_counts_and_ties_are_the_tokenizers(spark, vocabulary, library):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).select("text").collect()
    units = sorted({w for r in texts for w in r["text"].split()})
    assert len(units) > 1000
    for unit in units:
        assert token_counts.best_count(vocabulary, MARK + unit)[1] == len(library.encode(unit)), unit


def test_best_score_is_the_best_of_all(vocabulary):
    def every(unit, i=0):
        if i == len(unit):
            yield ()
        for j in range(i + 1, len(unit) + 1):
            if unit[i:j] in ids:
                for rest in every(unit, j):
                    yield (ids[unit[i:j]], *rest)

    ids = {vocabulary.pieces[i]: i for i in vocabulary.score}
    for unit in ("▁abab", "▁theatre", "aaaa", "▁▁x"):
        score, n = token_counts.best_count(vocabulary, unit)
        sums = [(sum(vocabulary.score[p] for p in way), len(way)) for way in every(unit)]
        assert score == max(s for s, _ in sums) and (score, n) in sums


def test_counts_of_awkward_rows(spark):
    got = token_counts.token_counts(document_frame(spark, awkward()), MODEL).collect()
    assert len(got) == len(awkward())
    by = {r["doc_id"]: r["n_tokens"] for r in got}
    assert by[1] == by[2] == 0 and by[5] == by[6] == by[None]
    assert token_counts.token_counts(spark.createDataFrame([], DOC_SCHEMA), MODEL).collect() == []


def run(texts, k, keys=None):
    keys = keys or range(len(texts))
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts), "seed": pa.array([i * 7919 for i in keys], pa.int64())}
    )
    return pa.Table.from_batches(list(segment_sampling.sample_rows(iter([batch]), MODEL, k, True))).to_pylist()


def ways(vocabulary, text):
    weight = segment_sampling.weights(vocabulary)
    ids = {vocabulary.pieces[i]: i for i in vocabulary.score}
    unit, out = MARK + text.replace(" ", MARK), {}

    def walk(i, taken, p):
        if i == len(unit):
            out[taken] = p
        for j in range(i + 1, len(unit) + 1):
            if unit[i:j] in ids:
                walk(j, (*taken, ids[unit[i:j]]), p * weight[ids[unit[i:j]]])

    walk(0, (), 1.0)
    total = sum(out.values())
    return {w: p / total for w, p in out.items()}


def test_samples_have_the_right_chances(vocabulary):
    for text, k in (("the", 1), ("on a", 2), ("ab", 3)):
        chance, n = ways(vocabulary, text), 4000
        rows = run([text] * n, k)
        by = defaultdict(dict)
        for r in rows:
            by[r["doc_id"]][r["sample"]] = r
            assert r["decodes"] and math.exp(r["log_prob"]) == pytest.approx(chance[tuple(r["ids"])], rel=1e-6)
        first = Counter(tuple(v[0]["ids"]) for v in by.values())
        for way, p in chance.items():
            assert first[way] / n == pytest.approx(p, abs=4 * math.sqrt(p * (1 - p) / n) + 1e-3)
        for v in by.values():
            assert len({tuple(r["ids"]) for r in v.values()}) == len(v) == min(k, len(chance))
            values = [v[i]["perturbed"] for i in sorted(v)]
            assert values == sorted(values, reverse=True)
        if k > 1:  # without replacement: the second follows the rest of the chances
            top = max(chance, key=chance.get)
            second = Counter(tuple(v[1]["ids"]) for v in by.values() if tuple(v[0]["ids"]) == top)
            m = sum(second.values())
            for way, p in chance.items():
                if way != top:
                    q = p / (1 - chance[top])
                    assert second[way] / m == pytest.approx(q, abs=4 * math.sqrt(q * (1 - q) / m) + 2e-3)
            weighted = [sum(math.exp(r["log_prob"] - r["log_inclusion"]) for r in v.values()) for v in by.values()]
            assert sum(weighted) / n == pytest.approx(1, abs=0.02)


def test_all_ways_are_found_when_few(vocabulary):
    chance = ways(vocabulary, "ab")
    got = run(["ab"], 50)
    assert {tuple(r["ids"]) for r in got} == set(chance) and {r["log_inclusion"] for r in got} == {0.0}


def test_samples_do_not_depend_on_batches(vocabulary):
    texts = ["the theatre on the hill", "日本 ﬁ\n\tx  y ", "abc" * 50]
    together = run(texts, 3, keys=[1, 2, 3])
    for i, text in enumerate(texts):
        alone = run([text], 3, keys=[i + 1])
        assert [r["ids"] for r in alone] == [r["ids"] for r in together if r["doc_id"] == i]


def test_samples_of_awkward_rows(spark):
    rows = document_frame(spark, awkward())
    got = segment_sampling.sample_segmentations(rows, MODEL, 2).collect()
    assert all(r["decodes"] for r in got)
    assert Counter(r["doc_id"] for r in got)[1] == Counter(r["doc_id"] for r in got)[2] == 1
    assert Counter(r["doc_id"] for r in got)[6] == 4
    assert segment_sampling.sample_segmentations(rows.where("false"), MODEL).collect() == []
