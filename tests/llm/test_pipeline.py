"""The stages one after the other, each against a plain version of what it does."""

from pyspark.sql import functions as F

import corpus_pipeline
from hourloom.llm import ngram_join
from hourloom.llm.storage import stored
from tests.llm.helpers import DOC_SCHEMA, awkward, document_frame, words
from tests.llm.test_documents import check_packing, plain_base, plain_classes, plain_pieces, in_order

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, outs = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test")
        outs.append(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    toxic, good, unique, packed = outs
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    whole = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    gone = whole - set(ids(toxic))
    assert gone and all(marks.get(i, 1) for i in gone)
    texts = {r["doc_id"]: r["text"] for r in toxic.collect()}
    assert set(texts) - set(ids(good)) == {i for i, t in texts.items() if plain_base(t)[-1]}
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert ids(unique) == sorted({c for _, _, c in plain_classes(rows, 5, 80)})
    left = [(r["doc_id"], r["text"]) for r in unique.collect()]
    got = packed.collect()
    assert in_order(tuple(r)[:5] for r in got) == in_order(plain_pieces(left, 4096))
    check_packing(got, 4096)


def test_awkward_rows_and_empty_tables(spark):
    frame = document_frame(spark, awkward())
    toxic = corpus_pipeline.toxic_out(spark, frame, SF)
    assert toxic.count() == len(awkward())
    good = stored(corpus_pipeline.low_quality_out(spark, frame, SF), "test")
    assert ids(good.where("doc_id is not null")) == [5, 6, 6, 7, 8, 9, 11]
    unique = corpus_pipeline.near_duplicates_out(spark, frame, SF)
    assert sorted((r["doc_id"] or 0) for r in unique.collect()) == [1, 2, 3, 4, 5, 8, 10, 11]
    assert sum(r["length"] > 0 for r in corpus_pipeline.packed(spark, frame, SF).collect()) >= len(awkward())
    nothing = spark.createDataFrame([], DOC_SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).collect() == []


def test_a_repeated_id_with_its_text_stays_once(spark):
    rows = [(1, "a b c d e f g", "en"), (1, "a b c d e f g", "en"), (2, "", "en"), (2, "", "en")]
    kept = corpus_pipeline.near_duplicates_out(spark, document_frame(spark, rows), SF)
    assert ids(kept) == [1, 2, 2]


def test_a_repeated_id_loses_no_text(spark):
    a, p = words(60, 5), words(60, 6)
    near = lambda text: " ".join(text.split()[:-1] + ["changed"])
    rows = [(5, near(a), "en"), (2, a, "en"), (5, near(p), "en"), (3, p, "en"), (None, p, "en"), (None, words(60, 7), "en")]
    frame = document_frame(spark, rows + rows[-1:])
    got = ngram_join.row_classes(frame).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (0, 0), (0, 3), (2, 2), (3, 3), (5, 2), (5, 3)]
    assert len({r["class"] for r in got}) == 3
    kept = corpus_pipeline.near_duplicates_out(spark, frame, SF).collect()
    assert {(r["doc_id"], r["text"]) for r in kept} == {(2, a), (3, p), (None, words(60, 7))} and len(kept) == 3


def test_columns_keep_their_names_and_values(spark):
    frame = document_frame(spark, awkward())
    names = ["_t", "_c", "_q", "_stratum", "_kept", "_toxicity", "class", "text_hash", "f1"]
    frame = frame.withColumns({c: F.lit(c) for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, frame, SF), "test")
        assert out.columns == frame.columns
        assert out.select(*names).distinct().collect() == [tuple(names)]
