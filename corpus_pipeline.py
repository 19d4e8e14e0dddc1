"""From raw documents to packed training sequences: toxicity, quality, near duplicates, packing.

Every stage takes what the one before kept. A rejected document leaves with its row; all but the last stage return the
columns of documents. Labels train the toxicity model and hold out the quality cutoffs; they never decide on a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm import ngram_join, packing, quality_rules, toxicity
from hourloom.llm.queries import table, tokenizer_file
from hourloom.llm.storage import stored

#: A document at or above this score is rejected.
TOXIC = 0.7


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = quality_rules.unused(docs, "toxicity")
    return toxicity.with_scores(docs, model, score).where(F.col(score) < TOXIC).drop(score)


def low_quality_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name, kept = quality_rules.unused(docs, "measures", "kept")
    features = stored(quality_rules.with_features(docs, name=name), "features")
    judged = quality_rules.judged(features, table(spark, sf_dir, "labels"), name=name, kept=kept)
    return judged.where(kept).select(*docs.columns)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class stays: of the smallest id, null last, then of one text; texts without words are no copies.

    Rows are told apart by id and text, so an id that is repeated with another text loses neither to the other's class.
    """
    classes = stored(ngram_join.row_classes(docs, n=5, percent=80), "classes").where("n_shingles > 0")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    stays = classes.groupBy("class").agg(F.min(row).alias("row")).select("row.*")
    rows = classes.groupBy("doc_id", "text_hash").count()
    same = lambda x, y: x["doc_id"].eqNullSafe(y["doc_id"]) & (x["text_hash"] == y["text_hash"])
    gone = stored(rows.join(stays, same(rows, stays), "left_anti").select("doc_id", "text_hash"), "gone")
    again = stored(rows.where("count > 1").join(stays, same(rows, stays), "left_semi").select("doc_id", "text_hash"), "again")
    keys = quality_rules.unused(docs, "id", "hash")
    keyed = docs.withColumns(dict(zip(keys, (F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))))))
    listed = lambda rows: F.col(keys[0]).eqNullSafe(rows["doc_id"]) & (F.col(keys[1]) == rows["text_hash"])
    kept = keyed.join(gone, listed(gone), "left_anti")
    if not again.isEmpty():
        once = kept.join(again, listed(again), "left_semi").dropDuplicates(keys)
        kept = kept.join(again, listed(again), "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(docs, tokenizer_file("word_bpe_49k.json")))


STAGES = [
    ("toxicity", toxic_out),
    ("quality rules", low_quality_out),
    ("n-gram Jaccard join", near_duplicates_out),
    ("best-fit packing", packed),
]

#: No SQL says a fitted model or a packing; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
