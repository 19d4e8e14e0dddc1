"""The registered queries of the numbered operators, with production parameters, on their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm.sql import ORACLES  # noqa: F401  (read from here with the queries)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourloom.llm import packing

    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return packing.pack(pieces)


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourloom.llm import ngram_join

    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=85)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourloom.llm import toxicity

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    model = toxicity.fit(docs, labels.where(~held_out))
    scored = toxicity.with_scores(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourloom.llm import quality_rules
    from hourloom.llm.storage import stored

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    features = stored(quality_rules.with_features(docs).drop("text"), "features")
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return quality_rules.judged(features, table(spark, sf_dir, "labels")).select(
        "doc_id", *(f"_q.{c}" for c in base), F.col("_kept").alias("kept")
    )


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourloom.llm import token_counts

    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op6_segment_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourloom.llm import segment_sampling

    return segment_sampling.sample_segmentations(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourloom.llm import url_filters

    rules = [
        ("com", "/", "allow"),
        ("example.com", "/en/", "block"),
        ("www.example.com", "/en/", "allow"),
        ("net", "/es/", "block"),
        ("net", "/fr/", "block"),
    ]
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    return url_filters.judged(table(spark, sf_dir, "pages"), listed)


@query
def op7_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourloom.llm import page_text

    texts = page_text.main_texts(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query
def op5_embedding_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourloom.llm import hnsw

    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op2_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    from hourloom.llm import chat_trees

    odd = r"\### Assistant: </turn> ok"
    extra = [(-7, 0, "user", odd), (-7, 1, "assistant", odd)]
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(extra, "conv_id long, turn long, role string, text string"))
    # a conversation is a tree without branches: each row answers the one before it
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = rows.withColumn("message_id", place).withColumn("parent_id", F.col("message_id") - 1)
    messages = rows.select(F.col("conv_id").alias("tree_id"), "message_id", "parent_id", F.lit(0.0).alias("score"), "role", "text")
    return chat_trees.read_digests(chat_trees.conversations(messages))


@query
def op11_jacobi_davidson_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourloom.llm import whitening

    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op12_two_pass_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourloom.llm import exact_dedup

    found = exact_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query
def op13_trie_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourloom.llm import vector_codes

    codes, books = vector_codes.compressed(table(spark, sf_dir, "embeddings"))
    digest = vector_codes.books_sha256(books) if books is not None else None
    return vector_codes.with_label_errors(codes).select(
        F.col("key").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
