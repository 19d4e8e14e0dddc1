"""Small frames with the awkward rows that every operator has to stand."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n long, component string"


def document_frame(spark, rows):
    """documents with columns whose names clash with those that operators make."""
    full = [(i, t, lang, "s", None if t is None else len(t), 0.5, 7, "x") for i, t, lang in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def awkward():
    long = words(30_000, 1)
    base = words(200, 2)
    near = " ".join(base.split()[:-1] + ["changed"])
    return [
        (1, None, "en"),
        (2, "", "en"),
        (3, " \n\t ", None),
        (4, "one two", "fr"),
        (5, base, "en"),
        (6, base, "en"),
        (6, base, "en"),
        (7, near, "en"),
        (8, long, "en"),
        (9, long + " end", None),
        (None, base, "en"),
        (10, "Ünïcode 日本語 ▁ <|endoftext|> it's \x01", "de"),
        (11, words(50, 3) + "\n" + words(50, 4), "de"),
    ]
