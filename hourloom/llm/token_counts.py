"""Token counts of whole texts by a count-only Viterbi search over a unigram vocabulary.

The scores are those of the model file. For every distinct unit Aho-Corasick lists the pieces that end at each
character, and a table over the characters carries the best score and the number of tokens of the best way to get
there; no segmentation is kept. Ties are those of the tokenizer: it goes from left to right and replaces a way only
by a better one, so of equal ways the one whose last piece starts first wins. A character without a piece of its own
may be spelled as bytes, each a token, at a score below every piece. Scores are added in double precision and unit
by unit, without the single-precision rounding that the tokenizer's own sums suffer in long texts.

Defined cases: null or empty text has 0 tokens and score 0; a null id is kept as null; repeated rows count alike; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.storage import bounded_batches
from hourloom.llm.unigram import UnitTable, Vocabulary, unit_blocks


def best_count(vocabulary: Vocabulary, unit: str) -> tuple[float, int]:
    """Score and number of tokens of the best segmentation of one unit."""
    n = len(unit)
    ends: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    alone = [False] * n
    for end, match in vocabulary.automaton.iter(unit):
        ends[end].append(match)
        if match[0] == 1:
            alone[end] = True
    score, tokens, scores = [0.0] * (n + 1), [0] * (n + 1), vocabulary.score
    for end in range(n):
        best, count = None, 0
        if not alone[end]:
            ends[end].append((1, -1))
        for length, piece in ends[end]:  # the automaton names the longest first, so the earliest start wins a tie
            before = end + 1 - length
            if piece < 0:
                value, more = score[before] + vocabulary.unknown, len(unit[end].encode("utf-8"))
            else:
                value, more = score[before] + scores[piece], 1
            if best is None or value > best:
                best, count = value, tokens[before] + more
        score[end + 1], tokens[end + 1] = best, count
    return score[n], tokens[n]


class Results:
    """Scores and token numbers of the units in a table, as arrays that grow with it: a block adds only what is new."""

    def __init__(self):
        self.score, self.tokens, self.n = np.zeros(1024), np.zeros(1024, np.int64), 0

    def of(self, found: list) -> tuple[np.ndarray, np.ndarray]:
        if len(found) < self.n:  # the table began anew
            self.n = 0
        if len(found) > len(self.score):
            size = max(2 * len(self.score), len(found))
            self.score, self.tokens = np.resize(self.score, size), np.resize(self.tokens, size)
        if len(found) > self.n:
            self.score[self.n : len(found)], self.tokens[self.n : len(found)] = zip(*found[self.n :])
            self.n = len(found)
        return self.score, self.tokens


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, best_score for every row of (doc_id, text)."""

    def counted(batches):
        vocabulary = Vocabulary(model)
        table, results = UnitTable(lambda unit: best_count(vocabulary, unit)), Results()
        for batch in batches:
            for block in unit_blocks(batch.column("text")):
                slots = table.of(block)
                score, tokens = results.of(table.found)
                edges = np.concatenate([[0], np.cumsum(block.counts)])
                upto = [np.concatenate([[0], np.cumsum(x[slots])]) for x in (score, tokens)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(block.lo, block.hi - block.lo),
                        "n_tokens": pa.array(np.diff(upto[1][edges]), pa.int64()),
                        "best_score": pa.array(np.diff(upto[0][edges]), pa.float64()),
                    }
                )

    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        counted, f"doc_id {kind}, n_tokens long, best_score double"
    )
