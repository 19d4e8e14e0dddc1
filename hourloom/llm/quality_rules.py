"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Every stratum (by default: language) gets its own cutoffs on a few text measures. A cutoff may be used only if the
labelled holdout shows, by an exact binomial test, that it rejects at most ``risk`` / (number of measures) of the good
texts of the stratum. Cutoffs of one measure are tested in a fixed sequence, the loosest first, up to the first failure,
which needs no correction; the level is divided by the number of measures in all strata. So with probability 1 - ``level``
no stratum loses more than ``risk`` of its good texts to the rules together. A stricter cutoff rejects all that a looser one
does, so the last of the sequence is the strictest cutoff that passes. The candidates are a fixed grid, so the whole holdout
serves as evidence.

Defined cases: null text counts as empty; a null stratum is a stratum of its own; a stratum with too few labelled good
texts gets no cutoff and keeps everything; several labels for an id: the smallest counts; null labels are not used;
repeated rows are judged alike; an empty table gives no rows; other columns are kept, whatever their names.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.storage import stored

BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20

RISK, LEVEL = 0.02, 0.05
#: Measures and the cutoffs tried: a text is rejected if the measure is above. They are shares of words or lines, but
#: for mean_word and short_word, characters a word.
GRID = {
    "symbol_share": [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8, 1.0, 1.5, 2.0],
    "dup_line_share": [0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8],
    "repeat_share": [0.01, 0.02, 0.05, 0.08, 0.1, 0.12, 0.15, 0.18],
    "mean_word": [7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0],
    "short_word": [-5.0, -4.5, -4.0, -3.5, -3.0, -2.5, -2.0],
}
MEASURES = list(GRID)


def unused(df: DataFrame, *stems: str) -> list[str]:
    """Names that no column has, made from the stems."""
    lead = "_"
    while any(c.lower().startswith(lead) for c in df.columns):
        lead += "_"
    return [lead + stem for stem in stems]


def with_features(docs: DataFrame, text: str = "text", name: str = "_q") -> DataFrame:
    """docs with the new struct ``name``: the base counts, base_failed, and the measures.

    Each row is handled alone, without a shuffle. Windows are compared by 64-bit hash, and only texts that have a
    repeated one sort theirs, with their places.
    """
    if name.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"docs has a column {name} already")
    t, w, l, h, again, s, p, r, c = unused(docs, "t", "w", "l", "h", "again", "s", "p", "r", "c")
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = docs.withColumn(t, whole)
    df = df.withColumn(w, F.filter(F.split(t, BLANK + "+"), lambda w: w != ""))
    df = df.withColumn(l, F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    hashed = F.expr(
        f"transform(sequence(0, size({w}) - {WINDOW}), i -> xxhash64({', '.join(f'{w}[i + {k}]' for k in range(WINDOW))}))"
    )
    none = F.array().cast("array<bigint>")
    df = df.withColumn(h, F.when(F.size(w) >= WINDOW, hashed).otherwise(none))
    df = df.withColumn(again, F.size(F.array_distinct(h)) < F.size(h))
    # places of windows that occur twice or more, in order of their hash; then in order of place
    sort = f"array_sort(transform({h}, (h, i) -> struct(h as h, i as i)))"
    df = df.withColumn(s, F.when(F.col(again), F.expr(sort)))
    near = (
        f"filter({s}, (x, j) -> (j > 0 and {s}[greatest(j - 1, 0)].h = x.h)"
        f" or (j < size({s}) - 1 and {s}[least(j + 1, size({s}) - 1)].h = x.h))"
    )
    df = df.withColumn(p, F.expr(f"sort_array(transform({near}, x -> x.i))"))
    covered = (
        f"aggregate({p}, struct(0L as n, -1 as upto), (a, p) -> struct(a.n + p + {WINDOW} - greatest(p, a.upto) as n,"
        f" p + {WINDOW} as upto), a -> a.n)"
    )
    df = df.withColumn(r, F.when(F.col(again), F.expr(covered)).otherwise(F.lit(0)).cast("long"))
    words, lines = F.size(w).cast("long"), F.size(l).cast("long")
    counts = F.struct(
        words.alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (lines - F.size(F.array_distinct(l))).alias("n_dup_lines"),
        F.col(r).alias("n_repeat_words"),
        lines.alias("n_lines"),
    )
    df = df.withColumn(c, counts).drop(t, w, l, h, again, s, p, r)
    n, per_word = F.col(f"{c}.n_words"), lambda m: F.col(f"{c}.{m}") / F.greatest(F.col(f"{c}.n_words"), F.lit(1))
    mean = per_word("word_chars")
    q = F.struct(
        f"{c}.*",
        ((n < LEAST_WORDS) | (F.col(f"{c}.n_repeat_words") * 100 > n * MOST_REPEATED)).alias("base_failed"),
        per_word("n_symbols").alias("symbol_share"),
        (F.col(f"{c}.n_dup_lines") / F.greatest(F.col(f"{c}.n_lines"), F.lit(1))).alias("dup_line_share"),
        per_word("n_repeat_words").alias("repeat_share"),
        mean.alias("mean_word"),
        (-mean).alias("short_word"),
    )
    return df.withColumn(name, q).drop(c)


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1: Stirling's series eight places up."""
    up = x + 8
    series = 1 / (12 * up) - 1 / (360 * up**3) + 1 / (1260 * up**5) - 1 / (1680 * up**7)
    far = (up - 0.5) * F.log(up) - up + F.lit(0.5) * F.log(F.lit(2 * pi)) + series
    for k in range(8):
        far = far - F.log(x + k)
    return far


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), for k below n * p.

    The terms are summed downward from k, each by its ratio to the one above. They fall at least geometrically; those
    beyond 400 + 40 sqrt(n) are below double precision.
    """
    log_top = (
        log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    )
    steps = F.least(k, F.lit(400) + 40 * F.sqrt(n)).cast("long")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(a, i):
        term = a["term"] * (k - i) * F.lit(1 - p) / ((n - k + i + 1) * F.lit(p))
        return F.struct(term.alias("term"), (a["total"] + term).alias("total"))

    indices = F.when(steps > 0, F.sequence(F.lit(0).cast("long"), steps - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.exp(log_top) * F.aggregate(indices, start, step, lambda a: a["total"])


def cutoffs(features: DataFrame, labels: DataFrame, stratum: str, risk: float = RISK, level: float = LEVEL, name: str = "_q") -> DataFrame:
    """(_stratum, one column of the least cutoff for each measure, null where none passes).

    features: doc_id, the stratum, the struct ``name``. labels: doc_id, quality (1 for good texts).
    """
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("_good")).where("_good = 1")
    held = features.select("doc_id", F.col(stratum).alias("_stratum"), F.col(name).alias("_q"))
    held = held.where("not _q.base_failed").join(good.select("doc_id"), "doc_id")
    rejected = [
        F.sum((F.col(f"_q.{m}") > c).cast("long")).alias(f"{m}|{i}") for m, grid in GRID.items() for i, c in enumerate(grid)
    ]
    counts = held.groupBy("_stratum").agg(F.count("*").alias("_n"), *rejected)
    tests = F.array(
        *(
            F.struct(F.lit(m).alias("measure"), F.lit(float(c)).alias("cutoff"), F.col(f"`{m}|{i}`").alias("k"))
            for m, grid in GRID.items()
            for i, c in enumerate(grid)
        )
    )
    rows = counts.select("_stratum", "_n", F.explode(tests).alias("t")).select("_stratum", "_n", "t.*")
    total = counts.agg(F.count("*").alias("_strata"))
    each = risk / len(MEASURES)
    rows = rows.withColumn("_tests", F.lit(len(MEASURES)) * total.scalar())
    k, n = F.col("k").cast("double"), F.col("_n").cast("double")
    chance = F.when(k < n * each, binomial_at_most(k, n, each)).otherwise(1.0)
    passed = rows.where(chance * F.col("_tests") <= level)
    least = [F.min(F.when(F.col("measure") == m, F.col("cutoff"))).alias(f"_at_{m}") for m in MEASURES]
    return passed.groupBy("_stratum").agg(*least)


def judged(
    features: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, level: float = LEVEL,
    name: str = "_q", kept: str = "_kept",
) -> DataFrame:
    """features (with the struct ``name``) and the new boolean ``kept``."""
    if kept.lower() in (c.lower() for c in features.columns):
        raise ValueError(f"features has a column {kept} already")
    limits = stored(cutoffs(features, labels, stratum, risk, level, name), "cutoffs")
    own, *at = unused(features, "stratum", *(f"at_{m}" for m in MEASURES))
    out = features.join(limits.toDF(own, *at), F.col(stratum).eqNullSafe(F.col(own)), "left")
    above = F.lit(False)
    for m, limit in zip(MEASURES, at):
        above = above | F.coalesce(F.col(f"{name}.{m}") > F.col(limit), F.lit(False))
    return out.withColumn(kept, ~F.col(f"{name}.base_failed") & ~above).drop(own, *at)
