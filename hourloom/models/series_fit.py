"""Least squares for every series at once: one aggregate of cross products, solved by expressions.

A model per station does not need a fit per station. The sums that the normal equations consist of add up, so one
grouped aggregate, combined in the map tasks, gathers them for all series, and a station with a third of all rows is as
good as any other. Each series then is one row, whose small system is eliminated column by column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.operators.layout import KEYS, computed_once

#: A feature whose share that the ones before it do not explain is smaller than this gets the coefficient 0.
COLLINEAR = 1e-10


def cross_products(df: DataFrame, features: list[str], label: str, keys=KEYS, weight: str | None = None) -> DataFrame:
    """Per series: rows, weights and means, and centred weighted products ``_a_i_j`` (features) and ``_b_i`` (with the
    label, index k). Rows with a NULL in any of them are left out. Products are taken about the mean of the series, which
    is joined first, so that offsets cost no digits."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    columns = [*features, label]
    rows = df.select(*keys, w.alias("_w"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])
    rows = rows.na.drop(subset=["_w", *[f"_x{i}" for i in range(len(columns))]]).where("_w > 0")
    means = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_w").alias("weight"),
        *[(F.sum(F.col("_w") * F.col(f"_x{i}")) / F.sum("_w")).alias(f"_m{i}") for i in range(len(columns))],
    )
    d = [F.col(f"_x{i}") - F.col(f"_m{i}") for i in range(len(columns))]
    products = {f"_p_{i}_{j}": F.sum(F.col("_w") * d[i] * d[j]) for i in range(len(columns)) for j in range(i, len(columns))}
    kept = ["n", "weight", *[f"_m{i}" for i in range(len(columns))]]
    sums = rows.join(means, list(keys)).groupBy(*keys).agg(*[F.first(c).alias(c) for c in kept], *[e.alias(n) for n, e in products.items()])
    return sums


def fit_per_series(df: DataFrame, features: list[str], label: str, keys=KEYS, weight: str | None = None, ridge: float = 0.0) -> DataFrame:
    """(keys, n, intercept, a column of coefficients for each feature, r2) of every series.

    ``ridge`` is added to the diagonal; the intercept is not shrunk. Coefficients of features that are constant or follow
    from those before them are 0.
    """
    k = len(features)
    sums = cross_products(df, features, label, keys, weight)

    def p(i: int, j: int) -> Column:
        return F.col(f"_p_{min(i, j)}_{max(i, j)}")

    system = {f"_s_{i}_{j}": p(i, j) + F.lit(float(ridge) if i == j else 0.0) for i in range(k) for j in range(k + 1)}
    now = computed_once(sums, system)
    for step in range(k):  # Gauss-Jordan; each step is computed once, for expressions would double at every one
        pivot = F.col(f"_s_{step}_{step}")
        sound = pivot > F.lit(COLLINEAR) * p(step, step)
        row = {j: F.when(sound, F.col(f"_s_{step}_{j}") / pivot).otherwise(F.lit(0.0)) for j in range(step, k + 1)}
        new = {}
        for i in range(k):
            for j in range(step, k + 1):
                old = F.col(f"_s_{i}_{j}")
                new[f"_t_{i}_{j}"] = row[j] if i == step else F.when(sound, old - F.col(f"_s_{i}_{step}") * row[j]).otherwise(old)
        kept = [c for c in now.columns if not c.startswith("_s_")]
        later = [f"_s_{i}_{j}" for i in range(k) for j in range(step)]
        now = computed_once(now, new).select(*kept, *later, *[F.col(f"_t_{i}_{j}").alias(f"_s_{i}_{j}") for i in range(k) for j in range(step, k + 1)])
    beta = [F.col(f"_s_{i}_{k}") for i in range(k)]
    intercept = sum([-b * F.col(f"_m{i}") for i, b in enumerate(beta)], F.col(f"_m{k}"))
    told = sum([2 * b * p(i, k) for i, b in enumerate(beta)], F.lit(0.0))
    model = sum([beta[i] * beta[j] * p(i, j) for i in range(k) for j in range(k)], F.lit(0.0))
    r2 = F.try_divide(told - model, p(k, k))
    return now.select(*keys, "n", intercept.alias("intercept"), *[b.alias(f) for b, f in zip(beta, features)], r2.alias("r2"))


def predict_per_series(df: DataFrame, fits: DataFrame, features: list[str], keys=KEYS, out: str = "prediction") -> DataFrame:
    """df with the value of its series' model; NULL for a series without one."""
    named = fits.select(*keys, F.struct("intercept", *features).alias("_f"))
    value = sum([F.col(f).cast("double") * F.col("_f")[f] for f in features], F.col("_f.intercept"))
    return df.join(named, list(keys), "left").withColumn(out, value).drop("_f")
