"""Feature ranking and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.models import regressors
from hourloom.operators import profiles

def top_features(importance: DataFrame, k: int = 50) -> DataFrame:
    """The k highest ranked features; the name decides a tie."""
    return importance.orderBy(F.desc("importance"), "feature").limit(k)


def model_importance(model, features: list[str], spark) -> DataFrame:
    """Gain importance of a fitted tree model."""
    scores = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(f, float(s)) for f, s in zip(features, scores)], "feature string, importance double")


def permutation_importance(
    model, df: DataFrame, features: list[str], label: str, rows: int | None = None, seed: int = 42, bucket: int = 1000
) -> DataFrame:
    """Rise of the squared error when one column is shuffled, on the validation split (or a seeded sample of it).

    Rows are dealt by hash to buckets of about ``bucket`` rows, and in each a row takes the shuffled feature from
    the next one, the last from the first. Every row is copied once per feature, and all copies are
    scored in a single pass.
    """
    sample = df.where("split = 'validation'")
    if rows is not None:
        sample = profiles.seeded_sample(sample, rows, seed=seed)
    sample = sample.select(label, *features)
    mixed = F.xxhash64(F.lit(seed), *features)
    buckets = sample.agg(F.greatest(F.ceil(F.count(F.lit(1)) / bucket), F.lit(1)).alias("n")).scalar()
    sample = sample.withColumn("_bucket", F.pmod(F.xxhash64(mixed), buckets))
    order = Window.partitionBy("_bucket").orderBy(mixed)
    donor = F.lead(F.struct(*features), 1).over(order)
    first = F.first(F.struct(*features)).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    given = sample.withColumn("_d", F.coalesce(donor, first)).drop("_bucket")
    names = F.array(F.lit(""), *[F.lit(f) for f in features])
    copies = given.withColumn("feature", F.explode(names))
    shuffled = copies.withColumns(
        {f: F.when(F.col("feature") == f, F.col("_d")[f]).otherwise(F.col(f)) for f in features}
    )
    scored = model.transform(shuffled)
    error = scored.groupBy("feature").agg(F.sqrt(F.avg((F.col(label) - F.col("prediction")) ** 2)).alias("rmse"))
    base = error.where("feature = ''").select("rmse").scalar()
    return error.where("feature <> ''").select("feature", (F.col("rmse") - base).alias("importance"))


def select_features(df: DataFrame, features: list[str], label: str, k: int = 50, rounds: int = 20) -> list[str]:
    """Rank with a boosted model and keep the k best names (at most ``len(features)`` strings)."""
    from hourloom.operators.guards import check_names

    check_names(features)
    model = regressors.train_one(regressors.boosted(label, rounds=rounds), df, features)
    ranked = permutation_importance(model, df, features, label)
    return [row.feature for row in top_features(ranked, k).collect()]
