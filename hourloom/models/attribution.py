"""Attribution of a tree ensemble's predictions to features, along the paths that rows take.

Stepping from a node to its child moves the prediction from the mean of the one to the mean of the other; the step is
put down to the feature that the node splits on. A row's attribution to a feature is the sum of such steps over all
trees, so that the expected value of the ensemble and all attributions add up to the prediction. Rows are assigned to leaves by the
model itself; what a leaf contributes is a small table (trees x leaves x features on the path) that follows from the
model alone and is joined and summed by DataFrame functions.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.models import regressors

STEPS = "tree int, leaf double, feature string, step double"


def _trees(stage) -> list[tuple[float, object]]:
    """(weight, root node) of each tree of a forest, boosted ensemble or single tree."""
    model = stage._java_obj
    if not hasattr(stage, "trees"):
        return [(1.0, model.rootNode())]
    weights = list(stage.treeWeights)
    averaged = type(stage).__name__.startswith("RandomForest")
    share = 1.0 / len(weights) if averaged else 1.0
    return [(w * share, t._java_obj.rootNode()) for w, t in zip(weights, stage.trees)]


def leaf_steps(spark: SparkSession, stage, features: list[str]) -> tuple[DataFrame, float]:
    """(tree, leaf, feature, step) for every leaf and feature on its path, leaves numbered from the left as the model
    numbers them; and the expected value of the ensemble, the weighted sum of the roots. As large as the model."""
    rows, expected = [], 0.0
    for tree, (weight, root) in enumerate(_trees(stage)):
        expected += weight * root.prediction()
        leaf, open_ = 0, [(root, {})]
        while open_:
            node, steps = open_.pop()
            if node.getClass().getSimpleName() == "LeafNode":
                rows += [(tree, float(leaf), f, s) for f, s in steps.items()]
                leaf += 1
                continue
            name = features[node.split().featureIndex()]
            for child in (node.rightChild(), node.leftChild()):
                moved = weight * (child.prediction() - node.prediction())
                open_.append((child, {**steps, name: steps.get(name, 0.0) + moved}))
    return spark.createDataFrame(rows, STEPS), expected


def attributions(model: PipelineModel, df: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """(keys, feature, attribution) in long form; features that no path of a row uses are left out. ``keys`` name a row."""
    from pyspark.ml.functions import vector_to_array

    spark, stage = df.sparkSession, model.stages[-1]
    steps, _ = leaf_steps(spark, stage, features)
    leaves = stage.copy({stage.leafCol: "_leaf"}).transform(regressors.assemble(features).transform(df))
    leaf = vector_to_array("_leaf") if hasattr(stage, "trees") else F.array(F.col("_leaf"))
    each = leaves.select(*keys, F.posexplode(leaf).alias("tree", "leaf"))
    # the table is part of the model; all steps of a row meet in its task before the shuffle
    return each.join(F.broadcast(steps), ["tree", "leaf"]).groupBy(*keys, "feature").agg(F.sum("step").alias("attribution"))


def mean_attribution(model: PipelineModel, df: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """(feature, importance): the mean size of a feature's attribution over all rows; 0 for features never used."""
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    found = attributions(model, df, features, keys).groupBy("feature").agg(F.sum(F.abs("attribution")).alias("_s"))
    listed = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return listed.join(F.broadcast(found), "feature", "left").select(
        "feature", F.coalesce(F.try_divide(F.col("_s"), rows.cast("double")), F.lit(0.0)).alias("importance")
    )
