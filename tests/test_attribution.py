"""Path attribution against a plain recursion, and its sum against the prediction."""

import random

import pytest

from hourloom.models import attribution, regressors

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1), 7.0, "train") for i in range(300)]
    rows = [(*r, 3 * r[1] + (2.0 if r[2] > 0 else -1.0) + rnd.gauss(0, 0.1)) for r in rows]
    return spark.createDataFrame(rows, "i int, a double, b double, c double, split string, y double")


def plain(stage, x):
    """Steps along one row's path, tree by tree."""
    out = {f: 0.0 for f in NAMES}
    for weight, node in attribution._trees(stage):
        while node.getClass().getSimpleName() != "LeafNode":
            split = node.split()
            child = node.leftChild() if x[split.featureIndex()] <= split.threshold() else node.rightChild()
            out[NAMES[split.featureIndex()]] += weight * (child.prediction() - node.prediction())
            node = child
    return out


@pytest.mark.parametrize("kind", ["forest", "tree", "boosted"])
def test_attributions_equal_a_recursion_and_add_up(spark, table, kind):
    estimators = {**regressors.tree_family("y", trees=4, depth=4), "boosted": regressors.boosted("y", rounds=4, depth=3, early=False)}
    model = regressors.train_one(estimators[kind], table, NAMES)
    stage = model.stages[-1]
    got = {(r.i, r.feature): r.attribution for r in attribution.attributions(model, table, NAMES, ["i"]).collect()}
    expected = attribution.leaf_steps(spark, stage, NAMES)[1]
    rows = {r.i: r for r in model.transform(table).collect()}
    for i in range(0, 300, 7):
        want = plain(stage, [rows[i][f] for f in NAMES])
        assert {f: got.get((i, f), 0.0) for f in NAMES} == pytest.approx(want, abs=1e-9)
        assert expected + sum(want.values()) == pytest.approx(rows[i].prediction, abs=1e-9)
    mean = {r.feature: r.importance for r in attribution.mean_attribution(model, table, NAMES, ["i"]).collect()}
    assert mean["c"] == 0.0 and mean["a"] > mean["b"] > 0
    assert mean["a"] == pytest.approx(sum(abs(got.get((i, "a"), 0.0)) for i in range(300)) / 300)
