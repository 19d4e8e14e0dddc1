import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.models import forecast, neighbours, regressors, selection
from hourloom.operators import splits


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(400):
        a, b = rnd.gauss(0, 2), rnd.gauss(5, 1)
        rows.append(("s", i, a, b, rnd.random(), 3 * a - b + rnd.gauss(0, 0.1)))
    df = spark.createDataFrame(rows, "station_id string, i int, a double, b double, c double, y double")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("i") * 3600)).drop("i")
    return splits.temporal_split(df).cache()


def test_ridge_equals_the_closed_form(table):
    train = table.where("split = 'train'")
    model = regressors.fit(regressors.linear_family(train, "y", ridge=5.0)["ridge"], train, ["a", "b"]).stages[-1]
    rows = np.array(train.select("a", "b", "y").collect(), dtype=float)
    x, y = rows[:, :2] - rows[:, :2].mean(axis=0), rows[:, 2] - rows[:, 2].mean()
    want = np.linalg.solve(x.T @ x + 5.0 * np.eye(2), x.T @ y)
    np.testing.assert_allclose(model.coefficients.toArray(), want, rtol=2e-3)


def test_leaderboard_blend_and_importance(spark, table):
    features = ["a", "b", "c"]
    make = lambda t: {"ols": regressors.linear(t), "tree": regressors.tree_family(t, depth=3)["tree"]}
    models, predictions = regressors.train_all(table, features, {24: "y"}, make)
    board = {r.model: r.rank for r in regressors.leaderboard(predictions).collect()}
    assert board == {"ols": 1, "tree": 2}
    weights, _, blended = regressors.linear_blend(predictions, ["ols", "tree"])
    assert weights["ols"] > 0.8 and blended.count() == 80
    ranked = selection.permutation_importance(models["ols", 24], table, features, "y").collect()
    score = {r.feature: r.importance for r in ranked}
    assert score["a"] > score["b"] > abs(score["c"])


def test_search_picks_the_lowest_error(table):
    make = lambda t, depth: regressors.tree_family(t, depth=depth)["tree"]
    _, setting, trials = regressors.param_search(table, ["a", "b"], "y", make, regressors.grid({"depth": [1, 5]}))
    assert setting == {"depth": 5} and trials.count() == 2
    draws = regressors.random_draws({"x": range(10), "y": range(10)}, 5)
    assert draws == regressors.random_draws({"x": range(10), "y": range(10)}, 5) and len(draws) == 5


@pytest.mark.parametrize("pivots, chunk", [(2048, 20_000), (3, 7), (1, 5)])
def test_knn_equals_brute_force(spark, monkeypatch, pivots, chunk):
    monkeypatch.setattr(neighbours, "MAX_PIVOTS", pivots)
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", chunk)
    rnd = random.Random(6)
    # a third of the rows sits on one spot
    points = [(0.0, 0.0) if i % 3 == 0 else (rnd.gauss(0, 1), rnd.gauss(0, 1)) for i in range(90)]
    train = [(f"t{i:03d}", *p, rnd.random()) for i, p in enumerate(points)]
    asked = [(f"q{i:03d}", rnd.gauss(0, 1), rnd.gauss(0, 1), 0.0) for i in range(30)] + [("zero", 0.0, 0.0, 0.0)]
    schema = "id string, a double, b double, y double"
    got = neighbours.knn_regress(
        spark.createDataFrame(train, schema), spark.createDataFrame(asked, schema), ["a", "b"], "y", ["id"], k=5
    ).collect()
    assert len(got) == len(asked)
    for row in got:
        q = next(x for x in asked if x[0] == row.id)
        near = sorted((np.hypot(q[1] - t[1], q[2] - t[2]), t[0], t[3]) for t in train)[:5]
        same = [y for d, _, y in near if d == 0]
        want = np.mean(same) if same else sum(y / d for d, _, y in near) / sum(1 / d for d, _, y in near)
        assert row.prediction == pytest.approx(want)


def test_knn_with_fewer_rows_than_k(spark):
    train = spark.createDataFrame([("t", 1.0, 4.0)], "id string, a double, y double")
    asked = spark.createDataFrame([("q", 9.0, 0.0)], "id string, a double, y double")
    assert neighbours.knn_regress(train, asked, ["a"], "y", ["id"]).first().prediction == 4.0


def test_gate_never_promotes_on_the_first_run(spark, table):
    cand = spark.createDataFrame([(24, 5.0, 0.5)], "horizon int, rmse double, r2 double")
    first = forecast.champion_gate(cand, None, table).first()
    assert not first.promoted and first.rmse == 5.0
    seeded = spark.createDataFrame([(24, first.rmse, first.r2)], "horizon int, rmse double, r2 double")
    better = spark.createDataFrame([(24, 4.0, 0.6)], "horizon int, rmse double, r2 double")
    # the table is too short for promotion until the row limit allows it
    assert not forecast.champion_gate(better, seeded, table).first().promoted
    assert forecast.champion_gate(better, seeded, table, min_rows=100).first().promoted


def test_forecast_carries_a_missing_long_horizon(table):
    model = regressors.train_one(regressors.linear("y"), table, ["a", "b"])
    got = forecast.forecast_latest(table, ["a", "b"], {24: model}).orderBy("horizon").collect()
    assert [r.horizon for r in got] == [24, 48, 72]
    assert got[0].prediction == got[1].prediction == got[2].prediction
    partly = forecast.forecast_latest(table, ["a", "b"], {24: model, 72: model}).orderBy("horizon").collect()
    assert partly[1].prediction is None
