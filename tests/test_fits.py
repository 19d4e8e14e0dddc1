"""Fits per series, the focus-weighted fit, and the search by halving."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.functions import fixed
from hourloom.models import focus, regressors, search, series_fit


def frame(spark, sizes, seed=1, offset=0.0):
    rnd = random.Random(seed)
    rows = []
    for g, n in sizes.items():
        for i in range(n):
            a, b = offset + rnd.gauss(0, 1), rnd.gauss(0, 2)
            rows.append((g, i, a, b, a + 2 * b, 3 + 2 * a - b + rnd.gauss(0, 0.1), rnd.random()))
    return spark.createDataFrame(rows, "station_id string, i int, a double, b double, c double, y double, w double"), rows


def test_fit_of_every_series_equals_a_dense_solver(spark):
    """One station holds most rows; offsets are large; c follows from a and b."""
    df, rows = frame(spark, {"big": 2000, "small": 12, "tiny": 2}, offset=1e6)
    got = {r.station_id: r for r in series_fit.fit_per_series(df, ["a", "b", "c"], "y", weight="w").collect()}
    for g in ("big", "small"):
        own = np.array([r[2:] for r in rows if r[0] == g])
        x, y, w = own[:, :2], own[:, 3], own[:, 4]
        root = np.sqrt(w)[:, None]
        mean = (w @ x) / w.sum()
        want = np.linalg.lstsq(root * np.column_stack([np.ones(len(x)), x - mean]), root[:, 0] * y, rcond=None)[0]
        assert [got[g].a, got[g].b] == pytest.approx(want[1:], rel=1e-6) and got[g].c == 0.0
        assert got[g].n == len(own) and 0.98 < got[g].r2 <= 1.0
    assert got["tiny"].b == 0.0


def test_nulls_constants_ridge_and_prediction(spark):
    df, _ = frame(spark, {"x": 50})
    df = df.withColumn("one", F.lit(4.0)).withColumn("y", F.when(F.col("i") % 7 > 0, F.col("y")))
    fit = series_fit.fit_per_series(df, ["one", "a"], "y")
    row = fit.first()
    assert row.one == 0.0 and row.n == 42
    shrunk = series_fit.fit_per_series(df, ["one", "a"], "y", ridge=1e6).first()
    assert abs(shrunk.a) < 1e-3 < abs(row.a)
    got = series_fit.predict_per_series(df.unionByName(df.limit(1).withColumn("station_id", F.lit("new"))), fit, ["one", "a"])
    assert got.where("station_id = 'new'").first().prediction is None
    assert got.where("station_id = 'x' AND i = 3").first().prediction == pytest.approx(row.intercept + row.a * df.where("i = 3").first().a)


@pytest.fixture(scope="module")
def table(spark):
    """A learning table whose three targets follow different slopes."""
    rnd = random.Random(2)
    rows = []
    for i in range(600):
        a = rnd.gauss(0, 1)
        split = "train" if i < 360 else "validation" if i < 480 else "test"
        rows.append(("s", i, a, rnd.gauss(0, 1), split, *(10.0 * k + slope * a + rnd.gauss(0, 0.3) for k, slope in ((1, 1.0), (2, 4.0), (3, 1.0)))))
    df = spark.createDataFrame(rows, f"station_id string, ts int, a double, b double, split string, {', '.join(f'{t} double' for t in fixed.TARGETS)}")
    return df.withColumn("ts", F.timestamp_seconds(F.col("ts") * 3600))


def test_the_focus_horizon_weighs_more(table):
    slopes = {}
    for weight in (1.0, 2.0, 50.0):
        name, model, columns, errors, scored = focus.focused_fit(table, ["a"], 48, {"ols": regressors.linear(focus.LABEL)}, weight)
        slopes[weight] = float(model.stages[-1].coefficients[0])
    assert slopes[1.0] == pytest.approx(2.0, abs=0.15) and slopes[2.0] == pytest.approx(2.5, abs=0.15) and slopes[50.0] > 3.7
    assert name == "ols" and columns == ["a", "is_48h", "is_72h"] and scored.select("horizon").distinct().count() == 3


def test_the_model_with_the_smaller_weighted_error_is_chosen(table):
    tried = {"lasso": regressors.linear(focus.LABEL, regParam=5.0, elasticNetParam=1.0), "ols": regressors.linear(focus.LABEL)}
    name, _, _, errors, _ = focus.focused_fit(table, ["a"], 48, tried)
    found = {r.model: r.weighted_mse for r in errors.collect()}
    assert name == "ols" and found["ols"] < found["lasso"]


def test_draws_are_the_same_again_and_within_their_ranges():
    space = {"x": search.LogUniform(0.01, 100.0), "n": search.Integer(3, 6), "u": search.Uniform(1, 2), "c": search.Choice(("p", "q"))}
    drawn = search.draws(space, 400, seed=7)
    assert drawn == search.draws(space, 400, seed=7) and drawn[:5] == search.draws(space, 5, seed=7)
    assert all(0.01 <= d["x"] <= 100 and d["n"] in (3, 4, 5) and 1 <= d["u"] <= 2 and d["c"] in "pq" for d in drawn)
    assert 0.4 < np.mean([d["x"] < 1 for d in drawn]) < 0.6


def test_halving_finds_the_setting_that_trying_all_finds(table):
    settings = [{"regParam": v, "elasticNetParam": 1.0} for v in (5.0, 0.001, 2.0, 1.0)]
    _, best, trials = search.successive_halving(table, ["a", "b"], fixed.TARGETS[0], regressors.linear, settings, factor=2)
    _, exhaustive, _ = regressors.param_search(table, ["a", "b"], fixed.TARGETS[0], regressors.linear, settings)
    assert best == exhaustive == settings[1]
    told = [(r["round"], r["count"]) for r in trials.groupBy("round").count().orderBy("round").collect()]
    assert told == [(0, 4), (1, 2), (2, 1)]
    assert trials.where("round = 2").first().share == 1.0


def test_smaller_shares_lie_in_larger_ones(table):
    rows = {s: {r.ts for r in search.row_share(table, s).where("split = 'train'").collect()} for s in (0.2, 0.5, 1.0)}
    assert rows[0.2] < rows[0.5] < rows[1.0] and 40 < len(rows[0.2]) < 110
    assert search.row_share(table, 0.2).where("split <> 'train'").count() == 240
