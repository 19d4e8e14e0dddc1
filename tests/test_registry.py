"""The registry's history, and daily runs that forecast with the valid champions."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourloom.models import registry as reg
from hourloom.models import regressors
from hourloom.plans import daily
from hourloom.session import fresh_path

SCORES = "horizon int, rmse double, r2 double, path string"


@pytest.fixture
def registry(spark):
    return reg.Registry(spark, fresh_path(spark, "registry"))


@pytest.fixture
def table(series):
    return series([float(i % 24) for i in range(600)], column="pm2_5")


def run(spark, registry, table, scores, day):
    registry.record(reg.gate(spark.createDataFrame(scores, SCORES), registry, table), datetime(2024, 1, day))


def spans(df):
    return sorted((r.horizon, r.path, r.valid_from.day, r.valid_to.day if r.valid_to else None) for r in df.collect())


def test_history_of_promotions(spark, registry, table):
    assert registry.history().isEmpty()
    run(spark, registry, table, [(24, 10.0, 0.1, "a"), (48, 20.0, 0.1, "b")], 1)
    run(spark, registry, table, [(24, 9.0, 0.2, "c"), (48, 19.9, 0.2, "d"), (72, 30.0, 0.0, "e")], 2)
    run(spark, registry, table, [(24, 12.0, 0.2, "f"), (48, 15.0, 0.4, "g"), (72, None, None, "h")], 3)
    assert spans(registry.history()) == [(24, "a", 1, 2), (24, "c", 2, None), (48, "b", 1, 3), (48, "g", 3, None), (72, "e", 2, None)]
    now = {r.horizon: (r.path, r.rmse) for r in registry.champions().collect()}
    assert now == {24: ("c", 9.0), 48: ("g", 15.0), 72: ("e", 30.0)}
    assert {r.horizon: r.path for r in registry.champions(datetime(2024, 1, 1, 12)).collect()} == {24: "a", 48: "b"}
    assert registry.champions(datetime(2023, 12, 31)).isEmpty()
    told = {(r.run_at.day, r.horizon): r.promoted for r in registry.decisions().collect()}
    assert told == {(1, 24): False, (1, 48): False, (2, 24): True, (2, 48): False, (2, 72): False, (3, 24): False, (3, 48): True, (3, 72): False}


def test_a_table_that_fails_the_quality_gate_promotes_nothing(spark, registry, table):
    run(spark, registry, table, [(24, 10.0, 0.1, "a")], 1)
    run(spark, registry, table.limit(100), [(24, 1.0, 0.9, "b")], 2)
    assert [r.path for r in registry.champions().collect()] == ["a"]


def test_rows_find_the_champion_of_their_time(spark, registry, table):
    run(spark, registry, table, [(24, 10.0, 0.1, "a")], 1)
    run(spark, registry, table, [(24, 5.0, 0.1, "b")], 5)
    rows = spark.createDataFrame([(datetime(2024, 1, d), 24) for d in (1, 4, 5, 9)], "ts timestamp, horizon int")
    rows = rows.unionByName(rows.withColumn("ts", F.col("ts") - F.expr("INTERVAL 30 DAYS")).limit(1))
    got = reg.with_champion(rows, registry.history(), "ts").orderBy("ts").collect()
    assert [r.path for r in got] == [None, "a", "a", "b", "b"]


def test_the_forecast_comes_from_the_models_that_the_gate_left(spark, registry, series):
    """The second run's candidate is better for one horizon only, and only that horizon changes its model."""
    value = [60 + 40 * math.sin(i / 9) + (i * 37 % 11) for i in range(900)]
    hourly = series(value, column="pm2_5").withColumn("pm10", F.col("pm2_5") * 1.5)
    names = ["pm2_5", "hour_sin", "pm2_5_lag_24h"]
    weak = lambda t: regressors.linear(t, regParam=50.0, elasticNetParam=1.0)
    good = regressors.linear
    first = daily.daily_run(hourly, names, lambda t: good(t) if "24" in t else weak(t), registry, datetime(2024, 2, 1))
    paths = {r.horizon: r.path for r in registry.champions().collect()}
    second = daily.daily_run(hourly, names, lambda t: weak(t) if "24" in t else good(t), registry, datetime(2024, 2, 2))
    told = {r.horizon: r.promoted for r in second.decisions.collect()}
    assert told[24] is False and any(told.values())
    now = {r.horizon: r.path for r in registry.champions().collect()}
    assert now[24] == paths[24] and all((now[h] != paths[h]) == told[h] for h in told)
    a = {(r.station_id, r.horizon): r.prediction for r in first.forecast.collect()}
    b = {(r.station_id, r.horizon): r.prediction for r in second.forecast.collect()}
    for (station, h), p in b.items():
        assert (abs(p - a[station, h]) > 1e-9) == told[h]
    split = daily.learning_table(hourly, names, trim=False).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in split}["latest"] == 72
