import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.operators import guards, joins, metrics, profiles, stats
from hourloom.sources import readers, sinks
from hourloom.session import fresh_path


def spread(kind, n, rnd):
    """Values that crowd, repeat, or lie many powers of ten apart."""
    make = {
        "mixed": lambda: rnd.choice([1.0, 2.0, 2.0, rnd.gauss(0, 1), rnd.expovariate(1) * 1e6]),
        "powers": lambda: rnd.choice([-1, 1]) * 2.0 ** rnd.uniform(-1000, 1000),
        "offset": lambda: 1e12 + rnd.random(),
        "constant": lambda: 3.5,
        "ends": lambda: rnd.choice([-8e307, 8e307, 0.0, 5e-324, -5e-324]),
    }[kind]
    return [make() for _ in range(n)]


@pytest.mark.parametrize("kind,limit", [("mixed", 40), ("mixed", 1 << 16), ("powers", 40), ("offset", 1), ("constant", 40), ("ends", 1)])
def test_quantiles_are_exact_whatever_a_task_may_sort(spark, limit, kind):
    """Group x holds most rows; y is small, z has one value, and the null group counts too."""
    rnd = random.Random(4)
    groups = {"x": spread(kind, 3000, rnd), "y": spread(kind, 30, rnd), "z": [7.0], None: spread(kind, 100, rnd)}
    rows = [(g, v) for g, values in groups.items() for v in [*values, None, float("nan")]]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = stats.exact_quantiles(df, ["v"], probs, keys=("g",), limit=limit).collect()
    assert len(got) == len(groups) * len(probs)
    for row in got:
        own, at = sorted(groups[row.g]), row.prob * (len(groups[row.g]) - 1)
        a, b = own[int(at)], own[-int(-at // 1)]
        assert row.value == pytest.approx(a + (b - a) * (at - int(at)), rel=1e-12)


def test_no_task_ranks_more_than_its_limit(spark):
    """One station holds 90 % of the rows; what is left to sort for it is a small range."""
    df = spark.range(50_000).select(
        F.when(F.col("id") % 10 == 0, F.lit("b")).otherwise(F.lit("a")).alias("g"), (F.hash("id") / 7.0).alias("v")
    )
    rows = stats.long_form(df, ["v"], ("g",))
    whole = df.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("inside"))
    targets = whole.where("g = 'a'").select(
        "g", F.lit("v").alias("column"), F.inline(F.array(stats._ranks(F.col("inside"), 0.5))), "lo", "hi", F.lit(0).alias("below")
    )
    left = stats._narrowed(rows, targets, ["g", "column"], False).collect()
    assert len(left) == 1 and left[0].known or left[0].inside < 50


def test_describe_handles_an_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    got = {r.column: r for r in stats.describe(df, ["a", "b"]).collect()}
    assert list(got) == ["a"] and got["a"].q50 == 2.0


def test_constant_columns(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [r.v for r in stats.standardise(df, ["v"]).collect()] == [0.0, 0.0]
    assert [tuple(r) for r in stats.histogram(df, "v", 5).collect()] == [(1, 2)]


@pytest.mark.parametrize("bucket", [None, 60, 100_000])
def test_nearest_equals_brute_force(spark, bucket):
    rnd = random.Random(8)
    t0 = datetime(2024, 1, 1)
    reads = sorted({rnd.randrange(0, 200_000, 10) for _ in range(150)})
    asks = sorted({rnd.randrange(0, 200_000, 5) for _ in range(200)})
    given = spark.createDataFrame([("a", t0 + timedelta(seconds=s), float(s)) for s in reads], "station_id string, ts timestamp, v double")
    probes = spark.createDataFrame([("a", t0 + timedelta(seconds=s), s) for s in asks], "station_id string, ts timestamp, s int")
    got = {r.s: r.v for r in joins.nearest_in_time(probes, given, ["v"], bucket_seconds=bucket).collect()}
    assert len(got) == len(asks)
    for s in asks:
        best = min(reads, key=lambda x: (abs(x - s), x))
        assert got[s] == (float(best) if abs(best - s) < 3600 else None)


def test_promotion_needs_a_known_champion_and_the_gain(spark):
    cand = spark.createDataFrame([(24, 9.0, 0.5), (48, 9.9, 0.5), (72, 5.0, 0.5)], "horizon int, rmse double, r2 double")
    champ = spark.createDataFrame([(24, 10.0, 0.4), (48, 10.0, 0.4), (72, None, None)], "horizon int, rmse double, r2 double")
    got = {r.horizon: (r.promoted, r.rmse) for r in joins.promotion_join(cand, champ).collect()}
    assert got == {24: (True, 9.0), 48: (False, 10.0), 72: (False, None)}
    blocked = joins.promotion_join(cand, champ, allowed=False).where("promoted").count()
    assert blocked == 0


def test_r2_is_null_without_spread(spark):
    df = spark.createDataFrame([("m", 24, "test", 1.0, 2.0), ("m", 24, "test", 1.0, 1.0)], "model string, horizon int, split string, y double, p double")
    row = metrics.regression_metrics(df).first()
    assert row.r2 is None and row.mae == 0.5 and row.mape == 0.5


def test_name_guard_and_drop(spark):
    with pytest.raises(guards.LeakageError):
        guards.check_names(["pm2_5_lag_1h", "Target_x"])
    df = spark.createDataFrame([(1, 2.0)], "pm2_5_24h_avg int, pm2_5 double")
    assert guards.drop_leakage(df).columns == ["pm2_5"]


def test_quality_gate(spark):
    df = spark.range(600).select("id", F.lit(None).cast("double").alias("v"))
    assert guards.quality_gate(df).first().passed
    assert not guards.quality_gate(df.limit(499)).first().passed


def test_payloads(spark):
    df = spark.createDataFrame(
        [(1, '{"list": [{"dt": 0, "main": {"aqi": 3}, "components": {"co": 1.5}}, {"dt": 3600}]}'), (2, '{"list": []}')],
        "id int, p string",
    )
    got = readers.flatten_pollution(df, "p", keep=["id"]).orderBy("ts").collect()
    assert [(r.id, r.aqi_category, r.co, r.no2) for r in got] == [(1, 3, 1.5, None), (1, None, None, None)]


def test_csv_roundtrip_and_time_column(spark):
    path = fresh_path(spark, "csv")
    df = spark.createDataFrame([("2024-01-01T00:00:00Z", 1.5), ("bad", 2.0)], "Date string, v double")
    sinks.write_table(df, path, "csv")
    back = readers.scan_series(spark, path, "Date string, v double", "csv", ts="Date")
    got = readers.detect_time_column(back, "ts").orderBy("v").collect()
    assert [r.ts is None for r in got] == [False, True]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        sinks.write_table(df, path, "csv")


def test_first_available(spark):
    with pytest.raises(FileNotFoundError):
        readers.scan_first_available(spark, ["/tmp/none-1", "/tmp/none-2"])


def test_first_last_needs_both_halves(spark, series):
    df = series([float(i) for i in range(48)]).unionByName(series([1.0] * 47, station="short"))
    got = profiles.first_last_compare(df, "v").collect()
    assert [(r.station_id, r.change, r.direction, r.volatility) for r in got] == [
        ("a", 24.0, "Worsening", "Same Variability")
    ]


def test_correlation_with_a_constant_column(spark):
    """A column that does not vary has no correlation (NaN, as in the SQL), which is no error; without pairs it is NULL."""
    rows = [(float(i), 100.0, 2.0 * i, None) for i in range(50)] + [(None, 7.0, None, 1.0)]
    df = spark.createDataFrame(rows, "x double, flat double, y double, none double")
    got = {r["column"]: r["corr"] for r in stats.corr_with_target(df, ["flat", "y", "none"], "x").collect()}
    assert np.isnan(got["flat"]) and got["y"] == pytest.approx(1.0) and got["none"] is None
    pairs = {(r["a"], r["b"]): r["corr"] for r in stats.corr_matrix(df, ["x", "flat", "y"]).collect()}
    assert np.isnan(pairs["flat", "x"]) and pairs["y", "x"] == pytest.approx(1.0) and pairs["flat", "flat"] == pytest.approx(1.0)
