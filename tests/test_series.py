import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourloom.operators import fill, layout, rolling, running, splits, stats, upsert
from hourloom.plans import features, training
from tests.conftest import START


def noise(n, seed=1, missing=0.0):
    rnd = random.Random(seed)
    return [None if rnd.random() < missing else round(rnd.gauss(50, 20), 2) for _ in range(n)]


@pytest.mark.parametrize("rows", [72, 100, 5000])
def test_blocks_equal_plain_windows(spark, series, rows):
    df = series(noise(900), skip=range(300, 340)).unionByName(series(noise(250, 2), station="b"))
    df = df.unionByName(series([1.0], station="one"))
    w = Window.partitionBy("station_id").orderBy("ts")
    frame = w.rowsBetween(-71, 0)
    x = F.row_number().over(w).cast("double")
    plain = df.withColumn("x", x).select(
        "station_id",
        "ts",
        F.avg("v").over(frame).alias("mean"),
        F.stddev_samp("v").over(frame).alias("std"),
        F.when(F.count("v").over(frame) > 1, F.regr_slope("v", "x").over(frame)).alias("trend"),
        F.lead("v", 72).over(w).alias("ahead"),
        F.lag("v", 72).over(w).alias("back"),
    )
    ours = layout.over_series(
        df,
        lambda b: {
            "mean": rolling.rolling_mean("v", 72, b),
            "std": rolling.rolling_std("v", 72, b),
            "trend": rolling.rolling_trend("v", 72, b),
            "ahead": F.lead("v", 72).over(b),
            "back": F.lag("v", 72).over(b),
        },
        back=72,
        ahead=72,
        rows=rows,
    )
    names = ["mean", "std", "trend", "ahead", "back"]
    a = plain.toPandas().sort_values(["station_id", "ts"])[names].to_numpy(float)
    b = ours.toPandas().sort_values(["station_id", "ts"])[names].to_numpy(float)
    assert a.shape == b.shape
    np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-9)


def test_trend_matches_polyfit(spark, series):
    values = noise(120)
    got = layout.over_series(series(values), lambda w: {"t": rolling.rolling_trend("v", 12, w)}, back=11)
    got = [r.t for r in got.orderBy("ts").collect()]
    assert got[0] is None
    for i in range(1, 120):
        part = values[max(0, i - 11) : i + 1]
        assert got[i] == pytest.approx(np.polyfit(range(len(part)), part, 1)[0], abs=1e-8)


def test_trend_is_null_with_a_gap(spark, series):
    got = layout.over_series(series([1.0, None, 3.0, 4.0]), lambda w: {"t": rolling.rolling_trend("v", 2, w)}, back=1)
    assert [r.t for r in got.orderBy("ts").collect()] == [None, None, None, pytest.approx(1.0)]


def test_positions_over_many_cells(spark, series):
    df = series(noise(2000), skip=range(100, 1500))
    out = layout.with_position(df).orderBy("ts").collect()
    assert [r._pos for r in out] == list(range(1, 601))
    assert {r._len for r in out} == {600}


@pytest.mark.parametrize("placed", [False, True])
def test_fills_match_pandas(spark, series, placed):
    values = [None] * 800 + noise(1500, 3, missing=0.9) + [None] * 900
    df = series(values)
    if placed:
        df = layout.with_position(df)
    carried = fill.ffill_bfill(df, ["v"], keep_position=True).orderBy("ts")
    want = pd.Series(values, dtype=float)
    np.testing.assert_allclose([r.v for r in carried.collect()], want.ffill().bfill())
    linear = fill.interpolate_linear(df, ["v"], keep_position=True).orderBy("ts")
    got = np.array([np.nan if r.v is None else r.v for r in linear.collect()])
    np.testing.assert_allclose(got, want.interpolate(method="linear").to_numpy(), rtol=1e-12)
    assert [r._pos for r in carried.select("_pos").collect()] == list(range(1, len(values) + 1))


def test_all_null_column_stays_null(spark, series):
    out = fill.ffill_bfill(series([None] * 5), ["v"])
    assert [r.v for r in out.collect()] == [None] * 5
    assert out.columns == ["station_id", "ts", "v"]


def test_upsample(spark, series):
    df = series([1.0, None, 3.0, 4.0, 5.0, 6.0], skip=(1, 2, 4))
    assert [r.v for r in fill.upsample_ffill(df, ["v"]).orderBy("ts").collect()] == [1.0, 1.0, 1.0, 4.0, 4.0, 6.0]


def test_keep_last_is_deterministic(spark):
    rows = [("a", "2024-01-01 00:10:00", 1, 1.0), ("a", "2024-01-01 00:50:00", 2, 2.0), ("a", "2024-01-01 01:00:00", 1, 3.0)]
    old = spark.createDataFrame(rows[:1] + rows[2:], "station_id string, t string, batch_seq int, v double")
    new = spark.createDataFrame(rows[1:2], "station_id string, t string, batch_seq int, v double")
    fix = lambda df: df.withColumn("ts", F.to_timestamp("t")).drop("t")
    out = upsert.upsert_keep_last(fix(old), fix(new).withColumn("extra", F.lit(7))).orderBy("ts").collect()
    assert [(r.v, r.extra) for r in out] == [(2.0, 7), (3.0, None)]


def test_split_sizes(spark, series):
    out = splits.temporal_split(series(noise(3260))).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in out} == {"train": 1956, "validation": 652, "test": 652}


def test_trim_tail_keeps_untargeted_series(spark, series):
    df = series(noise(100), column="numerical_aqi").unionByName(series(noise(10), "short", "numerical_aqi"))
    out = splits.trim_tail(splits.future_targets(df)).groupBy("station_id").count().collect()
    assert {r.station_id: r["count"] for r in out} == {"a": 28, "short": 10}


@pytest.mark.parametrize(
    "variant, n, first_label", [("label_at_end", 9, 3.0), ("label_next", 8, 4.0), ("drop_last", 8, 3.0)]
)
def test_sequences(spark, series, variant, n, first_label):
    out = splits.sequence_windows(series([float(i) for i in range(12)]), ["v"], "v", 4, variant).orderBy("ts").collect()
    assert len(out) == n and out[0].label == first_label
    assert [x.v for x in out[0].seq] == [0.0, 1.0, 2.0, 3.0]


def test_contiguous_folds(spark, series):
    out = splits.contiguous_folds(series(noise(7)), 3).orderBy("ts").collect()
    assert [r.fold for r in out] == [0, 0, 0, 1, 1, 2, 2]


def test_folds_and_origins_agree(spark, series):
    df = series(noise(100))
    folds = splits.rolling_origin_folds(df, 5).groupBy("fold").agg(F.max("ts").alias("ts"))
    origins = splits.fold_origins(df, 5).select("fold", "ts")
    assert sorted(map(tuple, folds.collect())) == sorted(map(tuple, origins.collect()))


def hourly(spark, n, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append(("a", i, *[abs(rnd.gauss(40, 15)) for _ in range(6)], rnd.gauss(20, 30), 50.0, 3.0, 90.0, 1000.0))
    names = "pm2_5 pm10 o3 co no2 so2 temperature relative_humidity wind_speed wind_direction pressure".split()
    df = spark.createDataFrame(rows, "station_id string, i int, " + ", ".join(f"{c} double" for c in names))
    return df.withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("i") * 3600)).drop("i")


def test_features_are_complete_and_training_is_trimmed(spark):
    df = hourly(spark, 200)
    # 13 source columns, 338 windowed, 30 of single rows
    assert len(features.build_features(df).columns) == 13 + 338 + 30
    table = training.training_table(df)
    assert table.count() == 200 - 72
    assert table.agg(F.max("temperature")).first()[0] <= 50.0
    assert table.select([F.sum(F.col(c).isNull().cast("int")) for c in table.columns]).first().count(0) == len(table.columns)


def test_a_row_a_second_in_short_cells(spark):
    """Positions, windows and fills of dense series with cells of an hour equal those with cells of a month."""
    rows = spark.range(9000).select(
        F.lit("a").alias("station_id"),
        F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"),
        F.when(F.col("id") % 7 > 0, (F.hash("id") % 100).cast("double")).alias("v"),
    ).repartition(5)
    mean = lambda w: {"m": rolling.rolling_mean("v", 50, w)}
    for run in (
        lambda c: layout.over_series(rows, mean, back=49, keep_position=True, cell_seconds=c),
        lambda c: fill.ffill_bfill(rows, ["v"], cell_seconds=c),
        lambda c: fill.interpolate_linear(rows, ["v"], cell_seconds=c),
    ):
        short, long = (sorted(map(str, run(c).collect())) for c in (600, layout.CELL_SECONDS))
        assert short == long


def test_windows_from_running_sums_equal_sliding_frames(spark):
    """Large offsets, an outlier far off all others, constant stretches, missing values and a hot station."""
    rnd = random.Random(3)
    rows = []
    for g, n in (("hot", 5000), ("short", 5), ("one", 1)):
        for i in range(n):
            offset = None if rnd.random() < 0.03 else 1e6 + rnd.gauss(0, 1)
            spiky = 1e9 if i == 700 else rnd.gauss(5, 2)
            steps = float(i // 90) if i % 11 else None
            rows.append((g, START + timedelta(hours=i), offset, spiky, steps))
    df = spark.createDataFrame(rows, "station_id string, ts timestamp, offset double, spiky double, steps double")
    columns, sizes = ("offset", "spiky", "steps"), (6, 24, 72)
    specs = {f"{c}_{n}_{k}": (k, c, n) for c in columns for n in sizes for k in ("mean", "std", "trend", "max", "lag", "change")}
    frames = {"mean": rolling.rolling_mean, "std": rolling.rolling_std, "trend": rolling.rolling_trend, "max": rolling.rolling_max}
    frames |= {"lag": rolling.lag, "change": rolling.change}
    blocks = layout.in_blocks(df, back=72)
    got = blocks.native(running.with_windows(blocks.df, blocks.window, specs))
    want = layout.over_series(df, lambda w: {name: frames[k](c, n, w) for name, (k, c, n) in specs.items()}, back=72)
    a, b = ({(r.station_id, r.ts): r.asDict() for r in x.select("station_id", "ts", *specs).collect()} for x in (got, want))
    assert a.keys() == b.keys() and len(a) == 5006
    plain = {(g, t): (o, s, p) for g, t, o, s, p in rows}
    for key, row in b.items():
        for name, value in row.items():
            if name in ("station_id", "ts"):
                continue
            own = a[key][name]
            assert (own is None) == (value is None), (key, name, own, value)
            if value is not None:
                near = 1e-6 * max(1.0, abs(value))
                assert math.isclose(own, value, abs_tol=near), (key, name, own, value, plain[key])
    assert all(r["steps_6_std"] in (None, 0.0) or r["steps_6_std"] > 1e-3 for r in a.values())


def test_hourly_grid_equals_the_plain_join(spark):
    """Gaps over many spans, single rows, a NULL station and a row without a time."""
    from hourloom.sources import frames

    t0 = datetime(2024, 1, 1, 5)
    hours = {"a": [0, 1, 2, 9, 40, 41, 120], "b": [7], "c": [0, 19], None: [3, 6]}
    rows = [(s, t0 + timedelta(hours=h), float(h) if h != 9 else None, h) for s, all_hours in hours.items() for h in all_hours]
    seen = spark.createDataFrame([*rows, ("a", None, 1.0, 1), ("d", None, 1.0, 1)], "station_id string, ts timestamp, v double, k int")
    ends = seen.groupBy("station_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    grid = ends.select("station_id", F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 HOUR"))).alias("ts"))
    want = {tuple(r) for r in grid.join(seen, ["station_id", "ts"], "left").collect()}
    for cell_seconds in (10 * 3600, 30 * 24 * 3600):
        got = [tuple(r) for r in frames.on_hourly_grid(seen, cell_seconds).collect()]
        assert len(got) == len(set(got)) == 121 + 1 + 20 + 4 and set(got) == want


def test_policy_shuffles_its_rows_once(spark, series):
    """Medians travel with the blocks, so rows are joined with the edges of their block only; values are as before."""
    values = [None, 3.0, None, None, 8.0, None, 1.0]
    df = series(values, column="pm2_5").unionByName(series(values[::-1], "b", "pm2_5"))
    df = df.withColumns({"pressure": F.col("pm2_5") * 2, "temperature": F.col("pm2_5")})
    out = fill.gap_fill_policy(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and plan.index("Join Inner") < plan.index("Join LeftOuter")
    first = stats.fill_median(df, ["pressure"], ["station_id"])
    both = fill.interpolate_linear(fill.ffill_bfill(first, ["pm2_5"]), ["temperature"])
    names = ["station_id", "ts", "pm2_5", "pressure", "temperature"]
    assert {tuple(r) for r in out.select(names).collect()} == {tuple(r) for r in both.select(names).collect()}
    carried = fill.ffill_bfill(df.select("station_id", "ts", "pm2_5"), ["pm2_5"])
    carried.collect()
    assert "ReusedExchange" in carried._jdf.queryExecution().executedPlan().toString()
    alone = fill.gap_fill_policy(df.select("station_id", "ts", "pressure"))
    assert alone.where("pressure is null").isEmpty() and alone.columns == ["station_id", "ts", "pressure"]


def test_figures_of_features_are_no_copies_of_rows(spark):
    """A row is not projected once for each of its features; names and counts are those of the columns."""
    from hourloom.catalog.series import summed

    df = spark.createDataFrame([("s", 1.0, None), ("s", 2.5, 4.0), (None, None, 1.0)], "station_id string, x double, y double")
    out = summed(df, ["x", "y"])
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in out.collect()} == {("s", "x", 2, 3.5, 1.0, 2.5), ("s", "y", 1, 4.0, 4.0, 4.0), (None, "y", 1, 1.0, 1.0, 1.0)}
