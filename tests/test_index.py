import pytest
from pyspark.sql import functions as F

from hourloom.functions import air, clock, fixed
from hourloom.operators import joins
from hourloom.plans.index import compute_index


def indices(spark, pollutant, table, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c double")
    cut = air.truncate_concentration(F.col("c"), pollutant)
    return [r[0] for r in df.orderBy("i").select(air.breakpoint_index(cut, table)).collect()]


@pytest.mark.parametrize(
    "pollutant, table, cases",
    [
        (
            "pm2_5",
            "pm2_5",
            {0.0: 0, 12.0: 50, 12.05: 50, 12.1: 51, 35.4: 100, 35.45: 100, 35.5: 101, 500.4: 500, 500.5: 500, -1.0: None, None: None},
        ),
        ("pm10", "pm10", {54.0: 50, 54.9: 50, 55.0: 51, 604.0: 500, 605.0: 500}),
        ("o3", "o3_8h", {200.0: 300, 201.0: 500}),
        ("o3", "o3_1h", {124.0: 0, 125.0: 101}),
    ],
)
def test_boundaries(spark, pollutant, table, cases):
    assert indices(spark, pollutant, table, list(cases)) == list(cases.values())


def test_halves_round_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "x double")
    assert [r[0] for r in df.select(air.round_half_even(F.col("x"), 2)).collect()] == [0.12, 0.38, 2.5]


@pytest.mark.parametrize("table", list(fixed.BREAKPOINTS))
def test_join_equals_expression(spark, table):
    rows = spark.range(0, 30000).select((F.col("id") / 10 - 5).alias("c"))
    both = joins.breakpoint_join(rows, "c", table).withColumn("e", air.breakpoint_index(F.col("c"), table))
    assert both.count() == 30000
    assert both.where(~F.col("index").eqNullSafe(F.col("e"))).count() == 0


def test_ozone_rule(spark):
    df = spark.createDataFrame(
        [(130.0, 120.0, 90.0), (124.0, 120.0, 90.0), (130.0, 80.0, 90.0), (130.0, 120.0, None)],
        "c double, one double, eight double",
    )
    got = [r[0] for r in df.select(air.select_ozone(F.col("c"), F.col("one"), F.col("eight"))).collect()]
    assert got == [120.0, 90.0, 90.0, None]


def test_dominant_skips_nulls_and_breaks_ties_by_order(spark):
    df = spark.createDataFrame(
        [(50.0, 50.0, None), (None, 40.0, 41.0), (None, None, None)], "pm2_5 double, pm10 double, no2 double"
    )
    top = air.dominant({p: F.col(p) for p in ("pm2_5", "pm10", "no2")})
    got = [tuple(r) for r in df.select(air.overall_index(top), air.primary_pollutant(top)).collect()]
    assert got == [(50.0, "pm2_5"), (41.0, "no2"), (None, None)]


def test_average_needs_eighteen_of_twenty_four(spark, series):
    df = series([10.0] * 30, column="pm2_5")
    rows = compute_index(df).orderBy("ts").collect()
    assert [r.numerical_aqi for r in rows[:17]] == [None] * 17
    assert rows[17].numerical_aqi == 42.0 and rows[17].primary_pollutant == "pm2_5"


def test_category_and_regional(spark):
    df = spark.createDataFrame([("100",), ("100.1",), ("abc",), (None,)], "raw string")
    got = [tuple(r) for r in df.select(air.index_category(F.col("raw")), air.index_color(F.col("raw"))).collect()]
    assert got == [
        ("Good", "#00E400"),
        ("Moderate", "#FFA500"),
        ("Invalid", "#808080"),
        ("Unknown", "#808080"),
    ]
    df = spark.createDataFrame([(15.0, 60.0), (None, 60.0), (500.0, 900.0)], "a double, b double")
    assert [r[0] for r in df.select(air.regional_index(F.col("a"), F.col("b"))).collect()] == [110.0, 120.0, 155.0]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (12.0,), (12.01,), (500.0,), (501.0,)], "v double")
    got = [r[0] for r in df.select(air.cut_bins(F.col("v"))).collect()]
    assert got == [None, "Good", "Moderate", "Hazardous", None]


def test_parse_iso(spark):
    df = spark.createDataFrame(
        [("2024-01-02T03:04:05Z",), ("2024-01-02T03:04:05+00:00",), ("soon",)], "t string"
    )
    got = [r[0] for r in df.select(clock.parse_iso(F.col("t")).cast("string")).collect()]
    assert got == ["2024-01-02 03:04:05", "2024-01-02 03:04:05", None]
