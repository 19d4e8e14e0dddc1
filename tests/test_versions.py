"""Versioned tables: what an upsert writes, what stays readable, and tables that follow one."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hourloom.plans import incremental, index
from hourloom.session import fresh_path
from hourloom.sources.versions import VersionedTable

START = datetime(2024, 1, 1)
SCHEMA = "station_id string, ts timestamp, v double"


def hours(spark, station, first, n, value, schema=SCHEMA, *more):
    return spark.createDataFrame([(station, START + timedelta(hours=first + i), value, *more) for i in range(n)], schema)


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/data") for f in names if f.startswith("part-")}


@pytest.fixture
def table(spark):
    return VersionedTable(spark, fresh_path(spark, "versioned"))


def test_upsert_writes_only_the_touched_months(spark, table):
    assert table.newest() == 0 and table.read() is None
    year = hours(spark, "a", 0, 24 * 366, 1.0).unionByName(hours(spark, "b", 0, 24 * 366, 2.0))
    assert table.upsert(year) == 1
    before = files(table.root)
    late = hours(spark, "a", 24 * 40, 72, 5.0)  # three days of February
    assert table.upsert(late) == 2
    written = files(table.root) - before
    assert {p for f in written for p in f.split("/") if "=20" in p} == {"_period=2024-02-01"}
    assert [e.written_in for e in table.entries()] == [1, 2, *[1] * 10]
    new = table.read()
    assert new.count() == 2 * 24 * 366 and new.where("v = 5").count() == 72
    assert table.read(1).where("v = 5").count() == 0
    assert sum(e.n_rows for e in table.entries()) == new.count()
    assert [tuple(r) for r in table.changes(1, 2).groupBy("station_id", "kind").count().collect()] == [("a", "updated", 72)]


def test_last_of_a_batch_and_rows_without_time(spark, table):
    rows = [("a", START, 1, 1.0), ("a", START + timedelta(minutes=5), 3, 3.0), ("a", START + timedelta(minutes=9), 2, 2.0), ("a", None, 9, 9.0)]
    table.upsert(spark.createDataFrame(rows, "station_id string, ts timestamp, batch_seq int, v double"))
    assert [(r.ts, r.v) for r in table.read().collect()] == [(START, 3.0)]
    table.upsert(spark.createDataFrame([("a", START, 1, 7.0)], "station_id string, ts timestamp, batch_seq int, v double"))
    assert [r.v for r in table.read().collect()] == [3.0]  # an older batch that comes late does not win


def test_new_columns_and_types(spark, table):
    table.upsert(hours(spark, "a", 0, 800, 1.0))
    table.upsert(hours(spark, "a", 24 * 35, 5, 2, "station_id string, ts timestamp, v int, extra string", "x"))
    got = table.read()
    assert dict(got.dtypes)["v"] == "double" and "extra" in got.columns
    assert got.count() == 805 and got.where("extra = 'x'").count() == 5
    assert "extra" not in table.read(1).columns
    assert table.read(periods=["2024-01-01"]).where("extra IS NULL").count() == 744


def test_added_batches_are_merged_when_read_and_folded(spark, table):
    table.upsert(hours(spark, "a", 0, 100, 1.0))
    for k in range(3):
        before = files(table.root)
        table.add(hours(spark, "a", 10 * k, 20, 2.0 + k))
        assert sum(spark.read.parquet(f).count() for f in files(table.root) - before if "/rows/" in f) == 20
    want = {k: 2.0 if k < 10 else 3.0 if k < 20 else 4.0 if k < 40 else 1.0 for k in range(100)}
    read = lambda: {int((r.ts - START).total_seconds()) // 3600: r.v for r in table.read().collect()}
    assert read() == want and len(table.entries()) == 4
    assert table.compact(4) == 4 and table.compact(3) == 5
    assert read() == want and len(table.entries()) == 1


def test_restore_and_expire(spark, table):
    for k in range(3):
        table.upsert(hours(spark, "a", 0, 3, float(k)))
    assert table.restore(1) == 4
    assert {r.v for r in table.read().collect()} == {0.0}
    assert table.expire(1) == [1, 2, 3]
    assert {r.v for r in table.read().collect()} == {0.0}
    with pytest.raises(ValueError):
        table.entries(2)


def test_versions_by_time(spark, table):
    table.upsert(hours(spark, "a", 0, 1, 1.0))
    between = spark.sql("SELECT current_timestamp()").first()[0]
    table.upsert(hours(spark, "a", 0, 1, 2.0))
    assert table.newest(between) == 1 and table.newest() == 2


def wave(spark, station, skip, scale=1.0):
    rows = [(station, START + timedelta(hours=h), 10.0 + (h * 7 % 50) * scale, 20.0 + h % 30) for h in range(24 * 90) if not skip(h)]
    return spark.createDataFrame(rows, "station_id string, ts timestamp, pm2_5 double, pm10 double")


def test_index_follows_over_long_gaps(spark, table):
    """Station b has no hours for two months, so what a change reaches lies far behind and ahead of it."""
    derived = VersionedTable(spark, fresh_path(spark, "derived"))
    rows = wave(spark, "a", lambda h: False).unionByName(wave(spark, "b", lambda h: 500 < h < 2000))
    table.upsert(rows)
    incremental.refresh_index(table, derived)
    change = rows.where("station_id = 'b'").where(F.col("ts").between(START + timedelta(hours=495), START + timedelta(hours=500)))
    table.upsert(change.withColumn("pm2_5", F.lit(300.0)))
    table.upsert(wave(spark, "c", lambda h: h > 30))
    incremental.refresh_index(table, derived)
    assert derived.followed() == 3 and incremental.refresh_index(table, derived) == derived.newest()
    got = derived.read()
    want = index.compute_index(table.read())
    columns = ["station_id", "ts", "pm2_5_aqi", "numerical_aqi", "primary_pollutant"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    again = {(r.station_id, r.ts) for r in got.where("batch_seq > 1").collect()}
    hours_of_b = [r.ts for r in rows.where("station_id = 'b'").orderBy("ts").collect()]
    first = hours_of_b.index(START + timedelta(hours=495))
    assert {t for s, t in again if s == "b"} == set(hours_of_b[first : first + 6 + index.REACH])
    assert sum(s == "c" for s, _ in again) == 31 and not any(s == "a" for s, _ in again)


def test_a_batch_without_differences_writes_nothing(spark, table):
    derived = VersionedTable(spark, fresh_path(spark, "derived"))
    rows = wave(spark, "a", lambda h: False)
    table.upsert(rows)
    incremental.refresh_index(table, derived)
    before = files(derived.root)
    table.upsert(rows.where("day(ts) = 3"))
    assert incremental.refresh_index(table, derived) == 2 and files(derived.root) == before
