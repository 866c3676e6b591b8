from datetime import date, datetime
from functools import partial

import pytest

from tests.conftest import plan, rows
from urbanlake.operators import facts, merge
from urbanlake.operators.clean import incremental
from urbanlake.sources import tables


def test_dedupe_latest_with_ties(spark):
    data = [(1, 10, 1), (1, 10, 2), (1, 9, 9), (2, None, 1), (2, 1, 0), (None, 5, 5)]
    df = spark.createDataFrame(data, "k int, t int, tie int")
    got = rows(merge.dedupe_latest(df, ["k"], ["t"], ["tie"]))
    assert got == sorted([(1, 10, 2), (2, 1, 0), (None, 5, 5)], key=repr)


def test_upsert_null_keys(spark):
    old = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "A"), (None, "B"), (4, "D")], "k int, v string")
    plain = rows(merge.upsert(old, new, ["k"]))
    assert plain == sorted([(1, "A"), (None, "b"), (None, "B"), (3, "c"), (4, "D")], key=repr)
    safe = rows(merge.upsert(old, new, ["k"], null_safe=True))
    assert safe == sorted([(1, "A"), (None, "B"), (3, "c"), (4, "D")], key=repr)


def test_insert_missing_is_idempotent(spark):
    old = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "new")], "k int, v string")
    once = merge.insert_missing(old, new, ["k"])
    assert rows(once) == rows(merge.insert_missing(once, new, ["k"])) == [(1, "old"), (2, "new")]


def test_missing_keys(spark):
    want, bad = spark.createDataFrame([("a",), ("b",), ("b",)], "k string"), spark.createDataFrame([("a",)], "k string")
    assert rows(merge.missing_keys(want, bad, ["k"])) == [("b",)]


def test_watermark_of_nothing(spark):
    assert merge.high_watermark(spark.createDataFrame([], "loaded_at timestamp")) is None


def test_late_rows_rebuild_whole_groups(spark):
    cols = (
        "trip_date date, pulocationid int, payment_type int, hour_of_day int, fare_amount double, total_amount double, "
        "trip_distance double, trip_duration_min double, passenger_count double, loaded_at timestamp_ntz"
    )
    day, t = date(2023, 1, 1), [datetime(2024, 1, d) for d in (1, 2, 3)]
    data = [
        (day, 1, 1, 5, 1.0, 2.0, 1.0, 10.0, 1.0, t[0]),
        (day, 1, 1, 6, 3.0, 4.0, 1.0, 20.0, 2.0, t[1]),
        (day, 1, None, 6, 3.0, 4.0, 1.0, 20.0, 2.0, t[0]),
        (day, 1, None, 6, 5.0, 4.0, 1.0, 20.0, 2.0, t[1]),
        (day, 2, 1, 6, 9.0, 9.0, 1.0, 20.0, 2.0, t[0]),
        (day, 2, 1, 6, 9.0, 9.0, 1.0, 20.0, 2.0, t[2]),
    ]
    silver = spark.createDataFrame(data, cols)
    old = facts.taxi_fact(incremental(silver, "loaded_at", None, t[0]))
    keys, build = ["date_key", "pickup_zone_id", "payment_id"], partial(facts.taxi_fact, newest="loaded_at")
    new = merge.refresh_fact(old, silver, keys, build, t[0], t[1])
    full = facts.taxi_fact(incremental(silver, "loaded_at", None, t[1]))
    assert rows(new) == rows(full)
    again = merge.refresh_fact(new, silver, keys, build, t[0], t[1])
    assert rows(again) == rows(full)


@pytest.mark.parametrize("catalog", [False, True])
def test_upsert_table_touches_only_its_partitions(spark, scratch, catalog):
    target = "lake.upsert_target" if catalog else f"{scratch}/t"
    if catalog:
        spark.sql(f"CREATE DATABASE lake LOCATION '{scratch}/lake'")
    schema = "k int, v string, y int"
    tables.upsert_table(spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2), (9, "n", None)], schema), target, ["k"], ["y"])
    before = {r.file for r in tables.read(spark, target).filter("y = 2").selectExpr("_metadata.file_path AS file").collect()}
    batch = spark.createDataFrame([(2, "B", 1), (4, "D", 3), (8, "m", None)], schema)
    for _ in range(2):
        tables.upsert_table(batch, target, ["k"], ["y"])
        if catalog:
            spark.catalog.refreshTable(target)
        got = rows(tables.read(spark, target), "k", "v", "y")
        want = [(1, "a", 1), (2, "B", 1), (3, "c", 2), (4, "D", 3), (8, "m", None), (9, "n", None)]
        assert got == sorted(want, key=repr)
    after = {r.file for r in tables.read(spark, target).filter("y = 2").selectExpr("_metadata.file_path AS file").collect()}
    assert before == after
    if catalog:
        spark.sql("DROP DATABASE lake CASCADE")


def test_appended_columns_reach_a_catalog_table(spark, scratch):
    spark.sql(f"CREATE DATABASE drift LOCATION '{scratch}/drift'")
    tables.append(spark.createDataFrame([(1, "a", 1)], "k int, v string, p int"), "drift.t", ["p"])
    tables.append(spark.createDataFrame([(2.5, 1, 2)], "w double, p int, k int"), "drift.t", ["p"])
    tables.append(spark.createDataFrame([("c", 3, 2)], "v string, k int, p int"), "drift.t", ["p"])
    assert rows(tables.read(spark, "drift.t"), "k", "v", "w", "p") == [(1, "a", None, 1), (2, None, 2.5, 1), (3, "c", None, 2)]
    spark.sql("DROP DATABASE drift CASCADE")


def test_overwrite_keeps_other_partitions(spark, scratch):
    path = f"{scratch}/t"
    tables.overwrite_partitions(spark.createDataFrame([(1, 1), (2, 2)], "v int, p int"), path, ["p"])
    tables.overwrite_partitions(spark.createDataFrame([(20, 2)], "v int, p int"), path, ["p"])
    assert rows(tables.read(spark, path), "v", "p") == [(1, 1), (20, 2)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t")
    text = plan(merge.dedupe_latest(df, ["k"], ["t"]))
    assert "row_number(), 1, Partial" in text


def test_bucketed_merge_moves_the_batch_only(spark, scratch):
    old = spark.createDataFrame([(i, i % 3, float(i)) for i in range(300)], "id int, month int, v double")
    new = spark.createDataFrame([(i, i % 3, -1.0) for i in range(0, 400, 3)], "id int, month int, v double")
    name = "merge_buckets"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        tables.upsert_bucketed(old, name, ["id"], 4, ["month"], scratch + "/t")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        merged = tables.merged_buckets(new, name, ["id"], 4, ["month"])
        physical = merged._jdf.queryExecution().executedPlan().toString()
        side = physical[physical.index("SortMergeJoin") :]
        stored = side[: side.index("FileScan parquet")]
        assert "Exchange" not in stored and "SelectedBucketsCount: 4 out of 4" in side
        tables.upsert_bucketed(new, name, ["id"], 4, ["month"], scratch + "/t")
        want = sorted({**{i: float(i) for i in range(300)}, **{i: -1.0 for i in range(0, 400, 3)}}.items(), key=repr)
        assert rows(tables.read(spark, name), "id", "v") == want
        # Months that the batch does not touch keep their files.
        before = {p for p in spark.table(name).where("month = 1").inputFiles() if "month=1" in p}
        tables.upsert_bucketed(new, name, ["id"], 4, ["month"], scratch + "/t")
        assert before == {p for p in spark.table(name).where("month = 1").inputFiles() if "month=1" in p}
        assert rows(tables.read(spark, name), "id", "v") == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_partitions_move_without_a_second_write(spark, scratch, monkeypatch):
    target = scratch + "/t"
    tables.upsert_table(spark.createDataFrame([(1, "a b", 1.0), (2, "c=d", 2.0), (3, None, 3.0)], "id int, p string, v double"), target, ["id"], ["p"])
    monkeypatch.setattr(tables, "overwrite_partitions", lambda *a, **k: 1 / 0)
    tables.upsert_table(spark.createDataFrame([(1, "a b", 5.0), (4, "c=d", 4.0), (5, None, 9.0), (6, "new", 6.0)], "id int, p string, v double"), target, ["id"], ["p"])
    assert rows(tables.read(spark, target), "id", "p", "v") == [
        (1, "a b", 5.0), (2, "c=d", 2.0), (3, None, 3.0), (4, "c=d", 4.0), (5, None, 9.0), (6, "new", 6.0),
    ]
