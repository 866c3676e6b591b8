from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from urbanlake.operators import control

NOW = datetime(2024, 6, 1, 12)
OLD = datetime(2024, 5, 1)
SPAN = "source_name string, first_day string, last_day string"


def ledger(spark, *states):
    """Rows (source, key, bronze status, silver status), started long ago."""
    df = spark.createDataFrame([], control.LEDGER_SCHEMA)
    new = spark.createDataFrame(list(states), "source_name string, partition_key string, status string, silver_status string")
    return df.unionByName(new.withColumns({"started_at": F.lit(OLD), "error_message": F.lit("old")}), allowMissingColumns=True)


def spans(spark, *items):
    return spark.createDataFrame(list(items), SPAN).withColumns(
        {c: F.col(c).cast("date") for c in ("first_day", "last_day")}
    )


STATES = [
    ("taxi", "2023-01", "succeeded", "pending"),
    ("taxi", "2023-02", "pending", None),
    ("taxi", "2023-03", "pending", "pending"),
    ("taxi", "2023-04", "running", None),
    ("air", "2023-01", "pending", None),
]


def test_seed_is_idempotent(spark):
    start = ledger(spark, *STATES)
    wanted = spans(spark, ("taxi", "2023-03-01", "2023-06-30"), ("new", "2023-01-01", "2023-01-01"))
    once = control.seed(start, wanted, NOW, "u/{yyyy-mm}")
    twice = control.seed(once, wanted, OLD, "other")
    assert rows(once) == rows(twice)
    added = once.filter(F.col("created_at") == NOW)
    assert rows(added, "source_name", "partition_key", "source_url", "status") == [
        ("new", "2023-01", "u/2023-01", "pending"),
        ("taxi", "2023-05", "u/2023-05", "pending"),
        ("taxi", "2023-06", "u/2023-06", "pending"),
    ]


@pytest.mark.parametrize("limit, want", [(None, ["2023-02", "2023-03"]), (0, []), (1, ["2023-02"]), (9, ["2023-02", "2023-03"])])
def test_pending_and_claim(spark, limit, want):
    state = ledger(spark, *STATES)
    assert [r.partition_key for r in control.pending(state, "taxi", "bronze", limit).collect()] == want
    claimed = control.claim(state, "taxi", "bronze", NOW, limit)
    fresh = claimed.filter(F.col("started_at") == NOW)
    assert rows(fresh, "partition_key", "status", "error_message") == [(k, "running", None) for k in want]
    assert claimed.count() == 5 and claimed.columns == state.columns


def test_silver_waits_for_bronze(spark):
    state = ledger(spark, *STATES)
    assert rows(control.pending(state, "taxi", "silver"), "partition_key") == [("2023-01",)]
    claimed = control.claim(state, "taxi", "silver", NOW, 5)
    assert rows(claimed.filter("silver_status = 'running'"), "partition_key") == [("2023-01",)]


def results(spark, *items):
    return spark.createDataFrame(
        list(items), "source_name string, partition_key string, new_status string, rows_written bigint, message string"
    )


def test_update_bronze(spark):
    done = results(spark, ("taxi", "2023-04", "succeeded", 5, None), ("taxi", "2023-02", "failed", None, "boom"), ("taxi", "2023-03", "running", None, None), ("none", "x", "failed", 1, "x"))
    got = control.update(ledger(spark, *STATES), done, "bronze", NOW, cascade=True).filter("source_name = 'taxi'")
    cols = ["partition_key", "status", "started_at", "ended_at", "bronze_rows_written", "error_message", "silver_status"]
    assert rows(got, *cols) == sorted([
        ("2023-01", "succeeded", OLD, None, None, "old", "pending"),
        ("2023-02", "failed", OLD, NOW, None, "boom", None),
        ("2023-03", "running", NOW, None, None, None, "pending"),
        ("2023-04", "succeeded", OLD, NOW, 5, None, "pending"),
    ], key=repr)
    kept = control.update(ledger(spark, *STATES), done, "bronze", NOW).filter("partition_key = '2023-04'")
    assert kept.first().silver_status is None


def test_update_silver_and_empty(spark):
    state = ledger(spark, *STATES)
    got = control.update(state, results(spark, ("taxi", "2023-01", "succeeded", 7, None)), "silver", NOW)
    row = got.filter("source_name = 'taxi' AND partition_key = '2023-01'").first()
    assert (row.silver_status, row.silver_ended_at, row.silver_rows_written, row.ended_at) == ("succeeded", NOW, 7, None)
    assert rows(control.update(state, results(spark), "silver", NOW)) == rows(state)


def test_unknown_layer(spark):
    for call in (lambda s: control.claim(s, "taxi", "gold", NOW), lambda s: control.reset_running(s, "taxi", "gold", "x", NOW)):
        with pytest.raises(ValueError):
            call(ledger(spark, *STATES))


def test_reset_stuck_replay(spark):
    state = ledger(spark, *STATES)
    reset = control.reset_running(state, "taxi", "bronze", "pending", NOW, "aborted").filter(F.col("ended_at") == NOW)
    assert rows(reset, "partition_key", "status", "error_message") == [("2023-04", "pending", "aborted")]
    assert rows(control.stuck(state, NOW), "partition_key") == [("2023-04",)]
    assert control.stuck(state, OLD + timedelta(minutes=59)).count() == 0
    again = control.replay(state, "taxi", "partition", "2023-01")
    assert rows(again.filter("source_name = 'taxi' AND partition_key = '2023-01'"), "status") == [("pending",)]
    silver = control.replay(state, "taxi", "silver").filter("silver_status = 'pending'")
    assert rows(silver, "partition_key") == [("2023-01",), ("2023-03",)]
    assert control.replay(state, "taxi", "rebuild").filter("silver_status = 'pending'").count() == 4
    with pytest.raises(ValueError):
        control.replay(state, "taxi", "all")


def test_watermarks(spark):
    marks = spark.createDataFrame([("t", "s", OLD, OLD, 1, "r0")], control.WATERMARK_SCHEMA)
    assert control.get_watermark(marks, "t").first()[0] == OLD
    assert control.get_watermark(marks, "new").first()[0] == datetime(1900, 1, 1)
    entries = spark.createDataFrame(
        [("t", "other", NOW, 5, "r1"), ("new", "src", NOW, 6, "r1")],
        "target_table string, source_table string, ts timestamp, rows_merged bigint, run_id string",
    )
    logged = control.log_watermark(marks, entries, NOW)
    assert rows(logged) == [("new", "src", NOW, NOW, 6, "r1"), ("t", "s", NOW, NOW, 5, "r1")]
    assert control.get_watermark(control.reset_watermark(logged, "t"), "t").first()[0] == datetime(1900, 1, 1)


def test_run_log(spark):
    log = spark.createDataFrame([], control.RUN_LOG_SCHEMA)
    runs = spark.createDataFrame([("1", "p", "silver"), ("2", "p", "silver")], "run_id string, pipeline_name string, layer string")
    log = control.start_runs(log, runs, OLD)
    done = spark.createDataFrame([("1", "succeeded", "ok")], "run_id string, new_status string, new_message string")
    log = control.finish_runs(log, done, NOW)
    assert rows(log, "run_id", "status", "ended_at", "message") == [("1", "succeeded", NOW, "ok"), ("2", "running", None, None)]
    assert tuple(control.run_status(log).first()) == ("p", OLD, "succeeded")
