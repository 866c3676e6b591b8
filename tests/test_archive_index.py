"""The file index, unreadable files, and months that fail alone."""

import gzip
import os
import threading
from datetime import date, datetime
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tests.test_jobs import FX, L1, L2, OLD, fx_row, month_file, sensors, trip
from tests.test_sources import HEADER, land
from urbanlake.operators import control
from urbanlake.plans import jobs
from urbanlake.sources import archive_index, tables


def reading(location, sensor, day, value, hour=10):
    return f"{location},{sensor},s,{day}T{hour:02d}:15:00+00:00,1,2,no2,ppm,{value}"


def archive(root):
    land(root, "locationid=1/year=2023/month=01", [reading(1, 10, "2023-01-05", 4)])
    land(root, "locationid=1/year=2023/month=2", [reading(1, 10, "2023-02-05", 5)])
    land(root, "locationid=2/year=2023/month=01", [reading(2, 20, "2023-01-06", 6)], "b.csv.gz")
    land(root, "locationid=2/year=2023/month=01", [reading(2, 20, "2023-01-07", 7)])
    land(root, "locationid=7/year=2023/month=01", [reading(7, 70, "2023-01-07", 7)])
    open(f"{root}/locationid=2/year=2023/month=01/notes.txt", "w").close()


def truncate(path):
    data = open(path, "rb").read()
    with open(path, "wb") as f:
        f.write(data[: len(data) // 2])


def locations(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "location_id bigint")


def test_only_folders_that_exist(spark, scratch):
    root, store = scratch + "/in", scratch + "/index"
    archive(root)
    archive_index.register(spark, root, store, locations(spark, 1, 2, 99, None), ["2023-01", "2023-02", "2022-12"])
    index = archive_index.read_index(spark, store)
    assert rows(index, "locationid", "year", "month") == [(1, 2023, 1), (1, 2023, 2), (2, 2023, 1), (2, 2023, 1)]
    ledger = spark.createDataFrame([("2023-01", "running"), ("2023-02", "pending")], "partition_key string, status string")
    found = archive_index.wanted_files(index, archive_index.month_frame(ledger.where("status = 'running'")), locations(spark, 1, 2, 99))
    assert [[p.split("/in/")[1] for p in some] for some in archive_index.slices(found, 1)] == [
        ["locationid=1/year=2023/month=01/a.csv.gz"],
        ["locationid=2/year=2023/month=01/a.csv.gz", "locationid=2/year=2023/month=01/b.csv.gz"],
    ]
    paths = [p for some in archive_index.slices(found) for p in some]
    assert rows(archive_index.read_files(spark, root, paths), "locationid", "month", "value") == [(1, 1, 4.0), (2, 1, 6.0), (2, 1, 7.0)]


def test_months_of_a_ledger_prune_the_index(spark, scratch):
    root, store = scratch + "/in", scratch + "/index"
    archive(root)
    archive_index.register(spark, root, store, locations(spark, 1, 2), ["2023-01", "2023-02"])
    tables.replace(spark.createDataFrame([("2023-01", "running"), ("2023-02", "pending")], "partition_key string, status string"), scratch + "/ledger")
    claimed = tables.read(spark, scratch + "/ledger").where("status = 'running'")
    found = archive_index.wanted_files(archive_index.read_index(spark, store), archive_index.month_frame(claimed), locations(spark, 1, 2))
    assert found.count() == 3
    assert "dynamicpruning" in plan(found)


def test_a_renewed_month_forgets_lost_files(spark, scratch):
    root, store = scratch + "/in", scratch + "/index"
    archive(root)
    archive_index.register(spark, root, store, locations(spark, 1, 2), ["2023-01", "2023-02"])
    os.remove(f"{root}/locationid=1/year=2023/month=2/a.csv.gz")
    os.remove(f"{root}/locationid=2/year=2023/month=01/b.csv.gz")
    archive_index.register(spark, root, store, locations(spark, 1, 2), ["2023-01", "2023-02"])
    assert rows(archive_index.read_index(spark, store), "locationid", "month") == [(1, 1), (2, 1)]
    archive_index.register(spark, root, scratch + "/none", locations(spark, 99), ["2023-01"])
    assert archive_index.read_index(spark, scratch + "/none").count() == 0


def test_halves_are_read_side_by_side():
    """The halves of a list that failed do not wait for one another; bad files come in the order given."""
    meeting, met = threading.Barrier(2, timeout=10), []

    def read(paths):
        frame = MagicMock()

        def save():
            if len(paths) == 4:
                met.append(meeting.wait())
            if {"b", "g"} & set(paths):
                raise OSError("not a gzip file")

        frame.write.format.return_value.mode.return_value.save.side_effect = save
        return frame

    assert archive_index.unreadable(read, list("abcdefgh")) == [(p, "OSError: not a gzip file") for p in "bg"]
    assert len(met) == 2
    assert archive_index.unreadable(read, []) == []


def test_unreadable_files_are_found(spark, scratch):
    root = scratch + "/in"
    names = []
    for i in range(9):
        land(root, f"locationid={i}/year=2023/month=01", [reading(i, 10, "2023-01-05", v) for v in range(300)])
        names.append(f"{root}/locationid={i}/year=2023/month=01/a.csv.gz")
    truncate(names[2])
    with open(names[7], "w") as f:
        f.write(HEADER)
    bad = archive_index.unreadable(lambda paths: archive_index.read_files(spark, root, paths), names)
    assert [p for p, _ in bad] == [names[2], names[7]] and all(len(m) > 10 for _, m in bad)
    archive_index.register(spark, root, scratch + "/index", locations(spark, *range(9)), ["2023-01"])
    index = archive_index.read_index(spark, scratch + "/index")
    got = archive_index.health(lambda paths: archive_index.read_files(spark, root, paths), index, 4)
    assert rows(got, "locationid", "status") == [(i, "unreadable" if i in (2, 7) else "good") for i in range(9)]


def test_a_month_fails_alone(spark, scratch):
    root, bronze, bad = scratch + "/in", scratch + "/b", scratch + "/rejects"
    archive(root)
    land(root, "locationid=1/year=2023/month=01", ["1,10,s,no time,1,2,no2,ppm,1", "1,99,s,no time,1,2,so2,ppm,1"], "c.csv.gz")
    land(root, "locationid=2/year=2023/month=03", [reading(2, 20, "2023-03-01", v) for v in range(300)])
    truncate(f"{root}/locationid=2/year=2023/month=03/a.csv.gz")
    land(root, "locationid=1/year=2023/month=03", [reading(1, 10, "2023-03-01", 3)])
    ours = sensors(spark).withColumn("first_datetime_utc", F.lit(None).cast("timestamp_ntz"))
    keys = ["2023-01", "2023-03", "2022-05", "2023-02"]
    results = jobs.load_archive_months(spark, root, ours, keys, bronze, L1, rejects=bad, slice_size=1)
    assert rows(results, "partition_key", "new_status", "rows_written") == [
        ("2022-05", "succeeded", 0), ("2023-01", "succeeded", 3), ("2023-02", "succeeded", 1), ("2023-03", "failed", 0),
    ]
    message = results.where("partition_key = '2023-03'").first().message
    assert "locationid=2/year=2023/month=03/a.csv.gz" in message and "locationid=1" not in message
    assert rows(tables.read(spark, bronze), "date_utc", "value") == [(date(2023, 1, 5), 4.0), (date(2023, 1, 6), 6.0), (date(2023, 1, 7), 7.0), (date(2023, 2, 5), 5.0)]
    assert rows(tables.read(spark, bad), "sensors_id", "reject_reasons", "month") == [(10, ["no_time"], 1)]
    again = jobs.load_archive_months(spark, root, ours, ["2023-03"], bronze, L2, bad_files="skip", rejects=bad)
    assert rows(again, "new_status", "rows_written") == [("succeeded", 1)] and "1 unreadable" in again.first().message
    jobs.load_archive_months(spark, root, ours, ["2023-01"], scratch + "/b2", L2, rejects=bad)
    assert tables.read(spark, bad).count() == 1
    spans = spark.createDataFrame([("s3_archive", date(2022, 5, 1), date(2023, 3, 1))], "source_name string, first_day date, last_day date")
    ledger = control.seed(spark.createDataFrame([], control.LEDGER_SCHEMA), spans, L1)
    after = control.update(ledger, results, "bronze", L1).where("status <> 'pending'")
    assert rows(after, "partition_key", "status") == [("2022-05", "succeeded"), ("2023-01", "succeeded"), ("2023-02", "succeeded"), ("2023-03", "failed")]


def test_a_trip_month_fails_alone(spark, scratch):
    root = scratch + "/in"
    for month in ("01", "02", "03"):
        month_file(spark, root, f"2023-{month}", OLD, [trip((int(month), d), 5, 10.0, 0.0) for d in range(1, 20)])
    folder = f"{root}/year=2023/month=02"
    name = next(f"{folder}/{f}" for f in os.listdir(folder) if f.endswith(".parquet"))
    data = open(name, "rb").read()
    with open(name, "wb") as f:
        # The footer still reads; the pages do not.
        footer = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
        f.write(data[:4] + bytes(footer - 4) + data[footer:])
    for crc in os.listdir(folder):
        if crc.endswith(".crc"):
            os.remove(f"{folder}/{crc}")
    results, failed = jobs.load_trip_months(spark, root, scratch + "/t", ["2023-01", "2023-02", "2023-03", "2023-04"], "taxi", L1)
    assert rows(results, "partition_key", "new_status", "rows_written") == [
        ("2023-01", "succeeded", 19), ("2023-02", "failed", 0), ("2023-03", "succeeded", 19), ("2023-04", "failed", 0),
    ]
    assert [k for k, _ in failed] == ["2023-04", "2023-02"]


def test_rejects_of_a_repeated_run_are_stored_once(spark, scratch, monkeypatch):
    bronze, silver, bad = scratch + "/b", scratch + "/s", scratch + "/bad"
    tables.append(spark.createDataFrame([fx_row(2, 1.0, L1), fx_row(3, 0.0, L1), fx_row(4, 9.0, L1, status="E")], FX), bronze)
    with monkeypatch.context() as broken:
        broken.setattr(jobs.tables, "upsert_table", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.merge_fx(spark, bronze, silver, None, bad)
    tables.append(spark.createDataFrame([fx_row(5, None, L2)], FX), bronze)
    mark = jobs.merge_fx(spark, bronze, silver, None, bad).watermark
    want = [(date(2024, 1, 3), ["rate"]), (date(2024, 1, 4), ["status"]), (date(2024, 1, 5), ["no_rate", "rate"])]
    assert rows(tables.read(spark, bad), "rate_date", "reject_reasons") == want
    tables.append(spark.createDataFrame([fx_row(6, -1.0, datetime(2024, 3, 1))], FX), bronze)
    jobs.merge_fx(spark, bronze, silver, mark, bad)
    assert rows(tables.read(spark, bad), "rate_date", "reject_reasons") == [*want, (date(2024, 1, 6), ["rate"])]


def test_rejects_of_yearly_values(spark, scratch):
    schema = "countryiso3code string, country_name string, indicator_id string, indicator_name string, year bigint, value bigint, loaded_at timestamp"
    data = [("USA", "US", "G", "GDP", 2022, 5, L1), ("USA", "US", "G", "GDP", 2023, None, L1), ("USA", "US", "G", "GDP", None, 0, L1)]
    tables.append(spark.createDataFrame(data, schema), scratch + "/b")
    assert jobs.merge_gdp(spark, scratch + "/b", scratch + "/s", None, scratch + "/bad").rows == 1
    assert rows(tables.read(spark, scratch + "/bad"), "year", "reject_reasons") == [(2023, ["no_value", "value"]), (None, ["value", "no_year"])]


def test_gzip_members_read_whole(spark, scratch):
    """Two members in one file, as appended archives have."""
    root, name = scratch + "/in", "locationid=1/year=2023/month=01"
    land(root, name, [reading(1, 10, "2023-01-05", 4)])
    with gzip.open(f"{root}/{name}/a.csv.gz", "at") as f:
        f.write(reading(1, 10, "2023-01-05", 8) + "\n")
    got = archive_index.read_files(spark, root, [f"{root}/{name}/a.csv.gz"])
    assert rows(got, "value") == [(4.0,), (8.0,)]
