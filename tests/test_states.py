"""States that merge and retract equal a full build; sketches and bitmaps equal the values they stand for."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tests.test_jobs import L1, L2, OLD, month_file, trip
from urbanlake.operators import facts, states
from urbanlake.plans import fact_states, jobs
from urbanlake.sources import tables

L3 = datetime(2024, 3, 1)


def near(df, columns=("avg_trip_duration_min", "total_fare_usd", "total_revenue_usd", "total_distance_miles")):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def equal_facts(spark, silver, target, grain="day"):
    full = facts.taxi_fact(tables.read(spark, silver), grain)
    got = fact_states.read_fact(spark, target, grain)
    assert rows(near(got), *full.columns) == rows(near(full))
    return got


def test_loads_corrections_and_lost_rows(spark, scratch):
    silver, log, day, hour = (f"{scratch}/{n}" for n in ("silver", "log", "day", "hour"))

    def load(root, key_rows, stamp):
        for key, data in key_rows.items():
            month_file(spark, f"{scratch}/{root}", key, OLD, data)
        jobs.load_trip_months(spark, f"{scratch}/{root}", silver, list(key_rows), "taxi", stamp, changes=log)

    january = [trip((1, d), z, 10.1 * d, 0.0) for d in range(1, 6) for z in (5, 6)]
    load("a", {"2023-01": january, "2023-02": [trip((2, 1), 5, 20.2, 0.0)]}, L1)
    done, mark = fact_states.refresh_trip_states(spark, log, day, None)
    assert done == 11
    fact_states.refresh_trip_states(spark, log, hour, None, "hour")
    equal_facts(spark, silver, day)
    # A late trip of January, a corrected fare, a lost row; February stays.
    load("b", {"2023-01": [*january[1:9], trip((1, 9), 7, 1.0, 0.0), trip((1, 1), 5, 99.9, 0.0)]}, L2)
    assert fact_states.refresh_trip_states(spark, log, day, L1)[0] == 20
    got = equal_facts(spark, silver, day)
    assert 20230105 in {r.date_key for r in got.collect()}
    # Repeated, nothing is added twice, from whatever watermark.
    for low in (None, L1, L2):
        assert fact_states.refresh_trip_states(spark, log, day, low)[0] == 0
    fact_states.refresh_trip_states(spark, log, hour, None, "hour")
    equal_facts(spark, silver, hour, "hour")
    # A month that ends without passing rows.
    load("c", {"2023-02": [trip((2, 1), 5, -1.0, 0.0)]}, L3)
    fact_states.refresh_trip_states(spark, log, day, L2)
    got = equal_facts(spark, silver, day)
    assert not got.where("date_key >= 20230200").collect()


def test_a_load_that_failed_in_its_swap_is_repeated(spark, scratch, monkeypatch):
    silver, log, day = (f"{scratch}/{n}" for n in ("silver", "log", "day"))
    month_file(spark, scratch + "/a", "2023-01", OLD, [trip((1, 1), 5, 10.0, 0.0)])
    jobs.load_trip_months(spark, scratch + "/a", silver, ["2023-01"], "taxi", L1, changes=log)
    month_file(spark, scratch + "/b", "2023-01", OLD, [trip((1, 1), 5, 12.0, 0.0), trip((1, 2), 5, 1.0, 0.0)])
    whole = tables.overwrite_partitions

    def broken(df, target, *more, **named):
        if target == silver:
            raise OSError("lost")
        whole(df, target, *more, **named)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "overwrite_partitions", broken)
        with pytest.raises(OSError):
            jobs.load_trip_months(spark, scratch + "/b", silver, ["2023-01"], "taxi", L2, changes=log)
    for _ in range(2):
        jobs.load_trip_months(spark, scratch + "/b", silver, ["2023-01"], "taxi", L2, changes=log)
        fact_states.refresh_trip_states(spark, log, day, None)
        equal_facts(spark, silver, day)


def test_a_refresh_reads_no_base_rows(spark, scratch):
    """The states of two sets of rows add up to those of both; what goes out leaves no group behind."""
    month_file(spark, scratch + "/a", "2023-01", OLD, [trip((1, d % 28 + 1), d % 3, 0.1 * d, 0.0) for d in range(200)])
    trips = facts.silver_trips(spark.read.parquet(scratch + "/a"), "taxi", L1)
    half = F.col("fare_amount") < 10
    parts = [states.trip_states(trips.where(p)) for p in (half, ~half)]
    merged = states.merge_states(parts, states.TRIP_KEYS)
    assert rows(near(states.trip_fact(merged))) == rows(near(facts.taxi_fact(trips).select(*states.trip_fact(merged).columns)))
    gone = states.trip_states(trips.withColumn("change", F.lit(-1)), sign="change")
    assert states.merge_states([merged, gone], states.TRIP_KEYS).count() == 0


def test_medians_from_stored_days(spark):
    dice = random.Random(2)
    data = [("no2", d % 60, dice.gauss(50, 20)) for d in range(6000)] + [("o3", d, float(d)) for d in range(9)] + [("co", 1, None)]
    df = spark.createDataFrame(data, "parameter string, day int, value double")
    days = states.day_sketches(df, ["parameter", "day"])
    got = {r.parameter: r for r in states.merged_quantiles(days, ["parameter"], {"median": 0.5, "p90": 0.9}).collect()}
    assert (got["o3"].median, got["o3"].p90, got["o3"]["values"]) == (4.0, 8.0, 9)
    assert (got["co"].median, got["co"]["values"]) == (None, 0)
    values = sorted(v for p, _, v in data if p == "no2")
    for name, rank in (("median", 0.5), ("p90", 0.9)):
        place = sum(v <= got["no2"][name] for v in values) / len(values)
        assert abs(place - rank) <= 2 * states.rank_error()
    assert got["no2"]["values"] == 6000 and 0 < states.rank_error() < 0.01


def test_zone_counts_from_bitmaps(spark):
    dice = random.Random(3)
    data = [(dice.randrange(1, 6), dice.choice(["a", "b"]), dice.choice([1, 7, 32768, 32769, 70000, None]), dice.choice([1.0, None])) for _ in range(200)]
    df = spark.createDataFrame(data, "day int, parameter string, zone_id int, avg_value double")
    days = states.zone_bitmaps(df, ["day", "parameter"])
    for keys in (["parameter"], ["day"], ["day", "parameter"]):
        got = states.count_zones(days, keys)
        want = df.where("avg_value is not null").groupBy(*keys).agg(F.count_distinct("zone_id").alias("zones_with_sensors")).where("zones_with_sensors > 0")
        assert rows(got) == rows(want.select(*got.columns))


def test_fact_keys():
    with pytest.raises(ValueError):
        states.trip_keys("week")


def test_signed_changes_cancel(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "id int, v double")
    log = states.signed_changes(df, df.where("id = 1"))
    assert rows(log.groupBy("id").agg(F.sum("change").alias("n"))) == [(1, 0), (2, -1)]
    assert "Join" not in plan(log)
