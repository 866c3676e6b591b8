from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from urbanlake.operators import clean, facts

TRIP = (
    "id string, pulocationid int, dolocationid int, tpep_pickup_datetime timestamp_ntz, "
    "tpep_dropoff_datetime timestamp_ntz, passenger_count double, fare_amount double, total_amount double, "
    "trip_distance double, payment_type int"
)
T0 = datetime(2023, 1, 31, 23, 50)


def trip(spark, **change):
    """One good trip per call, with some values changed."""
    base = {
        "id": "x",
        "pulocationid": 1,
        "dolocationid": 2,
        "tpep_pickup_datetime": T0,
        "tpep_dropoff_datetime": T0 + timedelta(minutes=30),
        "passenger_count": 1.0,
        "fare_amount": 0.0,
        "total_amount": 0.0,
        "trip_distance": 0.01,
        "payment_type": None,
    }
    return tuple({**base, **change}.values())


def minutes(m):
    return {"tpep_dropoff_datetime": T0 + timedelta(minutes=m)}


CASES = [
    ({}, []),
    ({"pulocationid": None}, ["no_pickup_zone"]),
    ({"dolocationid": None}, ["no_dropoff_zone"]),
    ({"tpep_pickup_datetime": None}, ["no_pickup_time", "time_order", "duration"]),
    ({"tpep_dropoff_datetime": None}, ["no_dropoff_time", "time_order", "duration"]),
    ({"passenger_count": 0.0}, ["passengers"]),
    ({"passenger_count": 6.0}, []),
    ({"passenger_count": 7.0}, ["passengers"]),
    ({"passenger_count": None}, ["passengers"]),
    ({"fare_amount": -0.01}, ["fare"]),
    ({"total_amount": -0.01}, ["total"]),
    ({"trip_distance": 0.0}, ["distance"]),
    ({"trip_distance": 100.0}, []),
    ({"trip_distance": 100.1}, ["distance"]),
    (minutes(0), ["time_order", "duration"]),
    (minutes(-5), ["time_order", "duration"]),
    (minutes(0.9), ["duration"]),
    (minutes(1), []),
    (minutes(720), []),
    (minutes(721), ["duration"]),
]


def test_trip_rules(spark):
    data = [trip(spark, id=str(i), **change) for i, (change, _) in enumerate(CASES)]
    df = spark.createDataFrame(data, TRIP)
    accepted, rejected = clean.split_rejects(df, clean.trip_rules())
    want = {str(i): reasons for i, (_, reasons) in enumerate(CASES)}
    assert {r.id for r in accepted.collect()} == {i for i, r in want.items() if not r}
    assert {r.id: r.reject_reasons for r in rejected.collect()} == {i: r for i, r in want.items() if r}
    tagged = {r.id: r.reject_reasons for r in clean.tag_rejects(df, clean.trip_rules()).collect()}
    assert tagged == want


def test_derived_trip_columns(spark):
    df = spark.createDataFrame([trip(spark)], TRIP)
    got = facts.silver_trips(df, "src", datetime(2024, 1, 1)).first()
    assert (got.trip_date, got.hour_of_day, got.day_of_week) == (date(2023, 1, 31), 23, 3)
    assert got.trip_duration_min == 30.0
    assert got.source_system == "src"


@pytest.mark.parametrize("mode, kept", [("drop", ["a"]), ("keep", ["a", "b"])])
def test_null_coverage(spark, mode, kept):
    day = date(2024, 1, 1)
    data = [("a", 1.0, 75.0, day), ("b", 1.0, None, day), ("c", 1.0, 74.9, day), ("d", -1.0, 80.0, day), ("e", 1.0, 80.0, None)]
    df = spark.createDataFrame(data, "id string, value double, coverage_pct double, date_utc date")
    assert [r.id for r in clean.apply_rules(df, clean.daily_rules(mode)).orderBy("id").collect()] == kept


def test_normalize_and_drift(spark):
    old = spark.createDataFrame([(1, "2.5")], "VendorID bigint, Airport_fee string")
    new = spark.createDataFrame([(2, "bad", 1.0)], "vendorid bigint, airport_fee string, congestion_surcharge double")
    both = clean.union_drift([clean.normalize_schema(df, clean.TRIP_TYPES) for df in (old, new)])
    assert dict(both.dtypes) == {"vendorid": "int", "airport_fee": "double", "congestion_surcharge": "double"}
    assert rows(both, "vendorid", "airport_fee", "congestion_surcharge") == [(1, 2.5, None), (2, None, 1.0)]


def test_names_that_differ_by_case(spark):
    df = spark.range(1).select(F.lit(1).alias("A"), F.lit(2).alias("a"))
    with pytest.raises(ValueError):
        clean.normalize_schema(df, {})


def test_active_interval(spark):
    data = [
        ("in", datetime(2023, 1, 1), datetime(2023, 12, 1)),
        ("open", None, None),
        ("last_minute", datetime(2023, 3, 31, 23, 59), datetime(2023, 4, 2)),
        ("ended", datetime(2022, 1, 1), datetime(2023, 2, 28, 23, 59)),
        ("later", datetime(2023, 4, 1), None),
    ]
    df = spark.createDataFrame(data, "id string, a timestamp_ntz, b timestamp_ntz")
    end = datetime(2023, 3, 31, 23, 59, 59, 999999)
    assert rows(clean.active_in(df, "a", "b", datetime(2023, 3, 1), end), "id") == [("in",), ("last_minute",), ("open",)]
    midnight = datetime(2023, 3, 31)
    assert rows(clean.active_in(df, "a", "b", datetime(2023, 3, 1), midnight, null_open=False), "id") == [("in",)]


def test_set_membership_ignores_case(spark):
    df = spark.createDataFrame([("PM25",), ("no2",), ("co2",), (None,)], "p string")
    assert rows(clean.filter_in_set(df, "p", clean.POLLUTANTS)) == [("PM25",), ("no2",)]
    assert rows(clean.filter_in_set(df, "p", ["PM25"], ci=False)) == [("PM25",)]
