"""Jobs over stored tables: repeated, late and split loads give what one load gives."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tests.test_sources import archive, land, pages
from urbanlake.operators import control, dims, facts, timeseries
from urbanlake.plans import jobs
from urbanlake.sources import tables
from urbanlake.streaming.intake import merge_landed

L1, L2 = datetime(2024, 1, 1), datetime(2024, 2, 1)


def month_file(spark, root, key, schema, data):
    year, month = key.split("-")
    spark.createDataFrame(data, schema).write.parquet(f"{root}/year={year}/month={month}")


OLD = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, "
    "trip_distance double, PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double, "
    "total_amount double, airport_fee double"
)
NEW = OLD.replace("airport_fee double", "Airport_fee double, congestion_surcharge double")


def trip(day, zone, fare, *more):
    start = datetime(2023, day[0], day[1], 8)
    return (1, start, start.replace(minute=30), 1.0, 2.0, zone, 1, 1, fare, fare + 1, *more)


def landed_trips(spark, root):
    month_file(spark, root, "2023-01", OLD, [trip((1, 1), 5, 10.0, 0.0), trip((1, 2), 5, -1.0, 0.0)])
    # A trip of January sits in the February file.
    month_file(spark, root, "2023-02", NEW, [trip((2, 1), 6, 20.0, 0.0, 2.5), trip((1, 1), 5, 30.0, 0.0, 2.5)])


def test_trips_from_files_to_fact(spark, scratch):
    landed_trips(spark, scratch + "/in")
    silver, fact = scratch + "/silver", scratch + "/fact"
    results, failed = jobs.load_trip_months(spark, scratch + "/in", silver, ["2023-01", "2023-09"], "taxi", L1)
    assert rows(results, "partition_key", "new_status", "rows_written") == [("2023-01", "succeeded", 1), ("2023-09", "failed", 0)]
    assert [k for k, _ in failed] == ["2023-09"]
    first = jobs.refresh_trips(spark, silver, fact, None)
    assert (first.rows, first.watermark) == (1, L1)
    jobs.load_trip_months(spark, scratch + "/in", silver, ["2023-02"], "taxi", L2)
    second = jobs.refresh_trips(spark, silver, fact, first.watermark)
    assert (second.rows, second.watermark) == (2, L2)
    full = facts.taxi_fact(tables.read(spark, silver))
    got = tables.read(spark, fact).drop("month_key").select(*full.columns)
    assert rows(got) == rows(full)
    assert rows(got, "date_key", "trip_count", "total_fare_usd") == [(20230101, 2, 40.0), (20230201, 1, 20.0)]
    again = jobs.refresh_trips(spark, silver, fact, second.watermark)
    assert again == jobs.Result(0, L2)
    hourly = jobs.refresh_trips(spark, silver, scratch + "/hourly", None, "hour")
    assert hourly.rows == 2


def test_all_months_missing(spark, scratch):
    results, failed = jobs.load_trip_months(spark, scratch + "/none", scratch + "/t", ["2023-01"], "taxi", L1)
    assert rows(results, "partition_key", "new_status") == [("2023-01", "failed")] and len(failed) == 1
    ledger = spark.createDataFrame([], control.LEDGER_SCHEMA)
    assert control.update(ledger, results, "silver", L1).count() == 0


FX = "TIME_PERIOD date, CURRENCY string, CURRENCY_DENOM string, OBS_VALUE double, OBS_STATUS string, FREQ string, loaded_at timestamp"


def fx_row(day, value, loaded, pair="USD", status="A"):
    return (date(2024, 1, day), pair, "EUR", value, status, "D", loaded)


def test_rates_over_two_loads(spark, scratch):
    bronze, silver, gold = scratch + "/bronze", scratch + "/silver", scratch + "/gold"
    one = [fx_row(2, 1.0, L1), fx_row(5, 2.0, L1), fx_row(4, 9.0, L1, status="E"), fx_row(3, 0.0, L1), fx_row(2, 5.0, L1, "GBP")]
    two = [fx_row(9, 3.0, L2), fx_row(5, 2.5, L2), fx_row(3, 1.5, L2)]
    tables.append(spark.createDataFrame(one, FX), bronze)
    currency = dims.currencies(spark)
    mark = jobs.merge_fx(spark, bronze, silver, None).watermark
    gold_mark = jobs.refresh_fx(spark, silver, currency, gold, None).watermark
    tables.append(spark.createDataFrame(two, FX), bronze)
    done = jobs.merge_fx(spark, bronze, silver, mark)
    assert (mark, done.watermark) == (L1, L2)
    usd = tables.read(spark, silver).filter("from_currency = 'USD'").orderBy("rate_date").collect()
    assert [(r.rate_date.day, float(r.rate), r.is_filled) for r in usd] == [
        (2, 1.0, False), (3, 1.5, False), (4, 1.5, True), (5, 2.5, False),
        (6, 2.5, True), (7, 2.5, True), (8, 2.5, True), (9, 3.0, False),
    ]
    whole = timeseries.fill_gaps(facts.silver_fx(tables.read(spark, bronze)), ["from_currency", "to_currency"], "rate_date")
    cols = ["rate_date", "from_currency", "to_currency", "rate", "is_filled"]
    assert rows(tables.read(spark, silver), *cols) == rows(whole, *cols)
    jobs.refresh_fx(spark, silver, currency, gold, gold_mark)
    want = facts.fx_fact(tables.read(spark, silver), currency)
    assert rows(tables.read(spark, gold), *want.columns) == rows(want)
    assert jobs.merge_fx(spark, bronze, silver, done.watermark) == jobs.Result(0, L2)


def test_yearly_values(spark, scratch):
    schema = "countryiso3code string, country_name string, indicator_id string, indicator_name string, year bigint, value bigint, loaded_at timestamp"
    data = [("USA", "US", "G", "GDP", 2022, 5, L1), ("USA", "US", "G", "GDP", 2022, 6, L2), ("USA", "US", "G", "GDP", 2023, None, L2), ("USA", "US", "G", "GDP", 2021, 0, L2)]
    tables.append(spark.createDataFrame(data, schema), scratch + "/b")
    result = jobs.merge_gdp(spark, scratch + "/b", scratch + "/s", None)
    assert result == jobs.Result(1, L2)
    assert jobs.refresh_gdp(spark, scratch + "/s", scratch + "/g", None).rows == 1
    assert [(r.year, float(r.gdp_usd)) for r in tables.read(spark, scratch + "/g").collect()] == [(2022, 6.0)]


def sensors(spark):
    schema = (
        "sensor_id bigint, location_id bigint, p_name string, latitude double, longitude double, first_datetime_utc "
        "timestamp_ntz, last_datetime_utc timestamp_ntz, loaded_at timestamp"
    )
    data = [
        (10, 1, "PM25", 1.0, 1.0, None, None, L1),
        (10, 1, "pm25", 1.0, 1.0, None, None, L2),
        (99, 1, "so2", 1.0, 1.0, None, None, L1),
        (20, 2, "no2", 50.0, 1.0, datetime(2023, 1, 31, 23, 59), None, L1),
    ]
    return spark.createDataFrame(data, schema)


def test_readings_from_archive_to_fact(spark, scratch):
    root, bronze, silver = scratch + "/in", scratch + "/b", scratch + "/s"
    archive(root)
    january = jobs.load_archive_month(spark, root, sensors(spark), "2023-01", bronze, L1)
    # The reading of 1 February (UTC) in the January folder is outside the month.
    assert january.rows == 1
    assert jobs.load_archive_month(spark, root, sensors(spark), "2022-05", bronze, L1).rows == 0
    first = jobs.merge_hourly(spark, bronze, silver, None)
    assert (first.rows, first.watermark) == (1, L1)
    land(root, "locationid=1/year=2023/month=01", ["1,10,s,2023-01-31T11:00:00+00:00,1,2,PM25,µg/m³,7"], "b.csv.gz")
    jobs.load_archive_month(spark, root, sensors(spark), "2023-01", bronze, L2)
    second = jobs.merge_hourly(spark, bronze, silver, first.watermark)
    assert second.watermark == L2
    got = tables.read(spark, silver)
    assert rows(got, "hour_utc", "parameter", "value", "loaded_at") == [(10, "pm25", 5.0, L2), (11, "PM25", 7.0, L2)]

    zones = spark.createDataFrame(
        [(7, "z", "b", "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))")], "zone_id int, zone_name string, borough string, geometry_wkt string"
    )
    tables.replace(sensors(spark), scratch + "/loc")
    tables.replace(zones, scratch + "/zones")
    assert jobs.map_sensors(spark, scratch + "/loc", scratch + "/zones", scratch + "/map").rows == 3
    result = jobs.refresh_air(spark, silver, scratch + "/map", dims.parameters(spark), scratch + "/fact", None, "hour")
    assert (result.rows, result.watermark) == (2, L2)
    # The name in upper case finds its parameter too.
    assert rows(tables.read(spark, scratch + "/fact"), "zone_id", "hour", "p_id", "avg_value") == [(7, 10, 2, 5.0), (7, 11, 2, 7.0)]


def test_daily_archive_needs_coverage_unless_told(spark, scratch):
    root, bronze = scratch + "/in", scratch + "/b"
    archive(root)
    assert jobs.load_archive_month(spark, root, sensors(spark), "2023-01", bronze, L1, "day").rows == 1
    assert jobs.merge_daily(spark, bronze, scratch + "/drop", None).rows == 0
    assert jobs.merge_daily(spark, bronze, scratch + "/keep", None, "keep").rows == 1


def test_api_pages_to_silver(spark, scratch):
    doc = {"results": [{"value": 3.0, "period": {"datetimeFrom": {"utc": "2024-01-05T05:00:00Z"}}, "coverage": {"percentComplete": 90.0}}]}
    frame = pages(spark, doc, sensor_id=1, location_id=2, parameter="o3", units="ppm")
    for stamp in (L1, L2):
        assert jobs.load_sensor_days(frame, scratch + "/b", stamp).rows == 1
    assert jobs.merge_daily(spark, scratch + "/b", scratch + "/s", None) == jobs.Result(1, L2)
    assert rows(tables.read(spark, scratch + "/s"), "measurement_date", "loaded_at") == [(date(2024, 1, 5), L2)]
    known = jobs.check_tables(spark, {"openaq_measurements": scratch + "/s"})
    assert rows(known, "success") == [(True,)] * 5


def test_weather_export(spark, scratch):
    fact = spark.createDataFrame(
        [(20230101, 0, 1, 5, 9.5), (20230101, 0, 2, 1, 0.5), (20230109, 1, 1, 3, 2.0)],
        "date_key int, hour int, pickup_zone_id int, trip_count bigint, total_revenue_usd double",
    )
    names = ["temperature_2m", "apparent_temperature", "precipitation", "wind_speed_10m", "relative_humidity_2m"]
    times = ["2023-01-01T00:00", "2023-01-01T01:00", "2023-01-09T01:00"]
    doc = {"hourly": {"time": times, **{n: [1.0] * 3 for n in names}, "weather_code": [0] * 3}}
    start, end, now = datetime(2023, 1, 1), datetime(2023, 1, 10), datetime(2025, 6, 1, 10, 30)
    mark, seen = None, []
    while (done := jobs.export_weather_chunk(fact, pages(spark, doc), scratch + "/x", mark, start, end, now, "r")).rows:
        mark = done.watermark
        out = tables.read(spark, scratch + "/x").withColumn("dest", F.date_format("dest_ts_utc", "MM-dd HH"))
        seen.append(rows(out, "dest", "trip_count", "revenue_usd"))
    assert seen == [[("05-25 10", 6, 10.0), ("05-25 11", 0, 0.0)], [("05-24 11", 3, 2.0)]]
    assert mark == end


def test_empty_zone_table(spark, scratch):
    tables.replace(sensors(spark), scratch + "/loc")
    empty = "zone_id int, zone_name string, borough string, geometry_wkt string"
    tables.replace(spark.createDataFrame([], empty), scratch + "/zones")
    with pytest.raises(RuntimeError):
        jobs.map_sensors(spark, scratch + "/loc", scratch + "/zones", scratch + "/map")


def test_streaming_intake(spark, scratch):
    """Two rounds of files; the second round only reads what is new."""
    schema = "k int, t int, v string"
    folder, target = scratch + "/in", scratch + "/out"

    def build(df):
        return df.withColumn("y", F.col("k") % 2)

    args = (spark, folder, schema, scratch + "/check", target, build, ["k"], ["y"])
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], schema).write.parquet(folder)
    merge_landed(*args)
    spark.createDataFrame([(2, 2, "B"), (3, 2, "c")], schema).coalesce(1).write.mode("append").parquet(folder)
    merge_landed(*args)
    merge_landed(*args)
    assert rows(tables.read(spark, target), "k", "v") == [(1, "a"), (2, "B"), (3, "c")]


def test_rates_without_currency_id_stay_apart(spark, scratch):
    silver, gold = scratch + "/fx", scratch + "/fct"
    schema = "rate_date date, from_currency string, to_currency string, rate decimal(18,6), loaded_at timestamp_ntz"
    currency = spark.createDataFrame([(1, "EUR")], "id int, currency_name string")
    day = date(2024, 1, 5)
    first = [(day, "XXA", "XXB", Decimal(1), L1), (day, "XXC", "XXD", Decimal(2), L1)]
    spark.createDataFrame(first, schema).write.parquet(silver)
    mark = jobs.refresh_fx(spark, silver, currency, gold, None).watermark
    spark.createDataFrame([(day, "XXA", "XXB", Decimal(3), L2)], schema).write.mode("append").parquet(silver)
    jobs.refresh_fx(spark, silver, currency, gold, mark)
    assert [(a, int(r)) for a, r in rows(tables.read(spark, gold), "from_currency", "rate")] == [("XXA", 3), ("XXC", 2)]


def test_rejects_are_stored(spark, scratch):
    landed_trips(spark, scratch + "/in")
    silver, bad = scratch + "/silver", scratch + "/bad"
    for _ in range(2):
        jobs.load_trip_months(spark, scratch + "/in", silver, ["2023-01", "2023-02"], "taxi", L1, bad)
    assert rows(tables.read(spark, bad), "fare_amount", "reject_reasons", "source_system", "month") == [(-1.0, ["fare"], "taxi", 1)]
    assert tables.read(spark, silver).count() == 3
    schema = "sensor_id int, location_id int, parameter string, units string, date_utc date, hour_utc int, value double, reading_count int, loaded_at timestamp"
    data = [(1, 1, "o3", "ppm", date(2024, 1, 1), h, v, 1, L1) for h, v in ((1, 2.0), (2, -1.0), (30, 1.0))]
    tables.append(spark.createDataFrame(data, schema), scratch + "/b")
    assert jobs.merge_hourly(spark, scratch + "/b", scratch + "/s", None, scratch + "/r").rows == 1
    assert tables.read(spark, scratch + "/r").count() == 2
    assert jobs.merge_hourly(spark, scratch + "/b", scratch + "/s", L1, scratch + "/r").rows == 0


def test_new_columns_of_a_load_reach_the_merge(spark, scratch):
    schema = "sensor_id int, location_id int, parameter string, units string, date_utc date, hour_utc int, value double, loaded_at timestamp"
    day = date(2024, 1, 1)
    tables.append(spark.createDataFrame([(1, 1, "o3", "ppm", day, 1, 2.0, L1)], schema), scratch + "/b")
    late = spark.createDataFrame([(1, 1, "o3", "ppm", day, 2, 3.0, L2, 7)], schema + ", reading_count int")
    tables.append(late, scratch + "/b")
    jobs.merge_hourly(spark, scratch + "/b", scratch + "/s", None)
    assert rows(tables.read(spark, scratch + "/s"), "hour_utc", "reading_count") == [(1, None), (2, 7)]


def test_touched_months_prune_folders(spark, scratch):
    df = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2024-12-31')) AS d").selectExpr("d", "year(d) AS year", "month(d) AS month")
    tables.overwrite_partitions(df, scratch + "/t", ["year", "month"])
    months = [date(2020, 3, 1), date(2023, 12, 1), date(2024, 1, 1)]
    got = tables.read(spark, scratch + "/t").filter(jobs.touched_months("d", months, foldered=True))
    assert got.count() == 31 * 3 and len({f.rsplit("/", 1)[0] for f in got.inputFiles()}) >= 3
    text = plan(got).split("== Physical Plan ==")[1]
    assert "year" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert tables.read(spark, scratch + "/t").filter(jobs.touched_months("d", [])).count() == 0


def test_month_without_passing_rows_succeeds_and_is_emptied(spark, scratch):
    silver = scratch + "/silver"
    month_file(spark, scratch + "/a", "2023-01", OLD, [trip((1, 1), 5, 10.0, 0.0)])
    month_file(spark, scratch + "/a", "2023-02", OLD, [trip((2, 1), 5, 10.0, 0.0)])
    jobs.load_trip_months(spark, scratch + "/a", silver, ["2023-01", "2023-02"], "taxi", L1)
    spark.createDataFrame([trip((1, 1), 5, -1.0, 0.0)], OLD).write.parquet(scratch + "/b/year=2023/month=1")
    results, failed = jobs.load_trip_months(spark, scratch + "/b", silver, ["2023-01"], "taxi", L2)
    assert rows(results, "partition_key", "new_status", "rows_written") == [("2023-01", "succeeded", 0)] and not failed
    assert rows(tables.read(spark, silver).select("year", "month").distinct()) == [(2023, 2)]


def test_many_partitions_in_one_predicate(spark):
    from urbanlake.sources import files

    values = [(y, m) for y in range(5000) for m in (1, None)]
    df = spark.createDataFrame([(7, 1), (7, 2), (4999, None)], "year int, month int")
    assert df.filter(tables.any_of(["year", "month"], values)).count() == 2
    assert df.filter(tables.any_of(["year"], [(y,) for y in range(5000)])).count() == 3
    assert df.filter(files.months_filter(f"{y:04d}-02" for y in range(5000))).count() == 1
    assert df.filter(files.months_filter([])).count() == 0


def test_upsert_leaves_no_scratch(spark, scratch):
    import glob

    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    df = spark.createDataFrame([(1, 1, "a")], "k int, p int, v string")
    tables.upsert_table(df, scratch + "/t", ["k"], ["p"])
    tables.upsert_table(df.withColumn("v", F.lit("b")), scratch + "/t", ["k"], ["p"])
    assert rows(tables.read(spark, scratch + "/t"), "v") == [("b",)]
    assert not glob.glob(f"{root}/urbanlake/upsert-*")
