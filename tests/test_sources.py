import gzip
import json
import os
from datetime import date, datetime

from pyspark.sql import functions as F

from tests.conftest import plan, rows
from urbanlake.operators import facts
from urbanlake.sources import documents, files, tables

LOAD = datetime(2024, 5, 1)
HEADER = "location_id,sensors_id,location,datetime,lat,lon,parameter,units,value\n"


def land(root, folder, lines, name="a.csv.gz"):
    os.makedirs(f"{root}/{folder}", exist_ok=True)
    with gzip.open(f"{root}/{folder}/{name}", "wt", encoding="utf-8") as f:
        f.write(HEADER + "\n".join(lines) + "\n")


def archive(root):
    land(root, "locationid=1/year=2023/month=01", [
        '1,10,"site, one",2023-01-31T23:30:00-05:00,1.5,2.5,pm25,µg/m³,8',
        "1,10,site,2023-01-31T10:15:00+00:00,1.5,2.5,pm25,µg/m³,4",
        "1,10,site,2023-01-31T10:45:00+00:00,1.5,2.5,pm25,µg/m³,6",
        "1,10,site,2023-01-31T10:50:00+00:00,1.5,2.5,pm25,µg/m³,",
        "1,10,site,not a time,1.5,2.5,pm25,µg/m³,9",
        "1,99,site,2023-01-31T10:50:00+00:00,1.5,2.5,co,ppm,1",
    ])
    land(root, "locationid=2/year=2023/month=02", ["2,20,s,2023-02-01T00:00:00Z,1,2,no2,ppm,1"])
    with open(f"{root}/locationid=2/year=2023/month=02/notes.txt", "w") as f:
        f.write("ignored\n")


def test_archive_rollup(spark, scratch):
    archive(scratch)
    raw = files.scan_archive(spark, scratch)
    assert raw.count() == 7
    hour = facts.rollup_readings(raw, "hour").filter("sensor_id = 10")
    # 23:30 at -05:00 is 04:30 UTC on the next day.
    assert rows(hour, "date_utc", "hour_utc", "value", "reading_count") == [
        (date(2023, 1, 31), 10, 5.0, 2),
        (date(2023, 2, 1), 4, 8.0, 1),
    ]
    day = facts.rollup_readings(raw, "day").filter("sensor_id = 10")
    assert rows(day, "date_utc", "value", "min_val", "max_val", "median_val", "coverage_pct", "expected_count") == [
        (date(2023, 1, 31), 5.0, 4.0, 6.0, 4.0, None, 2),
        (date(2023, 2, 1), 8.0, 8.0, 8.0, 8.0, None, 1),
    ]


def test_missing_folders_give_no_rows(spark, scratch):
    archive(scratch)
    wanted = spark.createDataFrame([(1,), (5,)], "location_id bigint")
    got = files.scan_archive_folders(spark, scratch, ["2023-01", "2022-07"], wanted)
    assert got.count() == 6
    assert "PartitionFilters: [" in got._jdf.queryExecution().toString()
    assert files.scan_archive_folders(spark, scratch, ["2022-07"], wanted).count() == 0


def test_months(spark, scratch):
    df = spark.createDataFrame([(1, 2023, 1), (2, 2023, 2), (3, 2024, 1)], "v int, year int, month int")
    tables.overwrite_partitions(df, scratch + "/m", ["year", "month"])
    got = files.scan_months(spark, scratch + "/m", ["2023-02", "2024-01", "2030-01"])
    assert rows(got, "v") == [(2,), (3,)]
    assert "PartitionFilters: [(" in plan(got)
    named = files.partition_columns_from_path(spark.read.parquet(scratch + "/m").drop("year", "month"))
    assert rows(named, "v", "year", "month") == [(1, 2023, 1), (2, 2023, 2), (3, 2024, 1)]


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_lookup_csv(spark, scratch):
    path = write(f"{scratch}/z.csv", '"LocationID","Borough","Zone","service_zone"\n1,EWR,"Newark, NJ",EWR\nx,Q,Z,B\n')
    got = files.scan_lookup(spark, path, files.ZONE_COLUMNS)
    assert rows(got, "zone_id", "borough", "zone_name", "service_zone") == [
        (1, "EWR", "Newark, NJ", "EWR"),
        (None, "Q", "Z", "B"),
    ]


def test_declared_csv_binds_by_position(spark, scratch):
    path = write(f"{scratch}/p.csv", "id,p_name,p_units,p_display_name\n7,no2,ppm,NO₂\n")
    assert rows(files.scan_declared(spark, path)) == [(7, "no2", "ppm", "NO₂")]


def test_rate_series(spark, scratch):
    names = [f.split()[0] for f in files.RATE_SERIES_SCHEMA.split(", ")]
    values = {"FREQ": "D", "CURRENCY": "USD", "CURRENCY_DENOM": "EUR", "TIME_PERIOD": "2024-01-02", "OBS_VALUE": "1.0956", "OBS_STATUS": "A"}
    path = write(f"{scratch}/r.csv", ",".join(names) + "\n" + ",".join(values.get(n, "") for n in names) + "\n")
    row = files.scan_rate_series(spark, path, LOAD).first()
    assert len(names) == 32 and row.TIME_PERIOD == date(2024, 1, 2) and row.OBS_VALUE == 1.0956
    assert row.source_url == path and row.loaded_at == LOAD


def pages(spark, *docs, **columns):
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")
    return df.withColumns({k: F.lit(v) for k, v in columns.items()})


def test_locations(spark):
    sensor = {"id": 5, "parameter": {"name": "pm25", "units": "µg/m³", "displayName": "PM2.5"}}
    doc = {"results": [
        {"id": 1, "name": "A", "timezone": "UTC", "country": {"code": "US"}, "coordinates": {"latitude": 40.5, "longitude": -74.0},
         "sensors": [sensor, {**sensor, "id": 6}], "datetimeFirst": {"utc": "2020-01-01T00:00:00Z"}, "datetimeLast": None,
         "provider": {"name": "P"}},
        {"id": 2, "name": "B", "sensors": []},
    ]}
    got = documents.flatten_locations(pages(spark, doc, {"results": []}), LOAD)
    cols = ["location_id", "sensor_id", "p_name", "latitude", "first_datetime_utc", "last_datetime_utc", "provider_name"]
    assert rows(got, *cols) == sorted([
        (1, 5, "pm25", 40.5, datetime(2020, 1, 1), None, "P"),
        (1, 6, "pm25", 40.5, datetime(2020, 1, 1), None, "P"),
        (2, None, None, None, None, None, None),
    ], key=repr)


def test_sensor_days(spark):
    doc = {"results": [
        {"value": 1.5, "period": {"datetimeFrom": {"utc": "2024-01-31T05:00:00Z"}}, "summary": None,
         "coverage": {"percentComplete": 80.0, "expectedCount": 24}},
        {"value": None, "period": {"datetimeFrom": {"utc": "2024-02-01T05:00:00Z"}},
         "summary": {"min": 1.0, "max": 2.0, "median": 1.2}, "coverage": None},
    ]}
    frame = pages(spark, doc, {"results": []}, sensor_id=1, location_id=2, parameter="o3", units="ppm")
    got = documents.flatten_sensor_days(frame)
    assert rows(got, "sensor_id", "date_utc", "value", "min_val", "median_val", "coverage_pct", "expected_count") == [
        (1, date(2024, 1, 31), 1.5, None, None, 80.0, 24),
        (1, date(2024, 2, 1), None, 1.0, 1.2, None, None),
    ]


def test_indicators(spark):
    row = {"indicator": {"id": "GDP", "value": "GDP (US$)"}, "country": {"id": "US", "value": "United States"},
           "countryiso3code": "USA", "unit": "", "obs_status": "", "decimal": 0}
    values = [("2022", 26006893000000), ("2023", 2.7720709e13), ("2024", None), ("bad", 0)]
    doc = [{"page": 1}, [{**row, "date": y, "value": v} for y, v in values]]
    got = documents.flatten_indicators(pages(spark, doc, [{"message": "none"}]), LOAD)
    assert rows(got, "countryiso3code", "year", "value") == sorted([
        ("USA", 2022, 26006893000000), ("USA", 2023, 27720709000000), ("USA", 2024, None), ("USA", None, 0),
    ], key=repr)
    silver = facts.silver_gdp(got.withColumnRenamed("x", "y"))
    assert [r.year for r in silver.orderBy("year").collect()] == [2022, 2023]


def test_weather(spark):
    codes = [0, 3, 4, 45, 55, 71, 81, 99, None, 2]
    n = len(codes)
    doc = {"hourly": {
        "time": [f"2023-01-01T{h:02d}:00" for h in range(n)],
        "temperature_2m": [5.0] * (n - 1) + [None],
        "apparent_temperature": [0.0, None, 1.0] + [2.0] * (n - 3),
        "precipitation": [0.1, 0.11, None] + [0.0] * (n - 3),
        "wind_speed_10m": [None] + [3.0] * (n - 1),
        "relative_humidity_2m": [None] + [50.0] * (n - 1),
        "weather_code": codes,
    }}
    got = documents.flatten_weather(pages(spark, doc), datetime(2023, 1, 1, 0), datetime(2023, 1, 2)).orderBy("hour").collect()
    assert [r.condition for r in got] == [
        "clear", "partly_cloudy", "other", "fog", "rain", "snow", "showers", "thunderstorm", "unknown",
    ]
    assert [r.feels_like_c for r in got[:3]] == [5.0, 5.0, 1.0]
    assert [r.is_rainy for r in got[:3]] == [False, True, False]
    assert (got[0].wind_speed_kmh, got[0].humidity, got[2].precipitation_mm, got[0].date_key) == (0.0, 0.0, 0.0, 20230101)
    cut = documents.flatten_weather(pages(spark, doc), datetime(2023, 1, 1, 2), datetime(2023, 1, 1, 4))
    assert rows(cut, "hour") == [(2,), (3,)]
