"""Scans: tables written by Spark from the given data, then read by each reader."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.operators import dims
from urbanlake.plans import jobs
from urbanlake.queries import bindings as b
from urbanlake.queries.bindings import landed
from urbanlake.queries.registry import query
from urbanlake.session import scratch_path, stage
from urbanlake.sources import archive_index, documents, files, tables

def trip_files(spark: SparkSession, sf_dir: str) -> str:
    """Raw trips under year=/month= folders of the pickup month."""
    raw = b.trips_raw(spark, sf_dir).withColumns(
        {"year": F.year("tpep_pickup_datetime"), "month": F.month("tpep_pickup_datetime")}
    )

    def write(path: str) -> None:
        tables.overwrite_partitions(raw, path, ["year", "month"])

    return landed(spark, sf_dir, "trip-files", write)


def archive_files(spark: SparkSession, sf_dir: str) -> str:
    """Readings as csv.gz under locationid=/year=/month= folders; times carry an offset."""
    raw = _archive_rows(b.readings_raw(spark, sf_dir))
    return landed(spark, sf_dir, "archive", lambda path: _write_archive(raw, path))


def _archive_rows(readings: DataFrame) -> DataFrame:
    return readings.select(
        "location_id",
        F.col("sensor_id").alias("sensors_id"),
        F.concat(F.lit("site "), "location_id").alias("location"),
        F.concat(F.date_format(F.col("ts_utc") - F.expr("interval 5 hours"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")).alias("datetime"),
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("lon"),
        "parameter",
        "units",
        "value",
        F.col("location_id").alias("locationid"),
        F.year("ts_utc").alias("year"),
        F.month("ts_utc").alias("month"),
    )


def _write_archive(raw: DataFrame, path: str, compression: str = "gzip") -> None:
    writer = raw.write.partitionBy("locationid", "year", "month")
    writer.option("header", True).option("compression", compression).csv(path)


@query(
    "scan_parquet_partition",
    """SELECT vendorid, tpep_pickup_datetime, payment_type, round(total_amount, 2) AS total_amount
    FROM trips_raw WHERE tpep_pickup_datetime >= TIMESTAMP '1998-03-01'
      AND tpep_pickup_datetime < TIMESTAMP '1998-04-01'""",
    b.TRIPS_RAW,
)
def scan_parquet_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = files.scan_months(spark, trip_files(spark, sf_dir), ["1998-03"])
    return month.select(
        F.col("VendorID").alias("vendorid"),
        "tpep_pickup_datetime",
        F.col("payment_type").cast("int").alias("payment_type"),
        F.round("total_amount", 2).alias("total_amount"),
    )


@query(
    "add_partition_columns",
    """SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
      count(*) AS row_count FROM trips_raw GROUP BY 1, 2""",
    b.TRIPS_RAW,
)
def add_partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.parquet(trip_files(spark, sf_dir)).drop("year", "month")
    return tables.partition_counts(files.partition_columns_from_path(raw), ["year", "month"])


_ARCHIVE_ROWS = """SELECT sensor_id AS sensors_id, location_id, parameter, units, round(value, 2) AS value,
  strftime(ts_utc - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S') || '-05:00' AS datetime,
  CAST(month(ts_utc) AS INTEGER) AS month FROM readings_raw"""


def _archive_columns(df: DataFrame) -> DataFrame:
    value = F.round("value", 2).alias("value")
    return df.select("sensors_id", "location_id", "parameter", "units", value, "datetime", "month")


@query("scan_csv_gz", _ARCHIVE_ROWS, b.READINGS_RAW)
def scan_csv_gz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _archive_columns(files.scan_archive(spark, archive_files(spark, sf_dir)))


@query("scan_existing_paths", _ARCHIVE_ROWS + " WHERE location_id IN (1, 3)", b.READINGS_RAW)
def scan_existing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations 1 and 3 exist, 99 and the month 1997-12 do not; the claimed months of a ledger prune the index."""
    root, store = archive_files(spark, sf_dir), scratch_path(spark, "archive-index")
    wanted = spark.createDataFrame([(1,), (3,), (99,)], "location_id bigint")
    archive_index.register(spark, root, store, wanted, ["1997-12", "1998-01", "1998-02"])
    states = [("1997-12", "running"), ("1998-01", "running"), ("1998-02", "pending")]
    claimed = spark.createDataFrame(states, "partition_key string, status string").where("status = 'running'")
    found = archive_index.wanted_files(archive_index.read_index(spark, store), archive_index.month_frame(claimed), wanted)
    return _archive_columns(reduce(DataFrame.union, [archive_index.read_files(spark, root, some) for some in archive_index.slices(found)]))


# The readings over four months, by the day of the month.
_SPREAD = """spread AS (
  SELECT *, month(moved) AS month, strftime(moved, '%Y-%m') AS key FROM (
    SELECT *, ts_utc + to_months(CAST(day(ts_utc) // 10 AS INTEGER)) AS moved FROM readings_raw))"""
_BAD = (3, 2)


def damaged_archive(spark: SparkSession, sf_dir: str) -> str:
    """An archive of four months, in which the folder of one location and month holds what no reader can unpack."""
    moved = b.readings_raw(spark, sf_dir).withColumn("ts_utc", F.expr("ts_utc + make_ym_interval(0, CAST(day(ts_utc) div 10 AS INT))"))
    raw = _archive_rows(moved)
    bad = (F.col("locationid") == _BAD[0]) & (F.col("month") == _BAD[1])

    def write(path: str) -> None:
        _write_archive(raw.where(~bad), path)
        plain = scratch_path(spark, "archive-plain")
        _write_archive(raw.where(bad), plain, "none")
        # Text under the name of an archive.
        conf, fs_path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
        fs = fs_path(path).getFileSystem(conf)
        for number, name in enumerate(spark.read.text(plain).inputFiles()):
            folder = fs_path(path + name[name.index("/locationid=") : name.rindex("/")])
            fs.mkdirs(folder)
            fs.rename(fs_path(name), fs_path(folder, f"bad-{number}.csv.gz"))

    return landed(spark, sf_dir, "damaged-archive", write)


@query(
    "scan_archive_health",
    f"""SELECT location_id AS locationid, CAST(month AS INTEGER) AS month,
      CASE WHEN location_id = {_BAD[0]} AND month = {_BAD[1]} THEN 'unreadable' ELSE 'good' END AS status,
      CASE WHEN location_id = {_BAD[0]} AND month = {_BAD[1]} THEN 0 ELSE count(*) END AS row_count
    FROM spread GROUP BY location_id, month""",
    b.READINGS_RAW,
    _SPREAD,
)
def scan_archive_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of all folders, those that cannot be read to the end, and the rows of the others."""
    root, store = damaged_archive(spark, sf_dir), scratch_path(spark, "archive-index")
    locations = b.readings_raw(spark, sf_dir).select("location_id").distinct()
    archive_index.register(spark, root, store, locations, ["1998-01", "1998-02", "1998-03", "1998-04"])

    def read(paths: list[str]) -> DataFrame:
        return archive_index.read_files(spark, root, paths)

    listed = stage(archive_index.health(read, archive_index.read_index(spark, store)), "archive-health")
    good = [read(some) for some in archive_index.slices(listed.where("status = 'good'"))]
    counts = reduce(DataFrame.union, good).groupBy("locationid", "month").agg(F.count("*").alias("row_count"))
    folders = listed.groupBy("locationid", "month").agg(F.max("status").alias("status"))
    rows = F.when(F.col("status") == "good", F.coalesce("row_count", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
    return folders.join(counts, ["locationid", "month"], "left").select("locationid", "month", "status", rows.alias("row_count"))


@query(
    "archive_load_results",
    f"""SELECT 's3_archive' AS source_name, key AS partition_key,
      CASE WHEN bool_or(location_id = {_BAD[0]} AND month = {_BAD[1]}) THEN 0
        ELSE count(DISTINCT (sensor_id, location_id, parameter, units, date_trunc('hour', moved))) END AS rows_written,
      CASE WHEN bool_or(location_id = {_BAD[0]} AND month = {_BAD[1]}) THEN 'failed' ELSE 'succeeded' END AS new_status
    FROM spread GROUP BY key
    UNION ALL SELECT 's3_archive', '1998-05', 0, 'succeeded'""",
    b.READINGS_RAW,
    _SPREAD,
)
def archive_load_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One result per month: a month with an unreadable file fails alone, one without folders has no rows."""
    root = damaged_archive(spark, sf_dir)
    null = F.lit(None).cast("timestamp_ntz")
    sensors = b.readings_raw(spark, sf_dir).select("sensor_id").distinct().select(
        "sensor_id", (F.col("sensor_id") % 5 + 1).alias("location_id"), F.lit("no2").alias("p_name"),
        null.alias("first_datetime_utc"), null.alias("last_datetime_utc"), F.lit("2024-01-01").cast("timestamp").alias("loaded_at"),
    )
    keys = ["1998-01", "1998-02", "1998-03", "1998-04", "1998-05"]
    results = jobs.load_archive_months(spark, root, sensors, keys, scratch_path(spark, "archive-bronze"), datetime(2024, 1, 1))
    return results.drop("message")


@query(
    "scan_csv_lookup",
    """SELECT CASE WHEN s_acctbal >= 0 THEN CAST(s_suppkey AS INTEGER) END AS zone_id,
      'borough ' || s_nationkey AS borough, s_name AS zone_name, 'service "A", ' || s_nationkey AS service_zone
    FROM supplier""",
)
def scan_csv_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header that differs in case, quoted text, and ids that are not numbers."""
    raw = b.table(spark, sf_dir, "supplier").selectExpr(
        "CASE WHEN s_acctbal >= 0 THEN CAST(s_suppkey AS STRING) ELSE 'N/A' END AS LocationID",
        "concat('borough ', s_nationkey) AS Borough",
        "s_name AS Zone",
        "concat('service \"A\", ', s_nationkey) AS service_zone",
    )
    path = landed(spark, sf_dir, "zone-lookup", lambda p: raw.write.option("header", True).csv(p))
    return files.scan_lookup(spark, path, files.ZONE_COLUMNS)


@query(
    "scan_csv_declared",
    "SELECT CAST(p_partkey AS INTEGER) AS p_id, p_name, p_brand AS p_units, p_type AS p_display_name FROM part",
)
def scan_csv_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), "p_name", F.col("p_brand").alias("p_units"), F.col("p_type").alias("label")
    )
    path = landed(spark, sf_dir, "parameters", lambda p: raw.write.option("header", True).csv(p))
    return files.scan_declared(spark, path)


@query(
    "scan_ecb_csv",
    """SELECT freq AS "FREQ", currency AS "CURRENCY", currency_denom AS "CURRENCY_DENOM", time_period AS "TIME_PERIOD",
      round(obs_value, 6) AS "OBS_VALUE", obs_status AS "OBS_STATUS", 'rates' AS source_url,
      TIMESTAMP '2002-01-01' AS loaded_at FROM fx_raw""",
    b.FX_RAW,
)
def scan_ecb_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.fx_raw(spark, sf_dir).drop("loaded_at")
    fields = [f.split()[0] for f in files.RATE_SERIES_SCHEMA.split(", ")]
    wide = raw.select(*[F.col(f) if f in raw.columns else F.lit(None).cast("string").alias(f) for f in fields])
    path = landed(spark, sf_dir, "rate-series", lambda p: wide.write.option("header", True).csv(p))
    series = files.scan_rate_series(spark, path, datetime(2002, 1, 1), "rates")
    return series.select(
        "FREQ",
        "CURRENCY",
        "CURRENCY_DENOM",
        "TIME_PERIOD",
        F.round("OBS_VALUE", 6).alias("OBS_VALUE"),
        "OBS_STATUS",
        "source_url",
        F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"),
    )


@query(
    "flatten_locations_json",
    """SELECT s_suppkey AS location_id, s_name AS name, CAST(NULL AS VARCHAR) AS locality, 'UTC' AS timezone,
      'N' || s_nationkey AS code, s_suppkey / 8.0 AS latitude, -s_suppkey / 4.0 AS longitude,
      s_suppkey * 10 + i AS sensor_id, CASE i WHEN 1 THEN 'pm25' WHEN 2 THEN 'no2' END AS p_name,
      CASE i WHEN 1 THEN 'µg/m³' WHEN 2 THEN 'ppm' END AS p_units,
      CASE i WHEN 1 THEN 'PM2.5' WHEN 2 THEN 'NO₂' END AS p_display_name,
      CASE WHEN s_acctbal >= 0 THEN TIMESTAMP '2016-03-06 19:00:00' END AS first_datetime_utc,
      CAST(NULL AS TIMESTAMP) AS last_datetime_utc, 'provider ' || s_nationkey AS provider_name,
      TIMESTAMP '2002-01-01' AS loaded_at
    FROM (SELECT *, unnest(CASE WHEN s_nationkey < 5 THEN [CAST(NULL AS INTEGER)] WHEN s_nationkey < 15 THEN [1]
      ELSE [1, 2] END) AS i FROM supplier)""",
)
def flatten_locations_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per supplier with no, one or two sensors."""
    sensor = (
        "named_struct('id', s_suppkey * 10 + {i}, 'parameter', named_struct('name', '{n}', 'units', '{u}', "
        "'displayName', '{d}'))"
    )
    one, two = sensor.format(i=1, n="pm25", u="µg/m³", d="PM2.5"), sensor.format(i=2, n="no2", u="ppm", d="NO₂")
    pages = b.table(spark, sf_dir, "supplier").selectExpr(
        f"""to_json(named_struct('meta', named_struct('page', 1), 'results', array(named_struct(
          'id', s_suppkey, 'name', s_name, 'timezone', 'UTC', 'country', named_struct('code', concat('N', s_nationkey)),
          'coordinates', named_struct('latitude', s_suppkey / 8D, 'longitude', -s_suppkey / 4D),
          'sensors', CASE WHEN s_nationkey < 5 THEN array() WHEN s_nationkey < 15 THEN array({one})
            ELSE array({one}, {two}) END,
          'datetimeFirst', CASE WHEN s_acctbal >= 0 THEN named_struct('utc', '2016-03-06T14:00:00-05:00') END,
          'provider', named_struct('name', concat('provider ', s_nationkey)))))) AS payload"""
    )
    return documents.flatten_locations(pages, F.expr("TIMESTAMP_NTZ '2002-01-01'"))


@query(
    "flatten_sensor_days_json",
    """SELECT sensor_id, location_id, parameter, units, date_utc, round(value, 2) AS value,
      CASE WHEN location_id <> 2 THEN round(min_val, 2) END AS min_val,
      CASE WHEN location_id <> 2 THEN round(max_val, 2) END AS max_val,
      CASE WHEN location_id <> 2 THEN round(median_val, 2) END AS median_val,
      CASE WHEN location_id <> 3 THEN coverage_pct END AS coverage_pct,
      CASE WHEN location_id <> 3 THEN CAST(24 AS INTEGER) END AS expected_count FROM readings_raw""",
    b.READINGS_RAW,
)
def flatten_sensor_days_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One result per page; summary is missing at location 2 and coverage at location 3."""
    pages = b.readings_raw(spark, sf_dir).selectExpr(
        "sensor_id",
        "location_id",
        "parameter",
        "units",
        """to_json(named_struct('results', array(named_struct(
          'value', round(value, 2),
          'period', named_struct('datetimeFrom', named_struct('utc', date_format(ts_utc, "yyyy-MM-dd'T'HH:mm:ss'Z'"))),
          'summary', CASE WHEN location_id <> 2 THEN
            named_struct('min', round(min_val, 2), 'max', round(max_val, 2), 'median', round(median_val, 2)) END,
          'coverage', CASE WHEN location_id <> 3 THEN
            named_struct('percentComplete', coverage_pct, 'expectedCount', 24) END)))) AS payload""",
    )
    return documents.flatten_sensor_days(pages)


@query(
    "flatten_worldbank_json",
    """SELECT indicator_id, indicator_name, country_id, country_name, countryiso3code, year, value, '' AS unit,
      '' AS obs_status, CAST(0 AS BIGINT) AS decimal, TIMESTAMP '2002-01-01' AS loaded_at
    FROM (SELECT o_orderpriority AS indicator_id, 'indicator ' || o_orderpriority AS indicator_name,
        CAST(o_custkey AS VARCHAR) AS country_id, 'country ' || o_custkey AS country_name,
        'C' || o_custkey AS countryiso3code, CAST(year(o_orderdate) AS BIGINT) AS year,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(round(o_totalprice * 100) AS BIGINT) * 1000000 END AS value FROM orders
      UNION ALL
      SELECT o_orderpriority, 'indicator ' || o_orderpriority, CAST(o_custkey AS VARCHAR), 'country ' || o_custkey,
        'C' || o_custkey, CAST(year(o_orderdate) - 1 AS BIGINT), CAST(0 AS BIGINT) FROM orders)""",
)
def flatten_worldbank_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two years per page; the value may be null or zero."""
    row = (
        "named_struct('indicator', named_struct('id', o_orderpriority, 'value', concat('indicator ', o_orderpriority)), "
        "'country', named_struct('id', CAST(o_custkey AS STRING), 'value', concat('country ', o_custkey)), "
        "'countryiso3code', concat('C', o_custkey), 'date', CAST(year(o_orderdate) - {back} AS STRING), "
        "'value', {value}, 'unit', '', 'obs_status', '', 'decimal', 0)"
    )
    value = "CASE WHEN o_orderstatus <> 'P' THEN CAST(round(o_totalprice * 100) AS BIGINT) * 1000000 END"
    rows = f"array({row.format(back=0, value=value)}, {row.format(back=1, value='0L')})"
    pages = b.table(spark, sf_dir, "orders").selectExpr(
        f"concat('[{{\"page\":1,\"pages\":1}},', to_json({rows}), ']') AS payload"
    )
    return documents.flatten_indicators(pages, F.expr("TIMESTAMP_NTZ '2002-01-01'"))


@query("table_scan", "SELECT sensor_id, zone_id FROM sensor_zones", b.SENSOR_ZONES)
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    b.sensor_zones(spark, sf_dir).createOrReplaceTempView("openaq_sensor_zones")
    return tables.read(spark, "openaq_sensor_zones")


@query("warehouse_scan", "SELECT year, country_code, CAST(gdp_usd AS DOUBLE) AS gdp_usd FROM fct_gdp_yearly", *b.GDP_CTES)
def warehouse_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly fact as written and read back."""
    fact = b.model(spark, sf_dir)["fct_gdp_yearly"]
    path = landed(spark, sf_dir, "fct-gdp-yearly", lambda p: tables.replace(fact, p))
    return tables.read(spark, path).withColumn("gdp_usd", F.col("gdp_usd").cast("double"))


@query(
    "range_generator",
    """SELECT CAST(i AS BIGINT) AS id, count(l_orderkey) AS lines
    FROM generate_series(0, (SELECT max(l_orderkey) FROM lineitem)) AS t(i) LEFT JOIN lineitem ON i = l_orderkey
    GROUP BY 1""",
)
def range_generator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order number up to the largest, with its lines (zero for a gap)."""
    lines = b.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    top = b.table(spark, sf_dir, "lineitem").agg(F.max("l_orderkey")).first()[0]
    ids = spark.range(0, top + 1)
    return ids.join(lines, ids.id == lines.l_orderkey, "left").select("id", F.coalesce("lines", F.lit(0)).alias("lines"))


@query(
    "inline_values",
    """SELECT CAST(id AS INTEGER) AS id, label AS payment_type, count(*) AS trips FROM trips_raw JOIN (VALUES (1, 'Credit card'), (2, 'Cash'),
      (3, 'No charge'), (4, 'Dispute'), (5, 'Unknown'), (6, 'Voided trip')) AS p(id, label) ON payment_type = id
    GROUP BY id, label""",
    b.TRIPS_RAW,
)
def inline_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal payment rows with the trips of each."""
    trips = b.trips_raw(spark, sf_dir).groupBy(F.col("payment_type").alias("id")).agg(F.count("*").alias("trips"))
    return dims.payments(spark).join(trips, "id")


WEATHER_SQL = """weather AS (
  SELECT src_ts_utc, CAST(strftime(src_ts_utc, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(hour(src_ts_utc) AS INTEGER) AS hour, temp_c,
    CASE WHEN apparent IS NULL OR apparent = 0 THEN temp_c ELSE apparent END AS feels_like_c,
    coalesce(precipitation, 0.0) AS precipitation_mm, CAST(n AS DOUBLE) AS wind_speed_kmh, 50.0::DOUBLE AS humidity,
    weather_code,
    CASE WHEN weather_code = 0 THEN 'clear' WHEN weather_code BETWEEN 1 AND 3 THEN 'partly_cloudy'
      WHEN weather_code BETWEEN 40 AND 49 THEN 'fog' WHEN weather_code BETWEEN 50 AND 67 THEN 'rain'
      WHEN weather_code BETWEEN 70 AND 77 THEN 'snow' WHEN weather_code BETWEEN 80 AND 82 THEN 'showers'
      WHEN weather_code BETWEEN 95 AND 99 THEN 'thunderstorm' ELSE 'other' END AS condition,
    coalesce(precipitation, 0.0) > 0.1 AS is_rainy
  FROM (SELECT date_utc + to_hours(CAST(hour_utc AS BIGINT)) AS src_ts_utc, count(*) AS n,
      CASE WHEN max(coverage_pct) < 30 THEN NULL ELSE max(coverage_pct) - 40 END AS temp_c,
      CASE WHEN min(coverage_pct) < 2 THEN 0.0 ELSE min(coverage_pct) END AS apparent,
      CASE WHEN count(*) % 3 = 0 THEN NULL ELSE count(*) / 100.0 END AS precipitation,
      CAST(max(coverage_pct) AS INTEGER) AS weather_code
    FROM readings_raw GROUP BY date_utc, hour_utc)
  WHERE temp_c IS NOT NULL AND src_ts_utc >= TIMESTAMP '1998-01-01' AND src_ts_utc < TIMESTAMP '1998-01-29')"""


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload per day; its arrays hold at most 24 hours, as readings are rolled up by hour first."""
    hours = b.readings_raw(spark, sf_dir).groupBy("date_utc", "hour_utc").agg(
        F.count("*").alias("n"), F.max("coverage_pct").alias("high"), F.min("coverage_pct").alias("low")
    )
    point = hours.selectExpr(
        "date_utc",
        "concat(date_utc, format_string('T%02d:00', hour_utc)) AS time",
        "CASE WHEN high < 30 THEN NULL ELSE high - 40 END AS temperature_2m",
        "CASE WHEN low < 2 THEN 0D ELSE low END AS apparent_temperature",
        "CASE WHEN n % 3 = 0 THEN NULL ELSE n / 100D END AS precipitation",
        "CAST(n AS DOUBLE) AS wind_speed_10m",
        "50D AS relative_humidity_2m",
        "CAST(high AS INT) AS weather_code",
    )
    fields = point.columns[1:]
    day = point.groupBy("date_utc").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("h"))
    # A missing value is written as a JSON null, so that the arrays stay parallel.
    payload = F.struct(F.struct(*[F.col(f"h.{c}").alias(c) for c in fields]).alias("hourly"))
    pages = day.select(F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload"))
    return documents.flatten_weather(pages, datetime(1998, 1, 1), datetime(1998, 1, 29))


@query("weather_hourly_parse", "SELECT * FROM weather", b.READINGS_RAW, WEATHER_SQL)
def weather_hourly_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather(spark, sf_dir)
