"""The given tables shaped as the domain tables, in Spark and as SQL.

Trips come from lineitem, readings from events (moved back 26 years so that
they share dates with trips), rates from orders, yearly values from orders by
nation, sensors from customer and zones from nation and supplier.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from urbanlake.functions.dates import date_dimension
from urbanlake.operators import dims, facts
from urbanlake.operators.measures import Model
from urbanlake.operators.timeseries import fill_gaps
from urbanlake.session import scratch_path

TRIP_SOURCE = "trip_files"


def near(column: str, digits: int) -> Column:
    """A double rounded half up to ``digits``; two more digits are settled first.

    Sums of doubles differ in their last bits with the order of the rows, which
    would tip a value that lies halfway.
    """
    return F.round(F.col(column).cast(f"decimal(38,{digits + 2})"), digits).cast("double")


def near_sql(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,{digits + 2})), {digits}) AS DOUBLE)"


_LANDED: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """The path of a landed copy, written once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _LANDED:
        path = scratch_path(spark, label)
        write(path)
        _LANDED[key] = path
    return _LANDED[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- trips -----------------------------------------------------------------------------

TRIPS_RAW = """trips_raw AS (
  SELECT CAST(l_suppkey % 2 + 1 AS BIGINT) AS vendorid,
    l_shipdate + to_minutes(CAST(l_partkey % 1440 AS BIGINT)) AS tpep_pickup_datetime,
    l_shipdate + to_minutes(CAST(l_partkey % 1440 AS BIGINT) + CAST(l_quantity AS BIGINT) * 15 - 20)
      AS tpep_dropoff_datetime,
    CAST(l_linenumber AS DOUBLE) AS passenger_count,
    l_quantity * CAST(2.1 AS DOUBLE) AS trip_distance,
    CAST(nullif(l_suppkey % 25, 24) AS INTEGER) AS pulocationid,
    CAST(l_partkey % 25 AS INTEGER) AS dolocationid,
    CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS INTEGER) AS payment_type,
    l_extendedprice - 2000 AS fare_amount,
    l_extendedprice - 1500 AS total_amount,
    TIMESTAMP '2002-01-01' + to_hours(CAST(l_orderkey % 24 AS BIGINT)) AS loaded_at
  FROM lineitem)"""

TRIPS = """trips AS (
  SELECT *, date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60.0 AS trip_duration_min,
    CAST(tpep_pickup_datetime AS DATE) AS trip_date,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour_of_day,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS day_of_week
  FROM trips_raw
  WHERE pulocationid IS NOT NULL AND dolocationid IS NOT NULL
    AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND passenger_count BETWEEN 1 AND 6 AND fare_amount >= 0 AND total_amount >= 0
    AND trip_distance BETWEEN 0.01 AND 100 AND tpep_dropoff_datetime > tpep_pickup_datetime
    AND date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60.0 BETWEEN 1 AND 720)"""


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey % 2 + 1 AS VendorID",
        "l_shipdate + make_dt_interval(0, 0, CAST(l_partkey % 1440 AS INT)) AS tpep_pickup_datetime",
        "l_shipdate + make_dt_interval(0, 0, CAST(l_partkey % 1440 AS INT) + CAST(l_quantity AS INT) * 15 - 20)"
        " AS tpep_dropoff_datetime",
        "CAST(l_linenumber AS DOUBLE) AS passenger_count",
        "l_quantity * 2.1D AS trip_distance",
        "nullif(l_suppkey % 25, 24L) AS PULocationID",
        "l_partkey % 25 AS DOLocationID",
        "CASE l_returnflag WHEN 'A' THEN 1L WHEN 'N' THEN 2L ELSE 3L END AS payment_type",
        "l_extendedprice - 2000 AS fare_amount",
        "l_extendedprice - 1500 AS total_amount",
        "TIMESTAMP_NTZ '2002-01-01' + make_dt_interval(0, CAST(l_orderkey % 24 AS INT)) AS loaded_at",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trips; the load time of the row is kept."""
    raw = trips_raw(spark, sf_dir).withColumnRenamed("loaded_at", "landed_at")
    return facts.silver_trips(raw, TRIP_SOURCE, F.col("landed_at")).drop("landed_at")


# --- readings --------------------------------------------------------------------------

READINGS_RAW = """readings_raw AS (
  SELECT event_id, user_id AS sensor_id,
    CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END
      AS BIGINT) AS location_id,
    CASE event_type WHEN 'view' THEN 'pm25' WHEN 'click' THEN 'PM10' WHEN 'purchase' THEN 'no2'
      WHEN 'signup' THEN 'o3' ELSE 'temperature' END AS parameter,
    CASE event_type WHEN 'view' THEN 'µg/m³' WHEN 'click' THEN 'µg/m³' WHEN 'error' THEN 'c' ELSE 'ppm' END AS units,
    ts - INTERVAL 26 YEAR AS ts_utc,
    CAST(ts - INTERVAL 26 YEAR AS DATE) AS date_utc,
    CAST(hour(ts) AS INTEGER) AS hour_utc,
    value - 5 AS value, value - 6 AS min_val, value - 4 AS max_val, value - 5 AS median_val,
    CAST(props->>'$.k' AS DOUBLE) AS coverage_pct,
    CAST(1 AS INTEGER) AS reading_count, ts AS loaded_at
  FROM events)"""

DAILY = """daily AS (
  SELECT sensor_id, location_id, parameter, units, date_utc AS measurement_date, value, min_val, max_val, median_val,
    coverage_pct, CAST(year(date_utc) AS INTEGER) AS year, CAST(month(date_utc) AS INTEGER) AS month, loaded_at
  FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id, date_utc, parameter ORDER BY loaded_at DESC) AS rn
        FROM readings_raw WHERE value >= 0 AND coverage_pct >= 75 AND date_utc IS NOT NULL)
  WHERE rn = 1)"""

HOURLY = """hourly AS (
  SELECT sensor_id, location_id, parameter, units, date_utc AS measurement_date, hour_utc, value, reading_count,
    CAST(year(date_utc) AS INTEGER) AS year, CAST(month(date_utc) AS INTEGER) AS month, loaded_at
  FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id, date_utc, hour_utc, parameter
          ORDER BY loaded_at DESC) AS rn
        FROM readings_raw WHERE value >= 0 AND date_utc IS NOT NULL AND hour_utc BETWEEN 0 AND 23)
  WHERE rn = 1)"""

_PARAMETER = (
    "CASE event_type WHEN 'view' THEN 'pm25' WHEN 'click' THEN 'PM10' WHEN 'purchase' THEN 'no2' "
    "WHEN 'signup' THEN 'o3' ELSE 'temperature' END"
)
_UNITS = "CASE event_type WHEN 'view' THEN 'µg/m³' WHEN 'click' THEN 'µg/m³' WHEN 'error' THEN 'c' ELSE 'ppm' END"
_LOCATION = (
    "CASE event_type WHEN 'view' THEN 1L WHEN 'click' THEN 2L WHEN 'purchase' THEN 3L WHEN 'signup' THEN 4L ELSE 5L END"
)


def readings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id AS sensor_id",
        f"{_LOCATION} AS location_id",
        f"{_PARAMETER} AS parameter",
        f"{_UNITS} AS units",
        "ts - INTERVAL '26' YEAR AS ts_utc",
        "to_date(ts - INTERVAL '26' YEAR) AS date_utc",
        "hour(ts) AS hour_utc",
        "value - 5 AS value",
        "value - 6 AS min_val",
        "value - 4 AS max_val",
        "value - 5 AS median_val",
        "CAST(get_json_object(props, '$.k') AS DOUBLE) AS coverage_pct",
        "1 AS reading_count",
        "ts AS loaded_at",
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.silver_daily(readings_raw(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.silver_hourly(readings_raw(spark, sf_dir))


# --- sensors and zones -----------------------------------------------------------------

SENSOR_ZONES = """sensor_zones AS (
  SELECT c_custkey AS sensor_id, nullif(c_nationkey, 13) AS zone_id FROM customer)"""

PARAMS = """params AS (SELECT * FROM (VALUES (1, 'pm1'), (2, 'pm25'), (3, 'pm10'), (4, 'relativehumidity'), (5, 'nox'),
  (6, 'temperature'), (7, 'no2'), (8, 'no'), (9, 'o3'), (10, 'co'), (11, 'um003'), (12, 'so2')) AS t(p_id, p_name))"""

ZONES = """zones AS (SELECT n_nationkey AS zone_id, n_name AS zone_name, r_name AS borough
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def sensor_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("c_custkey AS sensor_id", "nullif(c_nationkey, 13) AS zone_id")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_nationkey AS zone_id", "n_name AS zone_name", "r_name AS borough"
    )


# Sensors on a quarter-degree-ish lattice; square zones around lattice points, each with a square hole.
POINTS = """points AS (
  SELECT c_custkey AS sensor_id, CAST(c_nationkey AS BIGINT) AS location_id, c_mktsegment AS p_name,
    (c_custkey * 7919 % 1024) / 16.0 - 32 AS longitude, (c_custkey * 104729 % 1024) / 16.0 - 32 AS latitude
  FROM customer)"""

SHAPES = """shapes AS (
  SELECT CAST(s_suppkey AS INTEGER) AS zone_id, s_name AS zone_name, CAST(s_nationkey AS VARCHAR) AS borough,
    (s_suppkey * 6151 % 512) / 8.0 - 32 AS x, (s_suppkey * 12289 % 512) / 8.0 - 32 AS y, 1 + s_nationkey % 4 AS half
  FROM supplier)"""


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS sensor_id",
        "CAST(c_nationkey AS BIGINT) AS location_id",
        "c_mktsegment AS p_name",
        "(c_custkey * 104729 % 1024) / 16D - 32 AS latitude",
        "(c_custkey * 7919 % 1024) / 16D - 32 AS longitude",
        "TIMESTAMP_NTZ '2002-01-01' AS loaded_at",
    )


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares of half width 1 to 4 with a hole of a quarter of the width."""
    base = table(spark, sf_dir, "supplier").selectExpr(
        "CAST(s_suppkey AS INT) AS zone_id",
        "s_name AS zone_name",
        "CAST(s_nationkey AS STRING) AS borough",
        "(s_suppkey * 6151 % 512) / 8D - 32 AS x",
        "(s_suppkey * 12289 % 512) / 8D - 32 AS y",
        "1 + s_nationkey % 4 AS half",
    )

    def ring(half: str) -> str:
        corner = [("-", "-"), ("+", "-"), ("+", "+"), ("-", "+"), ("-", "-")]
        return ", ', ', ".join(f"x {a} {half}, ' ', y {b} {half}" for a, b in corner)

    return base.selectExpr(
        "zone_id",
        "zone_name",
        "borough",
        f"concat('POLYGON ((', {ring('half')}, '), (', {ring('half / 4D')}, '))') AS geometry_wkt",
    )


# --- rates and yearly values -----------------------------------------------------------

FX_RAW = """fx_raw AS (
  SELECT CAST(o_orderdate AS DATE) AS time_period,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'USD' WHEN '2-HIGH' THEN 'GBP' WHEN '3-MEDIUM' THEN 'CHF'
      WHEN '4-NOT SPECIFIED' THEN 'JPY' ELSE 'EUR' END AS currency,
    CASE o_orderstatus WHEN 'O' THEN 'EUR' WHEN 'F' THEN 'USD' ELSE 'SEK' END AS currency_denom,
    o_totalprice / 10000 - 1 AS obs_value, CASE WHEN o_totalprice < 20000 THEN 'E' ELSE 'A' END AS obs_status,
    'D' AS freq, o_orderdate + to_hours(CAST(o_custkey % 24 AS BIGINT)) AS loaded_at
  FROM orders)"""

FX = """fx AS (
  SELECT time_period AS rate_date, currency AS from_currency, currency_denom AS to_currency,
    CAST(obs_value AS DECIMAL(18,6)) AS rate, obs_status, freq AS frequency, loaded_at
  FROM (SELECT *, row_number() OVER (PARTITION BY time_period, currency, currency_denom
          ORDER BY loaded_at DESC, CAST(obs_value AS DECIMAL(18,6)) DESC) AS rn
        FROM fx_raw WHERE obs_status = 'A' AND obs_value > 0)
  WHERE rn = 1)"""

FX_FILLED = """fx_filled AS (
  SELECT CAST(unnest(generate_series(rate_date, coalesce(following - 1, max_date), INTERVAL 1 DAY)) AS DATE) AS rate_date,
    from_currency, to_currency, rate, rate_date AS observed_on
  FROM (SELECT *, lead(rate_date) OVER (PARTITION BY from_currency, to_currency ORDER BY rate_date) AS following,
          max(rate_date) OVER () AS max_date FROM fx))"""

GDP_RAW = """gdp_raw AS (
  SELECT n_name AS countryiso3code, n_name AS country_name, o_orderpriority AS indicator_id,
    o_orderpriority AS indicator_name, CAST(year(o_orderdate) AS BIGINT) AS year, o_totalprice - 50000 AS value,
    o_orderdate AS loaded_at
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

GDP = """gdp AS (
  SELECT countryiso3code AS country_code, country_name, indicator_id, indicator_name, year,
    CAST(value AS DECIMAL(20,2)) AS gdp_usd, loaded_at
  FROM (SELECT *, row_number() OVER (PARTITION BY countryiso3code, indicator_id, year
          ORDER BY loaded_at DESC, CAST(value AS DECIMAL(20,2)) DESC) AS rn
        FROM gdp_raw WHERE CAST(value AS DECIMAL(20,2)) > 0)
  WHERE rn = 1)"""


def fx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "to_date(o_orderdate) AS TIME_PERIOD",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'USD' WHEN '2-HIGH' THEN 'GBP' WHEN '3-MEDIUM' THEN 'CHF' "
        "WHEN '4-NOT SPECIFIED' THEN 'JPY' ELSE 'EUR' END AS CURRENCY",
        "CASE o_orderstatus WHEN 'O' THEN 'EUR' WHEN 'F' THEN 'USD' ELSE 'SEK' END AS CURRENCY_DENOM",
        "o_totalprice / 10000 - 1 AS OBS_VALUE",
        "CASE WHEN o_totalprice < 20000 THEN 'E' ELSE 'A' END AS OBS_STATUS",
        "'D' AS FREQ",
        "o_orderdate + make_dt_interval(0, CAST(o_custkey % 24 AS INT)) AS loaded_at",
    )


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.silver_fx(fx_raw(spark, sf_dir))


def fx_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_gaps(fx(spark, sf_dir), ["from_currency", "to_currency"], "rate_date")


def gdp_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "n_name AS countryiso3code",
        "n_name AS country_name",
        "o_orderpriority AS indicator_id",
        "o_orderpriority AS indicator_name",
        "CAST(year(o_orderdate) AS BIGINT) AS year",
        "o_totalprice - 50000 AS value",
        "o_orderdate AS loaded_at",
    )


def gdp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.silver_gdp(gdp_raw(spark, sf_dir))


# --- star schema -----------------------------------------------------------------------

FCT_TAXI_DAILY = """fct_taxi_daily AS (
  SELECT CAST(strftime(trip_date, '%Y%m%d') AS INTEGER) AS date_key, pulocationid AS pickup_zone_id,
    payment_type AS payment_id, count(*) AS trip_count, sum(fare_amount) AS total_fare_usd,
    sum(total_amount) AS total_revenue_usd, sum(trip_distance) AS total_distance_miles,
    avg(trip_duration_min) AS avg_trip_duration_min, CAST(sum(passenger_count) AS BIGINT) AS total_passengers
  FROM trips GROUP BY 1, 2, 3)"""

FCT_TAXI_HOURLY = """fct_taxi_hourly AS (
  SELECT CAST(strftime(trip_date, '%Y%m%d') AS INTEGER) AS date_key, pulocationid AS pickup_zone_id,
    payment_type AS payment_id, hour_of_day AS hour, count(*) AS trip_count, sum(fare_amount) AS total_fare_usd,
    sum(total_amount) AS total_revenue_usd, sum(trip_distance) AS total_distance_miles,
    avg(trip_duration_min) AS avg_trip_duration_min, CAST(sum(passenger_count) AS BIGINT) AS total_passengers
  FROM trips GROUP BY 1, 2, 3, 4)"""

_AIR = """SELECT a.*, p_id FROM (
    SELECT zone_id, CAST(strftime(measurement_date, '%Y%m%d') AS INTEGER) AS date_key, lower(parameter) AS p_name,{hour}
      avg(value) AS avg_value, count(*) AS sensor_count
    FROM {table} JOIN sensor_zones USING (sensor_id)
    WHERE zone_id IS NOT NULL AND lower(parameter) IN ('pm25', 'no2', 'o3', 'co', 'pm10')
    GROUP BY ALL) a LEFT JOIN params USING (p_name)"""

FCT_AIR = f"fct_air_quality AS ({_AIR.format(table='daily', hour='')})"
FCT_AIR_HOURLY = f"fct_air_quality_hourly AS ({_AIR.format(table='hourly', hour=' hour_utc AS hour,')})"

FCT_FX = """fct_fx_daily AS (
  SELECT CAST(strftime(rate_date, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(CASE from_currency WHEN 'USD' THEN 1 WHEN 'EUR' THEN 2 END AS INTEGER) AS id_cur_from,
    CAST(CASE to_currency WHEN 'USD' THEN 1 WHEN 'EUR' THEN 2 END AS INTEGER) AS id_cur_to, rate
  FROM fx_filled)"""

FCT_GDP = "fct_gdp_yearly AS (SELECT year, country_code, gdp_usd FROM gdp)"

TAXI_CTES = (TRIPS_RAW, TRIPS, FCT_TAXI_DAILY)
TAXI_HOUR_CTES = (TRIPS_RAW, TRIPS, FCT_TAXI_HOURLY)
AIR_CTES = (READINGS_RAW, DAILY, SENSOR_ZONES, PARAMS, FCT_AIR)
AIR_HOUR_CTES = (READINGS_RAW, HOURLY, SENSOR_ZONES, PARAMS, FCT_AIR_HOURLY)
FX_CTES = (FX_RAW, FX, FX_FILLED, FCT_FX)
GDP_CTES = (GDP_RAW, GDP, FCT_GDP)


class _Model(dict):
    """Tables of the star schema, built when first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]) -> None:
        super().__init__()
        self._builders = builders

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._builders[name]()
        return self[name]


def model(spark: SparkSession, sf_dir: str) -> Model:
    """The star schema. Facts are stored once per application and input, as a warehouse does, and read by all that ask."""

    def stored(name: str, build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        def read() -> DataFrame:
            return spark.read.parquet(landed(spark, sf_dir, name, lambda path: build().write.parquet(path)))

        return read

    def air(readings: Callable[[SparkSession, str], DataFrame], grain: str) -> DataFrame:
        return facts.air_fact(readings(spark, sf_dir), sensor_zones(spark, sf_dir), dims.parameters(spark), grain)

    built = {
        "fct_taxi_daily": lambda: facts.taxi_fact(trips(spark, sf_dir), "day"),
        "fct_taxi_hourly": lambda: facts.taxi_fact(trips(spark, sf_dir), "hour"),
        "fct_air_quality": lambda: air(daily, "day"),
        "fct_air_quality_hourly": lambda: air(hourly, "hour"),
        "fct_fx_daily": lambda: facts.fx_fact(fx_filled(spark, sf_dir), dims.currencies(spark)),
        "fct_gdp_yearly": lambda: facts.gdp_fact(gdp(spark, sf_dir)),
    }
    return _Model(
        {
            **{name: stored(name, build) for name, build in built.items()},
            "dm_date": lambda: date_dimension(spark, "1995-01-01", 2922),
            "dm_zone": lambda: zones(spark, sf_dir),
            "dm_payment": lambda: dims.payments(spark),
            "dm_vendor": lambda: dims.vendors(spark),
            "dm_currency": lambda: dims.currencies(spark),
            "dm_air_measurement": lambda: dims.parameters(spark),
        }
    )
