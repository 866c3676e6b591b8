"""Aggregations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.operators import control, dims, facts, states, timeseries
from urbanlake.queries import bindings as b
from urbanlake.queries.registry import query
from urbanlake.session import stage
from urbanlake.sources import tables

_TAXI_COLUMNS = """date_key, pickup_zone_id, payment_id, {hour}trip_count, CAST(round(CAST(total_fare_usd AS DECIMAL(38,4)), 2) AS DOUBLE) AS total_fare_usd,
  CAST(round(CAST(total_revenue_usd AS DECIMAL(38,4)), 2) AS DOUBLE) AS total_revenue_usd, CAST(round(CAST(total_distance_miles AS DECIMAL(38,6)), 4) AS DOUBLE) AS total_distance_miles,
  CAST(round(CAST(avg_trip_duration_min AS DECIMAL(38,8)), 6) AS DOUBLE) AS avg_trip_duration_min, total_passengers"""


def _rounded(df: DataFrame, scales: dict[str, int]) -> DataFrame:
    return df.withColumns({c: b.near(c, n) for c, n in scales.items()})


_TAXI_SCALES = {
    "total_fare_usd": 2,
    "total_revenue_usd": 2,
    "total_distance_miles": 4,
    "avg_trip_duration_min": 6,
}


@query("agg_taxi_daily", f"SELECT {_TAXI_COLUMNS.format(hour='')} FROM fct_taxi_daily", *b.TAXI_CTES)
def agg_taxi_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(facts.taxi_fact(b.trips(spark, sf_dir), "day"), _TAXI_SCALES)


@query("agg_taxi_hourly", f"SELECT {_TAXI_COLUMNS.format(hour='hour, ')} FROM fct_taxi_hourly", *b.TAXI_HOUR_CTES)
def agg_taxi_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(facts.taxi_fact(b.trips(spark, sf_dir), "hour"), _TAXI_SCALES)


@query(
    "agg_air_daily",
    """SELECT zone_id, date_key, CAST(p_id AS INTEGER) AS p_id, CAST(round(CAST(avg_value AS DECIMAL(38,8)), 6) AS DOUBLE) AS avg_value, sensor_count
    FROM fct_air_quality""",
    *b.AIR_CTES,
)
def agg_air_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = facts.air_fact(b.daily(spark, sf_dir), b.sensor_zones(spark, sf_dir), dims.parameters(spark), "day")
    return _rounded(fact, {"avg_value": 6})


@query(
    "agg_air_hourly",
    """SELECT zone_id, date_key, hour, CAST(p_id AS INTEGER) AS p_id, CAST(round(CAST(avg_value AS DECIMAL(38,8)), 6) AS DOUBLE) AS avg_value, sensor_count
    FROM fct_air_quality_hourly""",
    *b.AIR_HOUR_CTES,
)
def agg_air_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = facts.air_fact(b.hourly(spark, sf_dir), b.sensor_zones(spark, sf_dir), dims.parameters(spark), "hour")
    return _rounded(fact, {"avg_value": 6})


def _archive(spark: SparkSession, sf_dir: str, sensor: str = "location_id") -> DataFrame:
    """Readings as archive rows: by default one sensor per location, times as text with an offset."""
    local = F.col("ts_utc") + F.expr("interval 9 hours")
    return b.readings_raw(spark, sf_dir).select(
        F.col(sensor).alias("sensors_id"),
        "location_id",
        "parameter",
        "units",
        F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00")).alias("datetime"),
        F.nullif("value", F.lit(0.0)).alias("value"),
    )


@query(
    "agg_raw_to_hour",
    """SELECT location_id AS sensor_id, location_id, parameter, units, date_utc, hour_utc,
      CAST(round(CAST(avg(nullif(value, 0)) AS DECIMAL(38,8)), 6) AS DOUBLE) AS value, CAST(count(nullif(value, 0)) AS INTEGER) AS reading_count
    FROM readings_raw GROUP BY ALL""",
    b.READINGS_RAW,
)
def agg_raw_to_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(facts.rollup_readings(_archive(spark, sf_dir), "hour"), {"value": 6})


@query(
    "agg_raw_to_day",
    """SELECT sensor_id, location_id, parameter, units, date_utc, CAST(round(CAST(avg(nullif(value, 0)) AS DECIMAL(38,8)), 6) AS DOUBLE) AS value,
      CAST(round(CAST(min(nullif(value, 0)) AS DECIMAL(38,4)), 2) AS DOUBLE) AS min_val, CAST(round(CAST(max(nullif(value, 0)) AS DECIMAL(38,4)), 2) AS DOUBLE) AS max_val,
      CAST(round(CAST(quantile_disc(nullif(value, 0), 0.5) AS DECIMAL(38,4)), 2) AS DOUBLE) AS median_val, CAST(NULL AS DOUBLE) AS coverage_pct,
      CAST(count(nullif(value, 0)) AS INTEGER) AS expected_count
    FROM readings_raw GROUP BY ALL""",
    b.READINGS_RAW,
)
def agg_raw_to_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = facts.rollup_readings(_archive(spark, sf_dir, "sensor_id"), "day")
    return _rounded(day, {"value": 6, "min_val": 2, "max_val": 2, "median_val": 2})


@query(
    "agg_month_median",
    """SELECT sensor_id, CAST(month(date_utc) AS INTEGER) AS month, count(nullif(value, 0)) AS "values",
      CAST(round(CAST(quantile_disc(nullif(value, 0), 0.5) AS DECIMAL(38,4)), 2) AS DOUBLE) AS median_val
    FROM readings_raw GROUP BY ALL""",
    b.READINGS_RAW,
)
def agg_month_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of a sensor's month from the sketches that its days stored."""
    readings = b.readings_raw(spark, sf_dir).withColumn("value", F.nullif("value", F.lit(0.0)))
    days = stage(states.day_sketches(readings, ["sensor_id", "date_utc"]), "day-sketches")
    months = days.withColumn("month", F.month("date_utc"))
    return _rounded(states.merged_quantiles(months, ["sensor_id", "month"], {"median_val": 0.5}), {"median_val": 2})


@query(
    "agg_zones_by_period",
    """SELECT CAST(date_key // 100 % 100 AS INTEGER) AS month, CAST(p_id AS INTEGER) AS p_id, count(DISTINCT zone_id) AS zones_with_sensors
    FROM fct_air_quality WHERE avg_value IS NOT NULL GROUP BY 1, 2
    UNION ALL SELECT NULL, NULL, count(DISTINCT zone_id) FROM fct_air_quality WHERE avg_value IS NOT NULL""",
    *b.AIR_CTES,
)
def agg_zones_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different zones by month and parameter, and over all, from the bitmaps that the days stored."""
    fact = facts.air_fact(b.daily(spark, sf_dir), b.sensor_zones(spark, sf_dir), dims.parameters(spark), "day")
    days = stage(states.zone_bitmaps(fact, ["date_key", "p_id"]), "zone-bitmaps")
    months = days.withColumn("month", (F.floor(F.col("date_key") / 100) % 100).cast("int"))
    return states.count_zones(months, ["month", "p_id"]).unionByName(states.count_zones(days, []), allowMissingColumns=True)


@query(
    "agg_max_watermark",
    "SELECT 'trips' AS source, max(loaded_at) AS watermark FROM trips_raw UNION ALL SELECT 'readings', max(ts) FROM events",
    b.TRIPS_RAW,
)
def agg_max_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = F.max("loaded_at").alias("watermark")
    trips = b.trips_raw(spark, sf_dir).agg(newest).select(F.lit("trips").alias("source"), "watermark")
    readings = b.readings_raw(spark, sf_dir).agg(newest).select(F.lit("readings").alias("source"), "watermark")
    return trips.union(readings)


@query(
    "agg_rows_by_partition",
    """SELECT CAST(year(trip_date) AS INTEGER) AS year, CAST(month(trip_date) AS INTEGER) AS month,
      count(*) AS row_count FROM trips GROUP BY 1, 2""",
    b.TRIPS_RAW,
    b.TRIPS,
)
def agg_rows_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = b.trips(spark, sf_dir).withColumns({"year": F.year("trip_date"), "month": F.month("trip_date")})
    return tables.partition_counts(trips, ["year", "month"])


@query("agg_distinct_pairs", "SELECT DISTINCT from_currency, to_currency FROM fx", b.FX_RAW, b.FX)
def agg_distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.fx(spark, sf_dir).select("from_currency", "to_currency").distinct()


@query("agg_min_max_dates", "SELECT min(rate_date) AS min_date, max(rate_date) AS max_date FROM fx", b.FX_RAW, b.FX)
def agg_min_max_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries.date_bounds(b.fx(spark, sf_dir), "rate_date")


@query(
    "agg_hourly_city",
    """SELECT date_key, hour, CAST(sum(trip_count) AS BIGINT) AS trip_count,
      CAST(round(CAST(sum(total_revenue_usd) AS DECIMAL(38,4)), 2) AS DOUBLE) AS total_revenue_usd
    FROM fct_taxi_hourly WHERE date_key >= 19980101 AND date_key < 19990101 GROUP BY 1, 2""",
    *b.TAXI_HOUR_CTES,
)
def agg_hourly_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = facts.taxi_fact(b.trips(spark, sf_dir), "hour")
    return _rounded(facts.city_hourly(fact, 19980101, 19990101), {"total_revenue_usd": 2})


RUN_LOG_SQL = """run_log AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS pipeline_name, 'silver' AS layer,
    CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'succeeded' ELSE 'running' END AS status,
    o_orderdate AS started_at, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 1 HOUR END AS ended_at
  FROM orders)"""


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per order, pipelines named by priority."""
    return b.table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS run_id",
        "o_orderpriority AS pipeline_name",
        "'silver' AS layer",
        "CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'succeeded' ELSE 'running' END AS status",
        "o_orderdate AS started_at",
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL '1' HOUR END AS ended_at",
        "CAST(NULL AS STRING) AS message",
        "CAST(NULL AS TIMESTAMP_NTZ) AS logged_at",
    )


@query(
    "agg_run_status",
    """SELECT pipeline_name, max(started_at) AS last_run, max(status) AS last_status FROM run_log GROUP BY 1""",
    RUN_LOG_SQL,
)
def agg_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.run_status(run_log(spark, sf_dir))


NOW = datetime(2002, 2, 1, 12, 0)

LEDGER_SQL = """ledger AS (
  SELECT o_orderstatus AS source_name, strftime(o_orderdate, '%Y-%m') AS partition_key,
    'file-' || strftime(o_orderdate, '%Y-%m') AS source_url,
    CASE WHEN m <= 5 THEN 'succeeded' WHEN m <= 9 THEN 'pending' WHEN m <= 11 THEN 'running' ELSE 'failed' END AS status,
    CASE WHEN m <= 5 OR m > 9 THEN TIMESTAMP '2002-02-01' + to_hours(CAST(m AS BIGINT)) END AS started_at,
    CASE WHEN m <= 5 OR m > 11 THEN TIMESTAMP '2002-02-02' END AS ended_at,
    CASE WHEN m <= 5 THEN count(*) END AS bronze_rows_written,
    CASE WHEN m > 11 THEN 'unreadable' END AS error_message,
    CASE WHEN m <= 2 THEN 'succeeded' WHEN m <= 4 THEN 'pending' WHEN m <= 5 THEN 'running' END AS silver_status,
    CASE WHEN m <= 2 OR m = 5 THEN TIMESTAMP '2002-02-03' END AS silver_started_at,
    CASE WHEN m <= 2 THEN TIMESTAMP '2002-02-04' END AS silver_ended_at,
    CASE WHEN m <= 2 THEN count(*) - 1 END AS silver_rows_written,
    CAST(NULL AS VARCHAR) AS silver_error_message, TIMESTAMP '2002-01-31' AS created_at
  FROM (SELECT *, month(o_orderdate) AS m FROM orders) GROUP BY 1, 2, 3, m)"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per order status and month, its state given by the month."""
    key = F.date_format("o_orderdate", "yyyy-MM").alias("partition_key")
    months = (
        b.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("source_name"), key, F.month("o_orderdate").alias("m"))
        .agg(F.count("*").alias("n"))
    )
    stamp = "TIMESTAMP_NTZ '2002-02-0{}'"
    return months.selectExpr(
        "source_name",
        "partition_key",
        "concat('file-', partition_key) AS source_url",
        "CASE WHEN m <= 5 THEN 'succeeded' WHEN m <= 9 THEN 'pending' WHEN m <= 11 THEN 'running' ELSE 'failed' END AS status",
        f"CASE WHEN m <= 5 OR m > 9 THEN {stamp.format(1)} + make_dt_interval(0, m) END AS started_at",
        f"CASE WHEN m <= 5 OR m > 11 THEN {stamp.format(2)} END AS ended_at",
        "CASE WHEN m <= 5 THEN n END AS bronze_rows_written",
        "CASE WHEN m > 11 THEN 'unreadable' END AS error_message",
        "CASE WHEN m <= 2 THEN 'succeeded' WHEN m <= 4 THEN 'pending' WHEN m <= 5 THEN 'running' END AS silver_status",
        f"CASE WHEN m <= 2 OR m = 5 THEN {stamp.format(3)} END AS silver_started_at",
        f"CASE WHEN m <= 2 THEN {stamp.format(4)} END AS silver_ended_at",
        "CASE WHEN m <= 2 THEN n - 1 END AS silver_rows_written",
        "CAST(NULL AS STRING) AS silver_error_message",
        "TIMESTAMP_NTZ '2002-01-31' AS created_at",
    )


@query(
    "agg_backfill_progress",
    "SELECT source_name, status, count(*) AS partitions FROM ledger GROUP BY 1, 2",
    LEDGER_SQL,
)
def agg_backfill_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.backfill_progress(ledger(spark, sf_dir))
