"""Projections, filters and rejected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.operators import clean
from urbanlake.operators.joins import semi_filter
from urbanlake.operators.merge import missing_keys
from urbanlake.queries import bindings as b
from urbanlake.queries.registry import query
from urbanlake.sources import files


@query(
    "normalize_schema",
    """SELECT vendorid, pulocationid, dolocationid, payment_type, passenger_count, trip_distance, fare_amount,
      CASE WHEN payment_type <> 3 THEN CAST(2.5 AS DOUBLE) END AS airport_fee FROM (
        SELECT * REPLACE (CAST(vendorid AS INTEGER) AS vendorid) FROM trips_raw)""",
    b.TRIPS_RAW,
)
def normalize_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed-case names and bigint ids; a text fee that is not a number becomes null."""
    raw = b.trips_raw(spark, sf_dir)
    raw = raw.withColumn("Airport_fee", F.when(F.col("payment_type") == 3, "n/a").otherwise("2.5"))
    return clean.normalize_schema(raw, clean.TRIP_TYPES).select(
        "vendorid",
        "pulocationid",
        "dolocationid",
        "payment_type",
        "passenger_count",
        "trip_distance",
        "fare_amount",
        "airport_fee",
    )


@query(
    "project_rename",
    """SELECT time_period AS rate_date, currency AS from_currency, currency_denom AS to_currency,
      obs_value AS rate, obs_status, freq AS frequency FROM fx_raw""",
    b.FX_RAW,
)
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {
        "rate_date": "TIME_PERIOD",
        "from_currency": "CURRENCY",
        "to_currency": "CURRENCY_DENOM",
        "rate": "OBS_VALUE",
        "obs_status": "OBS_STATUS",
        "frequency": "FREQ",
    }
    return clean.project(b.fx_raw(spark, sf_dir), names)


@query(
    "filter_taxi_quality",
    """SELECT tpep_pickup_datetime, tpep_dropoff_datetime, pulocationid, dolocationid, passenger_count, fare_amount,
      trip_distance, trip_duration_min, trip_date, hour_of_day, day_of_week FROM trips""",
    b.TRIPS_RAW,
    b.TRIPS,
)
def filter_taxi_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.trips(spark, sf_dir).select(
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "pulocationid",
        "dolocationid",
        "passenger_count",
        "fare_amount",
        "trip_distance",
        "trip_duration_min",
        "trip_date",
        "hour_of_day",
        "day_of_week",
    )


@query(
    "filter_daily_quality",
    """SELECT event_id, sensor_id, date_utc, value, coverage_pct FROM readings_raw
    WHERE value >= 0 AND coverage_pct >= 75""",
    b.READINGS_RAW,
)
def filter_daily_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = clean.apply_rules(b.readings_raw(spark, sf_dir), clean.daily_rules())
    return good.select("event_id", "sensor_id", "date_utc", "value", "coverage_pct")


@query(
    "filter_hourly_quality",
    "SELECT event_id, sensor_id, date_utc, hour_utc, value FROM readings_raw WHERE value >= 0",
    b.READINGS_RAW,
)
def filter_hourly_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = clean.apply_rules(b.readings_raw(spark, sf_dir), clean.hourly_rules())
    return good.select("event_id", "sensor_id", "date_utc", "hour_utc", "value")


@query(
    "filter_fx_quality",
    """SELECT time_period AS rate_date, currency AS from_currency, currency_denom AS to_currency,
      CAST(CAST(obs_value AS DECIMAL(18,6)) AS DOUBLE) AS rate FROM fx_raw
    WHERE obs_status = 'A' AND obs_value > 0""",
    b.FX_RAW,
)
def filter_fx_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = b.fx_raw(spark, sf_dir).selectExpr(
        "TIME_PERIOD AS rate_date",
        "CURRENCY AS from_currency",
        "CURRENCY_DENOM AS to_currency",
        "OBS_VALUE AS rate",
        "OBS_STATUS AS obs_status",
    )
    good = clean.apply_rules(rates, clean.fx_rules()).drop("obs_status")
    return good.withColumn("rate", F.col("rate").cast("decimal(18,6)").cast("double"))


@query(
    "filter_gdp_quality",
    """SELECT countryiso3code AS country_code, year, CAST(CAST(value AS DECIMAL(20,2)) AS DOUBLE) AS gdp_usd
    FROM gdp_raw WHERE CAST(value AS DECIMAL(20,2)) > 0""",
    b.GDP_RAW,
)
def filter_gdp_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = b.gdp_raw(spark, sf_dir).selectExpr(
        "countryiso3code AS country_code", "year", "CAST(value AS DECIMAL(20,2)) AS gdp_usd"
    )
    return clean.apply_rules(values, clean.gdp_rules()).withColumn("gdp_usd", F.col("gdp_usd").cast("double"))


@query(
    "filter_in_set",
    """SELECT event_id, parameter FROM readings_raw WHERE lower(parameter) IN ('pm25', 'no2', 'o3', 'co', 'pm10')""",
    b.READINGS_RAW,
)
def filter_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.filter_in_set(b.readings_raw(spark, sf_dir), "parameter", clean.POLLUTANTS).select("event_id", "parameter")


@query(
    "filter_sensor_semijoin",
    """SELECT event_id, sensor_id, value FROM readings_raw WHERE sensor_id IN (
      SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))""",
    b.READINGS_RAW,
)
def filter_sensor_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = clean.filter_in_set(b.table(spark, sf_dir, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"], ci=False)
    kept = semi_filter(b.readings_raw(spark, sf_dir), wanted, {"sensor_id": "c_custkey"})
    return kept.select("event_id", "sensor_id", "value")


@query(
    "filter_chunk_window",
    "SELECT event_id, date_utc FROM readings_raw WHERE date_utc BETWEEN DATE '1998-01-08' AND DATE '1998-01-14'",
    b.READINGS_RAW,
)
def filter_chunk_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunk = files.between_dates(
        b.readings_raw(spark, sf_dir), "date_utc", F.lit("1998-01-08").cast("date"), F.lit("1998-01-14").cast("date")
    )
    return chunk.select("event_id", "date_utc")


@query(
    "filter_incremental",
    """SELECT event_id, ts FROM events
    WHERE ts > TIMESTAMP '2024-01-10 12:00:00' AND ts <= TIMESTAMP '2024-01-20'""",
)
def filter_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events")
    return clean.incremental(events, "ts", "2024-01-10 12:00:00", "2024-01-20 00:00:00").select("event_id", "ts")


@query(
    "filter_active_interval",
    """SELECT c_custkey, first_day, last_day, last_day IS NOT NULL AS strict
    FROM (SELECT o_custkey AS c_custkey, min(CAST(o_orderdate AS DATE)) AS first_day,
        CASE WHEN count(*) > 8 THEN max(CAST(o_orderdate AS DATE)) END AS last_day
      FROM orders GROUP BY 1)
    WHERE (last_day >= DATE '1998-03-01' OR last_day IS NULL) AND first_day <= DATE '1998-03-31'""",
)
def filter_active_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers active in March 1998; ``strict`` marks those found with null ends excluded."""
    day = F.to_date("o_orderdate")
    span = (
        b.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min(day).alias("first_day"), F.when(F.count("*") > 8, F.max(day)).alias("last_day"))
    )
    low, high = F.lit("1998-03-01").cast("date"), F.lit("1998-03-31").cast("date")
    open_ended = clean.active_in(span, "first_day", "last_day", low, high, null_open=True)
    closed = clean.active_in(span, "first_day", "last_day", low, high, null_open=False)
    return open_ended.join(closed.select("c_custkey", F.lit(True).alias("strict")), "c_custkey", "left").withColumn(
        "strict", F.coalesce("strict", F.lit(False))
    )


@query(
    "quarantine_rejects",
    """SELECT reason, count(*) AS rejected_rows, round(sum(fare_amount), 2) AS fares FROM (
      SELECT fare_amount, unnest([
        CASE WHEN pulocationid IS NULL THEN 'no_pickup_zone' END,
        CASE WHEN dolocationid IS NULL THEN 'no_dropoff_zone' END,
        CASE WHEN tpep_pickup_datetime IS NULL THEN 'no_pickup_time' END,
        CASE WHEN tpep_dropoff_datetime IS NULL THEN 'no_dropoff_time' END,
        CASE WHEN (passenger_count BETWEEN 1 AND 6) IS NOT TRUE THEN 'passengers' END,
        CASE WHEN (fare_amount >= 0) IS NOT TRUE THEN 'fare' END,
        CASE WHEN (total_amount >= 0) IS NOT TRUE THEN 'total' END,
        CASE WHEN (trip_distance BETWEEN 0.01 AND 100) IS NOT TRUE THEN 'distance' END,
        CASE WHEN (tpep_dropoff_datetime > tpep_pickup_datetime) IS NOT TRUE THEN 'time_order' END,
        CASE WHEN (date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60.0 BETWEEN 1 AND 720)
          IS NOT TRUE THEN 'duration' END]) AS reason FROM trips_raw) WHERE reason IS NOT NULL GROUP BY reason""",
    b.TRIPS_RAW,
)
def quarantine_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected trips per reason; a trip may have several."""
    raw = clean.normalize_schema(b.trips_raw(spark, sf_dir), clean.TRIP_TYPES)
    _, rejected = clean.split_rejects(raw, clean.trip_rules())
    reasons = rejected.select("fare_amount", F.explode("reject_reasons").alias("reason"))
    return reasons.groupBy("reason").agg(
        F.count("*").alias("rejected_rows"), F.round(F.sum("fare_amount"), 2).alias("fares")
    )


@query(
    "silver_daily",
    """SELECT sensor_id, location_id, parameter, measurement_date, value, coverage_pct, year, month, loaded_at FROM daily""",
    b.READINGS_RAW,
    b.DAILY,
)
def silver_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.daily(spark, sf_dir).select(
        "sensor_id", "location_id", "parameter", "measurement_date", "value", "coverage_pct", "year", "month", "loaded_at"
    )


@query(
    "union_by_name_drift",
    """SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, count(*) AS row_count,
      count(CASE WHEN year(tpep_pickup_datetime) >= 1998 THEN fare_amount END) AS with_fare,
      round(sum(total_amount), 2) AS total_amount FROM trips_raw GROUP BY 1""",
    b.TRIPS_RAW,
)
def union_by_name_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files before 1998 lack the fare column and spell the total differently."""
    raw = b.trips_raw(spark, sf_dir)
    year = F.year("tpep_pickup_datetime")
    old = raw.filter(year < 1998).drop("fare_amount").withColumnRenamed("total_amount", "Total_Amount")
    frames = [clean.normalize_schema(df, clean.TRIP_TYPES) for df in (old, raw.filter(year >= 1998))]
    return clean.union_drift(frames).groupBy(year.alias("year")).agg(
        F.count("*").alias("row_count"),
        F.count("fare_amount").alias("with_fare"),
        F.round(F.sum("total_amount"), 2).alias("total_amount"),
    )


@query(
    "set_difference_partitions",
    """SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS partition_key FROM orders
    EXCEPT SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_totalprice > 499000""",
)
def set_difference_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months requested minus months that failed (those with a very large order)."""
    month = F.date_format("o_orderdate", "yyyy-MM").alias("partition_key")
    orders = b.table(spark, sf_dir, "orders")
    return missing_keys(orders.select(month), orders.filter("o_totalprice > 499000").select(month), ["partition_key"])


@query(
    "accepted_and_rejected",
    """SELECT (SELECT count(*) FROM trips) AS accepted, (SELECT count(*) FROM trips_raw) - (SELECT count(*) FROM trips)
      AS rejected""",
    b.TRIPS_RAW,
    b.TRIPS,
)
def accepted_and_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected rows add up to the input."""
    raw = clean.normalize_schema(b.trips_raw(spark, sf_dir), clean.TRIP_TYPES)
    tagged = clean.tag_rejects(raw, clean.trip_rules())
    return tagged.agg(
        F.count_if(F.size("reject_reasons") == 0).alias("accepted"),
        F.count_if(F.size("reject_reasons") > 0).alias("rejected"),
    )

