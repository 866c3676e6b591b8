"""Write modes: each query writes to the shared folder and reads the table back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.operators import dims, export, facts
from urbanlake.operators.joins import weather_join
from urbanlake.operators.merge import dedupe_latest, upsert
from urbanlake.queries import bindings as b
from urbanlake.queries.landing import WEATHER_SQL, weather
from urbanlake.queries.registry import query
from urbanlake.session import scratch_path
from urbanlake.sources import tables

HALF = "2024-01-16"


@query(
    "write_append_partitioned",
    """SELECT sensor_id, date_utc, CAST(round(CAST(value AS DECIMAL(38,4)), 2) AS DOUBLE) AS value, CAST(loaded_at AS DATE) AS load_date,
      CASE WHEN loaded_at >= TIMESTAMP '2024-01-16' THEN coverage_pct END AS coverage_pct FROM readings_raw""",
    b.READINGS_RAW,
)
def write_append_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; the second brings a new column."""
    rows = b.readings_raw(spark, sf_dir).select(
        "sensor_id", "date_utc", b.near("value", 2).alias("value"), F.to_date("loaded_at").alias("load_date"), "coverage_pct"
    )
    path = scratch_path(spark, "append")
    tables.append(rows.filter(F.col("load_date") < HALF).drop("coverage_pct"), path, ["load_date"])
    tables.append(rows.filter(F.col("load_date") >= HALF), path, ["load_date"])
    return tables.read(spark, path, merge_schema=True)


@query(
    "write_dynamic_overwrite",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, o_orderkey,
      CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def write_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 1997 months are rewritten, the others stay."""
    rows = b.table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_orderkey", "o_totalprice"
    )
    path = scratch_path(spark, "dynamic")
    tables.overwrite_partitions(rows, path, ["year", "month"])
    again = rows.filter("year = 1997").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    tables.overwrite_partitions(again, path, ["year", "month"])
    return tables.read(spark, path)


@query("write_stage_overwrite", "SELECT s_suppkey AS sensor_id, s_name AS name, s_acctbal AS balance FROM supplier")
def write_stage_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage table replaced by one of another schema."""
    rows, path = b.table(spark, sf_dir, "supplier"), scratch_path(spark, "stage-overwrite")
    tables.replace(rows.select("s_suppkey", "s_nationkey"), path)
    tables.replace(rows.selectExpr("s_suppkey AS sensor_id", "s_name AS name", "s_acctbal AS balance"), path)
    return tables.read(spark, path)


_READING_KEYS = ["sensor_id", "date_utc", "parameter"]

_UPSERT_SQL = """SELECT sensor_id, date_utc, parameter, event_id, CAST(round(CAST(value AS DECIMAL(38,4)), 2) AS DOUBLE) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY sensor_id, date_utc, parameter ORDER BY event_id DESC) AS rn
  FROM readings_raw) WHERE rn = 1"""


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Morning readings as the table, afternoon readings as the batch; each unique per key."""
    rows = b.readings_raw(spark, sf_dir).select(*_READING_KEYS, "event_id", b.near("value", 2).alias("value"), "hour_utc")
    old = dedupe_latest(rows.filter("hour_utc < 12"), _READING_KEYS, ["event_id"]).drop("hour_utc")
    new = dedupe_latest(rows.filter("hour_utc >= 12"), _READING_KEYS, ["event_id"]).drop("hour_utc")
    return old, new


@query("merge_upsert", _UPSERT_SQL, b.READINGS_RAW)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _split(spark, sf_dir)
    return upsert(old, new, _READING_KEYS)


@query("keyed_upsert_gold", _UPSERT_SQL, b.READINGS_RAW)
def keyed_upsert_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a stored table, touching only the partitions of the batch."""
    old, new = _split(spark, sf_dir)
    path = scratch_path(spark, "upsert")
    day = F.col("date_utc")
    for batch in (old, new):
        tables.upsert_table(batch.withColumn("day", day), path, _READING_KEYS, ["day"])
    return tables.read(spark, path).drop("day")


@query("bucketed_upsert", _UPSERT_SQL, b.READINGS_RAW)
def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a table bucketed by its key, whose rows are not shuffled."""
    old, new = _split(spark, sf_dir)
    path = scratch_path(spark, "bucketed")
    name = f"readings_{path[-32:]}"
    for batch in (old, new):
        month = F.date_format("date_utc", "yyyyMM").cast("int")
        tables.upsert_bucketed(batch.withColumn("month_key", month), name, _READING_KEYS, 8, ["month_key"], path)
    return tables.read(spark, name).drop("month_key")


@query(
    "dim_overwrite",
    """SELECT CAST(n_nationkey AS INTEGER) AS zone_id, n_name AS zone_name, r_name AS borough, customers
    FROM nation JOIN region ON n_regionkey = r_regionkey
    JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) ON c_nationkey = n_nationkey""",
)
def dim_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone dimension, written twice, with the customers of each zone."""
    zones, path = b.zones(spark, sf_dir), scratch_path(spark, "dim-zone")
    tables.replace(zones, path)
    tables.replace(zones, path)
    customers = b.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("zone_id"))
    return tables.read(spark, path).join(customers.agg(F.count("*").alias("customers")), "zone_id")


@query(
    "export_report_json",
    """SELECT '{"generated_at_utc":"2025-01-01T00:00:00","source":"fct_taxi_daily","period_description":"May 1998",'
      || '"row_count":' || count(*) || ',"rows":['
      || string_agg('{"date_key":' || date_key || ',"pickup_zone_id":' || pickup_zone_id || ',"trip_count":' || trip_count
        || ',"total_revenue_usd":' || revenue || '}', ',' ORDER BY date_key, pickup_zone_id, payment_id)
      || ']}' AS document
    FROM (SELECT *, CAST(CAST(round(CAST(total_revenue_usd AS DECIMAL(38,4)), 2) AS DOUBLE) AS DECIMAL(20,2)) AS revenue FROM fct_taxi_daily
      WHERE date_key BETWEEN 19980501 AND 19980531
      ORDER BY date_key, pickup_zone_id, payment_id LIMIT 50)""",
    *b.TAXI_CTES,
)
def export_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = facts.taxi_fact(b.trips(spark, sf_dir))
    fact = fact.withColumn("total_revenue_usd", b.near("total_revenue_usd", 2).cast("decimal(20,2)"))
    return export.report_document(
        fact, 19980501, 19980531, "May 1998", datetime(2025, 1, 1), "fct_taxi_daily"
    )


EXPORT_SQL = """export_rows AS (
  SELECT 'run-1' AS run_id, src_ts_utc AS source_ts_utc,
    src_ts_utc + (TIMESTAMP '2025-06-01 10:00:00' - INTERVAL 7 DAY - INTERVAL 7 DAY - TIMESTAMP '1998-01-08')
      AS dest_ts_utc,
    w.date_key, w.hour, temp_c, feels_like_c, precipitation_mm, wind_speed_kmh, humidity, is_rainy, condition,
    weather_code, CAST(coalesce(t.trip_count, 0) AS BIGINT) AS trip_count, coalesce(t.revenue, 0) AS revenue_usd
  FROM weather w LEFT JOIN (SELECT date_key, hour, sum(trip_count) AS trip_count,
      CAST(round(CAST(sum(total_revenue_usd) AS DECIMAL(38,4)), 2) AS DOUBLE) AS revenue FROM fct_taxi_hourly GROUP BY 1, 2) t USING (date_key, hour))"""


def exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = facts.taxi_fact(b.trips(spark, sf_dir), "hour")
    city = facts.city_hourly(fact, 19980101, 19980129)
    city = city.withColumn("total_revenue_usd", b.near("total_revenue_usd", 2))
    joined = weather_join(weather(spark, sf_dir), city)
    now = datetime(2025, 6, 1, 10, 25)
    return export.export_rows(joined, "run-1", (datetime(1998, 1, 8), datetime(1998, 1, 15)), datetime(1998, 1, 1), now)


@query(
    "export_timeseries_records",
    """SELECT 'nyc_hourly' AS measurement, 'nyc' AS tag_location, condition AS tag_condition, temp_c, feels_like_c,
      precipitation_mm, wind_speed_kmh, humidity, CAST(is_rainy AS INTEGER) AS is_rainy, trip_count, revenue_usd,
      dest_ts_utc AS time FROM export_rows""",
    b.READINGS_RAW,
    *b.TAXI_HOUR_CTES,
    WEATHER_SQL,
    EXPORT_SQL,
)
def export_timeseries_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = export.timeseries_records(exported(spark, sf_dir))
    return records.select(
        "measurement",
        F.col("tags")["location"].alias("tag_location"),
        F.col("tags")["condition"].alias("tag_condition"),
        "fields.*",
        "time",
    )
