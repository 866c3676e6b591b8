"""Scalar functions over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.functions import dates, scalars
from urbanlake.queries import bindings as b
from urbanlake.queries.registry import query
from urbanlake.sources import files


@query(
    "date_key",
    """SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key, count(*) AS lines FROM lineitem GROUP BY 1""",
)
def date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = b.table(spark, sf_dir, "lineitem")
    return lines.groupBy(dates.date_key("l_shipdate").alias("date_key")).agg(F.count("*").alias("lines"))


_PARTS = """CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_key, CAST(year({d}) AS INTEGER) AS year,
  CAST(month({d}) AS INTEGER) AS month, CAST(day({d}) AS INTEGER) AS day,
  CAST(dayofweek({d}) + 1 AS INTEGER) AS day_of_week, dayname({d}) AS day_name, monthname({d}) AS month_name,
  CAST(quarter({d}) AS INTEGER) AS quarter, dayofweek({d}) IN (0, 6) AS is_weekend, strftime({d}, '%Y-%m') AS year_month"""


@query("date_parts", f"SELECT o_orderkey, {_PARTS.format(d='o_orderdate')} FROM orders")
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.date_parts(b.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop(
        "o_orderdate"
    )


@query(
    "date_dimension",
    f"""SELECT date, {_PARTS.format(d='date')}, coalesce(lines, 0) AS lines
    FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2002-12-31', INTERVAL 1 DAY)) AS DATE) AS date)
    LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS lines FROM lineitem GROUP BY 1) USING (date)""",
)
def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight years of days with the lines shipped on each."""
    lines = b.table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("date"))
    counts = lines.agg(F.count("*").alias("lines"))
    calendar = dates.date_dimension(spark, "1995-01-01", 2922)
    return calendar.join(counts, "date", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))


@query(
    "to_date_ts",
    """SELECT event_id, ts_utc, CAST(ts_utc AS DATE) AS date_utc, CAST(hour(ts_utc) AS INTEGER) AS hour_utc FROM (
      SELECT event_id, date_trunc('second', ts) - to_minutes(CAST(user_id % 24 * 60 AS BIGINT)) + INTERVAL 12 HOUR AS ts_utc
      FROM events WHERE event_type <> 'error')""",
)
def to_date_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with a different offset per user, from -12:00 to +11:00; errors carry malformed text and drop out."""
    offset = F.expr("format_string('%s%02d:00', CASE WHEN user_id % 24 < 12 THEN '-' ELSE '+' END, abs(user_id % 24 - 12))")
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), offset)
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), stamp)).otherwise(stamp)
    parsed = b.table(spark, sf_dir, "events").select("event_id", dates.parse_ts(text).alias("ts_utc"))
    return parsed.filter("ts_utc IS NOT NULL").select(
        "event_id", "ts_utc", F.to_date("ts_utc").alias("date_utc"), F.hour("ts_utc").alias("hour_utc")
    )


@query(
    "trip_duration_min",
    "SELECT tpep_pickup_datetime, vendorid, dolocationid, fare_amount, trip_duration_min FROM trips",
    b.TRIPS_RAW,
    b.TRIPS,
)
def trip_duration_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.trips(spark, sf_dir).select(
        "tpep_pickup_datetime", F.col("vendorid").cast("bigint").alias("vendorid"), "dolocationid", "fare_amount", "trip_duration_min"
    )


@query(
    "string_funcs",
    """SELECT p_partkey, lower(p_type) AS type, CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) AS brand_no,
      split_part(p_name, ' ', 2) AS noun,
      'data/' || strftime(DATE '2020-01-01' + to_months(CAST(p_size AS INTEGER)), '%Y/%m/%Y-%m') AS url
    FROM part""",
)
def string_funcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.add_months(F.lit("2020-01-01").cast("date"), F.col("p_size"))
    return b.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.lower("p_type").alias("type"),
        F.regexp_extract("p_brand", r"#(\d+)", 1).try_cast("int").alias("brand_no"),
        F.split("p_name", " ")[1].alias("noun"),
        dates.fill_template("data/{yyyy}/{mm}/{yyyy-mm}", month).alias("url"),
    )


@query(
    "decimal_cast",
    """SELECT o_orderkey, CAST(CAST(o_totalprice / 10000 AS DECIMAL(18,6)) AS VARCHAR) AS rate,
      CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS VARCHAR) AS amount FROM orders""",
)
def decimal_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        scalars.rate_decimal(F.col("o_totalprice") / 10000).cast("string").alias("rate"),
        scalars.money_decimal(F.col("o_totalprice")).cast("string").alias("amount"),
    )


@query(
    "null_default",
    """SELECT event_id, coalesce(x, 0) AS x_or_zero, CASE WHEN k IS NULL OR k = 0 THEN value ELSE k END AS k_or_value
    FROM (SELECT event_id, value, CASE WHEN value >= 50 THEN value END AS x,
      CASE WHEN event_type <> 'error' THEN CAST(props->>'$.k' AS DOUBLE) END AS k FROM events)""",
)
def null_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.when(F.col("event_type") != "error", F.get_json_object("props", "$.k").cast("double"))
    return b.table(spark, sf_dir, "events").select(
        "event_id",
        scalars.or_zero(F.when(F.col("value") >= 50, F.col("value"))).alias("x_or_zero"),
        scalars.falsy_default(k, F.col("value")).alias("k_or_value"),
    )


@query(
    "weather_condition",
    """SELECT event_id, CASE WHEN code IS NULL THEN 'unknown' WHEN code = 0 THEN 'clear'
      WHEN code BETWEEN 1 AND 3 THEN 'partly_cloudy' WHEN code BETWEEN 40 AND 49 THEN 'fog'
      WHEN code BETWEEN 50 AND 67 THEN 'rain' WHEN code BETWEEN 70 AND 77 THEN 'snow'
      WHEN code BETWEEN 80 AND 82 THEN 'showers' WHEN code BETWEEN 95 AND 99 THEN 'thunderstorm'
      ELSE 'other' END AS condition
    FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(props->>'$.k' AS INTEGER) END AS code FROM events)""",
)
def weather_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("event_type") != "error", F.get_json_object("props", "$.k").cast("int"))
    return b.table(spark, sf_dir, "events").select("event_id", scalars.weather_condition(code).alias("condition"))


@query(
    "rain_flag",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(nullif(l_discount, 0.05), 0) > 0.1 AS discounted,
      coalesce(l_tax * 2, 0) > 0.1 AS taxed FROM lineitem""",
)
def rain_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flag on two rates: null and exactly 0.1 are not rain."""
    return b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        scalars.rain_flag(F.nullif("l_discount", F.lit(0.05))).alias("discounted"),
        scalars.rain_flag(F.col("l_tax") * 2).alias("taxed"),
    )


@query(
    "time_remap",
    """SELECT event_id, ts + (TIMESTAMP '2025-06-01 10:00:00' - INTERVAL 14 DAY - INTERVAL 7 DAY
      - TIMESTAMP '2024-01-15') AS dest_ts FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-22'""",
)
def time_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third weekly chunk moved to before now."""
    rows = b.table(spark, sf_dir, "events").filter("ts >= '2024-01-15' AND ts < '2024-01-22'")
    dest = dates.remap("ts", (datetime(2024, 1, 15), datetime(2024, 1, 22)), datetime(2024, 1, 1), datetime(2025, 6, 1, 10, 25))
    return rows.select("event_id", dest.alias("dest_ts"))


@query(
    "month_sequence",
    """SELECT c_custkey, strftime(month, '%Y-%m') AS partition_key,
      'files/' || strftime(month, '%Y') || '/trips_' || strftime(month, '%Y-%m') || '.parquet' AS source_url
    FROM (SELECT o_custkey AS c_custkey, unnest(generate_series(date_trunc('month', min(o_orderdate)),
      date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS month FROM orders GROUP BY 1)""",
)
def month_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months from the first to the last order of each customer, with an address."""
    day = F.to_date("o_orderdate")
    spans = b.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    spans = spans.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    template = "files/{yyyy}/trips_{yyyy-mm}.parquet"
    return dates.month_rows(spans, "first_day", "last_day", template).select("c_custkey", "partition_key", "source_url")


@query(
    "month_bounds",
    """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day,
      last_day(o_orderdate) AS last_day FROM orders""",
)
def month_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = dates.month_bounds(F.date_format("o_orderdate", "yyyy-MM"))
    return b.table(spark, sf_dir, "orders").select("o_orderkey", first.alias("first_day"), last.alias("last_day"))


@query(
    "audit_columns",
    """SELECT s_suppkey, TIMESTAMP '2025-03-04 05:06:07' AS loaded_at, DATE '2025-03-04' AS load_date,
      'supplier_api' AS source_system FROM supplier""",
)
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = files.with_audit(b.table(spark, sf_dir, "supplier"), "supplier_api", datetime(2025, 3, 4, 5, 6, 7))
    return rows.select("s_suppkey", F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"), "load_date", "source_system")


@query(
    "json_envelope",
    """SELECT o_orderstatus, '{"status":"' || CASE WHEN count(*) FILTER (WHERE o_totalprice > 499000) = 0 THEN 'succeeded'
      ELSE 'partial_failure' END || '","succeeded_count":' || count(*) FILTER (WHERE o_totalprice <= 499000)
      || ',"failed_count":' || count(*) FILTER (WHERE o_totalprice > 499000) || ',"total_rows":' || count(*) || '}' AS payload
    FROM orders GROUP BY 1""",
)
def json_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run summary per order status; very large orders count as failed."""
    failed = F.count_if(F.col("o_totalprice") > 499000)
    body = F.struct(
        F.when(failed == 0, "succeeded").otherwise("partial_failure").alias("status"),
        F.count_if(F.col("o_totalprice") <= 499000).alias("succeeded_count"),
        failed.alias("failed_count"),
        F.count("*").alias("total_rows"),
    )
    return b.table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.to_json(body).alias("payload"))


@query(
    "chunk_advance",
    """SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events
    WHERE ts >= TIMESTAMP '2024-01-22' AND ts < TIMESTAMP '2024-01-25' GROUP BY 1""",
)
def chunk_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slice after a watermark, cut short by the end of the source."""
    low, high = dates.next_chunk(datetime(2024, 1, 22), datetime(2024, 1, 1), datetime(2024, 1, 25))
    rows = b.table(spark, sf_dir, "events").filter(f"ts >= '{low}' AND ts < '{high}'")
    return rows.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("events"))
