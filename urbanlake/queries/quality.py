"""Expectation checks over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.operators import quality
from urbanlake.queries import bindings as b
from urbanlake.queries.registry import query


def _check_sql(table: str, source: str, checks: list[tuple[str, str, str]]) -> str:
    """Rows (label, bad condition, evaluated condition) as one result set."""
    parts = []
    overall = " AND ".join(f"count(*) FILTER (WHERE ({seen}) AND ({bad})) = 0" for _, bad, seen in checks)
    for i, (label, bad, seen) in enumerate(checks):
        n, total = f"count(*) FILTER (WHERE ({seen}) AND ({bad}))", f"count(*) FILTER (WHERE {seen})"
        parts.append(
            f"SELECT '{table}' AS table_name, CAST({i + 1} AS INTEGER) AS check_no, '{label}' AS label, {n} = 0 AS success, "
            f"count(*) AS row_count, {n} AS unexpected_count, round({n} * 100.0 / nullif({total}, 0), 6) "
            f"AS unexpected_percent, {overall} AS overall_success FROM {source}"
        )
    return " UNION ALL ".join(parts)


def _result(df: DataFrame) -> DataFrame:
    return df.select(
        "table_name",
        "check_no",
        "label",
        "success",
        "row_count",
        "unexpected_count",
        F.round("unexpected_percent", 6).alias("unexpected_percent"),
        "overall_success",
    )


@query(
    "dq_between",
    _check_sql(
        "lineitem",
        "(SELECT l_quantity, l_discount, nullif(l_tax, 0) AS l_tax FROM lineitem)",
        [
            ("quantity 1 to 40", "l_quantity < 1 OR l_quantity > 40", "l_quantity IS NOT NULL"),
            ("tax > 0.02", "l_tax <= 0.02", "l_tax IS NOT NULL"),
            ("discount at most 0.1", "l_discount > 0.1", "l_discount IS NOT NULL"),
        ],
    ),
)
def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends, a strict minimum over a column with nulls, and an open start."""
    rows = b.table(spark, sf_dir, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    checks = [
        quality.between("quantity 1 to 40", "l_quantity", 1, 40),
        quality.between("tax > 0.02", "l_tax", 0.02, strict_min=True),
        quality.between("discount at most 0.1", "l_discount", high=0.1),
    ]
    return _result(quality.dq_run(rows, "lineitem", checks))


@query(
    "dq_not_null",
    _check_sql(
        "trips_raw",
        "trips_raw",
        [
            ("pulocationid not null", "pulocationid IS NULL", "true"),
            ("dolocationid not null", "dolocationid IS NULL", "true"),
        ],
    ),
    b.TRIPS_RAW,
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        quality.not_null("pulocationid not null", "pulocationid"),
        quality.not_null("dolocationid not null", "dolocationid"),
    ]
    return _result(quality.dq_run(b.trips_raw(spark, sf_dir), "trips_raw", checks))


@query(
    "dq_in_set",
    _check_sql(
        "orders",
        "(SELECT nullif(o_orderstatus, 'P') AS o_orderstatus, o_orderpriority FROM orders)",
        [
            ("status in set", "o_orderstatus NOT IN ('O')", "o_orderstatus IS NOT NULL"),
            (
                "priority in set",
                "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')",
                "o_orderpriority IS NOT NULL",
            ),
        ],
    ),
)
def dq_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    known = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    checks = [
        quality.in_set("status in set", "o_orderstatus", ["O"]),
        quality.in_set("priority in set", "o_orderpriority", known),
    ]
    return _result(quality.dq_run(rows, "orders", checks))


_KNOWN = "'pm25', 'no2', 'o3', 'co', 'pm10', 'pm1', 'so2', 'no', 'nox', 'temperature', 'relativehumidity', 'um003'"
_VALUE = ("value >= 0", "value < 0", "value IS NOT NULL")
_SENSOR = ("sensor_id not null", "sensor_id IS NULL", "true")
_IN_SET = ("parameter in known set", f"parameter NOT IN ({_KNOWN})", "parameter IS NOT NULL")

_RUN_SQL = " UNION ALL ".join(
    [
        _check_sql(
            "taxi_trips",
            "trips",
            [
                ("passenger_count between 1 and 6", "passenger_count < 1 OR passenger_count > 6", "passenger_count IS NOT NULL"),
                ("fare_amount >= 0", "fare_amount < 0", "fare_amount IS NOT NULL"),
                ("total_amount >= 0", "total_amount < 0", "total_amount IS NOT NULL"),
                ("trip_distance between 0.01 and 100", "trip_distance < 0.01 OR trip_distance > 100", "trip_distance IS NOT NULL"),
                ("pulocationid not null", "pulocationid IS NULL", "true"),
                ("dolocationid not null", "dolocationid IS NULL", "true"),
                (
                    "trip_duration_min between 1 and 720",
                    "trip_duration_min < 1 OR trip_duration_min > 720",
                    "trip_duration_min IS NOT NULL",
                ),
                ("payment_type in known set", "payment_type NOT IN (1, 2, 3, 4, 5, 6)", "payment_type IS NOT NULL"),
            ],
        ),
        _check_sql(
            "openaq_measurements",
            "daily",
            [
                _VALUE,
                ("coverage_pct >= 75", "coverage_pct < 75 OR coverage_pct > 100", "coverage_pct IS NOT NULL"),
                _SENSOR,
                ("measurement_date not null", "measurement_date IS NULL", "true"),
                _IN_SET,
            ],
        ),
        _check_sql(
            "openaq_measurements_hourly",
            "hourly",
            [_VALUE, ("hour_utc between 0 and 23", "hour_utc < 0 OR hour_utc > 23", "hour_utc IS NOT NULL"), _SENSOR, _IN_SET],
        ),
        _check_sql(
            "fx_daily",
            "fx",
            [
                ("rate > 0", "rate <= 0", "rate IS NOT NULL"),
                ("rate_date not null", "rate_date IS NULL", "true"),
                ("from_currency in set", "from_currency NOT IN ('USD')", "from_currency IS NOT NULL"),
                ("to_currency in set", "to_currency NOT IN ('EUR')", "to_currency IS NOT NULL"),
            ],
        ),
        _check_sql(
            "gdp_yearly",
            "gdp",
            [
                ("gdp_usd > 0", "gdp_usd <= 0", "gdp_usd IS NOT NULL"),
                ("year not null", "year IS NULL", "true"),
                ("country_code not null", "country_code IS NULL", "true"),
            ],
        ),
        _check_sql("openaq_sensor_zones", "sensor_zones", [_SENSOR]),
    ]
)
_RUN_CTES = (b.TRIPS_RAW, b.TRIPS, b.READINGS_RAW, b.DAILY, b.HOURLY, b.FX_RAW, b.FX, b.GDP_RAW, b.GDP, b.SENSOR_ZONES)


def _run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "taxi_trips": b.trips(spark, sf_dir),
        "openaq_measurements": b.daily(spark, sf_dir),
        "openaq_measurements_hourly": b.hourly(spark, sf_dir),
        "fx_daily": b.fx(spark, sf_dir),
        "gdp_yearly": b.gdp(spark, sf_dir),
        "openaq_sensor_zones": b.sensor_zones(spark, sf_dir),
    }
    return quality.dq_run_all(tables, quality.standard_checks())


@query("dq_run", _RUN_SQL, *_RUN_CTES)
def dq_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 standard checks of the six clean tables."""
    return _result(_run_all(spark, sf_dir))


@query(
    "dq_top_values",
    """SELECT table_name, label, value, count(*) AS times FROM (
      SELECT 'trips' AS table_name, 'passengers' AS label, CAST(passenger_count AS VARCHAR) AS value FROM trips_raw WHERE passenger_count NOT BETWEEN 2 AND 5
      UNION ALL SELECT 'trips', 'payment', CAST(payment_type AS VARCHAR) FROM trips_raw WHERE payment_type NOT IN (1)
      UNION ALL SELECT 'readings', 'parameter', parameter FROM readings_raw WHERE parameter NOT IN ('no2')
      UNION ALL SELECT 'readings', 'hour', CAST(hour_utc AS VARCHAR) FROM readings_raw WHERE hour_utc > 5)
    GROUP BY table_name, label, value QUALIFY row_number() OVER (PARTITION BY table_name, label ORDER BY times DESC, value) <= 5""",
    b.TRIPS_RAW,
    b.READINGS_RAW,
)
def dq_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most frequent values that break each check, from the aggregation that counts them."""
    tables = {"trips": b.trips_raw(spark, sf_dir), "readings": b.readings_raw(spark, sf_dir)}
    checks = {
        "trips": [quality.between("passengers", "passenger_count", 2, 5), quality.in_set("payment", "payment_type", [1])],
        "readings": [quality.in_set("parameter", "parameter", ["no2"]), quality.between("hour", "hour_utc", None, 5)],
    }
    return quality.dq_run_all(tables, checks, top=5).select("table_name", "label", F.inline("unexpected_values"))


@query(
    "dq_report",
    """SELECT table_name, CASE WHEN bool_and(success) THEN '✅ ' ELSE '⚠️ ' END || upper(table_name) || ' ('
      || count(*) FILTER (WHERE success) || '/' || count(*) || ' checks, ' || format('{:,}', max(row_count)) || ' rows)'
      || chr(10) || string_agg('  ' || CASE WHEN success THEN '✓' ELSE '✗' END || ' ' || label
        || CASE WHEN success THEN '' ELSE ' - ' || unexpected_count || printf(' bad (%.2f%%)', unexpected_percent) END,
        chr(10) ORDER BY check_no) AS block
    FROM results GROUP BY table_name
    UNION ALL
    SELECT 'footer', 'OVERALL: ' || count(*) FILTER (WHERE success) || '/' || count(*) || ' - '
      || CASE WHEN bool_and(success) THEN 'ALL PASSED' ELSE 'FAILURES DETECTED' END FROM results""",
    *_RUN_CTES,
    f"results AS ({_RUN_SQL})",
)
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block per table and the footer."""
    results = _run_all(spark, sf_dir)
    footer = quality.dq_footer(results).select(F.lit("footer").alias("table_name"), F.col("footer").alias("block"))
    return quality.dq_report(results).unionByName(footer)
