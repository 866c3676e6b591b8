"""Latest rows, filled series and top rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.operators import control, export, facts, timeseries
from urbanlake.operators.merge import dedupe_latest
from urbanlake.queries import bindings as b
from urbanlake.queries.aggregates import LEDGER_SQL, ledger
from urbanlake.queries.registry import query
from urbanlake.session import stage

PAIR = ["from_currency", "to_currency"]


@query(
    "dedupe_latest",
    """SELECT user_id, event_type, day, ts, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY ts DESC, event_id DESC) AS rn
      FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)) WHERE rn = 1""",
)
def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return dedupe_latest(rows, ["user_id", "event_type", "day"], ["ts"], ["event_id"]).select(
        "user_id", "event_type", "day", "ts", "event_id", "value"
    )


@query(
    "dedupe_latest_fx",
    """SELECT rate_date, from_currency, to_currency, CAST(rate AS DOUBLE) AS rate, obs_status, frequency, loaded_at
    FROM fx""",
    b.FX_RAW,
    b.FX,
)
def dedupe_latest_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.fx(spark, sf_dir).withColumn("rate", F.col("rate").cast("double"))


@query(
    "dedupe_latest_gdp",
    """SELECT country_code, country_name, indicator_id, indicator_name, year, CAST(gdp_usd AS DOUBLE) AS gdp_usd,
      loaded_at FROM gdp""",
    b.GDP_RAW,
    b.GDP,
)
def dedupe_latest_gdp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.gdp(spark, sf_dir).withColumn("gdp_usd", F.col("gdp_usd").cast("double"))


@query(
    "dedupe_latest_hourly",
    """SELECT sensor_id, location_id, parameter, units, measurement_date, hour_utc, value, reading_count, year, month,
      loaded_at FROM hourly""",
    b.READINGS_RAW,
    b.HOURLY,
)
def dedupe_latest_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.hourly(spark, sf_dir)


@query(
    "forward_fill",
    """SELECT rate_date, from_currency, to_currency, CAST(rate AS DOUBLE) AS rate FROM (
      SELECT rate_date, from_currency, to_currency, last_value(rate IGNORE NULLS) OVER (
        PARTITION BY from_currency, to_currency ORDER BY rate_date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rate
      FROM (SELECT from_currency, to_currency, CAST(day AS DATE) AS rate_date
          FROM (SELECT DISTINCT from_currency, to_currency FROM fx) CROSS JOIN
            (SELECT unnest(generate_series(min(rate_date), max(rate_date), INTERVAL 1 DAY)) AS day FROM fx))
        LEFT JOIN fx USING (rate_date, from_currency, to_currency)) WHERE rate IS NOT NULL""",
    b.FX_RAW,
    b.FX,
)
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine, observations and a fill split by month, over stored rates."""
    fx = stage(b.fx(spark, sf_dir), "fx")
    keys = ["rate_date", *PAIR]
    gaps = timeseries.join_spine(timeseries.date_spine(fx, "rate_date", PAIR), fx.select(*keys, "rate"), keys)
    filled = timeseries.forward_fill(gaps, PAIR, "rate_date", ["rate"], F.trunc("rate_date", "month"))
    return filled.filter("rate IS NOT NULL").select(*keys, F.col("rate").cast("double").alias("rate"))


@query(
    "fill_gaps",
    """SELECT rate_date, from_currency, to_currency, CAST(rate AS DOUBLE) AS rate, rate_date <> observed_on AS is_filled
    FROM fx_filled""",
    b.FX_RAW,
    b.FX,
    b.FX_FILLED,
)
def fill_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows without a spine, marking the days that were added."""
    filled = b.fx_filled(spark, sf_dir)
    return filled.select("rate_date", *PAIR, F.col("rate").cast("double").alias("rate"), "is_filled")


@query(
    "date_spine",
    """SELECT event_type, CAST(day AS DATE) AS day FROM (SELECT DISTINCT event_type FROM events) CROSS JOIN
      (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS day FROM events)""",
)
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return timeseries.date_spine(rows, "day", ["event_type"])


@query(
    "topn_report",
    """SELECT date_key, pickup_zone_id, payment_id, trip_count, CAST(round(CAST(total_revenue_usd AS DECIMAL(38,4)), 2) AS DOUBLE) AS total_revenue_usd
    FROM fct_taxi_daily WHERE date_key BETWEEN 19980501 AND 19980531
    ORDER BY date_key, pickup_zone_id, payment_id LIMIT 50""",
    *b.TAXI_CTES,
)
def topn_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = facts.taxi_fact(b.trips(spark, sf_dir)).filter("date_key BETWEEN 19980501 AND 19980531")
    return export.top_n(fact, ["date_key", "pickup_zone_id", "payment_id"], 50).select(
        "date_key", "pickup_zone_id", "payment_id", "trip_count", b.near("total_revenue_usd", 2).alias("total_revenue_usd")
    )


@query(
    "claim_top_n",
    """SELECT source_name, partition_key, source_url FROM ledger WHERE source_name = 'O' AND status = 'pending'
    ORDER BY partition_key LIMIT 7""",
    LEDGER_SQL,
)
def claim_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.pending(ledger(spark, sf_dir), "O", "bronze", 7)
