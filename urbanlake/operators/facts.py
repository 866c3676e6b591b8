"""Silver tables and the gold facts built from them.

Fixed values: the names and order of the tables' columns, and what the aggregates of the facts are called.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from urbanlake.functions.dates import date_key, minutes_between, parse_ts
from urbanlake.functions.scalars import money_decimal, rate_decimal
from urbanlake.operators import clean
from urbanlake.operators.joins import lookup, role_lookup
from urbanlake.operators.merge import dedupe_latest


def derive_trips(df: DataFrame, source: str, load_ts: datetime | Column | None = None) -> DataFrame:
    """Duration, calendar and audit columns of a normalised trip."""
    pickup, dropoff = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    stamp = F.current_timestamp() if load_ts is None else load_ts if isinstance(load_ts, Column) else F.lit(load_ts)
    return df.select(
        "*",
        minutes_between(pickup, dropoff).alias("trip_duration_min"),
        F.to_date(pickup).alias("trip_date"),
        F.hour(pickup).alias("hour_of_day"),
        F.dayofweek(pickup).alias("day_of_week"),
        stamp.alias("loaded_at"),
        F.lit(source).alias("source_system"),
    )


def silver_trips(raw: DataFrame, source: str, load_ts: datetime | Column | None = None) -> DataFrame:
    """Raw trip rows to clean trips: normalise, filter, derive."""
    trips = clean.normalize_schema(raw, clean.TRIP_TYPES)
    return derive_trips(clean.apply_rules(trips, clean.trip_rules()), source, load_ts)


def silver_daily(raw: DataFrame, null_coverage: str = "drop") -> DataFrame:
    good = clean.apply_rules(raw, clean.daily_rules(null_coverage))
    ties = ["coverage_pct", "value", "location_id"]
    return dedupe_latest(good, ["sensor_id", "date_utc", "parameter"], ["loaded_at"], ties).select(
        "sensor_id",
        "location_id",
        "parameter",
        "units",
        F.col("date_utc").alias("measurement_date"),
        "value",
        "min_val",
        "max_val",
        "median_val",
        "coverage_pct",
        F.year("date_utc").alias("year"),
        F.month("date_utc").alias("month"),
        "loaded_at",
    )


def silver_hourly(raw: DataFrame) -> DataFrame:
    good = clean.apply_rules(raw, clean.hourly_rules())
    keys = ["sensor_id", "date_utc", "hour_utc", "parameter"]
    return dedupe_latest(good, keys, ["loaded_at"], ["reading_count", "value", "location_id"]).select(
        "sensor_id",
        "location_id",
        "parameter",
        "units",
        F.col("date_utc").alias("measurement_date"),
        "hour_utc",
        "value",
        "reading_count",
        F.year("date_utc").alias("year"),
        F.month("date_utc").alias("month"),
        "loaded_at",
    )


def fx_rows(raw: DataFrame) -> DataFrame:
    """Rates as they landed, under their table's names."""
    return clean.project(
        raw,
        {
            "rate_date": F.to_date("TIME_PERIOD"),
            "from_currency": "CURRENCY",
            "to_currency": "CURRENCY_DENOM",
            "rate": "OBS_VALUE",
            "obs_status": "OBS_STATUS",
            "frequency": "FREQ",
            "loaded_at": "loaded_at",
        },
    )


def silver_fx(raw: DataFrame) -> DataFrame:
    """Observed rates, one per day and currency pair; see ``timeseries.fill_gaps`` for the gaps."""
    good = clean.apply_rules(fx_rows(raw), clean.fx_rules()).withColumn("rate", rate_decimal(F.col("rate")))
    return dedupe_latest(good, ["rate_date", "from_currency", "to_currency"], ["loaded_at"], ["rate"])


def gdp_rows(raw: DataFrame) -> DataFrame:
    """Yearly values as they landed, under their table's names."""
    return clean.project(
        raw,
        {
            "country_code": "countryiso3code",
            "country_name": "country_name",
            "indicator_id": "indicator_id",
            "indicator_name": "indicator_name",
            "year": "year",
            "gdp_usd": money_decimal(F.col("value")),
            "loaded_at": "loaded_at",
        },
    )


def silver_gdp(raw: DataFrame) -> DataFrame:
    good = clean.apply_rules(gdp_rows(raw), clean.gdp_rules())
    return dedupe_latest(good, ["country_code", "indicator_id", "year"], ["loaded_at"], ["gdp_usd"])


def rollup_readings(raw: DataFrame, grain: str = "hour") -> DataFrame:
    """Raw archive readings per sensor and ``hour`` or ``day`` (UTC)."""
    ts = clean.apply_rules(raw.withColumn("ts_utc", parse_ts("datetime")), clean.archive_rules())
    ts = ts.withColumn("date_utc", F.to_date("ts_utc"))
    keys = [F.col("sensors_id").alias("sensor_id"), "location_id", "parameter", "units", "date_utc"]
    readings = F.count("value").cast("int")
    if grain == "hour":
        return ts.groupBy(*keys, F.hour("ts_utc").alias("hour_utc")).agg(
            F.avg("value").alias("value"), readings.alias("reading_count")
        )
    if grain != "day":
        raise ValueError(f"unknown grain: {grain}")
    return ts.groupBy(*keys).agg(
        F.avg("value").alias("value"),
        F.min("value").alias("min_val"),
        F.max("value").alias("max_val"),
        F.percentile_approx("value", 0.5).cast("double").alias("median_val"),
        F.lit(None).cast("double").alias("coverage_pct"),
        readings.alias("expected_count"),
    )


def taxi_fact(trips: DataFrame, grain: str = "day", newest: str | None = None) -> DataFrame:
    """Trip totals per date, pickup zone and payment (and hour).

    Passengers are a bigint, so that a very large group cannot overflow.
    ``newest`` names a column whose maximum is added to each group.
    """
    if grain not in ("day", "hour"):
        raise ValueError(f"unknown grain: {grain}")
    keys = [
        date_key("trip_date").alias("date_key"),
        F.col("pulocationid").alias("pickup_zone_id"),
        F.col("payment_type").alias("payment_id"),
    ]
    if grain == "hour":
        keys.append(F.col("hour_of_day").alias("hour"))
    return trips.groupBy(*keys).agg(
        F.count("*").alias("trip_count"),
        F.sum("fare_amount").alias("total_fare_usd"),
        F.sum("total_amount").alias("total_revenue_usd"),
        F.sum("trip_distance").alias("total_distance_miles"),
        F.avg("trip_duration_min").alias("avg_trip_duration_min"),
        F.sum("passenger_count").cast("bigint").alias("total_passengers"),
        *([F.max(newest).alias(newest)] if newest else []),
    )


def zoned_readings(measurements: DataFrame, zones: DataFrame) -> DataFrame:
    """Pollutant readings of sensors that lie in a zone, parameter in lower case."""
    placed = lookup(measurements, zones, {"sensor_id": "sensor_id"}, {"zone_id": "zone_id"}, required=True)
    return clean.filter_in_set(placed, "parameter", clean.POLLUTANTS).withColumn("parameter", F.lower("parameter"))


def air_fact_of(
    readings: DataFrame, params: DataFrame, grain: str = "day", named: bool = False, newest: str | None = None
) -> DataFrame:
    """Average reading per zone, date and parameter (and hour); ``sensor_count`` counts rows.

    ``named`` keeps the parameter's name, which tells rows apart that have no id.
    ``newest`` names a column whose maximum is added to each group.
    """
    if grain not in ("day", "hour"):
        raise ValueError(f"unknown grain: {grain}")
    keys = ["zone_id", date_key("measurement_date").alias("date_key"), "parameter"]
    if grain == "hour":
        keys.append(F.col("hour_utc").alias("hour"))
    stamp = [F.max(newest).alias(newest)] if newest else []
    fact = readings.groupBy(*keys).agg(F.avg("value").alias("avg_value"), F.count("*").alias("sensor_count"), *stamp)
    return lookup(fact, params, {"parameter": "p_name"}, {"p_id": "p_id"}).drop(*([] if named else ["parameter"]))


def air_fact(measurements: DataFrame, zones: DataFrame, params: DataFrame, grain: str = "day") -> DataFrame:
    return air_fact_of(zoned_readings(measurements, zones), params, grain)


def fx_fact(fx: DataFrame, currency: DataFrame, named: bool = False) -> DataFrame:
    """Rates with the ids of both currencies; ``named`` keeps their names, which tell rows apart that have no id."""
    roles = {"from_currency": "id_cur_from", "to_currency": "id_cur_to"}
    keyed = fx.withColumn("date_key", date_key("rate_date"))
    return role_lookup(keyed, currency, "currency_name", "id", roles).select(
        "date_key", "id_cur_from", "id_cur_to", "rate", *(["from_currency", "to_currency"] if named else [])
    )


def gdp_fact(gdp: DataFrame) -> DataFrame:
    return gdp.select("year", "country_code", "gdp_usd")


def city_hourly(fact: DataFrame, low: int, high: int) -> DataFrame:
    """Trips and revenue of the whole city per hour, for ``low`` <= date_key < ``high``."""
    days = fact.filter((F.col("date_key") >= low) & (F.col("date_key") < high))
    return days.groupBy("date_key", "hour").agg(
        F.sum("trip_count").alias("trip_count"), F.sum("total_revenue_usd").alias("total_revenue_usd")
    )
