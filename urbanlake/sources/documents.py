"""API payloads (one JSON document per row of ``payload``) flattened to rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from urbanlake.functions.dates import date_key, parse_ts
from urbanlake.functions.scalars import falsy_default, rain_flag, weather_condition

# Shapes of the payloads.
LOCATIONS = """struct<results: array<struct<
    id: bigint, name: string, locality: string, timezone: string,
    country: struct<code: string>, coordinates: struct<latitude: double, longitude: double>,
    sensors: array<struct<id: bigint, parameter: struct<name: string, units: string, displayName: string>>>,
    datetimeFirst: struct<utc: string>, datetimeLast: struct<utc: string>, provider: struct<name: string>>>>"""
SENSOR_DAYS = """struct<results: array<struct<
    value: double, period: struct<datetimeFrom: struct<utc: string>>,
    summary: struct<min: double, max: double, median: double>,
    coverage: struct<percentComplete: double, expectedCount: int>>>>"""
INDICATOR_FIELDS = {
    "indicator_id": ("indicator.id", "string"),
    "indicator_name": ("indicator.value", "string"),
    "country_id": ("country.id", "string"),
    "country_name": ("country.value", "string"),
    "countryiso3code": ("countryiso3code", "string"),
}
WEATHER = """struct<hourly: struct<
    time: array<string>, temperature_2m: array<double>, apparent_temperature: array<double>,
    precipitation: array<double>, wind_speed_10m: array<double>, relative_humidity_2m: array<double>,
    weather_code: array<int>>>"""


def flatten_locations(pages: DataFrame, load_ts: datetime | Column) -> DataFrame:
    """One row per location and sensor; a location without sensors keeps one row."""
    stamp = load_ts if isinstance(load_ts, Column) else F.lit(load_ts)
    place = (
        pages.select(F.explode(F.from_json("payload", LOCATIONS)["results"]).alias("loc"), stamp.alias("loaded_at"))
        .select("loaded_at", "loc.*")
        .withColumn("sensor", F.explode_outer("sensors"))
    )
    return place.select(
        F.col("id").alias("location_id"),
        "name",
        "locality",
        "timezone",
        F.col("country.code").alias("code"),
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
        F.col("sensor.id").alias("sensor_id"),
        F.col("sensor.parameter.name").alias("p_name"),
        F.col("sensor.parameter.units").alias("p_units"),
        F.col("sensor.parameter.displayName").alias("p_display_name"),
        parse_ts("datetimeFirst.utc").alias("first_datetime_utc"),
        parse_ts("datetimeLast.utc").alias("last_datetime_utc"),
        F.col("provider.name").alias("provider_name"),
        "loaded_at",
    )


def flatten_sensor_days(pages: DataFrame) -> DataFrame:
    """Daily readings; the job columns of each page are carried to its rows."""
    job = ["sensor_id", "location_id", "parameter", "units"]
    day = pages.select(*job, F.explode(F.from_json("payload", SENSOR_DAYS)["results"]).alias("r"))
    return day.select(
        *job,
        F.substring("r.period.datetimeFrom.utc", 1, 10).try_cast("date").alias("date_utc"),
        F.col("r.value").alias("value"),
        F.col("r.summary.min").alias("min_val"),
        F.col("r.summary.max").alias("max_val"),
        F.col("r.summary.median").alias("median_val"),
        F.col("r.coverage.percentComplete").alias("coverage_pct"),
        F.col("r.coverage.expectedCount").alias("expected_count"),
    )


def flatten_indicators(pages: DataFrame, load_ts: datetime | Column) -> DataFrame:
    """Rows of the second element of ``[meta, rows]``; the two have no common type, so the payload is parsed as a variant, once."""
    stamp = load_ts if isinstance(load_ts, Column) else F.lit(load_ts)
    rows = F.try_variant_get(F.try_parse_json("payload"), "$[1]", "array<variant>")
    found = pages.select(F.explode(rows).alias("r"), stamp.alias("loaded_at"))

    def field(path: str, kind: str = "string") -> Column:
        return F.try_variant_get("r", f"$.{path}", kind)

    return found.select(
        *(field(path, kind).alias(name) for name, (path, kind) in INDICATOR_FIELDS.items()),
        field("date").try_cast("bigint").alias("year"),
        field("value").try_cast("decimal(38,6)").cast("decimal(38,0)").try_cast("bigint").alias("value"),
        field("unit").alias("unit"),
        field("obs_status").alias("obs_status"),
        field("decimal", "bigint").alias("decimal"),
        "loaded_at",
    )


def flatten_weather(pages: DataFrame, low: datetime, high: datetime) -> DataFrame:
    """Hourly rows in [low, high) with a temperature, plus derived condition and rain."""
    hourly = F.from_json("payload", WEATHER)["hourly"]
    names = [
        "time",
        "temperature_2m",
        "apparent_temperature",
        "precipitation",
        "wind_speed_10m",
        "relative_humidity_2m",
        "weather_code",
    ]
    h = (
        pages.select(hourly.alias("h"))
        .select(F.explode(F.arrays_zip(*[F.col(f"h.{n}").alias(n) for n in names])).alias("h"))
        .select("h.*")
        .withColumn("src_ts_utc", F.col("time").try_cast("timestamp_ntz"))
        .filter(F.col("src_ts_utc") >= F.lit(low).cast("timestamp_ntz"))
        .filter(F.col("src_ts_utc") < F.lit(high).cast("timestamp_ntz"))
        .filter(F.col("temperature_2m").isNotNull())
    )
    zero = F.lit(0.0)
    return h.select(
        "src_ts_utc",
        date_key("src_ts_utc").alias("date_key"),
        F.hour("src_ts_utc").alias("hour"),
        F.col("temperature_2m").alias("temp_c"),
        falsy_default(F.col("apparent_temperature"), F.col("temperature_2m")).alias("feels_like_c"),
        F.coalesce("precipitation", zero).alias("precipitation_mm"),
        F.coalesce("wind_speed_10m", zero).alias("wind_speed_kmh"),
        F.coalesce("relative_humidity_2m", zero).alias("humidity"),
        "weather_code",
        weather_condition(F.col("weather_code")).alias("condition"),
        rain_flag(F.col("precipitation")).alias("is_rainy"),
    )
