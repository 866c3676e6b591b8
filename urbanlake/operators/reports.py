"""Report queries: each visual of the report as one frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from urbanlake.operators.measures import Model, measure


UNKNOWN = "unknown"


def overview(model: Model) -> DataFrame:
    """Headline figures."""
    return measure(["trips", "revenue_usd", "zones_with_sensors"], model)


def coverage_matrix(model: Model) -> DataFrame:
    """Sensor rows by zone and parameter; the columns are the parameters of the dimension, which is read for them.

    Rows whose parameter the dimension lacks stand under ``UNKNOWN``.
    """
    named = model["fct_air_quality"].join(model["dm_air_measurement"].select("p_id", "p_name"), "p_id", "left")
    names = [r[0] for r in model["dm_air_measurement"].select("p_name").where("p_name is not null").distinct().orderBy("p_name").collect()]
    named = named.withColumn("p_name", F.coalesce("p_name", F.lit(UNKNOWN)))
    return named.groupBy("zone_id").pivot("p_name", [*names, UNKNOWN]).agg(F.sum("sensor_count"))


def traffic_vs_air(model: Model) -> DataFrame:
    """Trips and mean pollution per date."""
    return measure(["trips", "avg_pollution"], model, ["dm_date.date_key"])


def diurnal_by_zone(model: Model) -> DataFrame:
    """Trips and mean pollution by hour and zone."""
    return measure(["trips_hourly", "avg_pollution_hourly"], model, ["hour", "dm_zone.zone_id"])


def diurnal_by_hour(model: Model) -> DataFrame:
    return measure(["trips_hourly", "avg_pollution_hourly"], model, ["hour"])


def by_day_of_week(model: Model) -> DataFrame:
    return measure(["trips", "avg_pollution"], model, ["dm_date.day_of_week"])


def revenue_fx(model: Model) -> DataFrame:
    """Monthly revenue in both currencies, per-trip means and the mean rate."""
    names = ["revenue_usd", "revenue_eur", "avg_revenue_per_trip_usd", "avg_revenue_per_trip_eur", "eur_rate"]
    return measure(names, model, ["dm_date.year_month"])


def long_term(model: Model) -> DataFrame:
    """Trips, mean pollution and GDP per year that has any of them."""
    return measure(["trips", "avg_pollution", "gdp_usd"], model, ["dm_date.year"])


def correlation(model: Model, by: str = "zone_id") -> DataFrame:
    """Pearson correlation of trips and each pollutant, by ``zone_id`` or ``hour``.

    Points are (date, zone) pairs, or (date, hour, zone) when ``by`` is 'hour'.
    """
    suffix, extra = ("_hourly", ["hour"]) if by == "hour" else ("", [])
    grain = ["date_key", "zone_id", *extra]
    taxi = model["fct_taxi_daily" if not extra else "fct_taxi_hourly"].withColumnRenamed("pickup_zone_id", "zone_id")
    trips = taxi.groupBy(*grain).agg(F.sum("trip_count").alias("trips"))
    air = model[f"fct_air_quality{suffix}"].select(*grain, "p_id", "avg_value")
    x, y = F.col("trips").cast("double"), F.col("avg_value")
    # A constant series has no correlation: null instead of a division by zero.
    pearson = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    points = trips.join(air, grain).groupBy(by, "p_id")
    return points.agg(pearson.alias("pearson"), F.count("*").alias("points"))


REPORTS = {
    "overview": overview,
    "coverage_matrix": coverage_matrix,
    "traffic_vs_air": traffic_vs_air,
    "diurnal_by_zone": diurnal_by_zone,
    "diurnal_by_hour": diurnal_by_hour,
    "by_day_of_week": by_day_of_week,
    "revenue_fx": revenue_fx,
    "long_term": long_term,
    "correlation": correlation,
}


def report(name: str, model: Model) -> DataFrame:
    return REPORTS[name](model)
