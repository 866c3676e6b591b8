"""Measures and report queries over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.operators import reports
from urbanlake.operators.measures import measure
from urbanlake.queries import bindings as b
from urbanlake.queries.registry import query

_YM = "left(CAST(date_key AS VARCHAR), 4) || '-' || substr(CAST(date_key AS VARCHAR), 5, 2)"
_RATE = "rate AS (SELECT date_key, avg(rate) AS rate FROM fct_fx_daily WHERE id_cur_from = 1 AND id_cur_to = 2 GROUP BY 1)"
_REV = """revenue AS (SELECT pickup_zone_id, date_key, sum(total_revenue_usd) AS usd, sum(trip_count) AS trips
  FROM fct_taxi_daily GROUP BY 1, 2)"""


def _cast(df: DataFrame, scales: dict[str, int]) -> DataFrame:
    return df.withColumns({c: b.near(c, n) for c, n in scales.items()})


def _by_zone(name: str, sql_value: str, fact: str, zone: str, ctes: tuple[str, ...], scale: int | None) -> None:
    """A measure per zone and year-month, whose SQL is one aggregate."""
    value = b.near_sql(sql_value, scale) if scale is not None else f"CAST({sql_value} AS BIGINT)"
    body = f"SELECT borough AS dm_zone_borough, {_YM} AS dm_date_year_month, {value} AS {name} FROM {fact} LEFT JOIN zones ON {fact}.{zone} = zones.zone_id GROUP BY 1, 2"

    @query(f"m_{name}", body, *ctes, b.ZONES)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = measure(name, b.model(spark, sf_dir), ["dm_zone.borough", "dm_date.year_month"])
        return out if scale is None else _cast(out, {name: scale})


_TAXI = ("fct_taxi_daily", "pickup_zone_id", b.TAXI_CTES)
for _name, _value, (_fact, _zone, _ctes), _scale in [
    ("trips", "sum(trip_count)", _TAXI, None),
    ("trips_hourly", "sum(trip_count)", ("fct_taxi_hourly", "pickup_zone_id", b.TAXI_HOUR_CTES), None),
    ("revenue_usd", "sum(total_revenue_usd)", _TAXI, 2),
    ("total_distance", "sum(total_distance_miles)", _TAXI, 4),
    ("total_fare_usd", "sum(total_fare_usd)", _TAXI, 2),
    ("total_passengers", "sum(total_passengers)", _TAXI, None),
    ("avg_revenue_per_trip_usd", "sum(total_revenue_usd) / nullif(sum(trip_count), 0)", _TAXI, 6),
    ("avg_trip_duration", "sum(avg_trip_duration_min * trip_count) / nullif(sum(trip_count), 0)", _TAXI, 6),
    ("avg_pollution", "avg(avg_value)", ("fct_air_quality", "zone_id", b.AIR_CTES), 6),
    ("avg_pollution_hourly", "avg(avg_value)", ("fct_air_quality_hourly", "zone_id", b.AIR_HOUR_CTES), 6),
]:
    _by_zone(_name, _value, _fact, _zone, _ctes, _scale)


@query(
    "m_eur_rate",
    f"SELECT {_YM} AS dm_date_year_month, CAST(round(CAST(avg(CAST(rate AS DOUBLE)) AS DECIMAL(38,8)), 6) AS DOUBLE) AS eur_rate FROM fct_fx_daily "
    "WHERE id_cur_from = 1 AND id_cur_to = 2 GROUP BY 1",
    *b.FX_CTES,
)
def m_eur_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast(measure("eur_rate", b.model(spark, sf_dir), ["dm_date.year_month"]), {"eur_rate": 6})


@query(
    "m_revenue_eur",
    "SELECT pickup_zone_id AS dm_zone_zone_id, CAST(round(CAST(sum(usd * rate) AS DECIMAL(38,4)), 2) AS DOUBLE) AS revenue_eur FROM revenue JOIN rate USING (date_key) GROUP BY 1",
    *b.TAXI_CTES,
    *b.FX_CTES,
    _RATE,
    _REV,
)
def m_revenue_eur(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast(measure("revenue_eur", b.model(spark, sf_dir), ["dm_zone.zone_id"]), {"revenue_eur": 2})


@query(
    "m_avg_revenue_per_trip_eur",
    """SELECT z.pickup_zone_id AS dm_zone_zone_id, CAST(round(CAST(eur / nullif(trips, 0) AS DECIMAL(38,8)), 6) AS DOUBLE) AS avg_revenue_per_trip_eur
    FROM (SELECT pickup_zone_id, sum(trips) AS trips FROM revenue GROUP BY 1) z LEFT JOIN
      (SELECT pickup_zone_id, sum(usd * rate) AS eur FROM revenue JOIN rate USING (date_key) GROUP BY 1) e
      ON z.pickup_zone_id = e.pickup_zone_id""",
    *b.TAXI_CTES,
    *b.FX_CTES,
    _RATE,
    _REV,
)
def m_avg_revenue_per_trip_eur(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measure("avg_revenue_per_trip_eur", b.model(spark, sf_dir), ["dm_zone.zone_id"])
    return _cast(out, {"avg_revenue_per_trip_eur": 6})


@query(
    "m_revenue_eur_div",
    f"""SELECT coalesce(r.ym, f.ym) AS dm_date_year_month, CAST(round(CAST(usd / rate AS DECIMAL(38,6)), 4) AS DOUBLE) AS revenue_eur_div
    FROM (SELECT {_YM} AS ym, sum(total_revenue_usd) AS usd FROM fct_taxi_daily GROUP BY 1) r FULL JOIN
      (SELECT {_YM} AS ym, avg(CAST(rate AS DOUBLE)) AS rate FROM fct_fx_daily
        WHERE id_cur_from = 1 AND id_cur_to = 2 GROUP BY 1) f ON r.ym = f.ym""",
    *b.TAXI_CTES,
    *b.FX_CTES,
)
def m_revenue_eur_div(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measure("revenue_eur_div", b.model(spark, sf_dir), ["dm_date.year_month"])
    return _cast(out, {"revenue_eur_div": 4})


@query(
    "m_eur_rate_by_currency",
    "SELECT 'USD' AS dm_currency_currency_name, CAST(round(CAST(avg(CAST(rate AS DOUBLE)) AS DECIMAL(38,8)), 6) AS DOUBLE) AS eur_rate "
    "FROM fct_fx_daily WHERE id_cur_from = 1 AND id_cur_to = 2 HAVING count(*) > 0 UNION ALL "
    "SELECT 'to EUR', CAST(round(CAST(avg(CAST(rate AS DOUBLE)) AS DECIMAL(38,8)), 6) AS DOUBLE) "
    "FROM fct_fx_daily WHERE id_cur_from = 1 AND id_cur_to = 2 HAVING count(*) > 0",
    *b.FX_CTES,
)
def m_eur_rate_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the currency it comes from, then by the one it goes to."""
    model, by = b.model(spark, sf_dir), ["dm_currency.currency_name"]
    name = F.concat(F.lit("to "), "dm_currency_currency_name").alias("dm_currency_currency_name")
    target = measure("eur_rate", model, by, inactive=[("fct_fx_daily", "dm_currency")]).select(name, "eur_rate")
    return _cast(measure("eur_rate", model, by).unionByName(target), {"eur_rate": 6})


@query(
    "m_revenue_eur_div_by_zone",
    """SELECT coalesce(z.zone_id, r.pickup_zone_id) AS dm_zone_zone_id,
      CASE WHEN z.zone_id IS NOT NULL THEN CAST(round(CAST(usd / (SELECT avg(CAST(rate AS DOUBLE)) FROM fct_fx_daily
        WHERE id_cur_from = 1 AND id_cur_to = 2) AS DECIMAL(38,6)), 4) AS DOUBLE) END AS revenue_eur_div
    FROM zones z FULL JOIN (SELECT pickup_zone_id, sum(total_revenue_usd) AS usd FROM fct_taxi_daily GROUP BY 1) r
      ON z.zone_id = r.pickup_zone_id""",
    *b.TAXI_CTES,
    *b.FX_CTES,
    b.ZONES,
)
def m_revenue_eur_div_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates do not relate to zones, so each zone divides by the same mean rate."""
    out = measure("revenue_eur_div", b.model(spark, sf_dir), ["dm_zone.zone_id"])
    return _cast(out, {"revenue_eur_div": 4})


@query(
    "m_zones_with_sensors",
    """SELECT CAST(p_id AS INTEGER) AS dm_air_measurement_p_id, count(DISTINCT zone_id) AS zones_with_sensors
    FROM fct_air_quality JOIN zones USING (zone_id) WHERE avg_value IS NOT NULL
    GROUP BY 1""",
    *b.AIR_CTES,
    b.ZONES,
)
def m_zones_with_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per parameter."""
    return measure("zones_with_sensors", b.model(spark, sf_dir), ["dm_air_measurement.p_id"])


@query(
    "r_overview",
    """SELECT (SELECT CAST(sum(trip_count) AS BIGINT) FROM fct_taxi_daily) AS trips,
      (SELECT CAST(round(CAST(sum(total_revenue_usd) AS DECIMAL(38,4)), 2) AS DOUBLE) FROM fct_taxi_daily) AS revenue_usd,
      (SELECT count(DISTINCT zone_id) FROM fct_air_quality WHERE avg_value IS NOT NULL) AS zones_with_sensors""",
    *b.TAXI_CTES,
    *b.AIR_CTES,
)
def r_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast(reports.report("overview", b.model(spark, sf_dir)), {"revenue_usd": 2})


@query(
    "r_coverage_matrix",
    """SELECT zone_id, """
    + ", ".join(
        f"CAST(sum(sensor_count) FILTER (WHERE p_name = '{p}') AS BIGINT) AS {p}"
        for p in "pm1 pm25 pm10 relativehumidity nox temperature no2 no o3 co um003 so2".split()
    )
    + ", CAST(sum(sensor_count) FILTER (WHERE p_id IS NULL) AS BIGINT) AS unknown FROM fct_air_quality GROUP BY zone_id",
    *b.AIR_CTES,
)
def r_coverage_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report("coverage_matrix", b.model(spark, sf_dir))


@query(
    "r_traffic_vs_air",
    """SELECT date_key AS dm_date_date_key, trips, avg_pollution
    FROM (SELECT date_key, CAST(sum(trip_count) AS BIGINT) AS trips FROM fct_taxi_daily GROUP BY 1) FULL JOIN
      (SELECT date_key, CAST(round(CAST(avg(avg_value) AS DECIMAL(38,8)), 6) AS DOUBLE) AS avg_pollution FROM fct_air_quality GROUP BY 1) USING (date_key)""",
    *b.TAXI_CTES,
    *b.AIR_CTES,
)
def r_traffic_vs_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast(reports.report("traffic_vs_air", b.model(spark, sf_dir)), {"avg_pollution": 6})


@query(
    "r_diurnal",
    """SELECT hour, zone_id AS dm_zone_zone_id, trips_hourly, avg_pollution_hourly
    FROM (SELECT hour, pickup_zone_id AS zone_id, CAST(sum(trip_count) AS BIGINT) AS trips_hourly
        FROM fct_taxi_hourly GROUP BY 1, 2) FULL JOIN
      (SELECT hour, zone_id, CAST(round(CAST(avg(avg_value) AS DECIMAL(38,8)), 6) AS DOUBLE) AS avg_pollution_hourly FROM fct_air_quality_hourly GROUP BY 1, 2)
      USING (hour, zone_id)""",
    *b.TAXI_HOUR_CTES,
    *b.AIR_HOUR_CTES,
)
def r_diurnal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast(reports.report("diurnal_by_zone", b.model(spark, sf_dir)), {"avg_pollution_hourly": 6})


@query(
    "r_diurnal_by_hour",
    """SELECT hour, trips_hourly, avg_pollution_hourly
    FROM (SELECT hour, CAST(sum(trip_count) AS BIGINT) AS trips_hourly FROM fct_taxi_hourly GROUP BY 1) FULL JOIN
      (SELECT hour, CAST(round(CAST(avg(avg_value) AS DECIMAL(38,8)), 6) AS DOUBLE) AS avg_pollution_hourly FROM fct_air_quality_hourly GROUP BY 1) USING (hour)""",
    *b.TAXI_HOUR_CTES,
    *b.AIR_HOUR_CTES,
)
def r_diurnal_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast(reports.report("diurnal_by_hour", b.model(spark, sf_dir)), {"avg_pollution_hourly": 6})


_DOW = "CAST(dayofweek(strptime(CAST(date_key AS VARCHAR), '%Y%m%d')) + 1 AS INTEGER)"


@query(
    "r_day_of_week",
    f"""SELECT dow AS dm_date_day_of_week, trips, avg_pollution
    FROM (SELECT {_DOW} AS dow, CAST(sum(trip_count) AS BIGINT) AS trips FROM fct_taxi_daily GROUP BY 1) FULL JOIN
      (SELECT {_DOW} AS dow, CAST(round(CAST(avg(avg_value) AS DECIMAL(38,8)), 6) AS DOUBLE) AS avg_pollution FROM fct_air_quality GROUP BY 1) USING (dow)""",
    *b.TAXI_CTES,
    *b.AIR_CTES,
)
def r_day_of_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast(reports.report("by_day_of_week", b.model(spark, sf_dir)), {"avg_pollution": 6})


@query(
    "r_revenue_fx",
    f"""SELECT ym AS dm_date_year_month, CAST(round(CAST(revenue_usd AS DECIMAL(38,4)), 2) AS DOUBLE) AS revenue_usd, CAST(round(CAST(revenue_eur AS DECIMAL(38,4)), 2) AS DOUBLE) AS revenue_eur,
      CAST(round(CAST(revenue_usd / trips AS DECIMAL(38,8)), 6) AS DOUBLE) AS avg_revenue_per_trip_usd, CAST(round(CAST(revenue_eur / trips AS DECIMAL(38,8)), 6) AS DOUBLE) AS avg_revenue_per_trip_eur,
      CAST(round(CAST(eur_rate AS DECIMAL(38,8)), 6) AS DOUBLE) AS eur_rate
    FROM (SELECT {_YM} AS ym, sum(usd) AS revenue_usd, sum(trips) AS trips FROM revenue GROUP BY 1) FULL JOIN
      (SELECT {_YM} AS ym, sum(usd * rate) AS revenue_eur FROM revenue JOIN rate USING (date_key) GROUP BY 1) USING (ym)
      FULL JOIN (SELECT {_YM} AS ym, avg(CAST(rate AS DOUBLE)) AS eur_rate FROM fct_fx_daily
        WHERE id_cur_from = 1 AND id_cur_to = 2 GROUP BY 1) USING (ym)""",
    *b.TAXI_CTES,
    *b.FX_CTES,
    _RATE,
    _REV,
)
def r_revenue_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    scales = {
        "revenue_usd": 2,
        "revenue_eur": 2,
        "avg_revenue_per_trip_usd": 6,
        "avg_revenue_per_trip_eur": 6,
        "eur_rate": 6,
    }
    return _cast(reports.report("revenue_fx", b.model(spark, sf_dir)), scales)


@query(
    "r_long_term",
    """SELECT CAST(year AS BIGINT) AS dm_date_year, trips, avg_pollution, gdp_usd
    FROM (SELECT date_key // 10000 AS year, CAST(sum(trip_count) AS BIGINT) AS trips FROM fct_taxi_daily GROUP BY 1)
    FULL JOIN (SELECT date_key // 10000 AS year, CAST(round(CAST(avg(avg_value) AS DECIMAL(38,8)), 6) AS DOUBLE) AS avg_pollution FROM fct_air_quality GROUP BY 1)
      USING (year)
    FULL JOIN (SELECT year, CAST(sum(gdp_usd) AS DOUBLE) AS gdp_usd FROM fct_gdp_yearly GROUP BY 1) USING (year)""",
    *b.TAXI_CTES,
    *b.AIR_CTES,
    *b.GDP_CTES,
)
def r_long_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast(reports.report("long_term", b.model(spark, sf_dir)), {"avg_pollution": 6, "gdp_usd": 2})


_PEARSON = (
    "CASE WHEN stddev_pop(trips) * stddev_pop(avg_value) > 0 THEN " + b.near_sql("corr(trips, avg_value)", 6) + " END"
)
_ZONE_DAY = """SELECT zone_id, date_key, p_id, avg_value, trips FROM fct_air_quality JOIN (
  SELECT pickup_zone_id AS zone_id, date_key, sum(trip_count) AS trips FROM fct_taxi_daily GROUP BY 1, 2)
  USING (zone_id, date_key)"""


@query(
    "r_correlation",
    f"""SELECT zone_id, CAST(p_id AS INTEGER) AS p_id, {_PEARSON}
      AS pearson, count(*) AS points FROM ({_ZONE_DAY}) GROUP BY 1, 2""",
    *b.TAXI_CTES,
    *b.AIR_CTES,
)
def r_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.correlation(b.model(spark, sf_dir), "zone_id")
    return _cast(out, {"pearson": 6})


_ZONE_HOUR = """SELECT hour, p_id, avg_value, trips FROM fct_air_quality_hourly JOIN (
  SELECT pickup_zone_id AS zone_id, date_key, hour, sum(trip_count) AS trips FROM fct_taxi_hourly GROUP BY 1, 2, 3)
  USING (zone_id, date_key, hour)"""


@query(
    "r_correlation_hourly",
    f"""SELECT hour, CAST(p_id AS INTEGER) AS p_id, count(*) AS points,
      {_PEARSON} AS pearson FROM ({_ZONE_HOUR}) GROUP BY 1, 2""",
    *b.TAXI_HOUR_CTES,
    *b.AIR_HOUR_CTES,
)
def r_correlation_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.correlation(b.model(spark, sf_dir), "hour")
    return _cast(out, {"pearson": 6})
