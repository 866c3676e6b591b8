"""Joins: lookups, spines, star, spatial and keyed merges."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.operators import clean, dims, facts, joins, spatial, states, timeseries
from urbanlake.operators.measures import INACTIVE, MANY_TO_MANY, RELATIONSHIPS, measure
from urbanlake.operators.merge import insert_missing, refresh_fact, upsert
from urbanlake.queries import bindings as b
from urbanlake.queries.landing import WEATHER_SQL, weather
from urbanlake.queries.registry import query
from urbanlake.session import stage

PAIR = ["from_currency", "to_currency"]
TRIP_ID = ["tpep_pickup_datetime", "pulocationid", "fare_amount", "loaded_at"]


@query(
    "join_zone_lookup",
    "SELECT event_id, zone_id FROM readings_raw JOIN sensor_zones USING (sensor_id) WHERE zone_id IS NOT NULL",
    b.READINGS_RAW,
    b.SENSOR_ZONES,
)
def join_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = b.sensor_zones(spark, sf_dir)
    rows = b.readings_raw(spark, sf_dir)
    return joins.lookup(rows, placed, {"sensor_id": "sensor_id"}, {"zone_id": "zone_id"}, required=True).select(
        "event_id", "zone_id"
    )


@query(
    "join_param_dim",
    """SELECT parameter, CAST(p_id AS INTEGER) AS p_id, count(*) AS readings
    FROM readings_raw LEFT JOIN params ON parameter = p_name GROUP BY 1, 2""",
    b.READINGS_RAW,
    b.PARAMS,
)
def join_param_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as they come: one in upper case finds no id."""
    counts = b.readings_raw(spark, sf_dir).groupBy("parameter").agg(F.count("*").alias("readings"))
    return joins.lookup(counts, dims.parameters(spark), {"parameter": "p_name"}, {"p_id": "p_id"})


@query(
    "join_role_playing",
    """SELECT o_orderkey, l_linenumber, l_partkey, l_quantity, cn.n_name AS customer_nation, sn.n_name AS supplier_nation
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey""",
)
def join_role_playing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation in two roles on each order line."""
    orders, customer = b.table(spark, sf_dir, "orders"), b.table(spark, sf_dir, "customer")
    supplier = b.table(spark, sf_dir, "supplier")
    lines = (
        b.table(spark, sf_dir, "lineitem")
        .join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    )
    roles = {"c_nationkey": "customer_nation", "s_nationkey": "supplier_nation"}
    return joins.role_lookup(lines, b.table(spark, sf_dir, "nation"), "n_nationkey", "n_name", roles).select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_quantity", "customer_nation", "supplier_nation"
    )


_SPINE = """spine AS (
  SELECT from_currency, to_currency, CAST(day AS DATE) AS rate_date
  FROM (SELECT DISTINCT from_currency, to_currency FROM fx) CROSS JOIN
    (SELECT unnest(generate_series(min(rate_date), max(rate_date), INTERVAL 1 DAY)) AS day FROM fx))"""


@query("cross_join_spine", "SELECT rate_date, from_currency, to_currency FROM spine", b.FX_RAW, b.FX, _SPINE)
def cross_join_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair with every day; each pair expands the range in place."""
    return timeseries.date_spine(b.fx(spark, sf_dir), "rate_date", PAIR)


@query(
    "join_spine",
    """SELECT rate_date, from_currency, to_currency, CAST(rate AS DOUBLE) AS rate
    FROM spine LEFT JOIN fx USING (rate_date, from_currency, to_currency)""",
    b.FX_RAW,
    b.FX,
    _SPINE,
)
def join_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = b.fx(spark, sf_dir)
    keys = ["rate_date", *PAIR]
    observed = fx.select(*keys, F.col("rate").cast("double").alias("rate"))
    return timeseries.join_spine(timeseries.date_spine(fx, "rate_date", PAIR), observed, keys)


# Pairs by an inner join first: DuckDB 2.0.0 returns extra unmatched rows for a LEFT JOIN on these ranges.
_PAIRS = """pairs AS (
  SELECT sensor_id, zone_id, zone_name, borough FROM points JOIN shapes
  ON longitude > x - half AND longitude < x + half AND latitude > y - half AND latitude < y + half
    AND NOT (longitude BETWEEN x - half / 4.0 AND x + half / 4.0 AND latitude BETWEEN y - half / 4.0 AND y + half / 4.0))"""


@query(
    "spatial_join_within",
    """SELECT sensor_id, location_id, p_name, latitude, longitude, zone_id, zone_name, borough,
      TIMESTAMP '2002-01-01' AS loaded_at FROM points LEFT JOIN pairs USING (sensor_id)""",
    b.POINTS,
    b.SHAPES,
    _PAIRS,
)
def spatial_join_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping squares with holes; many points lie exactly on an edge."""
    return spatial.sensor_zones(b.locations(spark, sf_dir), b.shapes(spark, sf_dir))


@query(
    "spatial_map_stats",
    """SELECT count(zone_id) AS mapped, count(*) - count(zone_id) AS unmapped, count(*) AS total_sensors
    FROM points LEFT JOIN pairs USING (sensor_id)""",
    b.POINTS,
    b.SHAPES,
    _PAIRS,
)
def spatial_map_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.map_stats(spatial.sensor_zones(b.locations(spark, sf_dir), b.shapes(spark, sf_dir)))


@query(
    "join_weather_taxi",
    """SELECT w.date_key, w.hour, temp_c, condition, CAST(coalesce(t.trip_count, 0) AS BIGINT) AS trip_count,
      coalesce(t.revenue, 0) AS revenue_usd
    FROM weather w LEFT JOIN (SELECT date_key, hour, sum(trip_count) AS trip_count,
      CAST(round(CAST(sum(total_revenue_usd) AS DECIMAL(38,4)), 2) AS DOUBLE) AS revenue FROM fct_taxi_hourly GROUP BY 1, 2) t USING (date_key, hour)""",
    b.READINGS_RAW,
    *b.TAXI_HOUR_CTES,
    WEATHER_SQL,
)
def join_weather_taxi(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = facts.taxi_fact(b.trips(spark, sf_dir), "hour")
    city = facts.city_hourly(fact, 19980101, 19980129)
    return joins.weather_join(weather(spark, sf_dir), city).select(
        "date_key", "hour", "temp_c", "condition", "trip_count", b.near("revenue_usd", 2).alias("revenue_usd")
    )


@query(
    "upsert_anti_join",
    """SELECT c_custkey, CASE WHEN min(o_orderkey) IS NULL THEN 'new' ELSE 'kept' END AS origin
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""",
)
def upsert_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders are kept; all customers are offered, the missing ones inserted."""
    ordering = b.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    target = ordering.withColumn("origin", F.lit("kept"))
    source = b.table(spark, sf_dir, "customer").select("c_custkey", F.lit("new").alias("origin"))
    return insert_missing(target, source, ["c_custkey"])


@query(
    "merge_key_join",
    """SELECT rate_date, from_currency, to_currency, CAST(rate AS DOUBLE) AS rate FROM (
      SELECT *, row_number() OVER (PARTITION BY rate_date, from_currency, to_currency
        ORDER BY late DESC, loaded_at DESC, rate DESC) AS rn
      FROM (SELECT time_period AS rate_date, currency AS from_currency, currency_denom AS to_currency,
          CAST(obs_value AS DECIMAL(18,6)) AS rate, loaded_at, hour(loaded_at) >= 12 AS late
        FROM fx_raw WHERE obs_status = 'A' AND obs_value > 0)) WHERE rn = 1""",
    b.FX_RAW,
)
def merge_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates loaded before noon, then those loaded later merged on three keys."""
    raw = b.fx_raw(spark, sf_dir)
    early, late = [facts.silver_fx(raw.filter(c)) for c in ("hour(loaded_at) < 12", "hour(loaded_at) >= 12")]
    keys = ["rate_date", *PAIR]
    return upsert(early, late, keys).select(*keys, F.col("rate").cast("double").alias("rate"))


@query(
    "star_join",
    """SELECT borough AS dm_zone_borough, label AS dm_payment_payment_type, CAST(year(trip_date) AS INTEGER) AS year,
      CAST(sum(trip_count) AS BIGINT) AS trips FROM (
        SELECT pulocationid, payment_type, trip_date, count(*) AS trip_count FROM trips GROUP BY 1, 2, 3)
      JOIN zones ON pulocationid = zone_id JOIN (VALUES (1, 'Credit card'), (2, 'Cash'), (3, 'No charge')) p(id, label)
        ON payment_type = id GROUP BY 1, 2, 3""",
    b.TRIPS_RAW,
    b.TRIPS,
    b.ZONES,
)
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = b.model(spark, sf_dir)
    related = {"dm_date": ("date_key", "date_key"), "dm_zone": ("pickup_zone_id", "zone_id"), "dm_payment": ("payment_id", "id")}
    wide = joins.star_join(model["fct_taxi_daily"], model, related)
    keys = ["dm_zone_borough", "dm_payment_payment_type", F.col("dm_date_year").alias("year")]
    return wide.groupBy(*keys).agg(F.sum("trip_count").alias("trips"))


_MATCHES = {
    "date_key": "date_key BETWEEN 19950101 AND 20021231",
    "pickup_zone_id": "pickup_zone_id IN (SELECT zone_id FROM zones)",
    "zone_id": "zone_id IN (SELECT zone_id FROM zones)",
    "payment_id": "payment_id BETWEEN 1 AND 6",
    "p_id": "p_id BETWEEN 1 AND 12",
    "id_cur_from": "id_cur_from BETWEEN 1 AND 2",
    "id_cur_to": "id_cur_to BETWEEN 1 AND 2",
}


def _relationships() -> dict[str, dict[str, tuple[str, str]]]:
    """All many-to-one relationships by fact, the inactive one as a role of its dimension."""
    found = {f: {d: k for d, k in of.items() if (f, d) not in MANY_TO_MANY} for f, of in RELATIONSHIPS.items()}
    for (fact, dim), keys in INACTIVE.items():
        found[fact][f"{dim}:inactive"] = keys
    return {f: of for f, of in found.items() if of}


_ALL_MATCHES = " UNION ALL ".join(
    f"""SELECT '{fact}' AS fact, '{role.partition(":")[0]}' AS dimension, '{fk}' AS fact_column,
      count(*) FILTER ({_MATCHES[fk]}) AS matched, count(*) - count(*) FILTER ({_MATCHES[fk]}) AS unmatched FROM {fact}"""
    for fact, of in _relationships().items()
    for role, (fk, _) in of.items()
)


@query(
    "star_relationships",
    _ALL_MATCHES,
    *dict.fromkeys((*b.TAXI_CTES, *b.TAXI_HOUR_CTES, *b.AIR_CTES, *b.AIR_HOUR_CTES, *b.FX_CTES, b.ZONES)),
)
def star_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every fact that each of the 15 relationships finds in its dimension."""
    model = b.model(spark, sf_dir)
    parts = [joins.relationship_counts(name, model[name], model, of) for name, of in _relationships().items()]
    return reduce(DataFrame.union, parts)


@query(
    "trips_by_vendor",
    """SELECT CASE vendorid WHEN 1 THEN 'Creative Mobile Technologies, LLC' WHEN 2 THEN 'VeriFone Inc.' END AS vendor_name, count(*) AS trip_count
    FROM trips GROUP BY 1""",
    b.TRIPS_RAW,
    b.TRIPS,
)
def trips_by_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = joins.lookup(b.trips(spark, sf_dir), b.model(spark, sf_dir)["dm_vendor"], {"vendorid": "id"}, {"vendor_name": "vendor_name"})
    return named.groupBy("vendor_name").agg(F.count("*").alias("trip_count"))


@query(
    "gdp_year_join",
    """SELECT year, trips, gdp_usd FROM (SELECT CAST(year(trip_date) AS INTEGER) AS year, count(*) AS trips FROM trips GROUP BY 1)
    LEFT JOIN (SELECT CAST(year AS INTEGER) AS year, CAST(sum(gdp_usd) AS DOUBLE) AS gdp_usd FROM gdp GROUP BY 1) USING (year)""",
    b.TRIPS_RAW,
    b.TRIPS,
    b.GDP_RAW,
    b.GDP,
)
def gdp_year_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each side is rolled up to the year first, so the many-to-many link multiplies nothing."""
    model = b.model(spark, sf_dir)
    trips = measure("trips", model, ["dm_date.year"]).withColumnRenamed("dm_date_year", "year")
    gdp = measure("gdp_usd", model, ["dm_date.year"]).select(
        F.col("dm_date_year").cast("int").alias("year"), F.col("gdp_usd").cast("double").alias("gdp_usd")
    )
    return joins.yearly_join(trips, gdp)


@query(
    "incremental_fact_refresh",
    """SELECT date_key, pickup_zone_id, payment_id, trip_count, CAST(round(CAST(total_revenue_usd AS DECIMAL(38,4)), 2) AS DOUBLE) AS total_revenue_usd
    FROM fct_taxi_daily""",
    *b.TAXI_CTES,
)
def incremental_fact_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact built from the morning loads and then refreshed equals a full build."""
    trips = stage(b.trips(spark, sf_dir), "silver-trips")
    noon = "2002-01-01 12:00:00"
    old = facts.taxi_fact(clean.incremental(trips, "loaded_at", None, noon))
    build = partial(facts.taxi_fact, newest="loaded_at")
    new = refresh_fact(old, trips, ["date_key", "pickup_zone_id", "payment_id"], build, noon)
    return new.select(
        "date_key", "pickup_zone_id", "payment_id", "trip_count", b.near("total_revenue_usd", 2).alias("total_revenue_usd")
    )


@query(
    "incremental_state_refresh",
    """SELECT date_key, pickup_zone_id, payment_id, trip_count, CAST(round(CAST(total_revenue_usd AS DECIMAL(38,4)), 2) AS DOUBLE) AS total_revenue_usd,
      CAST(round(CAST(avg_trip_duration_min AS DECIMAL(38,6)), 4) AS DOUBLE) AS avg_trip_duration_min
    FROM fct_taxi_daily""",
    *b.TAXI_CTES,
)
def incremental_state_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of the morning loads, in which every fifth fare was wrong, then of what came and of what was corrected."""
    trips = stage(b.trips(spark, sf_dir), "silver-trips")
    morning = clean.incremental(trips, "loaded_at", None, "2002-01-01 12:00:00")
    wrong = F.pmod(F.xxhash64(*TRIP_ID), F.lit(5)) == 0
    first = morning.withColumn("total_amount", F.when(wrong, F.col("total_amount") + 7).otherwise(F.col("total_amount")))
    held = stage(states.trip_states(first), "trip-states")
    come = clean.incremental(trips, "loaded_at", "2002-01-01 12:00:00").union(morning.where(wrong))
    log = states.signed_changes(first.where(wrong), come)
    merged = states.merge_states([held, states.trip_states(log, sign="change")], states.TRIP_KEYS)
    return states.trip_fact(merged).select(
        "date_key", "pickup_zone_id", "payment_id", "trip_count", b.near("total_revenue_usd", 2).alias("total_revenue_usd"),
        b.near("avg_trip_duration_min", 4).alias("avg_trip_duration_min"),
    )


@query(
    "fx_incremental_fill",
    """SELECT rate_date, from_currency, to_currency, CAST(rate AS DOUBLE) AS rate, rate_date <> observed_on AS is_filled
    FROM fx_filled""",
    b.FX_RAW,
    b.FX,
    b.FX_FILLED,
)
def fx_incremental_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates to the end of 1998 filled, then the later ones merged: equals one fill of everything."""
    fx = stage(b.fx(spark, sf_dir), "fx")
    old, new = fx.filter("rate_date < '1999-01-01'"), fx.filter("rate_date >= '1999-01-01'")
    silver = stage(timeseries.fill_gaps(old, PAIR, "rate_date"), "fx-filled")
    changed = timeseries.fill_increment(silver, new, PAIR, "rate_date")
    merged = upsert(silver, changed, ["rate_date", *PAIR])
    return merged.select("rate_date", *PAIR, F.col("rate").cast("double").alias("rate"), "is_filled")

