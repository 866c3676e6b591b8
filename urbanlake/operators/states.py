"""Facts as mergeable states: what is stored can be added to and taken from, so that no base row is read twice.

- **Sums.** A trip group is stored as counts and exact decimal sums; a mean is stored as the sum and the count of its
  values. States of the same group add up, and a row that was replaced goes out with a negative sign. Refreshing a fact
  reads the rows that are new or replaced, and the states of the groups they touch.
- **Quantiles.** A day of readings stores a KLL sketch of its values; sketches merge, so that the median of any period or
  zone follows from stored days.
- **Distinct counts.** A day stores the zones with a reading as bitmaps by bucket; the count over any period is a merge of
  bitmaps, and exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from urbanlake.functions.dates import date_key

#: Sums are kept as decimals: adding and taking away in any order gives the same.
EXACT = "decimal(38,10)"
PART = "decimal(28,10)"
#: Sketches of this size hold the rank of a quantile within about 0.2 percent; smaller sets of values are held whole.
KLL_SIZE = 1000

TRIP_KEYS = ["date_key", "pickup_zone_id", "payment_id"]
TRIP_SUMS = ["trip_count", "fare_sum", "revenue_sum", "distance_sum", "duration_sum", "duration_count", "passenger_sum"]


def trip_keys(grain: str) -> list[str]:
    if grain not in ("day", "hour"):
        raise ValueError(f"unknown grain: {grain}")
    return [*TRIP_KEYS, *(["hour"] if grain == "hour" else [])]


def trip_states(trips: DataFrame, grain: str = "day", sign: str | None = None) -> DataFrame:
    """The state of every group of ``trips``; ``sign`` names a column that is 1 for a row that comes and -1 for one that goes."""
    weight = F.col(sign).cast("int") if sign else F.lit(1)

    def total(column: str) -> Column:
        return F.sum(F.col(column).cast(PART) * weight).cast(EXACT)

    keys = {"date_key": date_key("trip_date"), "pickup_zone_id": F.col("pulocationid"), "payment_id": F.col("payment_type"), "hour": F.col("hour_of_day")}
    return trips.groupBy(*(keys[k].alias(k) for k in trip_keys(grain))).agg(
        F.sum(weight).cast("bigint").alias("trip_count"),
        total("fare_amount").alias("fare_sum"),
        total("total_amount").alias("revenue_sum"),
        total("trip_distance").alias("distance_sum"),
        total("trip_duration_min").alias("duration_sum"),
        F.sum(F.when(F.col("trip_duration_min").isNotNull(), weight).otherwise(0)).cast("bigint").alias("duration_count"),
        F.sum(F.col("passenger_count").cast("bigint") * weight).alias("passenger_sum"),
    )


def merge_states(states: list[DataFrame], keys: list[str], sums: list[str] = TRIP_SUMS, rows: str = "trip_count") -> DataFrame:
    """The sum of states by group; a group whose rows have all gone is left out. Null keys are a group of their own."""
    first, *more = states
    both = first.select(*keys, *sums)
    for state in more:
        both = both.union(state.select(*keys, *sums))
    added = both.groupBy(*keys).agg(*(F.sum(c).cast(first.schema[c].dataType).alias(c) for c in sums))
    return added.where(F.col(rows) > 0)


def trip_fact(states: DataFrame, grain: str = "day") -> DataFrame:
    """The fact that the states stand for."""
    return states.select(
        *trip_keys(grain),
        "trip_count",
        F.col("fare_sum").cast("double").alias("total_fare_usd"),
        F.col("revenue_sum").cast("double").alias("total_revenue_usd"),
        F.col("distance_sum").cast("double").alias("total_distance_miles"),
        F.try_divide(F.col("duration_sum").cast("double"), "duration_count").alias("avg_trip_duration_min"),
        F.col("passenger_sum").alias("total_passengers"),
    )


def signed_changes(old: DataFrame, new: DataFrame, sign: str = "change") -> DataFrame:
    """Rows that go (``old``, -1) and rows that come (``new``, 1), as the log of a merge. Equal rows on both sides stay in: they cancel."""
    return old.withColumn(sign, F.lit(-1)).unionByName(new.withColumn(sign, F.lit(1)), allowMissingColumns=True)


def day_sketches(readings: DataFrame, keys: list[str], value: str = "value", size: int = KLL_SIZE) -> DataFrame:
    """``keys, values, sketch``: the values of each group as a KLL sketch; nulls are not counted."""
    return readings.groupBy(*keys).agg(
        F.count(value).alias("values"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("sketch")
    )


def merged_quantiles(sketches: DataFrame, keys: list[str], ranks: dict[str, float], size: int = KLL_SIZE) -> DataFrame:
    """``keys, values`` and a column per name in ``ranks``: quantiles over all sketches of a group.

    The value of rank ceil(rank * values), exactly while a group's values fit in one sketch; beyond that its rank is off by
    the share that ``rank_error`` gives, at most. A group without values has null quantiles.
    """
    merged = sketches.where("values > 0").groupBy(*keys).agg(
        F.sum("values").alias("values"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("_sketch")
    )
    empty = sketches.groupBy(*keys).agg(F.max("values").alias("_most")).where("_most = 0")
    found = [F.kll_sketch_get_quantile_double("_sketch", F.lit(rank)).alias(name) for name, rank in ranks.items()]
    nothing = [F.lit(None).cast("double").alias(name) for name in ranks]
    return merged.select(*keys, "values", *found).union(empty.select(*keys, F.lit(0).cast("bigint"), *nothing))


def rank_error(size: int = KLL_SIZE) -> float:
    """The share of the values by which the rank of a quantile is off, with a confidence of 99 percent."""
    return 2.296 / size**0.9021


def zone_bitmaps(readings: DataFrame, keys: list[str], zone: str = "zone_id", value: str = "avg_value") -> DataFrame:
    """``keys, bucket, zones``: the zones with a value as bitmaps, one row for every 32,768 zone numbers."""
    number = F.col(zone).cast("bigint")
    valid = readings.where(F.col(value).isNotNull() & number.isNotNull())
    return valid.groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("zones")
    )


def count_zones(bitmaps: DataFrame, keys: list[str], name: str = "zones_with_sensors") -> DataFrame:
    """The number of different zones in each group of bitmaps: exact, whatever the groups they were stored by."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("zones").alias("zones"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("zones")).alias(name))
