"""Schema normalisation, quality rules and rejected rows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from urbanlake.functions.dates import minutes_between

# Target types of the trip columns.
TRIP_TYPES = {
    "vendorid": "int",
    "passenger_count": "double",
    "trip_distance": "double",
    "ratecodeid": "double",
    "store_and_fwd_flag": "string",
    "pulocationid": "int",
    "dolocationid": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}
# The pollutants kept for facts.
POLLUTANTS = ["pm25", "no2", "o3", "co", "pm10"]


class Rule(NamedTuple):
    """A row passes when ``predicate`` is true; null counts as failed."""

    code: str
    predicate: Column


def trip_rules() -> list[Rule]:
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return [
        Rule("no_pickup_zone", F.col("pulocationid").isNotNull()),
        Rule("no_dropoff_zone", F.col("dolocationid").isNotNull()),
        Rule("no_pickup_time", pickup.isNotNull()),
        Rule("no_dropoff_time", dropoff.isNotNull()),
        Rule("passengers", F.col("passenger_count").between(1, 6)),
        Rule("fare", F.col("fare_amount") >= 0),
        Rule("total", F.col("total_amount") >= 0),
        Rule("distance", F.col("trip_distance").between(0.01, 100)),
        Rule("time_order", dropoff > pickup),
        Rule("duration", minutes_between(pickup, dropoff).between(1, 720)),
    ]


def daily_rules(null_coverage: str = "drop") -> list[Rule]:
    """``null_coverage='keep'`` lets archive rows, which carry no coverage, pass."""
    coverage = F.col("coverage_pct") >= 75
    if null_coverage == "keep":
        coverage = coverage | F.col("coverage_pct").isNull()
    return [
        Rule("no_value", F.col("value").isNotNull()),
        Rule("negative", F.col("value") >= 0),
        Rule("coverage", coverage),
        Rule("no_date", F.col("date_utc").isNotNull()),
    ]


def hourly_rules() -> list[Rule]:
    return [
        Rule("no_value", F.col("value").isNotNull()),
        Rule("negative", F.col("value") >= 0),
        Rule("no_date", F.col("date_utc").isNotNull()),
        Rule("hour", F.col("hour_utc").between(0, 23)),
    ]


def fx_rules() -> list[Rule]:
    return [
        Rule("status", F.col("obs_status") == "A"),
        Rule("no_rate", F.col("rate").isNotNull()),
        Rule("rate", F.col("rate") > 0),
    ]


def gdp_rules() -> list[Rule]:
    return [
        Rule("no_value", F.col("gdp_usd").isNotNull()),
        Rule("value", F.col("gdp_usd") > 0),
        Rule("no_year", F.col("year").isNotNull()),
    ]


def archive_rules() -> list[Rule]:
    """Of raw archive readings, whose time is in ``ts_utc``."""
    return [Rule("no_time", F.col("ts_utc").isNotNull())]


def normalize_schema(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Lower-case every name and cast the typed ones; a bad value becomes null.

    Columns that already have their type pass unchanged, so that filters on
    them still reach the scan.
    """
    lower = [c.lower() for c in df.columns]
    if len(set(lower)) < len(lower):
        raise ValueError(f"column names differ only by case: {sorted(df.columns)}")
    out = []
    for field, name in zip(df.schema.fields, lower):
        col = F.col(f"`{field.name}`")
        kind = types.get(name)
        if kind and field.dataType.simpleString() != kind:
            col = col.try_cast(kind)
        out.append(col.alias(name))
    return df.select(*out)


def project(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """Output name to source column or expression."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in mapping.items()])


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that pass every rule."""
    return df.filter(reduce(lambda a, b: a & b, [r.predicate for r in rules]))


def tag_rejects(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``reject_reasons``: codes of the failed rules, empty for a good row."""
    failed = [F.when(~F.coalesce(r.predicate, F.lit(False)), r.code) for r in rules]
    return df.withColumn("reject_reasons", F.array_compact(F.array(*failed)))


def split_rejects(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with their reasons."""
    passed = reduce(lambda a, b: a & b, [r.predicate for r in rules])
    # The plain predicate decides, so reasons are built for rejected rows only.
    rejected = tag_rejects(df.filter(~F.coalesce(passed, F.lit(False))), rules)
    return df.filter(passed), rejected


def filter_in_set(df: DataFrame, col: str, values: Iterable[str], ci: bool = True) -> DataFrame:
    """Set membership, case-insensitive by default."""
    if ci:
        return df.filter(F.lower(col).isin([v.lower() for v in values]))
    return df.filter(F.col(col).isin(list(values)))


def literal_for(df: DataFrame, col: str, value: object) -> Column:
    """``value`` as a literal of the column's own type, so that a comparison needs no cast and is pushed down."""
    return (value if isinstance(value, Column) else F.lit(value)).cast(df.schema[col].dataType)


def incremental(df: DataFrame, col: str, low: object | None = None, high: object | None = None) -> DataFrame:
    """Rows newer than ``low`` and, when given, not newer than ``high``."""
    if low is not None:
        df = df.filter(F.col(col) > literal_for(df, col, low))
    return df if high is None else df.filter(F.col(col) <= literal_for(df, col, high))


def active_in(
    df: DataFrame, first: str, last: str, low: object, high: object, null_open: bool = True
) -> DataFrame:
    """Rows whose [first, last] interval meets [low, high].

    ``null_open`` treats a null end as unbounded; otherwise such rows are out.
    """
    low, high = [v if isinstance(v, Column) else F.lit(v) for v in (low, high)]
    ends, starts = F.col(last) >= low, F.col(first) <= high
    if null_open:
        ends, starts = ends | F.col(last).isNull(), starts | F.col(first).isNull()
    return df.filter(ends & starts)


def union_drift(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
