"""Business measures over the star schema, under grouping and filters.

A model is a dict of frames by table name. Grouping columns and filters name a
dimension column as ``dm_zone.borough``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

# Fact column and dimension key per relationship.
RELATIONSHIPS = {
    "fct_taxi_daily": {
        "dm_date": ("date_key", "date_key"),
        "dm_zone": ("pickup_zone_id", "zone_id"),
        "dm_payment": ("payment_id", "id"),
    },
    "fct_taxi_hourly": {
        "dm_date": ("date_key", "date_key"),
        "dm_zone": ("pickup_zone_id", "zone_id"),
        "dm_payment": ("payment_id", "id"),
    },
    "fct_air_quality": {
        "dm_date": ("date_key", "date_key"),
        "dm_zone": ("zone_id", "zone_id"),
        "dm_air_measurement": ("p_id", "p_id"),
    },
    "fct_air_quality_hourly": {
        "dm_date": ("date_key", "date_key"),
        "dm_zone": ("zone_id", "zone_id"),
        "dm_air_measurement": ("p_id", "p_id"),
    },
    "fct_fx_daily": {"dm_date": ("date_key", "date_key"), "dm_currency": ("id_cur_from", "id")},
    "fct_gdp_yearly": {"dm_date": ("year", "year")},
}
# Relationships that only hold where they are asked for, in place of the one above.
INACTIVE = {("fct_fx_daily", "dm_currency"): ("id_cur_to", "id")}
# dm_date holds many rows per year, so this relationship only filters.
MANY_TO_MANY = {("fct_gdp_yearly", "dm_date")}
HOUR = "hour"
#: Values of a dimension that does not relate to a fact, over which the fact's values may be repeated.
MOST_REPEATED = 10_000

Model = dict[str, DataFrame]
Filters = dict[str, list]
Inactive = Iterable[tuple[str, str]]


class Base(NamedTuple):
    """An aggregate over one fact."""

    fact: str
    value: Callable[[], Column]


BASE = {
    "trips": Base("fct_taxi_daily", lambda: F.sum("trip_count")),
    "trips_hourly": Base("fct_taxi_hourly", lambda: F.sum("trip_count")),
    "revenue_usd": Base("fct_taxi_daily", lambda: F.sum("total_revenue_usd")),
    "total_fare_usd": Base("fct_taxi_daily", lambda: F.sum("total_fare_usd")),
    "total_distance": Base("fct_taxi_daily", lambda: F.sum("total_distance_miles")),
    "total_passengers": Base("fct_taxi_daily", lambda: F.sum("total_passengers")),
    "avg_trip_duration": Base(
        "fct_taxi_daily",
        lambda: F.try_divide(F.sum(F.col("avg_trip_duration_min") * F.col("trip_count")), F.sum("trip_count")),
    ),
    "avg_pollution": Base("fct_air_quality", lambda: F.avg("avg_value")),
    "avg_pollution_hourly": Base("fct_air_quality_hourly", lambda: F.avg("avg_value")),
    "zones_with_sensors": Base(
        "fct_air_quality", lambda: F.count_distinct(F.when(F.col("avg_value").isNotNull(), F.col("zone_id")))
    ),
    "gdp_usd": Base("fct_gdp_yearly", lambda: F.sum("gdp_usd")),
}
# name: (numerator, denominator); blank when the denominator is zero or missing.
RATIO = {
    "avg_revenue_per_trip_usd": ("revenue_usd", "trips"),
    "avg_revenue_per_trip_eur": ("revenue_eur", "trips"),
    "revenue_eur_div": ("revenue_usd", "eur_rate"),
}


def _related(fact: str, inactive: Inactive) -> dict[str, tuple[str, str]]:
    return RELATIONSHIPS[fact] | {table: INACTIVE[f, table] for f, table in inactive if f == fact}


def _scoped(
    model: Model, fact: str, frame: DataFrame, group_by: list[str], filters: Filters, inactive: Inactive = ()
) -> DataFrame:
    """``frame`` restricted by the filters, with the grouping columns attached.

    Only dimensions that are used are joined; the key itself needs no join.
    Filters on unrelated dimensions have no effect.
    """
    related = _related(fact, inactive)
    group: dict[str, dict[str, str]] = {}
    for path in group_by:
        table, _, column = path.rpartition(".")
        out = path.replace(".", "_")
        if not table:
            frame = frame.withColumn(out, F.col(column))
        elif table not in related:
            raise ValueError(f"{path} does not relate to {fact}")
        elif column == related[table][1]:
            frame = frame.withColumn(out, F.col(related[table][0]))
        else:
            group.setdefault(table, {})[column] = out
    wanted: dict[str, list[Column]] = {}
    for path, values in filters.items():
        table, _, column = path.rpartition(".")
        if not table:
            frame = frame.filter(F.col(column).isin(values)) if column in frame.columns else frame
        elif table in related:
            fk, key = related[table]
            if column == key:
                frame = frame.filter(F.col(fk).isin(values))
            else:
                wanted.setdefault(table, []).append(F.col(column).isin(values))
    for table in {**group, **wanted}:
        fk, key = related[table]
        dim = reduce(lambda d, p: d.filter(p), wanted.get(table, []), model[table])
        dim = dim.select(F.col(key).alias("_key"), *[F.col(c).alias(o) for c, o in group.get(table, {}).items()])
        if (fact, table) in MANY_TO_MANY:
            dim = dim.distinct()
        how = "left" if table not in wanted else "inner" if table in group else "left_semi"
        frame = frame.join(dim, F.col(fk) == F.col("_key"), how).drop("_key")
    return frame


def _currency_id(model: Model, name: str) -> Column:
    return model["dm_currency"].filter(F.col("currency_name") == name).select("id").scalar()


def _usd_eur(model: Model) -> DataFrame:
    fx = model["fct_fx_daily"]
    ids = (F.col("id_cur_from") == _currency_id(model, "USD")) & (F.col("id_cur_to") == _currency_id(model, "EUR"))
    return fx.filter(ids).withColumn("rate", F.col("rate").cast("double"))


def _groups(group_by: list[str]) -> list[str]:
    return [g.replace(".", "_") for g in group_by]


def _repeated(
    model: Model, fact: str, group_by: list[str], filters: Filters, inactive: Inactive, build: Callable[[list[str]], DataFrame]
) -> DataFrame:
    """``build`` over the related groups, its values repeated for every value of the unrelated dimensions.

    The distinct values of a dimension's grouping columns come as one scalar
    that each row expands in place. That is bounded: at most ``MOST_REPEATED``
    values, and one unrelated dimension; more is an error.
    """
    related = _related(fact, inactive)
    loose: dict[str, list[str]] = {}
    for path in group_by:
        table, _, column = path.rpartition(".")
        if table and table not in related:
            loose.setdefault(table, []).append(column)
    if len(loose) > 1:
        raise ValueError(f"{sorted(loose)} do not relate to {fact}: group by one such dimension at a time")
    out = build([g for g in group_by if g.rpartition(".")[0] not in loose])
    for table, columns in loose.items():
        dim = model[table]
        for path, values in filters.items():
            if path.rpartition(".")[0] == table:
                dim = dim.filter(F.col(path.rpartition(".")[2]).isin(values))
        each = dim.select(F.struct(*[F.col(c).alias(f"{table}_{c}") for c in columns]).alias("each")).distinct()
        listed = each.limit(MOST_REPEATED + 1).agg(F.collect_list("each")).scalar()
        message = F.lit(f"{table} has more than {MOST_REPEATED} values and does not relate to {fact}")
        listed = F.when(F.size(listed) > MOST_REPEATED, F.raise_error(message)).otherwise(listed)
        out = out.withColumn("_each", F.explode(listed)).select("*", "_each.*").drop("_each")
    return out


def _eur_rate(model: Model, group_by: list[str], filters: Filters, inactive: Inactive) -> DataFrame:
    scoped = _scoped(model, "fct_fx_daily", _usd_eur(model), group_by, filters, inactive)
    return scoped.groupBy(*_groups(group_by)).agg(F.avg("rate").alias("eur_rate"))


def _revenue_eur(model: Model, group_by: list[str], filters: Filters, inactive: Inactive) -> DataFrame:
    """Revenue of each date times that date's mean rate; dates without a rate drop out."""
    scoped = _scoped(model, "fct_taxi_daily", model["fct_taxi_daily"], group_by, filters)
    daily = scoped.groupBy("date_key", *_groups(group_by)).agg(F.sum("total_revenue_usd").alias("usd"))
    currency = {path: values for path, values in filters.items() if path.startswith("dm_currency.")}
    rate = _scoped(model, "fct_fx_daily", _usd_eur(model), [], currency, inactive).groupBy("date_key").agg(F.avg("rate").alias("rate"))
    eur = daily.join(rate, "date_key").groupBy(*_groups(group_by))
    return eur.agg(F.sum(F.col("usd") * F.col("rate")).alias("revenue_eur"))


def measure(
    names: str | list[str],
    model: Model,
    group_by: list[str] | None = None,
    filters: Filters | None = None,
    inactive: Inactive = (),
) -> DataFrame:
    """One row per group with the named measures.

    Measures of one fact share an aggregation; the results of several facts
    are united and folded by group. A dimension that does not relate to a
    fact repeats its value in each group. ``inactive`` names (fact, dimension)
    pairs of ``INACTIVE`` to be used in place of the active relationship.
    """
    names = [names] if isinstance(names, str) else list(names)
    group_by, filters = group_by or [], filters or {}
    needed = list(dict.fromkeys(names))
    while any(n in RATIO for n in needed):
        needed = list(dict.fromkeys(p for n in needed for p in RATIO.get(n, (n,))))
    parts, by_fact = [], {}
    for name in needed:
        if name == "eur_rate":
            build = partial(_eur_rate, model, filters=filters, inactive=inactive)
            parts.append(_repeated(model, "fct_fx_daily", group_by, filters, inactive, build))
        elif name == "revenue_eur":
            if any(g.startswith("dm_currency.") for g in group_by):
                raise ValueError("revenue in euros has one currency")
            build = partial(_revenue_eur, model, filters=filters, inactive=inactive)
            parts.append(_repeated(model, "fct_taxi_daily", group_by, filters, inactive, build))
        else:
            by_fact.setdefault(BASE[name].fact, []).append(name)
    for fact, own in by_fact.items():

        def build(groups: list[str], fact: str = fact, own: list[str] = own) -> DataFrame:
            scoped = _scoped(model, fact, model[fact], groups, filters, inactive)
            return scoped.groupBy(*_groups(groups)).agg(*[BASE[n].value().alias(n) for n in own])

        parts.append(_repeated(model, fact, group_by, filters, inactive, build))
    out = parts[0]
    if len(parts) > 1:
        united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        out = united.groupBy(*_groups(group_by)).agg(*[F.max(n).alias(n) for n in needed])

    def value(name: str) -> Column:
        if name not in RATIO:
            return F.col(name)
        top, bottom = RATIO[name]
        return F.try_divide(value(top), value(bottom))

    return out.select(*_groups(group_by), *[value(n).alias(n) for n in names])
