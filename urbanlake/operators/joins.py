"""Lookups and star joins. Spark broadcasts a side when its measured size allows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def semi_filter(df: DataFrame, keys: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``df`` with a partner in ``keys``; ``on`` maps df column to key column."""
    wanted = keys.select(*[F.col(k).alias(f"_{k}") for k in on.values()])
    return df.join(wanted, [F.col(d) == F.col(f"_{k}") for d, k in on.items()], "left_semi")


def lookup(df: DataFrame, dim: DataFrame, on: dict[str, str], cols: dict[str, str], required: bool = False) -> DataFrame:
    """Add columns of ``dim``; ``cols`` maps dim column to output name.

    ``required`` keeps only the rows that found a non-null value.
    """
    side = dim.select(
        *[F.col(k).alias(f"_{k}") for k in on.values()], *[F.col(c).alias(out) for c, out in cols.items()]
    )
    out = df.join(side, [F.col(d) == F.col(f"_{k}") for d, k in on.items()], "left")
    out = out.drop(*[f"_{k}" for k in on.values()])
    for name in cols.values() if required else []:
        out = out.filter(F.col(name).isNotNull())
    return out


def role_lookup(df: DataFrame, dim: DataFrame, key: str, value: str, roles: dict[str, str]) -> DataFrame:
    """Join ``dim`` once per role; ``roles`` maps a df column to the output name."""
    for source, out in roles.items():
        df = lookup(df, dim, {source: key}, {value: out})
    return df


def star_join(
    fact: DataFrame, dims: dict[str, DataFrame], relationships: dict[str, tuple[str, str]]
) -> DataFrame:
    """Join each dimension many-to-one; its columns are prefixed with its name.

    ``relationships`` maps a dimension name to (fact column, dimension key).
    """
    for name, (fk, key) in relationships.items():
        dim = dims[name]
        fact = lookup(fact, dim, {fk: key}, {c: f"{name}_{c}" for c in dim.columns})
    return fact


def relationship_counts(
    name: str, fact: DataFrame, dims: dict[str, DataFrame], relationships: dict[str, tuple[str, str]]
) -> DataFrame:
    """``fact, dimension, fact_column, matched, unmatched``: what every relationship of a fact finds, from one pass.

    A role of a dimension is named ``dimension:role``.
    """
    keys = {role: dims[role.partition(":")[0]].select(key) for role, (_, key) in relationships.items()}
    wide = star_join(fact.select(*dict.fromkeys(fk for fk, _ in relationships.values())), keys, relationships)
    found = {role: F.count(f"`{role}_{key}`").alias(f"n{i}") for i, (role, (_, key)) in enumerate(relationships.items())}
    rows = [
        F.struct(
            F.lit(role.partition(":")[0]).alias("dimension"),
            F.lit(fk).alias("fact_column"),
            F.col(f"n{i}").alias("matched"),
            (F.col("total") - F.col(f"n{i}")).alias("unmatched"),
        )
        for i, (role, (fk, _)) in enumerate(relationships.items())
    ]
    counts = wide.agg(F.count("*").alias("total"), *found.values())
    return counts.select(F.lit(name).alias("fact"), F.inline(F.array(*rows)))


def yearly_join(left: DataFrame, *others: DataFrame, on: str = "year") -> DataFrame:
    """Left join of frames that already hold one row per ``on``, so nothing multiplies."""
    for other in others:
        left = left.join(other, on, "left")
    return left


def weather_join(weather: DataFrame, city: DataFrame) -> DataFrame:
    """Hourly weather with the city's trips; hours without trips count zero."""
    hours = city.select("date_key", "hour", "trip_count", "total_revenue_usd")
    zero: list[Column] = [
        F.coalesce("trip_count", F.lit(0)).alias("trip_count"),
        F.coalesce("total_revenue_usd", F.lit(0.0)).alias("revenue_usd"),
    ]
    return weather.join(hours, ["date_key", "hour"], "left").select(*weather.columns, *zero)
