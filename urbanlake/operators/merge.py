"""Latest-row deduplication, keyed upserts and incremental recomputation."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from urbanlake.operators.clean import incremental


def dedupe_latest(df: DataFrame, keys: list[str], order: list[str], ties: list[str] | None = None) -> DataFrame:
    """The newest row per key, ``ties`` deciding between equal ``order`` values.

    Rank 1 is pushed below the shuffle as a partial group limit, so each task
    sends at most one row per key however many copies a key has.
    """
    newest = [F.col(c).desc_nulls_last() for c in [*order, *(ties or [])]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """``source`` over ``target``: equal keys replaced, others kept or added.

    Null keys match nothing, as in a MERGE, unless ``null_safe``. ``source``
    must be unique per key.
    """
    if null_safe:
        side = source.select(*[F.col(k).alias(f"_{k}") for k in keys])
        kept = target.join(side, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_anti")
    else:
        kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` plus the ``source`` rows whose key it lacks."""
    added = source.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(added, allowMissingColumns=True)


def missing_keys(requested: DataFrame, failed: DataFrame, keys: list[str]) -> DataFrame:
    """Requested keys that did not fail."""
    return requested.select(*keys).distinct().join(failed.select(*keys), keys, "left_anti")


def high_watermark(df: DataFrame, col: str = "loaded_at") -> datetime | None:
    """The newest load time, or None for an empty input."""
    return df.agg(F.max(col)).first()[0]


def touched_groups(
    df: DataFrame, build: Callable[[DataFrame], DataFrame], col: str, low: object, high: object | None = None
) -> DataFrame:
    """The groups of an aggregate that have a row in (low, high], each built from all its rows up to ``high``.

    ``build`` carries the newest ``col`` of each group, which decides: one
    partially aggregated shuffle and no join. Whole groups are rebuilt, so a
    late row never overwrites a full total with a partial one. Rows newer than
    ``high`` wait for the next run.
    """
    return incremental(build(incremental(df, col, None, high)), col, low).drop(col)


def refresh_fact(
    fact: DataFrame,
    silver: DataFrame,
    keys: list[str],
    build: Callable[[DataFrame], DataFrame],
    low: object,
    high: object | None = None,
    col: str = "loaded_at",
) -> DataFrame:
    """``fact`` with every group touched since ``low`` rebuilt in full."""
    return upsert(fact, touched_groups(silver, build, col, low, high), keys, null_safe=True)
