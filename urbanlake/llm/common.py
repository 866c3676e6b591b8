"""Helpers shared by the corpus operators: table readers, the registry, document keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: A word: a run without blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL where SQL can express it."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def one_row_per(df: DataFrame, *keys: str) -> DataFrame:
    """Exact repeats of a whole row collapse to one; other rows stay as they are."""
    return df.dropDuplicates(list(keys))


def conf_int(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(name, str(default)))


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions, for operators that must name a number."""
    return conf_int(spark, "spark.sql.shuffle.partitions", 200)
