"""Claims of ledger partitions by several callers, each partition going to one of them.

The ledger is stored in versions. A caller reads the newest one, writes the next as a snapshot of its own, and makes it the
next version by creating its commit file, which one caller alone can do. The others find the ledger moved, and claim again
from what it holds now.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.operators import control
from urbanlake.session import delete_folder

ATTEMPTS = 20


class LedgerMoved(RuntimeError):
    """Another caller committed the version first."""


class Snapshot(NamedTuple):
    version: int
    ledger: DataFrame


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def read_ledger(spark: SparkSession, store: str) -> Snapshot:
    """The newest committed version; a store without one is version 0, an empty ledger."""
    folder, fs = _path(spark, f"{store}/commits")
    names = [str(s.getPath().getName()) for s in fs.listStatus(folder)] if fs.exists(folder) else []
    # Commit files are named by version and hold the name of its snapshot.
    commits = [m for m in (re.fullmatch(r"(\d+)", n) for n in names) if m]
    if not commits:
        return Snapshot(0, spark.createDataFrame([], control.LEDGER_SCHEMA))
    version = max(int(m[1]) for m in commits)
    return Snapshot(version, read_version(spark, store, version))


def commit_ledger(spark: SparkSession, store: str, expected: int, ledger: DataFrame) -> int:
    """Make ``ledger`` the version after ``expected``; ``LedgerMoved`` if another caller was first."""
    name = uuid.uuid4().hex
    ledger.write.parquet(f"{store}/snapshots/{name}")
    file, fs = _path(spark, f"{store}/commits/{expected + 1:010d}")
    try:
        # Fails where the file is there: the store decides who is first.
        out = fs.create(file, False)
    except Py4JJavaError as error:
        delete_folder(spark, f"{store}/snapshots/{name}")
        if "exists" in str(error.java_exception):
            raise LedgerMoved(f"version {expected + 1} of {store} is taken") from None
        raise
    out.write(bytearray(name.encode()))
    out.close()
    return expected + 1


def change_ledger(
    spark: SparkSession, store: str, change: Callable[[DataFrame], DataFrame], attempts: int = ATTEMPTS
) -> Snapshot:
    """Commit ``change`` of the newest version, again from the start as often as the ledger moves meanwhile."""
    for _ in range(attempts):
        version, ledger = read_ledger(spark, store)
        try:
            done = commit_ledger(spark, store, version, change(ledger))
        except LedgerMoved:
            continue
        return Snapshot(done, read_version(spark, store, done))
    raise LedgerMoved(f"{store} moved {attempts} times")


def read_version(spark: SparkSession, store: str, version: int) -> DataFrame:
    for _ in range(100):
        named = spark.read.text(f"{store}/commits/{version:010d}").first()
        if named:
            return spark.read.schema(control.LEDGER_SCHEMA).parquet(f"{store}/snapshots/{named[0]}")
        # Its caller has created the file and is about to fill it.
        time.sleep(0.1)
    raise RuntimeError(f"commit {version} of {store} is empty")


def claim(
    spark: SparkSession, store: str, source: str, layer: str, now: datetime, limit: int | None = None
) -> list[str]:
    """Set the first ``limit`` pending partitions running and return their keys, which no other caller gets."""
    taken: list[str] = []

    def change(ledger: DataFrame) -> DataFrame:
        taken[:] = [row.partition_key for row in control.pending(ledger, source, layer, limit).collect()]
        mine = F.col("partition_key").isin(taken) & (F.col("source_name") == source)
        return control.claim(ledger.where(mine), source, layer, now).unionByName(ledger.where(~mine | F.col("partition_key").isNull()))

    change_ledger(spark, store, change)
    return list(taken)


def finish(spark: SparkSession, store: str, results: DataFrame, layer: str, now: datetime, cascade: bool = False) -> None:
    """Apply results to the newest version."""
    change_ledger(spark, store, lambda ledger: control.update(ledger, results, layer, now, cascade))
