"""Table writes. A target is a catalog name, or a path when it holds a slash."""

from __future__ import annotations

import logging
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F

from urbanlake.operators.merge import upsert
from urbanlake.session import delete_folder, scratch_path, stage, unstage


log = logging.getLogger(__name__)

_MODE = "spark.sql.sources.partitionOverwriteMode"


def _is_path(target: str) -> bool:
    return "/" in target


def exists(spark: SparkSession, target: str) -> bool:
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    try:
        spark.read.parquet(target)
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def read(spark: SparkSession, target: str, merge_schema: bool = False) -> DataFrame:
    if not _is_path(target):
        return spark.table(target)
    return spark.read.option("mergeSchema", merge_schema).parquet(target)


def _save(writer: DataFrameWriter, target: str) -> None:
    if _is_path(target):
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def append(df: DataFrame, target: str, partition_by: list[str] | None = None) -> None:
    """Append; a catalog table gains new columns, and readers that merge schemas see those of a path."""
    if partition_by:
        df = spread(df, partition_by)
    spark = df.sparkSession
    if not _is_path(target) and exists(spark, target):
        known = {c.lower() for c in spark.table(target).columns}
        added = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name.lower() not in known]
        if added:
            spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({', '.join(added)})")
        table = spark.table(target)
        given = {c.lower(): c for c in df.columns}
        columns = [F.col(f"`{given[c.lower()]}`") if c.lower() in given else F.lit(None).alias(c) for c in table.columns]
        df.select(*columns).write.insertInto(target)
        return
    _save(df.write.mode("append").partitionBy(*(partition_by or [])), target)


def replace(df: DataFrame, target: str, partition_by: list[str] | None = None) -> None:
    """Replace the whole table and its schema. ``df`` must not read ``target``."""
    _save(df.write.mode("overwrite").partitionBy(*(partition_by or [])), target)


def spread(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows of a partition brought together for writing.

    A rebalance, not a repartition: AQE splits a partition that is large and
    joins small ones, so a hot month is written by many tasks and a quiet one
    leaves no small files.
    """
    return df.hint("rebalance", *partition_by)


def overwrite_partitions(df: DataFrame, target: str, partition_by: list[str], clustered: bool = False) -> None:
    """Replace only the partitions that ``df`` holds rows for.

    ``clustered`` says that the rows already lie together by partition.

    Spark swaps the folders in when the job commits, after every task is done,
    so lost executors only cost a retry.
    """
    spark = df.sparkSession
    df = df if clustered else spread(df, partition_by)
    if _is_path(target) or not exists(spark, target):
        _save(
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by), target
        )
        return
    # insertInto ignores the writer option and follows the session setting.
    mode = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        df.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
    finally:
        spark.conf.set(_MODE, mode)


def upsert_table(
    df: DataFrame, target: str, keys: list[str], partition_by: list[str], null_safe: bool = False
) -> None:
    """Update rows with an equal key, insert the others; create the table when absent.

    ``partition_by`` must be determined by the key (a month of a date in the
    key, say). Then only touched partitions are read, merged and replaced; the
    rest of the table is neither read nor written. The merged partitions are
    written once, beside the table, and their folders moved in; the staged path
    is logged: should the driver die while it moves them, pass that path to
    ``move_partitions`` again.
    """
    spark = df.sparkSession
    if not exists(spark, target):
        replace(spread(df, partition_by), target, partition_by)
        return
    batch = stage(df, "upsert-batch")
    current = read(spark, target)
    old = current.filter(_in_partitions(batch, partition_by))
    merged = upsert(old, batch, keys, null_safe).select(*current.columns)
    path = scratch_path(spark, "upsert-merged")
    spread(merged, partition_by).write.partitionBy(*partition_by).parquet(path)
    log.info("partitions of %s staged in %s", target, path)
    if _is_path(target):
        move_partitions(spark, path, target, partition_by)
    else:
        overwrite_partitions(spark.read.schema(merged.schema).parquet(path), target, partition_by, clustered=True)
    # Kept only where the swap failed.
    delete_folder(spark, path)
    unstage(batch)


def move_partitions(spark: SparkSession, staged: str, target: str, partition_by: list[str]) -> None:
    """Move the partition folders of ``staged`` in the place of those of ``target``, one rename each.

    Moved folders are gone from ``staged``, so that a call that broke off can be
    repeated. Where both lie in different stores the rows are written instead.
    """
    make, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    here, there = make(staged), make(target)
    fs, other = here.getFileSystem(conf), there.getFileSystem(conf)
    if not fs.getUri().equals(other.getUri()):
        overwrite_partitions(spark.read.parquet(staged), target, partition_by, clustered=True)
        return
    for status in fs.globStatus(make(here, "/".join(f"{c}=*" for c in partition_by))):
        name = "/".join(part for part in status.getPath().toString().split("/")[-len(partition_by) :])
        place = make(there, name)
        fs.mkdirs(place.getParent())
        fs.delete(place, True)
        if not fs.rename(status.getPath(), place):
            raise RuntimeError(f"cannot move {status.getPath().toString()} to {place.toString()}")


def create_bucketed(
    df: DataFrame, table: str, keys: list[str], buckets: int, partition_by: list[str], path: str | None = None
) -> None:
    """A catalog table whose files are dealt out by the key, so that merges on it do not move what it holds."""
    _save_bucketed(df.repartition(buckets, *keys), table, keys, buckets, partition_by, path)


def _save_bucketed(
    dealt: DataFrame, table: str, keys: list[str], buckets: int, partition_by: list[str], path: str | None
) -> None:
    writer = dealt.write.format("parquet").partitionBy(*partition_by).bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def merged_buckets(df: DataFrame, table: str, keys: list[str], buckets: int, partition_by: list[str]) -> DataFrame:
    """The touched partitions of a bucketed table with ``df`` merged in; the batch alone is shuffled.

    Both sides of the union lie by bucket, so that a writing task holds rows of one bucket. Null keys match nothing.
    """
    current = df.sparkSession.table(table)
    batch = df.select(*current.columns).repartition(buckets, *keys)
    held = current.filter(_in_partitions(df, partition_by)) if partition_by else current
    return held.hint("merge").join(batch.select(*keys), keys, "left_anti").select(*current.columns).union(batch)


def upsert_bucketed(
    df: DataFrame, table: str, keys: list[str], buckets: int, partition_by: list[str], path: str | None = None
) -> None:
    """``upsert_table`` for a table of ``create_bucketed``: no shuffle of the stored side, and one staged write.

    The keys and partition columns of ``df`` must be unique per key and follow
    from it, as there.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        create_bucketed(df, table, keys, buckets, partition_by, path)
        return
    batch = stage(df, "bucket-batch")
    merged = merged_buckets(batch, table, keys, buckets, partition_by)
    side, place = f"{table}_merge_{uuid.uuid4().hex[:12]}", scratch_path(spark, "bucket-merged")
    _save_bucketed(merged, side, keys, buckets, partition_by, place)
    log.info("partitions of %s staged in %s", table, place)
    try:
        # The files of the side table hold a bucket each, and each is read by tasks of its own.
        overwrite_partitions(spark.table(side), table, partition_by, clustered=True)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {side}")
    # Kept only where the swap failed.
    delete_folder(spark, place)
    unstage(batch)


def _in_partitions(batch: DataFrame, partition_by: list[str]) -> Column:
    """A static predicate for the partitions ``batch`` touches.

    The driver reads one row per touched folder, a list it also needs to commit
    the write; a literal predicate prunes folders whatever the join strategy.
    """
    touched = batch.select(*partition_by).distinct().collect()
    return any_of(partition_by, [tuple(row) for row in touched])


def any_of(columns: list[str], values: list[tuple]) -> Column:
    """Whether the columns hold one of the value tuples; nulls equal nulls.

    One ``IN`` list per value of the columns before the last, and these joined
    in pairs, so that the depth grows with the logarithm of their number.
    """
    head, *rest = columns
    if not rest:
        plain = [v for (v,) in values if v is not None]
        listed = F.coalesce(F.col(head).isin(plain), F.lit(False)) if plain else F.lit(False)
        return listed | F.col(head).isNull() if len(plain) < len(values) else listed
    groups: dict = {}
    for value, *more in values:
        groups.setdefault(value, []).append(tuple(more))
    parts = [F.col(head).eqNullSafe(F.lit(v)) & any_of(rest, group) for v, group in groups.items()] or [F.lit(False)]
    while len(parts) > 1:
        parts = [a | b for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2 :]
    return parts[0]


def clear_partitions(spark: SparkSession, target: str, partition_by: list[str], values: list[tuple]) -> None:
    """Drop partitions that a reload found empty: an overwrite only replaces those it has rows for."""
    if not exists(spark, target):
        return
    for value in values:
        if _is_path(target):
            delete_folder(spark, "/".join([target.rstrip("/"), *(f"{c}={v}" for c, v in zip(partition_by, value))]))
        else:
            spec = ", ".join(f"{c}={v!r}" for c, v in zip(partition_by, value))
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({spec})")


def partition_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count"))
