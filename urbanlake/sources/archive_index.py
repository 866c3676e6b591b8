"""A stored index of the archive's files, so that a load touches the folders it needs and no others.

The archive has a folder per location, year and month, and years of them. Listing its root means listing every folder that
ever landed; here a Parquet table holds a row per file, foldered by month. It is built by looking up the folders of given
locations, ``SLICE`` at a time, and read with a join, in which the months that are asked for prune its folders.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import batched, product

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanlake.session import stage, unstage
from urbanlake.sources import files, tables

INDEX_SCHEMA = "locationid bigint, path string, bytes bigint, modified timestamp, year int, month int"
#: Locations that are looked up at once, and files that are read at once.
SLICE = 1024
LOOKUPS = 32
#: Lists of files that are tried side by side.
READS = 8


def register(spark: SparkSession, root: str, store: str, locations: DataFrame, keys: Iterable[str]) -> None:
    """Index the files of the months ``keys`` (``yyyy-MM``) of all ``locations`` (``location_id``).

    These months are replaced in ``store``; a month without files ends without rows. A folder that does not exist is no
    error, and a month may be spelled with or without its leading zero.
    """
    months = [tuple(map(int, key.split("-"))) for key in keys]
    ids = (row[0] for row in locations.select("location_id").where("location_id is not null").distinct().toLocalIterator())
    parts: list[DataFrame] = []
    for some in batched(ids, SLICE):
        names = [f"{root}/locationid={i}/year={y}/month={m}" for i, (y, n) in product(some, months) for m in dict.fromkeys((f"{n:02d}", str(n)))]
        there = existing(spark, names)
        if there:
            listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv.gz").option("basePath", root).load(there)
            # Without their content the files are listed, not read.
            parts.append(stage(listed.selectExpr("CAST(locationid AS BIGINT) AS locationid", "path", "length AS bytes", "modificationTime AS modified", "year", "month"), "archive-index"))
    found = set()
    if parts:
        rows = reduce(DataFrame.union, parts)
        tables.overwrite_partitions(rows, store, ["year", "month"])
        found = {(r.year, r.month) for r in rows.select("year", "month").distinct().collect()}
    if not existing(spark, [store]):
        tables.replace(spark.createDataFrame([], INDEX_SCHEMA), store, ["year", "month"])
    tables.clear_partitions(spark, store, ["year", "month"], [m for m in months if m not in found])
    for part in parts:
        unstage(part)


def read_index(spark: SparkSession, store: str) -> DataFrame:
    """The index; one without files has no rows."""
    return spark.read.schema(INDEX_SCHEMA).parquet(store)


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist, looked up side by side in whatever store holds them."""
    conf = spark._jsc.hadoopConfiguration()

    def there(path: str) -> bool:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(conf).exists(folder)

    with ThreadPoolExecutor(LOOKUPS) as pool:
        return [path for path, found in zip(paths, pool.map(there, paths)) if found]


def wanted_files(index: DataFrame, months: DataFrame, locations: DataFrame) -> DataFrame:
    """The index rows of the folders in ``months`` (``year, month``) of ``locations`` (``location_id``).

    The months may be a filtered frame, such as the claimed rows of a ledger: they prune the index's folders at run time.
    """
    ids = locations.select(F.col("location_id").alias("locationid")).distinct()
    return index.join(months.select("year", "month").distinct(), ["year", "month"], "left_semi").join(ids, "locationid", "left_semi")


def month_frame(partitions: DataFrame, key: str = "partition_key") -> DataFrame:
    """``year, month`` of ledger rows keyed by ``yyyy-MM``."""
    return partitions.select(F.substring(key, 1, 4).try_cast("int").alias("year"), F.substring(key, 6, 2).try_cast("int").alias("month"))


def read_files(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """The rows of the files, with their folders as columns."""
    schema = files.ARCHIVE_SCHEMA + ", locationid bigint, year int, month int"
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    return reader.option("basePath", root).csv(paths)


def slices(found: DataFrame, size: int = SLICE) -> Iterator[list[str]]:
    """The paths of index rows, about ``size`` at a time, so the driver never holds them all; a location is not cut."""
    some, last = [], None
    for location, path in found.select("locationid", "path").orderBy("locationid", "path").toLocalIterator():
        if len(some) >= size and location != last:
            yield some
            some = []
        some.append(path)
        last = location
    if some:
        yield some


def unreadable(read: Callable[[list[str]], DataFrame], paths: list[str]) -> list[tuple[str, str]]:
    """``(path, reason)`` of the files that Spark cannot read to the end.

    All are read at once, and the halves of a list that fails again: b bad files of n take about b log n jobs, and a list
    without one takes a single job. The lists of one length are read side by side, so the steps that wait for one another are
    log n, however many files are bad. Works for every format that ``read`` handles.
    """

    def failure(some: list[str]) -> str | None:
        try:
            read(some).write.format("noop").mode("overwrite").save()
        except Exception as error:
            return reason(error)
        return None

    bad: dict[str, str] = {}
    lists = [paths] if paths else []
    with ThreadPoolExecutor(READS) as pool:
        while lists:
            failed = [(some, why) for some, why in zip(lists, pool.map(failure, lists)) if why is not None]
            bad |= {some[0]: why for some, why in failed if len(some) == 1}
            lists = [half for some, _ in failed if len(some) > 1 for half in (some[: len(some) // 2], some[len(some) // 2 :])]
    return [(path, bad[path]) for path in paths if path in bad]


def reason(error: Exception) -> str:
    """What went wrong, in one line of at most 500 characters."""
    return f"{type(error).__name__}: {str(error).strip().splitlines()[0] if str(error).strip() else ''}"[:500]


def health(read: Callable[[list[str]], DataFrame], found: DataFrame, size: int = SLICE) -> DataFrame:
    """The index rows of ``found`` with ``status`` ('good' or 'unreadable') and ``message``."""
    spark = found.sparkSession
    bad = [entry for some in slices(found, size) for entry in unreadable(read, some)]
    named = spark.createDataFrame(bad, "path string, message string")
    status = F.when(F.col("message").isNull(), "good").otherwise("unreadable")
    return found.join(named, "path", "left").select(*found.columns, status.alias("status"), "message")
