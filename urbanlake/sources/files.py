"""Landed files: month partitions, csv.gz archives and lookup CSVs."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from urbanlake.sources.tables import any_of

# Schemas of the landed CSV files.
ARCHIVE_SCHEMA = (
    "location_id bigint, sensors_id bigint, location string, datetime string, lat double, lon double, "
    "parameter string, units string, value double"
)
PARAMETER_SCHEMA = "p_id int, p_name string, p_units string, p_display_name string"
RATE_SERIES_SCHEMA = (
    "KEY string, FREQ string, CURRENCY string, CURRENCY_DENOM string, EXR_TYPE string, EXR_SUFFIX string, "
    "TIME_PERIOD date, OBS_VALUE double, OBS_STATUS string, OBS_CONF string, OBS_PRE_BREAK string, "
    "OBS_COM string, TIME_FORMAT string, BREAKS string, COLLECTION string, COMPILING_ORG string, "
    "DISS_ORG string, DOM_SER_IDS string, PUBL_ECB string, PUBL_MU string, PUBL_PUBLIC string, "
    "UNIT_INDEX_BASE string, COMPILATION string, COVERAGE string, DECIMALS bigint, NAT_TITLE string, "
    "SOURCE_AGENCY string, SOURCE_PUB string, TITLE string, TITLE_COMPL string, UNIT string, UNIT_MULT bigint"
)
ZONE_COLUMNS = {
    "LocationID": ("zone_id", "int"),
    "Borough": ("borough", "string"),
    "Zone": ("zone_name", "string"),
    "Service_zone": ("service_zone", "string"),
}


def months_filter(keys: Iterable[str]) -> Column:
    """Partition predicate for ``yyyy-MM`` keys on the ``year``/``month`` columns."""
    return any_of(["year", "month"], [tuple(map(int, key.split("-"))) for key in keys])


def scan_months(spark: SparkSession, root: str, keys: Iterable[str]) -> DataFrame:
    """Only the month folders named by ``keys``; a missing month gives no rows."""
    return spark.read.parquet(root).filter(months_filter(keys))


def partition_columns_from_path(df: DataFrame) -> DataFrame:
    """``year`` and ``month`` taken from each row's file path."""
    path = F.col("_metadata.file_path")
    return df.select(
        "*",
        F.regexp_extract(path, r"year=(\d{4})", 1).try_cast("int").alias("year"),
        F.regexp_extract(path, r"month=(\d{1,2})", 1).try_cast("int").alias("month"),
    )


def scan_archive(spark: SparkSession, root: str) -> DataFrame:
    """All csv.gz files below ``root`` with the hive folders as columns."""
    return (
        spark.read.schema(ARCHIVE_SCHEMA + ", locationid bigint, year int, month int")
        .option("header", True)
        .option("pathGlobFilter", "*.csv.gz")
        .option("mode", "PERMISSIVE")
        .csv(root)
    )


def scan_archive_folders(spark: SparkSession, root: str, keys: Iterable[str], locations: DataFrame) -> DataFrame:
    """Rows of the month folders ``keys`` of the locations in ``locations``.

    Months prune statically and locations through a semi-join on the partition
    column; a folder that does not exist simply matches nothing.
    """
    wanted = locations.select(F.col("location_id").alias("locationid")).distinct()
    return scan_archive(spark, root).filter(months_filter(keys)).join(wanted, "locationid", "left_semi")


def scan_lookup(spark: SparkSession, path: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Header CSV read as text, columns matched case-insensitively, renamed and cast."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.col(old).try_cast(kind).alias(new) for old, (new, kind) in columns.items()])


def scan_declared(spark: SparkSession, path: str, schema: str = PARAMETER_SCHEMA) -> DataFrame:
    """Header CSV bound to ``schema`` by position; header names are ignored."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


def scan_rate_series(spark: SparkSession, path: str, load_ts: datetime, source_url: str | None = None) -> DataFrame:
    """Rate series CSV with its source address and load time."""
    return (
        spark.read.schema(RATE_SERIES_SCHEMA)
        .option("header", True)
        .csv(path)
        .select("*", F.lit(source_url or path).alias("source_url"), F.lit(load_ts).alias("loaded_at"))
    )


def with_audit(df: DataFrame, source: str, load_ts: datetime | None = None) -> DataFrame:
    """Add ``loaded_at``, ``load_date`` and ``source_system``."""
    stamp = F.current_timestamp() if load_ts is None else F.lit(load_ts)
    return (
        df.withColumn("loaded_at", stamp)
        .withColumn("load_date", F.to_date("loaded_at"))
        .withColumn("source_system", F.lit(source))
    )


def between_dates(df: DataFrame, col: str, low: date | Column, high: date | Column) -> DataFrame:
    """Rows whose date lies in [low, high]."""
    return df.filter(F.col(col).between(low, high))
