"""Calendar and clock expressions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def date_key(day: Column | str) -> Column:
    """yyyyMMdd as an int, by arithmetic (cheaper than format and parse)."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_parts(df: DataFrame, day: str) -> DataFrame:
    """The ten calendar attributes of ``day`` (Sunday = 1; weekend = 1 or 7)."""
    return df.select(
        "*",
        date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
    )


def date_dimension(spark: SparkSession, start: str = "2020-01-01", days: int = 4018) -> DataFrame:
    """One row per day from ``start``; the default ends on 2030-12-31."""
    calendar = spark.range(0, days).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date")
    )
    return date_parts(calendar, "date")


def parse_ts(text: Column | str) -> Column:
    """Offset-bearing text to a UTC wall-clock timestamp; null when malformed.

    The result does not depend on the session zone.
    """
    instant = F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)
    epoch = F.expr("TIMESTAMP_LTZ '1970-01-01 00:00:00Z'")
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + (instant - epoch)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes from ``start`` to ``end``, on whole seconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60


def month_bounds(key: Column | str) -> tuple[Column, Column]:
    """First and last date of a ``yyyy-MM`` key."""
    first = F.to_date(F.concat(F.col(key) if isinstance(key, str) else key, F.lit("-01")))
    return first, F.last_day(first)


def fill_template(template: str | None, month: Column | str) -> Column:
    """Replace ``{yyyy-mm}``, ``{yyyy}`` and ``{mm}`` in ``template``; null without one."""
    if not template:
        return F.lit(None).cast("string")
    out = F.lit(template)
    for mark, pattern in (("{yyyy-mm}", "yyyy-MM"), ("{yyyy}", "yyyy"), ("{mm}", "MM")):
        out = F.replace(out, F.lit(mark), F.date_format(month, pattern))
    return out


def month_rows(df: DataFrame, first: str, last: str, template: str | None = None) -> DataFrame:
    """Each input row once per month from ``first`` to ``last`` (dates), both inclusive."""
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    return (
        df.withColumn("month_start", F.explode(months))
        .withColumn("partition_key", F.date_format("month_start", "yyyy-MM"))
        .withColumn("source_url", fill_template(template, "month_start"))
    )


def months(spark: SparkSession, first: str, last: str, template: str | None = None) -> DataFrame:
    """Month keys and addresses from ``first`` to ``last`` (``yyyy-MM``), both inclusive."""
    bounds = spark.range(1).select(
        F.to_date(F.lit(f"{first}-01")).alias("lo"), F.to_date(F.lit(f"{last}-01")).alias("hi")
    )
    return month_rows(bounds, "lo", "hi", template).select("partition_key", "source_url")


def next_chunk(
    watermark: datetime | None, start: datetime, end: datetime, days: int = 7
) -> tuple[datetime, datetime] | None:
    """The next slice to export, clamped to [start, end); None when all is done."""
    low = max(watermark or start, start)
    return None if low >= end else (low, min(low + timedelta(days=days), end))


def remap(
    ts: Column | str, chunk: tuple[datetime, datetime], source_start: datetime, now: datetime, days: int = 7
) -> Column:
    """Move the times of a chunk into the recent past, chunk by chunk back from ``now``.

    The chunk number divides by the nominal chunk length, so a shorter last
    chunk ends where the one before it begins.
    """
    low, high = chunk
    index = (low - source_start) // timedelta(days=days)
    hour = now.replace(minute=0, second=0, microsecond=0)
    shift = hour - index * timedelta(days=days) - high
    return (F.col(ts) if isinstance(ts, str) else ts) + F.lit(shift)
