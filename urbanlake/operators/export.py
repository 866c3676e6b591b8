"""Report envelope and time-series records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from urbanlake.functions.dates import remap


def top_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def envelope(df: DataFrame, meta: dict[str, Column], order: list[str], columns: list[str]) -> DataFrame:
    """A bounded report as one JSON document, rows in ``order``."""
    keys = [F.col(c).alias(f"_{i}") for i, c in enumerate(order)]
    packed = F.collect_list(F.struct(*keys, F.struct(*columns).alias("row")))
    rows = F.transform(F.array_sort(packed), lambda r: r["row"])
    body = F.struct(*[v.alias(k) for k, v in meta.items()], F.count("*").alias("row_count"), rows.alias("rows"))
    return df.agg(F.to_json(body).alias("document"))


def report_document(
    fact: DataFrame, low: int, high: int, description: str, now: datetime, source: str, n: int = 50
) -> DataFrame:
    """The first ``n`` rows of a date_key range by date and zone, as one document."""
    order = ["date_key", "pickup_zone_id", "payment_id"]
    rows = top_n(fact.filter(F.col("date_key").between(low, high)), order, n)
    meta = {
        "generated_at_utc": F.lit(now.isoformat()),
        "source": F.lit(source),
        "period_description": F.lit(description),
    }
    return envelope(rows, meta, order, ["date_key", "pickup_zone_id", "trip_count", "total_revenue_usd"])


def export_rows(
    joined: DataFrame, run_id: str, chunk: tuple[datetime, datetime], source_start: datetime, now: datetime
) -> DataFrame:
    """The staged export log: weather and trips with remapped times."""
    return joined.select(
        F.lit(run_id).alias("run_id"),
        F.col("src_ts_utc").alias("source_ts_utc"),
        remap("src_ts_utc", chunk, source_start, now).alias("dest_ts_utc"),
        "date_key",
        "hour",
        "temp_c",
        "feels_like_c",
        "precipitation_mm",
        "wind_speed_kmh",
        "humidity",
        "is_rainy",
        "condition",
        "weather_code",
        "trip_count",
        "revenue_usd",
        F.lit(now).alias("written_at_utc"),
    )


def timeseries_records(rows: DataFrame, location: str = "nyc", measurement: str = "nyc_hourly") -> DataFrame:
    """Tags, numeric fields (flags as 0 or 1) and a time per row."""
    fields = [
        "temp_c",
        "feels_like_c",
        "precipitation_mm",
        "wind_speed_kmh",
        "humidity",
        F.col("is_rainy").cast("int").alias("is_rainy"),
        "trip_count",
        "revenue_usd",
    ]
    return rows.select(
        F.lit(measurement).alias("measurement"),
        F.create_map(F.lit("location"), F.lit(location), F.lit("condition"), F.col("condition")).alias("tags"),
        F.struct(*fields).alias("fields"),
        F.col("dest_ts_utc").alias("time"),
    )
