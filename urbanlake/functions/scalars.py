"""Small scalar rules shared by several tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Weather codes (first, last, label).
WEATHER_BANDS = [
    (0, 0, "clear"),
    (1, 3, "partly_cloudy"),
    (40, 49, "fog"),
    (50, 67, "rain"),
    (70, 77, "snow"),
    (80, 82, "showers"),
    (95, 99, "thunderstorm"),
]


def weather_condition(code: Column) -> Column:
    """Label of a weather code; 'unknown' for null, 'other' outside every band."""
    start = F.when(code.isNull(), "unknown")
    return reduce(lambda c, b: c.when(code.between(b[0], b[1]), b[2]), WEATHER_BANDS, start).otherwise("other")


def rain_flag(precipitation: Column) -> Column:
    return F.coalesce(precipitation, F.lit(0.0)) > 0.1


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def falsy_default(value: Column, fallback: Column) -> Column:
    """``fallback`` where ``value`` is null or zero."""
    return F.when(value.isNull() | (value == 0), fallback).otherwise(value)


def rate_decimal(value: Column) -> Column:
    return value.try_cast("decimal(18,6)")


def money_decimal(value: Column) -> Column:
    return value.try_cast("decimal(20,2)")
