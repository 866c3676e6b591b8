"""Expectation checks: one pass per table, one row per check."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


class Check(NamedTuple):
    """``bad`` marks an unexpected value, ``evaluated`` a value that was tested, ``value`` is what a report can show."""

    label: str
    bad: Column
    evaluated: Column
    value: Column | None = None


def between(
    label: str, col: str, low: float | None = None, high: float | None = None, strict_min: bool = False
) -> Check:
    """Range check, either end open; nulls are not evaluated."""
    c, parts = F.col(col), []
    if low is not None:
        parts.append(c <= low if strict_min else c < low)
    if high is not None:
        parts.append(c > high)
    return Check(label, reduce(lambda a, b: a | b, parts, F.lit(False)), c.isNotNull(), c)


def not_null(label: str, col: str) -> Check:
    return Check(label, F.col(col).isNull(), F.lit(True))


def in_set(label: str, col: str, values: list) -> Check:
    """Membership check; nulls are not evaluated."""
    return Check(label, ~F.col(col).isin(values), F.col(col).isNotNull(), F.col(col))


# Parameters that may occur.
KNOWN_PARAMETERS = ["pm25", "no2", "o3", "co", "pm10", "pm1", "so2", "no", "nox", "temperature", "relativehumidity", "um003"]


# Labels, columns and bounds of the checks.
def standard_checks() -> dict[str, list[Check]]:
    """The checks of the six silver tables."""
    value, known = between("value >= 0", "value", 0), in_set("parameter in known set", "parameter", KNOWN_PARAMETERS)
    sensor = not_null("sensor_id not null", "sensor_id")
    return {
        "taxi_trips": [
            between("passenger_count between 1 and 6", "passenger_count", 1, 6),
            between("fare_amount >= 0", "fare_amount", 0),
            between("total_amount >= 0", "total_amount", 0),
            between("trip_distance between 0.01 and 100", "trip_distance", 0.01, 100),
            not_null("pulocationid not null", "pulocationid"),
            not_null("dolocationid not null", "dolocationid"),
            between("trip_duration_min between 1 and 720", "trip_duration_min", 1, 720),
            in_set("payment_type in known set", "payment_type", [1, 2, 3, 4, 5, 6]),
        ],
        "openaq_measurements": [
            value,
            between("coverage_pct >= 75", "coverage_pct", 75, 100),
            sensor,
            not_null("measurement_date not null", "measurement_date"),
            known,
        ],
        "openaq_measurements_hourly": [value, between("hour_utc between 0 and 23", "hour_utc", 0, 23), sensor, known],
        "fx_daily": [
            between("rate > 0", "rate", 0, strict_min=True),
            not_null("rate_date not null", "rate_date"),
            in_set("from_currency in set", "from_currency", ["USD"]),
            in_set("to_currency in set", "to_currency", ["EUR"]),
        ],
        "gdp_yearly": [
            between("gdp_usd > 0", "gdp_usd", 0, strict_min=True),
            not_null("year not null", "year"),
            not_null("country_code not null", "country_code"),
        ],
        "openaq_sensor_zones": [sensor],
    }


#: Different bad values that a check keeps count of, so that the most frequent ones come out.
TRACKED = 1000


def dq_run(df: DataFrame, table: str, checks: list[Check], top: int = 0) -> DataFrame:
    """Results of all checks from a single aggregation over ``df``.

    The percentage is over evaluated values, null when there are none. With
    ``top``, ``unexpected_values`` holds the most frequent bad values as
    (value, times), most frequent first and ties by value: from a sketch of
    bounded size in the same aggregation, exact while a check meets at most
    ``TRACKED`` different ones, and null where a check has no value to show.
    """
    counts = [F.count("*").alias("row_count")]
    for i, check in enumerate(checks):
        counts.append(F.count_if(check.evaluated & check.bad).alias(f"bad_{i}"))
        counts.append(F.count_if(check.evaluated).alias(f"seen_{i}"))
        if top and check.value is not None:
            shown = F.when(check.evaluated & check.bad, check.value.cast("string"))
            counts.append(F.call_function("approx_top_k", shown, F.lit(TRACKED // 2), F.lit(TRACKED)).alias(f"top_{i}"))
    passed = reduce(lambda a, b: a & b, [F.col(f"bad_{i}") == 0 for i in range(len(checks))], F.lit(True))
    rows = [
        F.struct(
            F.lit(i + 1).alias("check_no"),
            F.lit(check.label).alias("label"),
            (F.col(f"bad_{i}") == 0).alias("success"),
            F.col(f"bad_{i}").alias("unexpected_count"),
            F.try_divide(F.col(f"bad_{i}") * 100.0, F.col(f"seen_{i}")).alias("unexpected_percent"),
            *([_most_frequent(i, check, top).alias("unexpected_values")] if top else []),
        )
        for i, check in enumerate(checks)
    ]
    return df.agg(*counts).select(
        F.lit(table).alias("table_name"), "row_count", passed.alias("overall_success"), F.inline(F.array(*rows))
    )


def _most_frequent(i: int, check: Check, top: int) -> Column:
    kind = "array<struct<value: string, times: bigint>>"
    if check.value is None:
        return F.lit(None).cast(kind)
    real = F.filter(f"top_{i}", lambda x: x["item"].isNotNull())
    ordered = F.array_sort(F.transform(real, lambda x: F.struct((-x["count"]).alias("n"), x["item"].alias("value"))))
    return F.slice(F.transform(ordered, lambda x: F.struct(x["value"].alias("value"), (-x["n"]).alias("times"))), 1, top).cast(kind)


def dq_run_all(tables: dict[str, DataFrame], checks: dict[str, list[Check]], top: int = 0) -> DataFrame:
    return reduce(DataFrame.unionByName, [dq_run(df, name, checks[name], top) for name, df in tables.items()])


# The texts of the report.
def dq_report(results: DataFrame) -> DataFrame:
    """A text block per table; a group holds as many rows as the table has checks."""
    detail = F.when(
        ~F.col("success"),
        F.format_string(" - %d bad (%.2f%%)", F.col("unexpected_count"), F.col("unexpected_percent")),
    ).otherwise("")
    line = F.concat(F.lit("  "), F.when(F.col("success"), "✓").otherwise("✗"), F.lit(" "), "label", detail)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("check_no", line.alias("line")))), lambda s: s.line)
    head = F.concat(
        F.when(F.every("success"), "✅ ").otherwise("⚠️ "),
        F.upper("table_name"),
        F.format_string(" (%d/%d checks, ", F.count_if("success"), F.count("*")),
        F.format_number(F.max("row_count"), 0),
        F.lit(" rows)"),
    )
    return results.groupBy("table_name").agg(F.concat_ws("\n", head, lines).alias("block"))


def dq_footer(results: DataFrame) -> DataFrame:
    """One line over all tables."""
    passed, total = F.count_if("success"), F.count("*")
    status = F.when(passed == total, "ALL PASSED").otherwise("FAILURES DETECTED")
    return results.agg(F.concat(F.format_string("OVERALL: %d/%d - ", passed, total), status).alias("footer"))
