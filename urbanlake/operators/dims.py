"""Dimensions seeded from fixed lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Seeded dimension rows.
VENDORS = [(1, "Creative Mobile Technologies, LLC"), (2, "VeriFone Inc.")]
PAYMENTS = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
CURRENCIES = [(1, "USD"), (2, "EUR")]
PARAMETERS = [
    (1, "pm1", "µg/m³", "PM1"),
    (2, "pm25", "µg/m³", "PM2.5"),
    (3, "pm10", "µg/m³", "PM10"),
    (4, "relativehumidity", "%", "RH"),
    (5, "nox", "ppm", "NOx"),
    (6, "temperature", "c", "Temperature (C)"),
    (7, "no2", "ppm", "NO₂"),
    (8, "no", "ppm", "NO"),
    (9, "o3", "ppm", "O₃"),
    (10, "co", "ppm", "CO"),
    (11, "um003", "particles/cm³", "PM0.3 count"),
    (12, "so2", "ppm", "SO₂"),
]


def vendors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VENDORS, "id int, vendor_name string")


def payments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PAYMENTS, "id int, payment_type string")


def currencies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CURRENCIES, "id int, currency_name string")


def parameters(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PARAMETERS, "p_id int, p_name string, p_units string, p_display_name string")
