import json
from datetime import datetime

import pytest

from tests.conftest import rows
from urbanlake.functions.dates import date_dimension
from urbanlake.operators import dims, export, joins, measures, quality, reports
from urbanlake.operators.measures import measure

TAXI = (
    "date_key int, pickup_zone_id int, payment_id int, trip_count bigint, total_fare_usd double, total_revenue_usd double, "
    "total_distance_miles double, avg_trip_duration_min double, total_passengers bigint"
)


@pytest.fixture
def model(spark):
    taxi = [
        (20230101, 1, 1, 10, 90.0, 100.0, 5.0, 10.0, 11),
        (20230102, 1, 1, 30, 80.0, 300.0, 5.0, 20.0, 31),
        (20240101, 2, 2, 0, 0.0, 0.0, 0.0, 0.0, 0),
        (20240102, 2, None, 1, 1.0, 7.0, 1.0, 1.0, 1),
    ]
    fx = [(20230101, 1, 2, 0.5), (20230102, 1, 2, 0.25), (20230102, 2, 1, 9.0), (20240101, None, 2, 8.0)]
    air = [(1, 20230101, 2, 4.0, 1), (1, 20230102, 2, 8.0, 3), (3, 20240101, 7, None, 1)]
    zones = [(1, "Queens", "A", "x"), (2, "Bronx", "B", "y"), (3, "Bronx", "C", "y")]
    return {
        "fct_taxi_daily": spark.createDataFrame(taxi, TAXI),
        "fct_fx_daily": spark.createDataFrame(fx, "date_key int, id_cur_from int, id_cur_to int, rate double"),
        "fct_air_quality": spark.createDataFrame(air, "zone_id int, date_key int, p_id int, avg_value double, sensor_count bigint"),
        "fct_gdp_yearly": spark.createDataFrame([(2023, "USA", 5.0), (2022, "USA", 4.0)], "year bigint, country_code string, gdp_usd double"),
        "dm_zone": spark.createDataFrame(zones, "zone_id int, borough string, zone_name string, service_zone string"),
        "dm_date": date_dimension(spark),
        "dm_payment": dims.payments(spark),
        "dm_currency": dims.currencies(spark),
        "dm_air_measurement": dims.parameters(spark),
    }


def test_totals(model):
    names = ["trips", "revenue_usd", "revenue_eur", "avg_trip_duration", "zones_with_sensors", "eur_rate", "avg_pollution"]
    got = measure(names, model).first()
    assert tuple(got) == (41, 407.0, 100 * 0.5 + 300 * 0.25, (100.0 + 600.0 + 1.0) / 41, 1, 0.375, 6.0)


def test_groups_and_blanks(model):
    got = rows(measure(["avg_revenue_per_trip_usd", "avg_revenue_per_trip_eur", "revenue_eur_div"], model, ["dm_date.year"]))
    assert got == [(2023, 10.0, 125.0 / 40, 400.0 / 0.375), (2024, 7.0, None, None)]
    assert rows(measure("trips", model, ["dm_payment.payment_type"])) == sorted([("Cash", 0), ("Credit card", 40), (None, 1)], key=repr)
    assert rows(measure("avg_revenue_per_trip_usd", model, ["dm_date.date_key"], {"dm_zone.borough": ["Bronx"]})) == [
        (20240101, None),
        (20240102, 7.0),
    ]


def test_filters(model):
    assert measure("trips", model, filters={"dm_zone.borough": ["Queens"], "dm_date.year_month": ["2023-01"]}).first()[0] == 40
    assert measure("avg_pollution", model, filters={"dm_payment.payment_type": ["Cash"]}).first()[0] == 6.0
    assert measure("trips", model, filters={"dm_zone.zone_id": [2]}).first()[0] == 1


def test_currencies(model):
    by, to = ["dm_currency.currency_name"], [("fct_fx_daily", "dm_currency")]
    assert rows(measure("eur_rate", model, by)) == [("USD", 0.375)]
    assert rows(measure("eur_rate", model, by, inactive=to)) == [("EUR", 0.375)]
    assert measure("eur_rate", model, filters={"dm_currency.currency_name": ["EUR"]}).first()[0] is None
    assert measure("eur_rate", model, filters={"dm_currency.currency_name": ["EUR"]}, inactive=to).first()[0] == 0.375
    assert measure("revenue_eur", model, filters={"dm_currency.currency_name": ["EUR"]}).first()[0] is None
    with pytest.raises(ValueError):
        measure("revenue_eur", model, by)


def test_unrelated_dimension_repeats_the_value(model):
    assert rows(measure("avg_pollution", model, ["dm_payment.payment_type"], {"dm_payment.id": [1, 2]})) == [("Cash", 6.0), ("Credit card", 6.0)]
    got = rows(measure("revenue_eur_div", model, ["dm_zone.zone_id", "dm_date.year"]))
    assert got == [(1, 2023, 400.0 / 0.375), (2, 2023, None), (2, 2024, None), (3, 2023, None)]


def test_repeated_values_are_bounded(model, monkeypatch):
    monkeypatch.setattr(measures, "MOST_REPEATED", 2)
    assert len(rows(measure("avg_pollution", model, ["dm_payment.payment_type"], {"dm_payment.id": [1, 2]}))) == 2
    with pytest.raises(Exception, match="more than 2 values"):
        measure("avg_pollution", model, ["dm_payment.payment_type"]).collect()
    with pytest.raises(ValueError, match="one such dimension"):
        measure("avg_pollution", model, ["dm_payment.payment_type", "dm_currency.currency_name"])


def test_rows_of_unknown_parameters_keep_a_column(spark, model):
    air = model["fct_air_quality"].unionByName(spark.createDataFrame([(1, 20230103, None, 5.0, 9), (1, 20230103, 99, 5.0, 4)], model["fct_air_quality"].schema))
    matrix = {r.zone_id: r for r in reports.report("coverage_matrix", {**model, "fct_air_quality": air}).collect()}
    assert matrix[1][reports.UNKNOWN] == 13 and matrix[3][reports.UNKNOWN] is None and matrix[1].pm25 == 4


def test_what_relationships_find(spark, model):
    related = {"dm_date": ("date_key", "date_key"), "dm_currency": ("id_cur_from", "id"), "dm_currency:to": ("id_cur_to", "id")}
    got = joins.relationship_counts("fx", model["fct_fx_daily"], model, related)
    assert rows(got) == sorted([("fx", "dm_date", "date_key", 4, 0), ("fx", "dm_currency", "id_cur_from", 3, 1), ("fx", "dm_currency", "id_cur_to", 4, 0)], key=repr)


def test_most_frequent_bad_values(spark):
    df = spark.createDataFrame([(x,) for x in [7, 7, 8, 8, 9, 1, None, None]], "n int")
    checks = [quality.between("n", "n", 1, 6), quality.not_null("n not null", "n"), quality.in_set("n in set", "n", [1, 7, 8, 9])]
    got = {r.label: r.unexpected_values for r in quality.dq_run(df, "t", checks, top=2).collect()}
    assert got["n"] == [("7", 2), ("8", 2)] and got["n not null"] is None and got["n in set"] == []
    assert "unexpected_values" not in quality.dq_run(df, "t", checks).columns


def test_gdp_is_filtered_not_multiplied(model):
    assert rows(measure("gdp_usd", model, ["dm_date.year"])) == [(2022, 4.0), (2023, 5.0)]
    by_month = rows(measure("gdp_usd", model, ["dm_date.year_month"], {"dm_date.year": [2023]}))
    assert len(by_month) == 12 and {r[1] for r in by_month} == {5.0}
    assert measure("gdp_usd", model, filters={"dm_date.month": [1, 2, 3]}).first()[0] == 9.0


def test_reports(model):
    assert rows(reports.report("long_term", model)) == [(2022, None, None, 4.0), (2023, 40, 6.0, 5.0), (2024, 1, None, None)]
    matrix = {r.zone_id: (r.pm25, r.no2, r.co) for r in reports.report("coverage_matrix", model).collect()}
    assert matrix == {1: (4, None, None), 3: (None, 1, None)}
    assert tuple(reports.report("overview", model).first()) == (41, 407.0, 1)
    points = reports.report("correlation", model).first()
    assert (points.zone_id, points.points) == (1, 2) and abs(points.pearson - 1.0) < 1e-12


def test_star_join_keeps_facts_without_a_dimension(model):
    related = {"dm_payment": ("payment_id", "id"), "dm_zone": ("pickup_zone_id", "zone_id")}
    wide = joins.star_join(model["fct_taxi_daily"], model, related)
    assert wide.count() == 4 and wide.filter("dm_payment_payment_type IS NULL").count() == 1


def test_report_document(spark, model):
    doc = export.report_document(model["fct_taxi_daily"], 20230101, 20241231, "all", datetime(2025, 1, 1), "fct", n=3).first()[0]
    body = json.loads(doc)
    assert body["row_count"] == 3 and [r["date_key"] for r in body["rows"]] == [20230101, 20230102, 20240101]
    assert set(body) == {"generated_at_utc", "source", "period_description", "row_count", "rows"}
    empty = export.report_document(model["fct_taxi_daily"], 1, 2, "none", datetime(2025, 1, 1), "fct").first()[0]
    assert json.loads(empty)["rows"] == []


def test_quality(spark):
    df = spark.createDataFrame([(0.0, "a"), (1.0, None), (None, "b"), (2.0, "a")], "v double, s string")
    checks = [
        quality.between("min", "v", 0),
        quality.between("strict", "v", 0, strict_min=True),
        quality.between("range", "v", 0, 1),
        quality.not_null("null", "v"),
        quality.in_set("set", "s", ["a"]),
    ]
    got = quality.dq_run(df, "t", checks)
    assert rows(got, "check_no", "success", "unexpected_count") == [(1, True, 0), (2, False, 1), (3, False, 1), (4, False, 1), (5, False, 1)]
    percent = {r.label: r.unexpected_percent for r in got.collect()}
    assert percent["strict"] == pytest.approx(100 / 3) and percent["null"] == 25.0 and percent["set"] == pytest.approx(100 / 3)
    block = quality.dq_report(got).first().block.split("\n")
    assert block[0] == "⚠️ T (1/5 checks, 4 rows)" and block[2] == "  ✗ strict - 1 bad (33.33%)" and block[1] == "  ✓ min"
    assert quality.dq_footer(got).first()[0] == "OVERALL: 1/5 - FAILURES DETECTED"


def test_quality_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    row = quality.dq_run(df, "t", [quality.between("min", "v", 0)]).first()
    assert (row.success, row.row_count, row.unexpected_count, row.unexpected_percent) == (True, 0, 0, None)


def test_standard_checks():
    assert sum(len(c) for c in quality.standard_checks().values()) == 25


def test_weather_hours_without_trips(spark):
    weather = spark.createDataFrame([(20230101, 0, 1.0), (20230101, 1, 2.0)], "date_key int, hour int, temp_c double")
    city = spark.createDataFrame([(20230101, 0, 5, 9.5)], "date_key int, hour int, trip_count bigint, total_revenue_usd double")
    assert rows(joins.weather_join(weather, city)) == [(20230101, 0, 1.0, 5, 9.5), (20230101, 1, 2.0, 0, 0.0)]

