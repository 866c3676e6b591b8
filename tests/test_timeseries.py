from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from urbanlake.functions import dates
from urbanlake.operators import timeseries
from urbanlake.operators.merge import upsert

D = date(2024, 1, 1)


def day(n):
    return D + timedelta(days=n)


def brute_fill(observed, last):
    """Rows (pair, day, rate, is_filled) by walking the calendar."""
    out = []
    for pair in {p for p, _ in observed}:
        known = {d: r for (p, d), r in observed.items() if p == pair}
        rate, d = None, min(known)
        while d <= last:
            rate = known.get(d, rate)
            out.append((pair, d, rate, d not in known))
            d += timedelta(days=1)
    return sorted(out, key=repr)


OBSERVED = st.dictionaries(
    st.tuples(st.sampled_from("ab"), st.integers(0, 40).map(day)), st.integers(1, 9), min_size=1, max_size=12
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(OBSERVED)
def test_fill_gaps(spark, observed):
    df = spark.createDataFrame([(p, d, r) for (p, d), r in observed.items()], "pair string, d date, rate int")
    want = brute_fill(observed, max(d for _, d in observed))
    assert rows(timeseries.fill_gaps(df, ["pair"], "d")) == want
    spine = timeseries.join_spine(timeseries.date_spine(df, "d", ["pair"]), df, ["pair", "d"])
    for block in (None, F.trunc("d", "month")):
        filled = timeseries.forward_fill(spine, ["pair"], "d", ["rate"], block).filter("rate IS NOT NULL")
        assert rows(filled, "pair", "d", "rate") == [w[:3] for w in want]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(OBSERVED, OBSERVED)
def test_fill_across_loads_equals_one_fill(spark, first, second):
    """The second load may start a pair, revise a day or fall between old days."""
    schema = "pair string, d date, rate int"
    old = spark.createDataFrame([(p, d, r) for (p, d), r in first.items()], schema)
    new = spark.createDataFrame([(p, d, r) for (p, d), r in second.items()], schema)
    silver = timeseries.fill_gaps(old, ["pair"], "d")
    merged = upsert(silver, timeseries.fill_increment(silver, new, ["pair"], "d"), ["pair", "d"])
    both = {**first, **second}
    assert rows(merged) == brute_fill(both, max(d for _, d in both))


def test_days_between_two_loads_belong_to_every_key(spark):
    schema = "pair string, d date, rate int"
    old = spark.createDataFrame([("a", day(0), 1), ("b", day(2), 2)], schema)
    new = spark.createDataFrame([("a", day(6), 3)], schema)
    silver = timeseries.fill_gaps(old, ["pair"], "d")
    merged = upsert(silver, timeseries.fill_increment(silver, new, ["pair"], "d"), ["pair", "d"])
    assert rows(merged) == brute_fill({("a", day(0)): 1, ("b", day(2)): 2, ("a", day(6)): 3}, day(6))


def test_blocks_carry_over_empty_months(spark):
    """A null key is a key like any other."""
    days = [(1, 5), (2, 5), (4, 1)]
    data = [(k, date(2024, m, d), v if (m, d) == (1, 5) else None) for k, v in (("a", 1.0), (None, 2.0)) for m, d in days]
    df = spark.createDataFrame([*data, ("b", date(2024, 4, 1), None)], "k string, d date, v double")
    got = timeseries.forward_fill(df, ["k"], "d", ["v"], F.trunc("d", "month"))
    assert rows(got, "k", "v") == sorted([*[("a", 1.0)] * 3, *[(None, 2.0)] * 3, ("b", None)], key=repr)
    text = plan(got).split("== Physical Plan ==")[1]
    # One for the rows, three for the one-row-per-block carry.
    assert text.count("Exchange hashpartitioning") == 4


def test_date_dimension(spark):
    dim = dates.date_dimension(spark)
    first, last = dim.orderBy("date").first(), dim.orderBy(F.desc("date")).first()
    assert dim.count() == 4018
    assert tuple(first) == (date(2020, 1, 1), 20200101, 2020, 1, 1, 4, "Wednesday", "January", 1, False, "2020-01")
    assert last.date == date(2030, 12, 31)


def test_months_and_templates(spark):
    got = rows(dates.months(spark, "2023-11", "2024-01", "x/{yyyy}/{mm}/t_{yyyy-mm}.parquet"))
    assert got == [
        ("2023-11", "x/2023/11/t_2023-11.parquet"),
        ("2023-12", "x/2023/12/t_2023-12.parquet"),
        ("2024-01", "x/2024/01/t_2024-01.parquet"),
    ]
    assert rows(dates.months(spark, "2024-01", "2024-01")) == [("2024-01", None)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_ts_does_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2023-01-01T23:30:00-05:00",), ("2023-01-01T00:30:00+05:30",), ("bad",), (None,)], "t string")
        got = [r[0] for r in df.select(dates.parse_ts("t")).collect()]
        assert got == [datetime(2023, 1, 2, 4, 30), datetime(2022, 12, 31, 19, 0), None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_chunks():
    start, end = datetime(2023, 1, 1), datetime(2025, 1, 1)
    assert dates.next_chunk(None, start, end) == (start, datetime(2023, 1, 8))
    assert dates.next_chunk(datetime(1900, 1, 1), start, end) == (start, datetime(2023, 1, 8))
    assert dates.next_chunk(datetime(2024, 12, 29), start, end) == (datetime(2024, 12, 29), end)
    assert dates.next_chunk(end, start, end) is None


def test_remap_of_the_short_last_chunk(spark):
    """731 days are 104 weeks and 3 days; the last chunk ends where the one before begins."""
    start, now = datetime(2023, 1, 1), datetime(2025, 6, 1, 10, 30)
    last = datetime(2024, 12, 29)
    df = spark.createDataFrame([(last,)], "t timestamp_ntz")
    got = df.select(dates.remap("t", (last, datetime(2025, 1, 1)), start, now)).first()[0]
    assert got == datetime(2025, 6, 1, 10) - timedelta(days=7 * 104 + 3)


def test_increment_prunes_older_years(spark, scratch):
    data = [("a", date(y, m, 1), float(y + m)) for y in (2020, 2021, 2022) for m in (1, 7)]
    filled = timeseries.fill_gaps(spark.createDataFrame(data, "k string, d date, v double"), ["k"], "d")
    filled.withColumn("y", F.year("d")).write.partitionBy("y").parquet(scratch + "/s")
    silver = spark.read.parquet(scratch + "/s")
    batch = spark.createDataFrame([("a", date(2022, 7, 5), 9.0), ("b", date(2022, 6, 30), 1.0)], "k string, d date, v double")
    got = timeseries.fill_increment(silver, batch, ["k"], "d", "y")
    assert rows(got) == rows(timeseries.fill_increment(silver.drop("y"), batch, ["k"], "d").select(*got.columns))
    partition_filters = [line for line in plan(got).split("\n") if "PartitionFilters" in line]
    assert any("y#" in line.split("PartitionFilters")[1] for line in partition_filters)
