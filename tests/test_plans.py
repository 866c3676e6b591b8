"""What reaches the scan, and how rows move."""

from functools import partial

import __spark_entry__ as entry
from tests.conftest import plan
from urbanlake.operators import clean, facts, merge
from urbanlake.queries import QUERIES, bindings as b

SF = "/root/testdata/sf0.001"


def test_filters_reach_the_scan(spark):
    events = b.table(spark, SF, "events")
    text = plan(clean.incremental(events, "ts", "2024-01-10 00:00:00", "2024-01-20 00:00:00").select("event_id"))
    assert "GreaterThan(ts," in text and "LessThanOrEqual(ts," in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_unchanged_types_keep_pushdown(spark):
    lines = b.table(spark, SF, "lineitem")
    normal = clean.normalize_schema(lines, {"l_quantity": "double"})
    text = plan(normal.filter("l_quantity BETWEEN 1 AND 6").select("l_orderkey"))
    assert "GreaterThanOrEqual(l_quantity,1.0)" in text and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_fact_is_one_shuffle_with_partial_aggregation(spark):
    text = plan(facts.taxi_fact(b.trips(spark, SF))).split("== Physical Plan ==")[1]
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text
    assert "l_tax" not in text


def test_refreshed_fact_needs_no_semi_join(spark):
    trips = b.trips(spark, SF)
    text = plan(merge.touched_groups(trips, partial(facts.taxi_fact, newest="loaded_at"), "loaded_at", "2002-01-01 12:00:00"))
    physical = text.split("== Physical Plan ==")[1]
    assert "Join" not in physical and physical.count("Exchange hashpartitioning") == 1


def test_required_lookup_is_an_inner_join(spark):
    text = plan(entry.queries()["join_zone_lookup"](spark, SF)).split("== Optimized Logical Plan ==")[1]
    assert "Join Inner" in text.split("== Physical Plan ==")[0]


def test_top_rows_are_taken_without_a_full_sort(spark):
    text = plan(entry.queries()["topn_report"](spark, SF))
    assert "TakeOrderedAndProject" in text


def test_latest_is_limited_before_the_shuffle(spark):
    text = plan(merge.dedupe_latest(b.table(spark, SF, "events"), ["user_id"], ["ts"], ["event_id"]))
    physical = text.split("== Physical Plan ==")[1]
    assert physical.index("Final") < physical.index("Exchange") < physical.index("Partial")


def test_no_query_runs_python_per_row(spark):
    for name, query in QUERIES.items():
        text = plan(query(spark, SF))
        assert "Python" not in text and "InPandas" not in text, name
