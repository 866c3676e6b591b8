"""Fixity audit against a direct comparison of records, and the query against its SQL."""

import random

from check import compare, connect
from pyspark.sql import functions as F

from urbanlake.llm import fixity

SCHEMA = "archive string, offset long, record binary"


def test_audit_finds_exactly_the_differences(spark):
    rng = random.Random(4)
    left = [(f"a{i % 3}", i * 37, bytes([rng.randrange(256)] * rng.randrange(50))) for i in range(900)] + [(None, None, None), ("a1", 5, b"same"), ("a1", 5, b"same")]
    right = [r for i, r in enumerate(left) if i % 131]
    right = [(a, o, b"changed") if i % 97 == 5 else (a, o, b) for i, (a, o, b) in enumerate(right)] + [("new", 3, b"x")]
    frames = [spark.createDataFrame(x, SCHEMA).withColumn("digest", F.lit(1)) for x in (left, right)]
    got = {(r.archive, r.offset, r.finding) for r in fixity.audit(*frames, span=64, fanout=4).collect()}
    sides = []
    for rows in (left, right):
        side = {}
        for a, o, b in rows:
            side.setdefault((a or "", -1 if o is None else o), []).append(b or b"")
        sides.append(side)
    want = {(*k, "missing" if k not in sides[1] else "extra" if k not in sides[0] else "altered") for k in sides[0] | sides[1] if sorted(sides[0].get(k, [])) != sorted(sides[1].get(k, []))}
    assert got == want


def test_equal_and_empty_replicas(spark):
    one = spark.createDataFrame([("a", 0, b"x"), ("a", 1, b"y")], SCHEMA)
    assert fixity.audit(one, one).count() == 0
    assert fixity.audit(one.limit(0), one.limit(0)).count() == 0
    assert {r.finding for r in fixity.audit(one, one.limit(0)).collect()} == {"missing"}


def test_record_bytes(spark):
    pages = spark.createDataFrame([(1, "u", "é"), (2, None, None), (None, "v", "x")], "page_id long, url string, html string")
    records = {r.page_id: bytes(r.record) for r in fixity.archives(pages).collect()}
    assert b"Content-Length: 2\r\n\r\n\xc3\xa9\r\n\r\n" in records[1] and records[2].endswith(b"Content-Length: 0\r\n\r\n\r\n\r\n") and None in records


def test_query(spark):
    con = connect("/root/testdata/sf0.1")
    assert compare(spark, con, "/root/testdata/sf0.1", "op5_fixity_audit")[0] == "ok"
