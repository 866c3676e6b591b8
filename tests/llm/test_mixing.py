"""Mixing: weights against direct bisection, and the block permutations' promises."""

import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from urbanlake.llm import mixing
from urbanlake.llm.common import QUERIES

SCHEMA = "doc_id long, source string, n_tokens long"


def rows(seed=0):
    sizes = {"a": 400, "b": 60, "c": 9, None: 5}
    return [(i * 10 + len(s or ""), s, 5 + (i * 7 + seed) % 40) for s, n in sizes.items() for i in range(n)]


def test_exponents(spark):
    totals = mixing.totals(spark.createDataFrame(rows(), SCHEMA))
    p = [r.tokens for r in totals.collect()]
    p = [x / sum(p) for x in p]

    def weights(a):
        w = [x**a for x in p]
        return [x / sum(w) for x in w]

    a = mixing.bisect_exponent(totals, target_entropy=0.8)
    entropy = lambda e: -sum(w * math.log(w) for w in weights(e))
    assert entropy(a) >= 0.8 * math.log(4) > entropy(a + 1e-6)
    a = mixing.bisect_exponent(totals, max_repetition=3.0)
    most = lambda e: (max(p) / min(p)) ** (1 - e)
    assert most(a) <= 3.0 + 1e-6 and most(a - 1e-6) > 3.0
    assert mixing.bisect_exponent(totals.limit(0), max_repetition=2.0) == 1.0


def test_budgets_and_epochs(spark):
    docs = spark.createDataFrame(rows(3), SCHEMA).withColumn("place", F.lit("own"))
    total = sum(r[2] for r in rows(3))
    got = mixing.mix(docs, target_entropy=0.9, budget=total, block_tokens=300).collect()
    plan = {r.source: r for r in mixing.weights(mixing.totals(docs), mixing.bisect_exponent(mixing.totals(docs), 0.9, budget=total), total).collect()}
    read, by_doc, last = Counter(), defaultdict(Counter), defaultdict(list)
    for r in got:
        read[r.source] += r.n_tokens
        by_doc[r.source][r.doc_id] += 1
        last[r.source].append(r)
    for source, p in plan.items():
        assert p.budget <= read[source] < p.budget + 45, source
        times = by_doc[source].values()
        assert max(times) - (min(times) if len(times) == p.documents else 0) <= 1
        whole = [r for r in last[source] if r.epoch < p.budget // p.tokens]
        assert Counter(r.epoch for r in whole) == {e: p.documents for e in range(p.budget // p.tokens)}


def test_empty_sources_and_tables(spark):
    docs = spark.createDataFrame([(1, "a", 0), (2, "b", 10), (2, "b", 10), (None, None, 3)], SCHEMA)
    got = Counter((r.doc_id, r.source) for r in mixing.mix(docs, max_repetition=100.0).collect())
    assert (1, "a") not in got and got[(2, "b")] == 2 and got[(None, None)] >= 1
    assert mixing.mix(docs.limit(0), max_repetition=2.0).count() == 0


def test_whole_query(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op2_mixing"](spark, sf)
    total = got.agg(F.sum("n_tokens")).first()[0]
    docs = spark.read.parquet(f"{sf}/documents.parquet").agg(F.sum(mixing.word_count())).first()[0]
    assert docs <= total <= 1.1 * docs
