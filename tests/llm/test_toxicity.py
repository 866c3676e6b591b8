"""Held-out accuracy of the toxicity classifier, and its features against plain counting."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from urbanlake.llm import toxicity
from urbanlake.llm.common import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op6_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("doc_id", "held_out", "score", "predicted", "toxic").toPandas()
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    held = got[got["held_out"]]
    print("accuracy", (held["predicted"] == held["toxic"]).mean(), "recall", held[held["toxic"] == 1]["predicted"].mean(), "false alarms", held[held["toxic"] == 0]["predicted"].mean())
    assert (held["predicted"] == held["toxic"]).mean() > 0.97
    # About one toxic label in twenty stands at a text without any toxic word.
    assert held[held["toxic"] == 1]["predicted"].mean() > 0.85
    assert held[held["toxic"] == 0]["predicted"].mean() < 0.01


def test_class_counts(spark):
    texts = [("Some Words", 1), ("some other", 0), ("some", 1), (None, 0), ("", 0), ("some some", 0)]
    got = {r.bucket: (r.one, r.zero) for r in toxicity.class_counts(spark.createDataFrame(texts, "text string, label int")).collect()}
    want = {}
    for text, label in texts:
        held = {b for _, _, owner, found in toxicity.grams([text]) for part in found for b in part.tolist()}
        for b in held:
            one, zero = want.get(b, (0, 0))
            want[b] = (one + label, zero + 1 - label)
    assert got == want


def test_grams_do_not_cross_texts():
    together = {}
    for first, count, owner, found in toxicity.grams(["abcdef", "ghijkl", ""], width=1):
        for i in range(count):
            together[first + i] = {b for part in found for b in part[owner == i].tolist()}
    joined = {}
    for first, count, owner, found in toxicity.grams(["abcdef", "ghijkl", ""]):
        for i in range(count):
            joined[first + i] = {b for part in found for b in part[owner == i].tolist()}
    assert together == joined


def test_edges(spark, odd_texts):
    df = spark.createDataFrame(odd_texts, "doc_id long, text string").withColumn("score", F.lit("own")).withColumn("toxicity", F.lit(7))
    nothing = toxicity.fit(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.toxicity for r in toxicity.score(df, nothing).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2) for i, _ in odd_texts] + [(None, 1), (3, None), (4, 0)], "doc_id long, toxic int")
    got = toxicity.score(df.union(df), toxicity.fit(df, labels))
    assert got.count() == 2 * len(odd_texts) and got.where("toxicity between 0 and 1").count() == 2 * len(odd_texts)
    assert got.columns == ["doc_id", "text", "score", "toxicity"]
    assert toxicity.score(df.limit(0), nothing).count() == 0


def test_logistic_separates():
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 2, 400).astype(float)
    rows = np.arange(400)
    weights, bias = toxicity.logistic(rows, labels.astype(int), np.ones(400), labels, 2)
    assert weights[1] + bias > 1 and weights[0] + bias < -1
