"""Quality rules against a plain Python version."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from urbanlake.llm import rules
from urbanlake.llm.common import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, at = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for starts in seen.values():
        if len(starts) > 1:
            at.update(j for i in starts for j in range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(at), n < 20 or 100 * len(at) > 30 * n)


def compare(spark, df):
    got = rules.judge(rules.measures(df))
    for r in got.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(r.text), r.doc_id
        assert not (r.base_failed and r.kept)
        assert 0 <= r.quality <= 1
    return got


def test_odd_texts(spark, odd_texts):
    df = spark.createDataFrame(odd_texts + odd_texts[:3], SCHEMA).withColumn("n_lines_", F.lit(1))
    assert compare(spark, df).count() == len(odd_texts) + 3


def test_given_documents(spark):
    compare(spark, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))


def test_columns_named_like_measures_give_way(spark, odd_texts):
    df = spark.createDataFrame(odd_texts, SCHEMA)
    for name in ("n_words", "N_LINES", "quality", "kept", "base_failed", "own"):
        df = df.withColumn(name, F.lit("clash"))
    got = compare(spark, df)
    assert got.columns.count("n_words") == 1 and "own" in got.columns


def plain_fit(patterns, rules_, start, rounds=400):
    """Expectation-maximisation with prior beliefs, document by document: the posterior of the good class by pattern."""
    docs = [v for v, n in patterns.items() for _ in range(n)]
    good = [0.1 if start(v) else 0.95 for v in docs]
    for _ in range(rounds):
        n = len(docs)
        prior = (sum(good) + 1 + 0.9 * n) / (2 * n + 2)
        odds = {v: math.log(prior / (1 - prior)) for v in patterns}
        for i in range(rules_):
            cast = [(v[i], g) for v, g in zip(docs, good) if v[i]]
            p = (sum(g for x, g in cast if x < 0) + 0.001 + 0.01 * n) / (sum(g for _, g in cast) + 0.002 + n)
            q = (sum(1 - g for x, g in cast if x < 0) + 1) / (sum(1 - g for _, g in cast) + 2)
            q = max(q, min(2 * p, (1 + p) / 2))
            for v in odds:
                given = math.log(p / q) if v[i] < 0 else math.log((1 - p) / (1 - q)) if v[i] else 0.0
                odds[v] += max(-math.log(1000), min(math.log(1000), given))
        post = {v: 1 / (1 + math.exp(-x)) for v, x in odds.items()}
        if max(abs(post[v] - g) for v, g in zip(docs, good)) < 1e-7:
            break
        good = [post[v] for v in docs]
    return post


@pytest.mark.parametrize("share", [0.02, 0.15, 0.4])
def test_fit_equals_plain_expectation_maximisation(share):
    dice = random.Random(8)
    patterns = {}
    for _ in range(1500):
        bad = dice.random() < share
        vote = tuple(0 if dice.random() < 0.2 else -1 if dice.random() < ((0.7, 0.6, 0.2, 0.5, 0.1) if bad else (0.02, 0.05, 0.01, 0.1, 0.1))[i] else 1 for i in range(5))
        patterns[vote] = patterns.get(vote, 0) + 1
    model = rules.fit(patterns, 5)
    got = {v: 1 / (1 + math.exp(-rules._log_odds(model, v))) for v in patterns}
    wants = [plain_fit(patterns, 5, start) for start in (lambda v: -1 in v, lambda v: v.count(-1) >= 2, lambda v: sum(v) <= 0)]
    assert min(max(abs(got[v] - want[v]) for v in want) for want in wants) < 1e-3


def test_posterior_column_is_the_model(spark):
    model = rules.Model(0.8, [(0.01, 0.3), (0.02, 0.05)])
    df = spark.createDataFrame([(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)], "a int, b int")
    for r in df.select("*", model.posterior(["a", "b"]).alias("p")).collect():
        assert r.p == pytest.approx(1 / (1 + math.exp(-rules._log_odds(model, (r.a, r.b)))))


def test_rules_that_see_the_same_are_not_taken_for_the_class():
    """Repeated lines and words go together in good documents; symbols stand alone in bad ones."""
    patterns = {(1, 1, 1, 1): 900, (-1, 1, 1, 1): 70, (1, -1, 0, 1): 6, (1, 0, -1, 1): 6, (1, 0, 0, 1): 30, (-1, 0, 0, 0): 5}
    for scale in (1, 100):
        model = rules.fit({v: n * scale for v, n in patterns.items()}, 4)
        good = {v: rules._log_odds(model, v) > 0 for v in patterns}
        assert good == {v: v[0] == 1 for v in patterns}


def test_no_documents():
    assert rules.fit({}, 3).prior == 0.5


def test_votes_are_bounded():
    """A vote's odds are bounded, an abstention has none."""
    model = rules.Model(0.9, [(1e-9, 0.999), (0.02, 0.04)])
    assert model.odds(0, 0) == 0 and model.odds(0, -1) == -math.log(1000)
    assert model.odds(1, -1) == pytest.approx(-math.log(2)) and model.odds(1, 1) > 0


def test_posterior_finds_labelled_junk(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    got = QUERIES["op4_quality_rules"](spark, sf).join(labels, "doc_id").groupBy("label").agg(F.avg(F.col("kept").cast("int")).alias("share"))
    share = {r.label: r.share for r in got.collect()}
    assert share[1] > 0.97
    assert share[0] < 0.2


def test_posterior_at_a_larger_scale(spark):
    """At sf0.1 the base alone fails 3 percent of the good documents; of those that pass it the same bars hold."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    got = QUERIES["op4_quality_rules"](spark, sf).join(labels, "doc_id").where("not base_failed")
    share = {r.label: r.share for r in got.groupBy("label").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.97
    assert share[0] < 0.2
