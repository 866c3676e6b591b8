"""Removal of repeated strings against a plain dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from urbanlake.llm import suffixes
from urbanlake.llm.common import QUERIES

SCHEMA = "doc_id long, text string, kept string"


def plain(texts, window):
    seen = {}
    for t in texts:
        for i in range(len(t) - window + 1):
            w = t[i : i + window]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, int)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i + 1] += 1
                gone[i + window + 1] -= 1
        gone = np.cumsum(gone)[1:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def check(spark, texts, window=24, k=8, hot=suffixes.HOT):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.span_starts), bytes(r.kept)) for r in suffixes.remove(df, window, k, hot).collect()}
    want = plain([(t or "").encode() for t in texts], window)
    assert got == dict(enumerate(want))


def made(seed):
    random.seed(seed)
    word = lambda n: "".join(random.choices("abé ", k=n))
    passages = [word(random.randint(20, 60)) for _ in range(6)]
    return [" ".join(random.choice(passages) if random.random() < 0.3 else word(15) for _ in range(random.randint(0, 12))) for _ in range(60)]


def test_made_texts(spark, odd_texts):
    check(spark, made(1) + [None, "", "x" * 300, "ab" * 200, "short"])
    check(spark, [t for _, t in odd_texts], 200, 50)


def test_hot_anchors_are_dealt_by_windows(spark):
    check(spark, made(2) + ["z" * 90, "z" * 40], hot=2)


def test_long_texts_in_segments(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 64)
    found = suffixes._batch_anchors
    data = np.frombuffer("".join(made(3)).encode(), np.uint8)
    parts = [suffixes.anchors(data[a:b], 24, 8) for a, b in suffixes.segments(len(data), 24)]
    assert sum(len(p[0]) for p in parts) and found
    assert sum(int((p[3] - p[2] + 1).sum()) for p in parts) == len(data) - 23


@pytest.fixture
def small_segments(monkeypatch):
    """Segments and steps of 64 bytes, in the tasks too: the patched modules are sent to them by value."""
    monkeypatch.setattr(suffixes, "SEGMENT", 64)
    monkeypatch.setattr(suffixes.V.steps, "__defaults__", (64,))
    for module in (suffixes, suffixes.V):
        cloudpickle.register_pickle_by_value(module)
    yield
    for module in (suffixes, suffixes.V):
        cloudpickle.unregister_pickle_by_value(module)


def test_repeats_at_the_edges_of_segments(spark, small_segments):
    # Each repeat starts at another distance before an edge; its other occurrence is a short text of its own.
    random.seed(7)
    texts = ["".join(random.choices("abcdefgh", k=900)) for _ in range(20)]
    others = [t[64 * (1 + i % 12) - i :][: 24 + i % 5] for i, t in enumerate(texts)]
    check(spark, texts + others)
    check(spark, texts + others, hot=1)
    check(spark, ["".join(made(4)), *made(4), "ab" * 200])


def test_repeat_at_the_edge_of_a_real_segment(spark):
    text = "".join(random.Random(8).choices("abcdefghijklmnop", k=2 * suffixes.SEGMENT + 5000))
    cuts = [(suffixes.SEGMENT - 150, suffixes.SEGMENT + 199), (2 * suffixes.SEGMENT - 1, 2 * suffixes.SEGMENT + 199)]
    df = spark.createDataFrame([(0, text)] + [(i, text[a:b]) for i, (a, b) in enumerate(cuts, 1)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes - r.n_removed, list(zip(r.span_starts, r.span_ends))) for r in suffixes.remove(df, content=False).collect()}
    assert got == {0: (len(text) - sum(b - a for a, b in cuts), cuts)} | {i: (0, [(0, b - a)]) for i, (a, b) in enumerate(cuts, 1)}


def test_repeated_rows(spark):
    text = "".join(random.Random(5).choices("abcdef", k=120))
    df = spark.createDataFrame([(1, text), (1, text), (2, text[:20]), (None, "tail"), (None, None)], "doc_id long, text string")
    rows = sorted((r.doc_id or -9, r.n_bytes, r.n_removed) for r in suffixes.remove(df, 24, 8).collect())
    assert rows == [(-9, 0, 0), (-9, 4, 0), (1, 120, 120), (1, 120, 120), (2, 20, 0)]


def test_empty_table(spark):
    assert suffixes.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text")).collect()
    want = dict(zip((r.doc_id for r in docs), plain([r.text.encode() for r in docs], 200)))
    for r in QUERIES["op1_suffix_dedup"](spark, sf).collect():
        a, b, c, left = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (a, b, c, hashlib.sha256(left).hexdigest())
