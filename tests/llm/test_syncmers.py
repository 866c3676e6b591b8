"""Closed syncmers against their definition, and fingerprints of edited texts."""

import hashlib
import random

import numpy as np
import zstandard
from pyspark.sql import functions as F

from urbanlake.llm import syncmers as sy
from urbanlake.llm.common import QUERIES


def plain(text, k, s):
    inner = sy._grams(sy.V.mix(np.array([ord(c) for c in text], np.uint64)), s)
    out = []
    for i in range(len(text) - k + 1):
        own = inner[i : i + k - s + 1]
        if own[0] == own.min() or own[-1] == own.min():
            out.append(i)
    return out


def test_definition():
    random.seed(2)
    texts = ["".join(random.choices("abcdé 𝔘", k=n)) for n in (0, 3, 15, 16, 17, 80, 400)]
    for text, (place, hashes) in zip(texts, sy.closed_syncmers(texts)):
        if len(text) >= sy.K:
            assert place.tolist() == (plain(text, sy.K, sy.S) or [0])
        assert len(hashes) == len(place) and (len(place) > 0) == (len(text) > 0)


def test_context_free():
    random.seed(3)
    passage = "".join(random.choices("abcdefgh ", k=300))
    (a, h), (b, g) = sy.closed_syncmers([passage, "xyz" + passage + "tail"])
    inside = (b >= 3) & (b <= 3 + 300 - sy.K)
    assert (b[inside] - 3).tolist() == a.tolist() and (g[inside] == h).all()


def test_likeness():
    random.seed(4)
    text = "".join(random.choices("abcdefghijk ", k=3000))
    other = "".join(random.choices("abcdefghijk ", k=3000))
    own, near, far = (sy.fingerprint(*sy.closed_syncmers([t])[0]) for t in (text, text[:1500] + other[1500:], other))
    assert sy.likeness(own, own) == 1 and 0.2 < sy.likeness(own, near) < 0.5 and sy.likeness(own, far) < 0.05
    none = sy.fingerprint(*sy.closed_syncmers([""])[0])
    assert sy.likeness(none, none) == 1 and sy.likeness(none, own) == 0


def test_fingerprints_grow_with_the_text():
    random.seed(5)
    made = lambda n: "".join(random.choices("abcdefghijk ", k=n))
    passage, text = made(600), made(120000)
    others = [passage.join([made(60000), made(60000)]) for _ in range(2)]
    ((_, hashes),) = sy.closed_syncmers([text])
    every = np.unique((hashes >> np.uint64(32)).astype(np.uint32))
    own, a, b = (sy.fingerprint(*sy.closed_syncmers([t])[0]) for t in (text, *others))
    assert len(own) > 10 * sy.SKETCH and own["hash"].tolist() == every[every < sy.LIMIT].tolist()
    assert 0.001 < sy.likeness(a, b) < 0.01 and sy.likeness(a, a) == 1
    half = sy.fingerprint(*sy.closed_syncmers([text[:60000] + made(60000)])[0])
    assert abs(sy.likeness(own, half) - 1 / 3) < 0.04


def test_next(spark):
    rows = [(i * 7 % 101, f"t{i}") for i in range(101)] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    read = lambda x: zstandard.ZstdDecompressor().decompress(x).decode()
    got = {(r.doc_id, read(r.packed)): read(r.next_packed) for r in sy.with_next(df).collect()}
    order = [(i, t or "") for i, t in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))]
    assert got == {a: b[1] for a, b in zip(order, order[1:] + order[:1])}
    assert sy.with_next(df.limit(0)).count() == 0
    assert sy.with_next(df.union(df)).count() == 2 * len(rows)
    one = sy.with_next(df.limit(1)).first()
    assert one.packed == one.next_packed


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()), reverse=True)
    rows = {r.doc_id: r for r in QUERIES["op8_syncmers"](spark, sf).collect()}
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = rows[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other, follow = (sy.fingerprint(*x) for x in sy.closed_syncmers([text, edited, after]))
        assert r.fingerprint == own.tobytes().hex() and r.edited_fingerprint == other.tobytes().hex()
        assert r.near_edited == sy.likeness(own, other) and r.near_next == sy.likeness(own, follow)


def test_columns_and_nulls(spark, odd_texts):
    df = spark.createDataFrame(odd_texts + odd_texts[:2], "doc_id long, text string").withColumn("fingerprint", F.lit(1))
    got = sy.fingerprints(df).collect()
    assert len(got) == len(odd_texts) + 2
    assert {r.fingerprint for r in got if not r.text} == {""}
    assert sy.anchors(df).where("size(anchors) > 0").count() == df.where("length(text) > 0").count()
