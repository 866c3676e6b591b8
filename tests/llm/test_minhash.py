"""Near duplicates against all pairs, and the sketches against exact similarities."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanlake.llm import minhash

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def plain(docs, percent=85):
    """All pairs of rows; rows without an id come last."""
    sets = [shingles(t) for _, t in docs]
    up = list(range(len(docs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(((d, len(s), c := least.get(top(i)) if s else d, d == c) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=repr)


def compare(spark, docs, **settings):
    df = spark.createDataFrame(docs, SCHEMA)
    for name in ("size", "row", "bands", "node", "component", "packed", "n_shingles"):
        df = df.withColumn(name, F.lit("clash"))
    got = sorted(map(tuple, minhash.near_duplicates(df, **settings).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    assert got == plain(docs)
    return got


def edited(text, dice, share):
    words = text.split(" ")
    for _ in range(max(1, int(len(words) * share))):
        words[dice.randrange(len(words))] = f"e{dice.randrange(10**6)}"
    return " ".join(words)


def near_copies(dice, groups, size, words=150):
    out = []
    for g in range(groups):
        base = " ".join(f"w{dice.randrange(500)}" for _ in range(words))
        out += [edited(base, dice, dice.choice([0.004, 0.01, 0.014, 0.02])) for _ in range(size)]
    return [(i + 1, t) for i, t in enumerate(out)]


def test_odd_texts(spark, odd_texts):
    compare(spark, odd_texts + [(20 + i, t) for i, t in odd_texts[4:8]] + [(None, t) for _, t in odd_texts] + [(5, "Same TEXT here with five words"), (5, "quite other words under this id")])


@pytest.mark.parametrize("turns", [0, 3])
def test_near_copies(spark, monkeypatch, turns):
    monkeypatch.setattr(minhash, "TURNS", turns)
    docs = near_copies(random.Random(turns), 25, 8)
    components = {c for _, _, c, _ in compare(spark, docs)}
    assert 25 <= len(components) < len(docs) * 0.6


def test_a_large_group_is_dealt_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "TURNS", 1)
    compare(spark, near_copies(random.Random(9), 1, 300, 80))


def test_short_texts(spark):
    docs = [(i, " ".join(f"w{j}" for j in range(i % 14))) for i in range(60)]
    compare(spark, docs + [(100 + i, " ".join(f"w{j}" for j in range(1, 9 + i))) for i in range(20)])


def test_rows_without_ids(spark):
    dice = random.Random(4)
    compare(spark, [(None, t) for _, t in near_copies(dice, 20, 5)] + [(7, "a b c d e f g")] * 40)


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    compare(spark, docs)


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_odd_sketches_estimate_high_similarities(spark):
    """Over pairs at the threshold, the estimate stays far above the margin; unlike sets fall below it."""
    dice = np.random.default_rng(1)
    rows, want, unlike = [], [], []
    for size in (7, 20, 100, 700, 5000):
        for like in (0.86, 0.4):
            for _ in range(20):
                shared = round(2 * size * like / (1 + like))
                pool = dice.integers(0, 2**63, 2 * size - shared, dtype=np.uint64)
                pair = []
                for own in (pool[:size], np.concatenate([pool[:shared], pool[size:]])):
                    own = np.unique(own)
                    samples, sketch = minhash.odd_sketches(own, np.array([0]))
                    pair.append((len(own), int(samples[0]), [int(v) for v in sketch[0].view(np.int64)]))
                rows.append((len(rows), *pair))
                want.append(shared / (2 * size - shared) >= 0.85)
                unlike.append(like < 0.5 and size >= 20)
    kind = "struct<size:long,samples:long,sketch:array<long>>"
    df = spark.createDataFrame(rows, f"i int, l {kind}, r {kind}")
    got = {r.i: r.ok for r in df.select("i", minhash.likely("l", "r", 85).alias("ok")).collect()}
    assert all(got[i] for i, w in enumerate(want) if w)
    assert not any(got[i] for i, u in enumerate(unlike) if u)
    for i, x, y in rows:
        odd = sum((a ^ b & (2**64 - 1)).bit_count() for a, b in ((p & (2**64 - 1), q & (2**64 - 1)) for p, q in zip(x[2], y[2])))
        assert bool(minhash.likely_arrays(*(np.int64(v) for v in (x[0], y[0], x[1] + y[1], odd)), 85)) == got[i]


def test_sketches_lose_no_link_of_small_sets():
    """Linked sets of every size pass, alike by a hair or by much, also where one is sampled and the other is not."""
    dice = np.random.default_rng(3)
    for size in [*range(7, 60), 200, 1000, 4090, 4096]:
        for more in (0, 1, size // 20):
            for _ in range(20):
                shared = -(-85 * (2 * size + more) // 185)
                if shared > size:
                    continue
                pool = dice.integers(0, 2**63, 2 * size + more - shared, dtype=np.uint64)
                x, y = np.unique(pool[:size]), np.unique(np.concatenate([pool[:shared], pool[size:]]))
                (a, s), (b, t) = ((int(n[0]), bits[0]) for n, bits in (minhash.odd_sketches(v, np.array([0])) for v in (x, y)))
                assert minhash.likely_arrays(np.int64(len(x)), np.int64(len(y)), a + b, np.bitwise_count(s ^ t).sum(dtype=np.int64), 85), (size, more)


def test_copies_meet_few_centres(spark):
    """A group of near copies shares most bands; each copy is held against a few centres, not against one in every band."""
    docs = near_copies(random.Random(6), 1, 200, 100)
    sets = [np.unique([zlib.crc32(repr(x).encode()) for x in shingles(t)]).astype(np.uint64) for _, t in docs]
    bands = minhash.signatures(np.concatenate(sets), np.cumsum([0, *(len(s) for s in sets[:-1])])).view(np.int64)
    rows = [(i, int(b), i) for i, own in enumerate(bands) for b in own]
    entries = spark.createDataFrame(rows, "node long, band long, component long")
    for turn in range(3):
        assert minhash.centred(entries, turn).count() <= 8 * len(docs)


def test_bands_meet_at_the_threshold():
    """Sets with a similarity of 0.85 share a band: a miss is expected once in 10 ** 9 pairs."""
    dice = np.random.default_rng(2)
    for _ in range(300):
        pool = dice.integers(0, 2**63, 100, dtype=np.uint64)
        x, y = np.unique(pool[:92]), np.unique(pool[7:])
        a, b = (minhash.signatures(s, np.array([0]))[0] for s in (x, y))
        assert (a == b).any()
