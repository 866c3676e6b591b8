"""Components of the Jaccard join against all pairs in plain Python."""

import random
import re
import time

from urbanlake.llm import ngram_join, vectors
from urbanlake.llm.common import QUERIES

SCHEMA = "doc_id long, text string, size string"


def sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3)) or frozenset([tuple(words)])


def plain(rows):
    all_ = [(i, sets(t)) for i, t in rows]
    top = list(range(len(all_)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for x, (_, a) in enumerate(all_):
        for y in range(x):
            b = all_[y][1]
            if a and b and 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b)) and 100 * len(a & b) >= 85 * len(a | b):
                top[find(x)] = find(y)
    low = {}
    for x, (i, _) in enumerate(all_):
        low[find(x)] = min(i, low.get(find(x), i))
    return sorted((i, len(s), low[find(x)]) for x, (i, s) in enumerate(all_))


def check(spark, rows):
    got = ngram_join.join(spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == plain(rows)


def made(seed, n=160):
    """Families of texts with few and many changes, all with a common passage."""
    rng = random.Random(seed)
    word = lambda: rng.choice("alpha beta gamma delta Eps zeta eta theta".split()) + str(rng.randint(0, 40))
    passage = [word() for _ in range(30)]
    out = []
    for _ in range(n // 8):
        base = [word() for _ in range(rng.randint(4, 90))] + passage * rng.randint(0, 1)
        for _ in range(8):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = word()
            out.append(" ".join(text[rng.randint(0, 2) :]))
    rng.shuffle(out)
    return list(enumerate(out, 5))


def test_made_texts(spark):
    check(spark, made(1) + [(300, None), (301, ""), (302, " \n"), (303, "one two"), (304, "ONE  two"), (305, "one"), (306, "x" * 5000)])


def test_other_order_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    monkeypatch.setattr(ngram_join, "CHUNK", 2)
    monkeypatch.setattr(ngram_join, "NEXT", 1)
    check(spark, made(2))


def test_sets_in_steps(monkeypatch):
    import pyarrow as pa

    texts = [t for _, t in made(3)] + ["", None]
    whole = [s.tolist() for _, s in ngram_join._sets(pa.array(texts), 4)]
    monkeypatch.setattr(vectors.steps, "__defaults__", (100,))
    assert [s.tolist() for _, s in ngram_join._sets(pa.array(texts), 4)] == whole
    assert [len(s) for s in whole] == [len(sets(t)) for t in texts]


def test_repeated_rows_and_ids(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (1, "other words in this one"), (2, "a b c d e"), (None, "q r s t u")]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or 0, r.component_id or 0) for r in got)) == [(0, 0), (1, 1), (1, 1), (1, 1), (2, 1)]


def test_empty_table(spark):
    assert ngram_join.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op10_ngram_join"](spark, sf).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain(rows)


def test_many_rows_without_an_id(spark):
    """Rows without ids, or with one id, are rows like others: no text meets all of them."""
    texts = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(1500)]
    texts += [t + " more" for t in texts[:500]]
    took = []
    for ids in (range(len(texts)), [None] * len(texts), [7] * len(texts)):
        begin = time.time()
        got = ngram_join.join(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string"), n=4, percent=80).collect()
        took.append(time.time() - begin)
        assert len(got) == len(texts)
        if ids == range(len(texts)):
            assert {r.doc_id: r.component_id for r in got} == {i: i if i < 1500 else i - 1500 for i in ids}
        else:
            assert {r.component_id for r in got} == {ids[0]}
    assert max(took[1:]) < 3 * took[0] + 5


def test_equal_hashes_of_ids_lose_nothing(spark):
    """Classes are told apart by the numbers of their rows."""
    rows = [(i, f"a{i} b{i} c{i} d{i} e{i}") for i in range(60)] + [(100 + i, f"a{i} b{i} c{i} d{i} e{i}") for i in range(60)]
    got = {r.doc_id: r.component_id for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i % 100 for i, _ in rows}
