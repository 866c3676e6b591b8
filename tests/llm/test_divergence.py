"""The divergence audit against a plain Python version, and the skyband against its definition."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from urbanlake.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def plain(docs, least, k=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, holders, groups = {}, Counter(), set()
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        counts.setdefault((lang, source), Counter()).update(terms)
        holders.update((lang, t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted((t for (x, t), n in holders.items() if x == lang and n >= least), key=lambda t: t.encode())
        own = {s: counts[(x, s)] for x, s in groups if x == lang}

        def shares(c):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(sum(own.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                found = found if part == "pair" else found[:k]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def compare(spark, docs, least, k=10):
    df = spark.createDataFrame(docs, SCHEMA)
    for name in ("term", "n", "terms", "total", "part", "item", "value", "rank", "chunk"):
        df = df.withColumn(name, F.lit("clash"))
    got = sorted(tuple(r) for r in divergence.audit(df, least, k).select(COLUMNS).collect())
    assert got == plain(docs, least, k)
    return got


def test_odd_rows(spark, odd_texts):
    langs, sources = ["en", "de", None, ""], ["a", "b", None, "ä", "c"]
    docs = [(i, t, langs[i % 4], sources[i % 5]) for i, t in odd_texts] + [(None, "Some same WORDS here", "en", "a")] * 4 + [(99, None, "only", "x"), (99, "alone", "bare", "y")]
    got = compare(spark, docs, 2)
    assert {r[0] for r in got} >= {"en", "de", ""}
    assert compare(spark, docs, 1)


def test_language_without_kept_terms(spark):
    docs = [(1, "one two", "en", "a"), (2, "three", "en", "b"), (3, None, "en", None)]
    got = compare(spark, docs, 5)
    assert [r[2:] for r in got if r[1] == "a"] == [("pair", "", 0, 1), ("pair", "b", 0, 2)]


def test_random_counts_and_ties(spark):
    dice = random.Random(3)
    terms = ["x" * i + c for i in range(9) for c in "aézß字"]
    docs = [(i, " ".join(dice.choice(terms[: 5 + i % 40]) for _ in range(dice.randrange(60))), "en", f"s{i % 7}") for i in range(300)]
    compare(spark, docs, 10)
    compare(spark, docs, 10, k=3)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_skyband_is_its_definition(spark):
    dice = random.Random(5)
    rows = [("en", s, f"t{i:04d}", dice.randrange(40), dice.randrange(40)) for s in "ab" for i in range(900)]
    df = spark.createDataFrame(rows, "lang string, source string, term string, n long, lang_n long").coalesce(1)
    got = {(r.source, r.term) for r in divergence.skyband(df, 3).collect()}
    want = {(s, t) for _, s, t, n, m in rows if sum(n2 >= n and m2 <= m for _, s2, t2, n2, m2 in rows if s2 == s and t2 < t) < 3}
    assert got == want and len(got) < len(rows) / 4


def test_shares_of_large_counts_are_exact(spark):
    for n, total, terms in ((10**13, 10**14, 10**9), (0, 0, 1), (7, 10**14 + 7, 123456)):
        want = 1 + 10**9 * (n + 2) // (total + 2 * terms)
        row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms))).first()
        assert row[0] == want == int(divergence.shares_of(*(divergence.np.array([x], "int64") for x in (n, total)), terms)[0])
