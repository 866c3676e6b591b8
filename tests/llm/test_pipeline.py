"""The pipeline's stages against plain Python, each on its own input."""

import re
from collections import Counter

import corpus_pipeline as cp
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm.test_secrets import plain as plain_secrets

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for i, (_, function) in enumerate(cp.STAGES):
        function(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        seen.append(docs)
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    every, clean, single, redacted, mixed = ([tuple(r) for r in d.collect()] for d in seen)
    assert all(d.columns == cp.COLUMNS for d in seen)

    fine = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    gone = {r[0] for r in every} - {r[0] for r in clean}
    assert set(clean) <= set(every) and gone and len(gone & fine) <= 2

    sets = {r[0]: shingles(r[1]) for r in clean}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    assert sorted(single) == sorted(r for r in clean if find(r[0]) == r[0])

    texts = {r[0]: r[1] for r in redacted}
    assert {r[0] for r in redacted} == {r[0] for r in single}
    for doc, text, *_ in single:
        if plain_secrets(text):
            assert "<SECRET>" in texts[doc] and not plain_secrets(texts[doc])
        elif "<SECRET>" not in texts[doc]:
            assert texts[doc] == text

    times = Counter(r[0] for r in mixed)
    assert set(mixed) == set(redacted) and max(times.values()) <= 2
    tokens, read = Counter(), Counter()
    for r in redacted:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
        tokens[r[3]] += n
        read[r[3]] += n * times[r[0]]
    longest = max(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in redacted)
    assert all(read[s] <= 1.25 * tokens[s] + longest for s in tokens)

    parts = docs.collect()
    assert Counter(r.doc_id for r in parts if r.piece == 0) == times
    spots = {}
    for r in parts:
        spots.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in spots.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048


def test_run_is_registered(spark):
    assert entry.queries()["pipeline"] is cp.run
    assert cp.run(spark, SF).where(F.col("length") > 2048).count() == 0


def test_empty_and_odd_tables(spark, odd_texts, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra int"
    odd = spark.createDataFrame([(i, t, "en" if i % 2 else None, None if i % 3 else "s", len(t or ""), 1) for i, t in odd_texts] + [(None, "null id", None, None, None, None)], schema)
    for name, docs in (("odd", odd), ("none", odd.limit(0))):
        for i, (_, function) in enumerate(cp.STAGES):
            function(spark, docs, SF).write.parquet(f"{tmp_path}/{name}{i}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{i}")
        assert (docs.count() > 0) == (name == "odd")


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(name, n=30):
    return " ".join(f"{name}{i}" for i in range(n))


def test_near_duplicates_of_shared_and_missing_ids(spark):
    rows = [
        (3, words("a"), "en", "s", 1), (5, words("a") + " more", "en", "s", 2), (5, words("b"), "en", "s", 3), (5, words("c"), "en", "s", 4),
        (None, words("d"), "en", "s", 5), (None, words("e"), "en", "s", 6), (None, words("e") + " more", "en", "s", 7), (None, words("c"), "en", "s", 8),
        (9, words("f"), "en", "s", 9), (9, words("f"), "en", "s", 9), (7, words("f") + " more", "en", "s", 10),
        (None, None, None, None, None), (None, "", "en", "s", 0), (6, " \n", "en", "s", 11), (6, "\t", "en", "s", 12),
    ]
    got = [tuple(r) for r in cp.one_of_each_group(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()]
    # Of e and its copy, which share the missing id, either may stay.
    either = [r for r in got if r[4] in (6, 7)]
    assert len(either) == 1
    assert Counter(got) == Counter([r for r in rows if r[4] in (1, 3, 4, 5, 10, None, 0, 11, 12)] + either)


def test_mixing_reads_rows_of_shared_ids_apart(spark):
    rows = [(None if i % 2 else 5, words(f"t{i}x"), "en", "s", i) for i in range(12)] + [(4, "same row", "en", "s", 20)] * 3 + [(None, None, None, None, None)] * 2
    got = Counter(tuple(r) for r in cp.mix_sources(spark, spark.createDataFrame(rows, SCHEMA), SF).collect())
    assert got == Counter(rows)


def test_stages_keep_rows_of_shared_ids(spark, tmp_path):
    docs = spark.createDataFrame([(None if i % 2 else 5, words(f"t{i}x"), "en", "s", 1) for i in range(12)], SCHEMA)
    texts = Counter(r.text for r in docs.collect())
    for i, (name, function) in enumerate(cp.STAGES):
        function(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if name in ("ngram_join", "secrets", "mixing"):
            assert Counter(r.text for r in docs.collect()) == texts
    assert docs.where("piece = 0").count() == 12
