"""Fill-in-the-middle forms against a plain version, their round trip, and the plan of two sorts and one shuffle."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from urbanlake.llm import infill

SCHEMA = "doc_id long, text string"


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def compare(spark, rows, **settings):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("n", "form", "output", "restored", "row"):
        df = df.withColumn(name, F.lit("clash"))
    got = sorted(map(tuple, infill.fill_in_middle(df, **settings).collect()), key=repr)
    want = sorted(((*(w := plain(*r))[:5], sha(w[5]), sha(r[1]), w[5], r[1] or "") for r in rows), key=repr)
    assert got == want
    return got


@pytest.mark.parametrize("units", [1, 3, 4096])
def test_odd_texts(spark, odd_texts, units):
    texts = [t for _, t in odd_texts] + ["a <P> mark", "<", "<S", "ends with <", "tab\tand\x0bfeed \n", "\x85 　 wide blanks are no blanks", "<M"]
    rows = [(i, t) for i, t in enumerate(texts * 8)]
    got = compare(spark, rows, units=units)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_shared_and_missing_ids_and_copies(spark):
    compare(spark, [(None, "one two three four")] * 50 + [(7, "one two three four")] * 50 + [(7, "other words here")] * 9 + [(None, None)] * 9)


def test_a_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(600_000))
    spoken = next(i for i in range(100) if plain(i, "a b")[2] != "plain")
    compare(spark, [(spoken, text), (spoken, "x" * 3_000_000), (spoken, " " * 1_000_000)])


def test_empty_table(spark):
    assert infill.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0


def test_texts_move_once(spark):
    rows = spark.createDataFrame([(i, "a b c") for i in range(20)], SCHEMA)
    lineage = infill.fill_in_middle(rows, texts=False).rdd.toDebugString().decode()
    assert lineage.count("ShuffledRDD") + lineage.count("PartitionerAwareUnionRDD") <= 1
