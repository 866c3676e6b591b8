"""Packing: whole texts come back from the sequences, and few sequences are used."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from urbanlake.llm import packing
from urbanlake.llm.common import QUERIES

SCHEMA = "doc_id long, text string"


def test_ids_equal_the_tokenizer(odd_texts):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [t or "" for _, t in odd_texts] + ["a <|endoftext|> b", "it's 3² ½ ǅ — “so”…  \n\n x", "\x85\xa0  y", "".join(map(chr, range(1, 0x250)))]
    for t in texts:
        assert packing.token_ids(t).tolist() == exact.encode(t, add_special_tokens=False).ids


def check(rows, docs, limit):
    spots, seen = {}, {}
    for r in rows:
        spots.setdefault(r.sequence_id, []).append((r.offset, r.length))
        seen.setdefault(r.doc_id, []).append(r)
    for parts in spots.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= limit
    for doc, text in docs:
        ids = np.append(packing.token_ids(text or ""), 0).astype("<u4")
        parts = sorted(seen[doc], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert sum(r.length for r in parts) == len(ids)
        assert all(r.length == limit for r in parts[1:]) and (len(ids) > limit or len(parts) == 1)
        for r in parts:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    return len(spots)


def test_odd_texts(spark, odd_texts):
    df = spark.createDataFrame([(i, t, 5) for i, t in odd_texts], SCHEMA + ", offset int")
    check(packing.packed_documents(df, 64).collect(), odd_texts, 64)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "word " * 100), (1, "word " * 100), (None, "x"), (None, None)], SCHEMA)
    rows = packing.packed_documents(df, 32).collect()
    assert sum(r.length for r in rows) == 2 * (len(packing.token_ids("word " * 100)) + 1) + 2 + 1
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.packed_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op3_packing"](spark, sf).collect()
    used = check(rows, docs, 2048)
    assert used <= 1.02 * -(-sum(r.length for r in rows) // 2048) + 1


def test_sum_of_squares_by_hand():
    # The third piece would leave equal counts in a new bin; it goes where the squares fall most.
    bins, offsets = packing.sum_of_squares(np.array([6, 6, 4, 4]), 10)
    assert bins.tolist() == [0, 1, 1, 0] and offsets.tolist() == [0, 0, 6, 6]
