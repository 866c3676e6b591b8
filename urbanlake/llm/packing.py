"""Sum-of-squares packing of tokenised documents into sequences.

A piece goes where the sum of squares of the open bins' counts per residual gap becomes smallest: with ``N(g)`` open bins of
gap ``g``, a piece of length ``s`` may open a bin or go into one of gap ``g >= s``, and the choice with the least
``sum of N(g) ** 2`` is taken (the tightest of equals). Bins that are spread over many gaps fit what comes next.

Pieces are packed in blocks, which a hash of the document's id deals out; a block holds about ``BLOCK`` documents, so the
number of blocks grows with the table and each leaves only a few open bins. Within a block, pieces come by falling length:
the long ones open the bins that the short ones close. Full pieces are sequences by themselves.

Token ids come from the byte-level vocabulary of the tokenizer file. Where a text holds no special token and no character
beyond the Latin blocks and common punctuation, the ids are made by the same vocabulary's rank file, which is about four
times as fast and gives the same ids; all other texts go through the tokenizer itself.
"""

from __future__ import annotations

import base64
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm.common import query, table
from urbanlake.session import stage

LIMIT = 2048
END = 0
BLOCK = 50_000
#: Code points for which both libraries' tables of letters and digits certainly agree.
PLAIN = re.compile(r"[\x00-ɏ‐-‧€]*")


@lru_cache(maxsize=2)
def _encoders(folder: str | None, name: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    at = (lambda f: os.path.join(folder, f)) if folder else public_tokenizers.path
    exact = Tokenizer.from_file(at(f"{name}.json"))
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    with open(at(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return exact, special, fast


def token_ids(text: str, folder: str | None = None, name: str = "byte_bpe_50k") -> np.ndarray:
    """The ids of a text without added special tokens; special tokens written out in the text are recognised."""
    exact, special, fast = _encoders(folder, name)
    if PLAIN.fullmatch(text) and not any(s in text for s in special):
        ids = fast.encode_ordinary(text)
    else:
        ids = exact.encode(text, add_special_tokens=False).ids
    return np.array(ids, np.int64)


def cut(length: int, limit: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: full ones, but for the first."""
    first = (length - 1) % limit + 1
    return [(0, first)] + [(s, limit) for s in range(first, length, limit)]


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


def pieces(docs: DataFrame, limit: int = LIMIT, key: str = "doc_id", text: str = "text", folder: str | None = None, name: str = "byte_bpe_50k", with_ids: bool = True) -> DataFrame:
    """The pieces of every document: its token ids, then the end id, cut where they exceed ``limit``.

    A null text is empty and gives the end id alone. Repeated rows give their pieces again. ``ids`` is null where
    ``with_ids`` is false.
    """

    def read(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                out = {c: [] for c in PIECES.names}
                part = batch.slice(a, 500)
                for doc, body in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.append(token_ids(body or "", folder, name), END).astype("<u4")
                    for i, (start, length) in enumerate(cut(len(ids), limit)):
                        own = ids[start : start + length]
                        for c, v in zip(PIECES.names, (doc, i, start, length, zlib.crc32(own.tobytes()), own.astype(np.int32) if with_ids else None)):
                            out[c].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=PIECES)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(read, PIECES_DDL)


def sum_of_squares(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, in the given order."""
    counts = np.zeros(limit + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(limit + 1)]
    used: list[int] = []
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, s in enumerate(lengths.tolist()):
        gap, rest = -1, limit - s
        opened = 2 * counts[rest] + 1 if rest else 0
        # Change of the sum when a bin of gap g becomes one of gap g - s; a full bin counts no more.
        change = 2 - 2 * counts[s:] + 2 * counts[: limit + 1 - s]
        change[0] = 1 - 2 * counts[s]
        change[counts[s:] == 0] = np.iinfo(np.int64).max
        at = int(np.argmin(change))
        if change[at] <= opened:
            gap = s + at
        if gap < 0:
            b = len(used)
            used.append(0)
        else:
            b = open_bins[gap].pop()
            counts[gap] -= 1
        bins[i], offsets[i] = b, used[b]
        used[b] += s
        left = limit - used[b]
        if left:
            open_bins[left].append(b)
            counts[left] += 1
    return bins, offsets


PLACED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PLACED_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(cut_: DataFrame, documents: int, limit: int = LIMIT) -> DataFrame:
    """Add ``sequence_id, offset`` to pieces; ``documents`` sets the number of blocks. Ids of sequences are unique."""
    blocks = max(1, -(-documents // BLOCK))

    def place(group):
        block = group.column("block")[0].as_py()
        length = np.asarray(group.column("length"))
        # Ties of the length go by document and piece, so that a block is packed the same way again.
        order = np.lexsort((np.asarray(group.column("ids_crc32")), np.asarray(group.column("piece")), np.asarray(group.column("doc_id").fill_null(-1)), -length))
        bins, offsets = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        bins[order], offsets[order] = sum_of_squares(length[order], limit)
        out = group.select(PLACED.names[:5])
        return out.append_column("sequence_id", pa.array(block + bins * blocks)).append_column("offset", pa.array(offsets)).cast(PLACED)

    block = F.pmod(F.xxhash64("doc_id", "ids_crc32"), F.lit(blocks)).alias("block")
    part = cut_.where(F.col("length") < limit).select(block, *PLACED.names[:5])
    packed = part.groupBy("block").applyInArrow(place, PLACED_DDL)
    # A full piece needs no bin. Its sequence has a negative id, from the number of its row: pieces are stored.
    own = -1 - F.monotonically_increasing_id()
    full = cut_.where(F.col("length") == limit).select(*PLACED.names[:5], own.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.union(full)


@query("op3_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, and its place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packed_documents(docs)


def packed_documents(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Tokenise, cut and pack ``docs``; the pieces are written once, without their ids."""
    done = stage(pieces(docs, limit, with_ids=False).drop("ids"), "packing-pieces")
    return pack(done, docs.count(), limit)
