"""Document fingerprints from closed syncmers.

A k-mer (``K`` code points) is a closed syncmer if, of its substrings of ``S`` code points, the one with the least hash is the
first or the last. Whether it is chosen depends on the k-mer alone, never on its surroundings, so a passage has the same
anchors wherever it stands, and an edit changes only the anchors that touch it.

The anchors of a document are all its closed syncmers with their places. The fingerprint keeps the anchors whose hash is below
``LIMIT``, one in ``SHARE``, and at least the ``SKETCH`` anchors with the least hash, the leftmost of equal ones: it grows with
the text, anchors are chosen over the whole text, and two fingerprints estimate the share of common anchors from all hashes
up to which both are complete. Texts without a closed syncmer, as those shorter than a k-mer,
have one anchor, the whole text. The likeness of two
fingerprints is that share, counted over anchors that match in place: their shift must be within ``SLACK`` of the shift
that most of them have, so that chance matches at scattered places do not count.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanlake.llm import vectors as V
from urbanlake.llm.common import partitions, query, table

K, S = 16, 6
SKETCH = 128
SHARE = 8
LIMIT = (1 << 32) // SHARE
SLACK = 64
FACTOR = np.uint64(0x100000001B3)


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    value = codes
    for i in range(1, n):
        value = value[:-1] * FACTOR + codes[i:]
    return V.mix(value)


def closed_syncmers(texts: list[str], k: int = K, s: int = S) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and hashes of each text's closed syncmers, by place."""
    codes, at = _code_points(texts)
    codes = V.mix(codes.astype(np.uint64))
    width = k - s + 1
    place, hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(codes) >= k:
        inner = _grams(codes, s)
        least, reach = inner, 1
        while reach * 2 <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        n = len(codes) - k + 1
        place = np.flatnonzero((inner[:n] == least[:n]) | (inner[width - 1 : width - 1 + n] == least[:n]))
        hashes = _grams(codes, k)[place]
    out = []
    low, high = np.searchsorted(place, at[:-1]), np.searchsorted(place, at[1:] - k, "right")
    for i in range(len(texts)):
        size = at[i + 1] - at[i]
        if size and high[i] <= low[i]:
            out.append((np.zeros(1, np.int64), V.mix(np.array([(codes[at[i] : at[i + 1]] * np.arange(1, size + 1, dtype=np.uint64)).sum() + np.uint64(size)], np.uint64))))
        else:
            out.append((place[low[i] : max(low[i], high[i])] - at[i], hashes[low[i] : max(low[i], high[i])]))
    return out


PRINT = np.dtype([("hash", "<u4"), ("place", "<u4")])


def fingerprint(place: np.ndarray, hashes: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """The anchors below ``LIMIT``, or the ``size`` ones with the least hash if these are more; each hash once at its leftmost
    place, by hash."""
    found, first = np.unique((hashes >> np.uint64(32)).astype(np.uint32), return_index=True)
    kept = min(max(size, int(np.searchsorted(found, LIMIT))), len(found))
    out = np.zeros(kept, PRINT)
    out["hash"], out["place"] = found[:kept], place[first[:kept]]
    return out


def _complete(own: np.ndarray, size: int) -> int:
    """The hash up to which a fingerprint holds every anchor of its text."""
    return max(LIMIT - 1, int(own["hash"][-1])) if len(own) >= size else (1 << 32) - 1


def likeness(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Share of common anchors in matching places, 0 to 1; two empty fingerprints are alike."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    both = np.union1d(a["hash"], b["hash"])
    both = both[both <= min(_complete(a, size), _complete(b, size))]
    if not len(both):
        return 0.0
    common, i, j = np.intersect1d(a["hash"], b["hash"], assume_unique=True, return_indices=True)
    inside = common <= both[-1]
    shift = np.sort(a["place"][i[inside]].astype(np.int64) - b["place"][j[inside]])
    if not len(shift):
        return 0.0
    # The most anchors that any shift explains.
    most = (np.searchsorted(shift, shift + SLACK, "right") - np.arange(len(shift))).max()
    return float(most / len(both))


def read_print(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text or ""), PRINT)


PRINT_ROWS = 1 << 20


def _prints(texts: list[str]) -> list[np.ndarray]:
    """Fingerprints of texts, about a million code points at a time."""
    out, a = [], 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size < PRINT_ROWS):
            size += len(texts[b])
            b += 1
        out += [fingerprint(*x) for x in closed_syncmers(texts[a:b])]
        a = b
    return out


def anchors(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``anchors``: an array of ``place, hash`` of all closed syncmers. Null texts have none."""
    kept = docs.drop("anchors")
    kind = pa.list_(pa.struct([("place", pa.int64()), ("hash", pa.int64())]))
    schema = kept.select("*", F.lit(None).cast("array<struct<place:bigint,hash:bigint>>").alias("anchors")).schema

    def read(batches):
        for batch in batches:
            found = closed_syncmers([t or "" for t in batch.column(text).to_pylist()])
            column = pa.array([[{"place": int(p), "hash": int(h)} for p, h in zip(f[0], f[1].view(np.int64))] for f in found], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "anchors"])

    return kept.mapInArrow(read, schema)


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with ``out``: the fingerprint as hexadecimal text, empty for null and empty texts.

    Equal texts have equal fingerprints; repeated rows repeat. A column called ``out`` is replaced.
    """
    kept = docs.drop(out)
    schema = kept.select("*", F.lit("").alias(out)).schema

    def read(batches):
        for batch in batches:
            prints = _prints([t or "" for t in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p.tobytes().hex() for p in prints], pa.string())], names=[*batch.schema.names, out])

    return kept.mapInArrow(read, schema)


def _packed(df: DataFrame, column: str) -> DataFrame:
    """Replace a text column by its compressed bytes."""
    schema = df.withColumn(column, F.col(column).cast("binary")).schema

    def read(batches):
        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column(column).cast(pa.large_binary())
            column_ = pa.array([tool.compress(x.as_buffer()) if x.is_valid else None for x in texts], pa.binary())
            yield batch.set_column(batch.schema.get_field_index(column), column, column_)

    return df.mapInArrow(read, schema)


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, packed, next_packed``: each row's compressed text and that of the row that follows by falling ``key``.

    Null keys come last, ties go by a hash of the text, and the last row is followed by the first. Rows are dealt to ranges of
    the key, whose number follows the shuffle partitions, and sorted within them; the first row of each range is handed to
    the range before it. Texts are compressed before they are shuffled, which they are once. Null texts count as empty.
    """
    count = partitions(docs.sparkSession)
    order = F.coalesce(F.col(key).cast("double"), F.lit(float("-inf")))
    edges = docs.select(key).agg(F.percentile_approx(order, F.array(*(F.lit(i / count) for i in range(1, max(2, count)))), 100 * count).alias("edges")).first()["edges"]
    limits = F.array(*(F.lit(float(e)) for e in sorted(set(edges or [0.0]), reverse=True)))
    own = F.coalesce(F.col(text), F.lit(""))
    spread = docs.select(F.size(F.filter(limits, lambda e: e > order)).alias("_range"), F.col(key).alias("_key"), F.xxhash64(own).alias("_tie"), own.alias("packed"))
    follow = W.partitionBy("_range").orderBy(F.desc_nulls_last("_key"), "_tie")
    here = _packed(spread, "packed").withColumn("_next", F.lead("packed").over(follow))
    # At most one row per range; only these rows are looked at in one place.
    firsts = _packed(spread.withColumn("_row", F.row_number().over(follow)).where("_row = 1").select("_range", "packed"), "packed")
    everywhere = W.partitionBy(F.lit(0))
    before = firsts.select(F.coalesce(F.lag("_range").over(everywhere.orderBy("_range")), F.max("_range").over(everywhere)).alias("_range"), F.col("packed").alias("_first"))
    return here.join(before, "_range").select(F.col("_key").alias(key), "packed", F.coalesce("_next", "_first").alias("next_packed"))


EDITED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
EDITED_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


@query("op8_syncmers")
def syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and its edited text, with fingerprints and their likeness."""

    def read(batches):
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                own, after = ([tool.decompress(x.as_buffer()).decode() for x in part.column(c)] for c in ("packed", "next_packed"))
                edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(own, after)]
                # The next text is mostly the next row's own: each text is looked at once.
                texts = list(dict.fromkeys(own + after + edited))
                prints = dict(zip(texts, _prints(texts)))
                columns = [
                    part.column("doc_id"),
                    [len(t) for t in own],
                    [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                    [prints[t].tobytes().hex() for t in own],
                    [prints[e].tobytes().hex() for e in edited],
                    [likeness(prints[t], prints[e]) for t, e in zip(own, edited)],
                    [likeness(prints[t], prints[n]) for t, n in zip(own, after)],
                ]
                yield pa.RecordBatch.from_pydict(dict(zip(EDITED.names, columns)), schema=EDITED)

    return with_next(table(spark, sf_dir, "documents").select("doc_id", "text")).mapInArrow(read, EDITED_DDL)
