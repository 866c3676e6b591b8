"""Exact removal of repeated substrings, found in column-wise Burrows-Wheeler transforms of the document collection.

Task: remove every byte that lies in a ``window``-byte string which also starts anywhere else in the collection.

**The transform.** A collection's transform is built by columns: each round inserts one symbol of every document, from the
last to the first, at the place that the symbol's rank in the transform so far gives; the common prefixes of neighbours are
updated with range minima. A string starts elsewhere if and only if a neighbour in that order shares ``window`` symbols.

**What is dealt out.** One transform over all documents would be one task, with a round for every byte of the longest
document. The collection is therefore cut so that strings that could be equal stay together:

1. Every window has an anchor: the substring of ``k`` bytes in it with the least hash (the leftmost of equals). Equal
   windows have equal anchors at the same place, so only windows of the same anchor can be equal, and only if the anchor
   occurs twice. Anchors are shuffled as hashes; those that occur once are done.
2. Around each occurrence of another anchor, the bytes that its windows cover (at most ``2 * window - k``) form a short
   document, aligned at the anchor. Equal short documents are kept once with a mark, in the batch before the shuffle and in
   the bucket after it.
3. A bucket inserts its short documents column by column. Since they are aligned, equal windows start in the same column:
   the order of a column's suffixes comes from that of the column before, and only the last column's order, transform and
   common prefixes are held in memory. The columns before are final and only pass on their repeats.
4. The repeated windows return to their documents as runs, and the documents drop these bytes.

**Hot anchors.** An anchor that occurs more than ``HOT`` times is dealt by whole windows: each of its windows is a short
document of its own, in the bucket of its own hash. A common passage whose surroundings all differ thus spreads over the
cluster, while its equal parts merge before the shuffle.

Nothing is gathered but what one bucket holds, and the number of buckets follows the session's shuffle partitions. The
whole is one plan: a lost executor costs the recomputation of its tasks. Buckets are read as Arrow, since the columns of
bytes need arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm import vectors as V
from urbanlake.llm.common import query, table

HOT = 20_000
#: Windows that one step of a long document covers.
SEGMENT = 1 << 21

SEEN = np.dtype([("hash", "<u8"), ("id", "<i8"), ("tag", "<u4"), ("pos", "<u4"), ("lo", "<u2"), ("hi", "<u2")])
HIT = np.dtype([("id", "<i8"), ("tag", "<u4"), ("pos", "<u4"), ("lo", "<u2"), ("hi", "<u2"), ("hot", "<u2")])
RUN = np.dtype([("id", "<i8"), ("tag", "<u4"), ("start", "<u4"), ("end", "<u4")])


def anchors(data: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows of a byte string: hash, place, and the first and last window that has it."""
    count = len(data) - window + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    hashes = V.Rolling(data).every(k)
    width = window - k + 1
    least = (hashes & ~np.uint64((1 << 24) - 1)) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    at = (least[:count] & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [count]]) - 1
    return hashes[at[first]], at[first], first, last


def segments(length: int, window: int) -> Iterator[tuple[int, int]]:
    """Parts of a document that together hold each of its windows once."""
    for start in range(0, max(1, length - window + 1), SEGMENT):
        yield start, min(length, start + SEGMENT + window - 1)


def _batch_anchors(data, offsets, ids, tags, window, k) -> np.ndarray:
    """The anchors of a batch of documents as records. Several short documents are hashed together."""
    out = []
    for a, b in V.steps(offsets):
        if b - a == 1 and offsets[b] - offsets[a] > SEGMENT:
            parts = [(a, s, e) for s, e in segments(int(offsets[b] - offsets[a]), window)]
            for row, s, e in parts:
                hashes, at, first, last = anchors(data[offsets[row] + s : offsets[row] + e], window, k)
                out.append(_seen(hashes, ids[row], tags[row], at + s, at - first, last - at))
            continue
        base = offsets[a]
        hashes, at, first, last = anchors(data[base : offsets[b]], window, k)
        # Cut the runs of windows at the ends of documents: windows that cross an end do not count.
        starts, ends = offsets[a:b] - base, offsets[a + 1 : b + 1] - base
        row = np.searchsorted(ends, at, "right")
        first = np.maximum(first, starts[row])
        last = np.minimum(last, ends[row] - window)
        good = (at >= starts[row]) & (first <= last)
        hashes, at, first, last, row = hashes[good], at[good], first[good], last[good], row[good]
        out.append(_seen(hashes, ids[a + row], tags[a + row], at - starts[row], at - first, last - at))
    return np.concatenate(out) if out else np.zeros(0, SEEN)


def _seen(hashes, ids, tags, pos, before, after) -> np.ndarray:
    """``lo`` is the distance from the first window to the anchor; ``hi`` from the last window to it."""
    rec = np.zeros(len(hashes), SEEN)
    rec["hash"], rec["id"], rec["tag"], rec["pos"], rec["lo"], rec["hi"] = hashes, ids, tags, pos, before, -after
    return rec


BLOBS = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
BLOBS_DDL = "bucket int, blob binary"


def _columns(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = V.utf8(batch.column("text"))
    return data, offsets, batch.column("id").to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column("id").to_numpy(), np.asarray(batch.column("tag")).astype(np.uint32)


def repeats_of_columns(texts: np.ndarray, left: np.ndarray, right: np.ndarray, window: int) -> np.ndarray:
    """Build the transform of aligned strings column by column; which of their windows a neighbour shares.

    ``texts[i, c]`` is the symbol of string i in column c plus one, 0 outside ``left[i] <= c < right[i]``. The result says
    for each string and column whether the window that starts there also starts at the same column of another string.
    """
    m, width = texts.shape
    shared = np.zeros((m, width), bool)
    order = np.arange(m)
    # common[j]: symbols that the suffixes of order[j - 1] and order[j] share; rows of minima over 2, 4, ... neighbours.
    common = np.zeros(m, np.int16)
    for c in range(width - 1, -1, -1):
        symbols = texts[order, c]
        place = np.argsort(symbols, kind="stable")
        picked = symbols[place]
        fresh = np.zeros(m, np.int16)
        same = np.flatnonzero((picked[1:] == picked[:-1]) & (picked[1:] > 0)) + 1
        if len(same):
            a, b = place[same - 1] + 1, place[same]
            fresh[same] = 1 + _range_min(common, a, b)
        order, common = order[place], np.minimum(fresh, window)
        full = common >= window
        if full.any():
            shared[order[full], c] = True
            shared[order[np.flatnonzero(full) - 1], c] = True
    return shared


def _range_min(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minima of ``values[first..last]``, by tables of minima over powers of two."""
    span = last - first + 1
    out = np.empty(len(first), values.dtype)
    level, table_ = 0, values
    depth = np.frexp(span)[1] - 1
    for level in range(int(depth.max()) + 1):
        if level:
            half = 1 << (level - 1)
            table_ = np.minimum(table_[:-half], table_[half:])
        here = depth == level
        if here.any():
            out[here] = np.minimum(table_[first[here]], table_[last[here] - (1 << level) + 1])
    return out


def _group_short(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal short documents: index of the first of each kind, the kind of each, how often each kind occurs."""
    key = np.zeros(len(starts), np.dtype([("a", "<u8"), ("b", "<u8")]))
    key["a"] = V.Rolling(data).of(starts, starts + lengths)
    key["b"] = extra
    _, first, kind, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return first, kind, count


def repeated_runs(docs: DataFrame, window: int = 200, k: int = 50, hot: int = HOT) -> DataFrame:
    """Runs of repeated windows: blobs of ``RUN`` by bucket; ``docs`` has ``bucket, id, tag, text``."""
    count = V.buckets(docs.sparkSession)

    def find(batches):
        for batch in batches:
            if batch.num_rows:
                data, offsets, ids, tags = _columns(batch)
                rec = _batch_anchors(data, offsets, ids, tags, window, k)
                if len(rec):
                    yield V.rows(list(V.packed((rec["hash"] % np.uint64(count)).astype(np.int64), rec, count)), BLOBS)

    def meet(group):
        rec = V.unpacked(group.column("blob"), SEEN)
        order = np.argsort(rec["hash"], kind="stable")
        rec = rec[order]
        edge = np.flatnonzero(np.concatenate([[True], rec["hash"][1:] != rec["hash"][:-1], [True]]))
        times = np.repeat(np.diff(edge), np.diff(edge))
        rec, times = rec[times > 1], times[times > 1]
        out = np.zeros(len(rec), HIT)
        for c in ("id", "tag", "pos", "lo", "hi"):
            out[c] = rec[c]
        out["hot"] = times > hot
        return pa.Table.from_batches([V.rows(list(V.packed(_home(out, count), out, count)), BLOBS)])

    def cut(texts, hits):
        rec = np.sort(V.unpacked(hits.column("blob"), HIT), order=["id", "tag"])
        pairs = []
        if texts.num_rows and len(rec):
            for part in texts.to_batches(max_chunksize=2000):
                pairs += _short(part, rec, window, k, count)
        return pa.Table.from_batches([V.rows(pairs, SHORT)])

    def sort(group):
        return pa.Table.from_batches([V.rows(_solve(group, window, k, count), BLOBS)])

    seen = docs.select("id", "tag", "text").mapInArrow(find, BLOBS_DDL)
    hits = seen.groupBy("bucket").applyInArrow(meet, BLOBS_DDL)
    short = docs.groupBy("bucket").cogroup(hits.groupBy("bucket")).applyInArrow(cut, SHORT_DDL)
    return short.groupBy("bucket").applyInArrow(sort, BLOBS_DDL)


def _home(rec: np.ndarray, count: int) -> np.ndarray:
    """The bucket of a document, as ``keyed`` computes it."""
    return (rec["id"].astype(np.int64) ^ rec["tag"].astype(np.int64)) % count


#: Short documents of a batch: their bytes joined, lengths, anchors, distances of first and last window, and where each
#: occurs (``WHERE``: document, place of the anchor, number of the short document).
SHORT = pa.schema([("bucket", pa.int32()), ("bytes", pa.binary()), ("shorts", pa.binary()), ("places", pa.binary())])
SHORT_DDL = "bucket int, bytes binary, shorts binary, places binary"
PIECE = np.dtype([("hash", "<u8"), ("size", "<u2"), ("lo", "<u2"), ("hi", "<i2")])
PLACE = np.dtype([("id", "<i8"), ("tag", "<u4"), ("pos", "<u4"), ("piece", "<u4")])


def _short(batch: pa.RecordBatch, hits: np.ndarray, window: int, k: int, count: int) -> list:
    data, offsets, ids, tags = _columns(batch)
    key = np.zeros(len(ids), HIT)
    key["id"], key["tag"] = ids, tags
    docs = np.zeros(len(ids), np.dtype([("id", "<i8"), ("tag", "<u4")]))
    docs["id"], docs["tag"] = ids, tags
    known = np.zeros(len(hits), docs.dtype)
    known["id"], known["tag"] = hits["id"], hits["tag"]
    low, high = np.searchsorted(known, docs, "left"), np.searchsorted(known, docs, "right")
    times = high - low
    if not times.sum():
        return []
    row = np.repeat(np.arange(len(ids)), times)
    hit = hits[np.concatenate([np.arange(a, b) for a, b in zip(low, high) if b > a])]
    # A row that occurs twice has each of its anchors twice, and an anchor at the edge of two segments has its windows in
    # two records, which adjoin; each row takes each place once, with all its windows.
    order = np.lexsort((hit["pos"], row))
    row, hit = row[order], hit[order]
    once = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (hit["pos"][1:] != hit["pos"][:-1])]))
    lo = np.maximum.reduceat(hit["lo"].astype(np.int64), once)
    hi = np.maximum.reduceat(-hit["hi"].astype(np.int16).astype(np.int64), once)
    row, hit = row[once], hit[once]
    at = offsets[row] + hit["pos"]
    hashes = V.Rolling(data)
    anchor = hashes.of(at, at + k)
    is_hot = hit["hot"] > 0
    if is_hot.any():
        # Windows of their own, under their own hash; equal ones merge just below.
        n = (lo + hi + 1)[is_hot]
        h_row, h_at, h_lo = np.repeat(row[is_hot], n), np.repeat(at[is_hot] - lo[is_hot], n), np.concatenate([np.arange(x) for x in n])
        start = h_at + h_lo
        row = np.concatenate([row[~is_hot], h_row])
        at = np.concatenate([at[~is_hot], start])
        anchor = np.concatenate([anchor[~is_hot], hashes.of(start, start + window)])
        lo = np.concatenate([lo[~is_hot], np.zeros(len(start), np.int64)])
        hi = np.concatenate([hi[~is_hot], np.zeros(len(start), np.int64)])
    start, size = at - lo, lo + hi + window
    first, kind, _ = _group_short(data, start, size, anchor + lo.astype(np.uint64))
    pieces = np.zeros(len(first), PIECE)
    pieces["hash"], pieces["size"], pieces["lo"], pieces["hi"] = anchor[first], size[first], lo[first], hi[first]
    bucket = (pieces["hash"] % np.uint64(count)).astype(np.int64)
    by_piece = np.argsort(bucket, kind="stable")
    rank = np.empty(len(first), np.int64)
    rank[by_piece] = np.arange(len(first))
    edges = np.searchsorted(bucket[by_piece], np.arange(count + 1))
    places = np.zeros(len(row), PLACE)
    places["id"], places["tag"], places["pos"] = ids[row], tags[row], at - offsets[row]
    where = rank[kind]
    order = np.argsort(where, kind="stable")
    places, where = places[order], where[order]
    out = []
    for b in np.flatnonzero(np.diff(edges)):
        chosen = first[by_piece[edges[b] : edges[b + 1]]]
        index = np.repeat(start[chosen] - np.concatenate([[0], np.cumsum(size[chosen])[:-1]]), size[chosen]) + np.arange(size[chosen].sum())
        x, y = np.searchsorted(where, [edges[b], edges[b + 1]])
        mine = places[x:y].copy()
        mine["piece"] = where[x:y] - edges[b]
        out.append((int(b), data[index].tobytes(), pieces[by_piece[edges[b] : edges[b + 1]]].tobytes(), mine.tobytes()))
    return out


def _solve(group: pa.Table, window: int, k: int, count: int) -> list:
    datas, pieces, places, base = [], [], [], 0
    for d, p, w in zip(group.column("bytes"), group.column("shorts"), group.column("places")):
        p, w = np.frombuffer(p.as_buffer(), PIECE), np.frombuffer(w.as_buffer(), PLACE).copy()
        w["piece"] += base
        base += len(p)
        datas.append(np.frombuffer(d.as_buffer(), np.uint8)), pieces.append(p), places.append(w)
    if not base:
        return []
    data, pieces, places = np.concatenate(datas), np.concatenate(pieces), np.concatenate(places)
    size = pieces["size"].astype(np.int64)
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    first, kind, _ = _group_short(data, start, size, pieces["hash"] + pieces["lo"].astype(np.uint64))
    occurrences = np.bincount(kind[places["piece"]], minlength=len(first))
    lo, hi = pieces["lo"][first].astype(np.int64), pieces["hi"][first].astype(np.int64)
    reach = int(lo.max())
    left, right = reach - lo, reach - lo + size[first]
    texts = np.zeros((len(first), int(right.max())), np.uint16)
    cells = np.repeat(np.arange(len(first)) * texts.shape[1] + left - np.concatenate([[0], np.cumsum(size[first])[:-1]]), size[first]) + np.arange(size[first].sum())
    source = np.repeat(start[first] - np.concatenate([[0], np.cumsum(size[first])[:-1]]), size[first]) + np.arange(size[first].sum())
    texts.ravel()[cells] = data[source].astype(np.uint16) + 1
    shared = repeats_of_columns(texts, left, right, window)
    columns = np.arange(texts.shape[1])
    windows = (columns >= left[:, None]) & (columns <= (reach + hi)[:, None])
    shared = (shared | (occurrences > 1)[:, None]) & windows
    # Runs of repeated windows of each kind, then of each place.
    edge = np.diff(np.pad(shared, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    run_kind, run_start = np.nonzero(edge == 1)
    _, run_end = np.nonzero(edge == -1)
    low, high = np.searchsorted(run_kind, kind[places["piece"]], "left"), np.searchsorted(run_kind, kind[places["piece"]], "right")
    times = high - low
    if not times.sum():
        return []
    at = np.repeat(places, times)
    which = np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
    out = np.zeros(len(at), RUN)
    out["id"], out["tag"] = at["id"], at["tag"]
    out["start"] = at["pos"].astype(np.int64) + run_start[which] - reach
    out["end"] = at["pos"].astype(np.int64) + run_end[which] - 1 - reach + window
    return list(V.packed(_home(out, count), out, count))


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``bucket, id, tag, text``: a document is known by its id and a hash of its text; a null id counts as -1."""
    count = V.buckets(docs.sparkSession)
    own = F.coalesce(F.col(text), F.lit(""))
    keys = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-1)).alias("id"), F.xxhash64(own).bitwiseAND(0xFFFFFFFF).alias("tag"), own.alias("text"), F.col(key).isNull().alias("null_id"))
    return keys.select(F.pmod(F.col("id").bitwiseXOR(F.col("tag")), F.lit(count)).cast("int").alias("bucket"), "id", "tag", "null_id", "text")


RESULT = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("span_starts", pa.list_(pa.int64())), ("span_ends", pa.list_(pa.int64()))])
RESULT_DDL = "doc_id long, kept binary, n_bytes long, n_removed long, span_starts array<long>, span_ends array<long>"


def remove(docs: DataFrame, window: int = 200, k: int = 50, hot: int = HOT, key: str = "doc_id", text: str = "text", content: bool = True) -> DataFrame:
    """``doc_id, kept, n_bytes, n_removed, span_starts, span_ends``: what is left of every document, and what went.

    One row per row of ``docs``. Texts are UTF-8 bytes, a null text is empty; matches never cross documents, overlapping
    occurrences count, and all windows are judged on the input. Repeated rows repeat each other, so both lose every byte of
    texts of ``window`` bytes or more. Other columns are not read. ``kept`` holds the remaining bytes, or their SHA-256
    where ``content`` is false.
    """
    source = keyed(docs, key, text)
    texts = source.select("bucket", "id", "tag", "null_id", "text")
    runs = repeated_runs(texts, window, k, hot)

    def drop(parts, found):
        rec = np.sort(V.unpacked(found.column("blob"), RUN), order=["id", "tag", "start"])
        known = np.zeros(len(rec), np.dtype([("id", "<i8"), ("tag", "<u4")]))
        known["id"], known["tag"] = rec["id"], rec["tag"]
        ids, tags = np.asarray(parts.column("id")), np.asarray(parts.column("tag")).astype(np.uint32)
        nulls = parts.column("null_id").to_pylist()
        wanted = np.zeros(len(ids), known.dtype)
        wanted["id"], wanted["tag"] = ids, tags
        low, high = np.searchsorted(known, wanted, "left"), np.searchsorted(known, wanted, "right")
        out = {name: [] for name in RESULT.names}
        data, offsets = V.utf8(parts.column("text"))
        for i in range(len(ids)):
            body = data[offsets[i] : offsets[i + 1]]
            start, end = _union(rec["start"][low[i] : high[i]].astype(np.int64), rec["end"][low[i] : high[i]].astype(np.int64))
            if len(start):
                keep = np.ones(len(body), bool)
                for a, b in zip(start, end):
                    keep[a:b] = False
                left = body[keep].tobytes()
            else:
                left = body.tobytes()
            for name, value in zip(RESULT.names, (None if nulls[i] else int(ids[i]), left if content else hashlib.sha256(left).digest(), len(body), len(body) - len(left), start, end)):
                out[name].append(value)
        return pa.Table.from_pydict(out, schema=RESULT)

    return texts.groupBy("bucket").cogroup(runs.groupBy("bucket")).applyInArrow(drop, RESULT_DDL)


def _union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of ranges that are sorted by their start; touching ranges are one span."""
    if not len(start):
        return start, end
    far = np.maximum.accumulate(end)
    new = np.concatenate([[True], start[1:] > far[:-1]])
    return start[new], np.concatenate([far[:-1][new[1:]], far[-1:]])


@query("op1_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the removal of repeated 200-byte strings leaves of every document."""
    done = remove(table(spark, sf_dir, "documents").select("doc_id", "text"), content=False)
    return done.select("doc_id", "n_bytes", "n_removed", F.size("span_starts").cast("long").alias("n_spans"), F.lower(F.hex("kept")).alias("kept_sha256"))
