"""Exact Jaccard self-join of documents on word shingles, answered as connected components.

A document's set holds the hashes of its distinct shingles of ``n`` words (fewer words: the whole sequence as one). Two
documents link when ``100 * |x & y| >= percent * |x | y|``.

**Classes.** Documents with equal sets are one class, found by a 96-bit digest of the set; one member stands for it.

**Inverted lists.** Shingles have one global order, frequent ones last. Sets that link share at least l shingles of their
prefixes of ``|x| - ceil(t |x|) + l`` shingles, so the lists hold prefixes only; l grows with the set (``needed``). A set
that stands beside others of a reachable size in fewer lists than that has no link and leaves all lists. Frequency decides the order alone, never the
result: every batch of documents reports the shingles that occur often in it, and the ``FREQUENT`` most frequent of them
(a table of fixed size) are put last.

**Index-level skipping.** A list is sorted by set size and position and cut into blocks. For a set, the blocks whose sizes
are out of reach are skipped as a whole, and within the others each entry whose position leaves too few shingles to reach
the overlap.

**Answer-level skipping.** Only components are asked for, so the answers of a set follow from those of a set that it links
with. The first round verifies each set with its successors in its lists (copies with small changes follow each other) and
forms components. The second decides what is left: entries of a list that lie in one component are answered, and where a
pair across components could link, the set is held against the other component by chunks of at most ``CHUNK`` similar sets.
In a chunk, the overlap with the first set is counted, and those with the others follow from it by their differences to the
first. Together the rounds decide every pair that shares a prefix shingle.

Sets are made anew from the texts of one member of each class that stands in a list with another; these texts are kept
compressed from the first scan, by the number of their row, and shuffled once. No group emits all its pairs: the first round emits at most ``NEXT`` per entry, the second one row per set and chunk.
Lists are shuffled once, as packed records in buckets by the shingle's hash; entries that are alone in their list, which is
most, go no further.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm import vectors as V
from urbanlake.llm.common import query, table
from urbanlake.llm.links import components
from urbanlake.session import stage, unstage

#: Table size of the shingles put last, and how often one must occur in a batch to be reported.
FREQUENT, OFTEN = 200_000, 8
NEXT = 2
BLOCK = 256
CHUNK = 256
SHARE = 50

POSTING = np.dtype([("token", "<u8"), ("class_a", "<u8"), ("class_b", "<u4"), ("size", "<u4"), ("at", "<u4")])
CLASS = np.dtype([("a", "<u8"), ("b", "<u4")])
SCAN = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("packed", pa.binary()), ("token", pa.int64()), ("times", pa.int64())])
SCAN_DDL = "row long, doc_id long, size long, set_a long, set_b long, packed binary, token long, times long"
MULTIPLIERS = V.mix(np.arange(101, 165, dtype=np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 4) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row; words are lower-cased in A-Z."""
    data = V.LOWER[data]
    start, end, at = V.words(data, offsets)
    codes = V.Rolling(data).of(start, end) + V.mix((end - start).astype(np.uint64))
    count = len(codes) - n + 1
    full = np.zeros(max(count, 0), np.uint64)
    for i in range(n):
        if count > 0:
            full += codes[i : i + count] * MULTIPLIERS[i]
    full = V.mix(full)
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= n:
            out.append(np.unique(full[a : b - n + 1]))
        elif b > a:
            out.append(V.mix(np.array([(codes[a:b] * MULTIPLIERS[: b - a]).sum() + MULTIPLIERS[10 + b - a]], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """96 bits that stand for a set."""
    a = V.mix(hashes).sum(dtype=np.uint64)
    b = V.mix(hashes ^ MULTIPLIERS[40]).sum(dtype=np.uint64) + np.uint64(len(hashes))
    return int(a.view(np.int64)), int(b >> np.uint64(32))


def _sets(column, n: int):
    """Row number and set of every row, a step of the batch at a time."""
    data, offsets = V.utf8(column)
    for a, b in V.steps(offsets):
        base = offsets[a]
        for i, s in enumerate(shingle_sets(data[base : offsets[b]], offsets[a : b + 1] - base, n)):
            yield a + i, s


def scan(docs: DataFrame, n: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document (``row, doc_id, size, set_a, set_b``, and its compressed text where it has a set), and rows
    ``token, times`` for what is frequent in a batch. Rows are numbered, since ids may be missing or shared."""

    def read(batches):
        tool = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes, digests, every, texts = [], [], [], batch.column("text")
            for _, s in _sets(batch.column("text"), n):
                sizes.append(len(s))
                digests.append(digest(s))
                every.append(s)
            m = len(sizes)
            # Equal sets count once, so that copies alone make nothing frequent.
            first = {d: i for i, d in reversed(list(enumerate(digests)))}
            tokens, times = np.unique(np.concatenate([every[i] for i in first.values()]), return_counts=True)
            tokens, times = tokens[times >= OFTEN].view(np.int64), times[times >= OFTEN]
            packed = pa.array([tool.compress(texts[i].as_buffer()) if size else None for i, size in enumerate(sizes)], pa.binary())
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "doc_id": batch.column("doc_id"), "size": sizes, "set_a": [d[0] for d in digests], "set_b": [d[1] for d in digests], "packed": packed, "token": pa.nulls(m, pa.int64()), "times": pa.nulls(m, pa.int64())}, schema=SCAN)
            k = len(tokens)
            if k:
                nothing = {c: pa.nulls(k, SCAN.field(c).type) for c in SCAN.names[:6]}
                yield pa.RecordBatch.from_pydict({**nothing, "token": tokens, "times": times}, schema=SCAN)

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(read, SCAN_DDL)


def least_overlap(total, percent: int):
    """The least intersection of two linked sets by the sum of their sizes: 100 i >= percent (total - i)."""
    return -(-percent * total // (100 + percent))


def prefix_length(size: int, percent: int) -> int:
    """Long enough that linked sets share ``needed`` shingles of it, by the size of the smaller."""
    return min(size, size - -(-percent * size // 100) + needed(size))


def needed(size: int) -> int:
    return 1 + size // SHARE


def postings(docs: DataFrame, frequent: np.ndarray, percent: int, n: int) -> DataFrame:
    """The inverted lists of prefixes as blobs of ``POSTING`` by bucket; equal sets of a batch are entered once."""
    count = V.buckets(docs.sparkSession)
    last = docs.sparkSession.sparkContext.broadcast(frequent)

    def read(batches):
        late = last.value
        for batch in batches:
            seen, out = set(), []
            for _, s in _sets(batch.column("text"), n):
                if not len(s) or (d := digest(s)) in seen:
                    continue
                seen.add(d)
                if len(late):
                    spot = np.minimum(np.searchsorted(late["token"], s), len(late) - 1)
                    rank = np.where(late["token"][spot] == s, late["times"][spot], 0)
                    s = s[np.lexsort((s, rank))]
                k = prefix_length(len(s), percent)
                rec = np.zeros(k, POSTING)
                rec["token"], rec["size"], rec["at"] = s[:k], len(s), np.arange(k)
                rec["class_a"], rec["class_b"] = np.int64(d[0]).view(np.uint64), d[1]
                out.append(rec)
            if out:
                rec = np.concatenate(out)
                yield V.rows(list(V.packed((rec["token"] % np.uint64(count)).astype(np.int64), rec, count)), BLOBS)

    return docs.select("text").mapInArrow(read, "bucket int, blob binary")


BLOBS = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
PAIRS = pa.schema([("a1", pa.int64()), ("a2", pa.int64()), ("b1", pa.int64()), ("b2", pa.int64())])
PAIRS_DDL = "a1 long, a2 long, b1 long, b2 long"


def _edges(rec: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], rec["token"][1:] != rec["token"][:-1], [True]])) if len(rec) else np.zeros(1, int)


def lists(entries: DataFrame, percent: int) -> DataFrame:
    """The lists, a row per bucket, sorted by shingle, size, position and class.

    Entries leave that have no other one of a reachable size beside them.
    """

    def sort(group):
        rec = V.unpacked(group.column("blob"), POSTING)
        rec = rec[np.argsort(rec["token"], kind="stable")]
        edge = _edges(rec)
        rec = rec[np.repeat(np.diff(edge) > 1, np.diff(edge))]
        rec = rec[np.lexsort((rec["class_b"], rec["class_a"], rec["at"], rec["size"], rec["token"]))]
        if len(rec):
            rec = rec[np.concatenate([[True], rec[["token", "class_a", "class_b"]][1:] != rec[["token", "class_a", "class_b"]][:-1]])]
            rec = rec[_beside(rec, percent)]
        blob = [(int(group.column("bucket")[0].as_py()), rec.tobytes())] if len(rec) else []
        return pa.Table.from_batches([V.rows(blob, BLOBS)])

    return entries.groupBy("bucket").applyInArrow(sort, "bucket int, blob binary")


def _reaches(rec: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether entries i and j of a list (size of i at most that of j) can still overlap enough."""
    size_i, size_j = rec["size"][i].astype(np.int64), rec["size"][j].astype(np.int64)
    rest = 1 + np.minimum(size_i - rec["at"][i] - 1, size_j - rec["at"][j] - 1)
    return (100 * size_i >= percent * size_j) & (rest >= least_overlap(size_i + size_j, percent))


def _pairs(rec: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.Table:
    """Pairs of classes, smaller digest first, each once."""
    ends = np.zeros((len(i), 4), np.int64)
    for c, k in ((0, i), (2, j)):
        ends[:, c], ends[:, c + 1] = rec["class_a"][k].view(np.int64), rec["class_b"][k]
    swap = (ends[:, 0] > ends[:, 2]) | ((ends[:, 0] == ends[:, 2]) & (ends[:, 1] > ends[:, 3]))
    ends[swap] = ends[swap][:, [2, 3, 0, 1]]
    ends = np.unique(ends, axis=0)
    ends = ends[(ends[:, 0] != ends[:, 2]) | (ends[:, 1] != ends[:, 3])]
    return pa.Table.from_arrays([pa.array(ends[:, c]) for c in range(4)], schema=PAIRS)


def first_round(kept: DataFrame, percent: int) -> DataFrame:
    """Pairs of each entry with its next ones in the list."""

    def meet(batches):
        for batch in batches:
            for blob in batch.column("blob"):
                rec = np.frombuffer(blob.as_buffer(), POSTING)
                edge = _edges(rec)
                end = np.repeat(edge[1:], np.diff(edge))
                found_i, found_j = [], []
                for step in range(1, NEXT + 1):
                    i = np.flatnonzero(np.arange(len(rec)) + step < end)
                    good = _reaches(rec, i, i + step, percent)
                    found_i.append(i[good]), found_j.append(i[good] + step)
                yield from _pairs(rec, np.concatenate(found_i), np.concatenate(found_j)).to_batches()

    return kept.mapInArrow(meet, PAIRS_DDL).distinct()


LABEL = np.dtype([("a", "<u8"), ("b", "<u4"), ("component", "<i8"), ("members", "<i8")])
REST = pa.schema([("a1", pa.int64()), ("a2", pa.int64()), ("component", pa.int64()), ("chunk", pa.int64())])
REST_DDL = "a1 long, a2 long, component long, chunk long"


def second_round(kept: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Sets and chunks of other components that could hold a link: the set is the one of the smaller component."""

    def meet(group, known):
        rec = V.unpacked(group.column("blob"), POSTING)
        edge = _edges(rec)
        label = np.sort(V.unpacked(known.column("blob"), LABEL), order=["a", "b"])
        spot, _ = _known(label, rec)
        if not len(label):
            return REST.empty_table()
        comp, members = label["component"][spot], label["members"][spot]
        own = np.ascontiguousarray(rec["class_a"]).view(np.int64), rec["class_b"].astype(np.int64)
        chunk = own[0] % -(-members // CHUNK)
        out = [np.zeros((0, 4), np.int64)]

        def add(i: np.ndarray, j: np.ndarray) -> None:
            """The set i against the chunk of j."""
            if len(i):
                ends = np.stack([own[0][i], own[1][i], comp[j], chunk[j]], axis=1)
                out.append(np.unique(ends, axis=0))

        for a, b in zip(edge[:-1], edge[1:]):
            if b - a < 2 or (comp[a:b] == comp[a]).all():
                continue
            reach = np.searchsorted(rec["size"][a:b], rec["size"][a:b].astype(np.int64) * 100 // percent, "right") + a
            for block in range(a, b, BLOCK):
                # Sizes grow along the list: what lies beyond the reach of a block's last entry is skipped as a whole.
                i = np.arange(block, min(block + BLOCK, b))
                last = int(reach[i[-1] - a])
                for other in range(block, last, BLOCK):
                    j = np.arange(other, min(other + BLOCK, last))
                    if comp[i[0]] == comp[j[0]] and (comp[i] == comp[i[0]]).all() and (comp[j] == comp[i[0]]).all():
                        continue
                    x, y = np.nonzero((comp[i][:, None] != comp[j][None, :]) & (j[None, :] > i[:, None]) & (j[None, :] < reach[i - a][:, None]))
                    good = _reaches(rec, i[x], j[y], percent)
                    x, y = i[x[good]], j[y[good]]
                    first = (members[x] < members[y]) | ((members[x] == members[y]) & (comp[x] < comp[y]))
                    add(x[first], y[first]), add(y[~first], x[~first])
        found = np.unique(np.concatenate(out), axis=0)
        return pa.Table.from_arrays([pa.array(found[:, c]) for c in range(4)], schema=REST)

    return kept.groupBy("bucket").cogroup(labels.groupBy("bucket")).applyInArrow(meet, REST_DDL).distinct()


def _members(kept: DataFrame) -> DataFrame:
    """``bucket, set_a, set_b, size, times``: the classes of each bucket, and in how many of its lists they stand."""

    def read(batches):
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob")):
                rec = np.frombuffer(blob.as_buffer(), POSTING)
                own = np.zeros(len(rec), CLASS)
                own["a"], own["b"] = rec["class_a"], rec["class_b"]
                own, first, times = np.unique(own, return_index=True, return_counts=True)
                columns = np.full(len(own), bucket, np.int32), own["a"].view(np.int64), own["b"].astype(np.int64), rec["size"][first].astype(np.int64), times
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "set_a", "set_b", "size", "times"])

    return kept.mapInArrow(read, "bucket int, set_a long, set_b long, size long, times long")


def _labels(members: DataFrame, label: DataFrame) -> DataFrame:
    """The components of the classes that each bucket holds, as blobs of ``LABEL``; others are left out."""

    def pack(group):
        rec = np.zeros(group.num_rows, LABEL)
        rec["a"], rec["b"] = np.asarray(group.column("set_a")).view(np.uint64), np.asarray(group.column("set_b"))
        rec["component"], rec["members"] = np.asarray(group.column("component")), np.asarray(group.column("members"))
        return pa.Table.from_batches([V.rows([(int(group.column("bucket")[0].as_py()), rec.tobytes())], BLOBS)])

    joined = members.join(label.hint("merge"), ["set_a", "set_b"]).select("bucket", "set_a", "set_b", "component", "members")
    return joined.groupBy("bucket").applyInArrow(pack, "bucket int, blob binary")


def _known(label: np.ndarray, rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry, its place in the sorted labels, and whether it is there."""
    own, names = np.zeros(len(rec), CLASS), np.zeros(len(label), CLASS)
    own["a"], own["b"] = rec["class_a"], rec["class_b"]
    names["a"], names["b"] = label["a"], label["b"]
    spot = np.minimum(np.searchsorted(names, own), max(len(names) - 1, 0))
    return spot, names[spot] == own if len(names) else np.zeros(len(rec), bool)


def thinned(kept: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The lists without the classes that stand in too few of them to have a link."""
    enough = members.groupBy("set_a", "set_b").agg(F.sum("times").alias("times"), F.max("size").alias("size"))
    # The other set may be smaller, and then fewer shared shingles are certain.
    enough = enough.where(F.col("times") >= 1 + F.floor(F.floor(F.col("size") * percent / 100) / SHARE)).select("set_a", "set_b", F.lit(0).cast("long").alias("component"), F.lit(0).cast("long").alias("members"))

    def keep(group, known):
        rec = V.unpacked(group.column("blob"), POSTING)
        rec = rec[_known(np.sort(V.unpacked(known.column("blob"), LABEL), order=["a", "b"]), rec)[1]]
        rec = rec[_beside(rec, percent)]
        blob = [(int(group.column("bucket")[0].as_py()), rec.tobytes())] if len(rec) else []
        return pa.Table.from_batches([V.rows(blob, BLOBS)])

    return kept.groupBy("bucket").cogroup(_labels(members, enough).groupBy("bucket")).applyInArrow(keep, "bucket int, blob binary")


def _beside(rec: np.ndarray, percent: int) -> np.ndarray:
    """Entries of sorted lists that have another one of a reachable size next to them."""
    near = (rec["token"][1:] == rec["token"][:-1]) & (100 * rec["size"][:-1].astype(np.int64) >= percent * rec["size"][1:].astype(np.int64))
    return np.concatenate([[False], near]) | np.concatenate([near, [False]]) if len(rec) else np.zeros(0, bool)


def member_texts(wanted: DataFrame, classes: DataFrame, scanned: DataFrame) -> DataFrame:
    """``set_a, set_b, packed``: the compressed text of the row that stands for each wanted class."""
    rows = wanted.join(classes.select("set_a", "set_b", "row"), ["set_a", "set_b"])
    return scanned.where("token is null").select("row", "packed").join(rows.hint("merge"), "row").select("set_a", "set_b", "packed")


def _unpack(column) -> pa.Array:
    tool = zstandard.ZstdDecompressor()
    return pa.array([tool.decompress(x.as_buffer()) for x in column], pa.large_binary())


def verify(pairs: DataFrame, texts: DataFrame, percent: int, n: int) -> DataFrame:
    """The pairs that link."""

    def compare(batches):
        for batch in batches:
            x, y = ([s for _, s in _sets(_unpack(batch.column(c)), n)] for c in ("x", "y"))
            both = [len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(x, y)]
            found = [100 * i >= percent * (len(a) + len(b) - i) for i, a, b in zip(both, x, y)]
            yield batch.select(["a1", "a2", "b1", "b2"]).filter(pa.array(found, pa.bool_()))

    left = pairs.hint("merge").join(texts.select(F.col("set_a").alias("a1"), F.col("set_b").alias("a2"), F.col("packed").alias("x")), ["a1", "a2"])
    both = left.hint("merge").join(texts.select(F.col("set_a").alias("b1"), F.col("set_b").alias("b2"), F.col("packed").alias("y")), ["b1", "b2"])
    return both.select("a1", "a2", "b1", "b2", "x", "y").mapInArrow(compare, PAIRS_DDL)


CHUNKS = pa.schema([("component", pa.int64()), ("chunk", pa.int64()), ("ends", pa.binary()), ("members", pa.binary())])
CHUNKS_DDL = "component long, chunk long, ends binary, members binary"
END = np.dtype([("a", "<i8"), ("b", "<i8"), ("bytes", "<i8")])


def verify_chunks(rest: DataFrame, label: DataFrame, texts: DataFrame, percent: int, n: int) -> DataFrame:
    """One link of each set and chunk that have one; a chunk's overlaps follow from that with its first set."""
    chunk = F.pmod(F.col("set_a"), F.ceil(F.col("members") / CHUNK))
    placed = label.select("set_a", "set_b", "component", chunk.alias("chunk"))
    placed = placed.join(rest.select("component", "chunk").distinct(), ["component", "chunk"]).join(texts, ["set_a", "set_b"])

    def pack(group):
        parts = _unpack(group.column("packed"))
        ends = np.zeros(len(parts), END)
        ends["a"], ends["b"], ends["bytes"] = np.asarray(group.column("set_a")), np.asarray(group.column("set_b")), [len(x.as_buffer()) for x in parts]
        # Members are alike, so together they take little more than one.
        body = zstandard.ZstdCompressor(level=3).compress(b"".join(x.as_py() for x in parts))
        row = [pa.array([group.column(c)[0].as_py()], pa.int64()) for c in ("component", "chunk")]
        return pa.Table.from_arrays([*row, pa.array([ends.tobytes()], pa.binary()), pa.array([body], pa.binary())], schema=CHUNKS)

    chunks = placed.select("component", "chunk", "set_a", "set_b", "packed").groupBy("component", "chunk").applyInArrow(pack, CHUNKS_DDL)

    def sets_of(ends: np.ndarray, body: bytes) -> tuple:
        offsets = np.concatenate([[0], np.cumsum(ends["bytes"])])
        column = pa.array([body[a:b] for a, b in zip(offsets[:-1], offsets[1:])], pa.large_binary())
        found = [s for _, s in _sets(column, n)]
        first = found[0]
        lost = [np.setdiff1d(first, s, assume_unique=True) for s in found]
        more = [np.setdiff1d(s, first, assume_unique=True) for s in found]
        size = np.array([len(s) for s in found])
        which = [np.repeat(np.arange(len(found)), [len(d) for d in part]) for part in (lost, more)]
        return first, size, np.concatenate(lost), which[0], np.concatenate(more), which[1]

    def compare(batches):
        known, kept = None, None
        for batch in batches:
            out = []
            y = [s for _, s in _sets(_unpack(batch.column("y")), n)]
            for i, s in enumerate(y):
                name = batch.column("component")[i].as_py(), batch.column("chunk")[i].as_py()
                if name != known:
                    ends = np.frombuffer(batch.column("ends")[i].as_buffer(), END)
                    known, kept = name, sets_of(ends, zstandard.ZstdDecompressor().decompress(batch.column("members")[i].as_buffer()))
                else:
                    ends = np.frombuffer(batch.column("ends")[i].as_buffer(), END)
                first, size, lost, lost_of, more, more_of = kept
                both = np.full(len(size), len(np.intersect1d(s, first, assume_unique=True)))
                both -= np.bincount(lost_of[np.isin(lost, s)], minlength=len(size))
                both += np.bincount(more_of[np.isin(more, s)], minlength=len(size))
                hit = np.flatnonzero(100 * both >= percent * (size + len(s) - both))
                if len(hit):
                    out.append((batch.column("a1")[i].as_py(), batch.column("a2")[i].as_py(), int(ends["a"][hit[0]]), int(ends["b"][hit[0]])))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(4)], schema=PAIRS)

    left = rest.join(texts.select(F.col("set_a").alias("a1"), F.col("set_b").alias("a2"), F.col("packed").alias("y")), ["a1", "a2"])
    both = left.join(chunks, ["component", "chunk"]).select("a1", "a2", "component", "chunk", "y", "ends", "members")
    return both.mapInArrow(compare, PAIRS_DDL)


def join(docs: DataFrame, n: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per row of ``docs``.

    ``component_id`` is the smallest id reachable by links, its own included. A document without words (null, empty or blank
    text) has the empty set and its own id. Repeated rows, and rows that share an id, are documents of their own that may
    link; a null id counts as smaller than none, so a component takes it only where no other id is there. Other columns are
    not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scanned = stage(scan(docs, n), "join-scan")
    found = scanned.where("token is not null").groupBy("token").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "token").limit(FREQUENT).toArrow()
    frequent = np.zeros(found.num_rows, np.dtype([("token", "<u8"), ("times", "<i8")]))
    frequent["token"], frequent["times"] = np.asarray(found.column("token")).view(np.uint64), np.asarray(found.column("times"))
    frequent.sort(order="token")
    rows = scanned.where("token is null").select("row", "doc_id", "size", "set_a", "set_b")
    classes = stage(rows.where("size > 0").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row")), "join-classes")

    full = stage(lists(postings(docs, frequent, percent, n), percent), "join-lists")
    kept = stage(thinned(full, _members(full), percent), "join-lists")
    unstage(full)
    texts = stage(member_texts(_members(kept).select("set_a", "set_b").distinct(), classes, scanned), "join-texts")
    number = classes.select("set_a", "set_b", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("low"), F.col("row").alias("node"))

    def ends(one: str, two: str, name: str) -> DataFrame:
        return number.select(F.col("set_a").alias(one), F.col("set_b").alias(two), F.col("node").alias(name))

    def labelled(links: DataFrame) -> DataFrame:
        """Components of all classes: ``set_a, set_b, low, component, members``; a class's node is the number of its row."""
        parts = components(links.join(ends("a1", "a2", "a"), ["a1", "a2"]).join(ends("b1", "b2", "b"), ["b1", "b2"]).select("a", "b"))
        every = stage(number.join(parts, "node", "left").select("set_a", "set_b", "low", F.coalesce("component", "node").alias("component")), "join-components")
        sizes = every.groupBy("component").agg(F.count("*").alias("members")).where("members > 1")
        return every.join(sizes, "component", "left").select("set_a", "set_b", "low", "component", F.coalesce("members", F.lit(1)).alias("members"))

    links = stage(verify(first_round(kept, percent), texts, percent, n), "join-links")
    label = stage(labelled(links), "join-labels")
    rest = stage(second_round(kept, _labels(_members(kept), label.select("set_a", "set_b", "component", "members")), percent), "join-rest")
    more = stage(verify_chunks(rest, label, texts, percent, n), "join-links")
    if not more.isEmpty():
        unstage(label)
        label = stage(labelled(links.union(more)), "join-labels")
    for part in (kept, texts, links, rest, more):
        unstage(part)
    smallest = label.groupBy("component").agg(F.min("low").alias("component_id"))
    of_class = label.join(smallest, "component").select("set_a", "set_b", "component_id")
    own = rows.join(of_class, ["set_a", "set_b"], "left").select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.when(F.col("component_id") < 2**63 - 1, F.col("component_id"))).otherwise(F.col("doc_id")).alias("component_id"))
    return own


@query("op10_ngram_join")
def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set and its component of links."""
    return join(table(spark, sf_dir, "documents").select("doc_id", "text"))
