"""Near duplicates by MinHash bands, with odd sketches that judge candidates before their sets are compared.

A document's set holds the hashes of its distinct shingles of ``n`` words (fewer words: the whole sequence as one). Two
documents link when ``100 * |x & y| >= percent * |x | y|``; components of links are answered.

**Samples.** One pass over the texts makes, for each set, a 128-bit digest, ``BANDS`` band hashes of ``ROWS`` MinHash values
each, and an odd sketch. Documents with equal digests are one class; one row stands for it. At a similarity of 0.85, the
smallest that links, two sets share no band with a probability of ``(1 - 0.85 ** 4) ** 28``, which is 1.1e-9.

**Odd sketch.** Each shingle of a set of up to ``WHOLE`` flips one of ``BITS`` bits, so that the shingles that two sets share
cancel in the XOR of their bitmaps: it has no more bits than the sets have shingles of their own. Pairs whose bitmaps differ in more
bits than linked sets of their sizes have such shingles are dropped, and no link is lost by that. A larger set flips the bits
of samples: the hash space is cut into ``SAMPLES`` cells and the least hash of a cell is its sample. Of two larger sets the
population count gives the number of samples in which they differ, hence their similarity; estimates from ``MARGIN`` below
the threshold pass, which is eight deviations (0.012, measured on sets of 4200 to 20000 shingles). A set of either kind is held
against one of the other by size alone. Sketches drop candidates only; what links is decided on the full sets.

**Rounds.** Classes that share a band are candidates, and only components are asked for. In a round, every band takes one of
its classes as its centre, by a random order of all classes, and the others are held against it where they are not yet in its
component: a number of pairs that grows with the entries, however large a band is. As the order is the same in all bands,
copies that share many bands meet few centres in them, and each centre once. After ``TURNS`` rounds most bands lie in one component each
and are answered. In the others, the entries of lesser components are held against all by their sketches, in blocks and inside
the task; what leaves it is a class and a chunk of at most ``CHUNK`` members of another component, and the full sets of these
are compared together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm import vectors as V
from urbanlake.llm.common import query, table
from urbanlake.llm.links import components
from urbanlake.llm.ngram_join import CHUNK, shingle_sets, verify_chunks
from urbanlake.session import stage, unstage

BANDS, ROWS = 28, 4
SAMPLES, BITS = 1024, 2048
#: Shingles of the largest set whose sketch holds them all.
WHOLE = 4096
TURNS = 3
MARGIN = 10
BLOCK = 512
WORDS = BITS // 64

_CONSTANTS = V.mix(np.arange(1001, 1001 + 2 * BANDS * ROWS + 8, dtype=np.uint64))
MULTIPLY, ADD = _CONSTANTS[: BANDS * ROWS] | np.uint64(1), _CONSTANTS[BANDS * ROWS : 2 * BANDS * ROWS]
SALTS = _CONSTANTS[-8:]

SCAN_DDL = "row long, doc_id long, size long, set_a long, set_b long, samples long, bands array<long>, sketch array<long>, packed binary"


def sets_of(column, n: int):
    """Row number and set of every row, some rows at a time."""
    data, offsets = V.utf8(column)
    for a, b in V.steps(offsets):
        base = offsets[a]
        yield a, shingle_sets(data[base : offsets[b]], offsets[a : b + 1] - base, n)


def signatures(every: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The band hashes of the sets that begin at ``starts`` in ``every``; none is empty."""
    bands = np.zeros((len(starts), BANDS), np.uint64)
    for band in range(BANDS):
        for r in range(ROWS):
            i = band * ROWS + r
            least = np.minimum.reduceat(every * MULTIPLY[i] + ADD[i], starts)
            bands[:, band] = V.mix(bands[:, band] ^ (least >> np.uint64(16)) + SALTS[r])
    return bands ^ SALTS[4] * np.arange(1, BANDS + 1, dtype=np.uint64)


def odd_sketches(every: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of samples (all shingles of a set of up to ``WHOLE``), and the parity bitmap, of each set."""
    sizes = np.diff(np.append(starts, len(every)))
    owner = np.repeat(np.arange(len(starts)), sizes)
    spread = V.mix(every ^ SALTS[5])
    whole = np.repeat(sizes <= WHOLE, sizes)
    large = np.flatnonzero(~whole)
    cell = owner[large] * SAMPLES + (spread[large] % np.uint64(SAMPLES)).astype(np.int64)
    order = np.lexsort((spread[large], cell))
    least = large[order[np.diff(cell[order], prepend=-1) != 0]]
    first = np.concatenate([np.flatnonzero(whole), least])
    bit = V.mix(spread[first] ^ SALTS[6]) % np.uint64(BITS)
    words = np.zeros(len(starts) * WORDS, np.uint64)
    np.bitwise_xor.at(words, owner[first] * WORDS + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return np.bincount(owner[first], minlength=len(starts)), words.reshape(len(starts), WORDS)


def digests(every: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for each set."""
    return np.add.reduceat(V.mix(every), starts), V.mix(np.add.reduceat(V.mix(every ^ SALTS[7]), starts))


def scan(docs: DataFrame, n: int) -> DataFrame:
    """One row per document: the measures of its set (null where it is empty) and its compressed text."""

    def read(batches):
        tool = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column("text")
            for low, sets in sets_of(texts, n):
                size = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(size)
                every = np.concatenate([sets[i] for i in full]) if len(full) else np.zeros(0, np.uint64)
                starts = np.concatenate([[0], np.cumsum(size[full])[:-1]]).astype(np.int64) if len(full) else full
                out = [[None] * len(sets) for _ in range(6)]
                if len(full):
                    a, b = digests(every, starts)
                    samples, sketch = odd_sketches(every, starts)
                    bands = signatures(every, starts)
                    for k, i in enumerate(full):
                        packed = tool.compress(texts[low + int(i)].as_buffer())
                        for column, value in zip(out, (int(a[k].view(np.int64)), int(b[k].view(np.int64)), int(samples[k]), bands[k].view(np.int64), sketch[k].view(np.int64), packed)):
                            column[i] = value
                part = batch.slice(low, len(sets))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
                columns = [part.column("row"), part.column("doc_id"), pa.array(size), *(pa.array(c, k) for c, k in zip(out, kinds))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "size", "set_a", "set_b", "samples", "bands", "sketch", "packed"])

    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(read, SCAN_DDL)


def likely(a: str, b: str, percent: int) -> Column:
    """Whether two sketched sets (structs ``size, samples, sketch``) can link: by their sizes, exactly, and by their sketches.

    Linked sets share at least ``percent (|x| + |y|) / (100 + percent)`` shingles, rounded up; the others are their own, and
    flip that many bits at most. Of sampled sets, the samples that differ are ``ln(1 - 2 z / BITS) / ln(1 - 2 / BITS)`` by the
    bits z that differ. At the threshold the union has ``100 (|x| + |y|) / (100 + percent)`` shingles, which fill so many
    cells; the samples that are shared, as a part of these, estimate the similarity.
    """
    least, most = F.least(f"{a}.size", f"{b}.size"), F.greatest(f"{a}.size", f"{b}.size")
    bits = sum((F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(WORDS)), F.lit(0))
    own = (100 + percent) * bits <= (100 - percent) * (least + most)
    odd = F.least(bits, F.lit(BITS // 2 - 1))
    differ = F.log(1 - 2 * odd / F.lit(float(BITS))) / float(np.log(1 - 2 / BITS))
    shared = (F.col(f"{a}.samples") + F.col(f"{b}.samples") - differ) / 2
    cells = SAMPLES * (1 - F.exp((least + most) * (-100.0 / (100 + percent) / SAMPLES)))
    alike = F.when(most <= WHOLE, own).when(least <= WHOLE, True).otherwise(100 * shared >= (percent - MARGIN) * cells)
    return (100 * least >= percent * most) & alike


def likely_arrays(a: np.ndarray, b: np.ndarray, samples: np.ndarray, odd: np.ndarray, percent: int) -> np.ndarray:
    """The same for arrays: sizes of both sets, the sum of their samples, the bits that differ."""
    own = (100 + percent) * odd <= (100 - percent) * (a + b)
    differ = np.log(1 - 2 * np.minimum(odd, BITS // 2 - 1) / BITS) / np.log(1 - 2 / BITS)
    cells = SAMPLES * (1 - np.exp((a + b) * (-100.0 / (100 + percent) / SAMPLES)))
    most, least = np.maximum(a, b), np.minimum(a, b)
    alike = np.where(most <= WHOLE, own, (least <= WHOLE) | (50 * (samples - differ) >= (percent - MARGIN) * cells))
    return (100 * least >= percent * most) & alike


def _unpack(column) -> pa.Array:
    tool = zstandard.ZstdDecompressor()
    return pa.array([tool.decompress(x.as_buffer()) for x in column], pa.large_binary())


def verify(pairs: DataFrame, texts: DataFrame, percent: int, n: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets link."""

    def compare(batches):
        for batch in batches:
            x, y = ([s for _, part in sets_of(_unpack(batch.column(c)), n) for s in part] for c in ("x", "y"))
            both = [len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(x, y)]
            found = [100 * i >= percent * (len(a) + len(b) - i) for i, a, b in zip(both, x, y)]
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("packed").alias("x")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("packed").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def crowded(sketched: DataFrame) -> DataFrame:
    """``band, node, others``: the entries of bands that more than one class shares. Counts are aggregated before they move."""
    entries = sketched.select("node", F.explode("bands").alias("band"))
    counts = entries.groupBy("band").agg(F.count("*").alias("others")).where("others > 1")
    return entries.join(counts, "band").select("band", "node", "others")


def centred(entries: DataFrame, seed: int) -> DataFrame:
    """``a, b``: each entry with its band's centre, the first class by an order of the round, where that is in another component."""
    order = F.xxhash64("node", F.lit(seed))
    centres = entries.groupBy("band").agg(F.min(F.struct(order.alias("order"), "node", "component")).alias("centre"))
    met = entries.join(centres, "band").where("component <> centre.component")
    return met.select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b")).distinct()


REST = pa.schema([("a1", pa.int64()), ("a2", pa.int64()), ("component", pa.int64()), ("chunk", pa.int64())])


def across(entries: DataFrame, sketches: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """``a1, a2, component, chunk``: classes, and chunks of other components that hold a likely partner in a common band.

    Of every two components in a band, one is not the band's largest: its entries are dealt to blocks of about ``BLOCK``, and
    all entries of the band stream past them. The sketches' test takes place in the task, so no pair leaves it.
    """
    parts = entries.groupBy("band", "component").agg(F.count("*").alias("n"))
    main = parts.groupBy("band").agg(F.max_by("component", F.struct("n", "component")).alias("main"), (F.sum("n") - F.max("n")).alias("rest"))
    known = entries.select("band", "node", "component").join(main, "band").join(sketches, "node").join(members, "component")
    blocks = F.ceil(F.col("rest") / BLOCK).cast("int")
    columns = ["band", "block", "side", "node", "component", "main", "members", "size", "samples", "sketch"]
    left = known.where("component <> main").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("side", F.lit(0))
    right = known.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("side", F.lit(1))
    dealt = left.select(columns).union(right.select(columns)).repartition("band", "block").sortWithinPartitions("band", "block", "side")

    def meet(batches):
        name, held = None, None
        for batch in batches:
            rows = {c: np.asarray(batch.column(c)) for c in columns[:-1]}
            rows["sketch"] = np.asarray(batch.column("sketch").flatten()).view(np.uint64).reshape(-1, WORDS)
            keys = np.stack([rows["band"], rows["block"]])
            edges = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0), [True]])) if batch.num_rows else [0]
            for low, high in zip(edges[:-1], edges[1:]):
                if name != (name := (rows["band"][low], rows["block"][low])):
                    held = None
                part = {c: v[low:high] for c, v in rows.items()}
                own = {c: v[part["side"] == 0] for c, v in part.items()}
                held = {c: np.concatenate([held[c], v]) for c, v in own.items()} if held else own
                found = _partners(held, {c: v[part["side"] == 1] for c, v in part.items()}, percent)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, c]) for c in range(4)], schema=REST)

    return dealt.mapInArrow(meet, "a1 long, a2 long, component long, chunk long").distinct()


def _partners(x: dict, y: dict, percent: int) -> np.ndarray:
    """Entries of x with the chunks of the likely partners among y, each once. Of two lesser components, the smaller one asks."""
    out = [np.zeros((0, 4), np.int64)]
    step = max(1, (1 << 21) // (max(1, len(x["node"])) * WORDS))
    for low in range(0, len(y["node"]) if len(x["node"]) else 0, step):
        z = {c: v[low : low + step] for c, v in y.items()}
        asks = (x["members"][:, None] < z["members"]) | ((x["members"][:, None] == z["members"]) & (x["component"][:, None] < z["component"])) | (z["component"] == z["main"])
        asks &= x["component"][:, None] != z["component"]
        odd = np.bitwise_count(x["sketch"][:, None, :] ^ z["sketch"][None, :, :]).sum(axis=2, dtype=np.int64)
        i, j = np.nonzero(asks & likely_arrays(x["size"][:, None], z["size"], x["samples"][:, None] + z["samples"], odd, percent))
        if len(i):
            chunk = z["node"][j] % -(-z["members"][j] // CHUNK)
            out.append(np.unique(np.stack([x["node"][i], np.zeros(len(i), np.int64), z["component"][j], chunk], axis=1), axis=0))
    return np.unique(np.concatenate(out), axis=0)


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of ``docs``.

    ``component_id`` is the smallest id reachable by links, its own included, and ``kept`` says whether that is the own one.
    A document without words (null, empty or blank text) has the empty set, its own id, and is kept. Repeated rows, and rows
    that share an id, are documents of their own that may link; a null id counts as larger than all, so a component has one
    only where all its ids are null, and then its rows are kept. Other columns are not read; an empty table gives no rows.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scanned = stage(scan(docs, n), "minhash-scan")
    classes = stage(scanned.where("size > 0").groupBy("set_a", "set_b").agg(F.min("row").alias("node"), F.min("doc_id").alias("low")), "minhash-classes")
    members = scanned.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    entries = stage(crowded(members.select(F.col("row").alias("node"), "bands")), "minhash-bands")
    some = entries.select("node").distinct()
    sketched = stage(members.withColumnRenamed("row", "node").join(some, "node", "left_semi").select("node", "size", "samples", "sketch", "packed"), "minhash-sketches")
    sketches, texts = sketched.select("node", "size", "samples", "sketch"), sketched.select("node", "packed")
    named = texts.select(F.col("node").alias("set_a"), F.lit(0).cast("long").alias("set_b"), "packed")

    def checked(pairs: DataFrame) -> DataFrame:
        l, r = (sketches.select(F.col("node").alias(c), F.struct("size", "samples", "sketch").alias(s)) for c, s in (("a", "l"), ("b", "r")))
        return pairs.join(l, "a").join(r, "b").where(likely("l", "r", percent)).select("a", "b")

    links, used = None, [entries, sketched]
    label = stage(some.withColumn("component", F.col("node")), "minhash-labels")
    placed = open_bands(entries, label)
    for turn in range(TURNS + 1):
        if turn < TURNS:
            found = stage(verify(checked(centred(placed, turn)), texts, percent, n), "minhash-links")
        else:
            # Whatever the centres have left open.
            members = label.groupBy("component").agg(F.count("*").alias("members"))
            rest = stage(across(placed, sketches, members, percent), "minhash-rest")
            sized = label.join(members, "component").select(F.col("node").alias("set_a"), F.lit(0).cast("long").alias("set_b"), "component", "members")
            found = stage(verify_chunks(rest, sized, named, percent, n).select(F.col("a1").alias("a"), F.col("b1").alias("b")), "minhash-links")
            used.append(rest)
        used += [placed, found]
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            unstage(label)
            label = stage(some.join(components(links), "node", "left").select("node", F.coalesce("component", "node").alias("component")), "minhash-labels")
            placed = open_bands(entries, label)
        if placed.isEmpty():
            break
    used.append(placed)
    for part in used:
        unstage(part)
    smallest = classes.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = smallest.groupBy("component").agg(F.min("low").alias("component_id"))
    of_class = smallest.join(ids, "component").select("set_a", "set_b", "component_id")
    rows = scanned.select("doc_id", F.col("size").alias("n_shingles"), "set_a", "set_b").join(of_class, ["set_a", "set_b"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def open_bands(entries: DataFrame, label: DataFrame) -> DataFrame:
    """The entries of bands that hold more than one component, with their components."""
    placed = entries.join(label, "node")
    spread = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("band")
    return stage(placed.join(spread, "band", "left_semi"), "minhash-open")


@query("op11_minhash")
def minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near duplicates, and whether it is the one that stays."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
