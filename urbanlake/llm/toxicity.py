"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

Features are the character n-grams (4 to 6 code points of the lower-cased text) that a text holds, hashed to ``2 ** BITS``
buckets; a gram counts once however often it occurs, so long texts are not louder than short ones.

1. The grams' document counts by class are summed over the training rows. A gram's scale is its log-count ratio
   ``r = log((p + 1) / (P + 2)) - log((q + 1) / (N + 2))``. Grams whose classes do not differ beyond chance (``LEAST_Z``)
   or by little (``LEAST_RATIO``) are left out: their ratio is noise.
2. Logistic regression with an L2 penalty is fitted on ``r * presence``.
3. Every document is scored with the product of scale and weight, a table of at most ``2 ** BITS`` numbers.

Training reads at most ``TRAIN_ROWS`` labelled rows, those with the least hash of their id; all documents are scored whole.
Only the text is read for a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm import vectors as V
from urbanlake.llm.common import query, table
from urbanlake.session import stage

LENGTHS = (4, 5, 6)
BITS = 21
TRAIN_ROWS = 20_000
LEAST_Z, LEAST_RATIO, LEAST_DOCUMENTS = 4.0, 1.0, 5
PENALTY = 1.0
FACTOR = np.uint64(0x100000001B3)
SPREAD = np.uint64(0x9E3779B97F4A7C15)
PAD = "\x00" * (max(LENGTHS) - 1)


def grams(texts: list[str], width: int = 1 << 20):
    """Yields (first text, number of texts, text of each gram, bucket of each gram), some texts at a time."""
    a = 0
    while a < len(texts):
        b, size, parts = a, 0, []
        while b < len(texts) and (b == a or size < width):
            parts.append(PAD + (texts[b] or "").lower())
            size += len(parts[-1])
            b += 1
        codes = np.frombuffer(("".join(parts) + PAD).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        owner = np.repeat(np.arange(b - a), [len(p) for p in parts])
        codes *= SPREAD
        codes ^= codes >> np.uint64(29)
        value, out = codes, []
        count = len(owner)
        for n in range(2, max(LENGTHS) + 1):
            value = value[:-1] * FACTOR + codes[n - 1 :]
            if n in LENGTHS:
                out.append(((value[:count] * SPREAD) >> np.uint64(64 - BITS)).astype(np.int32))
        yield a, b - a, owner, out
        a = b


def training(labels: DataFrame, key: str = "doc_id", label: str = "toxic", rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, label`` of the rows to learn from: not held out, at most ``rows``. Null ids and labels are left out."""
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
    ids = usable.groupBy(F.col(key).alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    return ids.orderBy(F.crc32(F.concat(F.lit("train"), F.col("doc_id").cast("string"))), "doc_id").limit(rows)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


COUNTS = np.dtype([("bucket", "<u4"), ("one", "<u4"), ("zero", "<u4")])
SLICES = 32


def class_counts(train: DataFrame) -> DataFrame:
    """``bucket, one, zero``: documents of either class that hold a gram of the bucket; ``train`` has ``text, label``."""

    def read(batches):
        sums, used = np.zeros((2, 1 << BITS), np.uint32), False
        for batch in batches:
            labels = np.asarray(batch.column("label"))
            for first, _, owner, found in grams(batch.column("text").to_pylist()):
                keys = np.unique(np.concatenate([(owner.astype(np.int64) << BITS) | b for b in found]))
                label = labels[first + (keys >> BITS)]
                for c in (0, 1):
                    sums[c] += np.bincount(keys[label == c] & ((1 << BITS) - 1), minlength=1 << BITS).astype(np.uint32)
                used = True
        if used:
            at = np.flatnonzero(sums[0] + sums[1])
            rec = np.zeros(len(at), COUNTS)
            rec["bucket"], rec["one"], rec["zero"] = at, sums[1][at], sums[0][at]
            yield V.rows(list(V.packed(at % SLICES, rec, SLICES)), BLOBS)

    def add(group):
        rec = V.unpacked(group.column("blob"), COUNTS)
        buckets, where = np.unique(rec["bucket"], return_inverse=True)
        one, zero = (np.bincount(where, rec[c]).astype(np.int64) for c in ("one", "zero"))
        return pa.table({"bucket": buckets.astype(np.int64), "one": one, "zero": zero})

    return train.select("text", "label").mapInArrow(read, "slice int, blob binary").groupBy("slice").applyInArrow(add, "bucket long, one long, zero long")


BLOBS = pa.schema([("slice", pa.int32()), ("blob", pa.binary())])


def ratios(counts: DataFrame, positives: int, negatives: int) -> DataFrame:
    """``bucket, ratio``: the log-count ratio of the grams whose classes differ beyond chance."""
    p, q, big_p, big_n = F.col("one"), F.col("zero"), F.lit(float(max(positives, 1))), F.lit(float(max(negatives, 1)))
    rate = (p + q) / (big_p + big_n)
    z = (p / big_p - q / big_n) / F.sqrt(rate * (1 - rate) * (1 / big_p + 1 / big_n))
    ratio = F.log((p + 1) / (big_p + 2)) - F.log((q + 1) / (big_n + 2))
    return counts.where((p + q >= LEAST_DOCUMENTS) & (rate < 1)).where((F.abs(z) >= LEAST_Z) & (F.abs(ratio) >= LEAST_RATIO)).select("bucket", ratio.alias("ratio"))


def logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, labels: np.ndarray, features: int, penalty: float = PENALTY, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient steps scaled per weight; entries are given as coordinates."""
    weights, bias = np.zeros(features), 0.0
    mean, square, t = np.zeros(features + 1), np.zeros(features + 1), 0
    n = max(len(labels), 1)
    for t in range(1, steps + 1):
        score = np.bincount(rows, weights[columns] * values, minlength=len(labels)) + bias
        error = 1 / (1 + np.exp(-np.clip(score, -50, 50))) - labels
        slope = np.append(np.bincount(columns, error[rows] * values, minlength=features) + penalty * weights, error.sum()) / n
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        move = 0.05 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, bias


class Model:
    """Buckets in rising order, the factor of each, and the bias."""

    def __init__(self, buckets: np.ndarray, factors: np.ndarray, bias: float):
        self.buckets, self.factors, self.bias = buckets, factors, bias


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Learn from the labelled documents; without any, every score is one half."""
    # At most TRAIN_ROWS ids.
    known = training(labels, key, label, rows)
    train = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known), "doc_id")
    train = stage(train.select("text", "label"), "toxicity-train")
    by_class = {r.label: r.n for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not by_class:
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    # At most 2 ** BITS rows.
    scale = ratios(class_counts(train), by_class.get(1, 0), by_class.get(0, 0)).toArrow().sort_by("bucket")
    buckets, ratio = np.asarray(scale.column("bucket"), np.int64), np.asarray(scale.column("ratio"), float)
    shared = docs.sparkSession.sparkContext.broadcast(buckets)

    def hold(batches):
        lookup = _lookup(shared.value, np.arange(1, len(shared.value) + 1, dtype=np.int32))
        for batch in batches:
            out = []
            for _, count, owner, found in grams(batch.column("text").to_pylist()):
                out += _present(lookup, owner, found, count)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([f.tobytes() for f in out], pa.binary())], names=["label", "features"])

    def learn(group):
        """At most TRAIN_ROWS rows of feature numbers, put in an order that does not depend on the partitions."""
        group = group.sort_by([("label", "ascending"), ("features", "ascending")])
        features = [np.frombuffer(x.as_buffer(), np.int32) for x in group.column("features")]
        at = np.repeat(np.arange(len(features), dtype=np.int32), [len(f) for f in features])
        columns = np.concatenate(features)
        weights, bias = logistic(at, columns, ratio[columns], np.asarray(group.column("label"), float), len(ratio))
        return pa.table({"weights": pa.array([weights.tolist()], pa.list_(pa.float64())), "bias": pa.array([bias], pa.float64())})

    held = train.mapInArrow(hold, "label int, features binary").groupBy(F.lit(0).alias("all")).applyInArrow(learn, "weights array<double>, bias double")
    found = held.first()
    return Model(buckets, np.array(found["weights"]) * ratio, found["bias"])


def _lookup(buckets: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << BITS, values.dtype)
    out[buckets] = values
    return out


def _present(lookup: np.ndarray, owner: np.ndarray, found: list[np.ndarray], count: int) -> list[np.ndarray]:
    """For each text, the numbers (from 0) of the features that it holds."""
    keys = []
    for buckets in found:
        number = lookup[buckets]
        hit = np.flatnonzero(number)
        keys.append((owner[hit].astype(np.int64) << 32) | (number[hit] - 1))
    keys = np.unique(np.concatenate(keys))
    edges = np.searchsorted(keys >> 32, np.arange(count + 1))
    return np.split((keys & 0xFFFFFFFF).astype(np.int32), edges[1:-1])


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with ``out``, a double from 0 to 1. Null and empty texts get what the bias says.

    A column called ``out`` is replaced; all others pass unchanged.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.buckets, model.factors, model.bias))
    kept = docs.drop(out)
    schema = kept.select("*", F.lit(0.0).alias(out)).schema

    def read(batches):
        buckets, factors, bias = shared.value
        lookup = _lookup(buckets, np.arange(1, len(buckets) + 1, dtype=np.int32))
        for batch in batches:
            total = np.full(batch.num_rows, bias)
            for first, count, owner, found in grams(batch.column(text).to_pylist()):
                for i, features in enumerate(_present(lookup, owner, found, count)):
                    total[first + i] += factors[features].sum()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))], names=[*batch.schema.names, out])

    return kept.mapInArrow(read, schema)


@query("op6_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
