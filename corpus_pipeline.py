"""The corpus pipeline: from ``documents`` to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``. Rows that share an id, or have none, are documents of their
own in every stage. Null texts count as empty, and an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm import mixing, ngram_join, packing, secrets, toxicity
from urbanlake.llm.common import WORD, text_of
from urbanlake.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOXIC_FROM = 0.5
#: How often a document of a small source may be read, so that small sources gain weight.
MAX_REPETITION = 1.25


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half; it learns from the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    docs = docs.select(*COLUMNS)
    return toxicity.score(docs, toxicity.fit(docs, labels)).where(F.col("toxicity") < TOXIC_FROM).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates (five words, a similarity of 0.8): that with the smallest id.

    A null id counts as larger than all, and ties go by a hash of the text. Texts without words are in no component and
    all stay.
    """
    # Rows are numbered, so that no two can be taken for one; the numbers are stored with them.
    keyed = stage(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_key")), "pipeline-rows")
    worded = text_of().rlike(WORD)
    groups = ngram_join.join(keyed.where(worded).select("_key", "text"), n=5, percent=80, key="_key").select(F.col("doc_id").alias("_key"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("tie"), "_key")).alias("first")
    firsts = keyed.where(worded).join(groups, "_key").groupBy("component_id").agg(first).select(F.col("first._key").alias("_key"))
    kept = keyed.where(worded).join(firsts, "_key", "left_semi")
    return kept.select(*COLUMNS).union(keyed.where(~worded).select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced by a mark and its length counted again where it had any."""
    done = secrets.redact(docs.select(*COLUMNS).withColumn("_before", F.length("text")))
    return done.withColumn("n_chars", F.when(F.length("text") == F.col("_before"), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and again as often as the weight of its source asks for.

    The budget reads the largest source once and the others up to ``MAX_REPETITION`` times, so none loses a document.
    """
    # Rows are numbered, so that each is a document of its own; the numbers are stored with them.
    keyed = stage(docs.select(*COLUMNS, mixing.word_count().alias("n_tokens"), F.monotonically_increasing_id().alias("_key")), "mix-rows")
    read = mixing.mix(keyed.select("_key", "source", "n_tokens"), max_repetition=MAX_REPETITION, key="_key").groupBy("_key").agg(F.count("*").alias("_times"))
    times = F.sequence(F.lit(1), F.greatest(F.coalesce("_times", F.lit(1)), F.lit(1)).cast("int"))
    return keyed.join(read, "_key", "left").select(*COLUMNS, F.explode(times).alias("_time")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.packed_documents(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", one_of_each_group),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL has no tokenizer and no classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
