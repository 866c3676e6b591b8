"""Temperature mixing of sources: exponentiated shares under a target, realised as budgeted block permutations.

1. The token share ``p`` of every source is summed. Weights are ``p ** a / sum(p ** a)``: ``a = 1`` keeps the shares,
   ``a = 0`` gives every source the same weight.
2. The exponent is bisected, ``a`` in [0, 1]: for a target entropy (of the weights, as a part of the largest possible) the
   largest ``a`` that still reaches it, or for a repetition limit the smallest ``a`` at which no source has to be read more
   than ``max_repetition`` times. The halving steps run six to a job, each over the one row per source.
3. A source's budget is read in epochs. Its documents lie in blocks by a hash of their id; an epoch visits the blocks in an
   order that a hash of seed, epoch and block gives, and the documents of a block in an order of the same kind. Only the
   last epoch is partial: it ends with the document that reaches the budget.

Every sort stays within one block, or within one bundle of blocks, or over the bundles of one source: about the cube root
of a source's size each, so that a source with a third of all rows is ordered by many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from urbanlake.llm.common import WORD, query, table
from urbanlake.session import stage

STEPS = 6


def word_count(column: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(column), F.lit("")), F.lit(WORD)).cast("long")


def totals(docs: DataFrame, source: str = "source", tokens: str = "n_tokens") -> DataFrame:
    """One row per source: ``source, tokens, documents``. A null source is a source of its own."""
    return docs.groupBy(F.col(source).alias("source")).agg(F.sum(tokens).alias("tokens"), F.count("*").alias("documents"))


def bisect_exponent(by_source: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None, budget: int | None = None, rounds: int = 5) -> float:
    """The exponent in [0, 1]: see the module. ``budget`` null means the largest source is read exactly once.

    A target that even ``a = 0`` (entropy) or ``a = 1`` (repetition) misses gives that end. No tokens at all give 1.
    """
    if (target_entropy is None) == (max_repetition is None):
        raise ValueError("give either target_entropy or max_repetition")
    live = by_source.where("tokens > 0")
    n, total, largest = live.agg(F.count("*"), F.sum("tokens"), F.max("tokens")).first()
    if not n:
        return 1.0
    share = F.col("tokens") / F.lit(float(total))
    low, high = 0.0, 1.0
    for _ in range(rounds):
        grid = [low + (high - low) * i / 2**STEPS for i in range(1, 2**STEPS)]
        sums = []
        for i, a in enumerate(grid):
            power = F.pow(share, F.lit(a))
            sums += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log(power)).alias(f"l{i}"), F.max(power / share).alias(f"r{i}")]
        row = live.agg(*sums).first()

        def holds(i: int) -> bool:
            """Whether this exponent is on the low side of the answer."""
            z = row[f"z{i}"]
            if target_entropy is not None:
                return math.log(z) - row[f"l{i}"] / z >= target_entropy * math.log(n) - 1e-12
            reading = budget / total if budget else (largest / total) ** (1 - grid[i]) * z
            return row[f"r{i}"] / z * reading > max_repetition

        first, last = -1, len(grid)
        while last - first > 1:
            middle = (first + last) // 2
            first, last = (middle, last) if holds(middle) else (first, middle)
        low, high = (grid[first] if first >= 0 else low), (grid[last] if last < len(grid) else high)
    return low if target_entropy is not None else high


def weights(by_source: DataFrame, exponent: float, budget: int | None = None) -> DataFrame:
    """``source, tokens, documents, weight, budget``: the tokens to read of each source, rounded to whole tokens.

    Without a budget the whole mixture is scaled until the most under-weighted source is read exactly once.
    A source without tokens has weight 0 and budget 0.
    """
    live = by_source.where("tokens > 0")
    total, largest = live.agg(F.sum("tokens"), F.max("tokens")).first()
    total, largest = float(total or 1), float(largest or 1)
    z = live.agg(F.sum(F.pow(F.col("tokens") / F.lit(total), F.lit(exponent)))).first()[0] or 1.0
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(total), F.lit(exponent)) / F.lit(z)).otherwise(F.lit(0.0))
    whole = float(budget) if budget is not None else largest / ((largest / total) ** exponent / z)
    return by_source.withColumn("weight", weight).withColumn("budget", F.round(F.col("weight") * F.lit(whole)).cast("long"))


def mix(docs: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None, budget: int | None = None, seed: str = "mix", block_tokens: int = 1 << 16, key: str = "doc_id", source: str = "source") -> DataFrame:
    """The mixture: the columns of ``docs`` and ``epoch, block, block_order, place``, one row per reading of a document.

    ``docs`` needs ``n_tokens``. Rows sort by ``epoch, block_order, place`` within their source. Documents without tokens
    are read once in each whole epoch of their source; a source of which every document is empty is left out, since its
    weight is 0. Repeated rows are documents of their own; ties of the order hash fall back to the id. Columns of ``docs``
    named like the new ones keep their place but take the new values.
    """
    plan = weights(totals(docs, source), bisect_exponent(totals(docs, source), target_entropy, max_repetition, budget), budget)
    return realise(docs, stage(plan, "mix-plan"), seed, block_tokens, key, source)


def realise(docs: DataFrame, plan: DataFrame, seed: str, block_tokens: int, key: str, source: str) -> DataFrame:
    """The readings of ``docs`` under ``plan`` (``weights``); see ``mix`` for columns, repeated rows, ids and empty tables."""

    def order(*parts: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(seed), *parts))

    own = [c for c in docs.columns if c not in ("epoch", "block", "block_order", "place")]
    quota = plan.where("budget > 0").select(
        F.col("source").alias("_source"),
        F.col("tokens").alias("_total"),
        F.col("budget").alias("_budget"),
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long").alias("_blocks"),
    )
    dealt = docs.select(*own).join(quota, F.col(source).eqNullSafe(F.col("_source")))
    # With a hash of the row, so that rows without an id, or with one id, are dealt to many blocks.
    name = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.xxhash64(*own).cast("string"))
    spot = F.conv(F.substring(order(F.lit("block"), name), 1, 15), 16, 10).cast("long")
    dealt = dealt.withColumn("block", F.pmod(spot, F.col("_blocks")))

    # One row per block of a source: where it starts in the partial epoch, which has the number of the whole ones.
    last = (F.col("_budget") / F.col("_total")).cast("long")
    blocks = dealt.groupBy("_source", "block", "_total", "_budget", "_blocks").agg(F.sum("n_tokens").alias("_tokens"))
    turn = order(F.lit("turn"), last.cast("string"), F.col("block").cast("string"))
    # The hash's leading digits name the bundle, so bundles are in the order of their blocks.
    bundles = F.ceil(F.sqrt(F.col("_blocks"))).cast("long")
    blocks = blocks.withColumn("_turn", turn).withColumn("_bundle", F.floor(F.conv(F.substring("_turn", 1, 8), 16, 10).cast("long") * bundles / F.lit(1 << 32)).cast("long"))
    inside = W.partitionBy("_source", "_bundle").orderBy("_turn", "block")
    before = W.partitionBy("_source").orderBy("_bundle").rowsBetween(W.unboundedPreceding, -1)
    sums = blocks.groupBy("_source", "_bundle").agg(F.sum("_tokens").alias("_sum"), F.count("*").alias("_count"))
    sums = sums.select(F.col("_source").alias("_s"), F.col("_bundle").alias("_b"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum"), F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_count"))
    placed = blocks.withColumn("_start", F.coalesce(F.sum("_tokens").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("_rank", F.row_number().over(inside) - 1)
    placed = placed.join(sums, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bundle") == F.col("_b")))
    placed = placed.select(F.col("_source").alias("_ps"), F.col("block").alias("_pb"), (F.col("_start") + F.col("_sum")).alias("_start"), (F.col("_rank") + F.col("_count")).alias("_order"))

    dealt = dealt.join(placed, F.col("_source").eqNullSafe(F.col("_ps")) & (F.col("block") == F.col("_pb")))
    epochs = F.sequence(F.lit(0).cast("long"), last)
    read = dealt.withColumn("epoch", F.explode(epochs)).withColumn("_last", F.col("epoch") == last)
    within = W.partitionBy("_source", "block", "epoch").orderBy(order(F.lit("document"), F.col("epoch").cast("string"), name), key, "_row")
    read = read.withColumn("_row", F.xxhash64(*own))
    read = read.withColumn("_before", F.coalesce(F.sum("n_tokens").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("place", F.row_number().over(within) - 1)
    rest = F.col("_budget") - last * F.col("_total")
    read = read.where(~F.col("_last") | (F.col("_start") + F.col("_before") < rest))
    # In whole epochs no budget depends on the blocks' order: their order hash is enough.
    turn_now = F.when(F.col("_last"), F.format_string("%016d", "_order")).otherwise(order(F.lit("turn"), F.col("epoch").cast("string"), F.col("block").cast("string")))
    return read.select(*own, "epoch", "block", turn_now.alias("block_order"), F.col("place").cast("long").alias("place"))


@query("op2_mixing")
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 98 % of the largest entropy, under a budget of the tokens they have."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("n_tokens"))
    docs = stage(docs, "mix-tokens")
    budget = docs.agg(F.sum("n_tokens")).first()[0] or 0
    return mix(docs, target_entropy=0.98, budget=budget).select("doc_id", "source", "n_tokens", "epoch", "block", "block_order", "place")
