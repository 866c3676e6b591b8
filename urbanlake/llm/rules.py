"""Quality rules under weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule votes 1 (good), -1 (bad) or 0 (abstains). Documents are counted by their votes: with r rules there are at most
3 ** r patterns, 19,683 here, whatever the number of documents, and the model is fitted on that table. The model is a hidden
class with conditionally independent votes; a rule's rate of bad votes is estimated for either class, among the documents on
which it votes. An abstention carries no weight, so that two rules which abstain at the same oddity cannot outvote the
others, and the odds of one vote are bounded.

Likelihood alone would take any two rules that see the same thing, such as repeated lines and repeated words, for the
hidden class. So the estimates are the most probable ones under two prior beliefs, that a good document gets a bad vote in
``FALSE_ALARM`` of cases and that ``GOOD`` of the documents are good, each as heavy as the documents themselves. The fit
starts from several first guesses, and the most probable result is taken. The posterior probability of the good class
replaces "must pass every rule".
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm.common import WORD, query, table
from urbanlake.session import stage

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
#: A bad vote speaks against a document with odds of 2 to 1 at least, and no vote with more than 1000 to 1.
BETTER, LIMIT = 2.0, math.log(1000)
FALSE_ALARM, GOOD = 0.01, 0.9
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_ended_lines", "n_upper", "n_digits"]


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of a text that the rules read; a null text has no words, an empty table stays empty.

    Words and windows are compared by 64-bit hashes, within one text only. Repeated rows stay as they are. A column of
    ``docs`` that is named like a measure gives way to it.
    """
    docs = docs.drop(*(c for c in docs.columns if c.lower() in MEASURES))
    own = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_text", own).withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD))
    df = df.withColumn("_lines", lines)
    df = df.withColumn("_codes", F.transform("_words", lambda w: F.xxhash64(w)))
    hashes = F.when(F.size("_codes") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("_codes") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_codes", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_hashes", hashes)
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn("_sorted", F.when(repeats, F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(empty))
    twice = F.transform("_sorted", lambda s, k: F.when(F.coalesce(F.get("_sorted", k - 1)["h"] == s["h"], F.lit(False)) | F.coalesce(F.get("_sorted", k + 1)["h"] == s["h"], F.lit(False)), s["i"]))
    df = df.withColumn("_starts", F.array_sort(F.filter(twice, lambda x: x.isNotNull())))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("_starts", zero, lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end")), lambda a: a["n"])
    letters = lambda kind: F.regexp_count("_text", F.lit(kind))
    return df.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_codes")).cast("long").alias("n_distinct_words"),
        F.size(F.filter("_lines", lambda x: x.rlike("[.!?\"')\\]]\\s*$"))).cast("long").alias("n_ended_lines"),
        letters(r"\p{Lu}").cast("long").alias("n_upper"),
        letters(r"[0-9]").cast("long").alias("n_digits"),
    )


def failed(df: DataFrame) -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0)).cast("int")


def votes() -> dict[str, Column]:
    """The rules, by name: each column is -1, 0 or 1."""
    c, words = F.col, F.greatest(F.lit(1), F.col("n_words"))
    return {
        "symbols": _vote(10 * c("n_symbols") > c("n_words"), 100 * c("n_symbols") <= c("n_words")),
        "lines_repeat": _vote(10 * c("n_dup_lines") > 3 * c("n_lines"), (c("n_dup_lines") == 0) & (c("n_lines") >= 3)),
        "words_repeat": _vote(10 * c("n_repeat_words") > 2 * c("n_words"), (50 * c("n_repeat_words") <= c("n_words")) & (c("n_words") >= 20)),
        "word_length": _vote((c("word_chars") < 3 * c("n_words")) | (c("word_chars") > 12 * words), (c("word_chars") >= 4 * c("n_words")) & (c("word_chars") <= 8 * words) & (c("n_words") >= 20)),
        "capitals": _vote(2 * c("n_upper") > c("word_chars"), (5 * c("n_upper") < c("word_chars")) & (c("word_chars") >= 50)),
        "endings": _vote((10 * c("n_ended_lines") < c("n_lines")) & (c("n_words") >= 20), (2 * c("n_ended_lines") >= c("n_lines")) & (c("n_words") >= 20)),
        "vocabulary": _vote(((10 * c("n_distinct_words") < c("n_words")) & (c("n_words") < 2000)) | (100 * c("n_distinct_words") < c("n_words")), (5 * c("n_distinct_words") >= 2 * c("n_words")) & (c("n_words") >= 20)),
        "digits": _vote(5 * c("n_digits") > c("word_chars"), (50 * c("n_digits") <= c("word_chars")) & (c("n_words") >= 20)),
        "length": _vote(c("n_words") < 20, c("n_words") >= 50),
    }


class Model:
    """Share of the good class and, by rule, the rates of bad votes in the good and in the bad class."""

    def __init__(self, prior: float, rates: list[tuple[float, float]]):
        self.prior, self.rates = prior, rates

    def odds(self, rule: int, vote: int) -> float:
        """Log-odds of good against bad that a vote gives; none for an abstention."""
        p, q = self.rates[rule]
        found = {-1: math.log(p / q), 0: 0.0, 1: math.log((1 - p) / (1 - q))}[vote]
        return max(-LIMIT, min(LIMIT, found))

    def log_odds(self, names: list[str]) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for i, name in enumerate(names):
            total = total + F.when(F.col(name) == 1, self.odds(i, 1)).when(F.col(name) == -1, self.odds(i, -1)).otherwise(0.0)
        return total

    def posterior(self, names: list[str]) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds(names)))


def _log_odds(model: Model, pattern: tuple[int, ...]) -> float:
    return math.log(model.prior / (1 - model.prior)) + sum(model.odds(i, v) for i, v in enumerate(pattern))


def _log_probability(model: Model, patterns: dict[tuple[int, ...], int], total: int) -> float:
    """Of the votes and of the model under the prior beliefs, but for a constant."""
    found = total * (GOOD * math.log(model.prior) + (1 - GOOD) * math.log(1 - model.prior))
    found += sum(total * (FALSE_ALARM * math.log(p) + (1 - FALSE_ALARM) * math.log(1 - p)) for p, _ in model.rates)
    for pattern, n in patterns.items():
        sides = [math.log(model.prior), math.log(1 - model.prior)]
        for (p, q), v in zip(model.rates, pattern):
            if v:
                sides = [sides[0] + math.log(p if v < 0 else 1 - p), sides[1] + math.log(q if v < 0 else 1 - q)]
        found += n * (max(sides) + math.log1p(math.exp(min(sides) - max(sides))))
    return found


def _maximised(patterns: dict[tuple[int, ...], int], good: dict[tuple[int, ...], float], rules: int) -> Model:
    """The most probable model, given each pattern's probability of the good class."""
    total = sum(patterns.values())
    prior = (sum(good[v] * n for v, n in patterns.items()) + 1 + total * GOOD) / (2 * total + 2)
    rates = []
    for i in range(rules):
        votes_by = {(side, vote): sum((good[v] if side else 1 - good[v]) * n for v, n in patterns.items() if v[i] == vote) for side in (0, 1) for vote in (-1, 1)}
        p = (votes_by[1, -1] + 1e-3 + total * FALSE_ALARM) / (votes_by[1, -1] + votes_by[1, 1] + 2e-3 + total)
        q = (votes_by[0, -1] + 1) / (votes_by[0, -1] + votes_by[0, 1] + 2)
        # A bad vote is taken to be better than chance.
        rates.append((p, max(q, min(BETTER * p, (1 + p) / 2))))
    return Model(prior, rates)


def fit(patterns: dict[tuple[int, ...], int], rules: int, iterations: int = 200, close: float = 1e-6) -> Model:
    """Fit on the number of documents by votes, from three first guesses of what is bad.

    No documents give a prior of one half and rules of no use. Of models that are equally probable, that of the earlier guess
    is taken.
    """
    guesses = (lambda v: -1 in v, lambda v: v.count(-1) >= 2, lambda v: sum(v) <= 0)
    total, found = sum(patterns.values()), []
    for bad in guesses:
        good = {v: 0.1 if bad(v) else 0.95 for v in patterns}
        for _ in range(iterations):
            model, before = _maximised(patterns, good, rules), good
            good = {v: 1 / (1 + math.exp(-_log_odds(model, v))) for v in patterns}
            if all(abs(good[v] - before[v]) < close for v in patterns):
                break
        found.append((_log_probability(model, patterns, total), model))
    return max(found, key=lambda x: round(x[0], 3))[1]


def judge(measured: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add ``quality`` (posterior of the good class), ``base_failed`` and ``kept``; ``measured`` comes from ``measures``.

    ``kept`` is false where the base fails and else whether ``quality`` reaches ``threshold``. Repeated rows count as often
    as they occur. The model is fitted on the documents that pass the base, since the others are decided; they get a
    posterior all the same. ``measured`` is written once, so that the measures are not made again for the votes; columns of
    these names give way. An empty table stays empty.
    """
    names = [f"_vote_{k}" for k in votes()]
    measured = stage(measured.drop("quality", "base_failed", "kept"), "rule-measures")
    voted = measured.select("*", *(v.alias(n) for n, v in zip(names, votes().values())))
    # At most 3 ** r rows, whatever the number of documents.
    patterns = {tuple(row[name] for name in names): row["n"] for row in voted.where(~failed(measured)).groupBy(*names).agg(F.count("*").alias("n")).collect()}
    model = fit(patterns, len(names))
    out = voted.withColumn("quality", model.posterior(names)).withColumn("base_failed", failed(measured))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)).drop(*names)


@query("op4_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures, the base verdict and the posterior verdict of every document."""
    measured = measures(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return judge(measured).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
