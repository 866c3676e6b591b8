"""Which terms and which other sources set a source apart from the rest of its language.

Terms are counted once per language and source, and a language keeps those that occur in enough of its documents. Every
group gives each kept term a share of a billion, smoothed so that none is 0, and two shares p and q differ by
``(p - q) ** 2 // (p + q)``.

**Dominance skyband.** The value of a term in a group grows with its count there and falls with its count in the language;
equal values go by the term's UTF-8 bytes. So a term comes after every term that dominates it: one with a count at least as
high, a language count at most as high, and earlier bytes. A partition keeps the terms that fewer than ``k`` others
dominate. As dominators stand earlier in the sorted partition, this is a filter over a stream that holds no more than the
band itself. The bands of all partitions are merged by the same filter, a group dealt to ``SALT`` tasks, and what is left is
ranked exactly; the group limit of the ranking lets each task send at most ``k`` rows of a group.

**Pairs of sources.** Kept terms are dealt out by hash. A task holds the counts of its terms by source and adds up the
differences of all pairs of sources of a language, so one row per pair leaves it, never one per pair and term.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from urbanlake.llm import vectors as V
from urbanlake.llm.common import query, table, text_of
from urbanlake.session import stage

#: The bytes of terms: letters A to Z, and those of characters beyond ASCII.
TERM_BYTE = np.zeros(256, bool)
TERM_BYTE[65:91] = TERM_BYTE[97:123] = TERM_BYTE[128:] = True
LEAST_DOCUMENTS = 10
TOP = 10
SALT = 8
#: Bytes of text that are counted at once, rows of a block in the skyband filter, cells of a step in the sums of pairs.
STEP, BLOCK, CELLS = 1 << 23, 256, 1 << 20
#: Kept rows that one task adds up, on average.
CHUNK = 1 << 18


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, documents``: occurrences, and the documents that hold the term. One shuffle, pre-aggregated."""

    def read(batches):
        for batch in batches:
            lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
            group = np.asarray(lang.indices).astype(np.int64) * len(source.dictionary) + np.asarray(source.indices)
            data, offsets = V.utf8(batch.column("text"))
            for a, b in V.steps(offsets, STEP):
                part, term, n, documents = counted(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], group[a:b])
                if len(n):
                    names = [values.take(pa.array(i)).cast(pa.string()) for values, i in zip((lang.dictionary, source.dictionary), np.divmod(part, len(source.dictionary)))]
                    yield pa.RecordBatch.from_arrays([*names, term.cast(pa.string()), pa.array(n), pa.array(documents)], names=["lang", "source", "term", "n", "documents"])

    found = docs.select(*_names(), "text").mapInArrow(read, "lang string, source string, term string, n long, documents long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def counted(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Group, term, occurrences and documents, a row per group and term, of texts that lie one after the other."""
    inside = TERM_BYTE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner], last[inner - 1] = inside[inner], inside[inner - 1]
    start = np.flatnonzero(first)
    ends = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - start)])
    terms = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(V.LOWER[data[inside]])).dictionary_encode()
    row = np.searchsorted(offsets, start, "right") - 1
    key = group[row] * max(len(terms.dictionary), 1) + np.asarray(terms.indices)
    # Rows ascend within equal keys, since the sort is stable.
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    edge = np.flatnonzero(new)
    new[1:] |= row[1:] != row[:-1]
    part, code = np.divmod(key[edge], max(len(terms.dictionary), 1))
    documents = np.add.reduceat(new.astype(np.int64), edge) if len(edge) else np.zeros(0, np.int64)
    return part, terms.dictionary.take(pa.array(code)), np.diff(np.append(edge, len(key))), documents


def _names() -> list[Column]:
    return [text_of(c).alias(c) for c in ("lang", "source")]


def kept_terms(counts: DataFrame, least_documents: int) -> DataFrame:
    """``lang, source, term, n, lang_n`` of the terms that enough documents of the language hold."""
    of_term = W.partitionBy("lang", "term")
    summed = counts.select("*", F.sum("n").over(of_term).alias("lang_n"), F.sum("documents").over(of_term).alias("lang_documents"))
    return summed.where(F.col("lang_documents") >= least_documents).select("lang", "source", "term", "n", "lang_n")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10 ** 9 * (n + 2) / (total + 2 * terms))`` in long arithmetic, exact for totals below 2.8e14."""
    whole = total + 2 * terms
    first = (n + 2) * 32000
    return 1 + _div(first, whole) * 31250 + _div(first % whole * 31250, whole)


def shares_of(n: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """The same for arrays."""
    whole = total + 2 * terms
    first, rest = np.divmod((n + 2) * 32000, whole)
    return 1 + first * 31250 + rest * 31250 // whole


def difference(p: Column, q: Column) -> Column:
    """``(p - q) ** 2 // (p + q)``."""
    return _div((p - q) * (p - q), p + q)


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, total, lang_total, terms`` of every group, with or without terms."""
    by_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"))
    # A term counts once per language: its first source stands for it.
    terms = kept.groupBy("lang", "term").agg(F.count("*").alias("sources")).groupBy("lang").agg(F.count("*").alias("terms"))
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(*_names()).distinct()
    joined = groups.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").join(terms, "lang", "left")
    return joined.select("lang", "source", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "lang_total", "terms")))


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every two sources of a language with kept terms, either way round."""
    chunks = 1 + kept.count() // CHUNK
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def add_up(terms: pa.Table, sources: pa.Table) -> pa.Table:
        names, lang = sources.column("source").combine_chunks(), sources.column("lang")[0].as_py()
        total, size = np.asarray(sources.column("total")), len(names)
        code = terms.column("term").combine_chunks().dictionary_encode()
        row, column = np.asarray(code.indices), np.asarray(pc.index_in(terms.column("source").combine_chunks(), names))
        n = np.asarray(terms.column("n"))
        order = np.argsort(row, kind="stable")
        row, column, n = row[order], column[order], n[order]
        sums = np.zeros((size, size), np.int64)
        step = max(1, CELLS // max(size, 1))
        for low in range(0, len(code.dictionary), step):
            a, b = np.searchsorted(row, [low, low + step])
            counts = np.zeros((min(step, len(code.dictionary) - low), size), np.int64)
            counts[row[a:b] - low, column[a:b]] = n[a:b]
            p = shares_of(counts, total, int(sources.column("terms")[0].as_py()))
            for i in range(size - 1):
                gap = p[:, i : i + 1] - p[:, i + 1 :]
                sums[i, i + 1 :] += (gap * gap // (p[:, i : i + 1] + p[:, i + 1 :])).sum(axis=0)
        x, y = np.nonzero(sums)
        return pa.Table.from_arrays([pa.array([lang] * len(x), pa.string()), names.take(pa.array(x)), names.take(pa.array(y)), pa.array(sums[x, y])], schema=schema)

    chunk = F.pmod(F.xxhash64("term"), F.lit(chunks)).cast("int").alias("chunk")
    dealt = kept.select("lang", "source", "term", "n", chunk)
    everywhere = groups.where("terms > 0").select("lang", "source", "total", "terms", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    parts = dealt.groupBy("lang", "chunk").cogroup(everywhere.groupBy("lang", "chunk")).applyInArrow(_if_both(add_up, schema), "lang string, source string, item string, value long")
    either = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select("lang", either.alias("pair"), "value").select("lang", "pair.*", "value")


def _if_both(add_up, schema: pa.Schema):
    def run(terms: pa.Table, sources: pa.Table) -> pa.Table:
        return add_up(terms, sources) if terms.num_rows and sources.num_rows else schema.empty_table()

    return run


def pairs(groups: DataFrame, sums: DataFrame) -> DataFrame:
    """``lang, source, item, value``: every group with each other source of its language."""
    others = groups.select("lang", F.col("source").alias("item"))
    both = groups.select("lang", "source").join(others, "lang").where("source <> item")
    return both.join(sums, ["lang", "source", "item"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))


class Band:
    """The terms of one group seen so far that fewer than ``k`` others dominate; terms come in the order of their bytes."""

    def __init__(self, k: int):
        self.k, self.n, self.lang_n = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def take(self, n: np.ndarray, lang_n: np.ndarray) -> np.ndarray:
        """Which of the next terms are in the band."""
        kept = [np.zeros(0, bool)]
        for low in range(0, len(n), BLOCK):
            a, b = n[low : low + BLOCK], lang_n[low : low + BLOCK]
            over = ((self.n[None, :] >= a[:, None]) & (self.lang_n[None, :] <= b[:, None])).sum(axis=1)
            over += np.tril((a[None, :] >= a[:, None]) & (b[None, :] <= b[:, None]), -1).sum(axis=1)
            good = over < self.k
            self.n, self.lang_n = np.concatenate([self.n, a[good]]), np.concatenate([self.lang_n, b[good]])
            kept.append(good)
        return np.concatenate(kept)


def skyband(entries: DataFrame, k: int) -> DataFrame:
    """The rows of each partition that fewer than ``k`` rows of their group and partition dominate.

    Needs ``lang, source, term, n, lang_n``; other columns stay. Equal rows do not occur, as a group has a term once.
    """

    def keep(batches):
        group, band = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
            edges = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            n, lang_n = np.asarray(batch.column("n")), np.asarray(batch.column("lang_n"))
            mask = []
            for a, b in zip(edges[:-1], edges[1:]):
                if names[a] != group:
                    group, band = names[a], Band(k)
                mask.append(band.take(n[a:b], lang_n[a:b]))
            yield batch.filter(pa.array(np.concatenate(mask)))

    return entries.sortWithinPartitions("lang", "source", "term").mapInArrow(keep, entries.schema)


def top_terms(kept: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """``lang, source, item, value, rank`` of the ``k`` terms that a group uses more than its language and that differ most."""
    used = kept.where("n > 0").join(groups, ["lang", "source"])
    used = used.select("lang", "source", "term", "n", "lang_n", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")).where("p > q")
    bands = skyband(used, k).withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALT)))
    merged = skyband(bands.repartition("lang", "source", "salt").drop("salt"), k)
    return ranked(merged.select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))).where(F.col("rank") <= k)


def ranked(df: DataFrame) -> DataFrame:
    """With ``rank`` by value descending and item ascending within each group."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, k: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` over all rows of ``docs`` (``text, lang, source``; other columns are not read).

    Part ``pair`` holds each other source of the language, part ``term`` the ``k`` terms that a group uses more than its
    language and that differ most. Null texts, languages and sources count as empty, repeated rows as often as they occur.
    Ties go by UTF-8 bytes. A language without kept terms has pairs of value 0 and no terms; an empty table gives no rows.
    """
    docs = docs.select("text", "lang", "source")
    kept = stage(kept_terms(term_counts(docs), least_documents), "divergence-terms")
    groups = stage(group_totals(docs, kept), "divergence-groups")
    of_pairs = ranked(pairs(groups, pair_sums(kept, groups))).withColumn("part", F.lit("pair"))
    of_terms = top_terms(kept, groups, k).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return of_pairs.select(columns).union(of_terms.select(columns))


_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
tokens AS (SELECT no, lang, source, unnest(terms) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT no) AS documents FROM tokens GROUP BY lang, source, term),
kept AS (SELECT lang, term, sum(n) AS lang_n FROM counts GROUP BY lang, term HAVING sum(documents) >= 10),
by_lang AS (SELECT lang, sum(lang_n) AS lang_total, count(*) AS terms FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n, l.lang_total, l.terms,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN by_lang l ON g.lang = l.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (total + 2 * terms) AS p,
         1 + (1000000000 * (lang_n + 2)) // (lang_total + 2 * terms) AS q
  FROM cells),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 10
"""


@query("op13_divergence", _SQL)
def divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group of language and source with its distance to the other sources and its ten most telling terms."""
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))
