"""Fill-in-the-middle texts, assembled by a secondary sort.

A text is a row of units: a word with the blanks before it, or the blanks at the end. Two hashed cuts part the units into
prefix, middle and suffix, and a document is written plainly, as prefix, suffix, middle, or as suffix, prefix, middle.

No task joins a document's parts in memory. Every document becomes pieces of at most ``UNITS`` units, keyed by document and
by their place in the output. ``repartitionAndSortWithinPartitions`` brings the pieces of a document together in that
order, and they stream into a running digest of the output. Reading the output alone, the marks in it say which part a
piece belongs to: pieces are keyed anew by their place in the original and sorted again, now within the partition, since the
partitioner stays the same, and stream into the digest of what was restored. Both sorts spill; texts move once.

The key of a document is the number of its row, so copies and shared ids do not meet. It follows from the place of the row
in its partition: ``docs`` must give the same partitions again when a lost task is repeated, as a stored table does.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator

from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm.common import partitions, query, table, text_of

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
UNITS = 4096
#: Bytes of text that one partition of the sort holds, on average.
PART_BYTES = 1 << 25
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: The places of the parts in the original, by their mark.
PLACE = {PREFIX.encode(): 0, MIDDLE.encode(): 1, SUFFIX.encode(): 2}
HEAD = -1

Key = tuple[int, int, int]


def numbers(seed: int, doc_id: str | None) -> list[int]:
    """Four numbers of 32 bits that a document's id gives; a null id counts as empty."""
    digits = hashlib.sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def parts_of(text: str, drawn: list[int], percent: int, spm_percent: int) -> tuple[int, str, list[tuple[bytes, int, int]], array]:
    """Number of units, form, the output's parts as ``(mark, first unit, last unit)`` in their order, and the ends of units."""
    ends = array("q", (m.end() for m in UNIT.finditer(text)))
    n = len(ends)
    low, high = sorted(h % (n + 1) for h in drawn[:2])
    if not text or drawn[2] % 100 >= percent or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", [(b"", 0, n)], ends
    prefix, middle, suffix = (PREFIX.encode(), 0, low), (MIDDLE.encode(), low, high), (SUFFIX.encode(), high, n)
    if drawn[3] % 100 < spm_percent:
        return n, "spm", [suffix, prefix, middle], ends
    return n, "psm", [prefix, suffix, middle], ends


def pieces(rows: Iterable, seed: int, percent: int, spm_percent: int, units: int) -> Iterator[tuple[Key, object]]:
    """The pieces of each ``(row, doc_id, name, text)``, keyed by row and place in the output, after a head with its measures."""
    for row, doc_id, name, text in rows:
        n, form, parts, ends = parts_of(text, numbers(seed, name), percent, spm_percent)
        chars = {mark: (ends[b - 1] if b else 0) - (ends[a - 1] if a else 0) for mark, a, b in parts}
        lengths = (None, None) if form == "plain" else (chars[PREFIX.encode()], chars[MIDDLE.encode()])
        yield (row, HEAD, 0), (doc_id, n, form, *lengths)
        place = 0
        for mark, first, last in parts:
            if mark:
                yield (row, 0, place), mark
                place += 1
            for a in range(first, last, units):
                b = min(a + units, last)
                yield (row, 0, place), text[ends[a - 1] if a else 0 : ends[b - 1]].encode()
                place += 1


def _documents(records: Iterable[tuple[Key, object]]) -> Iterator[tuple[int, tuple, Iterator[tuple[Key, bytes]]]]:
    """Runs of sorted records: ``row, head, its pieces``; the pieces must be read before the next run."""
    records = iter(records)
    following = next(records, None)

    def rest(row: int) -> Iterator[tuple[Key, bytes]]:
        nonlocal following
        while (following := next(records, None)) is not None and following[0][0] == row:
            yield following

    while following is not None:
        (row, _, _), head = following
        yield row, head, rest(row)


def assembled(records: Iterable[tuple[Key, object]], texts: bool) -> Iterator[tuple[Key, object]]:
    """Digest the output of each document as it streams by, and key its pieces by their place in the original.

    The place is read from the output: the marks name the parts, and are left out.
    """
    for row, head, body in _documents(records):
        digest, part, whole = hashlib.sha256(), 0, []
        plain = head[2] == "plain"
        for (_, _, place), piece in body:
            digest.update(piece)
            if texts:
                whole.append(piece)
            if not plain and piece in PLACE:
                part = PLACE[piece]
            else:
                yield (row, part, place), piece
        yield (row, HEAD, 0), (*head, digest.hexdigest(), b"".join(whole).decode() if texts else None)


def restored(records: Iterable[tuple[Key, object]], texts: bool) -> Iterator[tuple]:
    """One row per document, with the digest of the text that its pieces give in their original order."""
    for _, head, body in _documents(records):
        digest, whole = hashlib.sha256(), []
        for _, piece in body:
            digest.update(piece)
            if texts:
                whole.append(piece)
        *measures, output_digest, output = head
        yield (*measures, output_digest, digest.hexdigest(), *((output, b"".join(whole).decode()) if texts else ()))


def _row(key: Key) -> int:
    return key[0]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, percent: int = 50, spm_percent: int = 80, units: int = UNITS, texts: bool = True) -> DataFrame:
    """``key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``, and with ``texts`` ``output, restored``.

    One row per row of ``docs``; repeated rows and rows that share an id or have none are documents of their own. A null text
    is empty, and an empty one plain, as is one that contains a mark. Lengths of plain texts are null. The pieces of a very
    long text stream by in turn; only ``texts`` joins them, to one value as long as the row's own text. An empty table gives
    no rows; other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id(), F.col(key), F.col(key).cast("string"), text_of(text)).rdd
    # As many partitions as the texts need to be sorted in memory, whatever the session's setting.
    size = docs.agg(F.sum(F.octet_length(text_of(text)).cast("long"))).first()[0] or 0
    count = max(partitions(spark), -(-size // PART_BYTES))

    def sort(records: RDD) -> RDD:
        return records.repartitionAndSortWithinPartitions(count, _row)

    first = sort(rows.mapPartitions(lambda part: pieces(part, seed, percent, spm_percent, units)))
    # The same partitioner: the second sort stays within the partitions.
    second = sort(first.mapPartitions(lambda part: assembled(part, texts), preservesPartitioning=True))
    schema = f"`{key}` {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    schema += ", output string, restored string" if texts else ""
    return spark.createDataFrame(second.mapPartitions(lambda part: restored(part, texts)), schema, verifySchema=False)


_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM units),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT doc_id, n, form, text, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s
  FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@query("op12_fill_in_middle", _SQL)
def infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its fill-in-the-middle form, as digests of the output and of the text restored from it."""
    return fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), texts=False)
