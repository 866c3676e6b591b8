"""Merkle fixity audit of WARC replicas: hash trees over ordered offset ranges, compared from the root down.

A replica is a frame of records ``(archive, offset, record)``: the archive file's name, the byte offset of the record in
it and its bytes. The records of an archive in offset order are its leaves. A node covers ``fanout`` children; its digest
is the SHA-256 of its range and of its children's digests in order, so a changed byte, a lost record and a shifted offset
all change every digest above them.

The tree's shape must not depend on what a replica lost, else one lost record would shift all its successors into other
nodes. Leaves are therefore dealt by offset: a leaf range holds the records that start in one span of ``span`` bytes, and
the ranges above hold ``fanout`` spans each. One node gathers at most ``fanout`` digests, and a leaf range at most the
records that start within ``span`` bytes, whatever the size of an archive.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from urbanlake.llm.common import query, table
from urbanlake.session import stage

KEYS = ["archive", "offset"]


def warc_record(uri: Column, body: Column, record_id: Column) -> Column:
    """The bytes of one WARC/1.1 response record; null parts are empty."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(uri, F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:record:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def archives(pages: DataFrame, per_archive: int = 512) -> DataFrame:
    """Pages as WARC records with offsets: ``archive, offset, page_id, record``.

    Archive ``n`` takes the page ids from ``n * per_archive`` on, in id order, so its offsets come from one window over at
    most that many distinct ids. Null ids go by hash to archives of their own; repeated rows are repeated records.
    """
    record = warc_record(F.col("url"), F.col("html"), F.col("page_id"))
    number = F.coalesce(
        F.floor(F.col("page_id") / per_archive).cast("string"),
        F.concat(F.lit("null-"), F.pmod(F.xxhash64("url", "html"), F.lit(1024)).cast("string")),
    )
    order = W.partitionBy("archive").orderBy("page_id", "record").rowsBetween(W.unboundedPreceding, -1)
    return pages.select(F.concat(F.lit("part-"), number, F.lit(".warc")).alias("archive"), "page_id", record.alias("record")).select(
        "archive", F.coalesce(F.sum(F.octet_length("record")).over(order), F.lit(0)).alias("offset"), "page_id", "record"
    )


def leaves(records: DataFrame, *carry: str) -> DataFrame:
    """One leaf per record: ``archive, offset, length, digest``; null bytes count as an empty record."""
    record = F.coalesce(F.col("record"), F.lit("").cast("binary"))
    return records.select(*KEYS, *carry, F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest"))


def _node(children: DataFrame, child: Column, span: int) -> DataFrame:
    """Parents of nodes or leaves: digest of the ordered children, by ranges of ``span`` bytes."""
    packed = F.concat_ws(";", F.transform(F.array_sort(F.collect_list(F.struct("offset", child.alias("mark")))), lambda x: x["mark"]))
    start = F.floor(F.col("offset") / span) * span
    return children.groupBy("archive", start.alias("offset")).agg(F.sha2(packed, 256).alias("digest"), F.sum("records").alias("records"))


def tree(leaf: DataFrame, span: int, fanout: int, levels: int) -> list[DataFrame]:
    """Node tables from the leaf ranges up to ``levels``: ``archive, offset, digest, records``."""
    mark = F.concat_ws(",", "offset", "length", "digest")
    nodes = [_node(leaf.withColumn("records", F.lit(1)), mark, span)]
    for level in range(1, levels):
        nodes.append(_node(nodes[-1], F.concat_ws(",", "offset", "digest"), span * fanout**level))
    return nodes


def levels_for(largest_offset: int, span: int, fanout: int) -> int:
    """Levels until one node covers the largest archive."""
    levels, width = 1, span
    while width <= largest_offset:
        levels, width = levels + 1, width * fanout
    return levels


def audit(left: DataFrame, right: DataFrame, span: int = 1 << 16, fanout: int = 16) -> DataFrame:
    """Records in which two replicas differ: ``archive, offset, left_length, right_length, left_digest, right_digest, finding``.

    ``finding`` is ``altered`` (other bytes at the offset), ``missing`` (only on the left) or ``extra`` (only on the right).
    Both trees are written level by level and compared from the root: a level is read only below nodes that differ, and
    leaves only in leaf ranges that differ. A record that occurs n times at an offset on one side and m times on the other
    is one finding. Records with a null archive or offset belong to the archive "" and to offset -1.
    """
    sides = []
    for side in (left, right):
        filled = side.select(F.coalesce("archive", F.lit("")).alias("archive"), F.coalesce(F.col("offset").cast("long"), F.lit(-1)).alias("offset"), "record")
        sides.append(stage(leaves(filled), "fixity-leaves"))
    top = max(side.agg(F.max("offset")).first()[0] or 0 for side in sides)
    levels = levels_for(top, span, fanout)
    trees = [[stage(n, "fixity-level") for n in tree(side, span, fanout, levels)] for side in sides]

    def differing(a: DataFrame, b: DataFrame) -> DataFrame:
        a, b = (x.groupBy(*KEYS).agg(F.max("digest").alias(f"{s}_digest")) for x, s in ((a, "left"), (b, "right")))
        return a.join(b, KEYS, "full").where(~F.col("left_digest").eqNullSafe(F.col("right_digest"))).select(*KEYS)

    suspects = None
    for level in reversed(range(levels)):
        a, b = trees[0][level], trees[1][level]
        if suspects is not None:
            width = span * fanout ** (level + 1)
            a, b = (_below(x, suspects, width) for x in (a, b))
        suspects = differing(a, b)
    found = [_below(side, suspects, span).groupBy(*KEYS).agg(F.max("length").alias(f"{s}_length"), F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("digest"))), 256).alias(f"{s}_digest"), F.count("*").alias(f"{s}_n")) for side, s in zip(sides, ("left", "right"))]
    both = found[0].join(found[1], KEYS, "full").where(~F.col("left_digest").eqNullSafe(F.col("right_digest")))
    finding = F.when(F.col("left_digest").isNull(), "extra").when(F.col("right_digest").isNull(), "missing").otherwise("altered")
    return both.select(*KEYS, "left_length", "right_length", "left_digest", "right_digest", finding.alias("finding"))


def _below(nodes: DataFrame, suspects: DataFrame, width: int) -> DataFrame:
    """The nodes that lie in the suspect ranges of ``width`` bytes."""
    parent = suspects.select(F.col("archive").alias("_archive"), F.col("offset").alias("_start"))
    inside = (F.col("archive") == F.col("_archive")) & ((F.floor(F.col("offset") / width) * width) == F.col("_start"))
    return nodes.join(parent, inside, "left_semi")


def damaged(records: DataFrame) -> DataFrame:
    """A replica with known faults: by id, a record in 401 has a byte flipped, in 509 is cut by a byte, in 613 is lost.

    The faults keep all offsets, as a store does that loses or rots a block.
    """
    size = F.octet_length("record")
    middle = (size / 2).cast("int")
    byte = F.hex(F.expr("substring(record, cast(octet_length(record) / 2 as int), 1)"))
    other = F.unhex(F.when(byte == "78", "79").otherwise("78"))
    flipped = F.concat(F.expr("substring(record, 1, cast(octet_length(record) / 2 as int) - 1)"), other, F.expr("substring(record, cast(octet_length(record) / 2 as int) + 1)"))
    faulty = F.when(F.pmod("page_id", F.lit(401)) == 0, flipped).when(F.pmod("page_id", F.lit(509)) == 0, F.expr("substring(record, 1, octet_length(record) - 1)")).otherwise(F.col("record"))
    return records.where(F.coalesce(F.pmod("page_id", F.lit(613)) != 0, F.lit(True))).select("archive", "offset", "page_id", faulty.alias("record"))


_SQL = """
WITH records AS (
  SELECT page_id, CAST(floor(page_id / 512) AS BIGINT) AS part,
         encode('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: '
           || coalesce(url, '') || chr(13) || chr(10) || 'WARC-Record-ID: <urn:record:' || page_id || '>' || chr(13) || chr(10)
           || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))
           || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)) AS record
  FROM pages),
placed AS (
  SELECT *, CAST(coalesce(sum(octet_length(record)) OVER (PARTITION BY part ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
         CAST(octet_length(record) AS BIGINT) AS size
  FROM records)
SELECT page_id, 'part-' || part || '.warc' AS archive, start AS "offset", size AS left_length,
       CASE WHEN page_id % 613 = 0 THEN NULL WHEN page_id % 401 = 0 THEN size WHEN page_id % 509 = 0 THEN size - 1 END AS right_length,
       CASE WHEN page_id % 613 = 0 THEN 'missing' ELSE 'altered' END AS finding
FROM placed WHERE page_id % 613 = 0 OR page_id % 401 = 0 OR page_id % 509 = 0
"""


@query("op5_fixity_audit", _SQL)
def fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in two replicas, one with faults: the records that the audit finds."""
    # Written once: both replicas and the ids read the records from there, so they are shuffled once.
    left = stage(archives(table(spark, sf_dir, "pages").select("page_id", "url", "html")), "fixity-records")
    found = audit(left.select(*KEYS, "record"), damaged(left).select(*KEYS, "record"))
    ids = left.select("page_id", *KEYS)
    return found.join(ids, KEYS).select("page_id", *KEYS, "left_length", "right_length", "finding")
