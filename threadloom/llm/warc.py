"""Operator 5: fixity audit of web archives by Merkle trees.

Pages become archive records, laid out in files by hash of their id and, within a file, in order
of id; a record's offset is the sum of the lengths before it. A record's leaf hashes its id and
range (offset and length) with the record's own digest. ``FANOUT`` neighbouring nodes make the next
level, up to one root per file. Two replicas are compared root by root; only below a mismatching
node are its children compared, level by level, down to the leaves that differ. As a changed
length, a lost or an added record shifts all leaves behind it, the records of these leaves are
aligned by id: those that the other replica has unchanged, wherever in the file, are intact.

A file holds about ``FILE_BYTES`` (a parameter), so the number of files grows with the table and
each file's running sums stay in bounds. Digests, trees and comparisons are Spark expressions and
aggregations over groups of at most ``FANOUT`` rows.

Defined cases: null urls and html are empty. Rows without id take no part; rows that share an id
(repeated rows) are records of their own, ordered by digest; equal ones are aligned first. Records
that only one replica has show as damaged, with nulls for the other; those that only the second has
show at their place in it. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.sources.tables import stage

FANOUT = 16
FILE_BYTES = 16 << 20


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of one archive record, as text."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), page_id.cast("string"),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def _place(page_id: Column) -> Column:
    return F.conv(F.substring(F.md5(page_id.cast("string")), 1, 8), 16, 10).cast("long")


def digests(records: DataFrame) -> DataFrame:
    """``(page_id, length, digest)`` from rows ``(page_id, record)``."""
    return records.where(F.col("page_id").isNotNull()).select(
        "page_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest")
    )


def file_count(hashed: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    return max(1, -(-(hashed.agg(F.sum("length")).first()[0] or 0) // file_bytes))


def layout(hashed: DataFrame, files: int) -> DataFrame:
    """``(file, place, page_id, offset, length, digest)`` from rows of :func:`digests`."""
    within = Window.partitionBy("file").orderBy("page_id", "digest")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    return hashed.withColumn("file", _place(F.col("page_id")) % files).select(
        "file", (F.row_number().over(within) - 1).cast("long").alias("place"), "page_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), "length", "digest",
    )


def tree(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels ``(file, place, hash)`` from the leaves up to one root per file."""
    leaf = F.sha2(F.concat_ws(":", "page_id", "offset", "length", "digest"), 256)
    levels = [leaves.select("file", "place", leaf.alias("hash"))]
    widest = leaves.agg(F.max("place")).first()[0]
    while widest:
        widest //= fanout
        parts = F.sort_array(F.collect_list(F.struct("place", "hash")))
        above = levels[-1].groupBy("file", F.expr(f"place div {fanout}").alias("_up")).agg(parts.alias("_parts"))
        joined = F.sha2(F.array_join(F.transform("_parts", lambda x: x["hash"]), ""), 256)
        levels.append(stage(above.select("file", F.col("_up").alias("place"), joined.alias("hash")), "level"))
    return levels


def damaged(left: list[DataFrame], right: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """``(file, place)`` of the leaves that differ, found from the roots down. Nodes that only one
    side has differ. Trees of different height are compared from the lower one's root level."""
    height = min(len(left), len(right))

    def differ(a: DataFrame, b: DataFrame) -> DataFrame:
        both = a.join(b.withColumnRenamed("hash", "_other"), ["file", "place"], "full")
        return both.where(~F.col("hash").eqNullSafe(F.col("_other"))).select("file", "place")

    bad = stage(differ(left[height - 1], right[height - 1]), "damaged")
    for a, b in zip(left[height - 2 :: -1] if height > 1 else [], right[height - 2 :: -1] if height > 1 else []):
        above = bad.select("file", F.col("place").alias("_up"))
        below = lambda df: df.withColumn("_up", F.expr(f"place div {fanout}")).join(above, ["file", "_up"], "left_semi").drop("_up")  # noqa: E731, B023
        bad = stage(differ(below(a), below(b)), "damaged")
    return bad


def aligned(first: DataFrame, second: DataFrame) -> DataFrame:
    """``(file, page_id, place, other_place, other_digest)`` of the records that the other replica
    has not, or has changed; records of both are given, and equal ones go in pairs."""
    same = ["file", "page_id", "length", "digest", "_n"]
    nth = F.row_number().over(Window.partitionBy(*same[:-1]).orderBy("place"))
    a, b = stage(first.withColumn("_n", nth), "unaligned"), stage(second.withColumn("_n", nth), "unaligned")
    turn = F.row_number().over(Window.partitionBy("file", "page_id").orderBy("digest", "place"))
    left = a.join(b.select(*same), same, "left_anti").select("file", "page_id", "place", turn.alias("_turn"))
    right = b.join(a.select(*same), same, "left_anti").select(
        "file", "page_id", F.col("place").alias("other_place"), F.col("digest").alias("other_digest"), turn.alias("_turn")
    )
    return left.join(right, ["file", "page_id", "_turn"], "full").drop("_turn")


def audit(first: DataFrame, second: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``(file, place, page_id, offset, length, digest, other_digest, status)`` of all records of
    two laid-out replicas; status is ``intact`` or ``damaged``. Digests are compared where trees
    led, nowhere else."""
    first, second = stage(first, "replica"), stage(second, "replica")
    bad = damaged(tree(first, fanout), tree(second, fanout), fanout)
    below = [df.join(bad, ["file", "place"], "left_semi") for df in (first, second)]
    found = stage(aligned(*below), "aligned")
    here = found.where(F.col("place").isNotNull()).select("file", "place", "other_digest", F.lit(True).alias("_bad"))
    records = first.join(here, ["file", "place"], "left").select(
        "file", "place", "page_id", "offset", "length", "digest",
        F.when(F.col("_bad"), F.col("other_digest")).otherwise(F.col("digest")).alias("other_digest"),
        F.when(F.col("_bad"), "damaged").otherwise("intact").alias("status"),
    )
    added = found.where(F.col("place").isNull()).select(
        "file", F.col("other_place").alias("place"), "page_id", F.lit(None).cast("long").alias("offset"),
        F.lit(None).cast("long").alias("length"), F.lit(None).cast("string").alias("digest"), "other_digest",
        F.lit("damaged").alias("status"),
    )
    return records.unionByName(added)


def flipped(text: Column, page_id: Column) -> Column:
    """The record with its first byte changed where the id's hash ends in 00: the damage that the
    registered query has to find. Lengths, and so the other records' offsets, stay."""
    hit = F.substring(F.md5(page_id.cast("string")), -2, 2) == "00"
    return F.when(hit, F.overlay(text, F.lit("X"), 1, 1)).otherwise(text)


def audit_pages(pages: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Audit of the pages' archive against a replica with planted damage."""
    records = pages.select("page_id", record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    copy = records.select("page_id", flipped(F.col("record"), F.col("page_id")).alias("record"))
    one, two = stage(digests(records), "digests"), stage(digests(copy), "digests")
    files = file_count(one, file_bytes)
    return audit(layout(one, files), layout(two, files))


SQL = f"""
WITH records AS (
  SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
    || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
    || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages WHERE page_id IS NOT NULL),
hashed AS (
  SELECT page_id, strlen(record) AS length, sha256(record) AS digest,
    CASE WHEN md5(page_id::VARCHAR) LIKE '%00'
      THEN sha256('X' || substr(record, 2))
      ELSE sha256(record) END AS other_digest,
    ('0x' || substr(md5(page_id::VARCHAR), 1, 8))::BIGINT
      % (SELECT ceil(sum(strlen(record)) / {FILE_BYTES}.0)::BIGINT FROM records) AS file
  FROM records)
SELECT file, (row_number() OVER w - 1)::BIGINT AS place, page_id,
  coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id, digest
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset,
  length::BIGINT AS length, digest, other_digest,
  CASE WHEN digest = other_digest THEN 'intact' ELSE 'damaged' END AS status
FROM hashed WINDOW w AS (PARTITION BY file ORDER BY page_id, digest)
"""
