"""Fixity audit of WARC replicas with Merkle trees over ordered offset ranges.

A replica is a table of records: file, offset, length and the record's bytes.
Leaves hash the records that start in one range of offsets, in offset order; a
node above hashes its children in order, up to one root per file.  An audit
compares the roots of two replicas and goes down only below nodes that differ,
so most of two like replicas is never looked at again.  Everything but reading
files of the format is DataFrame functions.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procwarden.session import cut_lineage

RANGE = 1 << 18  # bytes of offsets under one leaf
FANOUT = 16  # children of a node
CRLF = "\r\n"


def record_text(url: Column, payload: Column, record_id: Column) -> Column:
    """One WARC resource record as text; null fields are empty."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: resource{CRLF}WARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), F.lit("")), F.lit(f">{CRLF}WARC-Target-URI: "),
        F.coalesce(url, F.lit("")), F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "),
        F.octet_length(body).cast("string"), F.lit(CRLF * 2), body, F.lit(CRLF * 2))


def records_of_pages(pages: DataFrame, per_file: int = 256) -> DataFrame:
    """(file, offset, length, page_id, digest): pages laid out as records of WARC files.

    A file holds the pages of ``per_file`` successive ids, by id, then digest; pages
    without an id are spread over files ``none-..`` by digest.  Only the digest
    (SHA-256) and the length of a record are carried on, its bytes never move.
    """
    record = record_text(F.col("url"), F.col("html"), F.col("page_id"))
    rows = pages.select(
        F.floor(F.col("page_id") / per_file).cast("string").alias("file"), "page_id",
        F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest"))
    rows = rows.withColumn("file", F.coalesce("file", F.concat(F.lit("none-"), F.substring("digest", 1, 4))))
    before = W.partitionBy("file").orderBy("page_id", "digest").rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(
        "file", "offset", "length", "page_id", "digest")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, length, uri, digest) of the records of WARC files, plain or gzip.

    Offsets count uncompressed bytes.  A file is the unit of work; a record that is
    cut off at the end of a file is kept with the length that is there.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = content.as_py()
                stream = gzip.GzipFile(fileobj=io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
                rows, at = [], 0
                while True:
                    head, size, uri = b"", 0, ""
                    while line := stream.readline():
                        head += line
                        if line in (b"\r\n", b"\n") and head.strip():
                            break
                        key, _, value = line.partition(b":")
                        if key.lower() == b"content-length" and value.strip().isdigit():
                            size = int(value)
                        elif key.lower() == b"warc-target-uri":
                            uri = value.strip().decode("utf-8", "replace")
                    if not head.strip():
                        break
                    data = head + stream.read(size + 4)
                    rows.append((name, at, len(data), uri, hashlib.sha256(data).hexdigest()))
                    at += len(data)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)],
                                                     ["file", "offset", "length", "uri", "digest"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, offset long, length long, uri string, digest string")


def _hash(parts: Column) -> Column:
    return F.sha2(F.concat_ws("\n", parts), 256)


def tree(records: DataFrame) -> list[DataFrame]:
    """Levels of (file, node, hash), leaves first, until every file has one node.

    Repeated rows are counted, not listed; records of equal offset are ordered by
    digest; null offsets or lengths count as 0, null files as the file ``none``.
    """
    once = records.groupBy(
        F.coalesce("file", F.lit("none")).alias("file"), F.coalesce("offset", F.lit(0)).alias("offset"),
        F.coalesce("digest", F.lit("")).alias("digest"), F.coalesce("length", F.lit(0)).alias("length")).count()
    line = F.struct("offset", "digest", "length", "count")
    lines = F.transform(F.sort_array(F.collect_list(line)),
                        lambda x: F.concat_ws(":", x["offset"], x["length"], x["digest"], x["count"]))
    levels = [cut_lineage(once.groupBy("file", F.floor(F.col("offset") / RANGE).alias("node"))
                          .agg(_hash(lines).alias("hash")))]
    while (levels[-1].agg(F.max("node").alias("m")).first()["m"] or 0) > 0:
        child = F.struct("node", "hash")
        children = F.transform(F.sort_array(F.collect_list(child)), lambda x: F.concat_ws(":", x["node"], x["hash"]))
        levels.append(cut_lineage(levels[-1].groupBy("file", F.floor(F.col("node") / FANOUT).alias("up"))
                                  .agg(_hash(children).alias("hash")).withColumnRenamed("up", "node")))
    return levels


def _differ(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes that are not the same in both, missing ones included."""
    keys = ["file", "node"]
    return (a.join(b.withColumnRenamed("hash", "_other"), keys, "full_outer")
            .where(~F.col("hash").eqNullSafe(F.col("_other"))).select(*keys))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """(file, offset, status, first_length, second_length, first_digest, second_digest) of unlike records.

    ``status`` is ``changed`` (same offset, other bytes), ``missing`` (not in the second
    replica) or ``extra`` (not in the first).  Of several rows at one offset all
    are compared; the smallest unlike digest stands for a side, else its smallest.  Like replicas, empty ones too, give no rows.
    """
    trees = [tree(r) for r in (first, second)]
    high = max(map(len, trees))
    below = None
    for level in reversed(range(high)):
        # a replica with fewer levels has all its nodes at 0 already
        one, two = (t[min(level, len(t) - 1)] for t in trees)
        if len(trees[0]) != len(trees[1]) and level >= min(map(len, trees)):
            continue
        if below is not None:
            up = F.floor(F.col("node") / FANOUT)
            one, two = (x.withColumn("_up", up).join(
                below.withColumnsRenamed({"node": "_up"}), ["file", "_up"], "left_semi").drop("_up") for x in (one, two))
        below = cut_lineage(_differ(one, two))
    sides = []
    for records, counts in ((first, (1, 0)), (second, (0, 1))):
        found = records.select(F.coalesce("file", F.lit("none")).alias("file"),
                               F.coalesce("offset", F.lit(0)).alias("offset"), F.coalesce("length", F.lit(0)).alias("length"),
                               F.coalesce("digest", F.lit("")).alias("digest"), *[F.lit(n).alias(c) for c, n in zip(("_a", "_b"), counts)])
        sides.append(found.withColumn("node", F.floor(F.col("offset") / RANGE)).join(below, ["file", "node"], "left_semi"))
    kinds = sides[0].unionByName(sides[1]).groupBy("file", "offset", "digest", "length").agg(
        F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    record, unlike = F.struct("digest", "length"), F.col("_a") != F.col("_b")
    shown = [F.coalesce(F.min(F.when(unlike & (F.col(c) > 0), record)), F.min(F.when(F.col(c) > 0, record))).alias(name)
             for name, c in (("first", "_a"), ("second", "_b"))]
    both = kinds.groupBy("file", "offset").agg(F.max(unlike).alias("_unlike"), *shown).where("_unlike")
    status = F.when(F.col("second").isNull(), "missing").when(F.col("first").isNull(), "extra").otherwise("changed")
    return both.select("file", "offset", status.alias("status"), F.col("first.length").alias("first_length"),
                       F.col("second.length").alias("second_length"), F.col("first.digest").alias("first_digest"),
                       F.col("second.digest").alias("second_digest"))


def damaged(pages: DataFrame) -> DataFrame:
    """The pages as a failing store would return them: the replica that the query audits.

    A page whose id's MD5 begins with ``00`` has its first two characters overwritten,
    one that begins with ``01`` has lost its content but kept its length.
    """
    mark = F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), 1, 2)
    html = F.col("html")
    return pages.withColumn("html", F.when(mark == "00", F.concat(F.lit("##"), F.substring(html, 3, 1 << 30)))
                            .when(mark == "01", F.repeat(F.lit(" "), F.octet_length(html))).otherwise(html))


ORACLE = r"""
WITH marked AS (
  SELECT page_id, url, html,
         substr(md5(coalesce(page_id::VARCHAR, '')), 1, 2) AS mark FROM pages
), both_ AS (
  SELECT page_id, url, coalesce(html, '') AS html, coalesce(CASE mark WHEN '00' THEN '##' || substr(html, 3)
         WHEN '01' THEN repeat(' ', octet_length(encode(html))) ELSE html END, '') AS html2 FROM marked
), recs AS (
  SELECT page_id, coalesce(floor(page_id / 256)::BIGINT::VARCHAR, 'none') AS file,
         [concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Record-ID: <urn:page:',
           coalesce(page_id::VARCHAR, ''), '>', chr(13), chr(10), 'WARC-Target-URI: ', coalesce(url, ''), chr(13), chr(10),
           'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', octet_length(encode(h)), chr(13), chr(10),
           chr(13), chr(10), h, chr(13), chr(10), chr(13), chr(10)) FOR h IN [html, html2]] AS r
  FROM both_
), hashed AS (
  SELECT file, page_id, octet_length(encode(r[1]))::BIGINT AS n1, octet_length(encode(r[2]))::BIGINT AS n2,
         sha256(r[1]) AS d1, sha256(r[2]) AS d2 FROM recs
), laid AS (
  SELECT *, coalesce(sum(n1) OVER (PARTITION BY file ORDER BY page_id, d1
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM hashed
)
SELECT file, "offset", 'changed' AS status, n1 AS first_length, n2 AS second_length,
       d1 AS first_digest, d2 AS second_digest
FROM laid WHERE d1 <> d2
"""
