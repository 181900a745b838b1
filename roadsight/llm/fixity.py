"""Merkle fixity audit of WARC replicas.

Pages become WARC records: a header, the URL and the payload, each with its offset in its archive.
A manifest row is (archive, offset, length, digest).  Leaves hash the records of one ordered offset
range of ``LEAF`` bytes, inner nodes the hashes of ``FANOUT`` ranges below, roots a whole archive.
The audit compares the roots of two replicas, then only the children of nodes that differ, down to
the records.  Levels are added until the root of the largest archive has at most ``FANOUT`` children, so
every node's are bounded, whatever the archive's size; payloads are hashed where they are read and
never shuffled.  An id that very many records share makes a large archive, which is cut into sorted
ranges for its offsets.

Null URLs and texts count as empty.  Records without id go to loose archives by their digest.
Exact repetitions of a record are one record (a revisit, as WARC calls it).  Equal or empty replicas
give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from roadsight.llm.common import stage

LEAF, FANOUT = 1 << 16, 64
ARCHIVE_IDS, LOOSE = 4096, 4096


def record(url: Column, payload: Column) -> Column:
    """A response record as text."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def manifest(records: DataFrame) -> DataFrame:
    """(page_id, length, digest, any more columns) to the same with archive and offset.

    Offsets are running sums inside an archive, which holds a bounded range of ids.  They run within
    sorted ranges of rows first, on top of the sums of an archive's earlier ranges, so an archive of
    any size passes no single task.  The ranges are written, so both passes see the same ones.
    """
    archive = F.coalesce(F.floor(F.col("page_id") / ARCHIVE_IDS), -1 - F.pmod(F.xxhash64("digest"), F.lit(LOOSE)))
    parts = max(2, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("page_id").asc_nulls_last(), F.col("digest")]
    ranged = stage(records.dropDuplicates(["page_id", "digest"]).withColumn("archive", archive.cast("long"))
                   .repartitionByRange(parts, F.col("archive"), *order).withColumn("__range", F.spark_partition_id()), "ranges")
    starts = ranged.groupBy("archive", "__range").agg(F.sum("length").alias("__size"))
    starts = starts.withColumn("__start", F.sum("__size").over(Window.partitionBy("archive").orderBy("__range")) - F.col("__size")
                               ).drop("__size")  # at most one row a range and archive
    inner = F.sum("length").over(Window.partitionBy("archive", "__range").orderBy(*order)) - F.col("length")
    return (ranged.withColumn("__inner", inner).join(starts, ["archive", "__range"])
            .withColumn("offset", (F.col("__start") + F.col("__inner")).cast("long")).drop("__range", "__inner", "__start"))


def levels_for(size: int) -> int:
    """Levels a tree needs for ``size`` bytes, so that its root has at most ``FANOUT`` children."""
    levels = 2
    while LEAF * FANOUT ** (levels - 1) < size:
        levels += 1
    return levels


def tree(manifests: DataFrame) -> list[DataFrame]:
    """Levels of the trees of (replica, archive, offset, length, digest), leaves first, roots last.

    A node is (replica, archive, node, hash); its hash covers its children in offset order.
    """
    entry = F.struct(F.col("offset").alias("at"), F.concat_ws(":", "offset", "length", "digest").alias("h"))
    rows = manifests.select("replica", "archive", F.floor(F.col("offset") / LEAF).alias("node"), entry.alias("e"))
    top = levels_for(manifests.agg(F.max(F.col("offset") + F.col("length"))).first()[0] or 0)
    levels = []
    for k in range(top):
        hashed = rows.groupBy("replica", "archive", "node").agg(
            F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["h"]), "\n"), 256).alias("hash"))
        levels.append(stage(hashed, f"tree{k}"))
        up = F.lit(0).cast("long") if k == top - 2 else F.floor(F.col("node") / FANOUT)
        rows = levels[-1].select("replica", "archive", up.alias("up"), F.struct(F.col("node").alias("at"), F.col("hash").alias("h")).alias("e")
                                 ).withColumnRenamed("up", "node")
    return levels


def _differing(nodes: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose values in the two replicas are not the same."""
    both = nodes.groupBy(*keys).agg(F.max(F.when(F.col("replica") == 0, F.col(value))).alias("v0"),
                                    F.max(F.when(F.col("replica") == 1, F.col(value))).alias("v1"))
    return both.where(~F.col("v0").eqNullSafe(F.col("v1")))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Damaged places of ``second`` against ``first``: archive, offset, page_id, lengths, digests, status.

    Both are (archive, offset, length, digest, page_id).
    """
    both = stage(reduce(DataFrame.unionByName, [
        m.select(F.lit(i).alias("replica"), "archive", "offset", "length", "digest", "page_id") for i, m in enumerate((first, second))]), "manifests")
    levels = tree(both)
    bad = _differing(levels[-1], ["archive", "node"], "hash").select("archive", "node")
    for k in range(len(levels) - 2, -1, -1):
        up = F.lit(0).cast("long") if k == len(levels) - 2 else F.floor(F.col("node") / FANOUT)
        below = levels[k].withColumn("up", up).join(
            bad.select("archive", F.col("node").alias("up")), ["archive", "up"], "left_semi")
        bad = _differing(below, ["archive", "node"], "hash").select("archive", "node")
    suspects = both.withColumn("node", F.floor(F.col("offset") / LEAF)).join(bad, ["archive", "node"], "left_semi")
    sides = suspects.groupBy("archive", "offset").agg(
        F.max("page_id").alias("page_id"),
        *[F.max(F.when(F.col("replica") == i, F.col(c))).alias(f"{n}_{c}") for i, n in enumerate(("expected", "found")) for c in ("length", "digest")])
    status = (F.when(F.col("found_digest").isNull(), "missing").when(F.col("expected_digest").isNull(), "extra")
              .when(F.col("expected_length") != F.col("found_length"), "resized").otherwise("altered"))
    return sides.where(~(F.col("expected_digest").eqNullSafe(F.col("found_digest")) & F.col("expected_length").eqNullSafe(F.col("found_length")))
                       ).withColumn("status", status)


def damaged(page_id: Column, html: Column) -> Column:
    """Payload that the query's second replica holds: some pages rot, some are cut, some are lost."""
    text = F.coalesce(html, F.lit(""))
    return (F.when(page_id % 389 == 11, F.lit(None)).when(page_id % 193 == 7, F.substr(text, F.lit(1), F.floor(F.length(text) / 2).cast("int")))
            .when(page_id % 97 == 5, F.concat(F.lit("~"), F.substr(text, F.lit(2)))).otherwise(text))


def audit_pages(pages: DataFrame) -> DataFrame:
    """Audit of the pages against a replica with the damage above."""
    url, html, page_id = F.col("url"), F.col("html"), F.col("page_id").cast("long")
    copy = damaged(page_id, html)
    whole, other = record(url, html), record(url, copy)
    rows = pages.select(
        page_id.alias("page_id"), F.octet_length(whole).cast("long").alias("length"), F.sha2(whole, 256).alias("digest"),
        F.when(copy.isNotNull(), F.octet_length(other).cast("long")).alias("length2"), F.when(copy.isNotNull(), F.sha2(other, 256)).alias("digest2"))
    placed = stage(manifest(rows), "manifest")
    return audit(placed, placed.where("digest2 is not null").select(
        "archive", "offset", "page_id", F.col("length2").alias("length"), F.col("digest2").alias("digest")))


AUDIT_SQL = f"""
WITH p AS (SELECT DISTINCT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
d AS (SELECT *, CASE WHEN page_id % 389 = 11 THEN NULL
        WHEN page_id % 193 = 7 THEN substr(html, 1, CAST(floor(length(html) / 2) AS BIGINT))
        WHEN page_id % 97 = 5 THEN '~' || substr(html, 2) ELSE html END AS copy FROM p),
w AS (SELECT page_id,
  'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS a,
  'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(copy) || chr(13) || chr(10) || chr(13) || chr(10) || copy || chr(13) || chr(10) || chr(13) || chr(10) AS b FROM d),
m AS (SELECT page_id, strlen(a) AS expected_length, sha256(a) AS expected_digest, strlen(b) AS found_length, sha256(b) AS found_digest,
  CAST(floor(page_id / {ARCHIVE_IDS}) AS BIGINT) AS archive FROM w),
o AS (SELECT *, CAST(sum(expected_length) OVER (PARTITION BY archive ORDER BY page_id, expected_digest) - expected_length AS BIGINT) AS "offset" FROM m)
SELECT archive, "offset", page_id, expected_length, expected_digest, found_length, found_digest,
  CASE WHEN found_digest IS NULL THEN 'missing' WHEN expected_length <> found_length THEN 'resized' ELSE 'altered' END AS status
FROM o WHERE found_digest IS NULL OR found_digest <> expected_digest"""
