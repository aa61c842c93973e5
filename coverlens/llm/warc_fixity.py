"""WARC fixity audit: Merkle trees over records and ordered offset ranges, compared from the root down.

Each record of an archive file is hashed; the records that start in one range of bytes make
a leaf, and ``FANOUT`` neighbouring ranges make a node of the next level, up to one root for
each file.  Two replicas are compared root by root, and only the branches whose hashes
differ are followed down, to the records that differ.  Ranges go by offset, so a damaged or
lost record changes the hashes above it and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coverlens.llm.common import save

#: Bytes of a leaf's range, and children of a node: what one hash is made of.
RANGE_BYTES = 1 << 16
FANOUT = 16
#: Records of one archive file when pages are laid out as an archive.
FILE_RECORDS = 1000


def record_head(url: Column, record_id: Column, payload: Column) -> Column:
    """Header of a WARC resource record, up to the blank line."""
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")),
                    F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))


def tree(records: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT, levels: int = 1) -> list[DataFrame]:
    """Levels (file, node, hash) of the trees over records (file, offset, length, digest), leaves first.

    A leaf's hash covers offset, length and digest of its records in order; a node's hash covers
    number and hash of its children in order.
    """
    part = F.struct("offset", F.concat_ws(" ", "offset", "length", "digest").alias("h"))
    node = F.floor(F.col("offset") / range_bytes).cast("long")

    def hashed(parts: Column) -> Column:
        return F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(parts)), lambda x: x["h"]), "|").cast("binary"), 256)

    out = [save(records.groupBy("file", node.alias("node")).agg(hashed(part).alias("hash")))]
    for _ in range(levels):
        part = F.struct("node", F.concat_ws(" ", "node", "hash").alias("h"))
        out.append(save(out[-1].groupBy("file", F.floor(F.col("node") / fanout).cast("long").alias("up")).agg(hashed(part).alias("hash"))
                        .withColumnRenamed("up", "node")))
    return out


def _unlike(a: DataFrame, b: DataFrame) -> DataFrame:
    """(file, node) of the nodes whose hashes differ, or that one side lacks."""
    b = b.select(F.col("file").alias("file_b"), F.col("node").alias("node_b"), F.col("hash").alias("hash_b"))
    both = a.join(b, (a["file"] == b["file_b"]) & (a["node"] == b["node_b"]), "full")
    return (both.filter(~F.col("hash").eqNullSafe(F.col("hash_b")))
            .select(F.coalesce("file", "file_b").alias("file"), F.coalesce("node", "node_b").alias("node")))


def audit(first: DataFrame, second: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Records on which two replicas differ: file, offset, kind, and length, digest and record id on both sides.

    The replicas are tables (file, offset, length, digest, record_id).  ``kind`` is ``missing``
    (only in the first), ``extra`` (only in the second), ``length`` or ``changed``.  A null file,
    offset, length or digest is an error of the index, and such rows are left to the caller;
    they are not compared.  Repeated rows of a replica count once.  Equal replicas, or two empty
    ones, give no rows.

    One hash covers the records that start in ``range_bytes`` bytes, or ``fanout`` children,
    whatever the size of a file, so no step gathers more than that.  The records are read for
    the leaves and once more in the branches that differ.
    """
    keys = ["file", "offset", "length", "digest"]
    a, b = (x.select(*keys, "record_id").dropna(subset=keys).dropDuplicates(keys) for x in (first, second))
    a, b = save(a), save(b)
    far = a.select("offset").unionByName(b.select("offset")).agg(F.max("offset")).first()[0] or 0
    levels, width = 0, far // range_bytes + 1
    while width > 1:
        levels, width = levels + 1, -(-width // fanout)
    trees = tree(a, range_bytes, fanout, levels), tree(b, range_bytes, fanout, levels)
    open_ = _unlike(trees[0][levels], trees[1][levels])
    for k in range(levels - 1, -1, -1):
        open_ = save(open_.withColumnRenamed("node", "up"))
        below = [t[k].withColumn("up", F.floor(F.col("node") / fanout).cast("long")).join(open_, ["file", "up"], "left_semi").drop("up")
                 for t in trees]
        open_ = _unlike(*below)
    open_ = save(open_)
    node = F.floor(F.col("offset") / range_bytes).cast("long")
    x, y = (r.withColumn("node", node).join(open_, ["file", "node"], "left_semi")
            .select("file", "offset", *[F.col(c).alias(f"{c}_{s}") for c in ("length", "digest", "record_id")])
            for r, s in ((a, "first"), (b, "second")))
    y = y.select(F.col("file").alias("f"), F.col("offset").alias("o"), "length_second", "digest_second", "record_id_second")
    both = x.join(y, (x["file"] == y["f"]) & (x["offset"] == y["o"]), "full")
    kind = (F.when(F.col("digest_second").isNull(), "missing").when(F.col("digest_first").isNull(), "extra")
            .when(F.col("length_first") != F.col("length_second"), "length").otherwise("changed"))
    return (both.filter(~(F.col("digest_first").eqNullSafe(F.col("digest_second")) & F.col("length_first").eqNullSafe(F.col("length_second"))))
            .select(F.coalesce("file", "f").alias("file"), F.coalesce("offset", "o").alias("offset"), kind.alias("kind"),
                    "length_first", "length_second", "digest_first", "digest_second",
                    F.coalesce("record_id_first", "record_id_second").alias("record_id")))


def archived_pages(pages: DataFrame) -> DataFrame:
    """Both replicas of the pages as archive records, side by side: file, offset, record_id, length_a/b, digest_a/b.

    Files hold ``FILE_RECORDS`` page numbers each; records lie in the order of page number and
    digest.  The second replica has the damage that the audit is to find: of the pages whose
    number is 11 modulo 211 the record is lost, 5 modulo 307 the payload is cut to half its
    characters, 7 modulo 89 its first character is an X.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    head, end = record_head(F.col("url"), F.col("page_id"), payload), F.lit("\r\n\r\n")
    number = F.col("page_id")
    hurt = (F.when(number % 307 == 5, F.substring(payload, F.lit(1), F.floor(F.length(payload) / 2).cast("int")))
            .when((number % 89 == 7) & (payload != ""), F.concat(F.lit("X"), F.substring(payload, F.lit(2), F.length(payload))))
            .otherwise(payload))
    one, two = F.concat(head, payload, end), F.concat(head, hurt, end)
    small = save(pages.select(
        F.col("page_id").alias("record_id"), F.coalesce(F.floor(number / FILE_RECORDS), F.lit(-1)).cast("long").alias("file"),
        F.octet_length(one).cast("long").alias("length_a"), F.sha2(one.cast("binary"), 256).alias("digest_a"),
        F.octet_length(two).cast("long").alias("length_b"),
        F.when(F.coalesce(number % 211 != 11, F.lit(True)), F.sha2(two.cast("binary"), 256)).alias("digest_b")))
    laid = Window.partitionBy("file").orderBy("record_id", "digest_a").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return small.withColumn("offset", F.sum("length_a").over(laid) - F.col("length_a"))


def op4_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    a, b = (both.select("file", "offset", F.col(f"length_{s}").alias("length"), F.col(f"digest_{s}").alias("digest"), "record_id") for s in "ab")
    return audit(a, b).select(F.col("record_id").alias("page_id"), "file", F.col("offset").alias("record_offset"), "kind",
                              "length_first", "length_second", "digest_first", "digest_second")


OP4_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
    || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) AS head,
    chr(13) || chr(10) || chr(13) || chr(10) AS tail FROM pages),
r AS (
  SELECT page_id, CAST(coalesce(floor(page_id / 1000), -1) AS BIGINT) AS file, head || body || tail AS a,
    CASE WHEN page_id % 211 = 11 THEN NULL
         ELSE head || CASE WHEN page_id % 307 = 5 THEN substr(body, 1, CAST(floor(length(body) / 2) AS BIGINT))
                           WHEN page_id % 89 = 7 AND body <> '' THEN 'X' || substr(body, 2) ELSE body END || tail END AS b
  FROM p),
o AS (
  SELECT *, CAST(sum(strlen(a)) OVER (PARTITION BY file ORDER BY page_id NULLS FIRST, sha256(a)
    ROWS UNBOUNDED PRECEDING) - strlen(a) AS BIGINT) AS record_offset FROM r)
SELECT page_id, file, record_offset,
  CASE WHEN b IS NULL THEN 'missing' WHEN strlen(a) <> strlen(b) THEN 'length' ELSE 'changed' END AS kind,
  CAST(strlen(a) AS BIGINT) AS length_first, CAST(strlen(b) AS BIGINT) AS length_second,
  sha256(a) AS digest_first, sha256(b) AS digest_second
FROM o WHERE b IS NULL OR a <> b
"""
