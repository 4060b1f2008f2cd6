"""WARC records, and a Merkle audit of their fixity.

Records are serialised as WARC/1.1 and laid out in files. Each replica of the files gets hash trees: a leaf
is the SHA-256 of the records that start in one range of offsets, and each node above hashes a fixed
number of children in order. The audit compares the replicas' roots and then descends one level at a time,
only below nodes that differ, down to the records.

Ranges go by offset, so no task ever numbers or holds a whole file; hashes are computed where the
records are read, and only digests are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import checkpoint, read_table

#: Bytes of a file that one leaf covers, and children of a node.
LEAF_BYTES, FANOUT = 64 << 10, 8
#: Records of a file, on average.
FILE_RECORDS = 1024


def warc_record(url: Column, body: Column, record_id: Column) -> Column:
    """A response record as bytes; null parts count as empty."""
    url, body, record_id = (F.coalesce(c.cast("string"), F.lit("")) for c in (url, body, record_id))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), record_id, F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def pack_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", file_records: int = FILE_RECORDS) -> DataFrame:
    """Lays records out in files: file, offset, length, copies, the id and url, and the record's bytes' digest.

    Files are dealt by a hash of id, url and body, about ``file_records`` each; in a file, records stand in the order of id, url and digest.
    Rows that are equal are stored once, with ``copies``. Bodies are hashed where they are read and not
    shuffled. An empty table gives no files.
    """
    record = warc_record(F.col(url_col), F.col(body_col), F.col(id_col))
    lean = pages.select(F.col(id_col).alias("record_id"), F.col(url_col).alias("url"), F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest"))
    distinct = lean.groupBy("record_id", "url", "length", "digest").agg(F.count(F.lit(1)).alias("copies"))
    files = F.greatest(F.ceil(F.lit(pages.count() / file_records)), F.lit(1))
    placed = distinct.withColumn("file", F.pmod(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), files))
    before = Window.partitionBy("file").orderBy("record_id", "url", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def leaf_nodes(records: DataFrame, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """Level 0: a hash for each range of offsets. A range holds at most as many records as it has bytes."""
    return (
        records.groupBy("file", F.floor(F.col("offset") / leaf_bytes).alias("node"))
        .agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "length", "digest"))), lambda r: F.concat_ws(":", r["offset"], r["length"], r["digest"])), "\n"), 256).alias("hash"))
    )


def parent_nodes(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The next level: each node hashes up to ``fanout`` children in order."""
    return nodes.groupBy("file", F.floor(F.col("node") / fanout).alias("parent")).agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "hash"))), lambda c: F.concat_ws(":", c["node"], c["hash"])), "\n"), 256).alias("hash")
    ).withColumnRenamed("parent", "node")


def merkle_levels(records: DataFrame, levels: int, leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT) -> list[DataFrame]:
    """Trees of all files, leaves first; the last level has one root for each file."""
    out = [leaf_nodes(records, leaf_bytes)]
    for _ in range(levels - 1):
        out.append(parent_nodes(out[-1], fanout))
    return out


def audit_replicas(left: DataFrame, right: DataFrame, leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Where two replicas differ: file, offset, status and the lengths and digests on either side.

    Both sides have file, offset, length and digest. Status is ``corrupt`` (both have a record at the offset, with other
    bytes), ``missing`` (only the left has it) or ``extra`` (only the right). Where several records claim one offset, those that both sides have
    are left out, and the others are set against each other in the order of length and digest. Null files or offsets can't be
    addressed and are left out, as are repeated rows after the first. Equal or empty replicas give no rows. Further columns are ignored.
    """
    sides = [checkpoint(x.select("file", "offset", "length", "digest").where("file IS NOT NULL AND offset IS NOT NULL").distinct()) for x in (left, right)]
    longest = max(x.agg(F.max("offset")).first()[0] or 0 for x in sides)
    levels, width = 1, leaf_bytes
    while width <= longest:
        levels, width = levels + 1, width * fanout
    trees = [merkle_levels(x, levels, leaf_bytes, fanout) for x in sides]
    differing: DataFrame | None = None
    for level in range(levels - 1, -1, -1):
        here = [t[level] for t in trees]
        if differing is not None:
            above = differing.withColumnRenamed("node", "parent")
            here = [x.withColumn("parent", F.floor(F.col("node") / fanout)).join(above, ["file", "parent"], "left_semi").drop("parent") for x in here]
        a, b = (x.withColumnRenamed("hash", f"hash_{i}") for i, x in enumerate(here))
        differing = a.join(b, ["file", "node"], "full").where(~F.col("hash_0").eqNullSafe(F.col("hash_1"))).select("file", "node")
        differing = checkpoint(differing)
    near = [x.withColumn("node", F.floor(F.col("offset") / leaf_bytes)).join(differing, ["file", "node"], "left_semi").select("file", "offset", F.struct("length", "digest").alias("r")) for x in sides]
    alike = F.col("a.file").eqNullSafe(F.col("b.file")) & (F.col("a.offset") == F.col("b.offset")) & F.col("a.r.length").eqNullSafe(F.col("b.r.length")) & F.col("a.r.digest").eqNullSafe(F.col("b.r.digest"))
    turn = F.row_number().over(Window.partitionBy("file", "offset").orderBy("r"))
    spots = [x.alias("a").join(y.alias("b"), alike, "left_anti").withColumn("turn", turn).withColumnRenamed("r", f"r{i}") for i, (x, y) in enumerate((near, near[::-1]))]
    return (
        spots[0].join(spots[1], ["file", "offset", "turn"], "full")
        .select(
            "file", "offset",
            F.when(F.col("r1").isNull(), "missing").when(F.col("r0").isNull(), "extra").otherwise("corrupt").alias("status"),
            F.col("r0.length").alias("length"), F.col("r1.length").alias("other_length"), F.col("r0.digest").alias("digest"), F.col("r1.digest").alias("other_digest"),
        )
    )


def damaged_replica(pages: DataFrame, placed: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """A second replica, read and hashed by itself, with faults planted in its bytes for drills: file, offset, length, digest.

    ``placed`` (of ``pack_records``) says where a record lies. By the record's own digest, one in 64 has a bit of its first byte flipped, another one is
    lost, and another one is followed by a stray record. Null parts count as in ``warc_record``; repeated pages are one record.
    """
    record = warc_record(F.col(url_col), F.col(body_col), F.col(id_col))
    read = pages.select(F.col(id_col).alias("record_id"), F.col(url_col).alias("url"), record.alias("record"), F.sha2(record, 256).alias("key"))
    drill = F.pmod(F.conv(F.substring("key", 63, 2), 16, 10).cast("int"), F.lit(64))
    kept = F.struct(F.lit(0).alias("shift"), F.when(drill == 0, F.concat(F.lit(b"w"), F.expr("substring(record, 2)"))).otherwise(F.col("record")).alias("bytes"))
    stray = F.struct(F.lit(1).alias("shift"), F.concat(F.lit("stray:"), "key").cast("binary").alias("bytes"))
    stored = read.where(drill != 1).select("record_id", "url", "key", F.explode(F.when(drill == 2, F.array(kept, stray)).otherwise(F.array(kept))).alias("s"))
    hashed = stored.select("record_id", "url", "key", "s.shift", F.octet_length("s.bytes").cast("long").alias("length"), F.sha2("s.bytes", 256).alias("digest"))
    same = F.col("h.record_id").eqNullSafe(F.col("p.record_id")) & F.col("h.url").eqNullSafe(F.col("p.url")) & (F.col("h.key") == F.col("p.digest"))
    return hashed.alias("h").join(placed.alias("p"), same).select("p.file", (F.col("p.offset") + F.col("h.shift")).alias("offset"), "h.length", "h.digest").distinct()


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits the WARC layout of all pages against a replica with planted faults."""
    pages = read_table(spark, sf_dir, "pages")
    records = checkpoint(pack_records(pages))
    found = audit_replicas(records, damaged_replica(pages, records))
    names = records.select("file", "offset", F.col("record_id").alias("page_id"), "copies")
    return found.join(names, ["file", "offset"], "left").select("file", "offset", "status", "page_id", "copies", "length", "other_length", "digest", "other_digest")


SQL = r"""
WITH rec AS (
  SELECT page_id, url, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '')
         || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
         || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages
), lean AS (
  SELECT page_id, url, CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS digest, sha256('w' || substr(record, 2)) AS flipped, count(*) AS copies FROM rec GROUP BY ALL
), placed AS (
  SELECT *, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % greatest((SELECT CAST(ceil(count(*) / 1024.0) AS BIGINT) FROM pages), 1) AS file,
         CAST('0x' || substr(digest, 63, 2) AS BIGINT) % 64 AS drill
  FROM lean
), laid AS (
  SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id NULLS FIRST, url NULLS FIRST, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM placed
)
SELECT file, "offset", 'corrupt' AS status, page_id, copies, length, length AS other_length, digest, flipped AS other_digest FROM laid WHERE drill = 0
UNION ALL SELECT file, "offset", 'missing', page_id, copies, length, NULL, digest, NULL FROM laid WHERE drill = 1
UNION ALL SELECT file, "offset" + 1, 'extra', NULL, NULL, NULL, 70, NULL, sha256('stray:' || digest) FROM laid WHERE drill = 2
"""
