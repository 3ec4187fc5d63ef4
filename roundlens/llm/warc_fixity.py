"""Merkle fixity audit of WARC replicas.

Records of a WARC file are hashed (sha256) in offset order; every ``FANOUT``
neighbouring hashes make one parent, up to the file's root.  Two replicas are
compared from the roots down: only children of branches that differ are read on
the next level, so an audit of equal replicas ends at the roots and a damaged
record is found along one path.  Everything is DataFrame work keyed by (file,
node), so no key holds more than ``FANOUT`` rows.

Defined cases: a null payload or url is an empty one; repeated records are
separate records in offset order; null page_ids are equal to each other; a record
missing in one replica is reported as ``missing`` (or ``extra``), one that stands at
another place as ``moved``; empty stores have no roots and no damage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .mixing import hash60
from .spread import written

FANOUT = 16
FILE_RECORDS = 4096


def warc_record(page_id: Column, url: Column, payload: Column) -> Column:
    """Bytes of one WARC/1.0 resource record."""
    body = F.encode(F.coalesce(payload, F.lit("")), "utf-8")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "utf-8"), body, F.encode(F.lit("\r\n\r\n"), "utf-8"))


def lay_out(pages: DataFrame, files: int) -> DataFrame:
    """(file, seq, offset, length, page_id, record): records of each file in page order, back to back."""
    rows = pages.select(F.pmod(hash60(F.col("page_id")), F.lit(files)).alias("file"), "page_id",
                        warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    order = Window.partitionBy("file").orderBy("page_id", "record")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("length", F.octet_length("record").cast("long")).select(
        "file", (F.row_number().over(order) - 1).cast("long").alias("seq"),
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), "length", "page_id", "record")


def leaves(records: DataFrame) -> DataFrame:
    """(file, node, hash) of level 0: offset, length and bytes of every record."""
    hashed = F.sha2(F.concat(F.encode(F.concat_ws(":", "offset", "length"), "utf-8"), F.col("record")), 256)
    return records.select("file", F.col("seq").alias("node"), hashed.alias("hash"))


def tree(records: DataFrame) -> list[DataFrame]:
    """Levels of the Merkle trees of all files, leaves first; the last level holds the roots."""
    levels = [written(leaves(records), "merkle")]
    while (levels[-1].agg(F.max("node")).first()[0] or 0) > 0:
        kids = F.array_sort(F.collect_list(F.struct("node", "hash")))
        up = (levels[-1].withColumn("parent", F.shiftright("node", FANOUT.bit_length() - 1))
              .groupBy("file", "parent").agg(kids.alias("kids")))
        levels.append(written(up.select(
            "file", F.col("parent").alias("node"),
            F.sha2(F.array_join(F.transform("kids", lambda k: F.concat_ws(":", k["node"], k["hash"])), ","), 256)
            .alias("hash")), "merkle"))
    return levels


def damaged(left: list[DataFrame], right: list[DataFrame]) -> DataFrame:
    """(file, node) of leaves that differ or stand in one replica only, found from the roots down."""
    while len(left) < len(right):  # an empty top level matches nothing, so every branch is descended
        left = [*left, left[-1].limit(0)]
    while len(right) < len(left):
        right = [*right, right[-1].limit(0)]
    branch = None
    for a, b in zip(reversed(left), reversed(right)):
        a, b = (x.withColumn("parent", F.shiftright("node", FANOUT.bit_length() - 1)) for x in (a, b))
        if branch is not None:
            up = branch.withColumnRenamed("node", "parent")
            a, b = (x.join(up, ["file", "parent"], "left_semi") for x in (a, b))
        branch = written(
            a.select("file", "node", F.col("hash").alias("ha")).join(
                b.select("file", "node", F.col("hash").alias("hb")), ["file", "node"], "full")
            .filter(~F.col("ha").eqNullSafe(F.col("hb"))).select("file", "node"), "merkle-diff")
    return branch


def _nth(rows: DataFrame, *key: str) -> DataFrame:
    """Rows with their number among those of equal key, so that repeats pair off in order."""
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy("file", *key).orderBy("seq")))


def audit(main: DataFrame, replica: DataFrame) -> DataFrame:
    """file, seq, offset, length, page_id, sha256, state of every record of either replica.

    Only records in differing branches are looked at further.  Those whose bytes
    stand elsewhere in the replica's file are ``moved``, so a lost or added record
    does not condemn those after it; of the rest, equal record ids are ``damaged``,
    others ``missing`` or ``extra`` (with the replica's place and no digest).
    """
    bad = damaged(tree(main), tree(replica)).withColumnRenamed("node", "seq")
    cols = ["file", "seq", "offset", "length", "page_id", "sha256"]
    a = main.select(*cols[:-1], F.sha2("record", 256).alias("sha256"))
    b = replica.join(bad, ["file", "seq"], "left_semi").select(*cols[:-1], F.sha2("record", 256).alias("sha256"))
    left = written(a.join(bad, ["file", "seq"], "left_semi"), "merkle-left")
    right = written(b, "merkle-right")
    fine = a.join(bad, ["file", "seq"], "left_anti").withColumn("state", F.lit("ok"))
    # Equal bytes first, each in file order, then equal record ids.
    by_bytes = ["file", "sha256", "nth"]
    l1, r1 = _nth(left, "sha256"), _nth(right, "sha256")
    moved = l1.join(r1.select(*by_bytes), by_bytes, "left_semi").select(*cols, F.lit("moved").alias("state"))
    l2 = _nth(l1.join(r1.select(*by_bytes), by_bytes, "left_anti").drop("nth"), "page_id")
    r2 = _nth(r1.join(l1.select(*by_bytes), by_bytes, "left_anti").drop("nth"), "page_id")
    same = (l2["file"] == r2["file"]) & l2["page_id"].eqNullSafe(r2["page_id"]) & (l2["nth"] == r2["nth"])
    hurt = l2.join(r2, same, "left_semi").select(*cols, F.lit("damaged").alias("state"))
    lost = l2.join(r2, same, "left_anti").select(*cols, F.lit("missing").alias("state"))
    extra = r2.join(l2, same, "left_anti").select(*cols[:-1], F.lit(None).cast("string").alias("sha256"),
                                                  F.lit("extra").alias("state"))
    return fine.union(moved).union(hurt).union(lost).union(extra)


def spoil(records: DataFrame) -> DataFrame:
    """A replica with damage by rule: one record in 97 has its last payload byte changed, one in 211 is lost."""
    h = hash60(F.concat(F.lit("spoil"), F.col("page_id").cast("string")))
    n = F.col("length").cast("int")
    changed = F.concat(F.substring("record", 1, n - 5), F.encode(F.lit("#"), "utf-8"), F.expr("substring(record, length - 3, 4)"))
    return (records.withColumn("record", F.when(F.coalesce(h % 97 == 0, F.lit(False)), changed).otherwise(F.col("record")))
            .filter(F.coalesce(h % 211 != 0, F.lit(True))))


def audit_pages(pages: DataFrame) -> DataFrame:
    """Lay the pages out as WARC files, derive a replica with damage by rule, and audit it."""
    files = max(1, -(-pages.count() // FILE_RECORDS))
    main = written(lay_out(pages, files), "warc-main")
    replica = written(spoil(main), "warc-replica")
    return audit(main, replica)


SQL = r"""
WITH n AS (SELECT greatest(1, (count(*) + 4095) // 4096) AS files FROM pages),
r AS (SELECT ('0x' || substr(md5(coalesce(page_id::VARCHAR, '')), 1, 15))::BIGINT % (SELECT files FROM n) AS file, page_id,
  ('0x' || substr(md5('spoil' || page_id::VARCHAR), 1, 15))::BIGINT AS h,
  encode('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
  || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
  || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10)
  || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)) AS record FROM pages)
SELECT file, row_number() OVER w - 1 AS seq,
  coalesce(sum(octet_length(record)) OVER (PARTITION BY file ORDER BY page_id, record ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset,
  octet_length(record)::BIGINT AS length, page_id, sha256(record) AS sha256,
  CASE WHEN coalesce(h % 211 = 0, false) THEN 'missing'
    WHEN coalesce(h % 97 = 0, false) AND length(html) > 0 AND right(html, 1) <> '#' THEN 'damaged' ELSE 'ok' END AS state
FROM r JOIN (SELECT page_id AS p, html FROM pages) ON p IS NOT DISTINCT FROM page_id WINDOW w AS (PARTITION BY file ORDER BY page_id, record)"""
