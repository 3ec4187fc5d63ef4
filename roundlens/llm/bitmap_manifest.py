"""Merkle manifest of a dataset whose leaf coordinates come from bitmap ranks.

Each row is a leaf; the leaves of a group (``source``) ascend by doc_id, every 16
consecutive nodes hash into one until one is left, and the groups' roots, in the
order of their names, hash into the dataset's root likewise.

* Coordinates.  Tasks put the doc_ids they read into compressed bitmaps, one per
  group and 65,536 ids (the shortest of list, runs and bits).  Bitmaps of equal
  place are merged into words of 64 ids with a popcount directory: the ids before
  each word, summed over three levels of the id's high bits, none of which
  orders more than 65,536 entries.  A leaf's coordinate is a rank query on its
  word: directory entry plus popcount below its bit.  No leaf is sorted.
* Repeated ids.  Bitmaps carry how often an id repeats, so ranks leave room.
  Rows that share an id, or have none, are told apart by leaf digest: equal
  leaves are counted, the digests' first bits ranked by the same bitmaps.
* Levels.  Leaves go by coordinate into keyed slot arrays of 4,096, each of
  which reduces three levels at once; what remains goes round again until each
  group has one node, then the groups do.  Sibling paths come back down the same
  way, and a last pass over the slot arrays gives each leaf its proof.

A group may hold any share of the rows: no key holds more than one bitmap's or
one slot array's rows, and equal rows travel as a count.

Defined cases: null fields hash as ``-``; a null doc_id comes before all others;
rows of one group and doc_id are ordered by leaf digest, so equal rows take
neighbouring places; a null group comes first, and an empty one is a group of its
own; a lone node is its own root; an empty table gives an empty result; other
columns are ignored.  doc_id must be an integer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.replay import sequence_numbers
from .spread import release, written
from .sqltext import CRC_TABLE, crc32

FAN_BITS = 4            # 16 children
ROUND_LEVELS = 3        # levels one slot array reduces
HELD_IDS = 1 << 20      # ids a task holds before it passes its bitmaps on
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_ROWS = 1 << 14    # rows written out at a time from one counted row

PARTIAL = "g string, place long, body binary, low binary, more binary"
WORDS = "g string, place long, word long, bits long, before long, reps array<struct<bit:int,more:long>>, total long"


# --- compressed bitmaps -----------------------------------------------------------------

def pack_ids(low: np.ndarray) -> bytes:
    """Ascending distinct 16-bit ids as the shortest of list (0), runs (1) and bits (2)."""
    edge = np.flatnonzero(np.diff(low.astype(np.int32)) != 1)
    start = low[np.concatenate([[0], edge + 1])]
    size = np.diff(np.concatenate([[-1], edge, [len(low) - 1]])) - 1
    if min(2 * len(low), 4 * len(start)) >= 8192:
        bits = np.zeros(65536, bool)
        bits[low] = True
        return b"\x02" + np.packbits(bits, bitorder="little").tobytes()
    if 4 * len(start) < 2 * len(low):
        return b"\x01" + start.astype("<u2").tobytes() + size.astype("<u2").tobytes()
    return b"\x00" + low.astype("<u2").tobytes()


def unpack_ids(body: bytes) -> np.ndarray:
    kind, rest = body[0], body[1:]
    if kind == 2:
        return np.flatnonzero(np.unpackbits(np.frombuffer(rest, np.uint8), bitorder="little"))
    a = np.frombuffer(rest, "<u2").astype(np.int64)
    if kind == 0:
        return a
    start, size = a[:len(a) // 2], a[len(a) // 2:] + 1
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, key, n) rows to one bitmap per group and high bits of the keys in this task."""
    def flush():
        rows = []
        for (g, place), parts in held.items():
            low, at = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
            n = np.bincount(at, np.concatenate([y for _, y in parts])).astype(np.int64)
            many = n > 1
            rows.append((g, place, pack_ids(low), low[many].astype("<u2").tobytes(),
                         (n[many] - 1).astype("<i8").tobytes()))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows), (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
            names=["g", "place", "body", "low", "more"])

    held: dict = {}
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(0).dictionary_encode()
        code, names = np.asarray(group.indices), group.dictionary.to_pylist()
        key, n = (np.asarray(batch.column(k)).astype(np.int64) for k in (1, 2))
        place = key >> 16
        order = np.lexsort((place, code))
        edge = np.flatnonzero((np.diff(code[order]) != 0) | (np.diff(place[order]) != 0)) + 1
        for rows in np.split(order, edge):
            held.setdefault((names[code[rows[0]]], int(place[rows[0]])), []).append(
                ((key[rows] & 0xFFFF).astype(np.uint16), n[rows]))
        size += len(key)
        if size >= HELD_IDS:
            yield flush()
            size = 0
    if held:
        yield flush()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps in order of (g, place) to their non-empty words of 64 ids with counts before each."""
    def done(key, n):
        low = np.flatnonzero(n)
        word, first = np.unique(low >> 6, return_index=True)
        bits = np.bitwise_or.reduceat(np.left_shift(np.uint64(1), (low & 63).astype(np.uint64)), first).view(np.int64)
        total = np.cumsum(n)
        before = np.concatenate([[0], total[(word << 6) - 1][word > 0]]) if word[0] == 0 else total[(word << 6) - 1]
        many = low[n[low] > 1]
        reps: dict = {}
        for x in many.tolist():
            reps.setdefault(x >> 6, []).append({"bit": x & 63, "more": int(n[x]) - 1})
        k = len(word)
        return pa.RecordBatch.from_arrays([
            pa.array([key[0]] * k, pa.string()), pa.array([key[1]] * k, pa.int64()),
            pa.array((key[1] << 10) + word), pa.array(bits), pa.array(before.astype(np.int64)),
            pa.array([reps.get(x) for x in word.tolist()],
                     pa.list_(pa.struct([("bit", pa.int32()), ("more", pa.int64())]))),
            pa.array([int(total[-1])] * k, pa.int64())],
            names=["g", "place", "word", "bits", "before", "reps", "total"])

    key = n = None
    for batch in batches:
        for g, place, body, low, more in zip(*(c.to_pylist() for c in batch.columns)):
            if (g, place) != key:
                if key is not None:
                    yield done(key, n)
                key, n = (g, place), np.zeros(65536, np.int64)
            n[unpack_ids(body)] += 1
            n[np.frombuffer(low, "<u2")] += np.frombuffer(more, "<i8")
    if key is not None:
        yield done(key, n)


def rank_directory(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, word, bits, base, reps) of the keys in (g string, key long, n long) rows, ``base`` counting the
    rows of g with keys before the word; and the written words it reads, to release."""
    partial = rows.select("g", "key", "n").mapInArrow(_partial, PARTIAL)
    words = written(partial.repartition("g", "place").sortWithinPartitions("g", "place").mapInArrow(_merge, WORDS),
                    "manifest-words")
    level = words.filter("before = 0").select("g", "place", "total")
    base = level.select("g", "place", F.lit(0).cast("long").alias("base"))
    for depth in range(3):  # sums over siblings of 16 high bits each: at most 65,536 a parent
        here, up = f"(place >> {16 * depth})", f"(place >> {16 * (depth + 1)})"
        nodes = level.groupBy("g", F.expr(here).alias("at")).agg(F.sum("total").alias("total")) if depth else (
            level.select("g", F.col("place").alias("at"), "total"))
        parent = F.expr("at >> 16") if depth < 2 else F.lit(0)  # the highest 16 bits, sign and all, have one parent
        order = Window.partitionBy("g", parent).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        sums = nodes.select("g", "at", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("sum"))
        base = (base.withColumn("at", F.expr(here)).join(sums, ["g", "at"])
                .select("g", "place", (F.col("base") + F.col("sum")).alias("base")))
    return words.join(base, ["g", "place"]).select(
        "g", "word", "bits", (F.col("base") + F.col("before")).alias("base"), "reps"), words


def rank_of(rows: DataFrame, directory: DataFrame) -> DataFrame:
    """``rows`` (with g, key) and their ``rank`` (rows of g with smaller keys) and ``shared`` (key stands on several)."""
    met = rows.withColumn("word", F.expr("key >> 6")).join(directory.hint("shuffle_hash"), ["g", "word"])
    bit = F.expr("cast(key & 63 as int)")
    below = F.expr("bit_count(bits & ~shiftleft(-1L, cast(key & 63 as int)))")
    more = F.coalesce(F.aggregate(F.filter("reps", lambda r: r["bit"] < bit), F.lit(0).cast("long"),
                                  lambda a, r: a + r["more"]), F.lit(0))
    return met.select(*rows.columns, (F.col("base") + below + more).alias("rank"),
                      F.coalesce(F.exists("reps", lambda r: r["bit"] == bit), F.lit(False)).alias("shared"))


# --- leaves and their coordinates -------------------------------------------------------

def field_text(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(
        F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")))


def digest(parts: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def leaf_rows(docs: DataFrame, fields=FIELDS, group: str = "source", changed: dict[str, Column] | None = None,
              where: Column | None = None) -> DataFrame:
    """(skey, doc_id, leaf, forged): the leaf digest of each row, and the one after ``changed`` fields where ``where``."""
    plain = {c: field_text(F.col(c)) for c in fields}
    forged = {**plain, **{c: field_text(v) for c, v in (changed or {}).items()}}
    leaf = digest(list(plain.values()))
    tampered = F.when(F.coalesce(where, F.lit(False)), digest(list(forged.values()))) if changed else F.lit(None)
    return docs.select(F.coalesce(F.concat(F.lit("s"), F.col(group)), F.lit("")).alias("skey"),
                       F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("leaf"),
                       tampered.cast("binary").alias("forged"))


def _shared_rows(rows: DataFrame) -> DataFrame:
    """(skey, coord, doc_id, leaf, forged) of rows that share an id or have none; ``first`` is their id's rank."""
    counted = written(rows.groupBy("skey", "doc_id", "leaf", "forged").agg(
        F.count(F.lit(1)).alias("n"), F.min("first").alias("first")), "manifest-shared")
    # Rows of one id, by the first bits of their digest; rows without an id of one group likewise.
    keyed = counted.withColumn("g", F.concat(F.coalesce(F.concat(F.col("doc_id").cast("string"), F.lit("/")),
                                                        F.lit("/")), "skey")) \
        .withColumn("key", F.conv(F.substring(F.hex("leaf"), 1, 15), 16, 10).cast("long"))
    directory, words = rank_directory(keyed)
    # Digests that differ only after those bits: hardly ever more than one a key.
    order = Window.partitionBy("g", "key").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    placed = (rank_of(keyed.withColumn("skip", F.coalesce(F.sum("n").over(order), F.lit(0))), directory)
              .withColumn("coord", F.col("first") + F.col("rank") + F.col("skip")))
    blocks = placed.withColumn("block", F.explode(F.expr(f"sequence(0L, (n - 1) div {BLOCK_ROWS})"))) \
        .repartition("skey", "coord", "block")
    each = F.explode(F.expr(f"sequence(block * {BLOCK_ROWS}, least(n, (block + 1) * {BLOCK_ROWS}) - 1)"))
    return blocks.withColumn("nth", each).select(
        "skey", (F.col("coord") + F.col("nth")).alias("coord"), "doc_id", "leaf", "forged")


def coordinates(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((skey, coord, doc_id, leaf, forged), (skey, total)): each leaf's place among its group's leaves."""
    without = leaves.groupBy("skey").agg(F.count(F.lit(1)).alias("total"),
                                         F.count(F.when(F.col("doc_id").isNull(), 1)).alias("nulls"))
    totals = written(without, "manifest-totals")
    rows = leaves.filter("doc_id is not null").select(
        F.col("skey").alias("g"), F.col("doc_id").alias("key"), F.lit(1).cast("long").alias("n"), "leaf", "forged")
    directory, words = rank_directory(rows)
    ranked = rank_of(rows.drop("n"), directory).join(
        totals.select(F.col("skey").alias("g"), "nulls"), "g")
    ranked = written(ranked.select(F.col("g").alias("skey"), (F.col("rank") + F.col("nulls")).alias("coord"),
                                   F.col("key").alias("doc_id"), "leaf", "forged", "shared"), "manifest-ranked")
    release(words)
    placed = ranked.filter("not shared").drop("shared")
    if totals.filter("nulls > 0").limit(1).count() or ranked.filter("shared").limit(1).count():
        several = ranked.filter("shared").select("skey", "doc_id", "leaf", "forged", F.col("coord").alias("first"))
        unnamed = leaves.filter("doc_id is null").select("skey", "doc_id", "leaf", "forged",
                                                         F.lit(0).cast("long").alias("first"))
        placed = placed.union(_shared_rows(several.union(unnamed)))
    return placed, totals.select("skey", "total")


# --- slot arrays and levels -------------------------------------------------------------

def _levels(total: int) -> int:
    n = 0
    while total > 1:
        total, n = -(-total >> FAN_BITS), n + 1
    return min(n, ROUND_LEVELS)


def lift(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes (hex text) and the levels above them; the last run of a level may be short."""
    out, fan = [nodes], 1 << FAN_BITS
    for _ in range(levels):
        low = out[-1]
        out.append([hashlib.sha256(b"".join(low[k:k + fan])).hexdigest().encode() for k in range(0, len(low), fan)])
    return out


def siblings(tree: list[list[bytes]], k: int) -> list[tuple[bytes, bytes]]:
    """(nodes before, nodes after) in the run of node k and of each of its ancestors below the top."""
    out, fan = [], 1 << FAN_BITS
    for level in tree[:-1]:
        start = k - k % fan
        out.append((b"".join(level[start:k]), b"".join(level[k + 1:start + fan])))
        k >>= FAN_BITS
    return out


def pack_path(path: list[tuple[bytes, bytes]]) -> bytes:
    return b"".join(bytes([len(a) // 64, len(b) // 64]) + bytes.fromhex((a + b).decode()) for a, b in path)


def unpack_path(body: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(body):
        a, b = body[at], body[at + 1]
        text = body[at + 2:at + 2 + 32 * (a + b)].hex().encode()
        out.append((text[:64 * a], text[64 * a:]))
        at += 2 + 32 * (a + b)
    return out


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(g, sub, columns) of rows that come grouped by their first two columns."""
    held: list = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        g, sub = batch.column(0).dictionary_encode(), np.asarray(batch.column(1))
        names, code = g.dictionary.to_pylist(), np.asarray(g.indices)
        edge = (np.flatnonzero((np.diff(code) != 0) | (np.diff(sub) != 0)) + 1).tolist()
        for a, b in zip([0, *edge], [*edge, batch.num_rows]):
            here = (names[code[a]], int(sub[a]))
            if here != key:
                if held:
                    yield (*key, pa.Table.from_batches(held).combine_chunks())
                key, held = here, []
            held.append(batch.slice(a, b - a))
    if held:
        yield (*key, pa.Table.from_batches(held).combine_chunks())


def _slots(table: pa.Table, idx: str, column: str) -> list:
    at = np.asarray(table[idx]) & ((1 << FAN_BITS * ROUND_LEVELS) - 1)
    out: list = [None] * len(at)
    for k, v in zip(at.tolist(), table[column].to_pylist()):
        out[k] = v
    return out


def _pack_leaves(batches):
    for g, sub, t in _arrays(batches):
        total = t["total"][0].as_py()
        ids, leaves, forged = (_slots(t, "coord", c) for c in ("doc_id", "leaf", "forged"))
        top = lift([x.hex().encode() for x in leaves], _levels(total))[-1][0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([g]), pa.array([sub], pa.int64()), pa.array([total], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
             pa.array([b"".join(leaves)], pa.binary()), pa.array([forged], pa.list_(pa.binary())),
             pa.array([bytes.fromhex(top.decode())], pa.binary())],
            names=["g", "sub", "total", "ids", "leaves", "forged", "digest"])


def _pack_nodes(batches):
    for g, sub, t in _arrays(batches):
        total = t["total"][0].as_py()
        tree = lift([x.hex().encode() for x in _slots(t, "idx", "digest")], _levels(total))
        paths = [{"idx": (sub << FAN_BITS * ROUND_LEVELS) + k, "path": pack_path(siblings(tree, k))}
                 for k in range(len(tree[0]))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([g]), pa.array([sub], pa.int64()), pa.array([total], pa.int64()),
             pa.array([paths], pa.list_(pa.struct([("idx", pa.int64()), ("path", pa.binary())]))),
             pa.array([bytes.fromhex(tree[-1][0].decode())], pa.binary())],
            names=["g", "sub", "total", "paths", "digest"])


def _above(packed: DataFrame) -> DataFrame:
    """(g, idx, total, digest): the nodes that slot arrays leave, one each."""
    width = FAN_BITS * ROUND_LEVELS
    return packed.select("g", F.col("sub").alias("idx"),
                         F.expr(f"(total + {(1 << width) - 1}) >> {width}").alias("total"), "digest")


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((g, idx, path), (g, digest)): sibling paths of ``nodes`` (g, idx, total, digest) to their group's top, and the tops."""
    rounds = []
    while (nodes.agg(F.max("total")).first()[0] or 0) > 1:
        grouped = nodes.select("g", F.expr(f"idx >> {FAN_BITS * ROUND_LEVELS}").alias("sub"), "total", "idx", "digest") \
            .repartition("g", "sub").sortWithinPartitions("g", "sub")
        packed = written(grouped.mapInArrow(
            _pack_nodes, "g string, sub long, total long, paths array<struct<idx:long,path:binary>>, digest binary"),
            "manifest-nodes")
        rounds.append(packed)
        nodes = _above(packed)
    paths = nodes.select("g", "idx", F.lit(b"").cast("binary").alias("path"))
    for packed in reversed(rounds):
        below = packed.select("g", F.col("sub").alias("up"), F.explode("paths").alias("p")).select(
            "g", "up", F.col("p.idx").alias("idx"), F.col("p.path").alias("low"))
        paths = below.join(paths.select("g", F.col("idx").alias("up"), "path"), ["g", "up"]).select(
            "g", "idx", F.concat("low", "path").alias("path"))
    return paths, nodes.select("g", "digest")


def _prove(batches):
    def sha(*parts):
        return hashlib.sha256(b"".join(parts)).hexdigest()

    for batch in batches:
        for row in range(batch.num_rows):
            total, ids, body, forged, path, subroot, root = (
                batch.column(k)[row].as_py() for k in range(7))
            leaves = [body[k:k + 32].hex().encode() for k in range(0, len(body), 32)]
            tree, upper = lift(leaves, _levels(total)), unpack_path(path)
            out: tuple = ([], [], [])
            tail = None
            for k, leaf in enumerate(leaves):
                near = siblings(tree[:2], k) if len(tree) > 1 else []
                if tail is None or k % (1 << FAN_BITS) == 0:  # shared by the leaves of one run
                    tail = siblings(tree[1:], k >> FAN_BITS) + upper
                    rest = b"".join(a + b for a, b in tail)
                now = forged[k].hex().encode() if forged[k] is not None else leaf
                for a, b in near + tail:
                    now = sha(a, now, b).encode()
                for c, v in zip(out, (leaf.decode(), sha(*[x for ab in near for x in ab], rest), now.decode())):
                    c.append(v)
            n = len(leaves)
            subroot, root = subroot.hex(), root.hex()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(out[0]), pa.array([subroot] * n), pa.array([root] * n),
                 pa.array(out[1]), pa.array(out[2]), pa.array([x == root for x in out[2]])],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def manifest(docs: DataFrame, fields=FIELDS, group: str = "source", changed: dict[str, Column] | None = None,
             where: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs``.

    ``folded_root`` is recomputed from the row as it reads with ``changed`` fields where ``where``
    holds (else as it is) and the manifest's siblings; ``verified`` tells whether it is the root.
    """
    leaves = written(leaf_rows(docs, fields, group, changed, where), "manifest-leaves")
    placed, totals = coordinates(leaves)
    grouped = (placed.join(totals, "skey")
               .select(F.col("skey").alias("g"), F.expr(f"coord >> {FAN_BITS * ROUND_LEVELS}").alias("sub"), "total",
                       "coord", "doc_id", "leaf", "forged")
               .repartition("g", "sub").sortWithinPartitions("g", "sub"))
    packed = written(grouped.mapInArrow(_pack_leaves, "g string, sub long, total long, ids array<long>, leaves binary, "
                                                      "forged array<binary>, digest binary"), "manifest-slots")
    release(leaves)
    paths, subroots = climb(_above(packed))
    subroots = written(subroots.select(F.col("g").alias("skey"), "digest"), "manifest-subroots")
    named = written(sequence_numbers(subroots, ["skey"]), "manifest-order")
    tops = named.select(F.lit("").alias("g"), (F.col("seq") - 1).alias("idx"),
                        F.lit(named.count()).cast("long").alias("total"), "digest")
    root_paths, top = climb(tops)
    root = top.select("digest").first()  # one digest, none of an empty table
    groups = (named.select("skey", (F.col("seq") - 1).alias("idx"), F.col("digest").alias("subroot"))
              .join(root_paths.select("idx", F.col("path").alias("last")), "idx")
              .withColumn("root", F.lit(bytes(root[0]) if root else None).cast("binary")))
    whole = (paths.withColumnRenamed("g", "skey").join(groups.drop("idx"), "skey")
             .select(F.col("skey").alias("g"), F.col("idx").alias("sub"), F.concat("path", "last").alias("path"),
                     "subroot", "root"))
    return packed.join(whole, ["g", "sub"]).select("total", "ids", "leaves", "forged", "path", "subroot", "root") \
        .mapInArrow(_prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                            "folded_root string, verified boolean")


LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def manifest_report(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``; every fifth document (by crc32 of its id) is tampered with: its text is lower-cased."""
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(docs, changed={"text": F.translate("text", *LOWER)}, where=fifth)


def _sql_leaf(text: str) -> str:
    def one(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    return "sha256(" + " || ".join(one(c) for c in (*FIELDS[:-1], text)) + ")"


SQL = f"""
WITH RECURSIVE crc AS {CRC_TABLE},
d AS (SELECT row_number() OVER () AS k, doc_id, coalesce('s' || source, '') AS g, {_sql_leaf('text')} AS leaf,
    CASE WHEN {crc32('doc_id::VARCHAR')} % 5 = 0 THEN {_sql_leaf(f"translate(text, '{LOWER[0]}', '{LOWER[1]}')")} END AS forged
    FROM documents, crc),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY g) AS n FROM d),
tree AS (SELECT g, 0 AS lvl, i AS idx, n, leaf AS h FROM o
    UNION ALL SELECT g, lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM tree WHERE n > 1
    GROUP BY g, lvl, idx // 16, n),
s AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
tops AS (SELECT 0 AS lvl, i AS idx, n, h FROM s
    UNION ALL SELECT lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1
    GROUP BY lvl, idx // 16, n),
near AS (SELECT o.k, string_agg(t.h, '' ORDER BY t.lvl, t.idx) AS x FROM o JOIN tree t ON t.g = o.g AND t.n > 1
    AND t.idx // 16 = o.i >> (4 * (t.lvl + 1))::INT AND t.idx <> o.i >> (4 * t.lvl)::INT GROUP BY o.k),
far AS (SELECT s.g, string_agg(t.h, '' ORDER BY t.lvl, t.idx) AS x FROM s JOIN tops t ON t.n > 1
    AND t.idx // 16 = s.i >> (4 * (t.lvl + 1))::INT AND t.idx <> s.i >> (4 * t.lvl)::INT GROUP BY s.g),
f AS (SELECT k, g, 0 AS lvl, i AS idx, n, coalesce(forged, leaf) AS h FROM o
    UNION ALL SELECT f.k, f.g, f.lvl + 1, f.idx // 16, (f.n + 15) // 16,
      sha256(string_agg(CASE WHEN t.idx = f.idx THEN f.h ELSE t.h END, '' ORDER BY t.idx))
    FROM f JOIN tree t ON t.g = f.g AND t.lvl = f.lvl AND t.idx // 16 = f.idx // 16 WHERE f.n > 1
    GROUP BY f.k, f.g, f.lvl, f.idx, f.n),
e AS (SELECT f.k, 0 AS lvl, s.i AS idx, s.n, f.h FROM f JOIN s ON s.g = f.g WHERE f.n = 1
    UNION ALL SELECT e.k, e.lvl + 1, e.idx // 16, (e.n + 15) // 16,
      sha256(string_agg(CASE WHEN t.idx = e.idx THEN e.h ELSE t.h END, '' ORDER BY t.idx))
    FROM e JOIN tops t ON t.lvl = e.lvl AND t.idx // 16 = e.idx // 16 WHERE e.n > 1 GROUP BY e.k, e.lvl, e.idx, e.n)
SELECT o.doc_id, o.leaf, s.h AS subroot, r.h AS root, sha256(coalesce(near.x, '') || coalesce(far.x, '')) AS proof_sha256,
  e.h AS folded_root, e.h = r.h AS verified
FROM o JOIN s ON s.g = o.g CROSS JOIN (SELECT h FROM tops WHERE n = 1) r JOIN e ON e.k = o.k AND e.n = 1
LEFT JOIN near ON near.k = o.k LEFT JOIN far ON far.g = o.g"""
