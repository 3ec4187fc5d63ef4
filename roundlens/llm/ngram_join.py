"""Exact Jaccard self-join on word shingles: size bands, bitmap bounds, exact sets.

1. Every document becomes a set of hashed shingles; equal sets form one class.
2. Classes meet in tiles.  With similarity s a linked pair shares one of the
   first ``n - ceil(s n) + 1`` shingles of each set under any common order, so
   those *prefix* shingles are the tile keys.  Shingles that many documents
   share are ordered last and rarely become keys; the order affects speed only.
3. Each class is first paired with the leader it meets in most tiles.  Links found
   so collapse groups of copies to components; only tiles that still hold
   several components are compared in full, split by size band.  Large ones are
   compared inside their tasks, which hold the sets and give spanning links.
4. A candidate pair must pass a bound from bitmap signatures (one bit per
   hashed shingle): a bit of x that y lacks proves a shingle of x outside y, so
   ``|x & y| <= min(|x| - bits(x & ~y), |y| - bits(y & ~x))``.  Survivors are
   intersected exactly as sorted arrays.

Defined cases: null, empty and word-less texts have an empty set and link with
nothing; fewer than k words make one shingle; rows that repeat a doc_id come
out once per row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .spread import components, release, written
from .text import chunks, mix, shingle_hashes

FREQUENT = 8            # a shingle occurring so often is ordered after the others (an order only)
FREQUENT_BITS = 1 << 24  # bits of the bitmap that marks such shingles (2 MB)
COMMON_LIST = 100_000   # most frequent shingles, ordered last by count
SALT_ROWS = 200_000     # a key expected in more documents than this is dealt over several buckets
STAR_ROUNDS = 2
SMALL_TILE = 16
TILE_ROWS = 2048        # members of one all-against-all tile
CELL_ITEMS = 1 << 20    # shingles of the sets that one cell of a tile's grid compares, about
SIG_BITS_PER_ITEM = 2

_U64 = np.uint64
_NAME = _U64(16)  # the name of a shingle is its hash without so many low bits


class Frequent:
    """Which shingles are frequent, by name (the upper 48 bits of the hash).

    ``marks`` is a bitmap of ``FREQUENT_BITS`` bits that marks every shingle occurring
    ``FREQUENT`` times or more (and, as it fills, some others); ``names`` and ``counts``
    hold the ``COMMON_LIST`` most frequent ones.  Both sizes are fixed.
    """

    def __init__(self, marks: np.ndarray, names: np.ndarray, counts: np.ndarray):
        self.marks, self.names, self.counts = marks, names, counts

    def marked(self, h: np.ndarray) -> np.ndarray:
        at = (h >> _NAME) & _U64(FREQUENT_BITS - 1)
        return (self.marks[(at >> _U64(6)).astype(np.int64)] >> (at & _U64(63)) & _U64(1)).astype(bool)

    def count(self, h: np.ndarray) -> np.ndarray:
        """Occurrences of listed shingles, 0 for others."""
        if not len(self.names):
            return np.zeros(len(h), np.int64)
        name = h >> _NAME
        at = np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)
        return np.where(self.names[at] == name, self.counts[at], 0)

    def prefix(self, s: np.ndarray, take: int) -> np.ndarray:
        """First ``take`` shingles of the sorted set ``s``: infrequent, frequent, listed by count; then by hash."""
        marked = self.marked(s)
        rare = s[~marked]
        if len(rare) < take:
            rest = s[marked]
            rare = np.concatenate([rare, rest[np.lexsort((rest, self.count(rest)))]])
        return rare[:take]


def _frequent_shingles(docs: DataFrame, k: int, buckets: int) -> Frequent:
    """Count all shingles: distinct names of a chunk with their counts meet in ranges of names."""
    limits = np.array([j * (2**64 // buckets) for j in range(1, buckets)], _U64)
    low = _U64((1 << 16) - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            h, _ = shingle_hashes(c, k)
            h = np.sort(h & ~low)
            edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]])) if len(h) else np.zeros(1, int)
            h = h[edge[:-1]] | np.minimum(np.diff(edge), int(low)).astype(_U64)
            cut = np.concatenate([[0], np.searchsorted(h, limits), [len(h)]])
            own = np.flatnonzero(np.diff(cut))
            yield pa.record_batch({
                "bucket": pa.array(own.astype(np.int32)),
                "entries": pa.array([h[cut[j]:cut[j + 1]].tobytes() for j in own], pa.binary())})

    def total(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        e = np.sort(np.frombuffer(b"".join(parts), _U64))
        name = e >> _NAME
        edge = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        n = np.add.reduceat((e & low).astype(np.int64), edge)
        pick = n >= FREQUENT
        yield pa.record_batch({"h": pa.array(name[edge][pick].view(np.int64)), "n": pa.array(n[pick])})

    packed = docs.select("text").mapInArrow(count, "bucket int, entries binary")
    counted = written(_by_bucket(packed, total, "h long, n long"), "ngram-counts")
    at = F.col("h").bitwiseAND(F.lit(FREQUENT_BITS - 1))
    words = (counted.select(at.alias("at")).groupBy(F.expr("cast(at div 64 as int)").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("bits")).toPandas())
    top = counted.orderBy(F.desc("n"), "h").limit(COMMON_LIST).toPandas()
    release(counted)
    marks = np.zeros(FREQUENT_BITS // 64, _U64)
    marks[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(_U64)
    names = top["h"].to_numpy(np.int64).view(_U64)
    order = np.argsort(names)
    return Frequent(marks, names[order], top["n"].to_numpy(np.int64)[order])


def _by_bucket(packed: DataFrame, group, schema: str) -> DataFrame:
    """Bring the packed ``entries`` of each bucket together and apply ``group`` to their list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for b, e in zip(batch.column(0).to_pylist(), batch.column(1)):
                if b != now:
                    if parts:
                        yield from group(parts)
                    now, parts = b, []
                parts.append(e.as_py())
        if parts:
            yield from group(parts)

    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _sig_bits(n: int) -> int:
    """Signature width of a size band: the next power of two above 2 n, at least 64."""
    return max(64, 1 << int(np.ceil(np.log2(max(1, SIG_BITS_PER_ITEM * n)))))


def _signature(h: np.ndarray, bits: int) -> bytes:
    out = np.zeros(bits, np.uint8)
    out[(h >> _U64(20)).astype(np.int64) & (bits - 1)] = 1
    return np.packbits(out).tobytes()


def fold(sig: np.ndarray, n_bytes: int) -> np.ndarray:
    """Halve packed signatures (rows) to ``n_bytes`` each; bit position is hash mod width."""
    while sig.shape[-1] > n_bytes:
        half = sig.shape[-1] // 2
        sig = sig[..., :half] | sig[..., half:]
    return sig


def overlap_bound(sx: np.ndarray, nx, sy: np.ndarray, ny):
    """Upper bound of the intersection size from two signatures of equal width."""
    only_x = np.bitwise_count(sx & ~sy).sum(-1, dtype=np.int64)
    only_y = np.bitwise_count(sy & ~sx).sum(-1, dtype=np.int64)
    return np.minimum(nx - only_x, ny - only_y)


def _linked(inter, nx, ny, pct: int):
    return 100 * inter >= pct * (nx + ny - inter)


def _shape_docs(docs: DataFrame, k: int, pct: int, common: Frequent, buckets: int) -> DataFrame:
    """Per document its set size, set hash and signature; per chunk and bucket the packed prefix entries."""

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            h, first = shingle_hashes(c, k)
            ids = c.rows.column(0)
            n_docs = len(ids)
            size, cls, sigs = np.zeros(n_docs, np.int64), np.zeros(n_docs, _U64), []
            keys, key_cls, key_n = [], [], []
            seen = set()
            for i in range(n_docs):
                s = np.unique(h[first[i]:first[i + 1]])
                n = len(s)
                size[i] = n
                if not n:
                    sigs.append(None)
                    continue
                cls[i] = _set_hash(s)
                sigs.append(_signature(s, _sig_bits(n)))
                if cls[i] in seen:  # an equal set of this chunk has given its entries
                    continue
                seen.add(cls[i])
                take = n - -(-n * pct // 100) + 1
                keys.append(common.prefix(s, take))
                key_cls.append(np.full(take, cls[i], _U64))
                key_n.append(np.full(take, n, np.int32))
            doc = pa.record_batch({
                "doc_id": ids, "n": pa.array(size), "cls": pa.array(cls.view(np.int64)),
                "sig": pa.array(sigs, pa.binary()), "bucket": pa.nulls(n_docs, pa.int32()),
                "entries": pa.nulls(n_docs, pa.binary())})
            yield doc
            if keys:
                e = np.empty(sum(map(len, keys)), _ENTRY)
                e["key"], e["cls"], e["n"] = np.concatenate(keys), np.concatenate(key_cls), np.concatenate(key_n)
                salts = _salts(e["key"], common)
                b = (mix(e["key"] + e["cls"] % salts) % _U64(buckets)).astype(np.int32)
                order = np.argsort(b, kind="stable")
                e, b = e[order], b[order]
                edge = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]]))
                m = len(edge) - 1
                yield pa.record_batch({
                    "doc_id": pa.nulls(m, pa.int64()), "n": pa.nulls(m, pa.int64()),
                    "cls": pa.nulls(m, pa.int64()), "sig": pa.nulls(m, pa.binary()),
                    "bucket": pa.array(b[edge[:-1]]),
                    "entries": pa.array([e[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:])], pa.binary())})

    schema = "doc_id long, n long, cls long, sig binary, bucket int, entries binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(shape, schema)


_ENTRY = np.dtype([("key", "<u8"), ("cls", "<u8"), ("n", "<i4")])


def _salts(key: np.ndarray, common: Frequent) -> np.ndarray:
    """Buckets over which each key is dealt: one, or more for a very common key."""
    return np.maximum(-(-common.count(key) // SALT_ROWS), 1).astype(_U64)


def _set_hash(s: np.ndarray) -> np.uint64:
    """Order-free 64-bit hash of a set of 64-bit hashes."""
    with np.errstate(over="ignore"):
        return mix(np.array([mix(s + _U64(0x5851F42D4C957F2D)).sum(dtype=_U64) + _U64(len(s))]))[0]


def _shared_keys(rows: DataFrame, common: Frequent) -> DataFrame:
    """(key, cls, n) of prefix keys that two or more classes hold, from the packed buckets."""

    def group(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        e = np.frombuffer(b"".join(parts), _ENTRY)
        e = e[np.lexsort((e["cls"], e["key"]))]
        e = e[np.concatenate([[True], (e["key"][1:] != e["key"][:-1]) | (e["cls"][1:] != e["cls"][:-1])])]
        edge = np.flatnonzero(np.concatenate([[True], e["key"][1:] != e["key"][:-1], [True]]))
        # A salted key may have its other classes in other buckets: all its entries stay.
        e = e[np.repeat((np.diff(edge) > 1) | (_salts(e["key"][edge[:-1]], common) > 1), np.diff(edge))]
        for lo in range(0, len(e), 1 << 16):
            p = e[lo:lo + (1 << 16)]
            yield pa.record_batch({"key": pa.array(p["key"].copy().view(np.int64)),
                                   "cls": pa.array(p["cls"].copy().view(np.int64)),
                                   "n": pa.array(p["n"].astype(np.int64))})

    packed = rows.filter("entries is not null").select("bucket", "entries")
    return _by_bucket(packed, group, "key long, cls long, n long")


def _pairs_within_bound(pairs: DataFrame, sigs: DataFrame, pct: int) -> DataFrame:
    """Candidate pairs (a, b) whose sizes and signatures allow a link."""

    @arrow_udf(T.BooleanType())
    def may_link(na: pa.Array, sa: pa.Array, nb: pa.Array, sb: pa.Array) -> pa.Array:
        out = []
        for x, sx, y, sy in zip(na.to_pylist(), sa, nb.to_pylist(), sb):
            u, v = np.frombuffer(sx.as_py(), np.uint8), np.frombuffer(sy.as_py(), np.uint8)
            w = min(len(u), len(v))
            out.append(bool(_linked(overlap_bound(fold(u, w), x, fold(v, w), y), x, y, pct)))
        return pa.array(out, pa.bool_())

    a = sigs.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    b = sigs.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    return (pairs.join(a, "a").join(b, "b")
            .filter(100 * F.least("na", "nb") >= pct * F.greatest("na", "nb"))
            .filter(may_link("na", "sa", "nb", "sb")).select("a", "b", "na", "nb"))


def _sets(docs: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """(cls, items): the sorted shingle array of the class of each document named in ``first``, read again."""

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            h, first = shingle_hashes(c, k)
            sets = [np.unique(h[first[i]:first[i + 1]]) for i in range(len(c.valid))]
            keep = [i for i, s in enumerate(sets) if len(s)]
            yield pa.record_batch({
                "cls": pa.array([_set_hash(sets[i]) for i in keep], pa.uint64()).view(pa.int64()),
                "items": pa.array([sets[i].tobytes() for i in keep], pa.binary())})

    return (docs.select(F.col("doc_id").cast("long"), "text").join(first, "doc_id")
            .select("text").mapInArrow(items, "cls long, items binary")
            .groupBy("cls").agg(F.first("items").alias("items")))


def _shared(u: np.ndarray, v: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(u) > len(v):
        u, v = v, u
    at = np.minimum(np.searchsorted(v, u), len(v) - 1)
    return int((v[at] == u).sum())


def _verified(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """Pairs whose sets really meet the threshold: merge of the sorted arrays."""

    @arrow_udf(T.BooleanType())
    def meets(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for p, q in zip(x, y):
            u, v = np.frombuffer(p.as_py(), _U64), np.frombuffer(q.as_py(), _U64)
            out.append(bool(_linked(_shared(u, v), len(u), len(v), pct)))
        return pa.array(out, pa.bool_())

    return (pairs.select("a", "b").join(sets.select(F.col("cls").alias("b"), F.col("items").alias("y")), "b")
            .join(sets.select(F.col("cls").alias("a"), F.col("items").alias("x")), "a")
            .filter(meets("x", "y")).select("a", "b"))


def _banded(rows: DataFrame, pct: int) -> DataFrame:
    """Each row in its own size band and in the next, so sets of compatible size share a band."""
    band = F.floor(F.log("n") / F.lit(float(np.log(100.0 / pct))) + F.lit(1e-9)).cast("int")
    return (rows.withColumn("band", F.explode(F.array(band, band + 1)))
            .withColumn("own", F.col("band") == band))


def _mixed(tiles: DataFrame, comp: DataFrame) -> DataFrame:
    """(key, cls, n, comp) of the tiles that hold more than one component.

    Components only ever merge, so the tiles mixed in one turn contain those of the next.
    """
    member = (tiles.select("key", "cls", "n").join(comp.withColumnRenamed("node", "cls"), "cls", "left")
              .withColumn("comp", F.coalesce("comp", "cls")))
    several = (member.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
               .filter("c0 <> c1").select("key"))
    return member.join(several, "key").select("key", "cls", "n", "comp")


def _stars(member: DataFrame, pct: int, turn: int) -> DataFrame:
    """One candidate pair per class: the leader of another component that it meets in most tiles.

    The leader of a tile is the class with the smallest hash, another one each turn.
    """
    rows = _banded(member, pct)
    lead = rows.filter("own").groupBy("key", "band").agg(
        F.min(F.struct(F.xxhash64("cls", F.lit(turn)).alias("h"), "cls", "comp", "n")).alias("lead"))
    met = (rows.join(lead, ["key", "band"]).filter(F.col("comp") != F.col("lead.comp"))
           .filter(100 * F.least("n", "lead.n") >= pct * F.greatest("n", "lead.n"))
           .groupBy("cls", F.col("lead.cls").alias("a")).agg(F.count("*").alias("m")))
    best = met.groupBy("cls").agg(F.max_by("a", F.struct("m", "a")).alias("a"))
    return best.select(F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b")).distinct()


def _check(docs: DataFrame, classes: DataFrame, pairs: DataFrame, known: list[DataFrame], k: int, pct: int,
           bounded: bool = False) -> DataFrame:
    """The candidate pairs that link: bitmap bound (unless already applied), then exact sets.

    ``known`` holds the sets read so far; those of classes met for the first time are added to it.
    """
    if not bounded:
        pairs = _pairs_within_bound(pairs, classes, pct)
    pairs = written(pairs.select("a", "b"), "ngram-pairs")
    names = written(pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct(),
                    "ngram-names")  # read in the plan once for every table of known sets
    sets = _sets_of(docs, classes, names, known, k)
    if sets is None:  # no pair at all
        release(names)
        return pairs
    found = written(_verified(pairs, sets, pct), "ngram-found")
    release(pairs, names)
    return found


def _sets_of(docs: DataFrame, classes: DataFrame, names: DataFrame, known: list[DataFrame], k: int) -> DataFrame | None:
    """(cls, items) of the named classes; sets met for the first time are read and added to ``known``."""
    unread = names
    if known:
        unread = names.join(reduce(DataFrame.unionAll, [sets.select("cls") for sets in known]), "cls", "left_anti")
    first = written(unread.join(classes, "cls").select("doc_id").distinct(), "ngram-unread")
    if not first.isEmpty():
        known.append(written(_sets(docs, first, k), "ngram-sets"))
    release(first)
    if not known:
        return None
    sets = reduce(DataFrame.unionAll, known)
    if len(known) > 1:  # sets of an earlier turn that are not named stay out of the shuffles
        sets = sets.join(names, "cls", "left_semi")
    return sets


def _tile_rows(residual: DataFrame, pct: int, large: bool) -> DataFrame:
    """Rows of the size-banded tiles that hold several components, with the tile size m."""
    rows = _banded(residual, pct)
    size = rows.groupBy("key", "band").agg(
        F.count("*").alias("m"), F.min("comp").alias("c0"), F.max("comp").alias("c1"),
        F.bit_xor(F.xxhash64("cls")).alias("who"), F.max("own").alias("any_own"),
        F.sum("n").alias("items")).filter("c0 <> c1 and any_own")
    # Keys of one shared passage often hold the same classes: one such tile is enough.
    size = (size.filter((F.col("m") > SMALL_TILE) if large else (F.col("m") <= SMALL_TILE))
            .groupBy("band", "m", "items", "who").agg(F.min("key").alias("key")))
    return rows.join(size.select("key", "band", "m", "items"), ["key", "band"])


def _small_tiles(residual: DataFrame, pct: int) -> DataFrame:
    """Pairs of different components inside tiles of at most ``SMALL_TILE`` classes."""
    rows = _tile_rows(residual, pct, False).select("key", "band", "cls", "n", "comp", "own")
    other = rows.select("key", "band", *[F.col(c).alias(f"{c}2") for c in ("cls", "n", "comp", "own")])
    return (rows.join(other, ["key", "band"])
            .filter("cls < cls2 and comp <> comp2 and (own or own2)")
            .filter(100 * F.least("n", "n2") >= pct * F.greatest("n", "n2"))
            .select(F.col("cls").alias("a"), F.col("cls2").alias("b")).distinct())


def _cells(rows: DataFrame, grid: Column) -> DataFrame:
    """Tile rows dealt to the cells (i, j) of a triangular ``grid``: each two rows of a tile meet in one cell."""
    return (rows.withColumn("grid", grid.cast("int"))
            .withColumn("cell", F.pmod(F.xxhash64("cls"), F.col("grid")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("grid") - 1)))
            .select("key", "band", F.least("cell", "other").alias("i"), F.greatest("cell", "other").alias("j"),
                    "cell", "own", "cls", "n", "comp"))


def _best_in_tiles(residual: DataFrame, sigs: DataFrame, pct: int) -> DataFrame:
    """For each class of a larger tile the partner of another component with the highest bitmap bound.

    ``residual`` is (key, cls, n, comp).  A tile above ``TILE_ROWS`` is cut into
    cells of a triangular grid, which bounds a task.
    """
    rows = _cells(_tile_rows(residual, pct, True), F.ceil(F.col("m") / TILE_ROWS)).join(sigs.select("cls", "sig"), "cls")

    def compare(table: pa.Table) -> pa.Table:
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        cls, n, comp = (table[c].to_numpy() for c in ("cls", "n", "comp"))
        own, cell = table["own"].to_numpy(), table["cell"].to_numpy()
        sig = _one_width([np.frombuffer(s.as_py(), np.uint8) for s in table["sig"]])
        a, b = [], []
        for x in range(len(cls)):
            y = (comp != comp[x]) & (own | own[x])
            if i != j:
                y &= cell != cell[x]
            y &= (100 * n >= pct * n[x]) & (100 * n[x] >= pct * n)
            y = np.flatnonzero(y)
            if len(y):
                bound = overlap_bound(sig[x], n[x], sig[y], n[y])
                ok = _linked(bound, n[x], n[y], pct)
                y, bound = y[ok], bound[ok]
                if len(y):
                    a.append(cls[x])
                    b.append(cls[y[np.argmax(bound / (n[x] + n[y] - bound))]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    pairs = rows.groupBy("key", "band", "i", "j").applyInArrow(compare, "a long, b long")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _one_width(raw: list[np.ndarray]) -> np.ndarray:
    """Packed signatures folded to the narrowest width, in 64-bit words where that fits."""
    width = min(map(len, raw))
    sig = np.stack([fold(r, width) for r in raw])
    return sig.view(_U64) if width % 8 == 0 else sig


def _links_in_tiles(docs: DataFrame, residual: DataFrame, classes: DataFrame, known: list[DataFrame], k: int,
                    pct: int) -> DataFrame:
    """Links that join the components still apart in larger tiles.

    The sorted sets travel to the cells, which check every pair of different
    components whose bitmaps allow a link, and note a found link by joining the
    two components at once.  A cell gives a spanning forest: fewer links than rows.
    """
    rows = written(_tile_rows(residual, pct, True), "ngram-large")
    sets = _sets_of(docs, classes, rows.select("cls").distinct(), known, k)
    if sets is None:  # no such tile
        return rows.select(F.col("cls").alias("a"), F.col("cls").alias("b"))
    grid = F.greatest(F.ceil(F.col("m") / TILE_ROWS), F.ceil(F.col("items") / CELL_ITEMS))

    def link(table: pa.Table) -> pa.Table:
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        cls, n = table["cls"].to_numpy(), table["n"].to_numpy()
        own, cell = table["own"].to_numpy(), table["cell"].to_numpy()
        comp = np.unique(table["comp"].to_numpy(), return_inverse=True)[1]
        items = [np.frombuffer(x.as_py(), _U64) for x in table["items"]]
        sig = _one_width([np.frombuffer(_signature(x, _sig_bits(len(x))), np.uint8) for x in items])
        a, b = [], []
        for x in range(len(cls)):
            y = (comp != comp[x]) & (own | own[x])
            y[:x] = False
            if i != j:
                y &= cell != cell[x]
            y = np.flatnonzero(y & (100 * n >= pct * n[x]) & (100 * n[x] >= pct * n))
            if not len(y):
                continue
            bound = overlap_bound(sig[x], n[x], sig[y], n[y])
            for z in y[_linked(bound, n[x], n[y], pct)].tolist():
                if comp[z] != comp[x] and _linked(_shared(items[x], items[z]), n[x], n[z], pct):
                    comp[comp == comp[z]] = comp[x]
                    a.append(cls[x])
                    b.append(cls[z])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    cells = _cells(rows, grid).join(sets, "cls").groupBy("key", "band", "i", "j").applyInArrow(link, "a long, b long")
    found = written(cells.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "ngram-found")
    release(rows)
    return found


def jaccard_components(docs: DataFrame, k: int = 5, pct: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    Two documents link when their k-word shingle sets meet ``pct`` percent
    Jaccard similarity; component_id is the smallest doc_id reachable by links.
    """
    spark = docs.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")) * 2, 32)
    common = _frequent_shingles(docs, k, 4 * buckets)
    shaped = written(_shape_docs(docs, k, pct, common, buckets), "ngram-shaped")
    per_doc = written(shaped.filter("entries is null").select("doc_id", "n", "cls"), "ngram-docs")
    classes = written(shaped.filter("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "ngram-classes")
    member = written(_shared_keys(shaped, common).withColumn("comp", F.col("cls")), "ngram-keys")
    release(shaped)
    known: list[DataFrame] = []
    comp = None
    n_links = 0

    def join_up(found: DataFrame) -> None:
        """Components of the links so far: a component found before enters as a star, not by its links."""
        nonlocal comp
        stars = comp
        if stars is not None:
            found = found.union(stars.filter("node <> comp").select("node", "comp"))
        comp = components(found, "ngram-comp")
        release(stars)

    def merge(found: DataFrame, new: int) -> None:
        nonlocal member, n_links
        n_links += new
        join_up(found)
        release(found)
        tiles, member = member, written(_mixed(member, comp), "ngram-residual")
        release(tiles)

    # Star rounds: each class against a leader of its tiles, links merged to components.
    for turn in range(STAR_ROUNDS):
        found = _check(docs, classes, _stars(member, pct, turn), known, k, pct)
        merge(found, found.count())

    # What still lies in one tile but in several components is compared in full: small
    # tiles pair by pair; large ones first by each class's best candidate, again and
    # again while that finds links, so that few pairs are left for the full comparison.
    found = _check(docs, classes, _small_tiles(member, pct), known, k, pct)
    merge(found, found.count())
    while True:
        found = _check(docs, classes, _best_in_tiles(member, classes, pct), known, k, pct, True)
        new = found.count()
        if new:
            merge(found, new)
        else:
            release(found)
        if 20 * new <= n_links:  # the full comparison below finds the rest
            break
    last = _links_in_tiles(docs, member, classes, known, k, pct)
    join_up(last)
    release(last, member, classes, *known)

    # Components take the name of their smallest document.
    named = (per_doc.filter("n > 0").join(comp.withColumnRenamed("node", "cls"), "cls", "left")
             .withColumn("comp", F.coalesce("comp", "cls")))
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, "comp").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.union(per_doc.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS h FROM s),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS i
      FROM e x JOIN e y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o WHERE 100 * i >= 80 * (na + nb - i)),
c AS (SELECT doc_id AS a, doc_id AS r FROM s UNION SELECT c.a, l.b FROM c JOIN l ON c.r = l.a)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, min(c.r) AS component_id
FROM s JOIN c ON c.a = s.doc_id GROUP BY s.doc_id, sh"""
