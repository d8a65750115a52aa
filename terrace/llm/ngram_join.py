"""N-gram Jaccard self-join by signature trees (operator 2).

A document's set is its distinct 5-word shingles; documents link where
100 * intersection >= 75 * union, and a component's id is its least doc_id.

1. Equal sets become one class (their copies link at once).
2. Shingles that occur in one class alone cannot be common to two.  A map
   pass packs the shingles of a chunk of classes by hash range (about six
   bytes each); a task per range counts them and gives back to each chunk
   those that occur more than once.  A class with more than n - ceil(0.75 n)
   shingles of its own links with nothing and goes no further.
3. Of the rest, classes that could link share one of their first
   n - ceil(0.75 n) + 1 shingles in a fixed order (rarest first, frequent
   ones last); classes that share such a shingle fall into one cluster, and
   no link crosses clusters.
4. Per cluster, classes are packed into blocks of about ``BLOCK``; a block
   is a signature tree: leaves hold one class, nodes hold the OR of their
   token bitmaps, their size range and the greatest count of tokens that
   share a bit.  A dual traversal drops node pairs whose sizes cannot reach
   the similarity, or whose greatest possible overlap - common bits plus
   shared-bit tokens - is below what the smallest sizes need.  Surviving
   leaf pairs are checked on their shingles, unless already connected.
5. Clusters of several blocks are packed anew with large components in
   blocks of their own, and every block pair that is not within one
   component and whose size ranges meet is traversed the same way.

Only connections are made, never all pairs of a group; a group of near
copies costs its traversals, which stop at what is connected.  Frequent
shingles - those counted often within some chunk of a task, over all rows,
the ``HEAVY`` most frequent - are broadcast and skip the count in 2, so no
range gathers a shingle that a large share of all rows hold; they come last
in the order.  Set sizes are exact; two shingles are told apart by 48 bits of
their hashes (a chance of about 1e-9 for one wrong shingle in a pair of
ordinary documents).

Defined cases: null and empty texts and texts without words have an empty
set, link with nothing and are their own component; a null doc_id never
names a component that has another; rows repeating a doc_id are separate
rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.llm.common import prepare, repacked, stored, table
from terrace.llm.components import components
from terrace.llm.shingles import shingle_sets

HEAVY = 1 << 16             # frequent shingles broadcast (8 bytes each)
CHUNK = 1 << 22             # shingles counted at a time
TOKEN_BITS = 48             # of a shingle's hash, where classes are compared
LEAST_COUNT = 16            # of a shingle in a chunk, to be called frequent
BLOCK = 512                 # classes of a block
FAN = 8                     # children of a tree node


def least_overlap(n: np.ndarray) -> np.ndarray:
    """Shingles a set of n must share with any set that links with it."""
    return (3 * n + 3) // 4


def _bounds(rows: np.ndarray, n_rows: int) -> np.ndarray:
    return np.searchsorted(rows, np.arange(n_rows + 1))


def _key(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def described(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, key, n) of every document, and (token, seen) of frequent shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def frequent() -> pa.RecordBatch:
            tokens, seen = np.unique(np.concatenate(held), return_counts=True)
            often = seen >= LEAST_COUNT
            none = pa.nulls(int(often.sum()), b.schema.field(0).type)
            return pa.RecordBatch.from_arrays(
                [none, pa.nulls(len(none), pa.binary()), pa.nulls(len(none), pa.int64()),
                 pa.array(tokens[often].view(np.int64)), pa.array(seen[often])], names)

        names = ["doc_id", "key", "n", "token", "seen"]
        for b in batches:
            s, rows = shingle_sets(b.column(1))
            at = _bounds(rows, b.num_rows)
            keys = [_key(s[lo:hi]) for lo, hi in zip(at[:-1], at[1:])]
            no = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(np.diff(at)), no, no], names)
            held.append(s)
            size += len(s)
            if size >= CHUNK:
                yield frequent()
                held, size = [], 0
        if size:
            yield frequent()

    src = docs.select("doc_id", "text")
    out = StructType([src.schema["doc_id"], *StructType.fromDDL("key binary, n long, token long, seen long").fields])
    return src.mapInArrow(run, out)


# ------------------------------------------------- shingles that classes share
def packed(tokens: np.ndarray, idx: np.ndarray) -> bytes:
    """Ascending tokens as differences of as few bytes as they need, and a class number each."""
    steps = np.diff(tokens, prepend=tokens[:1])
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    low = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return struct.pack("<BIQ", width, len(tokens), int(tokens[0])) + low.tobytes() + idx.astype("<u2").tobytes()


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    width, n, start = struct.unpack_from("<BIQ", data)
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :width] = np.frombuffer(data, np.uint8, n * width, 13).reshape(n, width)
    tokens = np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64) + np.uint64(start)
    return tokens, np.frombuffer(data, "<u2", n, 13 + n * width)


TOKENS, CLASSES = 0, 1
PACKED = "bucket int, uid long, kind int, payload binary"


def chunk_rows(docs: DataFrame, heavy: np.ndarray, buckets: int) -> DataFrame:
    """Chunks of classes: their shingles by hash range, and a row for the classes themselves.

    ``heavy``: frequent tokens, least frequent first; they stay with the
    chunk's classes.  A task skips sets that it has met.
    """
    order = np.argsort(heavy)
    known, rank = heavy[order], order
    edges = np.array([-(-(k << TOKEN_BITS) // buckets) for k in range(buckets)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, met = TaskContext.get().partitionId(), 0, set()
        keys, sizes, held, owner, size = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            t, i = np.concatenate(held), np.concatenate(owner)
            uid = int.from_bytes(blake2b(b"".join(keys) + struct.pack("<QQ", part, seq), digest_size=8).digest(),
                                 "little", signed=True)
            often, ranks = np.zeros(len(t), bool), np.empty(0, np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, t), len(known) - 1)
                often = known[at] == t
                ranks = rank[at[often]]
            payload = struct.pack("<II", len(keys), int(often.sum())) + b"".join(keys) + \
                np.array(sizes, "<u4").tobytes() + t[often].astype("<u8").tobytes() + \
                i[often].astype("<u2").tobytes() + ranks.astype("<u4").tobytes()
            out = [(uid % buckets, uid, CLASSES, payload)]
            t, i = t[~often], i[~often]
            o = np.argsort(t, kind="stable")
            t, i = t[o], i[o]
            cuts = np.append(np.searchsorted(t, edges), len(t))
            for b in np.flatnonzero(np.diff(cuts)):
                lo, hi = cuts[b], cuts[b + 1]
                out.append((int(b), uid, TOKENS, packed(t[lo:hi], i[lo:hi])))
            types = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), types)],
                                              ["bucket", "uid", "kind", "payload"])

        for batch in batches:
            s, rows = shingle_sets(batch.column(0))
            at = _bounds(rows, batch.num_rows)
            number = np.full(batch.num_rows, -1)
            for r in np.flatnonzero(np.diff(at)):
                key = _key(s[at[r]:at[r + 1]])
                if key not in met:
                    met.add(key)
                    number[r] = len(keys)
                    keys.append(key)
                    sizes.append(int(at[r + 1] - at[r]))
            own = number[rows] >= 0
            held.append(s[own] >> np.uint64(64 - TOKEN_BITS))
            owner.append(number[rows[own]])
            size += int(own.sum())
            if size >= CHUNK or len(keys) > 60_000:
                yield flush()
                keys, sizes, held, owner, size, seq = [], [], [], [], 0, seq + 1
        if keys:
            yield flush()

    return docs.select("text").mapInArrow(run, PACKED)


def _shared(bucket: pa.Table) -> pa.Table:
    """Tokens of a hash range that occur more than once, back by chunk; class rows pass."""
    rows = bucket.select(["uid", "kind", "payload"]).to_pylist()
    out = [(r["uid"], CLASSES, r["payload"]) for r in rows if r["kind"] == CLASSES]
    chunks = [(r["uid"], *unpacked(r["payload"])) for r in rows if r["kind"] == TOKENS]
    if chunks:
        t = np.concatenate([c[1] for c in chunks])
        i = np.concatenate([c[2] for c in chunks])
        of = np.repeat(np.arange(len(chunks)), [len(c[1]) for c in chunks])
        _, at, seen = np.unique(t, return_inverse=True, return_counts=True)
        seen = seen[at]
        more = np.flatnonzero(seen > 1)
        t, i, of, seen = t[more], i[more], of[more], np.minimum(seen[more], 65535)
        cuts = np.searchsorted(of, np.arange(len(chunks) + 1))
        for c, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
            if hi > lo:
                data = packed(t[lo:hi], i[lo:hi])
                out.append((chunks[c][0], TOKENS, struct.pack("<I", len(data)) + data + seen[lo:hi].astype("<u2").tobytes()))
    columns = list(zip(*out)) or [(), (), ()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int32(), pa.binary()])],
                    names=["uid", "kind", "payload"])


CANDIDATE = "key binary, k8 long, n long, shingles binary, prefix array<long>"


def _candidates(chunk: pa.Table) -> pa.Table:
    """Classes of a chunk that have too few shingles of their own to be without links."""
    t, i, seen, keys, n = [], [], [], [], np.empty(0, np.int64)
    for kind, data in zip(chunk.column("kind").to_pylist(), chunk.column("payload").to_pylist()):
        if kind == CLASSES:
            m, h = struct.unpack_from("<II", data)
            keys = [data[8 + 16 * k:24 + 16 * k] for k in range(m)]
            at = 8 + 16 * m
            n = np.frombuffer(data, "<u4", m, at).astype(np.int64)
            t.append(np.frombuffer(data, "<u8", h, at + 4 * m))
            i.append(np.frombuffer(data, "<u2", h, at + 4 * m + 8 * h))
            seen.append(np.frombuffer(data, "<u4", h, at + 4 * m + 10 * h).astype(np.int64) + (1 << 16))
        else:
            size, = struct.unpack_from("<I", data)
            tokens, idx = unpacked(data[4:4 + size])
            t.append(tokens)
            i.append(idx)
            seen.append(np.frombuffer(data, "<u2", len(tokens), 4 + size).astype(np.int64))
    t, i, seen = np.concatenate(t), np.concatenate(i), np.concatenate(seen)
    o = np.lexsort((t, seen, i))
    t, i = t[o], i[o]
    at = np.searchsorted(i, np.arange(len(keys) + 1))
    need = n - least_overlap(n) + 1 - (n - np.diff(at))
    out = []
    for c in np.flatnonzero(need > 0):
        own = t[at[c]:at[c + 1]]
        out.append((keys[c], int.from_bytes(keys[c][:8], "big", signed=True), int(n[c]), np.sort(own).tobytes(),
                    own[:need[c]].astype(np.int64)))
    columns = list(zip(*out)) or [()] * 5
    types = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    return pa.table([pa.array(c, k) for c, k in zip(columns, types)], names=["key", "k8", "n", "shingles", "prefix"])


# -------------------------------------------------------------- signature tree
class SignatureTree:
    """Levels of nodes over sets, leaves first; a node covers ``FAN`` of the level below.

    A level holds, per node: the OR of the bitmaps, the least and greatest
    size, the most shared shingles, and the most of them that share a bit.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, bits: int):
        order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), sizes[i]))
        self.order = np.array(order)
        n, shared = sizes[self.order], np.array([len(sets[i]) for i in order])
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for r, i in enumerate(order):
            at = (sets[i] >> np.uint64(11)) & np.uint64(bits - 1)
            np.bitwise_or.at(maps[r], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        slack = shared - np.bitwise_count(maps).sum(axis=1)
        self.levels = [(maps, n, n, shared, slack)]
        while len(self.levels[-1][1]) > 1:
            maps, low, high, shared, slack = self.levels[-1]
            cut = np.arange(0, len(low), FAN)
            self.levels.append((np.bitwise_or.reduceat(maps, cut), np.minimum.reduceat(low, cut),
                                *(np.maximum.reduceat(x, cut) for x in (high, shared, slack))))


def possible(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, step: int = 2048) -> np.ndarray:
    """Whether any pair below nodes ``i`` of level ``x`` and ``j`` of level ``y`` could link."""
    ok = (4 * x[2][i] >= 3 * y[1][j]) & (4 * y[2][j] >= 3 * x[1][i])
    live = np.flatnonzero(ok)
    for k in range(0, len(live), step):
        a, b = i[live[k:k + step]], j[live[k:k + step]]
        common = np.bitwise_count(x[0][a] & y[0][b]).sum(axis=1, dtype=np.int64)
        overlap = np.minimum(np.minimum(x[3][a], y[3][b]), common + np.minimum(x[4][a], y[4][b]))
        ok[live[k:k + step]] = 7 * overlap >= 3 * (x[1][a] + y[1][b])
    return ok


def candidates(x: SignatureTree, y: SignatureTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf pairs that survive a dual traversal from the roots; ``x is y`` gives each pair once."""
    depth = max(len(x.levels), len(y.levels)) - 1
    i = j = np.zeros(1, np.int64)
    for level in range(depth, -1, -1):
        lx, ly = x.levels[min(level, len(x.levels) - 1)], y.levels[min(level, len(y.levels) - 1)]
        if x is y:
            fit = i <= j if level else i < j
            i, j = i[fit], j[fit]
        ok = possible(lx, ly, i, j)
        i, j = i[ok], j[ok]
        if level:
            i, j = _children(i, j, level, x), _children(i, j, level, y, second=True)
            fit = (i >= 0) & (j >= 0)
            i, j = i[fit], j[fit]
    yield x.order[i], y.order[j]


def _children(i: np.ndarray, j: np.ndarray, level: int, t: SignatureTree, second: bool = False) -> np.ndarray:
    """Children of one side of node pairs, crossed with the other side's; -1 where there is none."""
    def down(nodes: np.ndarray) -> np.ndarray:
        if level >= len(t.levels):                           # the smaller tree waits at its root
            return np.where(np.arange(FAN)[None, :] == 0, nodes[:, None], -1)
        c = nodes[:, None] * FAN + np.arange(FAN)[None, :]
        return np.where(c < len(t.levels[level - 1][1]), c, -1)

    if second:
        return np.tile(down(j), (1, FAN)).ravel()
    return np.repeat(down(i), FAN, axis=1).ravel()


class Union:
    def __init__(self, labels: list):
        first: dict = {}
        self.up = [first.setdefault(label, i) for i, label in enumerate(labels)]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def linked(sets: list[np.ndarray], sizes: list[int], labels: list, split: int | None = None) -> list[tuple[int, int]]:
    """Links that connect ``sets`` as all their links would, given what ``labels`` connect.

    ``sizes`` are whole set sizes; ``sets`` hold the shingles that occur in
    more than one class.  With ``split``, only pairs between the first
    ``split`` sets and the rest.
    """
    most = max((len(s) for s in sets), default=0)
    bits = 1 << min(16, max(10, (4 * most - 1).bit_length()))
    sizes = np.array(sizes, np.int64)
    if split is None:
        x = y = SignatureTree(sets, sizes, bits)
        shift = 0
    else:
        x, y = SignatureTree(sets[:split], sizes[:split], bits), SignatureTree(sets[split:], sizes[split:], bits)
        shift = split
    union, links = Union(labels), []
    for left, right in candidates(x, y):
        for a, b in zip(left.tolist(), (right + shift).tolist()):
            ra, rb = union.root(a), union.root(b)
            if ra == rb:
                continue
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 7 * both >= 3 * (sizes[a] + sizes[b]):
                union.up[max(ra, rb)] = min(ra, rb)
                links.append((a, b))
    return links


LINKS = "u binary, v binary"


def _link_table(keys: list[bytes], links: list[tuple[int, int]]) -> pa.Table:
    return pa.table([pa.array([keys[a] for a, _ in links], pa.binary()),
                     pa.array([keys[b] for _, b in links], pa.binary())], names=["u", "v"])


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(v, np.uint64) for v in column.to_pylist()]


def _within(block: pa.Table) -> pa.Table:
    keys, sets = block.column("key").to_pylist(), _sets(block.column("shingles"))
    return _link_table(keys, linked(sets, block.column("n").to_pylist(), keys))


def _between(pair: pa.Table) -> pa.Table:
    """Links between the two blocks of a pair; rows carry their side."""
    pair = pair.sort_by("side")
    keys, labels = pair.column("key").to_pylist(), pair.column("part").to_pylist()
    left = pair.column("side").to_pylist().count("i")
    return _link_table(keys, linked(_sets(pair.column("shingles")), pair.column("n").to_pylist(), labels, split=left))


# ------------------------------------------------------------------------ join
def candidate_classes(docs: DataFrame, heavy: np.ndarray) -> DataFrame:
    """key, k8, n, shingles (those in more than one class), prefix of classes that may link."""
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = chunk_rows(docs, heavy, buckets).groupBy("bucket").applyInArrow(_shared, "uid long, kind int, payload binary")
    return shared.groupBy("uid").applyInArrow(_candidates, CANDIDATE)


def clusters(classes: DataFrame) -> DataFrame:
    """k8, cluster of classes that share a prefix shingle with another class."""
    postings = classes.select("k8", F.explode("prefix").alias("token"))
    shared = (postings.groupBy("token").agg(F.min("k8").alias("lo"), F.max("k8").alias("hi"))
              .where("lo != hi").select("token", "lo"))
    edges = postings.join(shared, "token").where("k8 != lo").select(F.col("k8").alias("u"), F.col("lo").alias("v"))
    parts = components(edges)
    return parts.select(F.col("u").alias("k8"), F.col("v").alias("cluster")).unionByName(
        parts.select(F.col("v").alias("k8"), F.col("v").alias("cluster")).distinct())


def links(sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """u, v: links that connect the classes as all links would."""
    size = sets.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"))
    blocked = sets.join(size, "cluster").withColumn(
        "blk", F.pmod(F.xxhash64("key"), F.ceil(F.col("members") / block)).cast("int"))
    # Dealt by block: the join's dealing by cluster would leave a wide cluster in one task.
    dealt = blocked.select("cluster", "blk", "key", "n", "shingles").repartition("cluster", "blk")
    first = stored(dealt.groupBy("cluster", "blk").applyInArrow(_within, LINKS), "links_within")
    wide = stored(blocked.where(F.col("members") > block).select("cluster", "key", "n", "shingles"), "wide_clusters")
    if wide.isEmpty():
        return first
    return first.unionByName(_links_across(wide, components(first), block))


def _links_across(wide: DataFrame, parts: DataFrame, block: int) -> DataFrame:
    """Links between blocks of clusters wider than one block."""
    part = parts.select(F.col("u").alias("key"), F.col("v").alias("part"))
    labelled = wide.join(part, "key", "left").withColumn("part", F.coalesce("part", "key"))
    sizes = labelled.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("in_part"))
    sizes = sizes.withColumn("bucket", F.when(F.col("in_part") * 2 >= block, F.col("part")).otherwise(F.lit(b"")))
    sizes = sizes.withColumn("in_bucket", F.sum("in_part").over(Window.partitionBy("cluster", "bucket")))
    placed = stored(labelled.join(sizes.drop("in_part"), ["cluster", "part"]).withColumn("blk", F.xxhash64(
        "bucket", F.pmod(F.xxhash64("key", F.lit(1)), F.ceil(F.col("in_bucket") / block)))), "wide_blocks")
    stats = placed.groupBy("cluster", "blk", "bucket").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    stats = stored(stats, "block_stats")
    other = stats.select(*[F.col(c).alias(f"y_{c}") for c in stats.columns])
    meets = (4 * F.col("hi") >= 3 * F.col("y_lo")) & (4 * F.col("y_hi") >= 3 * F.col("lo"))
    pairs = stored(stats.join(other, (F.col("cluster") == F.col("y_cluster")) & (F.col("blk") <= F.col("y_blk")))
                   .where(meets & ((F.col("bucket") == F.lit(b"")) | (F.col("bucket") != F.col("y_bucket"))))
                   .select("cluster", F.col("blk").alias("i"), F.col("y_blk").alias("j")), "block_pairs")
    by = ["cluster", "i", "j"]

    def side(which: str) -> DataFrame:
        at = pairs.select(F.col("cluster").alias("pc"), "i", "j", F.col(which).alias("at"))
        return (placed.join(at, (F.col("cluster") == F.col("pc")) & (F.col("blk") == F.col("at")))
                .select(*by, "key", "n", "part", "shingles", F.lit(which).alias("side")))

    met = side("i").unionByName(side("j")).groupBy(*by).applyInArrow(_between, LINKS)
    return stored(met, "links_across")


def near_rows(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, key, n_shingles, component_id, root (the component's key; null for an empty set)."""
    rows = stored(described(docs), "described")
    counted = (rows.where("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen"))
               .orderBy(F.desc("seen"), "token").limit(HEAVY).collect())       # bounded: HEAVY rows
    heavy = np.array([r["token"] for r in reversed(counted)], np.int64).view(np.uint64)
    own = rows.where("key IS NOT NULL").select("doc_id", "key", "n")
    classes = stored(own.groupBy("key", "n").agg(F.min("doc_id").alias("rep")), "classes")
    shared = stored(candidate_classes(docs, heavy >> np.uint64(64 - TOKEN_BITS)), "candidate_classes")
    sets = stored(shared.drop("prefix").join(clusters(shared), "k8").dropDuplicates(["key"])
                  .select("cluster", "key", "n", "shingles"), "cluster_sets")
    parts = components(links(sets, block))
    tied = parts.unionByName(parts.select(F.col("v").alias("u"), "v").distinct())
    tied = tied.join(classes.select(F.col("key").alias("u"), "rep"), "u")
    least = tied.groupBy("v").agg(F.min("rep").alias("component_id"))
    named = stored(classes.join(tied.join(least, "v").select(F.col("u").alias("key"), "component_id", "v"), "key", "left")
                   .select(F.col("key").alias("k"), F.coalesce("component_id", "rep").alias("component_id"),
                           F.coalesce("v", "key").alias("root")), "named")
    empty = own.where("n = 0").select("doc_id", "key", F.lit(0).cast("long").alias("n_shingles"),
                                      F.col("doc_id").alias("component_id"), F.lit(None).cast("binary").alias("root"))
    full = own.where("n > 0").join(named, F.col("key") == F.col("k")).select(
        "doc_id", "key", F.col("n").alias("n_shingles"), "component_id", "root")
    return full.unionByName(empty)


def near_components(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    return near_rows(docs, block).select("doc_id", "n_shingles", "component_id")


def keyed_rows(docs: DataFrame) -> DataFrame:
    """row (every input column), key, same (what rows of one key must share to be one)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, rows = shingle_sets(b.column(1))
            at = _bounds(rows, b.num_rows)
            keys = [_key(s[lo:hi]) for lo, hi in zip(at[:-1], at[1:])]
            same = [t if n == 0 else None for t, n in zip(b.column(1).to_pylist(), np.diff(at))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(same, pa.string())],
                                             ["row", "key", "same"])

    packed_ = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("t"))
    out = StructType([packed_.schema["row"], *StructType.fromDDL("key binary, same string").fields])
    return packed_.mapInArrow(run, out)


def one_of_each(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One document that names each component, every input column; of equal rows without shingles, one."""
    found = stored(near_rows(docs, block), "near_rows")
    repeated = stored(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated_ids")
    if repeated.isEmpty():
        return repacked(docs, found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))), ["doc_id"])
    # A repeated id does not tell rows apart: a component is named by its first row by (doc_id, key).
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("x")
    named = (found.where("root IS NOT NULL").groupBy("root").agg(first).select("x.doc_id", "x.key")
             .unionByName(found.where("root IS NULL").select("doc_id", "key").distinct()))
    named = stored(named, "named_rows")
    ids = repeated.select(F.col("doc_id").alias("again"))
    at = F.col("doc_id").eqNullSafe(F.col("again"))
    alone = repacked(docs, named.join(ids, at, "left_anti"), ["doc_id"])
    names = named.join(ids, at, "left_semi").select(F.col("doc_id").alias("d"), F.col("key").alias("k"))
    rows = keyed_rows(repacked(docs, repeated, ["doc_id"])).withColumn("id", F.col("row")["doc_id"])
    kept = (rows.join(names, F.col("id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left_semi")
            .dropDuplicates(["id", "key", "same"]))
    return alone.unionByName(kept.select("row.*"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(prepare(spark), sf_dir, "documents"))
