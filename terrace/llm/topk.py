"""Exact top-k inner-product search with block-at-a-time pruning (operator 9).

Components become integers floor(64 * x).  Rows are range-partitioned by
(nearest pivot, key), so 256 consecutive rows - a block - are alike; a
block is stored as one forward index (its vectors) with the largest and
smallest value of every term.  For a query, the sum over terms of the
better of query * largest and query * smallest bounds every score in the
block.  Blocks are dealt to shards of about ``SHARD_BLOCKS``; every shard
meets every group of queries: each query visits the shard's blocks in
falling order of bound and stops when the bound is below its k-th score so
far (equal bounds are visited: ties go to the smaller key).  A window over
k rows per (query, shard) takes the final k.

Pivots - at most ``PIVOTS`` vectors, the first by a hash of the key - only
shape blocks; results are exact whatever they are.  They are the only
table broadcast, of a fixed size.

Scores are exact: products are summed in float64 where all sums stay below 2 ** 53,
else in 64-bit whole numbers, which the scores have to fit.

Defined cases: vectors that are null, empty or hold a null or non-finite
component, and rows without a key, take no part; a candidate of another
length than the query's is not scored; a row never answers a query of its
own key; repeated rows are each candidates and their query is asked once;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm.common import prepare, stored, table
from terrace.llm.hard_negatives import Best

K = 20
SCALE = 64
QUERY_EVERY = 20
PIVOTS = 64
BLOCK = 256
SHARD_BLOCKS = 32
QUERY_GROUP = 1024

BLOCK_SCHEMA = "block long, dims int, ids binary, vectors binary, high binary, low binary"
HIT_SCHEMA = "query_id long, vec_id long, score long"


def quantised(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, dims, q (array of long) of the rows that take part."""
    x = F.transform(F.col(vector), lambda e: e.cast("double"))
    fit = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = embeddings.select(F.col(key).cast("bigint").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & fit)
    return rows.select("vec_id", F.size("x").alias("dims"),
                       F.transform("x", lambda e: F.floor(e * SCALE)).alias("q"))


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _packed(ids: np.ndarray, m: np.ndarray) -> list:
    m = m.astype("<f8")
    return [ids.astype("<i8").tobytes(), m.tobytes(), m.max(axis=0).tobytes(), m.min(axis=0).tobytes()]


def blocks(vectors: DataFrame, block_rows: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """Packed blocks of alike rows; at most ``block_rows`` rows each."""
    few = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("dims", "q").collect()
    by_dims: dict[int, np.ndarray] = {}
    for d in {r["dims"] for r in few}:
        by_dims[d] = np.array([r["q"] for r in few if r["dims"] == d], np.float64)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(1).to_numpy()
            near = np.zeros(b.num_rows, np.int32)
            for d in np.unique(dims):
                if int(d) in by_dims:
                    at = np.flatnonzero(dims == d)
                    m = _matrix(b.column(2).take(pa.array(at)), int(d)).astype(np.float64)
                    p = by_dims[int(d)]
                    near[at] = np.argmax(m @ p.T - (p * p).sum(axis=1) / 2, axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near)], ["vec_id", "dims", "q", "near"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            dims, out = b.column(1).to_numpy(), []
            edges = [0, *(np.flatnonzero(np.diff(dims)) + 1), len(dims)]
            for lo, hi in zip(edges[:-1], edges[1:]):
                for i in range(lo, hi, block_rows):
                    rows = b.slice(i, min(block_rows, hi - i))
                    d = int(dims[i])
                    out.append([(part << 32) + seq, d, *_packed(rows.column(0).to_numpy(), _matrix(rows.column(2), d))])
                    seq += 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int32()] + [pa.binary()] * 4)],
                    ["block", "dims", "ids", "vectors", "high", "low"])

    schema = "vec_id long, dims int, q array<long>, near int"
    alike = (vectors.mapInArrow(nearest, schema).repartitionByRange("dims", "near", "vec_id")
             .sortWithinPartitions("dims", "near", "vec_id"))
    return alike.mapInArrow(pack, BLOCK_SCHEMA)


def best_of_shard(queries: np.ndarray, own: np.ndarray, shard: list[dict], k: int) -> list[tuple]:
    """(query row, vec_id, score) of the k best of a shard's blocks for every query, exactly."""
    n = len(queries)
    high = np.stack([b["high"] for b in shard], axis=1)
    low = np.stack([b["low"] for b in shard], axis=1)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bounds = up @ high + down @ low
    order = np.argsort(-bounds, axis=1, kind="stable")
    scores = np.full((n, k), -np.inf)
    ids = np.full((n, k), np.iinfo(np.int64).max)
    active = np.arange(n)
    for turn in range(len(shard)):
        turn_block = order[active, turn]
        live = bounds[active, turn_block] >= scores[active, k - 1]
        active, turn_block = active[live], turn_block[live]
        if not len(active):
            break
        by_block = np.argsort(turn_block, kind="stable")
        cuts = np.flatnonzero(np.diff(turn_block[by_block])) + 1
        for rows in np.split(by_block, cuts):
            b, q = shard[turn_block[rows[0]]], active[rows]
            s = queries[q] @ b["vectors"].T
            s[own[q][:, None] == b["ids"][None, :]] = -np.inf
            if len(b["ids"]) > k:                       # only scores that can enter, k at most, ties kept
                reach = np.maximum(scores[q, k - 1], -np.partition(-s, k - 1, axis=1)[:, k - 1])
            else:
                reach = scores[q, k - 1]
            r, c = np.nonzero((s >= reach[:, None]) & (s > -np.inf))
            _merge(scores, ids, q, r, s[r, c], b["ids"][c], k)
    r, c = np.nonzero(scores > -np.inf)
    return list(zip(r.tolist(), ids[r, c].tolist(), scores[r, c].astype(np.int64).tolist()))


def fits_float(queries: np.ndarray, shard: list[dict]) -> bool:
    """Whether every sum of products stays a whole number that float64 holds exactly."""
    largest = max(max(abs(b["high"]).max(), abs(b["low"]).max()) for b in shard)
    return float(np.abs(queries).max()) * float(largest) * queries.shape[1] < 2.0 ** 53


def best_of_wide_shard(queries: np.ndarray, own: np.ndarray, shard: list[dict], k: int) -> list[tuple]:
    """As :func:`best_of_shard`, in 64-bit whole numbers: exact wherever the scores fit them.

    Sums may wrap on the way (arithmetic modulo 2 ** 64).  Bounds are floats, widened by more than their error.
    """
    high = np.stack([b["high"] for b in shard], axis=1)
    low = np.stack([b["low"] for b in shard], axis=1)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bounds = up @ high + down @ low + 1e-9 * (up @ np.abs(high) - down @ np.abs(low)) + 1.0
    whole, best = queries.astype(np.int64), Best(len(queries), k)
    for at in np.argsort(-bounds.max(axis=0), kind="stable"):
        b = shard[at]
        live = ~best.taken[:, -1] | (bounds[:, at] >= best.score[:, -1])
        if live.any():
            s = np.zeros((len(queries), len(b["ids"])), np.int64)
            s[live] = whole[live] @ b["vectors"].astype(np.int64).T
            best.add(s, b["ids"], live[:, None] & (own[:, None] != b["ids"][None, :]))
    return [(int(r), int(v), int(s)) for r, v, s in zip(*best.rows())]


def _merge(scores: np.ndarray, ids: np.ndarray, q: np.ndarray, r: np.ndarray, s: np.ndarray,
           v: np.ndarray, k: int) -> None:
    touched = np.unique(r)
    if not len(touched):
        return
    rows = np.concatenate([np.repeat(touched, k), r])
    all_s = np.concatenate([scores[q[touched]].ravel(), s])
    all_v = np.concatenate([ids[q[touched]].ravel(), v])
    order = np.lexsort((all_v, -all_s, rows))
    rows, all_s, all_v = rows[order], all_s[order], all_v[order]
    first = np.searchsorted(rows, touched)
    place = np.arange(len(rows)) - first[np.searchsorted(touched, rows)]
    keep = place < k
    at = q[rows[keep]], place[keep]
    scores[at], ids[at] = all_s[keep], all_v[keep]


def search(vectors: DataFrame, queries: DataFrame, k: int = K, block_rows: int = BLOCK,
           shard_blocks: int = SHARD_BLOCKS, query_group: int = QUERY_GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of ``vectors`` for every row of ``queries``."""
    index = stored(blocks(vectors, block_rows), "topk_blocks")
    n_shards = max(1, -(-index.count() // shard_blocks))
    asked = stored(queries.distinct(), "topk_queries")
    n_groups = max(1, -(-asked.count() // query_group))
    shards = index.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(n_shards)).cast("int"))
    grouped = asked.withColumn("grp", F.pmod(F.xxhash64("vec_id"), F.lit(n_groups)).cast("int"))
    to_all_shards = grouped.select("grp", "vec_id", "dims", "q",
                                   F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"))
    to_all_groups = shards.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("grp"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        qs: dict[int, list] = {}
        for r in left.select(["dims", "vec_id", "q"]).to_pylist():
            qs.setdefault(r["dims"], []).append((r["vec_id"], r["q"]))
        bs: dict[int, list[dict]] = {}
        for r in right.to_pylist():
            d = r["dims"]
            bs.setdefault(d, []).append({
                "ids": np.frombuffer(r["ids"], "<i8"), "vectors": np.frombuffer(r["vectors"], "<f8").reshape(-1, d),
                "high": np.frombuffer(r["high"], "<f8"), "low": np.frombuffer(r["low"], "<f8")})
        out: list[tuple] = []
        for d in qs.keys() & bs.keys():
            own = np.array([i for i, _ in qs[d]], np.int64)
            m = np.array([q for _, q in qs[d]], np.float64)
            best = best_of_shard if fits_float(m, bs[d]) else best_of_wide_shard
            out += [(int(own[r]), v, s) for r, v, s in best(m, own, bs[d], k)]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    met = (to_all_shards.groupBy("shard", "grp").cogroup(to_all_groups.groupBy("shard", "grp"))
           .applyInArrow(meet, HIT_SCHEMA))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
               .select("query_id", "rank", "vec_id", "score"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(prepare(spark), sf_dir, "embeddings"))
    return search(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
