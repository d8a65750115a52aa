"""Hard-negative mining by Kronecker-packed products (operator 13).

Components become integers floor(scale * x).  ``BLOCK`` candidate rows of one
label and length are packed component by component: each component, biased
so that none is negative, goes into a field of its own of one wide integer.
An anchor component, biased likewise, multiplies that integer once, and so
all the block's rows at once; the sum over components holds a sum of
products in every field, from which the exact score follows:

    sum (a + A)(c + C)  =  a.c + C sum a + A sum c + dims A C

A and C are the largest magnitudes among the anchors and the candidates, and
a field has as many bytes as the largest such sum needs, so no field runs
into the next, whatever the components.  Scores must fit 64 bits; fields may
be wider (they are unpacked modulo 2 ** 64).

1. Candidates are written as blocks, dealt to shards of about
   ``SHARD_ROWS`` rows;
   anchors are dealt to groups of ``ANCHOR_GROUP``.  A label that holds a third
   of the rows is just more blocks.
2. Positives: every anchor group meets the shards of its own label, which
   give each anchor's best rows, and a window over those takes the best.
3. Negatives: every anchor group meets every shard with the score bands of
   its positives; each shard gives its best rows of other labels in each
   band, and a window over those takes the first.  Small blocks are laid end
   to end here, so many small labels cost no more than a few large ones.

A shard returns a fixed number of rows per anchor, and a task holds one
group, one shard and the scores of one block.
The anchors are a stated query set: its products with all rows are the
exact search itself.

Defined cases: rows whose key, label or vector is null, whose vector is empty
or holds a null or non-finite component, take no part; a row never is a
positive of an anchor of its own key; rows of another length than the
anchor's are not scored; repeated rows are each candidates, repeated anchors
are asked once; ties go to the smaller key; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm.common import prepare, stored, table

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
BAND = (50, 95)             # hundredths of the positive's score: least and greatest of a negative
BLOCK = 512
SHARD_ROWS = 32 * BLOCK
ANCHOR_GROUP = 1024

BLOCK_SCHEMA = "label long, dims int, block long, n_rows int, ids binary, sums binary, packed array<binary>"
SCORE_SCHEMA = "anchor long, slot int, vec_id long, score long"
_LEAST = np.iinfo(np.int64).min


def usable(embeddings: DataFrame, label: Column, key: str = "vec_id", vector: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """vec_id, label, dims, q (array of long) of the rows that take part."""
    x = F.transform(F.col(vector), lambda e: e.cast("double"))
    fit = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = embeddings.select(F.col(key).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
                             x.alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()
                      & F.col("x").isNotNull() & (F.size("x") > 0) & fit)
    return rows.select("vec_id", "label", F.size("x").alias("dims"),
                       F.transform("x", lambda e: F.floor(e * scale)).alias("q"))


class Fields:
    """Width and biases of the fields of a wide integer."""

    def __init__(self, anchor_bias: int, candidate_bias: int, dims: int):
        self.a, self.c = anchor_bias, candidate_bias
        largest = dims * 2 * anchor_bias * 2 * candidate_bias
        self.width = max(1, (largest.bit_length() + 7) // 8, ((2 * candidate_bias).bit_length() + 7) // 8)

    def pack(self, column: np.ndarray) -> bytes:
        """One component of a block's rows, little-endian, a field each."""
        biased = column.astype(np.uint64) + np.uint64(self.c)           # c + C >= 0, below 2 ** 64
        out = np.zeros((len(column), self.width), np.uint8)
        n = min(8, self.width)
        out[:, :n] = biased.view(np.uint8).reshape(-1, 8)[:, :n]
        return out.tobytes()

    def unpack(self, total: int, n: int) -> np.ndarray:
        """The fields' values modulo 2 ** 64."""
        raw = np.frombuffer(total.to_bytes(n * self.width, "little"), np.uint8).reshape(n, self.width)
        out = np.zeros((n, 8), np.uint8)
        w = min(8, self.width)
        out[:, :w] = raw[:, :w]
        return out.view(np.uint64).ravel()

    def scores(self, anchors: list[list[int]], packed: list[int], sums: np.ndarray) -> np.ndarray:
        """anchors x rows, exact: one multiplication per anchor component for the whole block."""
        out = np.empty((len(anchors), len(sums)), np.uint64)
        dims, a, c = len(packed), self.a, self.c
        of_rows = sums.astype(np.uint64) * np.uint64(a & (2**64 - 1))
        for i, q in enumerate(anchors):
            total = sum(map(mul, packed, [x + a for x in q]))
            out[i] = self.unpack(total, len(sums)) - np.uint64((c * sum(q) + dims * a * c) % 2**64) - of_rows
        return out.view(np.int64)


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _largest(rows: DataFrame) -> tuple[int, int]:
    """Largest magnitude of a component, and longest vector (0, 0 without rows)."""
    r = rows.agg(F.max(F.greatest(F.abs(F.array_max("q")), F.abs(F.array_min("q")))), F.max("dims")).first()
    return r[0] or 0, r[1] or 0


def blocks(rows: DataFrame, fields: Fields, block_rows: int = BLOCK) -> DataFrame:
    """Packed blocks of at most ``block_rows`` rows of one label and length."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            label, dims = b.column(1).to_numpy(), b.column(2).to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(label) != 0) | (np.diff(dims) != 0)) + 1), b.num_rows]
            out = []
            for lo, hi in zip(edges[:-1], edges[1:]):
                for i in range(lo, hi, block_rows):
                    rows = b.slice(i, min(block_rows, hi - i))
                    m = _matrix(rows.column(3), int(dims[i]))
                    out.append((int(label[i]), int(dims[i]), (part << 32) + seq, rows.num_rows,
                                rows.column(0).to_numpy().astype("<i8").tobytes(),
                                m.sum(axis=1).astype("<i8").tobytes(), [fields.pack(c) for c in m.T]))
                    seq += 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int32(), pa.int64(), pa.int32(),
                                                                pa.binary(), pa.binary(), pa.list_(pa.binary())])],
                    ["label", "dims", "block", "n_rows", "ids", "sums", "packed"])

    alike = rows.select("vec_id", "label", "dims", "q").repartitionByRange("label", "dims", "vec_id")
    return alike.sortWithinPartitions("label", "dims", "vec_id").mapInArrow(pack, BLOCK_SCHEMA)


class Best:
    """The k best (score, then smaller key) of every (anchor, slot), a block at a time."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), _LEAST, np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        self.taken = np.zeros((n, k), bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        k = self.k
        full = self.taken[:, -1]
        allowed &= ~full[:, None] | (scores >= self.score[:, -1:])
        for r in np.flatnonzero(allowed.any(axis=1)):
            at = np.flatnonzero(allowed[r])
            have = int(self.taken[r].sum())
            s = np.concatenate([self.score[r, :have], scores[r, at]])
            v = np.concatenate([self.id[r, :have], ids[at]])
            if len(s) > 8 * k:                                     # no more than the k best and their ties
                reach = np.partition(s, len(s) - k)[len(s) - k]
                s, v = s[s >= reach], v[s >= reach]
            order = np.lexsort((v, ~s))[:k]                        # ~s falls as s rises, without overflow
            n = len(order)
            self.score[r, :n], self.id[r, :n], self.taken[r, :n] = s[order], v[order], True

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r, c = np.nonzero(self.taken)
        return r, self.id[r, c], self.score[r, c]


CELL = ["label", "grp", "shard"]


def _cells(anchors: DataFrame, index: DataFrame, extra: list[str], shard_rows: int, anchor_group: int,
           by_label: bool) -> tuple[DataFrame, DataFrame]:
    """Anchors and blocks, each once per cell (label, group, shard) it is met in.

    ``by_label``: cells hold one label's anchors and blocks; else ``label`` is 0 in all cells.
    """
    label = F.col("label") if by_label else F.lit(0).cast("bigint")
    block_cols = ["dims", "ids", "sums", "packed", F.col("label").alias("of_rows")]
    left = anchors.select(label.alias("label"), "anchor", "vec_id", "dims", "q",
                          F.col("label").alias("own"), *extra)
    right = index.select(label.alias("label"), "block", F.col("n_rows"), *block_cols)
    # one row per label: its numbers of groups and shards
    sizes = (left.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / anchor_group).cast("int").alias("groups"))
             .join(right.groupBy("label").agg(
                 F.ceil(F.sum("n_rows") / shard_rows).cast("int").alias("shards")), "label"))
    spread = lambda c, to: F.pmod(F.xxhash64(c), F.col(to)).cast("int")
    every = lambda to: F.explode(F.sequence(F.lit(0), F.col(to) - 1))
    left = (left.join(sizes, "label").withColumn("grp", spread("anchor", "groups"))
            .withColumn("shard", every("shards")).drop("groups", "shards"))
    right = (right.join(sizes, "label").withColumn("shard", spread("block", "shards"))
             .withColumn("grp", every("groups")).drop("groups", "shards"))
    return left, right


def _merged(blocks: Iterable[dict]) -> Iterator[dict]:
    """Small blocks of one length laid end to end, up to ``BLOCK`` rows: fields just follow each other."""
    run: list[dict] = []

    def joined() -> dict:
        ids = [np.frombuffer(b["ids"], "<i8") for b in run]
        return {"ids": np.concatenate(ids), "sums": b"".join(b["sums"] for b in run),
                "packed": [b"".join(c) for c in zip(*(b["packed"] for b in run))],
                "labels": np.concatenate([np.full(len(i), b["of_rows"], np.int64) for i, b in zip(ids, run)])}

    for b in blocks:
        if run and sum(x["n_rows"] for x in run) + b["n_rows"] > BLOCK:
            yield joined()
            run = []
        run.append(b)
    if run:
        yield joined()


def _by_dims(left: pa.Table, right: pa.Table, extra: list[str]):
    """(anchor rows, their vectors, blocks) of every vector length on both sides."""
    asked: dict[int, list[dict]] = {}
    for r in left.select(["anchor", "vec_id", "own", "dims", "q", *extra]).to_pylist():
        asked.setdefault(r["dims"], []).append(r)
    right = right.select(["dims", "ids", "sums", "packed", "of_rows", "n_rows"])
    dims = right["dims"].to_pylist()
    for d, rows in asked.items():
        at = [i for i, x in enumerate(dims) if x == d]
        if at:
            yield rows, [r["q"] for r in rows], _merged(right.slice(i, 1).to_pylist()[0] for i in at)


def _scored(fields: Fields, qs: list[list[int]], b: dict) -> tuple[np.ndarray, np.ndarray]:
    packed = [int.from_bytes(p, "little") for p in b["packed"]]
    return b["ids"], fields.scores(qs, packed, np.frombuffer(b["sums"], "<i8"))


def _table(out: list[tuple]) -> pa.Table:
    columns = list(zip(*out)) or [(), (), (), ()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.int64(), pa.int64()])],
                    names=["anchor", "slot", "vec_id", "score"])


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   band: tuple[int, int] = BAND, block_rows: int = BLOCK, shard_rows: int = SHARD_ROWS,
                   anchor_group: int = ANCHOR_GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors`` have the columns of :func:`usable`; ``band`` bounds a negative's
    score in hundredths of its positive's.
    """
    asked = stored(anchors.distinct().select(F.monotonically_increasing_id().alias("anchor"), "vec_id", "label",
                                             "dims", "q"), "negatives_anchors")
    (a, da), (c, dc) = _largest(asked), _largest(rows)
    fields = Fields(a, c, max(da, dc))
    index = stored(blocks(rows, fields, block_rows), "negatives_blocks")

    def best_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for asks, qs, bs in _by_dims(left, right, []):
            own = np.array([r["vec_id"] for r in asks], np.int64)
            best = Best(len(asks), positives)
            for b in bs:
                ids, s = _scored(fields, qs, b)
                best.add(s, ids, own[:, None] != ids[None, :])
            r, v, s = best.rows()
            out += [(asks[i]["anchor"], 0, int(x), int(y)) for i, x, y in zip(r, v, s)]
        return _table(out)

    left, right = _cells(asked, index, [], shard_rows, anchor_group, by_label=True)
    found = left.groupBy(*CELL).cogroup(right.groupBy(*CELL)).applyInArrow(best_positives, SCORE_SCHEMA)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc("vec_id"))
    pos = stored(found.withColumn("slot", F.row_number().over(first)).where(F.col("slot") <= positives)
                 .select("anchor", "slot", F.col("vec_id").alias("positive_id"),
                         F.col("score").alias("positive_score")), "negatives_positives")
    # at most ``positives`` rows an anchor
    wanted = asked.join(pos.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("slot", F.col("positive_score").alias("p")))).alias("wanted")), "anchor")
    least, most = band

    def best_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for asks, qs, bs in _by_dims(left, right, ["wanted"]):
            slots = [(i, w["slot"], w["p"]) for i, r in enumerate(asks) for w in r["wanted"]]
            of = np.array([i for i, _, _ in slots])
            own = np.array([asks[i]["own"] for i in of], np.int64)[:, None]
            # least * p <= 100 * s <= most * p, in whole numbers without overflow
            lo = np.array([max(_LEAST, -(-least * p // 100)) for _, _, p in slots], np.int64)[:, None]
            hi = np.array([min(-_LEAST - 1, most * p // 100) for _, _, p in slots], np.int64)[:, None]
            best = Best(len(slots), negatives)
            for b in bs:
                ids, s = _scored(fields, qs, b)
                s = s[of]
                best.add(s, ids, (s >= lo) & (s <= hi) & (own != b["labels"][None, :]))
            r, v, s = best.rows()
            out += [(asks[slots[i][0]]["anchor"], slots[i][1], int(x), int(y)) for i, x, y in zip(r, v, s)]
        return _table(out)

    left, right = _cells(wanted, index, ["wanted"], shard_rows, anchor_group, by_label=False)
    met = left.groupBy(*CELL).cogroup(right.groupBy(*CELL)).applyInArrow(best_negatives, SCORE_SCHEMA)
    last = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc("vec_id"))
    mined = (met.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= negatives)
             .join(pos, ["anchor", "slot"])
             .join(asked.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor"))
    return mined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                        "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable(table(prepare(spark), sf_dir, "embeddings"), label)
    return hard_negatives(rows, rows.where(F.col("vec_id") % ANCHOR_EVERY == 0))


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same),
n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
  WHERE p.place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
