"""Previous / next row within a key, safe for hot keys.

``lag``/``lead`` over ``Window.partitionBy(key)`` put every row of a key in
one task; a key holding a third of the table would then be one task.  Keys
whose row count exceeds ``rows_per_task`` are therefore cut into contiguous
*chunks* of their full order tuple: the rows of hot keys are range-partitioned
by (keys, order) into about ``2 N / rows_per_task`` ranges, and a row's range
number is its chunk.  Any orderable type works, NULL keys included, and rows
that share the first ordering value still fall into different chunks.  The
window runs per ``(key, chunk)``, and the first/last row of every chunk is
patched from a per-chunk summary (each chunk's first and last row, then
``lag``/``lead`` over the chunks of the key) of at most one row per chunk and
hot key.

Chunked rows are written to the shared folder once, so that every use of
them sees the same cuts.  Ordinary keys carry chunk ``-1``.  Joins carry no
hints: Spark broadcasts the small tables when their measured size allows.
One eager count decides whether any key is hot; a caller that can prove a
bound of rows per key passes it and saves the count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.session import scratch_path

CHUNK = "_chunk"
# Rows one window task may hold for a single key (sized for executor memory).
ROWS_PER_TASK = 4_000_000


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def null_safe(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Equality of key tuples in which NULL equals NULL."""
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & a.eqNullSafe(b)
    return cond


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and their counts: at most ``N / rows_per_task`` rows."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > F.lit(rows_per_task)))


def _hot_rows(df: DataFrame, keys: Sequence[str], rows_per_task: int) -> int:
    """Rows of hot keys (an eager partial aggregate over the key columns)."""
    return hot_keys(df, keys, rows_per_task).agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]


def assign_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str,
                  rows_per_task: int = ROWS_PER_TASK, collapse_copies: bool = False,
                  rows_bound: int | None = None) -> tuple[DataFrame, bool]:
    """Add ``_chunk`` (-1 ordinary keys, ordered range numbers for hot keys) when any key is hot.

    ``order``: the full order within a key.  ``rows_bound``: a proven bound
    of rows per key; at or under ``rows_per_task`` it decides without a count.
    Without a hot key the frame is returned unchanged and ``False``.

    ``collapse_copies`` (for callers to whom identical rows are redundant):
    when a hot key exists, exact copies are collapsed first with
    ``distinct()`` - combined map-side, so a hot group of copies ships one
    row per task - and the check is repeated on the result.
    """
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    if rows_bound is not None and rows_bound <= rows_per_task:
        return df, False
    n = _hot_rows(df, keys, rows_per_task)
    if n and collapse_copies:
        df = df.distinct()
        n = _hot_rows(df, keys, rows_per_task)
    if not n:
        return df, False
    hot = hot_keys(df, keys, rows_per_task).select(*[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)],
                                                   F.lit(True).alias("_hot"))
    names = [f"_hot_{i}" for i in range(len(keys))]
    flagged = df.join(hot, null_safe([F.col(k) for k in keys], [F.col(h) for h in names]), "left")
    ranges = 2 * -(-n // rows_per_task)
    cut = (flagged.where(F.col("_hot")).select(*df.columns)
           .repartitionByRange(ranges, *[F.col(c).asc_nulls_first() for c in keys + order])
           .withColumn(CHUNK, F.spark_partition_id().cast("long")))
    rest = flagged.where(F.col("_hot").isNull()).select(*df.columns, F.lit(-1).cast("long").alias(CHUNK))
    return rest.unionByName(_stored(cut, "chunks")), True


def _patched(rows: DataFrame, fix: DataFrame, part: Sequence[str]) -> DataFrame:
    """Left join of per-chunk values, NULL keys included."""
    names = [f"_fix_{i}" for i in range(len(part))]
    renamed = fix.withColumnsRenamed(dict(zip(part, names)))
    cond = null_safe([F.col(c) for c in part], [F.col(n) for n in names])
    return rows.join(renamed, cond, "left").drop(*names)


def neighbors(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              prev: Sequence[str] = (), nxt: Sequence[str] = (), chunked: bool = False,
              prev_prefix: str = "prev_", next_prefix: str = "next_") -> DataFrame:
    """Add ``prev_<c>`` / ``next_<c>`` plus ``prev__exists`` / ``next__exists`` flags.

    ``order`` must be a total order within a key.  With ``chunked`` the
    frame carries ``_chunk`` from :func:`assign_chunks` over the same keys
    and order.
    """
    part = list(keys) + ([CHUNK] if chunked else [])
    w = Window.partitionBy(*part).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    added = {prev_prefix + c: F.lag(c).over(w) for c in prev}
    added.update({next_prefix + c: F.lead(c).over(w) for c in nxt})
    added[prev_prefix + "_exists"] = F.lag(F.lit(True)).over(w).isNotNull()
    added[next_prefix + "_exists"] = F.lead(F.lit(True)).over(w).isNotNull()
    out = df.withColumns(added)
    if not chunked:
        return out

    # Hot keys only: each chunk's first and last row, then the neighbouring
    # chunks' boundary rows via lag/lead over the chunks of the key.
    order_struct = F.struct(*[F.col(c) for c in order])
    first_vals = F.struct(*[F.col(c) for c in nxt], F.lit(True).alias("_e"))
    last_vals = F.struct(*[F.col(c) for c in prev], F.lit(True).alias("_e"))
    summary = (df.where(F.col(CHUNK) >= 0)
                 .groupBy(*part)
                 .agg(F.min_by(first_vals, order_struct).alias("_first"),
                      F.max_by(last_vals, order_struct).alias("_last")))
    wc = Window.partitionBy(*keys).orderBy(CHUNK)
    fix = summary.select(*part,
                         F.lag("_last").over(wc).alias("_prev_chunk_last"),
                         F.lead("_first").over(wc).alias("_next_chunk_first"))
    out = _patched(out, fix, part)
    is_first = ~F.col(prev_prefix + "_exists")
    is_last = ~F.col(next_prefix + "_exists")
    patched = {prev_prefix + c: F.when(is_first, F.col("_prev_chunk_last")[c])
               .otherwise(F.col(prev_prefix + c)) for c in prev}
    patched.update({next_prefix + c: F.when(is_last, F.col("_next_chunk_first")[c])
                    .otherwise(F.col(next_prefix + c)) for c in nxt})
    patched[prev_prefix + "_exists"] = (F.col(prev_prefix + "_exists")
                                        | F.col("_prev_chunk_last._e").isNotNull())
    patched[next_prefix + "_exists"] = (F.col(next_prefix + "_exists")
                                        | F.col("_next_chunk_first._e").isNotNull())
    return out.withColumns(patched).drop("_prev_chunk_last", "_next_chunk_first")


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                 out: str, chunked: bool = False) -> DataFrame:
    """``out`` = the last non-NULL ``value`` at or before each row within its key.

    With ``chunked`` (frame from :func:`assign_chunks`) the fill runs per
    ``(key, chunk)``; rows whose chunk has no value yet take the last value
    of the earlier chunks from a per-chunk summary (bounded, broadcast).
    """
    part = list(keys) + ([CHUNK] if chunked else [])
    order_cols = [F.col(c).asc_nulls_first() for c in order]
    w = (Window.partitionBy(*part).orderBy(*order_cols)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = df.withColumn(out, F.last(value, ignorenulls=True).over(w))
    if not chunked:
        return filled
    order_struct = F.struct(*[F.col(c) for c in order])
    summary = (df.where((F.col(CHUNK) >= 0) & F.col(value).isNotNull())
                 .groupBy(*part).agg(F.max_by(value, order_struct).alias("_chunk_last")))
    earlier = (Window.partitionBy(*keys).orderBy(CHUNK)
               .rowsBetween(Window.unboundedPreceding, -1))
    # chunks that hold no value still need the carry: index every hot chunk
    chunks = df.where(F.col(CHUNK) >= 0).select(*part).distinct()
    carry = (_patched(chunks, summary.select(*part, "_chunk_last"), part)
                   .select(*part, F.last("_chunk_last", ignorenulls=True).over(earlier).alias("_carry")))
    return (_patched(filled, carry, part)
                  .withColumn(out, F.coalesce(F.col(out), F.col("_carry")))
                  .drop("_carry"))
