"""Table-change operators on plain Parquet snapshots (M1, M2, M4, O2).

Parquet has no ``MERGE INTO``; a merge here is a pure function
``(target snapshot, source batch) -> new snapshot`` that the caller writes
to a fresh version directory.  Each result row carries ``merge_action``
(``insert`` / ``update`` / ``noop``) so the metrics come from the same pass
that writes (``DataFrame.observe``), not from a second scan.

A target snapshot has one row per key (every merge result and every
``latest_per_key`` result has).  The target is only joined to the batch, which
is first reduced to one row per key: it is never ranked or sorted as a whole,
and when the batch is small enough to broadcast it is not shuffled either.

A batch row with a NULL in its key names no row: it is left out of the merge
(``unkeyed`` gives these rows, to be stored and counted).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.dedupe import latest_per_key, orderable_columns

ACTION = "merge_action"


def has_key(keys: Sequence[str]) -> Column:
    """No part of the key is NULL."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(has_key(keys))


def unkeyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that a merge leaves out because part of their key is NULL."""
    return df.where(~has_key(keys))


def _reduced(source: DataFrame, cols: Sequence[str], keys: Sequence[str], version: str,
             tie_breakers: Sequence[str]) -> DataFrame:
    """One row per key: the partial WindowGroupLimit runs before the shuffle, so a
    hot key in the batch ships one row per task."""
    return latest_per_key(keyed(source.select(*cols), keys), keys, version, tie_breakers)


def _inserts(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key the target lacks.  The target gives only its keys, and
    only those that the batch has."""
    known = target.select(*keys).join(batch.select(*keys), keys, "left_semi")
    return batch.join(known, keys, "left_anti")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], version: str,
                 tie_breakers: Sequence[str] | None = None, with_action: bool = False) -> DataFrame:
    """Newer-wins upsert.

    A source row replaces the target row of its key only when its
    ``version`` is strictly greater (the target wins ties), so replaying a
    batch or applying an older (late) file is a no-op (D10: the stamp is
    carried by the update).  Keys absent from the source pass through;
    keys absent from the target are inserted.  Duplicate source rows of a
    key resolve by version, then by every other column (D4).
    """
    keys, cols = list(keys), target.columns
    if tie_breakers is None:
        tie_breakers = orderable_columns(target, exclude=keys + [version])
    batch = _reduced(source, cols, keys, version, tie_breakers)
    new = batch.select(*keys, F.struct(*cols).alias("_new"))
    newer = F.col("_new").isNotNull() & F.col("_new")[version].isNotNull() & (
        F.col(version).isNull() | (F.col("_new")[version] > F.col(version)))
    joined = target.join(new, keys, "left").withColumn("_newer", newer)
    kept = joined.select(*[c if c in keys else F.when(F.col("_newer"), F.col("_new")[c]).otherwise(F.col(c)).alias(c)
                           for c in cols],
                         F.when(F.col("_newer"), F.lit("update")).otherwise(F.lit("noop")).alias(ACTION))
    out = kept.unionByName(_inserts(target, batch, keys).select(*cols, F.lit("insert").alias(ACTION)))
    return out if with_action else out.drop(ACTION)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str], version: str,
                      tie_breakers: Sequence[str] | None = None,
                      with_action: bool = False) -> DataFrame:
    """First write wins (M2): insert source keys the target lacks, never update.

    The target passes through as it is; a new key gets its latest source row.
    """
    keys, cols = list(keys), target.columns
    if tie_breakers is None:
        tie_breakers = orderable_columns(target, exclude=keys + [version])
    batch = _reduced(source, cols, keys, version, tie_breakers)
    out = target.select(*cols, F.lit("noop").alias(ACTION)).unionByName(
        _inserts(target, batch, keys).select(*cols, F.lit("insert").alias(ACTION)))
    return out if with_action else out.drop(ACTION)


def merge_metrics(merged: DataFrame, insert_only: bool = False) -> DataFrame:
    """One row: num_affected_rows, num_updated_rows, num_deleted_rows, num_inserted_rows (M4).

    Insert-only merges report NULL for the three counts they do not
    track, like the reference audit rows.
    """
    ins = F.sum(F.when(F.col(ACTION) == "insert", 1).otherwise(0)).cast("bigint")
    upd = F.sum(F.when(F.col(ACTION) == "update", 1).otherwise(0)).cast("bigint")
    null = F.lit(None).cast("bigint")
    if insert_only:
        return merged.agg(null.alias("num_affected_rows"), null.alias("num_updated_rows"),
                          null.alias("num_deleted_rows"), ins.alias("num_inserted_rows"))
    return merged.agg((ins + upd).alias("num_affected_rows"), upd.alias("num_updated_rows"),
                      F.lit(0).cast("bigint").alias("num_deleted_rows"), ins.alias("num_inserted_rows"))
