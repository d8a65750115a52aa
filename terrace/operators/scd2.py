"""Type-2 history (M3 / O3), order-insensitive and late-data safe.

History is rebuilt from *observations* (every raw row ever seen for a key),
never from compacted versions: with A@1, B@3 (late) and A@5, only the raw
observations still know that A was seen again at 5.

    observations --(prev tracked per key, ordered by effective time)-->
    change points --(next change per key)--> versions [start, end)

A row opens a version when its tracked attributes differ, null-safely
(D11), from the previous observation of the key.  Intervals are half-open
(D7) and come from the observations' effective time, not from the clock
of the load (D9); the first version may open at -infinity (NULL start).
The result is a pure function of the set of observations, so file arrival
order cannot change it (D2, D3).  Observations that share an effective time give
empty versions ``[t, t)`` for all but the last of them; no instant falls into
an empty version, and the temporal joins pass them by.  Both neighbour passes
are hot-key safe (:mod:`terrace.operators.neighbors`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.merge import ACTION
from terrace.operators.neighbors import CHUNK, ROWS_PER_TASK, assign_chunks, neighbors

START = "ts_start_date"
END = "ts_end_date"
ACTIVE = "flag_scd_active"
LAST_SEEN = "ts_last_seen"      # on active versions: the key's latest effective time
FIRST = "_first_version"


def tracked_differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe "any tracked attribute changed" (NULL->x and x->NULL count)."""
    return ~F.struct(*left).eqNullSafe(F.struct(*right))


def scd2_build(observations: DataFrame, keys: Sequence[str], tracked: Sequence[str],
               effective: str, carry: Sequence[str] = (), tie: Sequence[str] | None = None,
               open_start: bool = False, rows_per_task: int = ROWS_PER_TASK,
               rows_bound: int | None = None, with_first: bool = False) -> DataFrame:
    """Versions of every key: keys, tracked, carry, ts_start_date, ts_end_date, flag_scd_active.

    ``carry`` columns are taken from the first observation of each version
    (e.g. its file stamp, which identifies the version for surrogate keys).
    ``tie`` orders observations that share an effective time (default: the
    tracked then carried columns), so the result is deterministic.
    ``rows_bound``: a proven bound of observations per key; a small one saves
    the eager hot-key count.  ``with_first`` keeps the flag of a key's first version.
    """
    keys, tracked, carry = list(keys), list(tracked), list(carry)
    tie = list(tie) if tie is not None else [c for c in tracked + carry if c != effective]
    order = [effective] + [c for c in tie if c != effective]
    cols = list(dict.fromkeys(keys + tracked + carry + order))
    obs = observations.select(*cols)

    # identical observations cannot change the history: copies of a hot key collapse
    obs, chunked = assign_chunks(obs, keys, order, rows_per_task, collapse_copies=True, rows_bound=rows_bound)
    with_prev = neighbors(obs, keys, order, prev=tracked, chunked=chunked)
    changed = (~F.col("prev__exists")) | tracked_differs(
        [F.col(c) for c in tracked], [F.col("prev_" + c) for c in tracked])
    starts = (with_prev.where(changed)
                       .select(*cols, *([CHUNK] if chunked else []),
                               (~F.col("prev__exists")).alias(FIRST)))

    versions = neighbors(starts, keys, order, nxt=[effective], chunked=chunked)
    start = F.col(effective)
    if open_start:
        start = F.when(~F.col(FIRST), start)
    end = F.col("next_" + effective)
    return versions.select(*keys, *tracked, *[c for c in carry if c not in tracked],
                           start.alias(START), end.alias(END), end.isNull().alias(ACTIVE),
                           *([FIRST] if with_first else []))


def with_last_seen(history: DataFrame, observations: DataFrame, keys: Sequence[str],
                   effective: str) -> DataFrame:
    """Add ``ts_last_seen`` to the active versions of a history built from ``observations``."""
    last = observations.groupBy(*keys).agg(F.max(effective).alias("_last"))
    return (history.join(last, list(keys), "left")
            .withColumn(LAST_SEEN, F.when(F.col(ACTIVE), F.col("_last"))).drop("_last"))


def scd2_apply(history: DataFrame, observations: DataFrame, batch: DataFrame, keys: Sequence[str],
               tracked: Sequence[str], effective: str, carry: Sequence[str] = (),
               open_start: bool = False, rows_per_task: int = ROWS_PER_TASK,
               identity: str | None = None, shuffled: bool = False) -> DataFrame:
    """Apply a batch to a history that carries ``ts_last_seen``.

    Keys whose batch is newer than all that was seen of them, and new keys,
    continue from their active version: neither their closed versions nor the
    raw zone are read for them.  Only keys with a late observation are rebuilt
    from ``observations`` (which must include the batch).  Untouched keys and
    closed versions of continued keys pass through.  One small eager job asks
    whether any key is late.

    With ``identity`` (the column that with the keys names a version) every row
    carries ``merge_action``: insert, close, update or noop, and versions that
    vanish come out as ``delete`` rows, to be counted on the write and left out.
    A continued key's actions follow from its rows; only the late keys' old and
    rebuilt versions are compared.

    ``shuffled``: the batch is large, so its joins are shuffled.  Their sides are estimated
    by the size of well compressed files; left to that, whole key sets would be broadcast,
    each through the driver.
    """
    keys, tracked, carry = list(keys), list(tracked), list(carry)
    tie = [c for c in tracked + carry if c != effective]
    side = lambda df: df.hint("merge") if shuffled else df
    active = history.where(F.col(ACTIVE))
    seen = batch.groupBy(*keys).agg(F.min(effective).alias("_lo"), F.max(effective).alias("_hi"))
    touched = seen.join(side(active.select(*keys, F.col(LAST_SEEN).alias("_last"))), keys, "left")
    late = touched.where(F.col("_lo") <= F.col("_last"))
    on = touched.where(F.col("_last").isNull() | (F.col("_lo") > F.col("_last"))).select(*keys)

    cols = list(dict.fromkeys(keys + tracked + carry))
    # columns of the history that no observation has stay with their version
    own = [f for f in history.schema.fields if f.name not in {*cols, START, END, ACTIVE, LAST_SEEN}]
    no_time = F.lit(None).cast(dict(history.dtypes)[START])
    resumed = active.join(side(on), keys, "left_semi").select(
        *cols, *[f.name for f in own], F.col(LAST_SEEN).alias(effective), F.lit(True).alias("_old"),
        F.col(START).alias("_start"))
    fresh = batch.join(side(on), keys, "left_semi").select(
        *cols, *[F.lit(None).cast(f.dataType).alias(f.name) for f in own], F.col(effective),
        F.lit(False).alias("_old"), no_time.alias("_start"))
    built = scd2_build(resumed.unionByName(fresh), keys, tracked, effective,
                       [*carry, *[f.name for f in own], "_old", "_start"], tie,
                       rows_per_task=rows_per_task, with_first=True)
    start = F.when(F.col("_old"), F.col("_start"))
    if open_start:
        start = start.when(F.col(FIRST), no_time)
    kept = F.when(F.col(ACTIVE), F.lit("noop")).otherwise(F.lit("close"))
    action = F.when(F.col("_old"), kept).otherwise(F.lit("insert")).alias(ACTION)
    continued = (built.withColumn(START, start.otherwise(F.col(START))).withColumn(ACTION, action)
                 .drop("_old", "_start", FIRST))
    changed = continued
    if not late.isEmpty():
        rebuilt = scd2_build(observations.join(side(late.select(*keys)), keys, "left_semi"), keys, tracked, effective,
                             carry, tie, open_start, rows_per_task)
        if identity is None:
            rebuilt = rebuilt.withColumn(ACTION, F.lit("update"))
        else:
            before = history.join(side(late.select(*keys)), keys, "left_semi")
            rebuilt = scd2_changes(side(before), rebuilt, keys, identity, tracked, with_noop=True,
                                   keep=[f.name for f in own]).withColumnRenamed("change_kind", ACTION)
        changed = changed.unionByName(rebuilt, allowMissingColumns=True)
    last = touched.select(*keys, F.greatest("_last", "_hi").alias("_seen"))
    changed = (changed.join(side(last), keys)
               .withColumn(LAST_SEEN, F.when(F.col(ACTIVE), F.col("_seen"))).drop("_seen"))
    passed = history.join(side(touched.select(*keys)), keys, "left_anti").unionByName(
        history.where(~F.col(ACTIVE)).join(side(on), keys, "left_semi")).withColumn(ACTION, F.lit("noop"))
    out = passed.unionByName(changed)
    return out if identity is not None else out.drop(ACTION)


def scd2_rebuild_touched(history: DataFrame, observations: DataFrame, batch: DataFrame,
                         keys: Sequence[str], tracked: Sequence[str], effective: str,
                         carry: Sequence[str] = (), tie: Sequence[str] | None = None,
                         open_start: bool = False, rows_per_task: int = ROWS_PER_TASK,
                         rows_bound: int | None = None) -> DataFrame:
    """Apply a batch (possibly late) to an existing history.

    Keys present in ``batch`` are rebuilt from all their observations
    (``observations`` must already include the batch: the append-only raw
    zone); every other key's versions pass through untouched.  Both sides
    are cut by the touched keys with semi/anti joins, so the rebuild costs
    only what the batch touches.
    """
    keys = list(keys)
    touched = batch.select(*keys).distinct()
    rebuilt = scd2_build(observations.join(touched, keys, "left_semi"), keys, tracked,
                         effective, carry, tie, open_start, rows_per_task, rows_bound)
    kept = history.join(touched, keys, "left_anti")
    return kept.unionByName(rebuilt)


def changed_rows(incoming: DataFrame, active: DataFrame, keys: Sequence[str],
                 tracked: Sequence[str], version: str) -> DataFrame:
    """Incoming rows newer than the key's active version with a tracked change.

    ``active`` holds one active version per key with its ``version`` stamp.
    """
    keys = list(keys)
    cur = active.select(*keys, *[F.col(c).alias("_cur_" + c) for c in list(tracked) + [version]])
    joined = incoming.join(cur, keys, "inner")
    cond = (F.col(version) > F.col("_cur_" + version)) & tracked_differs(
        [F.col(c) for c in tracked], [F.col("_cur_" + c) for c in tracked])
    return joined.where(cond).select(*incoming.columns)


def scd2_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], identity: str,
                 tracked: Sequence[str] = (), with_noop: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """What a merge applies to go from history ``old`` to ``new``.

    ``insert``: a version absent from ``old``; ``delete``: a version that
    vanished (a late file can make it redundant); ``update``: a version whose
    start (a late earlier file) or tracked attributes changed; ``close``: a
    version of which only the end or active flag changed.  Versions are
    identified by ``keys`` + ``identity`` (the first observation's stamp).
    Applying the rows to ``old`` gives ``new``.  ``with_noop`` adds the versions
    that stay as they are; ``keep`` are columns that only ``old`` has.
    """
    ident, state = list(keys) + [identity], [START, *tracked]
    o = old.select(*ident, *keep, *[F.col(c).alias("_old_" + c) for c in [*state, END, ACTIVE]])
    joined = new.join(o, ident, "full_outer")
    moved = tracked_differs([F.col(c) for c in state], [F.col("_old_" + c) for c in state])
    ended = ~F.col(END).eqNullSafe(F.col("_old_" + END)) | (F.col(ACTIVE) != F.col("_old_" + ACTIVE))
    kind = (F.when(F.col("_old_" + ACTIVE).isNull(), F.lit("insert"))
             .when(F.col(ACTIVE).isNull(), F.lit("delete"))
             .when(moved, F.lit("update")).when(ended, F.lit("close")))
    if with_noop:
        kind = kind.otherwise(F.lit("noop"))
    return joined.withColumn("change_kind", kind).where(F.col("change_kind").isNotNull()) \
                 .drop(*["_old_" + c for c in [*state, END, ACTIVE]])


def scd2_metrics(old: DataFrame, new: DataFrame, keys: Sequence[str], identity: str,
                 tracked: Sequence[str] = ()) -> DataFrame:
    """One row of merge metrics of a type-2 merge (M4): changed versions count as updated."""
    changes = scd2_changes(old, new, keys, identity, tracked)
    n = lambda *kinds: F.count_if(F.col("change_kind").isin(*kinds)).cast("bigint")
    return changes.agg(F.count(F.lit(1)).cast("bigint").alias("num_affected_rows"),
                       n("close", "update").alias("num_updated_rows"),
                       n("delete").alias("num_deleted_rows"), n("insert").alias("num_inserted_rows"))
