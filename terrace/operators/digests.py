"""Content reconciliation by order-free digests that narrow to the differing rows.

Counts balance even when values differ.  Here each side is summarised per group
(file stamp) and range of key hashes by its count and the sum and exclusive-or of
its row digests: neither depends on order or partitioning, and both see a
changed, missing, added or repeated row.  Only ranges whose summaries differ
are cut finer, down to ``LEVELS[-1]`` bits, and only their rows are joined.  So equal
tables cost one aggregation a side, and one changed value costs a few narrow reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.sources.snapshots import write_snapshot

LEVELS = (0, 8, 16)          # bits of the key hash that name a range, by step
RANGE = "_range"
_KEY, _ROW = "_key_hash", "_row_hash"


def row_digest(columns: Sequence[str]) -> Column:
    """64-bit digest of a row's values; NULL differs from empty, and values do not run together."""
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("null")))
    return F.xxhash64(F.concat_ws("|", *parts))


def _hashed(df: DataFrame, group: str, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.select(group, *dict.fromkeys([*keys, *columns]), row_digest(keys).alias(_KEY),
                     row_digest(columns).alias(_ROW))


def _at(bits: int) -> Column:
    return F.lit(0).cast("bigint") if bits == 0 else F.shiftrightunsigned(_KEY, 64 - bits)


def digests(hashed: DataFrame, group: str, bits: int, side: str) -> DataFrame:
    """One row per group and key range: count, sum and exclusive-or of the row digests."""
    return hashed.withColumn(RANGE, _at(bits)).groupBy(group, RANGE).agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col(_ROW).cast("decimal(20,0)")).alias("sum"),
                 F.bit_xor(_ROW).alias("xor")).alias(side))


def differing_ranges(left: DataFrame, right: DataFrame, group: str, bits: int) -> DataFrame:
    """(group, range) whose digests differ, or which one side lacks."""
    l = digests(left, group, bits, "_l")
    r = digests(right, group, bits, "_r").select(F.col(group).alias("_g"), F.col(RANGE).alias("_b"), "_r")
    on = F.col(group).eqNullSafe(F.col("_g")) & (F.col(RANGE) == F.col("_b"))
    return (l.join(r, on, "full_outer").where(~F.col("_l").eqNullSafe(F.col("_r")))
            .select(F.coalesce(group, "_g").alias(group), F.coalesce(RANGE, "_b").alias(RANGE)))


def _within(hashed: DataFrame, group: str, ranges: DataFrame, bits: int) -> DataFrame:
    keep = ranges.select(F.col(group).alias("_g"), F.col(RANGE).alias("_b"))
    return hashed.withColumn(RANGE, _at(bits)).join(
        keep, F.col(group).eqNullSafe(F.col("_g")) & (F.col(RANGE) == F.col("_b")), "left_semi").drop(RANGE)


def reconcile_content(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str],
                      group: str, scratch: str, levels: Sequence[int] = LEVELS) -> DataFrame:
    """Keys whose rows differ between the sides: group, keys, nu_left, nu_right, difference, columns.

    ``difference`` is missing_right, missing_left, repeated (the same rows, other numbers of them)
    or changed; ``columns`` lists, for one row on both sides, what changed.  Empty where the sides
    hold the same rows.  ``scratch`` is a shared folder for the ranges of each step.
    """
    l, r = _hashed(left, group, keys, columns), _hashed(right, group, keys, columns)
    for bits in levels:
        ranges = write_snapshot(differing_ranges(l, r, group, bits), f"{scratch}/bits={bits}")
        if ranges.isEmpty():
            return _differences(l.limit(0), r.limit(0), keys, columns, group)
        l, r = _within(l, group, ranges, bits), _within(r, group, ranges, bits)
    return _differences(l, r, keys, columns, group)


def _differences(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 group: str) -> DataFrame:
    values = [c for c in columns if c not in keys and c != group]
    ident = [group, *keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        # one row per key: the smallest row stands for several (a key has one, unless a side repeats it)
        return df.groupBy(*ident).agg(
            F.count(F.lit(1)).alias(f"nu_{name}"), F.sum(F.col(_ROW).cast("decimal(20,0)")).alias(f"_sum_{name}"),
            F.min(_ROW).alias(f"_lo_{name}"), F.max(_ROW).alias(f"_hi_{name}"),
            F.min(F.struct(*values) if values else F.lit(0)).alias(f"_{name}"))

    l, r = side(left, "left"), side(right, "right").withColumnsRenamed({c: "_r_" + c for c in ident})
    on = F.lit(True)
    for c in ident:
        on = on & F.col(c).eqNullSafe(F.col("_r_" + c))
    j = l.join(r, on, "full_outer")
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    equal = ((F.col("nu_left") == F.col("nu_right")) & (F.col("_sum_left") == F.col("_sum_right"))
             & (F.col("_lo_left") == F.col("_lo_right")) & (F.col("_hi_left") == F.col("_hi_right")))
    one_row = (F.col("_lo_left") == F.col("_hi_left")) & (F.col("_lo_left") == F.col("_lo_right")) \
        & (F.col("_lo_right") == F.col("_hi_right"))
    kind = (F.when(F.col("nu_right").isNull(), "missing_right").when(F.col("nu_left").isNull(), "missing_left")
            .when(one_row, "repeated").otherwise("changed"))
    single = (F.col("nu_left") == 1) & (F.col("nu_right") == 1)
    changed = F.array_compact(F.array(*[
        F.when(single & ~F.col("_left")[c].eqNullSafe(F.col("_right")[c]), F.lit(c)) for c in values])) \
        if values else F.array().cast("array<string>")
    return j.where(~F.coalesce(equal, F.lit(False))).select(
        *[F.coalesce(c, "_r_" + c).alias(c) for c in ident], n("nu_left"), n("nu_right"), kind.alias("difference"),
        changed.alias("columns"))
