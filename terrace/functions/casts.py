"""Typing layer: string landing columns -> typed trusted columns.

Every cast is a ``try_cast`` so a malformed value becomes NULL instead of
failing the job (ANSI mode raises on ``cast``); a value that was present
before the cast and is NULL after it is a *reject* and is counted.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.schema import Entity

# Wall-clock timestamps without zone: the whole lake uses TIMESTAMP_NTZ.
_TYPE_ALIASES = {"timestamp": "timestamp_ntz", "long": "bigint", "integer": "int"}


def spark_type(name: str) -> str:
    return _TYPE_ALIASES.get(name, name)


def typed(col: str | Column, type_name: str) -> Column:
    """Never-failing cast; empty strings are absent values, not rejects."""
    c = F.col(col) if isinstance(col, str) else col
    if type_name != "string":
        c = F.when(F.trim(c) != F.lit(""), c)
    return c.try_cast(spark_type(type_name))


def is_reject(source: str | Column, target: Column) -> Column:
    """True when a non-empty source value did not survive the cast."""
    s = F.col(source) if isinstance(source, str) else source
    return s.isNotNull() & (F.trim(s) != F.lit("")) & target.isNull()


def typed_projection(df: DataFrame, entity: Entity,
                     carry: Iterable[str] = (), reject_col: str | None = None) -> DataFrame:
    """Rename + cast the landing columns of ``entity``.

    ``carry`` columns (lineage stamps) pass through unchanged; columns not
    named in the entity's typed list (e.g. ``seller_id``) are dropped.
    With ``reject_col`` an int column counting the failed casts of the row
    is added, to be summed by ``DataFrame.observe`` on the write.
    """
    out = [F.col(c) for c in carry]
    rejects = []
    for src, dst, t in entity.typed:
        tc = typed(src, t)
        out.append(tc.alias(dst))
        if t != "string":
            rejects.append(is_reject(src, tc).cast("int"))
    if reject_col:
        total = F.lit(0)
        for r in rejects:
            total = total + r
        out.append(total.alias(reject_col))
    return df.select(*out)


def stamp_to_timestamp(stamp: str | Column) -> Column:
    """14-digit ``yyyyMMddHHmmss`` bigint stamp -> TIMESTAMP_NTZ."""
    s = F.col(stamp) if isinstance(stamp, str) else stamp
    return F.to_timestamp_ntz(s.cast("string"), F.lit("yyyyMMddHHmmss"))


def timestamp_to_stamp(ts: str | Column) -> Column:
    """TIMESTAMP -> 14-digit bigint stamp ``yyyyMMddHHmmss`` (the file-name stamp).

    Integer arithmetic on the date fields: same value as formatting and
    parsing the text, without a formatter call per row.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    stamp = F.year(t).cast("bigint")
    for part in (F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.second(t)):
        stamp = stamp * 100 + part
    return stamp

