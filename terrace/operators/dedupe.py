"""Latest row per key.

``row_number() over (partition by keys order by version desc, <tie-breakers>) = 1``.
Catalyst plans the ``= 1`` filter as a partial ``WindowGroupLimit`` before
the shuffle and a final one after it, so each map task ships at most one
row per key: a key holding a third of all rows costs the same shuffle as
any other key.  The order is always total (D4): without explicit
tie-breakers every remaining orderable column breaks ties, so the winner
does not depend on partitioning or file order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

RANK_COL = "_rank"


def orderable_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, (MapType, VariantType))
            and not _contains_map(f.dataType)]


def _contains_map(t) -> bool:
    if isinstance(t, MapType):
        return True
    if isinstance(t, ArrayType):
        return _contains_map(t.elementType)
    if isinstance(t, StructType):
        return any(_contains_map(f.dataType) for f in t.fields)
    return False


def total_order(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str],
                tie_breakers: Sequence[str] | None = None,
                first: Sequence[Column] = ()) -> list[Column]:
    """``first`` columns, then ``newest_first`` descending, then tie-breakers ascending."""
    order = list(first) + [F.col(c).desc_nulls_last() for c in newest_first]
    if tie_breakers is None:
        tie_breakers = orderable_columns(df, exclude=list(keys) + list(newest_first))
    order += [F.col(c).asc_nulls_first() for c in tie_breakers]
    return order


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str] | str,
                   tie_breakers: Sequence[str] | None = None,
                   first: Sequence[Column] = ()) -> DataFrame:
    """Keep the newest row of every key."""
    if isinstance(newest_first, str):
        newest_first = [newest_first]
    order = total_order(df, keys, newest_first, tie_breakers, first)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(RANK_COL, F.row_number().over(w))
              .where(F.col(RANK_COL) == 1)
              .drop(RANK_COL))
