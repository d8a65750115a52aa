"""Trusted-zone flows: raw observations -> typed, deduplicated, merged snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.operators.dedupe import latest_per_key
from terrace.operators.merge import merge_insert_only, merge_upsert
from terrace.operators.scd2 import scd2_apply, scd2_build, scd2_rebuild_touched, with_last_seen
from terrace.schema import CUSTOMERS, REF_DAY, REF_FILE

CUSTOMER_CARRY = [REF_DAY, REF_FILE, "customer_unique_id"]
EFFECTIVE = "ts_effective"


def trusted_columns(entity) -> list[str]:
    return [REF_DAY, REF_FILE] + entity.trusted_columns


def _ties(entity) -> list[str]:
    return [c for c in trusted_columns(entity) if c != REF_FILE and c not in entity.keys]


def before(obs: DataFrame, stamp: int) -> DataFrame:
    return obs.where(F.col(REF_FILE) < F.lit(stamp))


def from_(obs: DataFrame, stamp: int) -> DataFrame:
    return obs.where(F.col(REF_FILE) >= F.lit(stamp))


def snapshot(obs: DataFrame, entity) -> DataFrame:
    """Latest observation of every key of ``entity``."""
    return latest_per_key(obs.select(*trusted_columns(entity)), list(entity.keys), REF_FILE)


def upsert(target: DataFrame, batch: DataFrame, entity, with_action: bool = False, extra=()) -> DataFrame:
    """``extra`` columns of both sides follow their row and break no ties."""
    cols = trusted_columns(entity)
    return merge_upsert(target.select(*cols, *extra), batch.select(*cols, *extra), list(entity.keys), REF_FILE,
                        tie_breakers=_ties(entity), with_action=with_action)


def insert_only(target: DataFrame, batch: DataFrame, entity, with_action: bool = False, extra=()) -> DataFrame:
    cols = trusted_columns(entity)
    return merge_insert_only(target.select(*cols, *extra), batch.select(*cols, *extra), list(entity.keys),
                             REF_FILE, tie_breakers=_ties(entity), with_action=with_action)


def customer_history(obs: DataFrame, **kw) -> DataFrame:
    """Type-2 customers: tracked zip/city/state, first version open at -infinity."""
    return scd2_build(obs, CUSTOMERS.keys, CUSTOMERS.tracked, EFFECTIVE, carry=CUSTOMER_CARRY,
                      open_start=True, **kw)


def customer_history_late(history: DataFrame, all_obs: DataFrame, batch: DataFrame, **kw) -> DataFrame:
    return scd2_rebuild_touched(history, all_obs, batch, CUSTOMERS.keys, CUSTOMERS.tracked,
                                EFFECTIVE, carry=CUSTOMER_CARRY, open_start=True, **kw)


def customer_history_seen(obs: DataFrame) -> DataFrame:
    """The history with each key's latest effective time on its active version."""
    return with_last_seen(customer_history(obs), obs, CUSTOMERS.keys, EFFECTIVE)


def customer_history_next(history: DataFrame, all_obs: DataFrame, batch: DataFrame,
                          identity: str | None = None, shuffled: bool = False) -> DataFrame:
    return scd2_apply(history, all_obs, batch, CUSTOMERS.keys, CUSTOMERS.tracked, EFFECTIVE,
                      carry=CUSTOMER_CARRY, open_start=True, identity=identity, shuffled=shuffled)
