"""Content reconciliation finds exactly the differing keys, whatever the order and partitioning."""

import random

import pytest
from pyspark.sql import functions as F

from terrace.operators import digests
from terrace.operators.digests import differing_ranges, reconcile_content
from terrace.session import scratch_path
from tests.conftest import rows

DDL = "stamp bigint, id string, a string, b string"


def _found(spark, left, right, **kw):
    l = spark.createDataFrame(left, DDL).repartition(3)
    r = spark.createDataFrame(right, DDL).repartition(5, "a")
    got = reconcile_content(l, r, ["id"], ["id", "a", "b"], "stamp", scratch_path(spark, "ranges"), **kw)
    return sorted((tuple(x[:5]) + (",".join(x.columns_),) for x in got.withColumnRenamed("columns", "columns_").collect()), key=repr)


BASE = [(s, str(i), f"a{i}", None if i % 7 == 0 else f"b{i}") for s in (1, 2) for i in range(300)]


@pytest.mark.parametrize("levels", [(0, 8, 16), (4,), (0, 2, 30)])
def test_one_changed_value_is_found(spark, levels):
    other = [(2, "123", "a123", "changed") if r[:2] == (2, "123") else r for r in BASE]
    assert _found(spark, BASE, other, levels=levels) == [(2, "123", 1, 1, "changed", "b")]
    assert _found(spark, BASE, random.Random(1).sample(BASE, len(BASE)), levels=levels) == []


def test_counts_that_balance_hide_nothing(spark):
    right = [r for r in BASE if r[:2] != (1, "5")] + [(1, "6", "a6", "b6")]        # one gone, one twice
    right = [(2, "9", "a8", "b9") if r[:2] == (2, "9") else (2, "8", "a9", "b8") if r[:2] == (2, "8") else r for r in right]
    right = [(1, "7", "a7", "") if r[:2] == (1, "7") else r for r in right]        # NULL is not empty
    assert _found(spark, BASE, right) == sorted([
        (1, "5", 1, 0, "missing_right", ""), (1, "6", 1, 2, "repeated", ""), (1, "7", 1, 1, "changed", "b"),
        (2, "8", 1, 1, "changed", "a"), (2, "9", 1, 1, "changed", "a")], key=repr)


def test_null_keys_groups_and_empty_sides(spark):
    left = [(None, "1", "x", "y"), (1, None, "x", "y"), (1, None, "x", "z")]
    assert _found(spark, left, left) == []
    assert _found(spark, left, []) == sorted([(1, None, 2, 0, "missing_right", ""), (None, "1", 1, 0, "missing_right", "")], key=repr)
    assert _found(spark, [], left[:1]) == [(None, "1", 0, 1, "missing_left", "")]
    assert _found(spark, [], []) == []
    assert _found(spark, left, [left[0], left[1], (1, None, "x", "w")])[0][4] == "changed"


def test_values_do_not_run_together_and_only_differing_ranges_go_on(spark):
    assert _found(spark, [(1, "k", "ab", "c")], [(1, "k", "a", "bc")]) == [(1, "k", 1, 1, "changed", "a,b")]
    l = digests._hashed(spark.createDataFrame(BASE, DDL), "stamp", ["id"], ["id", "a", "b"])
    r = l.withColumn("_row_hash", F.when((F.col("id") == "50") & (F.col("stamp") == 1), F.lit(0)).otherwise(F.col("_row_hash")))
    assert rows(differing_ranges(l, r, "stamp", 0), "stamp") == [(1,)]
    assert differing_ranges(l, r, "stamp", 16).count() == 1
