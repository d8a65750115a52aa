"""Latest-per-key and merge operators: D4, D10, M1, M2, M4, idempotence."""

from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.operators.dedupe import latest_per_key
from terrace.operators.merge import merge_insert_only, merge_metrics, merge_upsert
from tests.conftest import rows

SCHEMA = "k string, v bigint, payload string"


def test_latest_per_key_picks_newest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], SCHEMA)
    assert rows(latest_per_key(df, ["k"], "v")) == [("a", 3, "y"), ("b", 2, "z")]


def test_tie_has_same_winner_under_any_partitioning(spark):
    # Same key and stamp, two payloads
    data = [("a", 5, "p2"), ("a", 5, "p1"), ("a", 4, "p0")]
    winners = set()
    for n in (1, 2, 3, 7):
        df = spark.createDataFrame(data, SCHEMA).repartition(n)
        winners.add(tuple(rows(latest_per_key(df, ["k"], "v"))))
    for order in (data, data[::-1]):
        winners.add(tuple(rows(latest_per_key(spark.createDataFrame(order, SCHEMA), ["k"], "v"))))
    assert winners == {(("a", 5, "p1"),)}


def test_latest_plan_limits_before_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    plan = latest_per_key(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    # map-side top-1: a hot key ships at most one row per task
    assert plan.count("WindowGroupLimit") >= 2


def test_upsert_newer_wins_and_inserts(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 1, "keep")], SCHEMA)
    source = spark.createDataFrame([("a", 2, "new"), ("c", 1, "ins")], SCHEMA)
    out = merge_upsert(target, source, ["k"], "v", with_action=True)
    assert rows(out) == [("a", 2, "new", "update"), ("b", 1, "keep", "noop"),
                         ("c", 1, "ins", "insert")]
    m = merge_metrics(out).first()
    assert (m.num_affected_rows, m.num_updated_rows, m.num_deleted_rows, m.num_inserted_rows) == (2, 1, 0, 1)


def test_stale_upsert_is_ignored(spark):
    # t1 insert, t3 update, t2 late -> t3 payload kept
    t1 = spark.createDataFrame([("k", 1, "t1")], SCHEMA)
    after_t3 = merge_upsert(t1, spark.createDataFrame([("k", 3, "t3")], SCHEMA), ["k"], "v")
    after_t2 = merge_upsert(after_t3, spark.createDataFrame([("k", 2, "t2")], SCHEMA), ["k"], "v")
    assert rows(after_t2) == [("k", 3, "t3")]


def test_equal_version_keeps_target(spark):
    target = spark.createDataFrame([("k", 5, "target")], SCHEMA)
    source = spark.createDataFrame([("k", 5, "aaa-source")], SCHEMA)
    assert rows(merge_upsert(target, source, ["k"], "v")) == [("k", 5, "target")]


def test_insert_only_never_updates(spark):
    target = spark.createDataFrame([("a", 1, "first")], SCHEMA)
    source = spark.createDataFrame([("a", 9, "later"), ("b", 1, "b1"), ("b", 2, "b2")], SCHEMA)
    out = merge_insert_only(target, source, ["k"], "v", with_action=True)
    assert rows(out) == [("a", 1, "first", "noop"), ("b", 2, "b2", "insert")]
    m = merge_metrics(out, insert_only=True).first()
    assert m.num_inserted_rows == 1 and m.num_updated_rows is None


batch = st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 5), st.sampled_from(["x", "y", "z"])),
                 min_size=0, max_size=8)


@settings(max_examples=15, deadline=None)
@given(t=batch, s=batch)
def test_upsert_is_idempotent(spark, t, s):
    target = latest_per_key(spark.createDataFrame(t, SCHEMA), ["k"], "v")
    source = spark.createDataFrame(s, SCHEMA)
    once = merge_upsert(target, source, ["k"], "v")
    twice = merge_upsert(once, source, ["k"], "v")
    assert rows(once) == rows(twice)
    # newer-wins equals latest over everything seen, target first on ties
    assert {r[0] for r in rows(once)} == {r[0] for r in t} | {r[0] for r in s}


@settings(max_examples=10, deadline=None)
@given(t=batch, s=batch)
def test_insert_only_is_idempotent_and_keeps_target(spark, t, s):
    target = latest_per_key(spark.createDataFrame(t, SCHEMA), ["k"], "v")
    source = spark.createDataFrame(s, SCHEMA)
    once = merge_insert_only(target, source, ["k"], "v")
    assert rows(merge_insert_only(once, source, ["k"], "v")) == rows(once)
    kept = {r[0]: r for r in rows(target)}
    for r in rows(once):
        if r[0] in kept:
            assert r == kept[r[0]]


def test_merge_reads_the_target_without_ranking_it(spark, tmp_path):
    spark.range(5000).selectExpr("cast(id as string) k", "id v", "'x' payload").write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    batch = spark.createDataFrame([("1", 9999, "new"), ("z", 1, "ins"), (None, 1, "keyless")], SCHEMA)
    for merge, updated in ((merge_upsert, 1), (merge_insert_only, 0)):
        out = merge(target, batch, ["k"], "v", with_action=True)
        assert out.count() == 5001
        assert rows(out.groupBy("merge_action").count()) == sorted(
            [("insert", 1), ("noop", 5000 - updated)] + [("update", 1)] * updated)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        scan_of_target = [i for i, line in enumerate(plan.splitlines()) if "[k#" in line and "parquet" in line]
        window = [i for i, line in enumerate(plan.splitlines()) if "Window" in line]
        assert scan_of_target and window
        # windows stand above the batch only: no scan of the target lies below one
        lines = plan.splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        for w in window:
            below = next((i for i in range(w + 1, len(lines)) if depth(lines[i]) <= depth(lines[w])), len(lines))
            assert not any(w < t < below for t in scan_of_target)
