"""Type-2 history: D1, D2, D3, D11, late re-observation, order insensitivity, hot keys."""

import datetime as dt
import itertools

from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.operators.scd2 import changed_rows, scd2_build, scd2_rebuild_touched
from tests.conftest import rows

OBS = "k string, city string, ts timestamp_ntz, stamp bigint"


def T(d):
    return dt.datetime(2020, 1, d)


def build(spark, data, **kw):
    df = spark.createDataFrame(data, OBS)
    return scd2_build(df, ["k"], ["city"], "ts", carry=["stamp"], **kw)


def hist(df):
    return rows(df, "k", "city", "ts_start_date", "ts_end_date", "flag_scd_active")


def test_new_key_is_active(spark):
    # D1
    assert hist(build(spark, [("k1", "A", T(1), 1)])) == [("k1", "A", T(1), None, True)]


def test_late_file_splits_history(spark):
    # A@1, C@3, then B@2 late
    h = hist(build(spark, [("k", "A", T(1), 1), ("k", "C", T(3), 3), ("k", "B", T(2), 2)]))
    assert h == [("k", "A", T(1), T(2), False), ("k", "B", T(2), T(3), False),
                 ("k", "C", T(3), None, True)]


def test_change_then_revert_in_one_batch(spark):
    # D3: three versions, exactly one active
    h = hist(build(spark, [("k", "A", T(1), 1), ("k", "B", T(2), 2), ("k", "A", T(3), 3)]))
    assert [r[1] for r in sorted(h, key=lambda r: r[2])] == ["A", "B", "A"]
    assert sum(r[4] for r in h) == 1


def test_late_reobserved_value(spark):
    # A@1, A@5, then B@3 -> A[1,3) B[3,5) A[5,inf)
    h = hist(build(spark, [("k", "A", T(1), 1), ("k", "A", T(5), 5), ("k", "B", T(3), 3)]))
    assert h == [("k", "A", T(1), T(3), False), ("k", "A", T(5), None, True),
                 ("k", "B", T(3), T(5), False)]


def test_null_changes_count(spark):
    # A -> NULL -> A is two changes
    h = hist(build(spark, [("k", "A", T(1), 1), ("k", None, T(2), 2), ("k", "A", T(3), 3)]))
    assert len(h) == 3


def test_unchanged_observations_compact(spark):
    h = hist(build(spark, [("k", "A", T(1), 1), ("k", "A", T(2), 2), ("k", "A", T(3), 3)]))
    assert h == [("k", "A", T(1), None, True)]


def test_open_start(spark):
    # The first version opens at -infinity
    h = hist(build(spark, [("k", "A", T(4), 1), ("k", "B", T(6), 2)], open_start=True))
    assert h == [("k", "A", None, T(6), False), ("k", "B", T(6), None, True)]


def test_rebuild_touched_equals_full_rebuild(spark):
    early = [("a", "A", T(1), 1), ("a", "A", T(5), 5), ("b", "X", T(1), 1)]
    late = [("a", "B", T(3), 3)]
    history = build(spark, early)
    all_obs = spark.createDataFrame(early + late, OBS)
    inc = scd2_rebuild_touched(history, all_obs, spark.createDataFrame(late, OBS),
                               ["k"], ["city"], "ts", carry=["stamp"])
    assert hist(inc) == hist(build(spark, early + late))


def test_changed_rows_is_null_safe_and_newer_only(spark):
    active = spark.createDataFrame([("a", "A", T(1), 1), ("b", None, T(1), 1), ("c", "C", T(1), 5)], OBS)
    incoming = spark.createDataFrame([("a", "A", T(2), 2), ("b", "B", T(2), 2), ("c", "Z", T(2), 2)], OBS)
    out = rows(changed_rows(incoming, active, ["k"], ["city"], "stamp"), "k")
    assert out == [("b",)]


def _invariants(h):
    by_key = {}
    for k, _city, start, end, active in h:
        by_key.setdefault(k, []).append((start, end, active))
    for versions in by_key.values():
        assert sum(1 for v in versions if v[2]) == 1
        versions.sort(key=lambda v: v[0])
        for (s1, e1, _), (s2, _e2, _) in itertools.pairwise(versions):
            assert e1 == s2  # contiguous, disjoint, half-open


obs_strategy = st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["A", "B", None]),
                                  st.integers(1, 20)), min_size=1, max_size=10,
                        unique_by=lambda r: (r[0], r[2]))


@settings(max_examples=12, deadline=None)
@given(data=obs_strategy, seed=st.randoms())
def test_history_is_order_insensitive(spark, data, seed):
    rowsx = [(k, c, T(d), d) for k, c, d in data]
    shuffled = list(rowsx)
    seed.shuffle(shuffled)
    a = hist(build(spark, rowsx))
    b = hist(spark.createDataFrame(shuffled, OBS).repartition(3).transform(
        lambda df: scd2_build(df, ["k"], ["city"], "ts", carry=["stamp"])))
    assert a == b
    _invariants(a)


def test_hot_key_split_matches_plain_window(spark):
    # one key with most rows, split into chunks; result must equal the unsplit build
    data = [("hot", "ABC"[(i // 3) % 3], dt.datetime(2020, 1, 1) + dt.timedelta(hours=i), i)
            for i in range(60)]
    data += [("cold", "X" if i < 2 else "Y", dt.datetime(2020, 1, 1) + dt.timedelta(hours=i), i)
             for i in range(4)]
    plain = hist(build(spark, data))
    split = hist(build(spark, data, rows_per_task=7))
    assert split == plain
    _invariants(plain)


def test_bursty_hot_key_is_refined(spark):
    # 50 of the hot key's rows fall within one hour of a year-long span
    from pyspark.sql import functions as F

    from terrace.operators.neighbors import CHUNK, assign_chunks
    t0 = dt.datetime(2020, 1, 1)
    data = [("hot", "AB"[i % 2], t0 + dt.timedelta(seconds=i), i) for i in range(50)]
    data += [("hot", "C", t0 + dt.timedelta(days=d), 100 + d) for d in range(1, 366, 30)]
    data += [("cold", "X", t0, 1)]
    df = spark.createDataFrame(data, OBS)
    chunked, hot = assign_chunks(df, ["k"], "ts", rows_per_task=8)
    assert hot
    sizes = [r[1] for r in chunked.where(F.col(CHUNK) >= 0).groupBy(CHUNK).count().collect()]
    assert max(sizes) <= 8
    assert hist(build(spark, data, rows_per_task=8)) == hist(build(spark, data))


def test_scd2_changes_kinds(spark):
    from terrace.operators.scd2 import scd2_changes
    old = build(spark, [("a", "A", T(1), 1), ("b", "X", T(1), 1)])
    new = build(spark, [("a", "A", T(1), 1), ("a", "B", T(3), 3), ("b", "X", T(1), 1)])
    got = rows(scd2_changes(old, new, ["k"], "stamp"), "k", "stamp", "change_kind")
    assert got == [("a", 1, "close"), ("a", 3, "insert")]


@settings(max_examples=10, deadline=None)
@given(data=obs_strategy, late_mask=st.lists(st.booleans(), min_size=10, max_size=10))
def test_late_batch_rebuild_equals_full_build(spark, data, late_mask):
    rows_ = [(k, c, T(d), d) for k, c, d in data]
    early = [r for r, late in zip(rows_, late_mask) if not late]
    late = [r for r, is_late in zip(rows_, late_mask) if is_late]
    if not early or not late:
        return
    history = build(spark, early)
    inc = scd2_rebuild_touched(history, spark.createDataFrame(rows_, OBS), spark.createDataFrame(late, OBS),
                               ["k"], ["city"], "ts", carry=["stamp"])
    assert hist(inc) == hist(build(spark, rows_))


def test_hot_group_of_copies_collapses(spark):
    # a third of the rows are copies of one observation of one key
    data = [("hot", "A", T(2), 2)] * 40 + [("hot", "B", T(d), d) for d in (1, 3, 4)]
    data += [(f"k{i}", "X", T(1), 1) for i in range(80)]
    from terrace.operators.neighbors import assign_chunks
    out, chunked = assign_chunks(spark.createDataFrame(data, OBS), ["k"], "ts", rows_per_task=8,
                                 collapse_copies=True)
    assert not chunked and out.count() == 84          # 1 + 3 hot rows + 80 others
    assert hist(build(spark, data, rows_per_task=8)) == hist(build(spark, data))


def test_hot_null_key_one_timestamp_and_string_order(spark):
    from pyspark.sql import functions as F

    from terrace.operators.neighbors import CHUNK, assign_chunks
    schema = "k string, city string, ts string, stamp bigint"
    data = [(None, "AB"[i % 2], f"t{i:03d}", i) for i in range(60)]          # NULL key, string order
    data += [("one", "AB"[i % 2], "t5", i) for i in range(60)]              # one effective value
    data += [("cold", "X", "t1", 1)]
    df = spark.createDataFrame(data, schema)
    order = ["ts", "city", "stamp"]
    chunked, hot = assign_chunks(df, ["k"], order, rows_per_task=10)
    assert hot
    sizes = [r["count"] for r in chunked.where(F.col(CHUNK) >= 0).groupBy("k", CHUNK).count().collect()]
    assert sum(sizes) == 120 and max(sizes) <= 20
    assert len(sizes) <= 2 * 120 // 10 + 2
    out = lambda **kw: rows(scd2_build(df, ["k"], ["city"], "ts", carry=["stamp"], **kw))
    assert out(rows_per_task=10) == out()


def test_scd2_changes_report_moved_starts(spark):
    from terrace.operators.scd2 import scd2_changes
    old = build(spark, [("a", "A", T(5), 5)], open_start=True)
    new = build(spark, [("a", "A", T(5), 5), ("a", "Z", T(1), 1)], open_start=True)
    got = rows(scd2_changes(old, new, ["k"], "stamp", ["city"]), "k", "stamp", "ts_start_date", "change_kind")
    assert got == [("a", 1, None, "insert"), ("a", 5, T(5), "update")]


FACTS = "fk string, at timestamp_ntz, n int"
version_days = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["A", "B", None]),
                                  st.integers(1, 6)), min_size=0, max_size=8)
fact_days = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(1, 7))),
                     min_size=0, max_size=8)


@settings(max_examples=12, deadline=None)
@given(versions=version_days, facts=fact_days, open_start=st.booleans(), per_task=st.sampled_from([3, 1000]))
def test_asof_equals_residual_with_ties_and_nulls(spark, versions, facts, open_start, per_task):
    from terrace.operators.temporal import asof_left_join, residual_left_join
    h = build(spark, [(k, c, T(d), i) for i, (k, c, d) in enumerate(versions)], open_start=open_start)
    f = spark.createDataFrame([(k, None if d is None else T(d), i) for i, (k, d) in enumerate(facts)], FACTS)
    args = (f, h, "fk", "k", "at", ["city", "stamp"])
    assert rows(asof_left_join(*args, rows_per_task=per_task)) == rows(residual_left_join(*args))


tied_obs = st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(["A", "B", None]), st.integers(1, 6)),
                    min_size=0, max_size=9)


@settings(max_examples=15, deadline=None)
@given(early=tied_obs, batch=tied_obs, open_start=st.booleans())
def test_applied_batch_equals_full_build(spark, early, batch, open_start):
    from terrace.operators.scd2 import LAST_SEEN, scd2_apply, with_last_seen
    first = spark.createDataFrame([(k, c, T(d), i) for i, (k, c, d) in enumerate(early)], OBS)
    more = spark.createDataFrame([(k, c, T(d), 100 + i) for i, (k, c, d) in enumerate(batch)], OBS)
    args = (["k"], ["city"], "ts")
    history = with_last_seen(scd2_build(first, *args, carry=["stamp"], open_start=open_start), first, ["k"], "ts")
    both = first.unionByName(more)
    got = scd2_apply(history, both, more, *args, carry=["stamp"], open_start=open_start)
    want = with_last_seen(scd2_build(both, *args, carry=["stamp"], open_start=open_start), both, ["k"], "ts")
    cols = ["k", "city", "stamp", "ts_start_date", "ts_end_date", "flag_scd_active", LAST_SEEN]
    assert rows(got, *cols) == rows(want, *cols)
