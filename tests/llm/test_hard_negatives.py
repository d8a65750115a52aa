"""Kronecker-packed hard negatives against brute force: odd rows, wide fields, many labels."""

import random

import pytest
from pyspark.sql import functions as F

from terrace.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, anchors, positives=5, negatives=3, band=(50, 95)):
    out = []
    for a_id, a_label, a in {(i, lab, tuple(q)) for i, lab, q in anchors}:
        scored = [(sum(x * y for x, y in zip(a, q)), i, lab) for i, lab, q in rows if len(q) == len(a)]
        best = lambda some, n: sorted(some, key=lambda r: (-r[0], r[1]))[:n]
        for p, p_id, _ in best([r for r in scored if r[2] == a_label and r[1] != a_id], positives):
            some = [r for r in scored if r[2] != a_label and band[0] * p <= 100 * r[0] <= band[1] * p]
            out += [(a_id, p_id, k + 1, i, p, s) for k, (s, i, _) in enumerate(best(some, negatives))]
    return sorted(out)


def mined(spark, data, every=3, scale=256, **kw):
    df = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("x") for c in ("q", "dims", "block", "score")})
    rows = H.usable(df, F.col("label"), scale=scale)
    got = H.hard_negatives(rows, rows.where(F.col("vec_id") % every == 0), **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    plain = [(r.vec_id, r.label, list(r.q)) for r in rows.collect()]
    return sorted(tuple(r) for r in got.collect()), brute(plain, [r for r in plain if r[0] % every == 0])


@pytest.mark.parametrize("large", [1.0, 4e4, 2e6])
def test_exact_for_any_magnitude_over_many_blocks_and_cells(spark, large):
    """Scores up to 2 ** 62, fields up to 80 bits, blocks of 4 rows, cells of 8 rows and 5 anchors."""
    rng = random.Random(5)
    data = [(i, rng.randrange(12) if i % 2 else 0, [rng.uniform(-1, 1) * large for _ in range(8)]) for i in range(90)]
    got, want = mined(spark, data, block_rows=4, shard_rows=8, anchor_group=5)
    assert got == want and len(got) > 50


def test_odd_rows_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, 0.25, -0.125]
    data = [(0, 1, v), (0, 1, v), (3, 1, v), (3, 2, [0.25, 0.25, 0.0]), (6, 1, [0.0, 0.0, 0.0]), (9, 3, [-1.0, 0.0, 0.0]),
            (1, 1, v), (2, 1, v), (2, 1, v), (4, 2, [0.4, 0.2, 0.0]), (5, 2, [0.4, 0.2, 0.0]), (7, 2, [0.3, 0.2, 0.0]),
            (8, 3, [0.35, 0.1, 0.0]), (10, 3, [1.0]), (12, 3, [0.5]), (11, 4, [0.9]),
            (None, 1, v), (13, None, v), (15, 1, None), (18, 1, []), (21, 1, [nan, 0.0, 0.0]),
            (24, 2, [inf, 0.0, 0.0]), (27, 2, [None, 0.0, 0.0])]
    got, want = mined(spark, data)
    assert got == want and got
    assert not {r[0] for r in got} & {13, 15, 18, 21, 24, 27}


def test_all_labels_differ_and_one_label_holds_all(spark):
    rng = random.Random(6)
    vectors = [[rng.random() for _ in range(4)] for _ in range(40)]
    assert mined(spark, [(i, i, v) for i, v in enumerate(vectors)]) == ([], [])      # no positives
    assert mined(spark, [(i, 7, v) for i, v in enumerate(vectors)]) == ([], [])      # no negatives


def test_empty_table(spark):
    rows = H.usable(spark.createDataFrame([], SCHEMA), F.col("label"))
    assert H.hard_negatives(rows, rows).count() == 0


def test_fields_do_not_run_into_each_other():
    import numpy as np
    f = H.Fields(300, 2 ** 40, 5)
    m = np.array([[2 ** 40, -2 ** 40, 0, 1, -1], [-2 ** 40] * 5, [2 ** 40] * 5], np.int64)
    q = [300, -300, 300, 7, -300]
    packed = [int.from_bytes(f.pack(c), "little") for c in m.T]
    got = f.scores([q], packed, m.sum(axis=1))
    assert got.tolist() == [[int(sum(int(x) * y for x, y in zip(r, q))) for r in m]]
