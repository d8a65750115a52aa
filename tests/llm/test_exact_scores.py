"""Scores beyond 2 ** 53 are exact; repetitions of a document draw segmentations of their own."""

import random

from pyspark.sql import functions as F

from terrace.llm import pieces, topk
from tests.llm.helpers import EXTRA


def _brute(data, every, k):
    out = []
    for q, v in {(i, tuple(v)) for i, v in data if i % every == 0}:
        some = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in data if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(some[:k])]
    return sorted(out)


def test_large_components_and_repeated_ids(spark):
    rng = random.Random(2)
    for large in (10 ** 7, 15 * 10 ** 8, 50):
        data = [(i, [rng.randrange(-large, large) for _ in range(rng.choice([4, 4, 2]))]) for i in range(220)]
        data += [data[5], (7, data[8][1])]
        df = spark.createDataFrame(data, "vec_id long, q array<long>").select("vec_id", F.size("q").alias("dims"), "q")
        got = topk.search(df, df.where("vec_id % 20 = 0"), k=6, block_rows=16, shard_blocks=3, query_group=4)
        assert sorted(tuple(r) for r in got.collect()) == _brute(data, 20, 6)


def test_each_repetition_has_a_draw_of_its_own(spark):
    text = "Therouou thon heoron eratsh therin blees esheon erstlyat. " * 6
    rows = [(1, text)] * 4 + [(2, text), (None, text), (None, text), (3, None), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in EXTRA})
    take = lambda **kw: [(r.doc_id, tuple(r.ids) if r.ids is not None else None, r.lossless)
                         for r in pieces.encode(docs.repartition(3), **kw).collect()]
    plain, several = take(), take(repetitions=True)
    assert len(plain) == len(several) == 10 and sorted(several, key=repr) == sorted(take(repetitions=True), key=repr)
    of = lambda got, i: [x for d, x, _ in got if d == i]
    assert len(set(of(plain, 1))) == 1 and len(set(of(several, 1))) == 4 and of(plain, 1)[0] in of(several, 1)
    assert of(several, 2) == of(plain, 2) and len(set(of(several, None))) == 2
