"""Decontamination against brute force: exact windows, rarity, hot passages, odd rows."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from terrace.llm import decontaminate as D
from tests.llm.helpers import documents, empty_docs, odd_docs

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, window=10):
    cut = {}
    for key, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            cut.setdefault(tuple(w[i:i + n]), set()).add(key)
    sizes = {len(k) for k in cut}
    out = []
    for doc_id, text in docs:
        w, hit, of = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in cut:
                    hit.update(range(i, i + n))
                    of |= cut[tuple(w[i:i + n])]
        ids = sorted(str(k) for k in of if k is not None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def found(spark, docs, items, **kw):
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("x"))
    got = D.contaminated(docs, bench, **kw).select(*COLUMNS)
    return (sorted((tuple(r) for r in got.collect()), key=repr),
            brute([(r.doc_id, r.text) for r in docs.collect()], items, kw.get("window", 10)))


def test_random_texts_over_a_small_vocabulary(spark):
    """Few words: windows overlap, repeat, share prefixes and items; sizes from 1 to 10."""
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice(["a", "B", "ça", "d4", "e"]) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 3, 4, 5, 7, 10, 12, 30]) if i > 3 else 14)) for i in range(25)]
    items += [(3, items[5][1]), (None, items[6][1]), (90, None), (91, " . "), (92, "Zeta")]
    docs = [(i, rng.choice(["", ". "]) + say(rng.randrange(60)) + "!" + rng.choice(items)[1].__str__().upper() + "  " + say(9))
            for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got, want = found(spark, df, items)
    assert got == want and any(r[3] for r in got)
    got, want = found(spark, df, [i for i in items if len(words(i[1])) > 9], window=6, shingle=2)
    assert got == want and any(r[2] for r in got) and not all(r[5] for r in got)


def test_a_passage_that_most_documents_hold(spark):
    rng = random.Random(4)
    passage = " ".join(f"w{rng.randrange(1000)}" for _ in range(60))
    docs = [(i, f"intro {i} {passage}, end {i}" if i % 3 else f"nothing of it {i}") for i in range(300)]
    got, want = found(spark, spark.createDataFrame(docs, "doc_id long, text string"), [(1, passage), (2, passage + " x")])
    assert got == want and sum(r[5] for r in got) == 200 and {r[2] for r in got} == {0, 60}


def test_odd_rows_and_empty_tables(spark):
    base = odd_docs(spark)
    items = [(1, "one two three four five six seven eight nine ten"), (2, "A b"), (3, "lorem ipsum"), (4, "x" * 50_000)]
    got, want = found(spark, base, items)
    assert got == want and len(got) == 12
    empty = spark.createDataFrame([], "item_id long, text string")
    got = D.contaminated(base, empty).select(*COLUMNS).collect()
    assert len(got) == 12 and not any(r.contaminated for r in got)
    assert D.contaminated(empty_docs(spark), empty).count() == 0


def test_given_documents(spark):
    docs = documents(spark)
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    got, want = found(spark, docs, [(r.item_id, r.text) for r in bench])
    assert got == want
