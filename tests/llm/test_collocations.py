"""Phrase mining against brute force: tries that burst and spill, ties, languages, odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import collocations as C
from tests.llm.helpers import documents, empty_docs, odd_docs

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, least, top, longest=5):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    cand = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    gone = set()
    for (lang, w), a in cand.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                if a >= f[lang, w[i:i + m]]:
                    gone.add((lang, w[i:i + m]))
    rows = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in gone:
            score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            rows.setdefault(lang, []).append((" ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    return sorted((lang, i + 1, *r) for lang, some in rows.items()
                  for i, r in enumerate(sorted(some, key=lambda r: (-r[5], -r[1], r[0].encode()))[:top]))


def mined(spark, docs, least, top=2000, **kw):
    df = spark.createDataFrame(docs, "lang string, text string").withColumns({c: F.lit(1) for c in ("id", "n", "key", "a")})
    got = C.collocations(df.repartition(3), min_count=least, top=top, **kw)
    assert got.columns == COLUMNS
    return sorted(tuple(r) for r in got.collect()), brute(docs, least, top)


def _docs(rng, n=150):
    vocab = ["the", "Of", "new", "york", "city", "ça", "日本", "x-1", "a\x00b", "it's"]
    say = lambda: "".join(rng.choice(vocab[:4] if rng.random() < .5 else vocab) + rng.choice([" ", " ", " ", "\t", ", ", "\n", ". "])
                          for _ in range(rng.randrange(60)))
    return [(rng.choice(["en", "en", "fr", None, "und", ""]), say() + rng.choice(["", " new york city hall opens new york city hall"]))
            for _ in range(n)]


@pytest.mark.parametrize("entries,burst", [(500_000, 8192), (60, 8)])
def test_phrases(spark, entries, burst):
    """The second case spills whole subtrees and bursts containers all the time."""
    docs = _docs(random.Random(7))
    got, want = mined(spark, docs, 4, entries=entries, burst=burst)
    assert got == want and len(got) > 100
    got, want = mined(spark, docs, 9, top=7, entries=entries, burst=burst)
    assert got == want and max(r[1] for r in got) == 7


def test_colliding_ids_draw_another_seed(spark, monkeypatch):
    seeds = []
    plain = C.word_counts

    def counts(texts, seed):
        seeds.append(seed)
        df = plain(texts, seed)
        return df.withColumn("same", F.lit(False)) if seed < 2 else df
    monkeypatch.setattr(C, "word_counts", counts)
    docs = _docs(random.Random(8), 40)
    got, want = mined(spark, docs, 3)
    assert got == want and seeds == [0, 1, 2]


def test_odd_rows_and_empty_tables(spark):
    got = C.collocations(odd_docs(spark), min_count=2)
    want = brute([(r.lang, r.text) for r in odd_docs(spark).collect()], 2, 2000)
    assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == want and want
    assert C.collocations(empty_docs(spark)).count() == 0
    assert mined(spark, [("en", None), (None, " ,. \n")], 1) == ([], [])


def test_given_documents(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = sorted(tuple(r) for r in C.collocations(docs).select(*COLUMNS).collect())
    assert got == brute([(r.lang, r.text) for r in docs.collect()], 100, 2000) and got


def test_trie_and_merge_add_up():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 6, (5000, 3)).astype(np.uint64) * np.uint64(2 ** 61 + 5)
    trie, spilt, spills = C.HatTrie(burst=4, entries=50), Counter(), 0
    for lo in range(0, len(ids), 250):
        trie.add(ids[lo:lo + 250])
        trie.add(ids[lo:lo + 250, :2])
        out = trie.spill()
        spills += bool(out)
        spilt.update(out)
    spilt.update(trie.spill(everything=True))
    want = Counter(r.astype(">u8").tobytes() for r in ids) + Counter(r[:2].astype(">u8").tobytes() for r in ids)
    assert spilt == want and spills > 3
    columns, n = C.summed(ids.T, np.ones(len(ids), np.int64))
    assert {c.astype(">u8").tobytes(): int(k) for c, k in zip(columns.T, n)} == Counter(r.astype(">u8").tobytes() for r in ids)


def test_sums_of_keys_of_equal_hash(monkeypatch):
    monkeypatch.setattr(C, "mixed", lambda x: x & np.uint64(1))
    ids = np.array([[1, 2], [3, 2], [1, 2], [5, 4], [3, 2], [1, 2]], np.uint64)
    columns, n = C.summed(ids.T, np.arange(6))
    assert sorted(zip(columns[0].tolist(), columns[1].tolist(), n.tolist())) == [(1, 2, 7), (3, 2, 5), (5, 4, 3)]
