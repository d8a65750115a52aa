"""Operators 1 to 5 and 9 and the pipeline against brute force, and their edge cases."""

import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terrace.llm import exact_dedup, mixing, ngram_join, pieces, registry, shingles, topk, toxicity
from terrace.llm.common import prepare
from tests.llm.helpers import BASE, EXTRA, documents, empty_docs, odd_docs

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------ 1: piece sampling
@pytest.fixture(scope="module")
def sampler():
    return pieces.Sampler(pieces.Pieces(pieces.model_path()))


def test_pieces_round_trip(sampler):
    texts = ["", None, " a  b\n c\t▁x \n\ny.z,w", "\n\nxx", "Ünïcödé 漢字 🎉 word", "x" * 3000, "a.b,c..d. .e", "￾"]
    ids = sampler.sample(pa.array(texts), np.arange(len(texts), dtype=np.int64))
    assert [b.as_py().decode() for b in pieces.joined(sampler.pieces, ids)] == [t or "" for t in texts]
    assert ids[0].as_py() == [] and ids[1].as_py() == []


def test_sampling_follows_path_weights(sampler):
    weights, word, n = sampler.pieces.weights, "then", 40000

    def paths(text):
        if not text:
            yield 1.0, ()
        for k in range(1, len(text) + 1):
            if text[:k] in weights:
                w, i = weights[text[:k]]
                yield from ((np.exp(w) * a, (i, *rest)) for a, rest in paths(text[k:]))

    all_paths = list(paths(pieces.MARK + word))
    total = sum(a for a, _ in all_paths)
    ids = sampler.sample(pa.array([word] * n), np.arange(n, dtype=np.int64) * 7919)
    seen = Counter(map(tuple, ids.to_pylist()))
    assert set(seen) <= {p for _, p in all_paths}
    assert max(abs(a / total - seen[p] / n) for a, p in all_paths) < 0.015


def test_samples_depend_on_the_key_alone(spark):
    prepare(spark)
    docs = documents(spark)
    one = {r.doc_id: r.ids for r in pieces.encode(docs.repartition(7)).collect()}
    rows = pieces.encode(docs.coalesce(1)).collect()
    assert all(one[r.doc_id] == r.ids and r.lossless for r in rows)
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(docs)).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}


# ----------------------------------------------------------- 2: n-gram join
def brute_sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def brute_components(ids, texts):
    sets, up = brute_sets(texts), list(range(len(ids)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in itertools.combinations(range(len(ids)), 2):
        if sets[a] and sets[b] and root(a) != root(b):
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                up[root(a)] = root(b)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(s), least.get(root(i), d)) for i, (d, s) in enumerate(zip(ids, sets))]


def test_shingle_sets_match_brute_force(spark):
    texts = [r.text for r in documents(spark).collect()] + [None, "", "  ", "a b", "A\tB", "a b c d", "a b c d e", "ab c d e f"]
    s, rows = shingles.shingle_sets(pa.array(texts))
    want = brute_sets(texts)
    assert np.bincount(rows, minlength=len(texts)).tolist() == [len(w) for w in want]
    assert len(np.unique(s)) == len(set().union(*want))


def family(seed, n, length=120, change=0.03):
    rng = np.random.default_rng(seed)
    base = [f"w{seed}x{k}" for k in range(length)]
    return [" ".join(f"c{rng.integers(1e9)}" if rng.random() < change else w for w in base) for _ in range(n)]


@pytest.mark.parametrize("block", [512, 8])
def test_ngram_components(spark, block):
    prepare(spark)
    rng = np.random.default_rng(5)
    texts = family(1, 60) + family(2, 30, change=0.06) + family(3, 10, length=8) + [" ".join(
        f"r{rng.integers(50)}" for _ in range(rng.integers(1, 40))) for _ in range(40)]
    texts += [texts[0], texts[3], None, "", "a b c", "A  b\nc"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in ngram_join.near_components(docs, block).collect())
    assert got == sorted(brute_components(range(len(texts)), texts))


def test_ngram_components_of_documents_and_odd_rows(spark):
    prepare(spark)
    rows = documents(spark).collect()
    got = {r.doc_id: tuple(r) for r in ngram_join.op2_ngram_join(spark, SF).collect()}
    assert got == {x[0]: x for x in brute_components([r.doc_id for r in rows], [r.text for r in rows])}
    odd = odd_docs(spark)
    want = brute_components(*zip(*[(r.doc_id, r.text) for r in odd.collect()]))
    assert sorted(map(tuple, ngram_join.near_components(odd).collect()), key=repr) == sorted(want, key=repr)
    kept = ngram_join.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 7, 9, 10]
    assert ngram_join.near_components(empty_docs(spark)).count() == 0


def test_one_of_each_with_repeated_and_null_ids(spark):
    prepare(spark)
    a, b, c, d = ([f"{family(k, 1, change=0.0)[0]} end{i}" for i in range(3)] for k in (11, 12, 13, 14))
    rows = [(3, a[0]), (5, a[1]), (5, b[0]), (7, c[0]), (7, c[1]), (8, c[2]), (None, d[0]), (None, d[1]), (None, b[1]),
            (9, ""), (9, ""), (9, " "), (10, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in ngram_join.one_of_each(docs).collect()]
    assert sorted((r for r in kept if r[0] is not None and r[0] != 7), key=repr) == sorted(
        [(3, a[0]), (5, b[0]), (9, ""), (9, " "), (10, "x y")], key=repr)
    assert len([r for r in kept if r[0] == 7]) == 1 and len([r for r in kept if r[0] is None]) == 1


def test_packed_tokens_round_trip():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5000):
        tokens, idx = np.sort(rng.integers(0, 2**48, n, dtype=np.uint64)), rng.integers(0, 65536, n).astype(np.uint16)
        t, i = ngram_join.unpacked(ngram_join.packed(tokens, idx))
        assert (t == tokens).all() and (i == idx).all()


def test_tree_bound_never_drops_a_link():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**64, 60, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(1, 50))) for _ in range(150)]
    trees = ngram_join.SignatureTree(sets, np.array([len(x) for x in sets]), 64)
    found = {frozenset(p) for a, b in ngram_join.candidates(trees, trees) for p in zip(a.tolist(), b.tolist())}
    for a, b in itertools.combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[a], sets[b]))
        if 7 * both >= 3 * (len(sets[a]) + len(sets[b])):
            assert frozenset((a, b)) in found


# ----------------------------------------------------------------- 3: mixing
def brute_targets(sizes, weights):
    mix, left, target = 1.5 * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while True:
        share = {i: mix * weights[i] / sum(weights[j] for j in left) for i in left}
        over = [i for i in left if share[i] > 2 * sizes[i] + 1e-9]
        if not over:
            for i in left:
                target[i] = share[i]
            return target
        for i in over:
            target[i] = 2.0 * sizes[i]
            mix -= target[i]
            left.discard(i)
        if not left:
            return target


def test_targets_match_repeated_resharing(spark):
    sizes = [100, 7, 5000, 40, 40, 900]
    rows = [(f"s{i}" if i < 5 else None, n) for i, n in enumerate(sizes)]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = brute_targets(sizes, [5, 2, 1, 5, 2, 1])
    assert all(abs(got[s] - w) < 1e-6 for (s, _), w in zip(rows, want))


def test_mix_meets_targets(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs)
    assert all(0 <= r.taken <= 2 * r.size for r in mixed.collect())
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect():
        assert abs(r.n - r.t) <= 0.5
    again = mixing.mix(docs.repartition(9))
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, again.collect()))


def test_repeated_rows_hold_the_taken_words(spark):
    docs = documents(spark).withColumns({c: F.lit(1) for c in EXTRA})
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    got = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(words).alias("n")).collect()}
    want = {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken}
    assert got == want


def test_mix_of_odd_and_empty_rows(spark):
    odd = odd_docs(spark)
    assert mixing.mix(odd).count() == odd.count()
    assert mixing.mix(empty_docs(spark)).count() == 0 and mixing.repeated(empty_docs(spark)).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert {(r.taken, r.target) for r in mixing.mix(blank).collect()} == {(0, 0.0)}
    assert mixing.repeated(odd).columns == odd.columns


# --------------------------------------------------------------- 4: toxicity
def test_grammar_reads_clauses():
    g = toxicity.Grammar({"idiot": 3.0}, [-2.0] + [1.0] * 9)
    channels = lambda t: toxicity.clause_channels([g.token(w) for w in t.split()])
    assert channels("an idiot") == [3.0, 0, 0, 0, 0]
    assert channels("you are an idiot") == [0, 3.0, 0, 0, 0]
    assert channels("not an idiot") == [0, 0, 3.0, 0, 0]
    assert channels("he said idiot")[toxicity.REPORTED] == 3.0
    assert channels("kill")[toxicity.THREATENED] == 0 and channels("you kill")[toxicity.THREATENED] > 0
    assert g.score("what an idiot") > g.score("what a day") == g.score("")


def test_threats_are_scored_before_and_after_their_target():
    g = toxicity.Grammar({"idiot": 3.0}, toxicity.FALLBACK_MODEL + [0.0, 0.0])
    threat = lambda t: toxicity.clause_channels([g.token(w) for w in t.split()])[toxicity.THREATENED]
    for text in ("kill you", "i will kill you", "we will hurt them", "you kill", "killing you", "they shot him", "you get burned",
                 "je vais te tuer", "je tuerai vous", "ich werde dich töten", "ich schlage dich", "voy a matar ellos"):
        assert threat(text) == 3.0, text
    assert threat("kill and burn you") == threat("you kill them and burn") == 6.0
    for text in ("kill time", "never kill you", "he said kill you", "you stable tuesday", "kill"):
        assert threat(text) == 0.0, text
    assert threat("kill time") == 0.0 and g.features("Kill time. You win.")[toxicity.THREATENED] == 0.0
    assert g.score("I will kill you") > g.score("I will thank you") and g.score("They were killing you") > 0.5


def test_threats_weigh_without_labelled_threats(spark):
    sf = "/root/testdata/sf0.01"
    g = toxicity.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert g.score("I will kill you") > 0.5 > g.score("I will thank you")


def test_toxicity_learns_from_its_rows_only(spark):
    got = toxicity.op4_toxicity(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.93
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got.collect())
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs.withColumn("lang", F.lit("x")), flipped)
    assert a == b


def test_toxicity_of_odd_rows_and_missing_labels(spark):
    odd, none = odd_docs(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    g = toxicity.train(odd, none)
    assert toxicity.score(odd, g).count() == odd.count()
    kept = toxicity.without_toxic(odd, none)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert toxicity.without_toxic(empty_docs(spark), none).count() == 0


# ------------------------------------------------------------- 5: exact dedup
def brute_exact(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for d, t in rows:
        groups.setdefault(norm(t), []).append(d)
    return sorted((d, min((x for x in groups[norm(t)] if x is not None), default=None), len(groups[norm(t)]))
                  for d, t in rows)


@pytest.mark.parametrize("identify", [F.xxhash64, lambda c: F.length(c).cast("long")])
def test_exact_groups_even_when_identifiers_collide(spark, identify):
    rows = [(i, f"text {i % 7} " * (i % 5)) for i in range(60)] + [(7, "text 0 "), (100, None), (101, ""), (102, "zxy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup.exact_groups(docs, identify).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == brute_exact(rows)
    per_text = Counter(r.text_sha256 for r in got if r.kept)
    assert set(per_text.values()) == {1} and len(per_text) == len({r.text_sha256 for r in got})


def test_chunks_lose_nothing(spark):
    texts = ["", "a", "ab " * 5000, "x" * 30000, "the lazy dog ran away. " * 900, "日本語" * 9000, "a b\u0085" * 3000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", exact_dedup.chunks(F.col("t")).alias("c")).collect()
    assert all("".join(r.c) == r.t and all(0 < len(c) <= exact_dedup.MAX_CHUNK + 8 for c in r.c) for r in got)


def test_drop_copies_of_odd_rows(spark):
    odd = odd_docs(spark)
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 6, 7, 8, 9, 10]
    assert exact_dedup.exact_groups(empty_docs(spark)).count() == 0


# ----------------------------------------------------------------- 9: search
def brute_top(vectors, k):
    q = {i: np.floor(64 * np.array(v, float)) for i, v in vectors}
    out = []
    for a in sorted(i for i in q if i % 20 == 0):
        best = sorted(((-int(q[a] @ q[b]), b) for b in q if b != a and len(q[a]) == len(q[b])))[:k]
        out += [(a, r + 1, b, -s) for r, (s, b) in enumerate(best)]
    return out


@pytest.mark.parametrize("block_rows,shard_blocks,group", [(256, 32, 1024), (8, 3, 2)])
def test_topk_is_exact_with_ties(spark, block_rows, shard_blocks, group):
    prepare(spark)
    rng = np.random.default_rng(9)
    vectors = [(i, (rng.integers(-2, 3, 6) / 8).tolist()) for i in range(400)] + [(1000 + i, [0.5, 0.25]) for i in range(3)]
    bad = [(2000, None), (2020, [1.0, None]), (2040, [float("nan"), 1.0]), (2060, [float("inf")] * 6), (2080, [])]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    v = topk.quantised(df)
    got = topk.search(v, v.where("vec_id % 20 = 0"), 20, block_rows, shard_blocks, group).collect()
    assert sorted(tuple(r) for r in got) == brute_top(vectors, 20)


def test_topk_of_no_vectors(spark):
    none = topk.quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.search(none, none).count() == 0


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages_keep_the_columns_and_take_effect(spark):
    docs = documents(spark)
    frames, df = [docs], docs
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, SF)
        path = ngram_join.stored(df, "stage")
        frames.append(path)
        df = path
    assert all(f.columns == docs.columns for f in frames[:-1])
    toxic = {r.doc_id for r in toxicity.op4_toxicity(spark, SF).where("predicted = 1").collect()}
    ids = [[r.doc_id for r in f.select("doc_id").collect()] for f in frames]
    assert sorted(ids[1]) == sorted(set(ids[0]) - toxic)
    norm = exact_dedup.normalised(F.col("text"))
    assert frames[2].select(norm).distinct().count() == frames[2].count() == frames[1].select(norm).distinct().count()
    rows = frames[2].collect()
    want = {c for _, _, c in brute_components([r.doc_id for r in rows], [r.text for r in rows])}
    empty = {r.doc_id for r in rows if not (r.text or "").split()}
    assert set(ids[3]) == want | empty and len(ids[3]) == len(set(ids[3]))
    assert Counter(ids[4]) == Counter(ids[5]) and all(r.lossless for r in frames[5].collect())


def test_registry_names_each_operator_once():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in registry.QUERIES if n != "pipeline")
    assert numbers == list(range(1, 11)) and set(registry.ORACLE_SQL) <= set(registry.QUERIES)


def test_odd_rows_through_the_last_operators(spark):
    prepare(spark)
    odd = odd_docs(spark)
    assert pieces.encode(odd).where("lossless IS NULL").count() == 1
    assert pieces.encode(odd).where("NOT lossless").count() == 0
    assert pieces.encode(empty_docs(spark)).count() == 0
    assert BASE in {r.text for r in pieces.decode(pieces.encode(odd)).collect()}
