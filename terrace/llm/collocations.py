"""Phrase collocation mining by HAT-trie counting (operator 12).

Words become 64-bit ids that hash (lang, word), so a sequence of ids names a
phrase of one language.  Two (lang, word) pairs of equal id are looked for among
all distinct words; if there are any, ids are drawn with the next seed.

A task counts phrases in a HAT-trie (:class:`HatTrie`): shallow nodes that
dispatch on a word id, over hash containers of whole keys.  A node covers
the ids by ranges; a container that grows beyond ``BURST`` keys bursts into
two half ranges, and one whose keys share that word becomes a node on the next
word.  When a trie holds more than ``ENTRIES`` keys, whole subtrees, the largest
first, are spilled as sorted runs.  Runs are cut by prefix partition - a hash
of the first words - and merged there; what occurs less than ``min_count`` times
in all goes.  There are as many partitions as the number of words needs for
about ``MERGE_KEYS`` keys each.  A prefix is the first two words of a pair and the first
three of a longer phrase, so one frequent word fills no partition, and a task
adds up its own copies of a phrase before anything moves.

Three passes over whole texts, each pruned by what is exact: a phrase that
occurs ``min_count`` times has only parts that do.

1. words, which also gives every language's number of words;
2. pairs of frequent words;
3. phrases of three to ``MAX_WORDS`` words all of whose pairs are frequent.

Frequency is asked of a bit filter of fixed size (``words.BitFilter``): strangers
it lets through are counted and then dropped by their count.

A phrase lies inside a longer one that occurs as often only if it is the first or
last part, one word shorter, of such a phrase; those go.  The rest are cut at
every word, and scored by joins with the stored counts in exact arithmetic (128-bit
decimals: 1000 * a * n and l * r must stay below 10 ** 38).

Defined cases: null lang counts as `und`; null and empty texts have no words; no
other column is read; repeated rows count each; score ties go to larger a, then to
the smaller phrase by its UTF-8 bytes; empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm.common import prepare, stored, table
from terrace.llm.shingles import mixed
from terrace.llm.words import BitFilter, Group, Hasher, bit_filter, groups, kinds

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
BURST = 8192
ENTRIES = 500_000
DEPTH = 2
MERGE_KEYS = 1 << 21
NO_LANG = "und"

# FIXED VALUES: words part at space and tab, pieces of text at . , ; : ! ? and 0A-0D (A-Z count as a-z).
KINDS = kinds(b"\x20\x09", b".,;:!?\x0A\x0B\x0C\x0D")

WORD_SCHEMA = "id long, lang string, word string, n long"
RUN_SCHEMA = "part long, words int, n int, keys binary, counts binary"
PHRASE_SCHEMA = "key binary, words int, a long, mark long"


# ------------------------------------------------------------------ the trie
class _Node:
    """Containers (or nodes) over ranges of the ids of the word at ``depth``."""

    def __init__(self, depth: int):
        self.depth = depth
        self.bounds = np.zeros(1, np.uint64)        # least id of each child's range
        self.children: list = [{}]

    def size(self) -> int:
        return sum(_size(c) for c in self.children)


def _size(child) -> int:
    return len(child) if isinstance(child, dict) else child.size()


def _items(child):
    if isinstance(child, dict):
        yield from child.items()
    else:
        for c in child.children:
            yield from _items(c)


class _Pure(dict):
    """A container at the greatest depth all of whose keys share that word: it grows until a spill."""


class HatTrie:
    """Counts of sequences of word ids, given as big-endian keys of 8 bytes a word."""

    def __init__(self, burst: int = BURST, entries: int = ENTRIES, depth: int = DEPTH):
        self.burst, self.entries, self.depth = burst, entries, depth
        self.root = _Node(0)

    def add(self, ids: np.ndarray) -> None:
        """Count the rows of ``ids`` (sequences x words)."""
        if len(ids):
            keys = np.ascontiguousarray(ids.astype(">u8")).view(f"V{8 * ids.shape[1]}").ravel()
            self._add(self.root, ids, keys)

    def _add(self, node: _Node, ids: np.ndarray, keys: np.ndarray) -> None:
        child = np.searchsorted(node.bounds, ids[:, node.depth], side="right") - 1
        order = np.argsort(child, kind="stable")
        child = child[order]
        cuts = [0, *(np.flatnonzero(np.diff(child)) + 1).tolist(), len(child)]
        burst = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            c, rows = int(child[lo]), order[lo:hi]
            at = node.children[c]
            if isinstance(at, dict):
                for k, n in Counter(keys[rows].tolist()).items():
                    at[k] = at.get(k, 0) + n
                if len(at) > self.burst and not isinstance(at, _Pure):
                    burst.append(c)
            else:
                self._add(at, ids[rows], keys[rows])
        for c in reversed(burst):
            self._burst(node, c)

    def _burst(self, node: _Node, c: int) -> None:
        """Halve a container's range of ids, or give its one word a node of its own."""
        full = node.children[c]
        lo = 8 * node.depth
        words = np.sort(np.frombuffer(b"".join(k[lo:lo + 8] for k in full), ">u8").astype(np.uint64))
        if words[0] == words[-1]:
            if node.depth + 1 < self.depth:
                below = _Node(node.depth + 1)
                below.children[0] = full
                node.children[c] = below
                self._burst(below, 0)
            else:
                node.children[c] = _Pure(full)
            return
        middle = words[len(words) // 2]
        if middle == words[0]:
            middle = words[np.searchsorted(words, middle, side="right")]
        cut, low, high = int(middle).to_bytes(8, "big"), {}, {}
        for k, n in full.items():
            (low if k[lo:lo + 8] < cut else high)[k] = n
        node.children[c:c + 1] = [low, high]
        node.bounds = np.insert(node.bounds, c + 1, middle)
        for at in (c + 1, c):
            if len(node.children[at]) > self.burst:
                self._burst(node, at)

    def spill(self, everything: bool = False) -> dict[bytes, int]:
        """Take out whole subtrees, the largest first, until half the allowed keys are left."""
        sizes = [_size(c) for c in self.root.children]
        held = sum(sizes)
        if not everything and held <= self.entries:
            return {}
        out: dict[bytes, int] = {}
        left = 0 if everything else self.entries // 2
        for c in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            if held <= left:
                break
            out.update(_items(self.root.children[c]))
            self.root.children[c] = {}
            held -= sizes[c]
        return out


# ------------------------------------------------------------------ runs
def _prefix(words: int) -> int:
    return min(words, 3)


def _part(ids: np.ndarray, parts: int) -> np.ndarray:
    h = np.zeros(len(ids), np.uint64)
    for k in range(_prefix(ids.shape[1])):
        h = mixed(h + ids[:, k])
    return (h % np.uint64(parts)).astype(np.int64)


def _runs(counts: dict[bytes, int], parts: int) -> Iterator[tuple]:
    """Sorted runs of the spilled keys, by length and prefix partition."""
    by_words: dict[int, list[bytes]] = {}
    for k in sorted(counts):
        by_words.setdefault(len(k) // 8, []).append(k)
    pack = zstandard.ZstdCompressor(level=1).compress
    for words, keys in by_words.items():
        ids = np.frombuffer(b"".join(keys), ">u8").reshape(-1, words)
        n = np.fromiter((counts[k] for k in keys), np.int64, len(keys))
        part = _part(ids.astype(np.uint64), parts)
        order = np.argsort(part, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(part[order])) + 1).tolist(), len(order)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            rows = order[lo:hi]
            yield (int(part[rows[0]]), words, len(rows), pack(np.ascontiguousarray(ids[rows].T).tobytes()),
                   pack(n[rows].astype("<i8").tobytes()))


def _run_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["part", "words", "n", "keys", "counts"])


def summed(columns: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (words x keys) and the sums of their counts."""
    h = np.zeros(columns.shape[1], np.uint64)
    for c in columns:
        h = mixed(h + c)
    order = np.argsort(h, kind="stable")

    def edges(order: np.ndarray) -> np.ndarray:
        new = np.zeros(len(order), bool)
        new[:1] = True
        for c in columns:
            s = c[order]
            new[1:] |= s[1:] != s[:-1]
        return new

    new = edges(order)
    if int(new.sum()) != 1 + int((np.diff(h[order]) != 0).sum()):     # keys of equal hash: sort the keys themselves
        order = np.lexsort(columns[::-1])
        new = edges(order)
    first = np.flatnonzero(new)
    return columns[:, order[first]], np.add.reduceat(n[order], first)


def merged(runs: DataFrame, parts: int, min_count: int) -> DataFrame:
    """key, words, a, mark of the phrases that occur ``min_count`` times or more over all runs; a task
    for each of the ``parts`` prefix partitions, so a task reads as much at any size of the corpus."""
    def merge(part: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        keys, length, a, marks = [], [], [], []
        rows = part.select(["words", "n", "keys", "counts"])
        for words in sorted(set(rows["words"].to_pylist())):
            own = rows.filter(pa.compute.equal(rows["words"], words)).to_pylist()
            columns = np.concatenate([np.frombuffer(unpack(r["keys"]), ">u8").reshape(words, -1).astype(np.uint64)
                                      for r in own], axis=1)
            ids, n = summed(columns, np.concatenate([np.frombuffer(unpack(r["counts"]), "<i8") for r in own]))
            often = n >= min_count
            ids, n = ids[:, often], n[often]
            raw = np.ascontiguousarray(ids.T.astype(">u8")).tobytes()
            keys += [raw[i:i + 8 * words] for i in range(0, len(raw), 8 * words)]
            length += [words] * len(n)
            a += n.tolist()
            marks += (pair_mark(ids[0], ids[1]) if words == 2 else np.zeros(len(n), np.uint64)).view(np.int64).tolist()
        return pa.table([pa.array(keys, pa.binary()), pa.array(length, pa.int32()), pa.array(a, pa.int64()),
                         pa.array(marks, pa.int64())], names=["key", "words", "a", "mark"])

    return runs.repartition(parts, "part").groupBy("part").applyInArrow(merge, PHRASE_SCHEMA)


def pair_mark(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(mixed(a) + b)


# ------------------------------------------------------------------ passes over the texts
def _texts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.col(text).cast("string").alias("text"))


class _Ids:
    """Ids of the words of a group: a hash of the word and its text's language."""

    def __init__(self, seed: int):
        self.seed, self.hasher, self.langs = seed, Hasher(seed), {}

    def of_lang(self, lang: str) -> np.uint64:
        if lang not in self.langs:
            raw = np.frombuffer(lang.encode() or b"\0", np.uint8)
            self.langs[lang] = mixed(self.hasher(raw, np.zeros(1, np.int64), np.full(1, len(raw)))
                                     + np.uint64(len(lang) + 1))[0]
        return self.langs[lang]

    def __call__(self, g: Group, langs: list[str]) -> np.ndarray:
        salt = np.array([self.of_lang(x) for x in langs[g.first:g.first + g.n]], np.uint64)
        return mixed(g.ids ^ salt[g.text]) if len(g.ids) else g.ids


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """id, lang, word, n, same: every word of every language; ``same`` is false where two share an id."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, n, name = _Ids(seed), Counter(), {}

        def flush() -> pa.RecordBatch:
            ids = list(n)
            rows = [np.array(ids, np.uint64).view(np.int64), [name[i][0] for i in ids], [name[i][1] for i in ids],
                    [n[i] for i in ids]]
            n.clear()
            name.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                rows, [pa.int64(), pa.string(), pa.string(), pa.int64()])], ["id", "lang", "word", "n"])

        for b in batches:
            langs = b.column(0).to_pylist()
            for g in groups(b.column(1), KINDS, make.hasher):
                ids, first, often = np.unique(make(g, langs), return_index=True, return_counts=True)
                for i, f, k in zip(ids.tolist(), first.tolist(), often.tolist()):
                    if i not in name:
                        name[i] = (langs[g.first + int(g.text[f])], g.lowered(int(g.start[f]), int(g.end[f])).decode())
                    n[i] += k
                if len(n) > ENTRIES:
                    yield flush()
        if n:
            yield flush()

    w = F.struct("lang", "word")
    counted = texts.mapInArrow(count, WORD_SCHEMA).groupBy("id").agg(
        F.min(w).alias("w"), F.max(w).alias("v"), F.sum("n").alias("n"))
    return counted.select("id", "w.lang", "w.word", "n", (F.col("w") == F.col("v")).alias("same"))


def phrase_runs(texts: DataFrame, seed: int, lengths: list[int], words: BitFilter, pairs: BitFilter | None,
                parts: int, entries: int = ENTRIES, burst: int = BURST) -> DataFrame:
    """Sorted runs of the counts of all phrases of the given lengths that the filters let through."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, trie = _Ids(seed), HatTrie(burst, entries)
        for b in batches:
            langs = b.column(0).to_pylist()
            for g in groups(b.column(1), KINDS, make.hasher):
                ids = make(g, langs)
                if len(ids) < 2:
                    continue
                fit = words(ids)
                joined = fit[:-1] & fit[1:] & ~g.after_break[1:]       # this word and the next one
                if pairs is not None:
                    at = np.flatnonzero(joined)
                    joined[at] = pairs(pair_mark(ids[at], ids[at + 1]))
                chain = joined
                for length in range(2, max(lengths) + 1):
                    if length > 2:
                        chain = chain[:-1] & joined[length - 2:]
                    if length in lengths:
                        at = np.flatnonzero(chain)
                        for lo in range(0, len(at), entries):          # the trie grows by one slice at a time
                            trie.add(ids[at[lo:lo + entries, None] + np.arange(length)])
                            if out := list(_runs(trie.spill(), parts)):
                                yield _run_batch(out)
        if out := list(_runs(trie.spill(everything=True), parts)):
            yield _run_batch(out)

    return texts.mapInArrow(count, RUN_SCHEMA)


# ------------------------------------------------------------------ scores
def _piece(key: Column, first: Column, n: Column) -> Column:
    return F.substring(key, first * 8 + 1, n * 8)


def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score from the counts of all frequent phrases and words."""
    several = phrases.select("key", "words", "a")
    n_words = F.col("words")
    shorter = F.array(*[F.struct(_piece(F.col("key"), F.lit(i), n_words - 1).alias("key"), "a") for i in (0, 1)])
    inside = several.where(n_words > 2).select(F.explode(shorter).alias("s")).select("s.*").distinct()
    kept = several.join(inside, ["key", "a"], "left_anti")

    id_bytes = F.unhex(F.lpad(F.hex("id"), 16, "0"))
    counts = several.select("key", "a").unionByName(words.select(id_bytes.alias("key"), F.col("n").alias("a")))
    part = lambda key, count: counts.select(F.col("key").alias(key), F.col("a").alias(count))
    cuts = kept.select("key", "words", "a", F.explode(F.sequence(F.lit(1), n_words - 1)).alias("k"))
    cuts = cuts.select("key", "words", "a", "k", _piece(F.col("key"), F.lit(0), F.col("k")).alias("left"),
                       _piece(F.col("key"), F.col("k"), n_words - F.col("k")).alias("right"))
    cuts = cuts.join(part("left", "l"), "left").join(part("right", "r"), "right").drop("left", "right")

    names = words.select(id_bytes.alias("id"), "lang", "word")
    spelt = (kept.select("key", "words", F.explode(F.sequence(F.lit(0), n_words - 1)).alias("i"))
             .select("key", "i", _piece(F.col("key"), F.col("i"), F.lit(1)).alias("id")).join(names, "id")
             .groupBy("key").agg(F.first("lang").alias("lang"),
                                 F.array_join(F.sort_array(F.collect_list(F.struct("i", "word")))["word"], " ").alias("phrase")))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    spelt = spelt.join(totals, "lang")
    best = F.min(F.struct("score", "k", "l", "r")).alias("b")
    scores = (cuts.join(spelt.select("key", "n"), "key")
              .withColumn("num", (wide("a") * wide("n")).cast("decimal(35,0)"))
              .withColumn("den", wide("l") * wide("r"))
              .withColumn("score", F.expr("(num * cast(1000 AS decimal(4,0))) div den").cast("bigint"))
              .groupBy("key", "a").agg(best))
    ranked = scores.join(spelt, "key").select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, lang: str = "lang",
                 text: str = "text", entries: int = ENTRIES, burst: int = BURST, seed: int = 0) -> DataFrame:
    """The best phrases of every language, see the module's text."""
    texts, spark = _texts(docs, lang, text), docs.sparkSession
    while True:
        vocabulary = stored(word_counts(texts, seed), "collocations_words")
        if vocabulary.where(~F.col("same")).isEmpty():
            break
        seed += 1
    totals = stored(vocabulary.groupBy("lang").agg(F.sum("n").alias("n")), "collocations_totals")
    n = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(spark.sparkContext.defaultParallelism, -(-n * (MAX_WORDS - 2) // MERGE_KEYS))
    words = vocabulary.where(F.col("n") >= min_count)
    frequent = bit_filter(words, "id")
    pairs = stored(merged(phrase_runs(texts, seed, [2], frequent, None, parts, entries, burst), parts, min_count),
                   "collocations_pairs")
    longer = list(range(3, MAX_WORDS + 1))
    runs = phrase_runs(texts, seed, longer, frequent, bit_filter(pairs, "mark"), parts, entries, burst)
    more = stored(merged(runs, parts, min_count), "collocations_phrases")
    return scored(pairs.unionByName(more), words, totals, top)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(prepare(spark), sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT row, lang, j, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT row, lang, unnest(ps) AS p, generate_subscripts(ps, 1) AS j FROM (
    SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
           regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[.,;:!?\x0A-\x0D]') AS ps FROM documents))),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang HAVING sum(len(w)) > 0),
grams AS (
  SELECT lang, m, list_slice(w, i, i + m - 1) AS ws, count(*) AS f
  FROM pieces, unnest(range(1, 6)) AS u(m), unnest(range(1, len(w) - m + 2)) AS v(i) WHERE len(w) >= m
  GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT * FROM grams WHERE m >= 2),
covered AS (
  SELECT DISTINCT s.lang, s.ws FROM cand s
  JOIN (SELECT lang, f, list_slice(ws, i, i + k - 1) AS part
        FROM cand, unnest(range(2, m)) AS u(k), unnest(range(1, m - k + 2)) AS v(i)) l
    ON l.lang = s.lang AND l.part = s.ws AND 100 * l.f >= 100 * s.f),
cuts AS (
  SELECT c.lang, c.ws, c.f AS a, k, x.f AS l, y.f AS r, t.n,
         CAST(1000 * CAST(c.f AS HUGEINT) * t.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cand c ANTI JOIN covered d ON c.lang = d.lang AND c.ws = d.ws, unnest(range(1, c.m)) AS u(k),
       grams x, grams y, totals t
  WHERE x.lang = c.lang AND x.ws = list_slice(c.ws, 1, k) AND y.lang = c.lang AND y.ws = list_slice(c.ws, k + 1, c.m)
    AND t.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank,
         array_to_string(ws, ' ') AS phrase, a, l, r, n, score FROM best)
SELECT * FROM ranked WHERE rank <= 2000
"""
