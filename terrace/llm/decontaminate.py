"""Benchmark decontamination as a prefix-filtered set join (operator 11).

A benchmark item is cut into windows of ``WINDOW`` consecutive words (an item
with fewer words is one window).  A window's set is its shingles of
``SHINGLE`` words (a window of fewer words is one shingle); a document span
holds the window only if it holds all of them, so one necessary token - the
prefix of a set at containment 1 - suffices to find every occurrence, and the
rarest shingle finds the fewest false ones.

1. The windows of all items are written out, distinct, with their items apart.
2. Rarity: one pass over all documents counts the occurrences of the windows'
   shingles.  A window one of whose shingles never occurs cannot occur and
   goes; the others keep their rarest shingle as prefix, with its place.
3. Candidates: a second pass gives, for every document place that may hold
   a prefix, the words that any window around it can span.
4. They are joined to the windows by prefix.  Positional bound: the window must
   begin inside those words; length bound: it must end inside them; then
   the words are compared, so hashes decide nothing.  Verified spans give
   the words hit, distinct windows the items.

Both passes test hashes against a bit filter of fixed size (``words.BitFilter``),
so nothing broadcast grows with the benchmark or the documents; strangers it
lets through find no partner in the join.  Rows of the join are dealt by prefix
and by one of ``SALTS`` salts of the document, so a passage that a third of
all documents repeat is not one task's.  Document texts are never shuffled: only
candidates are, with at most ``2 * WINDOW`` words each.

Defined cases: null text and text without words have no words and no hits; items
without words have no windows; an item with a null id marks words but is not
counted or listed; items that repeat an id count once; rows repeating doc_id or
text each get their own result; no item at all: sha256 of the empty string;
empty tables give an empty result, or one without hits; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.common import prepare, stored, table
from terrace.llm.shingles import mixed
from terrace.llm.words import BitFilter, Group, Hasher, bit_filter, groups, kinds

WINDOW = 10
SHINGLE = 5
SALTS = 16

# FIXED VALUES: what is not a word byte is 00-2F, 3A-40, 5B-60, 7B-7F (A-Z count as a-z).
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
KINDS = kinds(SEPARATORS)

WINDOW_SCHEMA = "item_id string, words string, n int, shingles array<long>"
COUNT_SCHEMA = "shingle long, n long"
SPAN_SCHEMA = ("row long, doc_id long, n_words long, "
               "candidates array<struct<shingle:long,place:long,lead:int,context:string>>")


def _shingles(g: Group, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on (of no meaning where the text ends before)."""
    h = np.zeros(len(g.ids), np.uint64)
    for k in range(min(size, len(h))):
        h[:len(h) - k] += mixed(g.ids[k:] + np.uint64(k + 1))
    return mixed(h + np.uint64(size))


def _whole(g: Group, size: int) -> np.ndarray:
    """Words from which ``size`` words of the same text follow, themselves included."""
    if len(g.ids) < size:
        return np.empty(0, np.int64)
    return np.flatnonzero(g.text[size - 1:] == g.text[:len(g.text) - size + 1])


def _words(g: Group, lo: int, hi: int) -> bytes:
    """Words lo to hi - 1, lower-cased, joined by one space."""
    return b" ".join(g.lowered(int(s), int(e)) for s, e in zip(g.start[lo:hi], g.end[lo:hi]))


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                 key: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, words, n, shingles: every window of every item, its shingles in order."""
    hasher = Hasher()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, out = b.column(0).to_pylist(), []
            for g in groups(b.column(1), KINDS, hasher):
                first = 0
                for t, n in enumerate(g.words().tolist()):
                    size = min(n, window)
                    part = min(size, shingle)
                    if n:
                        h = _shingles(g, part).view(np.int64)
                        for i in range(first, first + n - size + 1):
                            out.append((keys[g.first + t], _words(g, i, i + size).decode(), size,
                                        h[i:i + size - part + 1].tolist()))
                    first += n
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, x) for c, x in zip(zip(*out), [pa.string(), pa.string(), pa.int32(),
                                                                pa.list_(pa.int64())])],
                    ["item_id", "words", "n", "shingles"])

    rows = benchmark.select(F.col(key).cast("string").alias("item_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(cut, WINDOW_SCHEMA)


def shingle_counts(docs: DataFrame, wanted: BitFilter, sizes: list[int], text: str = "text") -> DataFrame:
    """shingle, n: occurrences, over all documents, of shingles that pass the filter."""
    hasher = Hasher()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g in groups(b.column(0), KINDS, hasher):
                for size in sizes:
                    h = _shingles(g, size)[_whole(g, size)]
                    seen, n = np.unique(h[wanted(h)], return_counts=True)
                    if len(seen):
                        yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(n.astype(np.int64))],
                                                         ["shingle", "n"])

    partial = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, COUNT_SCHEMA)
    return partial.groupBy("shingle").agg(F.sum("n").alias("n"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """words, n, prefix, place: each window that can occur, by its rarest shingle (ties: the smaller hash)."""
    each = windows.select("words", "n", F.posexplode("shingles").alias("place", "shingle"))
    known = each.join(counts.withColumnRenamed("n", "seen"), "shingle", "left").withColumn(
        "seen", F.coalesce("seen", F.lit(0)))
    rarest = known.groupBy("words", "n").agg(F.min(F.struct("seen", "shingle", "place")).alias("r"))
    return rarest.where(F.col("r.seen") > 0).select("words", "n", F.col("r.shingle").alias("prefix"),
                                                    F.col("r.place").alias("place"))


def spans(docs: DataFrame, wanted: BitFilter, sizes: list[int], window: int = WINDOW,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its number of words and the places that may hold a prefix, each
    with the words around it (``lead`` of them before it) that a window can span."""
    hasher = Hasher()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            n_words, found = np.zeros(b.num_rows, np.int64), [[] for _ in range(b.num_rows)]
            for g in groups(b.column(1), KINDS, hasher):
                n = g.words()
                n_words[g.first:g.first + g.n] = n
                first = np.cumsum(n) - n
                for size in sizes:
                    h = _shingles(g, size)
                    at = _whole(g, size)
                    for i in at[wanted(h[at])].tolist():
                        t = int(g.text[i])
                        begin, end = int(first[t]), int(first[t] + n[t])
                        lo, hi = max(begin, i - (window - size)), min(end, i + window)
                        found[g.first + t].append({"shingle": int(h[i].view(np.int64)), "place": i - begin,
                                                   "lead": i - lo, "context": _words(g, lo, hi).decode()})
            rows = (part << 33) + seq + np.arange(b.num_rows)
            seq += b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(rows), b.column(0), pa.array(n_words), pa.array(found, _CANDIDATES)],
                                             ["row", "doc_id", "n_words", "candidates"])

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(find, SPAN_SCHEMA)


_CANDIDATES = pa.list_(pa.struct([("shingle", pa.int64()), ("place", pa.int64()), ("lead", pa.int32()),
                                  ("context", pa.string())]))


def verified(found: DataFrame, by_prefix: DataFrame, salts: int = SALTS) -> DataFrame:
    """row, begin, n, words: every occurrence of a window in a document."""
    c = (found.select("row", F.explode("candidates").alias("c")).select("row", "c.*")
         .withColumn("salt", F.pmod("row", F.lit(salts)).cast("int")))
    w = by_prefix.withColumnRenamed("prefix", "shingle").withColumnRenamed("place", "offset").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    begin = F.col("lead") - F.col("offset")
    at = F.split("context", " ")
    met = (c.join(w, ["shingle", "salt"])
           .where((begin >= 0) & (begin + F.col("n") <= F.size(at)))
           .where(F.array_join(F.slice(at, begin + 1, F.col("n")), " ") == F.col("words")))
    return met.select("row", (F.col("place") - F.col("offset")).alias("begin"), "n", "words")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items (their ids) of every document."""
    cut = stored(item_windows(benchmark, window, shingle), "leaks_windows")
    windows = cut.select("words", "n", "shingles").distinct()
    tokens = windows.select(F.explode("shingles").alias("shingle")).distinct()
    # at most ``shingle`` different sizes
    sizes = sorted(r[0] for r in windows.select(F.least("n", F.lit(shingle)).alias("s")).distinct().collect())
    counts = shingle_counts(docs, bit_filter(tokens, "shingle"), sizes)
    by_prefix = stored(prefixes(windows, counts), "leaks_prefixes")
    first = bit_filter(by_prefix.select("prefix").distinct(), "prefix")
    found = stored(spans(docs, first, sizes, window), "leaks_candidates")

    hits = stored(verified(found, by_prefix), "leaks_hits")
    # words hit: the union of a document's spans, walked in order of their begin
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["end"], s["begin"]))).alias("n"),
        F.greatest(acc["end"], s["end"]).alias("end"))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    span = F.struct("begin", (F.col("begin") + F.col("n")).alias("end"))
    of_words = hits.groupBy("row").agg(F.sort_array(F.collect_set(span)).alias("spans")).select(
        "row", F.aggregate("spans", zero, step)["n"].alias("n_hit"))
    of_items = (hits.select("row", "words").distinct()
                .join(cut.where(F.col("item_id").isNotNull()).select("words", "item_id").distinct(), "words")
                .groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    # documents without candidates need no join
    plain = found.where(F.size("candidates") == 0).select(
        "doc_id", "n_words", F.lit(0).cast("bigint").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    held = (found.where(F.size("candidates") > 0).select("row", "doc_id", "n_words")
            .join(of_words, "row", "left").join(of_items, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))
    return plain.unionByName(held).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "items")


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


OP11_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS words
  FROM bw, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0),
grams AS (
  SELECT row, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS words
  FROM dw, (SELECT DISTINCT n FROM win) AS s, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
hit AS (SELECT row, i, n, words FROM grams WHERE words IN (SELECT words FROM win)),
words_hit AS (SELECT row, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, n)) AS u(k) GROUP BY row),
items AS (SELECT DISTINCT row, item_id FROM (SELECT DISTINCT row, words FROM hit) JOIN win USING (words)
          WHERE item_id IS NOT NULL),
listed AS (SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM items GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words_hit USING (row) LEFT JOIN listed USING (row)
"""
