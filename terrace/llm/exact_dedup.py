"""Exact dedup over content-defined chunk recipes (operator 5), DataFrame functions only.

A normalised text is cut where its own content says so (after a word that
ends in a vowel and a rare letter, within length bounds), so equal texts
get equal cuts and one regular-expression pass cuts a document.  Its recipe
is the ordered list of its chunks' 64-bit identifiers.  Identifiers are
verified: every distinct (identifier, chunk) pair is gathered once -
combined map-side, so a chunk held by a third of all rows ships once per
task - and an identifier that names two different chunks is a collision.
Documents then compare by recipe lists of a few longs per kilobyte; texts
do not move again.  Documents with a colliding identifier also carry their
whole text in the comparison, so the result is exact whatever the hash does.

Defined cases: null text counts as empty; a null row key loses to any other
key; rows repeating both key and text keep one row; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.common import SPACE, prepare, stored, table

MIN_CHUNK, MAX_CHUNK = 512, 8192
# A cut falls after this content, or at the greatest length, or at the end.
CUT = r"[aeiou][gklmpwyz] "
CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 1}}}?(?:{CUT}|\z)|.{{1,{MAX_CHUNK}}}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def chunks(norm: Column) -> Column:
    return F.regexp_extract_all(norm, F.lit(CHUNK), F.lit(0))


def colliding_documents(docs: DataFrame, norm: str, identify) -> DataFrame:
    """Texts' digests (``sha``) of documents with an identifier of two different chunks."""
    pieces = docs.select("sha", F.explode(chunks(F.col(norm))).alias("chunk"))
    pieces = pieces.select("sha", "chunk", identify(F.col("chunk")).alias("chunk_id"))
    dictionary = pieces.select("chunk_id", "chunk").distinct()
    bad = dictionary.groupBy("chunk_id").count().where("count > 1").select("chunk_id")
    return pieces.select("sha", "chunk_id").join(bad, "chunk_id", "left_semi").select("sha").distinct()


def recipes(docs: DataFrame, identify=F.xxhash64) -> DataFrame:
    """doc_id, sha, recipe, residue per document.

    ``residue`` is empty, or the whole text where an identifier collided.
    """
    normed = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    normed = normed.withColumn("sha", F.sha2("norm", 256))
    plain = stored(normed.select("doc_id", "sha", F.transform(chunks(F.col("norm")), lambda c: identify(c)).alias("recipe")),
                   "recipes")
    bad = stored(colliding_documents(normed, "norm", identify), "recipe_collisions")
    if bad.isEmpty():
        return plain.withColumn("residue", F.lit(""))
    texts = normed.join(bad, "sha", "left_semi").select("sha", "norm").distinct()
    return (plain.join(texts, "sha", "left")
                 .select("doc_id", "sha", "recipe", F.coalesce("norm", F.lit("")).alias("residue")))


def exact_groups(docs: DataFrame, identify=F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = recipes(docs, identify)
    key = ["recipe", "residue"]
    groups = rows.groupBy(*key).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Rows that repeat both key and text are numbered by a count, so that one of them stays.
    counted = rows.groupBy(*key, "sha", "doc_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    joined = counted.join(groups, key).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return joined.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, every input column; of rows repeating key and text, one."""
    keep = exact_groups(docs).where("kept").select(F.col("doc_id").alias("k"), F.col("text_sha256").alias("h"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col("doc_id").alias("d"), F.sha2(normalised(F.col("text")), 256).alias("s"))
    kept = packed.join(keep, F.col("d").eqNullSafe(F.col("k")) & (F.col("s") == F.col("h")))
    return kept.dropDuplicates(["k", "h"]).select("row.*")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(prepare(spark), sf_dir, "documents"))


OP5_SQL = """
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size,
       t.doc_id IS NOT DISTINCT FROM g.keep_id
         AND row_number() OVER (PARTITION BY t.norm, t.doc_id) = 1 AS kept,
       sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""
