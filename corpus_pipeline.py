"""The corpus pipeline: documents in, sampled piece ids out.

Five stages, each taking (spark, docs, sf_dir): toxic documents go, of equal
texts one stays, of near copies one stays, sources are mixed to their target
weights, and the mix is encoded.  Every stage but the last returns the
columns of ``documents``; ``run`` writes each result to the shared folder
and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import exact_dedup, mixing, ngram_join, pieces, toxicity
from terrace.llm.common import prepare, stored, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.repeated(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_ids, ids, lossless: a row, with a draw of its own, for every repetition in the mix."""
    prepare(spark)
    return pieces.encode(docs, keep=["source"], repetitions=True).select(
        "doc_id", "source", F.size("ids").cast("bigint").alias("n_ids"), "ids", "lossless")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

# The classifier, the sampled segmentation and the component search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
