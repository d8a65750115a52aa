"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import scratch_path

# White space of all text contracts: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Rows per Arrow batch handed to a Python worker: bounds its memory with long texts.
ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage at files that every executor can read, so a lost
    executor costs a reread, not the work above.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_text(doc_id: Column) -> Column:
    """A row key as text for seeded hashing; null has a fixed text of its own."""
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def repacked(docs: DataFrame, decisions: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``docs`` (every column) whose ``on`` columns occur in ``decisions``.

    ``docs`` columns are packed into one struct, so no extra column can
    clash with a working column.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    keys = decisions.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(on)])
    cond = None
    for i, c in enumerate(on):
        e = F.col("row")[c].eqNullSafe(F.col(f"k{i}"))
        cond = e if cond is None else cond & e
    return packed.join(keys, cond, "left_semi").select("row.*")
