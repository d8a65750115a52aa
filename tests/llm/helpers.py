"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing names."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns with names that operators use inside.
EXTRA = ["n", "key", "kept", "size", "row", "score", "spans", "blob", "ids", "token", "cluster", "seen", "norm",
         "sha", "recipe", "target", "taken", "m", "t", "d", "s"]
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"

ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n ", "en", "a", 4),
    (None, BASE, "en", "a", 90),
    (4, BASE, "en", "b", 90),
    (4, BASE, "en", "b", 90),
    (5, BASE.replace(" ", "\n  "), None, "b", 99),
    (6, BASE + " seventeen", "en", None, 100),
    (7, "a b", "en", "c", 3),
    (8, "A  B", "en", "c", 4),
    (9, "lorem ipsum dolor sit amet, " * 4000, "la", "c", 112000),
    (10, "x" * 50_000, "la", "c", 50000),
]


def odd_docs(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    return df.withColumns({c: F.lit("extra") for c in EXTRA})


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf}/documents.parquet")
