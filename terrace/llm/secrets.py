"""Secret scans over an incremental blob ledger (operator 6), DataFrame functions only.

Every text version is a blob addressed by its SHA-256.  The ledger holds
one row per (blob, rule version) scanned, with its spans.  A scan takes the
distinct blobs of the given rows, pairs them with the rule versions asked
for, drops the pairs the ledger has, scans the rest once each, and appends
them; findings are then joined back to every row (path) that holds the
blob.  A rerun on the same rows scans nothing; a changed text or a new rule
version scans only what is new.

Spans: for a pattern, the matches (``regexp_extract_all``) and the pieces
between them (``split``) have the same leftmost non-overlapping cuts, so a
running sum of both lengths gives code point offsets.

Rule versions: ``base-1`` has the kinds assign, access and hex; ``keys-1``
adds key blocks and provider token formats.  Defined cases: null text is
empty (no span); repeated rows each get their findings; a null row key
stays null; an empty table gives an empty result and an empty ledger batch;
other columns are not read.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.common import prepare, table
from terrace.session import scratch_path

# Fixed patterns of the base rules; the number is the least length of the group named.
KEYWORD = r"(?i:(?:password|passwd|secret|token|api_?key))"
ASSIGN = KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES = {
    "base-1": [("assign", ASSIGN, 1, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]{24,}", 0, 24)],
    "keys-1": [("keyblock", r"-----BEGIN[A-Z\x20]{0,40}PRIVATE KEY-----", 0, 1),
               ("provider", r"(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10}|sk_live_[A-Za-z0-9]{16})"
                            r"[A-Za-z0-9-]*", 0, 1)],
}
BASE = "base-1"
BASE_KINDS = ["assign", "access", "hex"]
SPAN = "struct<start:int,kind_order:int,kind:string,end:int>"
LEDGER_SCHEMA = f"blob string, rule_version string, spans array<{SPAN}>"


def _spans(text: Column, kind: str, order: int, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind in one text: array of (start, kind_order, kind, end)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pieces = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.zip_with(found, measured, lambda m, g: F.struct(F.length(m).alias("len"), F.length(g).alias("size"))),
        F.slice(pieces, F.lit(1), F.size(found)),
        lambda m, p: F.struct(F.length(p).alias("gap"), m["len"].alias("len"), m["size"].alias("size")))
    none = F.array().cast(f"array<{SPAN}>")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(acc: Column, s: Column) -> Column:
        a = acc["at"] + s["gap"]
        span = F.struct(a.alias("start"), F.lit(order).alias("kind_order"), F.lit(kind).alias("kind"),
                        (a + s["len"]).alias("end"))
        return F.struct((a + s["len"]).alias("at"),
                        F.when(s["size"] >= least, F.concat(acc["spans"], F.array(span)))
                         .otherwise(acc["spans"]).alias("spans"))

    listed = F.aggregate(steps, start, step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), listed).otherwise(none)


def _version_spans(text: Column, version: str) -> Column:
    order = {kind: i for i, kind in enumerate(k for rules in RULES.values() for k, *_ in rules)}
    return F.array_sort(reduce(lambda a, b: F.concat(a, b), [
        _spans(text, kind, order[kind], pattern, group, least) for kind, pattern, group, least in RULES[version]]))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], LEDGER_SCHEMA)
        raise


def scan_unseen(docs: DataFrame, ledger: str, versions: list[str]) -> None:
    """Scan the (blob, rule version) pairs that the ledger lacks and append them.

    A batch is a folder of its own, written whole or not at all; a failed
    scan leaves nothing behind that a rerun would count as seen.
    """
    spark = docs.sparkSession
    blobs = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(
        F.sha2("text", 256).alias("blob"), "text")
    known = read_ledger(spark, ledger).groupBy("blob").agg(F.collect_set("rule_version").alias("seen"))
    wanted = F.array(*[F.lit(v) for v in versions])
    # One copy of each blob; combined map-side, so copies of a hot text ship once per task.
    once = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    unseen = (once.join(known, "blob", "left")
              .withColumn("due", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
              .where(F.size("due") > 0))
    results = F.array(*[F.when(F.array_contains("due", v),
                               F.struct(F.lit(v).alias("rule_version"), _version_spans(F.col("text"), v).alias("spans")))
                        for v in versions])
    (unseen.select("blob", F.explode(F.filter(results, lambda r: r.isNotNull())).alias("r"))
           .select("blob", "r.rule_version", "r.spans")
           .write.parquet(f"{ledger}/batch={uuid.uuid4().hex[:12]}"))


def findings(docs: DataFrame, ledger: str, versions: list[str]) -> DataFrame:
    """doc_id, blob, spans (of all ``versions``, by start then kind) for every row."""
    paths = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"))
    held = (read_ledger(docs.sparkSession, ledger).where(F.col("rule_version").isin(versions))
            .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")))
    return paths.join(held, "blob").select("doc_id", "blob", "spans")


def scan(docs: DataFrame, ledger: str, versions: list[str] | None = None) -> DataFrame:
    versions = versions or list(RULES)
    scan_unseen(docs, ledger, versions)
    return findings(docs, ledger, versions)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    found = scan(docs, scratch_path(spark, "secret_ledger"))
    base = F.filter("spans", lambda s: s["kind"].isin(BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))
