"""Mixing sources to target weights by capped water-filling (operator 3).

Each source's target is its weighted share of the mix, clamped at
``max_epochs`` times the source's size; what a clamped source cannot take
is shared again by weight among the rest until no target is above its cap.
With sources sorted by cap / weight the repeated resharing has a closed
form: before source ``i`` the level is (mix - caps before) / (weights from
i on); it rises while sources are clamped and falls afterwards, so the
final level is its maximum and a target is min(cap, level * weight).  That
window runs over one row per source.

Sampling: the target is whole repetitions of the source plus a rest.  The
rest goes to its documents in seeded random order (md5 of seed and row
key): documents before the cut get one more whole repetition, the document
at the cut a fraction of one, so a source's taken words are its rounded
target.  The running sum is two-level - per 1/4096 slice of the hash, then
inside a slice - so a source holding a third of all rows is 4096 groups.

Defined cases: null text has size 0 (taken 0); null source is a source,
ranked last; a null row key is hashed as ``null``; repeated rows are
separate rows; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm.common import WORD, key_text, prepare, stored, table

WEIGHTS = (5, 2, 1)      # by source in code point order, repeating
SHARE = 1.5              # words of the mix per word of the input
MAX_EPOCHS = 2
SEED = "mix-1"
SLICE_DIGITS = 3         # 16**3 slices of the hash order per source


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, size) rows -> one row per source: source, source_size, target.

    The unpartitioned windows run over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((rank - 1) % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    ranked = (per_source.withColumn("weight", weight).withColumn("rank", rank)
              .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
              .withColumn("mix", F.sum("source_size").over(everything) * F.lit(float(share)))
              .withColumn("weights", F.sum("weight").over(everything)))
    before = (Window.orderBy(F.col("cap") / F.col("weight"), "rank")
              .rowsBetween(Window.unboundedPreceding, -1))
    level = ((F.col("mix") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    return (ranked.withColumn("level", level)
            .withColumn("level", F.max("level").over(everything))
            .select("source", "source_size",
                    F.least(F.col("cap"), F.col("level") * F.col("weight")).alias("target")))


def mix(docs: DataFrame, seed: str = SEED, weights: Sequence[float] = WEIGHTS,
        share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    order_key = F.md5(F.concat(F.lit(seed + ":"), key_text(F.col("doc_id"))))
    sized = stored(docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        order_key.alias("order_key"))
        .withColumn("slice", F.substring("order_key", 1, SLICE_DIGITS)), "mix_sizes")
    targets = source_targets(sized, weights, share, max_epochs)
    goal = F.floor(F.col("target") + 0.5).cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0)
    targets = (targets.withColumn("whole", whole.cast("bigint"))
                      .withColumn("rest", goal - F.col("whole") * F.col("source_size")))
    earlier = (Window.partitionBy("source").orderBy("slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    slices = (sized.groupBy("source", "slice").agg(F.sum("size").alias("in_slice"))
              .withColumn("before_slice", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)))
              .select(F.col("source").alias("s_source"), F.col("slice").alias("s_slice"), "before_slice"))
    plan = (slices.join(targets, F.col("s_source").eqNullSafe(F.col("source")))
                  .drop("source"))
    inside = (Window.partitionBy("source", "slice").orderBy("order_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = sized.withColumn("in_order", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(plan, F.col("source").eqNullSafe(F.col("s_source"))
                         & (F.col("slice") == F.col("s_slice")))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before_slice")
                                        - F.col("in_order")))
    return joined.select("doc_id", "source", "size", "source_size", "target",
                         (F.col("whole") * F.col("size") + part).cast("bigint").alias("taken"))


def repeated(docs: DataFrame, **kw) -> DataFrame:
    """The mixed documents themselves, every input column: a row per repetition.

    A fractional repetition holds the document's first words, joined by one
    space, with ``n_chars`` (where present) of that text.  Repeated rows
    share one decision per (doc_id, source, size).
    """
    words = F.regexp_count("text", F.lit(WORD))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col("doc_id").alias("d"), F.col("source").alias("s"),
                        F.coalesce(words, F.lit(0)).cast("bigint").alias("n"))
    decided = (mix(docs, **kw).groupBy("doc_id", "source", "size")
               .agg(F.max("taken").alias("taken")))
    joined = keyed.join(decided, F.col("d").eqNullSafe(F.col("doc_id"))
                        & F.col("s").eqNullSafe(F.col("source")) & (F.col("n") == F.col("size")))
    whole = F.floor(F.col("taken") / F.col("n")).cast("int")
    rest = (F.col("taken") - whole * F.col("n")).cast("int")
    copies = joined.where(F.col("taken") > 0).select(
        "row", "n", F.explode(F.concat(F.array_repeat(F.col("n").cast("int"), whole),
                                       F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>"))))
        .alias("m"))
    part = F.array_join(F.slice(F.regexp_extract_all(F.col("row")["text"], F.lit(WORD), F.lit(0)),
                                F.lit(1), F.col("m")), " ")
    text = F.when(F.col("m") < F.col("n"), part).otherwise(F.col("row")["text"])
    out = copies.select("row", "m", "n", text.alias("t"))
    made = {"text": F.col("t"),
            "n_chars": F.when(F.col("m") < F.col("n"), F.length("t")).otherwise(F.col("row")["n_chars"])
            if "n_chars" in docs.columns else None}
    types = dict(docs.dtypes)
    return out.select(*[(made[c].cast(types[c]) if made.get(c) is not None else F.col("row")[c]).alias(c)
                        for c in docs.columns])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(prepare(spark), sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


OP3_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM per),
weighed AS (
  SELECT *, CAST(CASE (r - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w,
         source_size * CAST(2 AS DOUBLE) AS cap,
         CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS mix FROM ranked),
levels AS (
  SELECT *, (mix - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS lvl
  FROM weighed
  WINDOW b AS (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(cap, max(lvl) OVER () * w) AS target FROM levels),
goals AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS goal,
         CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS whole
  FROM targets),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id NULLS FIRST, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized)
SELECT p.doc_id, p.size, g.source_size, g.target,
       CAST(g.whole * p.size + greatest(0, least(p.size, g.goal - g.whole * g.source_size - p.before))
            AS BIGINT) AS taken
FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source
"""
