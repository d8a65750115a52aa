"""Threats need an object, contractions negate, and training does not depend on partitions."""

from terrace.llm import bitplane, toxicity
from terrace.llm.common import prepare
from terrace.session import scratch_path
from tests.llm.helpers import documents
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
CLEAN = ["They beat the record in this race.", "She burned the toast and he laughed.", "He shot a photo of them.",
         "I won't kill you.", "You can\u2019t hurt me.", "We didn't destroy it, you know.", "He never hurt them.",
         "This kills time.", "They burn wood here."]
TOXIC = ["I will kill you.", "We will hurt them.", "You will get shot", "Je vais te tuer", "I'll burn all of you"]


def _train(spark, parts):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.train(docs.repartition(parts), labels.repartition(parts + 1))


def test_equal_models_whatever_the_partitions_and_clean_sentences_stay(spark):
    a, b, c = (_train(spark, n) for n in (1, 3, 7))
    assert a.lexicon == b.lexicon == c.lexicon and a.model == b.model == c.model
    assert {t: a.score(t) for t in CLEAN if a.score(t) >= 0.5} == {}
    assert {t: a.score(t) for t in TOXIC if a.score(t) < 0.5} == {}


def test_read_back_has_a_task_for_every_file(spark):
    prepare(spark)
    docs = documents(spark).repartitionByRange(7, "doc_id")
    folder = scratch_path(spark, "planes")
    import public_tokenizers
    manifest = bitplane.write_files(bitplane.encoded(docs, str(public_tokenizers.path(bitplane.TOKENIZER))), folder)
    back = bitplane.read_files(manifest, folder).withColumn("task", F.spark_partition_id())
    assert back.select("task").distinct().count() == manifest.count() == 7
    assert back.count() == docs.count()
