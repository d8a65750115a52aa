"""Landing -> raw flows over drops derived from the benchmark tables.

The customer drops (:func:`terrace.sources.feeds.customer_drops`) are
written as stamped CSV drops under the shared checkpoint folder, then read
back through the landing reader, the raw writer, the batch reader and the
streaming ingester - the same code a production run uses on real drops.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.casts import typed_projection
from terrace.operators.control import control_raw, read_audit, reconcile, write_audit
from terrace.operators.digests import reconcile_content
from terrace.operators.merge import has_key
from terrace.plans import batch
from terrace.plans.flows import customer_history
from terrace.schema import CUSTOMERS, ORDER_ITEMS, REF_FILE
from terrace.session import scratch_path
from terrace.sources import feeds, landing
from terrace.sources.feeds import BATCH_TS, CUSTOMER_DROP_STAMPS, PROC_STAMP, REF_DAY_1, REF_DAY_2
from terrace.streaming.ingest import ingest_available

# Zone and path names written into the audit rows (relative, portable).
LANDING_ZONE = "landzone"
RAW_ZONE = "raw"
# Stamps of the drops that a stream has to reject in part or as a whole.
SPOILT_DROP = 19950201000000
DRIFTED_DROP = 19950301000000


@dataclass
class Lake:
    landing_root: str
    raw_path: str

    @property
    def folder(self) -> str:
        return f"{self.landing_root}/{CUSTOMERS.folder}"


def write_customer_drops(spark: SparkSession, sf_dir: str, with_bad_name: bool = True) -> Lake:
    """Three stamped drops (and one drop without a stamp in its name)."""
    root = scratch_path(spark, "lake")
    lake = Lake(landing_root=f"{root}/landing", raw_path=f"{root}/raw/{CUSTOMERS.folder}")
    drops = feeds.customer_drops(spark, sf_dir)
    for i, stamp in enumerate(CUSTOMER_DROP_STAMPS, start=1):
        landing.write_drop(drops.where(F.col("drop_no") == i), lake.landing_root,
                           CUSTOMERS.folder, stamp, CUSTOMERS.landing)
    if with_bad_name:
        (drops.where(F.col("drop_no") == 1).select(*CUSTOMERS.landing)
              .write.mode("overwrite").option("header", True)
              .csv(f"{lake.folder}/{CUSTOMERS.folder}_latest.csv"))
    return lake


def land_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows of the stamped drops (S1 + P2); the unstamped drop is rejected."""
    lake = write_customer_drops(spark, sf_dir)
    scanned = landing.read_landing(spark, lake.folder, CUSTOMERS.landing)
    return landing.accepted(scanned, CUSTOMERS.landing)


def raw_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw projection of all drops for one batch day."""
    lake = write_customer_drops(spark, sf_dir)
    scanned = landing.read_landing(spark, lake.folder, CUSTOMERS.landing)
    return landing.to_raw(scanned, CUSTOMERS.landing, REF_DAY_1)


def _ingest_days(spark: SparkSession, sf_dir: str) -> Lake:
    """Drops 1-2 on day 1, drop 3 on day 2, then drop 2 replayed."""
    lake = write_customer_drops(spark, sf_dir, with_bad_name=False)
    scanned = landing.read_landing(spark, lake.folder, CUSTOMERS.landing)
    stamps_day1 = list(CUSTOMER_DROP_STAMPS[:2])
    day1 = scanned.where(F.col(REF_FILE).isin(stamps_day1))
    day2 = scanned.where(F.col(REF_FILE) == F.lit(CUSTOMER_DROP_STAMPS[2]))
    landing.write_raw(landing.to_raw(day1, CUSTOMERS.landing, REF_DAY_1), lake.raw_path)
    landing.write_raw(landing.to_raw(day2, CUSTOMERS.landing, REF_DAY_2), lake.raw_path)
    replay = scanned.where(F.col(REF_FILE) == F.lit(CUSTOMER_DROP_STAMPS[1]))
    landing.write_raw(landing.to_raw(replay, CUSTOMERS.landing, REF_DAY_1), lake.raw_path)
    return lake


def raw_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_raw(spark, _ingest_days(spark, sf_dir).raw_path)


def batch_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_batch(spark, _ingest_days(spark, sf_dir).raw_path, REF_DAY_2)


def control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = landing.read_raw(spark, _ingest_days(spark, sf_dir).raw_path)
    return control_raw(raw, "raw_customers", LANDING_ZONE, RAW_ZONE,
                       f"ecommerce/{CUSTOMERS.folder}/", f"ecommerce/{CUSTOMERS.folder}",
                       PROC_STAMP)


def audit_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit log after one batch wrote its rows twice (K3): each row once."""
    audit, path = control_rows(spark, sf_dir), scratch_path(spark, "control")
    for _ in range(2):
        write_audit(audit, path, "b1")
    return read_audit(spark, path)


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing vs raw vs trusted per drop (O5): half of drop 3 is not in raw yet, and the
    trusted table was merged from drops 1 and 2 without every tenth customer."""
    lake = write_customer_drops(spark, sf_dir, with_bad_name=False)
    scanned = landing.read_landing(spark, lake.folder, CUSTOMERS.landing)
    key = F.col("customer_id").cast("bigint")
    arrived = scanned.where((F.col(REF_FILE) != F.lit(CUSTOMER_DROP_STAMPS[2])) | (key % 2 == 0))
    landing.write_raw(landing.to_raw(arrived, CUSTOMERS.landing, REF_DAY_1), lake.raw_path)
    merged = customer_history(spark, sf_dir, (1, 2)).where(key % 10 != 0)
    return reconcile(scanned, landing.read_raw(spark, lake.raw_path), trusted=merged, keys=CUSTOMERS.keys)


def content_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing vs raw by content (O5).  In raw, every 101st customer of drop 2 has another city and
    every 103rd of drop 3 is swapped for a copy of its neighbour, so all counts balance."""
    lake = write_customer_drops(spark, sf_dir, with_bad_name=False)
    scanned = landing.accepted(landing.read_landing(spark, lake.folder, CUSTOMERS.landing), CUSTOMERS.landing)
    key, stamp = F.col("customer_id").cast("bigint"), F.col(REF_FILE)
    city = F.when((stamp == CUSTOMER_DROP_STAMPS[1]) & (key % 101 == 0), F.lit("ELSEWHERE"))
    gone = (stamp == CUSTOMER_DROP_STAMPS[2]) & (key % 103 == 0)
    copied = (stamp == CUSTOMER_DROP_STAMPS[2]) & (key % 103 == 102)
    raw = (scanned.where(~gone).withColumn("customer_city", F.coalesce(city, F.col("customer_city")))
           .withColumn("_n", F.explode(F.when(copied, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_n"))
    raw.write.parquet(lake.raw_path)
    found = reconcile_content(scanned, spark.read.parquet(lake.raw_path), CUSTOMERS.keys, CUSTOMERS.landing, REF_FILE,
                              f"{lake.raw_path}_ranges")
    return found.withColumn("columns", F.array_join("columns", ","))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every drop lands as several part files.  Run 1 meets drop 1 and half of drop 2, run 2
    the rest of drop 2 and drop 3, in micro-batches of two files; a third run finds nothing."""
    root = scratch_path(spark, "stream")
    landing_root, raw_path, ckpt = f"{root}/landing", f"{root}/raw", f"{root}/_checkpoint"
    folder = f"{landing_root}/{CUSTOMERS.folder}"
    drops = feeds.customer_drops(spark, sf_dir).repartition(3, "customer_id")
    half = F.col("customer_id").cast("bigint") % 2 == 0

    def land(drop_no: int, rows: DataFrame) -> None:
        landing.write_drop(rows.where(F.col("drop_no") == drop_no), landing_root, CUSTOMERS.folder,
                           CUSTOMER_DROP_STAMPS[drop_no - 1], CUSTOMERS.landing, mode="append")

    land(1, drops)
    land(2, drops.where(half))
    ingest_available(spark, folder, CUSTOMERS.landing, raw_path, ckpt, REF_DAY_1, max_files=2)
    land(2, drops.where(~half))
    land(3, drops)
    for _ in range(2):
        ingest_available(spark, folder, CUSTOMERS.landing, raw_path, ckpt, REF_DAY_2, max_files=2)
    return landing.read_raw(spark, raw_path)


def _two_days(spark: SparkSession, sf_dir: str) -> batch.Lake:
    """Customer drops over two batch days from one landing folder, day 2 run twice."""
    root = scratch_path(spark, "two_days")
    drops = feeds.customer_drops(spark, sf_dir)

    def land(drop_no: int) -> None:
        landing.write_drop(drops.where(F.col("drop_no") == drop_no), f"{root}/landing", CUSTOMERS.folder,
                           CUSTOMER_DROP_STAMPS[drop_no - 1], CUSTOMERS.landing)

    land(1)
    land(2)
    batch.run_trusted(spark, f"{root}/landing", f"{root}/lake", REF_DAY_1, "b1", BATCH_TS, entities=[CUSTOMERS])
    land(3)
    for _ in range(2):
        batch.run_trusted(spark, f"{root}/landing", f"{root}/lake", REF_DAY_2, "b2", BATCH_TS, "b1",
                          entities=[CUSTOMERS])
    return batch.Lake(f"{root}/lake")


def run_batch_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_raw(spark, _two_days(spark, sf_dir).raw(CUSTOMERS))


def run_batch_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_days(spark, sf_dir).read(spark, CUSTOMERS, "b2")


def spoilt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop 1 as text lines: some end early, some have a field too many, some leave a quote open."""
    k = F.col("customer_id").cast("bigint")
    line = F.concat_ws(",", *CUSTOMERS.landing)
    spoilt = (F.when(k % 97 == 0, F.concat_ws(",", "customer_id", "customer_unique_id"))
              .when(k % 89 == 0, F.concat(line, F.lit(",surplus")))
              .when(k % 83 == 0, F.concat(F.lit('"'), line)).otherwise(line))
    return feeds.customer_drops(spark, sf_dir).where(F.col("drop_no") == 1).select(spoilt.alias("line"))


def write_lines(lines: DataFrame, path: str, header: str) -> None:
    """Text lines as files that each begin with ``header``."""
    def with_header(batches):
        first = True
        for b in batches:
            values = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(([header] if first else []) + values, pa.string())], ["value"])
            first = False
    lines.mapInArrow(with_header, "value string").write.mode("overwrite").text(path)


def landing_rejects(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(raw, rejected) paths after a stream met a drop with spoilt lines, a drop whose header
    names two columns in the other order, a drop without a stamp, and good drops."""
    lake = write_customer_drops(spark, sf_dir)
    cols = list(CUSTOMERS.landing)
    write_lines(spoilt_lines(spark, sf_dir), landing.drop_path(lake.landing_root, CUSTOMERS.folder, SPOILT_DROP),
                ",".join(cols))
    swapped = [cols[1], cols[0], *cols[2:]]
    (feeds.customer_drops(spark, sf_dir).where(F.col("drop_no") == 2).select(*swapped)
     .write.option("header", True).csv(landing.drop_path(lake.landing_root, CUSTOMERS.folder, DRIFTED_DROP)))
    ingest_available(spark, lake.folder, CUSTOMERS.landing, lake.raw_path, f"{lake.raw_path}_checkpoint", REF_DAY_1)
    return lake.raw_path, f"{lake.raw_path}_rejected"


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows by reason: item landings with spoilt keys and values; drops with spoilt
    lines, another header, or no stamp."""
    items = feeds.item_landing(spark, sf_dir)
    order = F.col("order_id").cast("bigint")
    spoilt = items.withColumns({
        "order_item_id": F.when(order % 97 == 0, F.lit("x")).otherwise(F.col("order_item_id")),
        "price": F.when(order % 89 == 0, F.lit("n/a")).otherwise(F.col("price"))})
    typed = typed_projection(spoilt, ORDER_ITEMS, reject_col="n")
    by_kind = typed.agg(F.count_if(~has_key(ORDER_ITEMS.keys)).alias("item_without_key"),
                        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("item_values"))
    of_items = by_kind.unpivot([], ["item_without_key", "item_values"], "reason", "nu_rows")
    _, rejected = landing_rejects(spark, sf_dir)
    return of_items.unionByName(spark.read.parquet(rejected).groupBy("reason").agg(
        F.count(F.lit(1)).alias("nu_rows")))


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every line that did not fit, as it landed."""
    _, rejected = landing_rejects(spark, sf_dir)
    return (spark.read.parquet(rejected).where(F.col("reason") == "malformed_line")
            .select("reason", landing.LANDING_LINE))
