"""run_batch end to end: landing drops of all entities over two batch days."""

import datetime as dt

from pyspark.sql import functions as F

from terrace.operators.control import read_audit
from terrace.plans import flows
from terrace.plans.batch import Lake, run_batch, run_trusted
from terrace.schema import CUSTOMERS, ORDER_ITEMS, ORDER_PAYMENTS, ORDERS, PRODUCTS
from terrace.session import scratch_path
from terrace.sources import feeds, landing
from tests.conftest import SF_SMALL, rows

DAY1, DAY2 = 20240111, 20240112


def _drop(df, root, entity, stamp):
    landing.write_drop(df, root, entity.folder, stamp, entity.landing)


def test_run_batch_two_days(spark):
    base = scratch_path(spark, "batch")
    land, lake_root = f"{base}/landing", f"{base}/lake"      # one landing folder for all days
    drops = feeds.customer_drops(spark, SF_SMALL)
    for i, stamp in enumerate(feeds.CUSTOMER_DROP_STAMPS[:2], start=1):
        _drop(drops.where(F.col("drop_no") == i), land, CUSTOMERS, stamp)
    hist = feeds.order_history(spark, SF_SMALL)
    _drop(feeds.as_landing(hist.where(F.col("order_status") == "O"), ORDERS), land, ORDERS, 20240110000000)
    items = feeds.item_observations(spark, SF_SMALL)
    _drop(feeds.as_landing(items, ORDER_ITEMS), land, ORDER_ITEMS, 20240110000000)
    bad = spark.createDataFrame([("o", "x", "p", "s", None, "1", "1")] * 3, ",".join(f"{c} string" for c in ORDER_ITEMS.landing))
    _drop(bad, land, ORDER_ITEMS, 20240110000001)            # three rows without a usable key
    _drop(feeds.as_landing(feeds.payment_observations(spark, SF_SMALL), ORDER_PAYMENTS), land, ORDER_PAYMENTS,
          20240110000000)
    prods = feeds.product_observations(spark, SF_SMALL)
    _drop(feeds.as_landing(prods.where(F.col("ref_file_extraction") < 20190101000000), PRODUCTS), land,
          PRODUCTS, 20240110000000)

    ts = dt.datetime(2024, 1, 11)
    m1 = run_batch(spark, land, lake_root, DAY1, "b1", ts)
    # day 2: customers and orders only
    _drop(drops.where(F.col("drop_no") == 3), land, CUSTOMERS, feeds.CUSTOMER_DROP_STAMPS[2])
    _drop(feeds.as_landing(hist.where(F.col("order_status") != "O"), ORDERS), land, ORDERS, 20240111000000)
    m2 = run_batch(spark, land, lake_root, DAY2, "b2", ts, previous_batch_id="b1")
    lake = Lake(lake_root)
    n_orders = feeds.table(spark, SF_SMALL, "orders").count()
    closed = hist.where(F.col("order_status") != "O").count()
    assert m1["orders"]["ins"] == n_orders and m1["orders"]["upd"] == 0
    assert m2["orders"]["upd"] == closed and m2["orders"]["ins"] == 0
    assert m1["order_items"]["rejects"] == 3 and m1["order_items"]["keyless"] == 3
    assert spark.read.parquet(lake.rejected(ORDER_ITEMS, "b1")).count() == 3
    assert m2["order_items"] == {"ins": 0, "upd": 0, "del": 0, "touched": 0, "rows": m1["order_items"]["rows"],
                                 "rejects": 0, "keyless": 0}
    # trusted customers after both days == history over all three drops
    got = lake.read(spark, CUSTOMERS, "b2")
    cols = ["customer_id", "customer_city", "ts_start_date", "ts_end_date", "flag_scd_active"]
    assert rows(got, *cols) == rows(flows.customer_history(spark, SF_SMALL), *cols)
    # each landed row is in raw once, on the day it arrived
    raw = landing.read_raw(spark, lake.raw(CUSTOMERS))
    n = drops.where("drop_no = 1").count()
    assert rows(raw.groupBy("ref_day").count()) == [(DAY1, 2 * n), (DAY2, n)]
    # audit: one raw row per (day, drop) and entity; one trusted row per merge
    audit = read_audit(spark, lake.control("raw"))
    assert audit.where(F.col("str_process") == "raw_customers").count() == 3
    merges = read_audit(spark, lake.control("trusted"))
    assert merges.count() == 10                              # 5 merges x 2 days
    assert merges.where("str_process = 'trusted_customers' AND num_inserted_rows = 0").count() == 0
    # fact: every item row plus every order without items
    fact = lake.read_fact(spark, "b2")
    n_items = lake.read(spark, ORDER_ITEMS, "b2").count()
    no_items = fact.where(F.col("order_item_id").isNull()).count()
    assert fact.count() == n_items + no_items
    assert spark.read.parquet(lake.refined("aggregate_sales_performance_by_city", "b2")).count() > 0
    refined = read_audit(spark, lake.control("refined"))
    assert refined.count() == 12                             # 6 tables x 2 days
    assert refined.where("str_process = 'refined_dw_fact_orders'").orderBy("nu_qtd_rows").collect()[-1].nu_qtd_rows == fact.count()
    audit, merges = rows(audit), rows(merges)
    # a batch that died half-way reruns under the same id: nothing is ingested or audited twice
    run_trusted(spark, land, lake_root, DAY2, "b2", ts, previous_batch_id="b1")
    assert rows(lake.read(spark, CUSTOMERS, "b2"), *cols) == \
        rows(flows.customer_history(spark, SF_SMALL), *cols)
    assert landing.read_raw(spark, lake.raw(CUSTOMERS)).count() == 3 * n
    assert rows(read_audit(spark, lake.control("raw"))) == audit
    assert rows(read_audit(spark, lake.control("trusted"))) == merges
    # replaying day 2 into a new version changes nothing
    run_trusted(spark, land, lake_root, DAY2, "b3", ts, previous_batch_id="b2")
    for e in (CUSTOMERS, ORDERS, ORDER_ITEMS):
        assert rows(lake.read(spark, e, "b2")) == rows(lake.read(spark, e, "b3"))
