"""End-to-end flows over the benchmark tables, one per registered query.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame; the flows only
compose feeds (:mod:`terrace.sources.feeds`) with the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.control import control_trusted
from terrace.operators.merge import keyed, merge_metrics
from terrace.operators.scd2 import ACTIVE, changed_rows, scd2_build, scd2_changes, scd2_metrics
from terrace.operators.temporal import asof_left_join, temporal_left_join
from terrace.plans import marts, star, trusted
from terrace.schema import CUSTOMERS, ORDER_ITEMS, ORDER_PAYMENTS, ORDERS, PRODUCTS, REF_FILE
from terrace.session import scratch_path
from terrace.sources import feeds
from terrace.sources.snapshots import write_snapshot
from terrace.sources.feeds import BATCH_TS, CUSTOMER_DROP_STAMPS, CUTOFF_STAMP, PROC_STAMP, PRODUCT_CUTOFF_STAMP

# Each customer drop is a full snapshot with one row per customer, so a
# customer has at most one observation - hence at most one version - per drop.
CUSTOMER_VERSIONS_BOUND = len(CUSTOMER_DROP_STAMPS)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A snapshot of ``df`` in the shared folder (K2): its readers do not compute it again."""
    return write_snapshot(df, scratch_path(spark, name))


def customer_history(spark: SparkSession, sf_dir: str, drops=(1, 2, 3)) -> DataFrame:
    return trusted.customer_history(feeds.customer_observations(spark, sf_dir, drops),
                                    rows_bound=CUSTOMER_VERSIONS_BOUND)


def customer_history_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops arrive 1, 3, then 2 late, holding only customers that may move: those
    keys are rebuilt, the stored versions of all others pass through."""
    early = stored(spark, customer_history(spark, sf_dir, (1, 3)), "customers_early")
    all_obs = feeds.customer_observations(spark, sf_dir, (1, 2, 3), delta_drop=2)
    late = feeds.customer_observations(spark, sf_dir, (2,), delta_drop=2)
    return trusted.customer_history_late(early, all_obs, late, rows_bound=CUSTOMER_VERSIONS_BOUND)


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version changes a merge of drop 2 applies to the history of drop 1."""
    old = customer_history(spark, sf_dir, (1,))
    new = customer_history(spark, sf_dir, (1, 2))
    return scd2_changes(old, new, CUSTOMERS.keys, REF_FILE, CUSTOMERS.tracked)


def customer_changes_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version changes when drop 1 arrives after drops 2 and 3: starts move."""
    old = customer_history(spark, sf_dir, (2, 3))
    new = customer_history(spark, sf_dir, (1, 2, 3))
    return scd2_changes(old, new, CUSTOMERS.keys, REF_FILE, CUSTOMERS.tracked)


def customer_merge_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trusted-zone audit row of the type-2 merge of drop 3 (M4, M6)."""
    metrics = scd2_metrics(customer_history(spark, sf_dir, (1, 2)), customer_history(spark, sf_dir),
                           CUSTOMERS.keys, REF_FILE, CUSTOMERS.tracked)
    return control_trusted(metrics, "trusted_customers", "raw", "trusted", "ecommerce/olist_customers_dataset",
                           "ecommerce/olist_customers_dataset", PROC_STAMP)


def events_at_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's user state an hour later, by the as-of plan; every 50th fact has no key."""
    e = feeds.event_observations(spark, sf_dir)
    facts = e.select(F.col("event_id").alias("fact_id"),
                     F.when(F.col("event_id") % 50 != 0, F.col("user_id")).alias("fact_user"),
                     (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(1))).alias("ts_fact"))
    return asof_left_join(facts, event_history(spark, sf_dir), "fact_user", "user_id", "ts_fact",
                          take=["event_type", "event_id"])


def changed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = customer_history(spark, sf_dir, (1,)).where(F.col(ACTIVE))
    incoming = feeds.customer_observations(spark, sf_dir, (2,))
    return changed_rows(incoming, active, CUSTOMERS.keys, CUSTOMERS.tracked, REF_FILE)


def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_build(feeds.event_observations(spark, sf_dir), ["user_id"], ["event_type"], "ts",
                      carry=["event_id"], tie=["event_id"])


def dim_customers(spark: SparkSession, sf_dir: str, history: DataFrame | None = None) -> DataFrame:
    """Customer dimension rebuilt after drop 3, keeping the keys of the build after drop 2."""
    previous = star.dim_customers(customer_history(spark, sf_dir, (1, 2)), BATCH_TS)
    if history is None:
        history = customer_history(spark, sf_dir)
    return star.dim_customers(history, BATCH_TS, previous)


def dim_location_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_location_distinct(customer_history(spark, sf_dir))


def dim_location(spark: SparkSession, sf_dir: str, history: DataFrame | None = None) -> DataFrame:
    return star.dim_location(history if history is not None else customer_history(spark, sf_dir))


def _staged(spark: SparkSession, batch: DataFrame, entity) -> DataFrame:
    """The batch reduced to one row per key and stored: a merge uses it several times."""
    return stored(spark, trusted.snapshot(keyed(batch, entity.keys), entity), f"{entity.name}_batch")


def trusted_orders(spark: SparkSession, sf_dir: str, with_action: bool = False) -> DataFrame:
    """The stored snapshot of the files before the cutoff, upserted with every later
    file plus the stale replays (which must lose)."""
    feed = feeds.order_feed(spark, sf_dir)
    replay = F.col(feeds.ORDER_KIND) == "replay"
    early = feed.where(~replay & (F.col(REF_FILE) < F.lit(CUTOFF_STAMP)))
    target = stored(spark, trusted.snapshot(early, ORDERS), "orders")
    batch = _staged(spark, feed.where(replay | (F.col(REF_FILE) >= F.lit(CUTOFF_STAMP))), ORDERS)
    return trusted.upsert(target, batch, ORDERS, with_action)


def _inserted(spark: SparkSession, obs: DataFrame, entity, cutoff: int, with_action: bool = False) -> DataFrame:
    target = stored(spark, trusted.snapshot(trusted.before(obs, cutoff), entity), entity.name)
    return trusted.insert_only(target, _staged(spark, trusted.from_(obs, cutoff), entity), entity, with_action)


def trusted_items(spark: SparkSession, sf_dir: str, with_action: bool = False) -> DataFrame:
    return _inserted(spark, feeds.item_observations(spark, sf_dir), ORDER_ITEMS, CUTOFF_STAMP, with_action)


def trusted_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inserted(spark, feeds.payment_observations(spark, sf_dir), ORDER_PAYMENTS, CUTOFF_STAMP)


def trusted_products(spark: SparkSession, sf_dir: str, upsert: bool) -> DataFrame:
    """Products follow attribute changes with ``upsert`` (D5: SCD1 needs an upsert upstream)."""
    obs = feeds.product_observations(spark, sf_dir)
    if not upsert:
        return _inserted(spark, obs, PRODUCTS, PRODUCT_CUTOFF_STAMP)
    target = stored(spark, trusted.snapshot(trusted.before(obs, PRODUCT_CUTOFF_STAMP), PRODUCTS), "products")
    return trusted.upsert(target, trusted.from_(obs, PRODUCT_CUTOFF_STAMP), PRODUCTS)


def order_merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_metrics(trusted_orders(spark, sf_dir, with_action=True))


def order_merge_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trusted-zone audit row of the orders merge (M6)."""
    return control_trusted(order_merge_metrics(spark, sf_dir), "trusted_orders", "raw",
                           "trusted", "ecommerce/olist_orders_dataset",
                           "ecommerce/olist_orders_dataset", PROC_STAMP)


def insert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the insert-only items merge (M4)."""
    return merge_metrics(trusted_items(spark, sf_dir, with_action=True), insert_only=True)


def fact_orders(spark: SparkSession, sf_dir: str, history: DataFrame | None = None,
                customers: bool = True) -> DataFrame:
    """Order-item fact over trusted snapshots: each merge runs once.  Items, which the fact reads
    twice, are stored; orders and payments go straight into the stored enriched orders."""
    dim = dim_customers(spark, sf_dir, history) if customers else None
    items = stored(spark, trusted_items(spark, sf_dir), "t_items")
    return star.fact_orders(trusted_orders(spark, sf_dir), dim, items, trusted_payments(spark, sf_dir),
                            customer_versions_bound=CUSTOMER_VERSIONS_BOUND,
                            store=lambda df: stored(spark, df, "enriched_orders"))


def sales_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City mart over the stored fact and customer history."""
    history = stored(spark, customer_history(spark, sf_dir), "customers")
    fact = stored(spark, fact_orders(spark, sf_dir, history), "fact")
    return marts.sales_by_city(dim_location(spark, sf_dir, history), fact)


def sales_by_day_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day mart over a stored fact without the customer dimension, which it does not use."""
    return marts.sales_by_day_payment(stored(spark, fact_orders(spark, sf_dir, customers=False), "fact"))


# ---------------------------------------------------------------- query-shaped outputs
def _money_to_double(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def typed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing strings of the items typed by the entity contract (P3, P4), with rejects."""
    from terrace.functions.casts import typed_projection
    t = typed_projection(feeds.item_landing(spark, sf_dir), ORDER_ITEMS, carry=[REF_FILE],
                         reject_col="nu_rejects")
    return _money_to_double(t, ["nu_price", "nu_freight_value"])


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted.snapshot(feeds.order_observations(spark, sf_dir), ORDERS)


def latest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = trusted.snapshot(feeds.item_observations(spark, sf_dir), ORDER_ITEMS)
    return _money_to_double(snap, ["nu_price", "nu_freight_value"])


def insert_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money_to_double(trusted_items(spark, sf_dir), ["nu_price", "nu_freight_value"])


def insert_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money_to_double(trusted_payments(spark, sf_dir), ["nu_payment_value"])


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_products(trusted_products(spark, sf_dir, upsert=True), BATCH_TS)


def active_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_history(spark, sf_dir).where(F.col(ACTIVE))


def orders_with_customer_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the customer version valid at its purchase time."""
    o = feeds.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").alias("ts_order_purchase"))
    h = customer_history(spark, sf_dir).withColumnRenamed(REF_FILE, "ref_customer_version")
    return temporal_left_join(o, h, "customer_id", "customer_id", "ts_order_purchase",
                              take=["customer_zip_code_prefix", "customer_city", "customer_state",
                                    "ref_customer_version"],
                              versions_bound=CUSTOMER_VERSIONS_BOUND)


def fact_orders_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money_to_double(fact_orders(spark, sf_dir),
                            ["nu_items_price", "nu_freight_value", "nu_payment_value"])


def scalar_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's scalar expressions (X1-X18) over every order."""
    from terrace.sources.landing import file_stamp
    o = feeds.table(spark, sf_dir, "orders")
    fn = F.concat(F.lit("olist_orders_dataset_"), F.date_format("o_orderdate", "yyyyMMddHHmmss"),
                  F.lit(".csv"))
    lo = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit("1996-12-31 00:00:00").cast("timestamp_ntz")
    return o.select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("ref_day"),
        F.replace(F.reverse(F.substring_index(F.reverse(fn), "_", 1)), F.lit(".csv"), F.lit(""))
         .cast("bigint").alias("stamp_reversed"),
        file_stamp(fn).alias("stamp_pattern"),
        F.round(F.col("o_totalprice") / 3, 2).alias("nu_third"),
        F.col("o_orderdate").between(lo, hi).alias("flag_1996"),
        F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "open")
         .otherwise("partial").alias("str_status"),
        F.to_date("o_orderdate").alias("dt_order"))
