"""Order-domain feeds derived from the benchmark tables.

The e-commerce entities are played by the TPC-H-style tables: ``orders``
-> orders and payments, ``lineitem`` -> order items, ``customer`` +
``nation`` + ``region`` -> customers with zip (nation key), city (nation)
and state (region), ``part`` -> products, ``events`` -> a type-2 feed.
Every feed is a Spark derivation of the whole table, so its work grows
with the data.  The scenario constants below decide which rows change and
when; the oracle SQL derives the same rows with the same expressions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.casts import timestamp_to_stamp
from terrace.schema import MONEY, REF_DAY, REF_FILE

# Scenario parameters.
CUSTOMER_DROP_STAMPS = (19950101000000, 19970601000000, 19990601000000)
MOVE_EVERY = 7            # drop 2 moves customers with key % 7 == 0 to the next nation
BACK_EVERY = 14           # drop 3 moves those with key % 14 == 0 back
NATIONS = 25              # the nation table's fixed size
REF_DAY_1 = 20240111      # batch day of drops 1 and 2
REF_DAY_2 = 20240112      # batch day of drop 3
PROC_STAMP = 20240111000000
BATCH_TS = dt.datetime(2024, 1, 11, 0, 0, 0)
CUTOFF_STAMP = 19990101000000   # trusted snapshot holds files before it; later files are the batch
CLOSE_AFTER_DAYS = 45
SECOND_PAYMENT_EVERY = 3
SECOND_PAYMENT_AFTER_DAYS = 30
# Stamps of landed order drops: placed and closed orders, and stale re-sends stamped before both.
PLACED_DROP = 20240110000000
CLOSED_DROP = 20240111000000
STALE_DROP = 20240109000000
# Stamps of landed payment drops: first payments, all payments again, the rest.
PAYMENT_DROPS = (20240110000000, 20240111000000)
PRODUCT_LAUNCH_STAMP = 20180101000000
PRODUCT_RECATEGORISED_STAMP = 20190101000000
PRODUCT_CUTOFF_STAMP = 20180126000000
DELIVERED = "F"           # order status playing "delivered"
REPLAYED_PRIORITY = "1-URGENT"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given (read-only) input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days(ts: Column, n: int) -> Column:
    return ts + F.make_dt_interval(F.lit(n))


# ---------------------------------------------------------------- customers
def customer_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three full customer drops (all-string landing columns + ``ref_file_extraction``).

    Drop 2 moves every 7th customer to the next nation, drop 3 moves every
    14th back; each row also carries ``drop_no`` (1..3).
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    drops = F.array(*[F.struct(F.lit(i + 1).alias("drop_no"), F.lit(s).cast("bigint").alias("stamp"))
                      for i, s in enumerate(CUSTOMER_DROP_STAMPS)])
    moved = F.pmod(F.col("c_nationkey") + 1, F.lit(NATIONS))
    k = F.col("c_custkey")
    nk = (F.when((F.col("d.drop_no") == 2) & (k % MOVE_EVERY == 0), moved)
           .when((F.col("d.drop_no") == 3) & (k % MOVE_EVERY == 0) & (k % BACK_EVERY != 0), moved)
           .otherwise(F.col("c_nationkey")))
    rows = c.select("c_custkey", "c_name", "c_nationkey", F.explode(drops).alias("d")) \
            .select("c_custkey", "c_name", nk.cast("int").alias("_nk"),
                    F.col("d.drop_no").alias("drop_no"), F.col("d.stamp").alias(REF_FILE))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "inner")
    # by its estimate (a product of two file sizes) Catalyst would broadcast the customers instead
    j = rows.join(F.broadcast(geo), rows._nk == geo.n_nationkey, "inner")
    return j.select(F.col("c_custkey").cast("string").alias("customer_id"),
                    F.col("c_name").alias("customer_unique_id"),
                    F.col("_nk").cast("string").alias("customer_zip_code_prefix"),
                    F.col("n_name").alias("customer_city"),
                    F.col("r_name").alias("customer_state"),
                    F.col(REF_FILE), F.col("drop_no"))


def customer_observations(spark: SparkSession, sf_dir: str, drops=(1, 2, 3),
                          delta_drop: int | None = None) -> DataFrame:
    """Customer drops as raw-zone observations, with the drop's effective time.

    ``delta_drop``: this drop holds only the customers that may move.
    """
    d = customer_drops(spark, sf_dir).where(F.col("drop_no").isin(list(drops)))
    if delta_drop is not None:
        d = d.where((F.col("drop_no") != delta_drop) | (F.col("customer_id").cast("bigint") % MOVE_EVERY == 0))
    ref_day = F.when(F.col("drop_no") < 3, F.lit(REF_DAY_1)).otherwise(F.lit(REF_DAY_2))
    return d.select(ref_day.alias(REF_DAY), F.col(REF_FILE),
                    F.to_timestamp_ntz(F.col(REF_FILE).cast("string"), F.lit("yyyyMMddHHmmss"))
                    .alias("ts_effective"),
                    "customer_id", "customer_unique_id", "customer_zip_code_prefix",
                    "customer_city", "customer_state")


# ---------------------------------------------------------------- orders
ORDER_KIND = "_kind"


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order observation from one scan, tagged ``_kind``:

    ``placed`` (status O) for every order; ``closed`` for F/P orders, 45 days
    later; ``replay`` - stale re-sends of urgent orders placed before the
    cutoff, with their original stamp and status S, which must never
    overwrite (D10).
    """
    o = table(spark, sf_dir, "orders")
    ts = F.col("o_orderdate")
    closes = F.col("o_orderstatus") != "O"
    replays = ((F.col("o_orderpriority") == REPLAYED_PRIORITY)
               & (timestamp_to_stamp(ts) < F.lit(CUTOFF_STAMP)))
    kinds = F.array(F.lit("placed"), F.when(closes, F.lit("closed")), F.when(replays, F.lit("replay")))
    rows = o.select("*", F.explode(kinds).alias(ORDER_KIND)).where(F.col(ORDER_KIND).isNotNull())
    closed = F.col(ORDER_KIND) == "closed"
    no_ts = F.lit(None).cast("timestamp_ntz")
    return rows.select(
        F.lit(REF_DAY_1).alias(REF_DAY),
        timestamp_to_stamp(F.when(closed, _days(ts, CLOSE_AFTER_DAYS)).otherwise(ts)).alias(REF_FILE),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(closed, F.col("o_orderstatus"))
         .when(F.col(ORDER_KIND) == "replay", F.lit("S")).otherwise(F.lit("O")).alias("order_status"),
        ts.alias("ts_order_purchase"),
        _days(ts, 1).alias("ts_order_approved_at"),
        F.when(closed, _days(ts, 3)).otherwise(no_ts).alias("ts_order_delivered_carrier"),
        F.when(closed & (F.col("o_orderstatus") == DELIVERED), _days(ts, 10)).otherwise(no_ts)
         .alias("ts_order_delivered_customer"),
        F.to_date(_days(ts, 20)).alias("dt_order_estimated_delivery"),
        F.col(ORDER_KIND))


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placed and closed order observations."""
    f = order_feed(spark, sf_dir)
    return f.where(F.col(ORDER_KIND) != "replay").drop(ORDER_KIND)


def order_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_feed(spark, sf_dir).drop(ORDER_KIND)


# ---------------------------------------------------------------- items
def item_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row is one observation of item (order, line), stamped by ship date.

    (order, line) repeats with different or equal stamps, so latest-per-key
    needs a total order to be deterministic (D4).
    """
    li = table(spark, sf_dir, "lineitem")
    # narrow operands keep the exact product in a long (decimal(14,4))
    freight = (F.col("l_tax").cast("decimal(4,2)") * F.col("l_quantity").cast("decimal(9,2)")).cast(MONEY)
    return li.select(
        F.lit(REF_DAY_1).alias(REF_DAY),
        timestamp_to_stamp(F.col("l_shipdate")).alias(REF_FILE),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("int").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("ts_shipping_limit"),
        F.col("l_extendedprice").cast(MONEY).alias("nu_price"),
        freight.alias("nu_freight_value"))


def item_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item observations rendered as the all-string landing contract."""
    i = item_observations(spark, sf_dir)
    return i.select(F.col(REF_FILE), "order_id",
                    F.col("order_item_id").cast("string").alias("order_item_id"),
                    "product_id", "seller_id",
                    F.date_format("ts_shipping_limit", "yyyy-MM-dd HH:mm:ss").alias("shipping_limit_date"),
                    F.col("nu_price").cast("string").alias("price"),
                    F.col("nu_freight_value").cast("string").alias("freight_value"))


# ---------------------------------------------------------------- payments
def payment_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order; every 3rd order pays 60 % first and the rest 30 days
    later (both rows from one scan)."""
    o = table(spark, sf_dir, "orders")
    total = F.col("o_totalprice").cast(MONEY)
    split = F.col("o_orderkey") % SECOND_PAYMENT_EVERY == 0
    first_part = (F.floor(F.col("o_totalprice") * 60) / 100).cast(MONEY)
    rows = o.select("*", F.explode(F.array(F.lit(1), F.when(split, F.lit(2)))).alias("_seq")) \
            .where(F.col("_seq").isNotNull())
    second = F.col("_seq") == 2
    ts = F.col("o_orderdate")
    return rows.select(
        F.lit(REF_DAY_1).alias(REF_DAY),
        timestamp_to_stamp(F.when(second, _days(ts, SECOND_PAYMENT_AFTER_DAYS)).otherwise(ts)).alias(REF_FILE),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("_seq").cast("int").alias("nu_payment_sequential"),
        F.when(second, F.lit("voucher")).otherwise(F.col("o_orderpriority")).alias("payment_type"),
        F.when(second, F.lit(1)).otherwise(F.col("o_orderkey") % 10 + 1).cast("int")
         .alias("nu_payment_installments"),
        F.when(second, total - first_part).when(split, first_part).otherwise(total).cast(MONEY)
         .alias("nu_payment_value"))


# ---------------------------------------------------------------- products
def product_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part launches on day ``p_size`` of 2018 and is re-categorised in 2019."""
    p = table(spark, sf_dir, "part")
    launch = _days(F.to_timestamp_ntz(F.lit(str(PRODUCT_LAUNCH_STAMP)), F.lit("yyyyMMddHHmmss")),
                   0)

    def row(stamp: Column, category: Column) -> DataFrame:
        return p.select(
            F.lit(REF_DAY_1).alias(REF_DAY), stamp.alias(REF_FILE),
            F.col("p_partkey").cast("string").alias("product_id"),
            category.alias("product_category_name"),
            F.length("p_name").cast("int").alias("nu_product_name_lenght"),
            F.length("p_brand").cast("int").alias("nu_product_description_lenght"),
            F.floor(F.col("p_size") / 10).cast("int").alias("nu_product_photos_qty"),
            F.col("p_retailprice").cast("double").alias("nu_product_weight_g"),
            F.col("p_size").cast("double").alias("nu_product_length_cm"),
            (F.col("p_size") / 2.0).cast("double").alias("nu_product_height_cm"),
            (F.col("p_size") / 4.0).cast("double").alias("nu_product_width_cm"))

    launched = row(timestamp_to_stamp(launch + F.make_dt_interval(F.col("p_size"))), F.col("p_type"))
    recat = row(F.lit(PRODUCT_RECATEGORISED_STAMP).cast("bigint"), F.lower(F.col("p_type")))
    return launched.unionByName(recat)


# ---------------------------------------------------------------- landing drops
def as_landing(df: DataFrame, entity) -> DataFrame:
    """Typed rows of ``entity`` rendered as its all-string landing contract."""
    out = []
    for src, dst, t in entity.typed:
        c = F.date_format(F.col(dst), "yyyy-MM-dd HH:mm:ss") if t == "timestamp" else F.col(dst)
        out.append(c.cast("string").alias(src))
    typed = {src for src, _, _ in entity.typed}
    out += [F.lit("s1").alias(c) for c in entity.landing if c not in typed]    # landed, dropped in trusted
    return df.select(*out)


# ---------------------------------------------------------------- events
def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
