"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly from the semantics in the operator docstrings, over the
same benchmark tables; it shares no code with the Spark side except the
scenario constants.  Money stays DECIMAL(18,2) until the final cast to
DOUBLE; every window has a total order; ASC orderings say NULLS FIRST to
match Spark's default.
"""

from __future__ import annotations

from terrace.sources import feeds as S

TS = "'%Y%m%d%H%M%S'"


def _stamp(ts: str) -> str:
    return f"CAST(strftime({ts}, {TS}) AS BIGINT)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------------ customers
CUST_DROPS = f"""
cust_drops AS (
  SELECT c.c_custkey, c.c_name, d.drop_no, d.stamp,
         CASE WHEN d.drop_no = 2 AND c.c_custkey % {S.MOVE_EVERY} = 0
                THEN (c.c_nationkey + 1) % {S.NATIONS}
              WHEN d.drop_no = 3 AND c.c_custkey % {S.MOVE_EVERY} = 0
                   AND c.c_custkey % {S.BACK_EVERY} <> 0
                THEN (c.c_nationkey + 1) % {S.NATIONS}
              ELSE c.c_nationkey END AS nk
  FROM customer c,
       (VALUES (1, CAST({S.CUSTOMER_DROP_STAMPS[0]} AS BIGINT)),
               (2, CAST({S.CUSTOMER_DROP_STAMPS[1]} AS BIGINT)),
               (3, CAST({S.CUSTOMER_DROP_STAMPS[2]} AS BIGINT))) AS d(drop_no, stamp)
),
cust_land AS (
  SELECT CAST(cd.c_custkey AS VARCHAR) AS customer_id, cd.c_name AS customer_unique_id,
         CAST(cd.nk AS VARCHAR) AS customer_zip_code_prefix, n.n_name AS customer_city,
         r.r_name AS customer_state, cd.stamp AS ref_file_extraction, cd.drop_no
  FROM cust_drops cd JOIN nation n ON cd.nk = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
cust_obs AS (
  SELECT CASE WHEN drop_no < 3 THEN {S.REF_DAY_1} ELSE {S.REF_DAY_2} END AS ref_day,
         ref_file_extraction,
         strptime(CAST(ref_file_extraction AS VARCHAR), {TS}) AS ts_effective,
         customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
         customer_state, drop_no
  FROM cust_land
)"""

CUST_ORDER = ("ts_effective ASC NULLS FIRST, customer_zip_code_prefix ASC NULLS FIRST, "
              "customer_city ASC NULLS FIRST, customer_state ASC NULLS FIRST, "
              "ref_day ASC NULLS FIRST, ref_file_extraction ASC NULLS FIRST, "
              "customer_unique_id ASC NULLS FIRST")


def cust_history(name: str, drops: tuple[int, ...], where: str = "") -> str:
    """Type-2 history CTE ``name`` over the given drops."""
    ds = ", ".join(str(d) for d in drops)
    return f"""
{name}_lag AS (
  SELECT *,
         LAG(customer_zip_code_prefix) OVER w AS p_zip, LAG(customer_city) OVER w AS p_city,
         LAG(customer_state) OVER w AS p_state, ROW_NUMBER() OVER w AS rn
  FROM cust_obs WHERE drop_no IN ({ds}) {where}
  WINDOW w AS (PARTITION BY customer_id ORDER BY {CUST_ORDER})
),
{name}_starts AS (
  SELECT * FROM {name}_lag
  WHERE rn = 1 OR customer_zip_code_prefix IS DISTINCT FROM p_zip
        OR customer_city IS DISTINCT FROM p_city OR customer_state IS DISTINCT FROM p_state
),
{name} AS (
  SELECT customer_id, customer_zip_code_prefix, customer_city, customer_state,
         ref_day, ref_file_extraction, customer_unique_id,
         CASE WHEN rn = 1 THEN NULL ELSE ts_effective END AS ts_start_date,
         LEAD(ts_effective) OVER (PARTITION BY customer_id ORDER BY {CUST_ORDER}) AS ts_end_date,
         LEAD(ts_effective) OVER (PARTITION BY customer_id ORDER BY {CUST_ORDER}) IS NULL
           AS flag_scd_active
  FROM {name}_starts
)"""


HIST_COLS = ("customer_id, customer_zip_code_prefix, customer_city, customer_state, ref_day, "
             "ref_file_extraction, customer_unique_id, ts_start_date, ts_end_date, flag_scd_active")


def _bucket(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return (f"substr(md5(concat_ws('|', COALESCE({a}customer_id, ''), "
            f"COALESCE(CAST({a}ref_file_extraction AS VARCHAR), ''))), 1, 3)")


DIM_CUSTOMERS = f"""
dimc_prev AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY {_bucket()}, customer_id ASC NULLS FIRST,
                                        ref_file_extraction ASC NULLS FIRST) AS sk
  FROM hist12
),
dimc_join AS (
  SELECT h.*, p.sk AS prev_sk
  FROM hist123 h LEFT JOIN dimc_prev p
    ON h.customer_id IS NOT DISTINCT FROM p.customer_id
   AND h.ref_file_extraction IS NOT DISTINCT FROM p.ref_file_extraction
),
dimc AS (
  SELECT CAST(prev_sk AS BIGINT) AS sk_customers, {HIST_COLS} FROM dimc_join WHERE prev_sk IS NOT NULL
  UNION ALL
  SELECT CAST((SELECT MAX(sk) FROM dimc_prev)
              + ROW_NUMBER() OVER (ORDER BY {_bucket()}, customer_id ASC NULLS FIRST,
                                            ref_file_extraction ASC NULLS FIRST) AS BIGINT),
         {HIST_COLS}
  FROM dimc_join WHERE prev_sk IS NULL
)"""

DIM_LOCATION = """
loc_cnt AS (
  SELECT customer_zip_code_prefix, customer_city, customer_state, COUNT(*) AS n
  FROM hist123 WHERE customer_zip_code_prefix IS NOT NULL
  GROUP BY customer_zip_code_prefix, customer_city, customer_state
),
dim_location AS (
  SELECT customer_zip_code_prefix, customer_city, customer_state FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_zip_code_prefix
                                 ORDER BY n DESC, customer_city ASC NULLS FIRST,
                                          customer_state ASC NULLS FIRST) AS rn
    FROM loc_cnt) WHERE rn = 1
)"""

# ------------------------------------------------------------------ orders
ORDER_COLS = ("ref_day, ref_file_extraction, order_id, customer_id, order_status, ts_order_purchase, "
              "ts_order_approved_at, ts_order_delivered_carrier, ts_order_delivered_customer, "
              "dt_order_estimated_delivery")
ORDER_TIE = ("ref_day ASC NULLS FIRST, customer_id ASC NULLS FIRST, order_status ASC NULLS FIRST, "
             "ts_order_purchase ASC NULLS FIRST, ts_order_approved_at ASC NULLS FIRST, "
             "ts_order_delivered_carrier ASC NULLS FIRST, ts_order_delivered_customer ASC NULLS FIRST, "
             "dt_order_estimated_delivery ASC NULLS FIRST")


def _order_row(status: str, stamp_ts: str, closed: bool, where: str) -> str:
    carrier = "o_orderdate + INTERVAL 3 DAY" if closed else "CAST(NULL AS TIMESTAMP)"
    cust = (f"CASE WHEN o_orderstatus = '{S.DELIVERED}' THEN o_orderdate + INTERVAL 10 DAY END"
            if closed else "CAST(NULL AS TIMESTAMP)")
    return f"""SELECT {S.REF_DAY_1} AS ref_day, {_stamp(stamp_ts)} AS ref_file_extraction,
         CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         {status} AS order_status, o_orderdate AS ts_order_purchase,
         o_orderdate + INTERVAL 1 DAY AS ts_order_approved_at,
         {carrier} AS ts_order_delivered_carrier, {cust} AS ts_order_delivered_customer,
         CAST(o_orderdate + INTERVAL 20 DAY AS DATE) AS dt_order_estimated_delivery
  FROM orders {where}"""


ORDER_FEEDS = f"""
ord_hist AS (
  {_order_row("'O'", "o_orderdate", False, "")}
  UNION ALL
  {_order_row("o_orderstatus", f"o_orderdate + INTERVAL {S.CLOSE_AFTER_DAYS} DAY", True,
              "WHERE o_orderstatus <> 'O'")}
),
ord_replay AS (
  {_order_row("'S'", "o_orderdate", False,
              f"WHERE o_orderpriority = '{S.REPLAYED_PRIORITY}' AND {_stamp('o_orderdate')} < {S.CUTOFF_STAMP}")}
)"""


def _latest(src: str, keys: str, tie: str, cols: str) -> str:
    return f"""SELECT {cols} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys}
                                 ORDER BY ref_file_extraction DESC NULLS LAST, {tie}) AS rn
    FROM {src}) WHERE rn = 1"""


def _upsert(name: str, target: str, batch: str, keys: str, tie: str, cols: str) -> str:
    return f"""
{name}_t AS ({_latest(target, keys, tie, cols)}),
{name}_b AS ({_latest(batch, keys, tie, cols)}),
{name}_both AS (SELECT {cols}, 0 AS side FROM {name}_t UNION ALL SELECT {cols}, 1 AS side FROM {name}_b),
{name}_ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys}
                               ORDER BY ref_file_extraction DESC NULLS LAST, side ASC, {tie}) AS rn,
         MIN(side) OVER (PARTITION BY {keys}) = 0 AS in_target
  FROM {name}_both
),
{name} AS (
  SELECT {cols},
         CASE WHEN side = 0 THEN 'noop' WHEN in_target THEN 'update' ELSE 'insert' END AS merge_action
  FROM {name}_ranked WHERE rn = 1
)"""


def _insert_only(name: str, target: str, batch: str, keys: list[str], tie: str, cols: str) -> str:
    k = ", ".join(keys)
    on = " AND ".join(f"b.{c} = t.{c}" for c in keys)
    return f"""
{name}_t AS ({_latest(target, k, tie, cols)}),
{name}_b AS ({_latest(batch, k, tie, cols)}),
{name} AS (
  SELECT {cols}, 'noop' AS merge_action FROM {name}_t
  UNION ALL
  SELECT {cols}, 'insert' AS merge_action FROM {name}_b b
  WHERE NOT EXISTS (SELECT 1 FROM {name}_t t WHERE {on})
)"""


TRUSTED_ORDERS = ORDER_FEEDS + "," + f"""
ord_target_src AS (SELECT * FROM ord_hist WHERE ref_file_extraction < {S.CUTOFF_STAMP}),
ord_batch_src AS (
  SELECT * FROM ord_hist WHERE ref_file_extraction >= {S.CUTOFF_STAMP}
  UNION ALL SELECT * FROM ord_replay
),""" + _upsert("t_orders", "ord_target_src", "ord_batch_src", "order_id", ORDER_TIE, ORDER_COLS)

# ------------------------------------------------------------------ items
ITEM_COLS = ("ref_day, ref_file_extraction, order_id, order_item_id, product_id, ts_shipping_limit, "
             "nu_price, nu_freight_value")
ITEM_TIE = ("ref_day ASC NULLS FIRST, product_id ASC NULLS FIRST, ts_shipping_limit ASC NULLS FIRST, "
            "nu_price ASC NULLS FIRST, nu_freight_value ASC NULLS FIRST")
ITEM_FEED = f"""
item_obs AS (
  SELECT {S.REF_DAY_1} AS ref_day, {_stamp('l_shipdate')} AS ref_file_extraction,
         CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
         l_shipdate AS ts_shipping_limit, CAST(l_extendedprice AS DECIMAL(18,2)) AS nu_price,
         CAST(CAST(l_tax AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(18,2))
           AS nu_freight_value
  FROM lineitem
)"""
TRUSTED_ITEMS = ITEM_FEED + "," + f"""
item_t_src AS (SELECT * FROM item_obs WHERE ref_file_extraction < {S.CUTOFF_STAMP}),
item_b_src AS (SELECT * FROM item_obs WHERE ref_file_extraction >= {S.CUTOFF_STAMP}),""" + \
    _insert_only("t_items", "item_t_src", "item_b_src", ["order_id", "order_item_id"], ITEM_TIE, ITEM_COLS)

# ------------------------------------------------------------------ payments
PAY_COLS = ("ref_day, ref_file_extraction, order_id, nu_payment_sequential, payment_type, "
            "nu_payment_installments, nu_payment_value")
PAY_TIE = ("ref_day ASC NULLS FIRST, payment_type ASC NULLS FIRST, "
           "nu_payment_installments ASC NULLS FIRST, nu_payment_value ASC NULLS FIRST")
_FIRST_PART = "CAST(FLOOR(o_totalprice * 60) / 100 AS DECIMAL(18,2))"
PAY_FEED = f"""
pay_obs AS (
  SELECT {S.REF_DAY_1} AS ref_day, {_stamp('o_orderdate')} AS ref_file_extraction,
         CAST(o_orderkey AS VARCHAR) AS order_id, 1 AS nu_payment_sequential,
         o_orderpriority AS payment_type, CAST(o_orderkey % 10 + 1 AS INTEGER) AS nu_payment_installments,
         CASE WHEN o_orderkey % {S.SECOND_PAYMENT_EVERY} = 0 THEN {_FIRST_PART}
              ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS nu_payment_value
  FROM orders
  UNION ALL
  SELECT {S.REF_DAY_1}, {_stamp(f"o_orderdate + INTERVAL {S.SECOND_PAYMENT_AFTER_DAYS} DAY")},
         CAST(o_orderkey AS VARCHAR), 2, 'voucher', 1,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) - {_FIRST_PART} AS DECIMAL(18,2))
  FROM orders WHERE o_orderkey % {S.SECOND_PAYMENT_EVERY} = 0
)"""
TRUSTED_PAYMENTS = PAY_FEED + "," + f"""
pay_t_src AS (SELECT * FROM pay_obs WHERE ref_file_extraction < {S.CUTOFF_STAMP}),
pay_b_src AS (SELECT * FROM pay_obs WHERE ref_file_extraction >= {S.CUTOFF_STAMP}),""" + \
    _insert_only("t_pay", "pay_t_src", "pay_b_src", ["order_id", "nu_payment_sequential"],
                 PAY_TIE, PAY_COLS)

# ------------------------------------------------------------------ products
PROD_COLS = ("ref_day, ref_file_extraction, product_id, product_category_name, nu_product_name_lenght, "
             "nu_product_description_lenght, nu_product_photos_qty, nu_product_weight_g, "
             "nu_product_length_cm, nu_product_height_cm, nu_product_width_cm")
PROD_TIE = ("ref_day ASC NULLS FIRST, product_category_name ASC NULLS FIRST, "
            "nu_product_name_lenght ASC NULLS FIRST, nu_product_description_lenght ASC NULLS FIRST, "
            "nu_product_photos_qty ASC NULLS FIRST, nu_product_weight_g ASC NULLS FIRST, "
            "nu_product_length_cm ASC NULLS FIRST, nu_product_height_cm ASC NULLS FIRST, "
            "nu_product_width_cm ASC NULLS FIRST")


def _prod_row(stamp: str, category: str) -> str:
    return f"""SELECT {S.REF_DAY_1} AS ref_day, {stamp} AS ref_file_extraction,
         CAST(p_partkey AS VARCHAR) AS product_id, {category} AS product_category_name,
         CAST(length(p_name) AS INTEGER) AS nu_product_name_lenght,
         CAST(length(p_brand) AS INTEGER) AS nu_product_description_lenght,
         CAST(FLOOR(p_size / 10) AS INTEGER) AS nu_product_photos_qty,
         CAST(p_retailprice AS DOUBLE) AS nu_product_weight_g,
         CAST(p_size AS DOUBLE) AS nu_product_length_cm,
         CAST(p_size AS DOUBLE) / 2.0 AS nu_product_height_cm,
         CAST(p_size AS DOUBLE) / 4.0 AS nu_product_width_cm
  FROM part"""


PROD_FEED = f"""
prod_obs AS (
  {_prod_row(_stamp(f"strptime('{S.PRODUCT_LAUNCH_STAMP}', {TS}) + p_size * INTERVAL 1 DAY"), "p_type")}
  UNION ALL
  {_prod_row(f"CAST({S.PRODUCT_RECATEGORISED_STAMP} AS BIGINT)", "lower(p_type)")}
),
prod_t_src AS (SELECT * FROM prod_obs WHERE ref_file_extraction < {S.PRODUCT_CUTOFF_STAMP}),
prod_b_src AS (SELECT * FROM prod_obs WHERE ref_file_extraction >= {S.PRODUCT_CUTOFF_STAMP})"""

# ------------------------------------------------------------------ fact & marts
FACT = f"""
pay_order AS (
  SELECT order_id, MAX(CASE WHEN rk = 1 THEN payment_type END) AS payment_type,
         MAX(nu_payment_installments) AS nu_payment_installments,
         CAST(SUM(nu_payment_value) AS DECIMAL(18,2)) AS nu_payment_value
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
                                     ORDER BY nu_payment_value DESC, nu_payment_sequential ASC) AS rk
        FROM t_pay) GROUP BY order_id
),
fact AS (
  SELECT o.order_id, i.order_item_id, o.customer_id, c.sk_customers, c.customer_zip_code_prefix,
         o.order_status, o.ts_order_purchase, o.ts_order_approved_at, o.ts_order_delivered_carrier,
         o.ts_order_delivered_customer, o.dt_order_estimated_delivery, i.product_id,
         i.nu_price AS nu_items_price, i.nu_freight_value, p.payment_type,
         p.nu_payment_installments, p.nu_payment_value
  FROM t_orders o
  LEFT JOIN dimc c ON o.customer_id = c.customer_id
       AND (c.ts_start_date IS NULL OR o.ts_order_purchase >= c.ts_start_date)
       AND (c.ts_end_date IS NULL OR o.ts_order_purchase < c.ts_end_date)
  LEFT JOIN pay_order p ON o.order_id = p.order_id
  LEFT JOIN t_items i ON o.order_id = i.order_id
  WHERE o.order_id IS NOT NULL
)"""

FACT_CTES = ",".join([CUST_DROPS, cust_history("hist12", (1, 2)), cust_history("hist123", (1, 2, 3)),
                      DIM_CUSTOMERS, TRUSTED_ORDERS, TRUSTED_ITEMS, TRUSTED_PAYMENTS, FACT])

FACT_SELECT = """SELECT order_id, order_item_id, customer_id, sk_customers, customer_zip_code_prefix,
       order_status, ts_order_purchase, ts_order_approved_at, ts_order_delivered_carrier,
       ts_order_delivered_customer, dt_order_estimated_delivery, product_id,
       CAST(nu_items_price AS DOUBLE) AS nu_items_price,
       CAST(nu_freight_value AS DOUBLE) AS nu_freight_value, payment_type,
       nu_payment_installments, CAST(nu_payment_value AS DOUBLE) AS nu_payment_value
FROM fact"""

AGG_CITY = f"""SELECT l.customer_state, l.customer_city,
       COUNT(DISTINCT f.order_id) AS nu_qty_sales,
       ROUND(CAST(SUM(f.nu_items_price) AS DOUBLE) / CAST(COUNT(DISTINCT f.order_id) AS DOUBLE), 2)
         AS nu_avg_ticket,
       CAST(ROUND(SUM(f.nu_items_price), 2) AS DOUBLE) AS nu_sum_items_price,
       COUNT(DISTINCT f.customer_id) AS nu_qty_unique_customers,
       ROUND(CAST(SUM(f.nu_freight_value) AS DOUBLE) / CAST(COUNT(f.nu_freight_value) AS DOUBLE), 2)
         AS nu_avg_freight_value,
       MAX(f.ts_order_purchase) AS ts_last_order_purchase
FROM fact f JOIN dim_location l ON f.customer_zip_code_prefix = l.customer_zip_code_prefix
WHERE f.order_status = '{S.DELIVERED}'
GROUP BY l.customer_state, l.customer_city
ORDER BY nu_sum_items_price DESC"""

AGG_DAY = f"""SELECT CAST(ts_order_purchase AS DATE) AS dt_order_purchase, payment_type,
       CAST(ROUND(SUM(nu_items_price), 2) AS DOUBLE) AS nu_sum_items_value,
       COUNT(DISTINCT order_id) AS nu_qty_orders
FROM fact WHERE order_status = '{S.DELIVERED}'
GROUP BY CAST(ts_order_purchase AS DATE), payment_type
ORDER BY dt_order_purchase, payment_type"""

# ------------------------------------------------------------------ landing / raw
LAND_COLS = ("customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, "
             "customer_state")
RAW_DAY = f"CASE WHEN drop_no < 3 THEN {S.REF_DAY_1} ELSE {S.REF_DAY_2} END"


def _raw(day: str, where: str = "") -> str:
    return (f"SELECT {day} AS ref_day, {day} AS ref_day_partition, ref_file_extraction, "
            f"ref_file_extraction AS ref_file_extraction_partition, {LAND_COLS} FROM cust_land {where}")


EVENTS = """
ev_lag AS (
  SELECT *, LAG(event_type) OVER w AS p_type, ROW_NUMBER() OVER w AS rn
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST)
),
ev_starts AS (SELECT * FROM ev_lag WHERE rn = 1 OR event_type IS DISTINCT FROM p_type)"""

EV_SELECT = """SELECT user_id, event_type, event_id, ts AS ts_start_date,
       LEAD(ts) OVER w AS ts_end_date, LEAD(ts) OVER w IS NULL AS flag_scd_active
FROM ev_starts WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST)"""


def _scd2_changes(old: tuple[int, ...], new: tuple[int, ...]) -> str:
    """Rows that a type-2 merge applies to go from the history of ``old`` drops to that of ``new``."""
    tracked = ("n.ts_start_date IS DISTINCT FROM o.ts_start_date"
               " OR n.customer_zip_code_prefix IS DISTINCT FROM o.customer_zip_code_prefix"
               " OR n.customer_city IS DISTINCT FROM o.customer_city"
               " OR n.customer_state IS DISTINCT FROM o.customer_state")
    return _with(CUST_DROPS, cust_history("ho", old), cust_history("hn", new)) + f"""SELECT
       COALESCE(n.customer_id, o.customer_id) AS customer_id,
       n.customer_zip_code_prefix, n.customer_city, n.customer_state, n.ref_day,
       COALESCE(n.ref_file_extraction, o.ref_file_extraction) AS ref_file_extraction,
       n.customer_unique_id, n.ts_start_date, n.ts_end_date, n.flag_scd_active,
       CASE WHEN o.customer_id IS NULL THEN 'insert' WHEN n.customer_id IS NULL THEN 'delete'
            WHEN {tracked} THEN 'update' ELSE 'close' END AS change_kind
FROM hn n FULL OUTER JOIN ho o
  ON n.customer_id = o.customer_id AND n.ref_file_extraction = o.ref_file_extraction
WHERE o.customer_id IS NULL OR n.customer_id IS NULL OR {tracked}
   OR n.ts_end_date IS DISTINCT FROM o.ts_end_date OR n.flag_scd_active <> o.flag_scd_active"""


# the trusted tables after three landed batches: an item line's rows all come in one drop
LANDED_CTES = ",".join([CUST_DROPS, cust_history("hist123", (1, 2, 3)), ORDER_FEEDS, ITEM_FEED, PAY_FEED, f"""
dimc AS (SELECT 0 AS sk_customers, * FROM hist123),
t_orders AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_status = 'O') AS rn FROM ord_hist) WHERE rn = 1),
t_items AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY {ITEM_TIE}) AS rn FROM item_obs) WHERE rn = 1),
t_pay AS (SELECT * FROM pay_obs)""", FACT])


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["q_land_scan"] = _with(CUST_DROPS) + f"SELECT {LAND_COLS}, ref_file_extraction FROM cust_land"
    q["q_raw_stamp"] = _with(CUST_DROPS) + _raw(str(S.REF_DAY_1))
    q["q_raw_append"] = _with(CUST_DROPS) + _raw(RAW_DAY)
    q["q_batch_read"] = _with(CUST_DROPS) + _raw(RAW_DAY, "WHERE drop_no = 3")
    # the second half of drop 2 arrives on the second day
    q["q_stream_ingest"] = _with(CUST_DROPS) + _raw(
        f"CASE WHEN drop_no = 1 OR (drop_no = 2 AND CAST(customer_id AS BIGINT) % 2 = 0) "
        f"THEN {S.REF_DAY_1} ELSE {S.REF_DAY_2} END")
    q["q_control_raw"] = _with(CUST_DROPS) + f"""SELECT 'landzone' AS str_origin_zone, 'raw' AS str_target_zone,
       'raw_customers' AS str_process, 'ecommerce/olist_customers_dataset/' AS str_origin_file_path,
       'ecommerce/olist_customers_dataset' AS str_target_file_path,
       {RAW_DAY} AS ref, {RAW_DAY} AS ref_partition, ref_file_extraction,
       ref_file_extraction AS ref_file_extraction_partition,
       CAST(20240111000000 AS BIGINT) AS dt_proc, COUNT(*) AS nu_qtd_rows
FROM cust_land GROUP BY ALL"""
    q["q_audit_replay"] = q["q_control_raw"]
    q["q_run_batch_raw"] = q["q_raw_append"]
    q["q_reconcile"] = _with(CUST_DROPS) + f"""SELECT ref_file_extraction, nu_landing_rows, nu_raw_rows,
       nu_raw_rows AS nu_raw_keys, nu_trusted_keys,
       nu_landing_rows = nu_raw_rows AND nu_raw_rows = nu_trusted_keys AS flag_balanced
FROM (SELECT ref_file_extraction, COUNT(*) AS nu_landing_rows,
             COUNT(*) FILTER (WHERE drop_no < 3 OR CAST(customer_id AS BIGINT) % 2 = 0) AS nu_raw_rows,
             COUNT(*) FILTER (WHERE (drop_no < 3 OR CAST(customer_id AS BIGINT) % 2 = 0)
                              AND CAST(customer_id AS BIGINT) % 10 <> 0) AS nu_trusted_keys
      FROM cust_land GROUP BY ref_file_extraction)"""
    changed, third = S.CUSTOMER_DROP_STAMPS[1], S.CUSTOMER_DROP_STAMPS[2]
    q["q_reconcile_content"] = _with(CUST_DROPS) + f"""SELECT ref_file_extraction, customer_id, CAST(1 AS BIGINT) AS nu_left,
       CAST(CASE WHEN ref_file_extraction = {changed} THEN 1 WHEN k % 103 = 0 THEN 0 ELSE 2 END AS BIGINT) AS nu_right,
       CASE WHEN ref_file_extraction = {changed} THEN 'changed' WHEN k % 103 = 0 THEN 'missing_right'
            ELSE 'repeated' END AS difference,
       CASE WHEN ref_file_extraction = {changed} THEN 'customer_city' ELSE '' END AS columns
FROM (SELECT *, CAST(customer_id AS BIGINT) AS k FROM cust_land)
WHERE (ref_file_extraction = {changed} AND k % 101 = 0) OR (ref_file_extraction = {third} AND k % 103 IN (0, 102))"""
    q["q_rejects"] = """SELECT 'item_without_key' AS reason, COUNT(*) AS nu_rows FROM lineitem WHERE l_orderkey % 97 = 0
UNION ALL
SELECT 'item_values', COUNT(*) FILTER (WHERE l_orderkey % 97 = 0) + COUNT(*) FILTER (WHERE l_orderkey % 89 = 0)
FROM lineitem
UNION ALL SELECT 'file_without_stamp', COUNT(*) FROM customer
UNION ALL SELECT 'header_drift', COUNT(*) FROM customer
UNION ALL SELECT 'malformed_line', COUNT(*) FROM customer
WHERE c_custkey % 97 = 0 OR c_custkey % 89 = 0 OR c_custkey % 83 = 0"""
    line = "concat_ws(',', customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state)"
    q["q_rejected_lines"] = _with(CUST_DROPS) + f"""SELECT 'malformed_line' AS reason,
       CASE WHEN k % 97 = 0 THEN concat_ws(',', customer_id, customer_unique_id)
            WHEN k % 89 = 0 THEN {line} || ',surplus' ELSE '"' || {line} END AS landing_line
FROM (SELECT *, CAST(customer_id AS BIGINT) AS k FROM cust_land WHERE drop_no = 1)
WHERE k % 97 = 0 OR k % 89 = 0 OR k % 83 = 0"""
    q["q_typed_items"] = _with(ITEM_FEED) + """SELECT ref_file_extraction, order_id, order_item_id, product_id,
       ts_shipping_limit, CAST(nu_price AS DOUBLE) AS nu_price,
       CAST(nu_freight_value AS DOUBLE) AS nu_freight_value, 0 AS nu_rejects
FROM item_obs"""
    q["q_scalar_suite"] = r"""WITH f AS (
  SELECT o_orderkey, o_orderdate, o_totalprice, o_orderstatus,
         'olist_orders_dataset_' || strftime(o_orderdate, '%Y%m%d%H%M%S') || '.csv' AS file_name
  FROM orders)
SELECT o_orderkey,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS ref_day,
       CAST(replace(reverse(split_part(reverse(file_name), '_', 1)), '.csv', '') AS BIGINT) AS stamp_reversed,
       TRY_CAST(regexp_extract(file_name, '_([0-9]{14})\.csv(/[^/]*)?$', 1) AS BIGINT) AS stamp_pattern,
       ROUND(o_totalprice / 3, 2) AS nu_third,
       o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 00:00:00' AS flag_1996,
       CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'open'
            ELSE 'partial' END AS str_status,
       CAST(o_orderdate AS DATE) AS dt_order
FROM f"""
    q["q_latest_orders"] = _with(ORDER_FEEDS, "ord_obs AS (SELECT * FROM ord_hist UNION ALL SELECT * FROM ord_replay)") + \
        _latest("ord_obs", "order_id", ORDER_TIE, ORDER_COLS)
    q["q_latest_items"] = _with(ITEM_FEED) + "SELECT ref_day, ref_file_extraction, order_id, order_item_id, " \
        "product_id, ts_shipping_limit, CAST(nu_price AS DOUBLE) AS nu_price, " \
        "CAST(nu_freight_value AS DOUBLE) AS nu_freight_value FROM (" + \
        _latest("item_obs", "order_id, order_item_id", ITEM_TIE, ITEM_COLS) + ")"
    q["q_upsert_orders"] = _with(TRUSTED_ORDERS) + f"SELECT {ORDER_COLS} FROM t_orders"
    q["q_merge_metrics"] = _with(TRUSTED_ORDERS) + """SELECT
       CAST(SUM(CASE WHEN merge_action IN ('insert', 'update') THEN 1 ELSE 0 END) AS BIGINT) AS num_affected_rows,
       CAST(SUM(CASE WHEN merge_action = 'update' THEN 1 ELSE 0 END) AS BIGINT) AS num_updated_rows,
       CAST(0 AS BIGINT) AS num_deleted_rows,
       CAST(SUM(CASE WHEN merge_action = 'insert' THEN 1 ELSE 0 END) AS BIGINT) AS num_inserted_rows
FROM t_orders"""
    money_items = ("ref_day, ref_file_extraction, order_id, order_item_id, product_id, ts_shipping_limit, "
                   "CAST(nu_price AS DOUBLE) AS nu_price, CAST(nu_freight_value AS DOUBLE) AS nu_freight_value")
    q["q_insert_items"] = _with(TRUSTED_ITEMS) + f"SELECT {money_items} FROM t_items"
    q["q_insert_payments"] = _with(TRUSTED_PAYMENTS) + """SELECT ref_day, ref_file_extraction, order_id,
       nu_payment_sequential, payment_type, nu_payment_installments,
       CAST(nu_payment_value AS DOUBLE) AS nu_payment_value FROM t_pay"""
    q["q_insert_products"] = _with(PROD_FEED + "," + _insert_only(
        "t_prod", "prod_t_src", "prod_b_src", ["product_id"], PROD_TIE, PROD_COLS)) + \
        f"SELECT {PROD_COLS} FROM t_prod"
    q["q_dim_products"] = _with(PROD_FEED + "," + _upsert(
        "t_prod", "prod_t_src", "prod_b_src", "product_id", PROD_TIE, PROD_COLS)) + \
        f"SELECT {PROD_COLS}, TIMESTAMP '2024-01-11 00:00:00' AS ref_dw_process FROM t_prod"
    q["q_scd2_history"] = _with(CUST_DROPS, cust_history("h", (1, 2, 3))) + f"SELECT {HIST_COLS} FROM h"
    q["q_run_batch_customers"] = q["q_scd2_history"]
    q["q_stream_merge_customers"] = q["q_catch_up_customers"] = q["q_scd2_history"]
    # the batch that died had its day stored with its rows
    q["q_version_ledger"] = _with(CUST_DROPS, cust_history("h1", (1,)), cust_history("h", (1, 2, 3))) + """
SELECT 'b1' AS version, CAST(NULL AS VARCHAR) AS parent, COUNT(*) AS nu_ins, CAST(0 AS BIGINT) AS nu_upd,
       CAST(0 AS BIGINT) AS nu_del, COUNT(*) AS nu_rows, CAST(0 AS BIGINT) AS nu_keyless FROM h1
UNION ALL
SELECT 'b2', 'b1', COUNT(*) FILTER (WHERE NOT kept), COUNT(*) FILTER (WHERE kept AND ts_end_date IS NOT NULL), 0,
       COUNT(*), 0
FROM (SELECT h.*, EXISTS (SELECT 1 FROM h1 WHERE h1.customer_id = h.customer_id
                          AND h1.ref_file_extraction = h.ref_file_extraction) AS kept FROM h)"""
    q["q_stream_merge"] = _with(ORDER_FEEDS) + f"""SELECT
       CASE WHEN order_status = 'O' THEN {S.REF_DAY_1} ELSE {S.REF_DAY_2} END AS ref_day,
       CAST(CASE WHEN order_status = 'O' THEN {S.PLACED_DROP} ELSE {S.CLOSED_DROP} END AS BIGINT) AS ref_file_extraction,
       order_id, customer_id, order_status, ts_order_purchase, ts_order_approved_at, ts_order_delivered_carrier,
       ts_order_delivered_customer, dt_order_estimated_delivery
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_status = 'O') AS rn FROM ord_hist) WHERE rn = 1"""
    q["q_stream_merge_payments"] = _with(PAY_FEED) + f"""SELECT
       CASE WHEN nu_payment_sequential = 1 THEN {S.REF_DAY_1} ELSE {S.REF_DAY_2} END AS ref_day,
       CAST(CASE WHEN nu_payment_sequential = 1 THEN {S.PAYMENT_DROPS[0]} ELSE {S.PAYMENT_DROPS[1]} END AS BIGINT)
         AS ref_file_extraction, order_id, nu_payment_sequential, payment_type, nu_payment_installments,
       CAST(nu_payment_value AS DOUBLE) AS nu_payment_value FROM pay_obs"""
    q["q_scd2_late"] = _with(CUST_DROPS, cust_history(
        "h", (1, 2, 3), f"AND (drop_no <> 2 OR CAST(customer_id AS BIGINT) % {S.MOVE_EVERY} = 0)")) + \
        f"SELECT {HIST_COLS} FROM h"
    q["q_scd2_active"] = _with(CUST_DROPS, cust_history("h", (1, 2, 3))) + \
        f"SELECT {HIST_COLS} FROM h WHERE flag_scd_active"
    q["q_scd2_events"] = _with(EVENTS) + EV_SELECT
    q["q_changed_customers"] = _with(CUST_DROPS, cust_history("h1", (1,))) + f"""SELECT o.ref_day,
       o.ref_file_extraction, o.ts_effective, o.customer_id, o.customer_unique_id,
       o.customer_zip_code_prefix, o.customer_city, o.customer_state
FROM cust_obs o JOIN h1 a ON o.customer_id = a.customer_id AND a.flag_scd_active
WHERE o.drop_no = 2 AND o.ref_file_extraction > a.ref_file_extraction
  AND (o.customer_zip_code_prefix IS DISTINCT FROM a.customer_zip_code_prefix
       OR o.customer_city IS DISTINCT FROM a.customer_city
       OR o.customer_state IS DISTINCT FROM a.customer_state)"""
    q["q_scd2_changes"] = _scd2_changes((1,), (1, 2))
    q["q_scd2_changes_late"] = _scd2_changes((2, 3), (1, 2, 3))
    q["q_control_customers"] = f"""SELECT 'raw' AS str_origin_zone, 'trusted' AS str_target_zone,
       'trusted_customers' AS str_process, 'ecommerce/olist_customers_dataset' AS str_origin_file_path,
       'ecommerce/olist_customers_dataset' AS str_target_file_path, CAST({S.PROC_STAMP} AS BIGINT) AS dt_proc,
       COUNT(*) AS num_affected_rows,
       COUNT(*) FILTER (WHERE change_kind IN ('close', 'update')) AS num_updated_rows,
       COUNT(*) FILTER (WHERE change_kind = 'delete') AS num_deleted_rows,
       COUNT(*) FILTER (WHERE change_kind = 'insert') AS num_inserted_rows
FROM ({_scd2_changes((1, 2), (1, 2, 3))})"""
    q["q_insert_metrics"] = _with(TRUSTED_ITEMS) + """SELECT CAST(NULL AS BIGINT) AS num_affected_rows,
       CAST(NULL AS BIGINT) AS num_updated_rows, CAST(NULL AS BIGINT) AS num_deleted_rows,
       COUNT(*) FILTER (WHERE merge_action = 'insert') AS num_inserted_rows FROM t_items"""
    q["q_temporal_events"] = _with(EVENTS) + f""", h AS ({EV_SELECT}),
facts AS (
  SELECT event_id AS fact_id, CASE WHEN event_id % 50 <> 0 THEN user_id END AS fact_user,
         ts + INTERVAL 1 HOUR AS ts_fact FROM events)
SELECT f.fact_id, f.fact_user, f.ts_fact, h.event_type, h.event_id
FROM facts f LEFT JOIN h ON f.fact_user = h.user_id
  AND (h.ts_start_date IS NULL OR f.ts_fact >= h.ts_start_date)
  AND (h.ts_end_date IS NULL OR f.ts_fact < h.ts_end_date)"""
    q["q_temporal_join"] = _with(CUST_DROPS, cust_history("h", (1, 2, 3))) + """SELECT
       CAST(o.o_orderkey AS VARCHAR) AS order_id, CAST(o.o_custkey AS VARCHAR) AS customer_id,
       o.o_orderdate AS ts_order_purchase, h.customer_zip_code_prefix, h.customer_city,
       h.customer_state, h.ref_file_extraction AS ref_customer_version
FROM orders o LEFT JOIN h ON CAST(o.o_custkey AS VARCHAR) = h.customer_id
  AND (h.ts_start_date IS NULL OR o.o_orderdate >= h.ts_start_date)
  AND (h.ts_end_date IS NULL OR o.o_orderdate < h.ts_end_date)"""
    q["q_dim_location_distinct"] = _with(CUST_DROPS, cust_history("h", (1, 2, 3))) + """SELECT DISTINCT
       customer_zip_code_prefix, customer_city, customer_state
FROM h WHERE customer_zip_code_prefix IS NOT NULL"""
    q["q_control_trusted"] = _with(TRUSTED_ORDERS) + """SELECT 'raw' AS str_origin_zone,
       'trusted' AS str_target_zone, 'trusted_orders' AS str_process,
       'ecommerce/olist_orders_dataset' AS str_origin_file_path,
       'ecommerce/olist_orders_dataset' AS str_target_file_path,
       CAST(20240111000000 AS BIGINT) AS dt_proc,
       CAST(SUM(CASE WHEN merge_action IN ('insert', 'update') THEN 1 ELSE 0 END) AS BIGINT) AS num_affected_rows,
       CAST(SUM(CASE WHEN merge_action = 'update' THEN 1 ELSE 0 END) AS BIGINT) AS num_updated_rows,
       CAST(0 AS BIGINT) AS num_deleted_rows,
       CAST(SUM(CASE WHEN merge_action = 'insert' THEN 1 ELSE 0 END) AS BIGINT) AS num_inserted_rows
FROM t_orders"""
    q["q_dim_location"] = _with(CUST_DROPS, cust_history("hist123", (1, 2, 3)), DIM_LOCATION) + \
        "SELECT * FROM dim_location"
    q["q_dim_customers"] = _with(CUST_DROPS, cust_history("hist12", (1, 2)),
                                 cust_history("hist123", (1, 2, 3)), DIM_CUSTOMERS) + \
        "SELECT *, TIMESTAMP '2024-01-11 00:00:00' AS ref_dw_process FROM dimc"
    q["q_fact_orders"] = "WITH " + FACT_CTES + "\n" + FACT_SELECT
    q["q_agg_city"] = "WITH " + FACT_CTES + "," + DIM_LOCATION + "\n" + AGG_CITY
    q["q_incremental_fact"] = "WITH " + LANDED_CTES + "\n" + FACT_SELECT.replace("customer_id, sk_customers,", "customer_id,")
    q["q_incremental_marts"] = "WITH " + LANDED_CTES + "," + DIM_LOCATION + f"""
SELECT 'city' AS mart, * FROM ({AGG_CITY}) UNION ALL BY NAME SELECT 'day' AS mart, * FROM ({AGG_DAY})"""
    q["q_agg_day_payment"] = "WITH " + FACT_CTES + "\n" + AGG_DAY
    return q
