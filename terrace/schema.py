"""Entity contracts: landing columns, typed trusted columns, keys, tracked attributes.

FIXED VALUES — these names are the landing CSV contract of the e-commerce
order data set (column names and their misspellings are part of the input
contract and must not be corrected):

  customers      customer_id, customer_unique_id, customer_zip_code_prefix,
                 customer_city, customer_state
  orders         order_id, customer_id, order_status, order_purchase_timestamp,
                 order_approved_at, order_delivered_carrier_date,
                 order_delivered_customer_date, order_estimated_delivery_date
  order items    order_id, order_item_id, product_id, seller_id,
                 shipping_limit_date, price, freight_value
  payments       order_id, payment_sequential, payment_type,
                 payment_installments, payment_value
  products       product_id, product_category_name, product_name_lenght,
                 product_description_lenght, product_photos_qty,
                 product_weight_g, product_length_cm, product_height_cm,
                 product_width_cm
  landing file   <folder>/<folder>_<yyyyMMddHHmmss>.csv
  folders        olist_customers_dataset, olist_orders_dataset,
                 olist_order_items_dataset, olist_order_payments_dataset,
                 olist_products_dataset
"""

from __future__ import annotations

from dataclasses import dataclass, field

MONEY = "decimal(18,2)"

# Lineage columns every raw row carries.
REF_DAY = "ref_day"
REF_DAY_PARTITION = "ref_day_partition"
REF_FILE = "ref_file_extraction"
REF_FILE_PARTITION = "ref_file_extraction_partition"
# The ingest unit (a stream epoch, or a whole drop): what a replay replaces.
INGEST = "ingest_partition"
RAW_PARTITIONS = (REF_DAY_PARTITION, REF_FILE_PARTITION, INGEST)


@dataclass(frozen=True)
class Entity:
    name: str
    folder: str
    landing: tuple[str, ...]
    # (landing column, trusted column, Spark type)
    typed: tuple[tuple[str, str, str], ...]
    keys: tuple[str, ...]
    tracked: tuple[str, ...] = field(default=())

    @property
    def trusted_columns(self) -> list[str]:
        return [t for _, t, _ in self.typed]


CUSTOMERS = Entity(
    name="customers",
    folder="olist_customers_dataset",
    landing=("customer_id", "customer_unique_id", "customer_zip_code_prefix",
             "customer_city", "customer_state"),
    typed=(("customer_id", "customer_id", "string"),
           ("customer_unique_id", "customer_unique_id", "string"),
           ("customer_zip_code_prefix", "customer_zip_code_prefix", "string"),
           ("customer_city", "customer_city", "string"),
           ("customer_state", "customer_state", "string")),
    keys=("customer_id",),
    tracked=("customer_zip_code_prefix", "customer_city", "customer_state"),
)

ORDERS = Entity(
    name="orders",
    folder="olist_orders_dataset",
    landing=("order_id", "customer_id", "order_status", "order_purchase_timestamp",
             "order_approved_at", "order_delivered_carrier_date",
             "order_delivered_customer_date", "order_estimated_delivery_date"),
    typed=(("order_id", "order_id", "string"),
           ("customer_id", "customer_id", "string"),
           ("order_status", "order_status", "string"),
           ("order_purchase_timestamp", "ts_order_purchase", "timestamp"),
           ("order_approved_at", "ts_order_approved_at", "timestamp"),
           ("order_delivered_carrier_date", "ts_order_delivered_carrier", "timestamp"),
           ("order_delivered_customer_date", "ts_order_delivered_customer", "timestamp"),
           ("order_estimated_delivery_date", "dt_order_estimated_delivery", "date")),
    keys=("order_id",),
)

ORDER_ITEMS = Entity(
    name="order_items",
    folder="olist_order_items_dataset",
    landing=("order_id", "order_item_id", "product_id", "seller_id",
             "shipping_limit_date", "price", "freight_value"),
    typed=(("order_id", "order_id", "string"),
           ("order_item_id", "order_item_id", "int"),
           ("product_id", "product_id", "string"),
           ("shipping_limit_date", "ts_shipping_limit", "timestamp"),
           ("price", "nu_price", MONEY),
           ("freight_value", "nu_freight_value", MONEY)),
    keys=("order_id", "order_item_id"),
)

ORDER_PAYMENTS = Entity(
    name="order_payments",
    folder="olist_order_payments_dataset",
    landing=("order_id", "payment_sequential", "payment_type",
             "payment_installments", "payment_value"),
    typed=(("order_id", "order_id", "string"),
           ("payment_sequential", "nu_payment_sequential", "int"),
           ("payment_type", "payment_type", "string"),
           ("payment_installments", "nu_payment_installments", "int"),
           ("payment_value", "nu_payment_value", MONEY)),
    keys=("order_id", "nu_payment_sequential"),
)

PRODUCTS = Entity(
    name="products",
    folder="olist_products_dataset",
    landing=("product_id", "product_category_name", "product_name_lenght",
             "product_description_lenght", "product_photos_qty", "product_weight_g",
             "product_length_cm", "product_height_cm", "product_width_cm"),
    typed=(("product_id", "product_id", "string"),
           ("product_category_name", "product_category_name", "string"),
           ("product_name_lenght", "nu_product_name_lenght", "int"),
           ("product_description_lenght", "nu_product_description_lenght", "int"),
           ("product_photos_qty", "nu_product_photos_qty", "int"),
           ("product_weight_g", "nu_product_weight_g", "double"),
           ("product_length_cm", "nu_product_length_cm", "double"),
           ("product_height_cm", "nu_product_height_cm", "double"),
           ("product_width_cm", "nu_product_width_cm", "double")),
    keys=("product_id",),
)

ENTITIES = {e.name: e for e in (CUSTOMERS, ORDERS, ORDER_ITEMS, ORDER_PAYMENTS, PRODUCTS)}
