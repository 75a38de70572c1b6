"""Column contracts of the raw tables and of the warehouse tables."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(text: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _KINDS[kind]) for name, kind in (part.split() for part in text.split(","))]
    )


RAW = {
    "orders": _schema(
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
    ),
    "customers": _schema(
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, "
        "customer_state string"
    ),
    "order_items": _schema(
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price double, freight_value double"
    ),
    "payments": _schema(
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double"
    ),
    "reviews": _schema(
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"
    ),
    "products": _schema(
        "product_id string, product_category_name string, product_name_lenght int, product_description_lenght int, "
        "product_photos_qty int, product_weight_g double, product_length_cm double, product_height_cm double, "
        "product_width_cm double"
    ),
    "sellers": _schema("seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"),
    "category_translation": _schema("product_category_name string, product_category_name_english string"),
}

OPTIONAL_TABLES = ("category_translation", "geo")

ORDER_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
REVIEW_TIMESTAMPS = ("review_creation_date", "review_answer_timestamp")
PRODUCT_DIMENSIONS = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")

WAREHOUSE = {
    "fact_orders": _schema(
        "order_id string, customer_id string, customer_unique_id string, time_id int, "
        "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
        "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
        "order_estimated_delivery_date timestamp_ntz, order_status string, customer_state string, "
        "customer_city string, delivery_delay_days double, is_late int, total_payment double, "
        "total_items_value double, total_freight double, total_order_value double, item_count bigint, "
        "payment_installments int, payment_type string, review_score double, purchase_date date"
    ),
    "dim_customers": RAW["customers"],
    "dim_products": _schema(
        "product_id string, product_category_name string, product_category_name_english string, "
        "product_name_lenght int, product_description_lenght int, product_photos_qty int, product_weight_g double, "
        "product_length_cm double, product_height_cm double, product_width_cm double, seller_id string"
    ),
    "dim_sellers": RAW["sellers"],
    "dim_time": _schema(
        "time_id int, date date, year int, month int, month_name string, day int, quarter int, week_of_year int, "
        "day_of_week string, is_weekend int"
    ),
    "order_items": RAW["order_items"],
    "payments": RAW["payments"],
    "reviews": RAW["reviews"],
}

# Declared keys, required columns and references of the warehouse.
PRIMARY_KEYS = (
    ("dim_customers", ("customer_id",)),
    ("dim_products", ("product_id",)),
    ("dim_sellers", ("seller_id",)),
    ("dim_time", ("time_id",)),
    ("dim_time", ("date",)),
    ("fact_orders", ("order_id",)),
    ("order_items", ("order_id", "order_item_id")),
    ("payments", ("order_id", "payment_sequential")),
    ("reviews", ("review_id",)),
)
NOT_NULL = (
    ("dim_customers", "customer_unique_id"),
    ("dim_time", "date"),
    ("fact_orders", "customer_id"),
    ("order_items", "order_id"),
    ("order_items", "order_item_id"),
    ("payments", "order_id"),
    ("reviews", "order_id"),
)
FOREIGN_KEYS = (
    ("fact_orders", "customer_id", "dim_customers"),
    ("fact_orders", "time_id", "dim_time"),
    ("order_items", "order_id", "fact_orders"),
    ("order_items", "product_id", "dim_products"),
    ("order_items", "seller_id", "dim_sellers"),
    ("payments", "order_id", "fact_orders"),
    ("reviews", "order_id", "fact_orders"),
)


#: Columns of the contracts that a data set may lack.
OPTIONAL_COLUMNS = {
    "products": ("product_name_lenght", "product_description_lenght", "product_photos_qty"),
    "dim_products": ("product_name_lenght", "product_description_lenght", "product_photos_qty"),
    "reviews": ("review_comment_title", "review_comment_message"),
}

# Casts that lose nothing.
_WIDER = {T.IntegerType: (T.LongType, T.DoubleType), T.LongType: (T.DoubleType,), T.ShortType: (T.IntegerType, T.LongType)}


class ContractError(ValueError):
    """A table does not hold its contract."""


def conform(df: DataFrame, schema: T.StructType, optional: Collection[str] = (), exact: bool = False) -> DataFrame:
    """The contract's columns in its order and types.

    A column that the input lacks must be in ``optional`` and is left out then. A column of another type fails, but for
    whole numbers that are widened; with ``exact`` these fail too. Further columns of the input are dropped.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name} is missing" for f in schema if f.name not in kinds and f.name not in optional]
    for f in schema:
        kind = kinds.get(f.name, f.dataType)
        widened = not exact and isinstance(f.dataType, _WIDER.get(type(kind), ()))
        if kind != f.dataType and not widened:
            wrong.append(f"{f.name} is {kind.simpleString()}, not {f.dataType.simpleString()}")
    if wrong:
        raise ContractError("; ".join(wrong))
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in kinds])


def empty(spark, table: str) -> DataFrame:
    return spark.createDataFrame([], RAW[table])
