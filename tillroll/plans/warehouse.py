"""Star schema: one fact, four dimensions, three detail tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import day_text, floor_days, is_late, second_text, total
from ..operators.joins import right_skew_join, skew_join
from ..schemas import OPTIONAL_COLUMNS, WAREHOUSE, conform

#: What each part of the fact adds to the orders.
FACT_COLUMNS = {
    "customer": ("customer_unique_id", "customer_state", "customer_city"),
    "payment": ("total_payment", "payment_installments", "payment_type"),
    "items": ("total_items_value", "total_freight", "total_order_value", "item_count"),
    "review": ("review_score",),
    "time": ("time_id",),
}
FACT_PARTS = tuple(FACT_COLUMNS)


def payment_agg(payments: DataFrame) -> DataFrame:
    """Per order: paid total, most installments, most frequent payment type (lowest name on a tie, nulls ignored).

    Rows are first reduced per order and type by a hash aggregate, already in the map tasks, so that an order with very many
    payments arrives as one row per type and task.
    """
    per_type = (
        payments.filter(F.col("order_id").isNotNull())
        .groupBy("order_id", "payment_type")
        .agg(
            F.sum("payment_value").alias("_paid"),
            F.max("payment_installments").alias("_most"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    known = F.col("payment_type").isNotNull()
    often = F.when(known, F.struct((-F.col("_n")).alias("fewer"), F.col("payment_type").alias("name")))
    return per_type.groupBy("order_id").agg(
        total(F.col("_paid")).alias("total_payment"),
        F.max("_most").alias("payment_installments"),
        F.min(often)["name"].alias("payment_type"),
    )


def items_agg(items: DataFrame) -> DataFrame:
    """Per order: item value, freight, number of items and their sum."""
    sums = items.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        total(F.col("price")).alias("total_items_value"),
        total(F.col("freight_value")).alias("total_freight"),
        F.count("order_item_id").alias("item_count"),
    )
    return sums.withColumn("total_order_value", F.col("total_items_value") + F.col("total_freight"))


def latest_review(reviews: DataFrame) -> DataFrame:
    """Score of the last answered review per order; an unanswered one counts as last, review_id breaks ties."""
    answered = F.col("review_answer_timestamp")
    when = F.struct(answered.isNull().alias("open"), answered.alias("at"), F.col("review_id"))
    scored = reviews.filter(F.col("review_score").isNotNull() & F.col("order_id").isNotNull())
    return scored.groupBy("order_id").agg(F.max_by("review_score", when).cast("double").alias("review_score"))


def delay_of(orders: DataFrame) -> DataFrame:
    """Add delivery_delay_days and is_late; both are null unless the order is delivered."""
    delivered = F.col("order_status") == "delivered"
    days = floor_days(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))
    return orders.withColumn("delivery_delay_days", F.when(delivered, days)).withColumn(
        "is_late", F.when(delivered, is_late(F.col("delivery_delay_days")))
    )


def delivery_delay(orders: DataFrame) -> DataFrame:
    return delay_of(orders.filter(F.col("order_status") == "delivered")).select(
        "order_id", "delivery_delay_days", "is_late"
    )


def dim_time(orders: DataFrame) -> DataFrame:
    """One row per purchase date that occurs, numbered from 1 in date order.

    The numbering orders all dates in one task. Their number is bounded by the calendar, not by the orders: a Spark
    date lies in the years 1 to 9999, at most 3.7 million rows of one date each.
    """
    purchased = F.to_date("order_purchase_timestamp")
    dates = orders.select(purchased.alias("date")).filter(F.col("date").isNotNull()).distinct()
    d = F.col("date")
    return dates.select(
        F.row_number().over(Window.orderBy("date")).alias("time_id"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.weekofyear(d).alias("week_of_year"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        (F.weekday(d) >= 5).cast("int").alias("is_weekend"),
    )


def dim_products(products: DataFrame, items: DataFrame) -> DataFrame:
    """One row per product and seller that sold it; a product without sales keeps one row with a null seller.

    A product that very many sellers sell is split over tasks by its sellers.
    """
    pairs = items.filter(F.col("product_id").isNotNull()).select("product_id", "seller_id").distinct()
    joined = right_skew_join(products, pairs, "product_id", spread_by="seller_id")
    optional = {*OPTIONAL_COLUMNS["dim_products"], "product_category_name_english"}
    return conform(joined, WAREHOUSE["dim_products"], optional)


def fact_orders(
    clean: Mapping[str, DataFrame], time: DataFrame | None = None, parts: Iterable[str] = FACT_PARTS
) -> DataFrame:
    """One row per order. ``parts`` limits the build to the measures a query reads.

    The clean orders and the per-order aggregates are all hash-partitioned by order_id, so these joins add no shuffle
    of their own. Customers are joined last because many orders may share one customer id.
    """
    parts = set(parts)
    fact = delay_of(clean["orders"]).withColumn("purchase_date", F.to_date("order_purchase_timestamp"))
    if "payment" in parts:
        fact = fact.join(payment_agg(clean["payments"]), "order_id", "left")
    if "items" in parts:
        fact = fact.join(items_agg(clean["order_items"]), "order_id", "left")
    if "review" in parts:
        fact = fact.join(latest_review(clean["reviews"]), "order_id", "left")
    if "time" in parts:
        time = dim_time(clean["orders"]) if time is None else time
        keys = time.select(F.col("date").alias("purchase_date"), "time_id")
        # One row per calendar date, see dim_time.
        fact = fact.join(F.broadcast(keys), "purchase_date", "left")
    if "customer" in parts:
        customers = clean["customers"].select("customer_id", "customer_unique_id", "customer_state", "customer_city")
        fact = skew_join(fact, customers, "customer_id", spread_by="order_id", counted_in=clean["orders"])
    left_out = {c for part, columns in FACT_COLUMNS.items() if part not in parts for c in columns}
    return conform(fact, WAREHOUSE["fact_orders"], left_out)


def build(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The eight warehouse tables from the seven clean ones."""
    time = dim_time(clean["orders"])
    return {
        "fact_orders": fact_orders(clean, time),
        "dim_customers": clean["customers"],
        "dim_products": dim_products(clean["products"], clean["order_items"]),
        "dim_sellers": clean["sellers"],
        "dim_time": time,
        "order_items": clean["order_items"],
        "payments": clean["payments"],
        "reviews": clean["reviews"],
    }


def bi_export(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, booleans as 0/1, for tools without these types; null stays null."""
    as_text = {"timestamp_ntz": second_text, "timestamp": second_text, "date": day_text}
    columns = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind in as_text:
            c = as_text[kind](c)
        elif kind == "boolean":
            c = c.cast("int")
        columns.append(c.alias(name))
    return df.select(columns)
