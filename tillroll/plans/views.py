"""Reporting views over the warehouse."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def monthly_revenue(fact: DataFrame, time: DataFrame) -> DataFrame:
    """Delivered orders per month. The time dimension is bounded by the calendar (see dim_time), so it is broadcast."""
    months = time.select("time_id", "year", "month", "month_name")
    return (
        fact.filter(F.col("order_status") == "delivered")
        .join(F.broadcast(months), "time_id")
        .groupBy("year", "month", "month_name")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("total_order_value").alias("revenue"),
            F.avg("total_order_value").alias("avg_order_value"),
            F.sum(F.when(F.col("is_late") == 1, 1).otherwise(0)).alias("late_deliveries"),
        )
        .orderBy("year", "month")
    )


def seller_performance(sellers: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per seller: orders, revenue, mean item price, mean score. Sellers without items stay.

    By definition every item counts once per review of its order. That product is never materialised: items shrink to
    (seller, order) sums and reviews to one row per order before they meet, and the counts multiply.
    """
    pairs = items.filter(F.col("seller_id").isNotNull()).groupBy("seller_id", "order_id").agg(
        F.count(F.lit(1)).alias("_items"), F.sum("price").alias("_price"), F.count("price").alias("_priced")
    )
    scores = reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_reviews"),
        F.sum("review_score").alias("_score"),
        F.count("review_score").alias("_scored"),
    )
    times = F.coalesce("_reviews", F.lit(1))
    per_seller = (
        pairs.join(scores, "order_id", "left")
        .groupBy("seller_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum(F.col("_price") * times).alias("total_revenue"),
            F.sum(F.col("_priced") * times).alias("_priced"),
            F.sum(F.col("_items") * F.col("_score")).alias("_score"),
            F.sum(F.col("_items") * F.col("_scored")).alias("_scored"),
        )
    )
    return sellers.select("seller_id", "seller_state").join(per_seller, "seller_id", "left").select(
        "seller_id",
        "seller_state",
        F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        "total_revenue",
        F.try_divide("total_revenue", F.col("_priced")).alias("avg_item_price"),
        F.try_divide("_score", F.col("_scored")).alias("avg_review_score"),
    )


def customer_summary(customers: DataFrame, fact: DataFrame) -> DataFrame:
    """Per person and state: orders, value, last order, mean score. Orders shrink to one row per customer id first."""
    value, score = F.col("total_order_value"), F.col("review_score")
    per_id = fact.groupBy("customer_id").agg(
        F.count("order_id").alias("_orders"),
        F.sum(value).alias("_value"),
        F.count(value).alias("_valued"),
        F.max("order_purchase_timestamp").alias("_last"),
        F.sum(score).alias("_score"),
        F.count(score).alias("_scored"),
    )
    return (
        customers.select("customer_id", "customer_unique_id", "customer_state")
        .join(per_id, "customer_id")
        .groupBy("customer_unique_id", "customer_state")
        .agg(
            F.sum("_orders").alias("order_count"),
            F.sum("_value").alias("lifetime_value"),
            F.try_divide(F.sum("_value"), F.sum("_valued")).alias("avg_order_value"),
            F.max("_last").alias("last_order_date"),
            F.try_divide(F.sum("_score"), F.sum("_scored")).alias("avg_review_score"),
        )
    )


def register(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Make the warehouse tables and the views whose tables exist available to ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    views = {
        "v_monthly_revenue": (monthly_revenue, "fact_orders", "dim_time"),
        "v_seller_performance": (seller_performance, "dim_sellers", "order_items", "reviews"),
        "v_customer_summary": (customer_summary, "dim_customers", "fact_orders"),
    }
    for view, (build, *sources) in views.items():
        if all(source in tables for source in sources):
            build(*[tables[source] for source in sources]).createOrReplaceTempView(view)
