"""Cleaning rules. Every function takes and returns lazy frames; the row-wise rules need no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import non_negative, parse_timestamp, strip
from ..operators.dedup import distinct_apart, keep_first, keep_first_apart
from ..operators.profile import rows_of, stack
from ..operators.quantiles import quantile_row, with_row
from ..schemas import ORDER_TIMESTAMPS, PRODUCT_DIMENSIONS, RAW, REVIEW_TIMESTAMPS


class Landed(dict):
    """Raw tables in files that cost little to read again: their rows are shuffled only where they may come again."""


REVIEW_ORDER = ("review_answer_timestamp", "order_id", "review_score", "review_creation_date")


def parse_timestamps(df: DataFrame, columns: Sequence[str], permissive: bool = False) -> DataFrame:
    """Parse text timestamps; columns that are timestamps already, or absent, stay as they are."""
    text = [c for c, kind in df.dtypes if kind == "string" and c in columns]
    return df.withColumns({c: parse_timestamp(F.col(c), permissive) for c in text})


def null_negatives(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Negative amounts become null; the row stays."""
    return df.withColumns({c: non_negative(F.col(c)) for c in columns if c in df.columns})


def normalize_place(df: DataFrame, city: str, state: str) -> DataFrame:
    rules = {state: F.upper(strip(F.col(state))), city: F.lower(strip(F.col(city)))}
    return df.withColumns({c: rule for c, rule in rules.items() if c in df.columns})


def impute_median(df: DataFrame, columns: Sequence[str] = PRODUCT_DIMENSIONS) -> DataFrame:
    """Fill nulls with the column's median over the whole table."""
    present = [c for c in columns if c in df.columns]
    medians = quantile_row(df, {f"_median_{c}": (c, 0.5) for c in present})
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_median_{c}")) for c in present}
    return with_row(df, medians).withColumns(filled).drop(*[f"_median_{c}" for c in present])


def translate_category(products: DataFrame, translation: DataFrame | None) -> DataFrame:
    """Add the English category, falling back to the original one.

    The join carries no hint: Spark broadcasts the lookup when it is small and otherwise sort-merges, where adaptive
    execution splits a category that dominates the products.
    """
    if translation is None:
        return products
    return products.join(translation, "product_category_name", "left").select(
        *products.columns,
        F.coalesce("product_category_name_english", "product_category_name").alias("product_category_name_english"),
    )


def first_orders(orders: DataFrame, copies: str | None = None, landed: bool = False) -> DataFrame:
    """First row per order: by purchase time, then the remaining columns in table order, nulls first."""
    parsed = parse_timestamps(orders, ORDER_TIMESTAMPS)
    if landed:
        return keep_first_apart(parsed, "order_id", ["order_purchase_timestamp"])
    return keep_first(parsed, "order_id", ["order_purchase_timestamp"], copies=copies)


def first_reviews(reviews: DataFrame, landed: bool = False) -> DataFrame:
    """First row per review: by answer time (null last), order, score (null last), creation date, remaining columns.

    One review id may stand for several orders; only the first of them keeps the review.
    """
    first = keep_first_apart if landed else keep_first
    return first(
        parse_timestamps(reviews, REVIEW_TIMESTAMPS), "review_id", REVIEW_ORDER, ("review_answer_timestamp", "review_score")
    )


def clean_orders(orders: DataFrame, landed: bool = False) -> DataFrame:
    return first_orders(orders, landed=landed)


def clean_customers(customers: DataFrame) -> DataFrame:
    return normalize_place(keep_first(customers, "customer_id"), "customer_city", "customer_state")


def clean_order_items(items: DataFrame, landed: bool = False) -> DataFrame:
    distinct = distinct_apart(items) if landed else items.distinct()
    parsed = parse_timestamps(distinct, ["shipping_limit_date"])
    return null_negatives(parsed, ["price", "freight_value"])


def clean_payments(payments: DataFrame, landed: bool = False) -> DataFrame:
    """Distinct rows with a value of zero or more; the filter runs before the shuffle."""
    known = payments.filter(F.col("payment_value") >= 0)
    return distinct_apart(known) if landed else known.distinct()


def scored_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.filter(F.col("review_score").isNotNull())


def clean_reviews(reviews: DataFrame, landed: bool = False) -> DataFrame:
    return scored_reviews(first_reviews(reviews, landed))


def clean_products(products: DataFrame, translation: DataFrame | None) -> DataFrame:
    return translate_category(impute_median(keep_first(products, "product_id")), translation)


def clean_sellers(sellers: DataFrame) -> DataFrame:
    return normalize_place(keep_first(sellers, "seller_id"), "seller_city", "seller_state")


def clean_tables(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The whole pass: nine raw tables (translation and geo optional) to seven clean ones."""
    missing = [t for t in RAW if t != "category_translation" and t not in raw]
    if missing:
        raise ValueError(f"raw tables missing: {', '.join(missing)}")
    landed = isinstance(raw, Landed)
    return {
        "orders": clean_orders(raw["orders"], landed),
        "customers": clean_customers(raw["customers"]),
        "order_items": clean_order_items(raw["order_items"], landed),
        "payments": clean_payments(raw["payments"], landed),
        "reviews": clean_reviews(raw["reviews"], landed),
        "products": clean_products(raw["products"], raw.get("category_translation")),
        "sellers": clean_sellers(raw["sellers"]),
    }


def clean_audit(raw: Mapping[str, DataFrame]) -> DataFrame:
    """What the pass drops and changes, as rows (table_name, metric, value); one scan per table."""
    count_if = F.count_if
    orders = first_orders(raw["orders"], copies="_copies").agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("dropped_duplicates"),
        count_if(F.col("order_approved_at").isNull()).alias("null_approved"),
        count_if(F.col("order_delivered_customer_date").isNull()).alias("null_delivered"),
    )
    items = raw["order_items"].distinct().agg(
        count_if(F.col("price") < 0).alias("negatives_price"),
        count_if(F.col("freight_value") < 0).alias("negatives_freight"),
    )
    reviews = first_reviews(raw["reviews"]).agg(count_if(F.col("review_score").isNull()).alias("null_score"))
    products = keep_first(raw["products"], "product_id").agg(
        *[count_if(F.col(c).isNull()).alias(f"null_{c}") for c in PRODUCT_DIMENSIONS]
    )
    tables = {"orders": orders, "order_items": items, "reviews": reviews, "products": products}
    return stack(
        [
            rows_of(df, ("table_name", "metric", "value"), [(F.lit(name), F.lit(m), F.col(m)) for m in df.columns])
            for name, df in tables.items()
        ]
    )
