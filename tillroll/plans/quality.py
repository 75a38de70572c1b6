"""Data-quality checks over the raw tables and declared constraints over the warehouse. Findings are rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import all_null, second_text
from ..operators import profile
from ..operators.joins import orphan_counts
from ..operators.presence import Reference, broken_references
from ..operators.profile import null_facts, null_measures, rows_of, stack
from ..operators.quantiles import quantile_row, with_row
from ..schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, PRODUCT_DIMENSIONS

# Key looked at per table. For items and payments it is knowingly not unique.
CHECKED_KEYS = {
    "orders": "order_id",
    "customers": "customer_id",
    "order_items": "order_id",
    "payments": "order_id",
    "reviews": "review_id",
    "products": "product_id",
    "sellers": "seller_id",
}
CATEGORICAL = (("orders", "order_status"), ("payments", "payment_type"), ("reviews", "review_score"))
NUMERIC_PAYMENT_COLUMNS = ("payment_value", "payment_installments")
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
RELATIONS = (
    ("orders_without_customer", "orders", "customers", "customer_id"),
    ("items_without_order", "order_items", "orders", "order_id"),
    ("items_without_product", "order_items", "products", "product_id"),
    ("items_without_seller", "order_items", "sellers", "seller_id"),
)
EXTREME_FACTOR = 3.0

Raw = Mapping[str, DataFrame]


def table_counts(raw: Raw) -> DataFrame:
    return stack([profile.row_count(df, name) for name, df in raw.items()])


def null_profile(raw: Raw) -> DataFrame:
    return stack([profile.null_profile(raw[t], t) for t in CHECKED_KEYS])


def duplicate_check(raw: Raw) -> DataFrame:
    return stack([profile.duplicate_check(raw[t], t, key) for t, key in CHECKED_KEYS.items()])


def duplicate_keys(raw: Raw, top: int = 5) -> DataFrame:
    return stack([profile.duplicate_keys(raw[t], t, key, top) for t, key in CHECKED_KEYS.items()])


def value_checks(raw: Raw) -> DataFrame:
    return stack([profile.distinct_values(raw[t], t, [c]) for t, c in CATEGORICAL])


def value_counts(raw: Raw, top: int | None = 10) -> DataFrame:
    return stack([profile.value_counts(raw[t], t, c, top) for t, c in CATEGORICAL])


def describe_payments(raw: Raw) -> DataFrame:
    return profile.describe(raw["payments"], NUMERIC_PAYMENT_COLUMNS, QUARTILES)


def _raw_references() -> list[Reference]:
    return [Reference(name, child, key, parent, key) for name, child, parent, key in RELATIONS]


def referential_integrity(raw: Raw) -> DataFrame:
    """Child rows without their parent, per relation; a null key matches a null key. One shuffle answers all."""
    found = broken_references(raw, _raw_references(), null_is_key=True)
    listed = [(F.lit(name), F.col(f"`orphans {name}`")) for name, *_ in RELATIONS]
    return rows_of(found, ("relation", "orphan_rows"), listed)


def orphan_order_sample(raw: Raw, rows: int = 3) -> DataFrame:
    """A few orders without a customer, for the eye."""
    orphans = orphan_counts(raw["orders"], raw["customers"], "customer_id", "order_id")
    return orphans.select("order_id").distinct().orderBy("order_id").limit(rows)


def _date_measures(as_of: Column | None) -> dict[str, Column]:
    as_of = F.localtimestamp() if as_of is None else as_of
    bought, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    delivered, estimated = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    return {
        "min_purchase": F.min(bought),
        "max_purchase": F.max(bought),
        "future_orders": F.count_if(bought > as_of),
        "delivered_before_purchase": F.count_if(delivered < bought),
        "approved_before_purchase": F.count_if(approved < bought),
        "estimated_on_purchase_day": F.count_if(F.to_date(estimated) == F.to_date(bought)),
    }


def date_consistency(raw: Raw, as_of: Column | None = None) -> DataFrame:
    """Date range and impossible dates of the orders in one scan. ``as_of`` (default: now) decides what is future."""
    metrics = _date_measures(as_of)
    texts = {name: second_text(m) if name in ("min_purchase", "max_purchase") else m.cast("string") for name, m in metrics.items()}
    one_row = raw["orders"].agg(*[m.alias(name) for name, m in texts.items()])
    return rows_of(one_row, ("metric", "value"), [(F.lit(name), F.col(name)) for name in metrics])


def orders_without_payment(raw: Raw) -> DataFrame:
    """Order rows without any payment row, by status."""
    orphans = orphan_counts(raw["orders"], raw["payments"], "order_id", "order_status")
    return orphans.groupBy("order_status").agg(F.sum("n").alias("n"))


def payment_outliers(raw: Raw) -> DataFrame:
    """All payments above three times the 99th percentile."""
    threshold = quantile_row(raw["payments"], {"p99": ("payment_value", 0.99)})
    return (
        with_row(raw["payments"], threshold)
        .filter(F.col("payment_value") > F.col("p99") * EXTREME_FACTOR)
        .select("order_id", "payment_sequential", "payment_type", "payment_value", "p99")
    )


def non_positive_payments(raw: Raw) -> DataFrame:
    return raw["payments"].agg(F.count_if(F.col("payment_value") <= 0).alias("non_positive_payments"))


ORPHAN_REVIEWS = Reference("orphan_reviews", "reviews", "order_id", "orders", "order_id")


def _review_rows(found: DataFrame) -> DataFrame:
    metrics = {
        "orphan_reviews": "orphans orphan_reviews",
        "multi_review_orders": "repeats reviews.order_id",
        "max_reviews_per_order": "most reviews.order_id",
    }
    return rows_of(found, ("metric", "value"), [(F.lit(name), F.col(f"`{c}`")) for name, c in metrics.items()])


def review_quality(raw: Raw) -> DataFrame:
    """Reviews of unknown orders, and orders with several reviews, from one aggregate by order."""
    return _review_rows(broken_references(raw, [ORPHAN_REVIEWS], repeated=[("reviews", "order_id")], null_is_key=True))


def _product_measures() -> dict[str, Column]:
    return {
        "total": F.count(F.lit(1)),
        "categories": F.count_distinct(F.col("product_category_name")),
        "all_dims_missing": F.count_if(all_null(PRODUCT_DIMENSIONS)),
    }


def product_quality(raw: Raw) -> DataFrame:
    one_row = raw["products"].agg(*[m.alias(name) for name, m in _product_measures().items()])
    return rows_of(one_row, ("metric", "value"), [(F.lit(name), F.col(name)) for name in one_row.columns])


def pk_violations(tables: Raw) -> DataFrame:
    """Per declared key: how many key values occur more than once."""
    checks = []
    for table, key in PRIMARY_KEYS:
        # The time dimension has a second unique column besides its key.
        label = f"{table}({key[0]})" if (table, key) == ("dim_time", ("date",)) else table
        repeated = tables[table].groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        checks.append(
            repeated.agg(F.count(F.lit(1)).alias("duplicate_keys")).select(F.lit(label).alias("table_name"), "duplicate_keys")
        )
    return stack(checks)


def constraint_report(tables: Raw) -> DataFrame:
    """Violations of the declared NOT NULLs and references (a null reference is no violation), from one shuffle."""
    references = [Reference(f"{t}.{c}", t, c, parent, c) for t, c, parent in FOREIGN_KEYS]
    found = broken_references(tables, references, NOT_NULL)
    rows = [(t, f"not null {c}", f"nulls {t}.{c}") for t, c in NOT_NULL]
    rows += [(t, f"{c} references {parent}", f"orphans {t}.{c}") for t, c, parent in FOREIGN_KEYS]
    names = ("table_name", "constraint", "violations")
    return rows_of(found, names, [(F.lit(t), F.lit(label), F.col(f"`{c}`")) for t, label, c in rows])


def _table_facts(raw: Raw, table: str, as_of: Column | None) -> DataFrame:
    """(check, table_name, column_name, metric, value) of everything that one aggregate over a table can tell."""
    df = raw[table]
    measures = null_measures(df.columns)
    facts = [
        ("nulls", c, metric, F.when(missing > 0, value))
        for c, missing, share, high in null_facts(df.columns)
        for metric, value in (("null_count", missing), ("null_pct", share), ("high_null", high))
    ]
    kept = len(facts)
    if table == "orders":
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        for name, m in _date_measures(as_of).items():
            measures.append(m.alias(name))
            day = F.timestamp_diff("SECOND", epoch, F.col(name)) / F.lit(86_400.0)
            facts.append(("dates", None, name, day if name in ("min_purchase", "max_purchase") else F.col(name)))
    elif table == "products":
        for name, m in _product_measures().items():
            measures.append(m.alias(name))
            facts.append(("products", None, name, F.col(name)))
    elif table == "payments":
        # One set of located ranks serves the summary and the threshold of extreme payments.
        ranks = {f"_{n}_{c}": (c, p) for c in NUMERIC_PAYMENT_COLUMNS for n, p in QUARTILES.items()}
        df = with_row(df, quantile_row(df, ranks | {"_p99": ("payment_value", 0.99)}))
        for c in NUMERIC_PAYMENT_COLUMNS:
            measures += [make(F.col(c)).alias(f"_{n}_{c}") for n, make in profile.SUMMARY.items()]
            measures += [F.max(f"_{n}_{c}").alias(f"_{n}_{c}") for n in QUARTILES]
            facts += [("numeric summary", c, n, F.col(f"_{n}_{c}")) for n in ("count", "mean", "std", "min", *QUARTILES, "max")]
        value = F.col("payment_value")
        for name, holds in (("non_positive", value <= 0), ("extreme", value > F.col("_p99") * EXTREME_FACTOR)):
            measures.append(F.count_if(holds).alias(f"{name}_payments"))
            facts.append(("payments", "payment_value", f"{name}_payments", F.col(f"{name}_payments")))
    text = F.lit(None).cast("string")
    rows = [
        (F.lit(check), F.lit(table), text if c is None else F.lit(c), F.lit(metric), v.cast("double"), F.lit(i >= kept))
        for i, (check, c, metric, v) in enumerate(facts)
    ]
    listed = rows_of(df.agg(*measures), (*REPORT, "_always"), rows)
    # Columns without nulls are not listed; every other finding is, even where it has no value.
    return listed.filter(F.col("_always") | F.col("value").isNotNull()).drop("_always")


REPORT = ("check", "table_name", "column_name", "metric", "value")


def quality_report(raw: Raw, as_of: Column | None = None) -> DataFrame:
    """Every raw-table check in one shape: (check, table_name, column_name, metric, value).

    Dates appear as days since 1970-01-01 with the time of day as the fraction. All checks that are sums over a table come
    out of one aggregate per table, all references out of one shuffle; the rest groups by whole rows or by a column.
    """
    none = F.lit(None).cast("string")

    def shape(df: DataFrame, *columns: Column) -> DataFrame:
        return df.select(*[c.cast("double" if n == "value" else "string").alias(n) for n, c in zip(REPORT, columns)])

    table, column = F.col("table_name"), F.col("column_name")
    copies = duplicate_check(raw).unpivot(
        ["table_name", "key_column"], ["full_row_duplicates", "key_duplicates"], "metric", "value"
    )
    references = broken_references(
        raw, [*_raw_references(), ORPHAN_REVIEWS], repeated=[("reviews", "order_id")], null_is_key=True
    )
    names = [("references", None, name, f"orphans {name}") for name, *_ in RELATIONS]
    names += [
        ("reviews", "reviews", "orphan_reviews", "orphans orphan_reviews"),
        ("reviews", "reviews", "multi_review_orders", "repeats reviews.order_id"),
        ("reviews", "reviews", "max_reviews_per_order", "most reviews.order_id"),
    ]
    found = rows_of(
        references,
        REPORT,
        [
            (F.lit(check), none if t is None else F.lit(t), none, F.lit(metric), F.col(f"`{c}`").cast("double"))
            for check, t, metric, c in names
        ],
    )
    parts = [
        *[_table_facts(raw, t, as_of) for t in CHECKED_KEYS],
        shape(copies, F.lit("duplicates"), table, F.col("key_column"), F.col("metric"), F.col("value")),
        shape(value_checks(raw), F.lit("distinct values"), table, column, F.lit("distinct_values"), F.col("distinct_values")),
        shape(value_counts(raw), F.lit("value counts"), table, column, F.col("value"), F.col("n")),
        found,
        shape(
            orders_without_payment(raw), F.lit("orders without payment"), F.lit("orders"), F.lit("order_status"),
            F.col("order_status"), F.col("n"),
        ),
    ]
    return stack(parts)
