"""Profiles of any table: nulls, duplicates, frequencies, descriptive statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import digestible, row_digest
from .quantiles import quantile_row, with_row

HIGH_NULL_PERCENT = 20.0


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def rows_of(one_row: DataFrame, names: Sequence[str], rows: Sequence[Sequence[Column]]) -> DataFrame:
    """Turn a one-row aggregate into several rows of the given columns, without a second scan."""
    return one_row.select(
        F.inline(F.array(*[F.struct(*[c.alias(n) for n, c in zip(names, row)]) for row in rows]))
    )


def row_count(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("col_count")
    )


def null_measures(columns: Sequence[str]) -> list[Column]:
    """Aggregates that count rows and values, for `null_facts` to read; they go into any other aggregate of the table."""
    return [F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"_known_{i}") for i, c in enumerate(columns)]]


def null_facts(columns: Sequence[str]) -> list[tuple[str, Column, Column, Column]]:
    """(column, null_count, null_pct, high_null) over a row of `null_measures`; percentages have two digits, half-even."""
    facts = []
    for i, c in enumerate(columns):
        missing = F.col("_rows") - F.col(f"_known_{i}")
        share = F.bround(F.try_divide(missing * F.lit(100.0), F.col("_rows")), 2)
        facts.append((c, missing, share, (share >= HIGH_NULL_PERCENT).cast("int")))
    return facts


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """Columns with nulls, their count, percentage and the high-share flag; one scan."""
    names = ("table_name", "column_name", "null_count", "null_pct", "high_null")
    listed = [(F.lit(table), F.lit(c), *facts) for c, *facts in null_facts(df.columns)]
    return rows_of(df.agg(*null_measures(df.columns)), names, listed).filter("null_count > 0")


def _key_copies(df: DataFrame, key: str) -> DataFrame:
    """Per key: its rows and its distinct rows. Rows meet by the key and 16 bytes that stand for all other columns.

    Equal rows collapse in the map tasks, and no other column is shuffled, however wide the table. Columns that have no
    digest (nested ones) are grouped by as they are.
    """
    rest = [(c, kind) for c, kind in df.dtypes if c != key]
    told = [(c, kind) for c, kind in rest if digestible(kind)]
    digest = [row_digest(told)[part].alias(name) for part, name in (("one", "_row"), ("two", "_row_again"))] if told else []
    rows = df.select(key, *digest, *[c for c, kind in rest if not digestible(kind)])
    distinct_rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    return distinct_rows.groupBy(key).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("different"))


def duplicate_check(df: DataFrame, table: str, key: str) -> DataFrame:
    """Full-row and key duplicates; nulls are equal to each other. Rows count as equal by key and two 64-bit hashes."""
    return (
        _key_copies(df, key)
        .agg(
            F.coalesce(F.sum(F.col("n") - F.col("different")), F.lit(0)).alias("full_row_duplicates"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("key_duplicates"),
        )
        .select(
            F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), "full_row_duplicates", "key_duplicates"
        )
    )


def duplicate_keys(df: DataFrame, table: str, key: str, top: int = 5) -> DataFrame:
    """The most repeated keys, for the eye."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).cast("string").alias("key_value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .orderBy(F.desc("n"), "key_value")
        .limit(top)
        .select(F.lit(table).alias("table_name"), "key_value", "n")
    )


def _frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, counted over the same frequencies that value_counts lists."""
    return stack(
        [
            _frequencies(df, c).agg(F.count("value").alias("distinct_values")).select(
                F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), "distinct_values"
            )
            for c in columns
        ]
    )


def value_counts(df: DataFrame, table: str, column: str, top: int | None = 10) -> DataFrame:
    """Frequencies, most frequent first (then by value, null last); null is a value of its own."""
    counted = _frequencies(df, column).orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return (counted if top is None else counted.limit(top)).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "value", "n"
    )


SUMMARY = {
    "count": F.count,
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": lambda c: F.min(c).cast("double"),
    "max": lambda c: F.max(c).cast("double"),
}


def describe(
    df: DataFrame, columns: Sequence[str], percentiles: Mapping[str, float], extra: Mapping[str, object] | None = None
) -> DataFrame:
    """One row per column: count, mean, std (sample), min, the named percentiles, max, and ``extra`` aggregates.

    ``extra`` maps an output name to a function from a column to an aggregate expression.
    """
    extra = extra or {}
    parts = SUMMARY | extra
    summary = df.agg(
        *[make(F.col(c)).alias(f"_{i}_{name}") for i, c in enumerate(columns) for name, make in parts.items()]
    )
    ranked = quantile_row(df, {f"_{i}_{n}": (c, p) for i, c in enumerate(columns) for n, p in percentiles.items()})
    names = ("count", "mean", "std", "min", *percentiles, "max", *extra)
    return rows_of(
        with_row(summary, ranked),
        ("column_name", *names),
        [(F.lit(c), *[F.col(f"_{i}_{name}") for name in names]) for i, c in enumerate(columns)],
    )
