"""Keep the first row of every key under a declared order; rows that no other row equals need no shuffle for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import digestible, row_digest

HASH_BITS = 40  # what a row sends to find the hashes that come again
TABLE_BITS = 1 << 26  # at most 2^HASH_BITS; 8 MB
CHUNK_BITS = 1 << 15  # bits per row of bitmap_construct_agg


def keep_first(
    df: DataFrame,
    key: str,
    order: Sequence[str] = (),
    nulls_last: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """One row per ``key``: the smallest by ``order``, then by all remaining columns in table order.

    Nulls come first unless the column is in ``nulls_last``. ``copies`` names an extra column with the number of rows
    the key had. Spark tables have no file order, so the order is part of the rule.

    The row travels as one struct through ``min``: every map task already reduces a key to a single row, so a key
    that holds a large share of the table sends one row per task, and the planner knows the result is unique per key.
    """
    ranked = [*order, *(c for c in df.columns if c != key and c not in order)]
    fields = []
    for name in ranked:
        if name in nulls_last:
            fields.append(F.col(name).isNull().alias(f"_no_{name}"))
        fields.append(F.col(name))
    aggregates = [F.min(F.struct(*fields)).alias("_first")]
    if copies:
        aggregates.append(F.count(F.lit(1)).alias(copies))
    kept = df.groupBy(key).agg(*aggregates)
    columns = [F.col(key) if c == key else F.col("_first")[c].alias(c) for c in df.columns]
    return kept.select(*columns, *([copies] if copies else []))


def apart(df: DataFrame, hashed: Column) -> tuple[DataFrame, DataFrame]:
    """(alone, others): rows that share the 64-bit ``hashed`` with no other row, and all the others with perhaps a few more.

    Equal keys must have equal hashes, so all rows of a key with several rows are among the others. Instead of the rows,
    ``HASH_BITS`` of each are shuffled to find the hashes that come again. These set bits in a table of one size whatever
    the rows, which is broadcast; hashes that share a bit only bring more rows to the others.
    """
    short = hashed.bitwiseAND(F.lit((1 << HASH_BITS) - 1).cast("long"))
    again = df.select(short.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    at = short.bitwiseAND(F.lit(TABLE_BITS - 1).cast("long"))
    place = F.col("_h").bitwiseAND(F.lit(TABLE_BITS - 1).cast("long"))
    chunk = F.lit(CHUNK_BITS).cast("long")
    table = (
        again.select(F.call_function("div", place, chunk).alias("_chunk"), (place % chunk).alias("_bit"))
        .groupBy("_chunk")
        .agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    )
    byte = F.col("_bits").substr((F.col("_at") % chunk / 8).cast("int") + 1, F.lit(1))
    mask = F.call_function("shiftleft", F.lit(1), (F.col("_at") % 8).cast("int"))
    marked = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(mask) != 0
    rows = (
        df.withColumn("_at", at)
        .withColumn("_chunk", F.call_function("div", F.col("_at"), chunk))
        .join(F.broadcast(table), "_chunk", "left")
        .withColumn("_marked", F.coalesce(marked, F.lit(False)))
    )
    return rows.filter(~F.col("_marked")).select(df.columns), rows.filter("_marked").select(df.columns)


def keep_first_apart(
    df: DataFrame, key: str, order: Sequence[str] = (), nulls_last: Sequence[str] = ()
) -> DataFrame:
    """The rows of ``keep_first``; only keys that may have several rows are shuffled. Reads ``df`` three times."""
    alone, others = apart(df, F.xxhash64(key, F.col(key).isNull()))
    return keep_first(others, key, order, nulls_last).unionByName(alone)


def distinct_apart(df: DataFrame) -> DataFrame:
    """The rows of ``distinct``; only rows that may come again are shuffled. Reads ``df`` three times."""
    if not all(digestible(kind) for _, kind in df.dtypes):
        return df.distinct()
    alone, others = apart(df, row_digest(df.dtypes)["one"])
    # As a grouping does: one zero.
    zeros = {c: F.when(F.col(c) == 0, F.lit(0).cast(kind)).otherwise(F.col(c)) for c, kind in df.dtypes if kind in ("float", "double")}
    return others.distinct().unionByName(alone.withColumns(zeros) if zeros else alone)
