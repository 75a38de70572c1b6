"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they agree after every run of white space became one space; a null text is the empty text. One
scan turns each text into a narrow fingerprint (a few dozen bytes), and only fingerprints are shuffled. Rows whose
length nobody shares never reach the prefix level, rows whose prefix nobody shares never reach the grouping by full
hash. The full hash of a row is taken while its text is in hand in that one scan, because its digest is part of the
result for every row and a second pass over the texts would cost more than hashing; it *decides* only for survivors.

Defined cases: of equal texts the smallest id stays, null ids count as larger than any other; of repeated rows with one
id and one text a single row is kept; empty tables give empty results; further columns are ignored by `decisions` and
carried along by `keep_first_copies`.

Every grouping is a count or a minimum, so a group of any size is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import SPACE, first_of, staged, text_or_empty

PREFIX_CHARS = 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS):
    """(id, length, prefix_hash, full_hash) of every row."""
    texts = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    return texts.select(
        "id",
        F.char_length("norm").alias("length"),
        F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix_hash"),
        F.sha2("norm", 256).alias("full_hash"),
    )


def refine(prints: DataFrame) -> DataFrame:
    """Groups of at least two equal texts: (length, prefix_hash, full_hash, keep_id, group_size)."""

    def shared(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("copies").alias("n")).filter("n > 1").select(*keys)

    by_length = prints.join(shared(prints, "length"), ["length"], "left_semi")
    by_prefix = by_length.join(shared(by_length, "length", "prefix_hash"), ["length", "prefix_hash"], "left_semi")
    return (
        by_prefix.groupBy("length", "prefix_hash", "full_hash")
        .agg(F.min("id").alias("keep_id"), F.sum("copies").alias("group_size"))
        .filter("group_size > 1")
    )


def decisions(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """One row per row of `docs`: (id, keep_id, group_size, kept, text_sha256); `id` keeps the name `id_col`."""
    prints = staged(fingerprints(docs, id_col, text_col, prefix_chars), "exact-dedup")
    keys = ["length", "prefix_hash", "full_hash"]
    rows = prints.groupBy("id", *keys).agg(F.count(F.lit(1)).alias("copies"))
    judged = rows.join(refine(rows), keys, "left").select(
        "id",
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        "full_hash",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    )
    return judged.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("full_hash").alias("text_sha256"),
    )


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, all columns as they are.

    The texts are shuffled once, by a key that is unique up to repeated rows, so copies of one text spread evenly. Rows
    that share id and text but differ elsewhere become the one whose columns hash lowest.
    """
    key = F.concat_ws("|", F.col("digest"), F.coalesce(F.col("row_id").cast("string"), F.lit("null")))
    kept = (
        decisions(docs, id_col, text_col)
        .filter("kept")
        .select(F.col("text_sha256").alias("digest"), F.col(id_col).alias("row_id"))
        .select(key.alias("copy_key"))
    )
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
        F.col(id_col).alias("row_id"),
        F.sha2(normalised(F.col(text_col)), 256).alias("digest"),
    ).select("whole", key.alias("copy_key"))
    return first_of(packed.join(kept, ["copy_key"], "left_semi"), "copy_key").select("whole.*")
