"""Equal-width histograms with all bins listed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import with_row


def histogram(df: DataFrame, column: str, bins: int = 60, span: tuple[str, str] | None = None) -> DataFrame:
    """Rows (bin_no, lo, hi, n): half-open bins over [min, max], the last one closed; empty bins count 0.

    A single value widens the range by half on both sides; no value at all gives the range 0 to 1. ``span`` names two
    columns that hold the smallest and the largest value in every row, where they are known already.
    """
    least, most = span or ("_least", "_most")
    values = df.filter(F.col(column).isNotNull()).withColumn("x", F.col(column).cast("double"))
    if span is None:
        values = with_row(values.select("x"), values.agg(F.min("x").alias(least), F.max("x").alias(most)))
    single = F.col(least) == F.col(most)
    values = values.select(
        "x",
        F.when(single, F.col(least) - 0.5).otherwise(F.col(least)).alias("first"),
        F.when(single, F.col(most) + 0.5).otherwise(F.col(most)).alias("last"),
    )
    step = (F.col("last") - F.col("first")) / F.lit(bins)

    def edge(i):
        return F.when(i == bins, F.col("last")).otherwise(F.col("first") + i * step)

    # The division may land one bin off at an edge; the edges themselves decide.
    guess = F.least(F.floor((F.col("x") - F.col("first")) / step), F.lit(bins - 1)).cast("int")
    placed = values.withColumn("i", guess).select(
        "first",
        "last",
        F.when((F.col("i") > 0) & (F.col("x") < edge(F.col("i"))), F.col("i") - 1)
        .when((F.col("i") < bins - 1) & (F.col("x") >= edge(F.col("i") + 1)), F.col("i") + 1)
        .otherwise(F.col("i"))
        .alias("i"),
    )
    counts = placed.groupBy("first", "last", "i").agg(F.count(F.lit(1)).alias("n"))
    # At most one row per bin comes together in one row, which then lists all bins.
    whole = counts.agg(
        F.coalesce(F.max("first"), F.lit(0.0)).alias("first"),
        F.coalesce(F.max("last"), F.lit(1.0)).alias("last"),
        F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("counted"),
    )
    return whole.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).select(
        (F.col("i") + 1).alias("bin_no"),
        edge(F.col("i")).alias("lo"),
        edge(F.col("i") + 1).alias("hi"),
        F.coalesce(F.try_element_at("counted", F.col("i")), F.lit(0)).cast("bigint").alias("n"),
    )
