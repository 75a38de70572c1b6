"""Exact, linearly interpolated quantiles of large columns.

Spark's ``percentile`` gathers every distinct value of a group in one task. Here the wanted ranks are located by
counting instead: first per coarse bucket, then per fine bucket inside the few coarse buckets that hold a wanted rank,
then per value inside those. Every pass is a narrow scan with map-side counting, and what one task has to order is
bounded by the number of buckets per level (at most a few million), whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# log2 of a positive double lies in [-1074, 1024]; shifted to be positive and split twice.
_LOG_SHIFT = 1_100
_FINE_BITS = 31
_COARSE_FROM_FINE = 21


def _levels(value: Column, whole_numbers: bool) -> list[Column]:
    """Bucket numbers that never decrease with the value, coarse to fine."""
    if whole_numbers:
        return [F.shiftright(value, 16)]
    size = F.abs(value)
    fine = F.floor((F.log2(size) + _LOG_SHIFT) * float(2**_FINE_BITS))
    sign = F.signum(value).cast("bigint")
    return [
        F.coalesce(sign * F.shiftright(fine, _COARSE_FROM_FINE), F.lit(0)),
        F.coalesce(sign * fine, F.lit(0)),
    ]


def _rows(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """(column_name, v, bucket numbers) of every value, and the names of the levels, the value itself last."""
    kinds = {f.name: f.dataType for f in df.schema}
    whole = all(isinstance(kinds[c], (T.IntegerType, T.ShortType, T.ByteType)) for c in columns)
    kind = "int" if whole else "double"
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("v")) for c in columns])
    rows = (
        df.select(F.col(columns[0]).cast(kind).alias("v")).withColumn("column_name", F.lit(columns[0]))
        if len(columns) == 1
        else df.select(F.inline(pairs))
    )
    rows = rows.filter(F.col("v").isNotNull() if whole else F.col("v").isNotNull() & ~F.isnan("v"))
    level_columns = _levels(F.col("v"), whole)
    names = [f"_k{i}" for i in range(len(level_columns))]
    return rows.select("column_name", "v", *[c.alias(n) for n, c in zip(names, level_columns)]), [*names, "v"]


def _targets(probabilities: Iterable[float], total: Column) -> Column:
    """The two ranks around every wanted position among ``total`` values, as structs (p, side, part, rank)."""
    last = total - 1
    return F.array(
        *[
            F.struct(
                F.lit(p).alias("p"),
                F.lit(side).alias("side"),
                (F.lit(p) * last - F.floor(F.lit(p) * last)).alias("part"),
                (F.floor(F.lit(p) * last) if side == 0 else F.ceil(F.lit(p) * last)).alias("rank"),
            )
            for p in dict.fromkeys(map(float, probabilities))
            for side in (0, 1)
        ]
    )


def _located(
    rows: DataFrame,
    names: Sequence[str],
    probabilities: Sequence[float],
    lowest: DataFrame | None = None,
    carry: Sequence[str] = (),
    sums: bool = False,
) -> DataFrame:
    """The values that hold a wanted rank, with the ranks [_from, _to) they cover in their column and their targets.

    Level by level, rows are counted per bucket inside the buckets that hold a wanted rank, and running counts from the
    bucket's own start give the ranks. What a level knows of a bucket are numbers alone (where it starts, how many values
    there are in all), so the next level needs its input and this one exactly once.

    ``lowest`` is a one-row frame with ``_total``: ranks are then wanted among that many lowest values, and its columns
    ``carry`` stay with the result. With ``sums`` the sum of all values up to each one comes along as ``_sum_to``, and the
    smallest value of the column as ``_least``.
    """
    outer: list[str] = ["column_name"]
    known = ["_from", "_total", *carry, *(["_sum_from", "_least"] if sums else [])]
    located = None
    for level in names:
        inside = rows if located is None else rows.join(F.broadcast(located), outer)
        measures = [F.count(F.lit(1)).alias("_n")]
        if sums:
            measures.append(F.sum(F.col("v").cast("double")).alias("_s"))
        if located is not None:
            measures += [F.max(c).alias(c) for c in known]
        elif sums:
            measures.append(F.min(F.col("v").cast("double")).alias("_least"))
        counts = inside.groupBy(*outer, level).agg(*measures)
        order = Window.partitionBy(*outer).orderBy(level).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if located is None:
            counts = counts.withColumn("_from", F.lit(0).cast("bigint"))
            if sums:
                whole = Window.partitionBy(*outer)
                counts = counts.withColumn("_sum_from", F.lit(0.0)).withColumn("_least", F.min("_least").over(whole))
            if lowest is None:
                counts = counts.withColumn("_total", F.sum("_n").over(Window.partitionBy(*outer)))
            else:
                counts = with_row(counts, lowest.select("_total", *carry))
        counts = counts.withColumn("_to", F.col("_from") + F.sum("_n").over(order)).withColumn("_from", F.col("_to") - F.col("_n"))
        if sums:
            counts = counts.withColumn("_sum_to", F.col("_sum_from") + F.sum("_s").over(order)).withColumn(
                "_sum_from", F.col("_sum_to") - F.col("_s")
            )
        held = F.filter(
            _targets(probabilities, F.col("_total")), lambda t: (t["rank"] >= F.col("_from")) & (t["rank"] < F.col("_to"))
        )
        found = counts.withColumn("_held", held).filter(F.size("_held") > 0)
        outer = [*outer, level]
        located = found if level == names[-1] else found.select(*outer, *known)
    return located


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Iterable[float]) -> DataFrame:
    """Rows (column_name, p, value) for every column with a value; nulls and NaN are ignored."""
    rows, names = _rows(df, columns)
    found = _located(rows, names, list(probabilities)).select("column_name", "v", F.inline("_held"))
    low = F.max(F.when(F.col("side") == 0, F.col("v")))
    high = F.max(F.when(F.col("side") == 1, F.col("v")))
    return found.groupBy("column_name", "p").agg((low + (high - low) * F.max("part")).alias("value"))


def capped_summary(
    df: DataFrame, column: str, cap: float, wanted: Mapping[str, float] | None = None
) -> DataFrame:
    """One row about the values up to their quantile ``cap``: (cap, count, mean, min, max), and a column per ``wanted``
    quantile of those values, ``{alias: p}``. Null where there is no value.

    The values up to the cap are the lowest ranks of the same column, so their number, sum and largest one are read off
    the buckets that locate the cap, and their quantiles are ranks among that many lowest values: the input is read once
    per level for the cap and once per level for the rest.
    """
    rows, names = _rows(df, [column])
    at_cap = _located(rows, names, [cap], sums=True)
    sides = at_cap.select("v", "_to", "_sum_to", "_least", F.inline("_held"))
    low, high = (
        F.max(F.when(F.col("side") == side, F.struct("v", "_to", "_sum_to"))).alias(name)
        for side, name in ((0, "_low"), (1, "_high"))
    )
    limit = F.col("_low.v") + (F.col("_high.v") - F.col("_low.v")) * F.col("_part")
    # Between two values the cap keeps the lower one; on the upper one (also by rounding) it keeps both.
    kept = F.when(F.col("cap") >= F.col("_high.v"), F.col("_high")).otherwise(F.col("_low"))
    row = (
        sides.agg(low, high, F.max("part").alias("_part"), F.min("_least").alias("min"))
        .withColumn("cap", limit)
        .withColumn("_kept", kept)
        .select(
            "cap",
            F.coalesce(F.col("_kept._to"), F.lit(0)).cast("bigint").alias("count"),
            F.try_divide(F.col("_kept._sum_to"), F.col("_kept._to").cast("double")).alias("mean"),
            "min",
            F.col("_kept.v").alias("max"),
        )
    )
    if not wanted:
        return row
    facts = ("cap", "count", "mean", "min", "max")
    lowest = row.withColumn("_total", F.col("count"))
    held = _located(rows, names, list(wanted.values()), lowest, facts).select("v", *facts, F.inline("_held"))

    def interpolated(p: float) -> Column:
        one, two = (F.max(F.when((F.col("p") == float(p)) & (F.col("side") == side), F.col("v"))) for side in (0, 1))
        return one + (two - one) * F.max(F.when(F.col("p") == float(p), F.col("part")))

    return held.agg(
        F.max("cap").alias("cap"),
        F.coalesce(F.max("count"), F.lit(0)).cast("bigint").alias("count"),
        *[F.max(c).alias(c) for c in ("mean", "min", "max")],
        *[interpolated(p).alias(alias) for alias, p in wanted.items()],
    )


def quantile_row(df: DataFrame, wanted: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Always exactly one row: ``{alias: (column, p)}`` becomes one column per alias, null where there is no value."""
    columns = list(dict.fromkeys(column for column, _ in wanted.values()))
    found = quantiles(df, columns, [p for _, p in wanted.values()])
    return found.agg(
        *[
            F.max(F.when((F.col("column_name") == column) & (F.col("p") == float(p)), F.col("value"))).alias(alias)
            for alias, (column, p) in wanted.items()
        ]
    )


def with_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row frame (thresholds, medians) to every row without leaving the executors."""
    return df.crossJoin(F.broadcast(one_row))
