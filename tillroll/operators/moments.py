"""Weighted co-moments of pairs of columns, and what follows from them: correlations, Pearson's test, the pooled t-test.

Rows may carry a whole-number weight, the number of equal rows they stand for, so copies never have to be written out.
Rows are reduced per weight by Spark's own aggregates, which centre as they go and merge in the map tasks; the few
weights that occur are then merged by the parallel-axis rule. Nothing is a difference of large sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import clip, strength_label
from ..functions.statistics import t_of_r, t_tail

Pair = tuple[str, str]


def _weight(weight: str | None) -> Column:
    return F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")


def co_moments(df: DataFrame, pairs: Sequence[Pair], weight: str | None = None) -> DataFrame:
    """Always one row: per pair number i the columns n, mx, my, cxx, cyy, cxy (as ``n_i`` and so on), the weighted count,
    means and centred sums over the rows where both columns are present, and ``constant_i``, true if one of the two has
    a single value. Rows of weight null or below 1 stand for nothing."""
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    rows = df.select(_weight(weight).alias("_w"), *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    at = {c: f"_{i}" for i, c in enumerate(columns)}
    measures = []
    for i, (x, y) in enumerate(pairs):
        x, y = F.col(at[x]), F.col(at[y])
        both = x.isNotNull() & y.isNotNull()
        px, py = F.when(both, x), F.when(both, y)
        n = F.count(px)
        measures += [
            n.alias(f"n_{i}"),
            F.avg(px).alias(f"mx_{i}"),
            F.avg(py).alias(f"my_{i}"),
            (F.var_pop(px) * n).alias(f"cxx_{i}"),
            (F.var_pop(py) * n).alias(f"cyy_{i}"),
            (F.covar_pop(px, py) * n).alias(f"cxy_{i}"),
            F.min(px).alias(f"lx_{i}"),
            F.max(px).alias(f"hx_{i}"),
            F.min(py).alias(f"ly_{i}"),
            F.max(py).alias(f"hy_{i}"),
        ]
    per_weight = rows.filter(F.col("_w") > 0).groupBy("_w").agg(*measures)
    # One row per weight that occurs; their means come first, then everything is centred on them.
    whole = Window.partitionBy()
    mass = {i: F.col("_w") * F.col(f"n_{i}") for i in range(len(pairs))}
    means = {
        f"g{v}_{i}": F.try_divide(F.sum(mass[i] * F.col(f"m{v}_{i}")).over(whole), F.sum(mass[i]).over(whole).cast("double"))
        for i in range(len(pairs))
        for v in "xy"
    }
    centred = per_weight.withColumns(means)

    def merged(i: int, a: str, b: str) -> Column:
        shift = mass[i] * (F.col(f"m{a}_{i}") - F.col(f"g{a}_{i}")) * (F.col(f"m{b}_{i}") - F.col(f"g{b}_{i}"))
        return F.sum(F.col("_w") * F.col(f"c{a}{b}_{i}") + shift)

    out = []
    for i in range(len(pairs)):
        single = (F.min(f"lx_{i}") == F.max(f"hx_{i}")) | (F.min(f"ly_{i}") == F.max(f"hy_{i}"))
        out += [
            F.coalesce(F.sum(mass[i]), F.lit(0)).cast("bigint").alias(f"n_{i}"),
            F.max(f"gx_{i}").alias(f"mx_{i}"),
            F.max(f"gy_{i}").alias(f"my_{i}"),
            merged(i, "x", "x").alias(f"cxx_{i}"),
            merged(i, "y", "y").alias(f"cyy_{i}"),
            merged(i, "x", "y").alias(f"cxy_{i}"),
            single.alias(f"constant_{i}"),
        ]
    return centred.agg(*out)


def correlation(i: int) -> Column:
    """Pearson's r of pair i of ``co_moments``; null if either column is constant or has fewer than two values."""
    scale = F.sqrt(F.col(f"cxx_{i}")) * F.sqrt(F.col(f"cyy_{i}"))
    r = F.try_divide(F.col(f"cxy_{i}"), scale)
    return F.when(~F.col(f"constant_{i}"), clip(r, F.lit(-1.0), F.lit(1.0)))


def correlations(df: DataFrame, pairs: Sequence[Pair], weight: str | None = None) -> DataFrame:
    """One row (col_x, col_y, n, corr) per pair, all from one aggregate."""
    listed = [
        F.struct(F.lit(x).alias("col_x"), F.lit(y).alias("col_y"), F.col(f"n_{i}").alias("n"), correlation(i).alias("corr"))
        for i, (x, y) in enumerate(pairs)
    ]
    return co_moments(df, pairs, weight).select(F.inline(F.array(*listed)))


def correlation_matrix(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Long form (col_x, col_y, corr) of the full square; each pair uses the rows where both are present."""
    pairs = [*combinations(columns, 2), *((c, c) for c in columns)]
    found = {pair: correlation(i) for i, pair in enumerate(pairs)}
    listed = []
    for x in columns:
        for y in columns:
            # A column correlates with itself unless it is constant or has fewer than two values.
            r = F.when(found[x, x].isNotNull(), F.lit(1.0)) if x == y else found.get((x, y), found.get((y, x)))
            listed.append(F.struct(F.lit(x).alias("col_x"), F.lit(y).alias("col_y"), r.alias("corr")))
    return co_moments(df, pairs, weight).select(F.inline(F.array(*listed)))


def pearson(df: DataFrame, x: str, y: str, weight: str | None = None, min_rows: int = 2) -> DataFrame:
    """Pearson's r of two columns with its two-sided p and words: (r, n, p_value, strength, direction).

    No row for ``min_rows`` rows or fewer; r and p are null where a column is constant.
    """
    r, n = F.col("r"), F.col("n")
    return (
        co_moments(df, [(x, y)], weight)
        .select(F.col("n_0").alias("n"), correlation(0).alias("r"))
        .filter(n > min_rows)
        .withColumn("p_value", F.when(F.abs(r) >= 1, 0.0).otherwise(t_tail(t_of_r(r, n), n - 2)))
        .select(
            "r",
            "n",
            "p_value",
            strength_label(r).alias("strength"),
            F.when(r < 0, "negative").when(r >= 0, "positive").alias("direction"),
        )
    )


def pooled_t(
    df: DataFrame,
    value: str,
    group: str,
    weight: str | None = None,
    names: tuple[str, str] = ("a", "b"),
    min_group: int = 1,
    alpha: float = 0.05,
) -> DataFrame:
    """Student's t-test with equal variances of ``value`` between the rows with ``group`` 0 and 1.

    One row (mean_a, n_a, mean_b, n_b, t_stat, df, p_value, significant), a for 0 and b for 1; no row unless both groups
    have more than ``min_group`` rows. The statistic is null where no value varies.
    """
    first, second = names
    sides = df.select(
        _weight(weight).alias("_w"),
        F.when(F.col(group) == 0, F.col(value)).alias("_a"),
        F.when(F.col(group) == 1, F.col(value)).alias("_b"),
    )
    # A column paired with itself gives its own moments; each row has a value in one of the two.
    moments = co_moments(sides, [("_a", "_a"), ("_b", "_b")], "_w")

    def spread(i: int) -> Column:
        return F.when(F.col(f"constant_{i}"), 0.0).otherwise(F.col(f"cxx_{i}"))

    degrees = F.col("n_0") + F.col("n_1") - 2
    pooled = F.try_divide(spread(0) + spread(1), degrees.cast("double"))
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), F.col("n_0")) + F.try_divide(F.lit(1.0), F.col("n_1"))))
    return (
        moments.filter((F.col("n_0") > min_group) & (F.col("n_1") > min_group))
        .select(
            F.col("mx_0").alias(f"mean_{first}"),
            F.col("n_0").alias(f"n_{first}"),
            F.col("mx_1").alias(f"mean_{second}"),
            F.col("n_1").alias(f"n_{second}"),
            F.try_divide(F.col("mx_0") - F.col("mx_1"), error).alias("t_stat"),
            degrees.alias("df"),
        )
        .withColumn("p_value", t_tail(F.col("t_stat"), F.col("df")))
        .withColumn("significant", (F.col("p_value") < alpha).cast("int"))
    )
