"""Mixing sources to target weights by fitting a word budget as a subset sum.

Each source gets a share of all words by weight; a target stops at `max_repeats` times the source and the excess goes to
the others by weight. A source first takes an even share of the documents of every exact length (several times over where
the target asks for it), and the remaining budget is fitted by bounded-knapsack dynamic programming over (length, takes
left). Only counts by length travel there; which documents of a length are taken is decided by a seeded hash.

Scale: one scan reduces texts to (id, source, size). The knapsack of a source sees one row per distinct length, so its
memory is bounded by the longest document, not by the number of documents. The seeded choice inside one length never
sorts the group: hashes are counted in buckets of about `BUCKET_ROWS` rows, whole buckets are taken, and only the bucket
on the border is ranked.

Defined cases: null source is a source of its own and comes last; null or empty texts have size 0 and take nothing; an
empty table gives an empty mix; repeated ids are chosen row by row; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import WORD, first_of, staged, text_or_empty

BUCKET_ROWS = 256
DP_WORDS = 1 << 16
SEED = 20

PLAN = "source string, size long, n long, source_size long, target double, passes long, extra long"


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, body, source, size): words of each row, and a hash of its text."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_or_empty(F.col(text_col))).alias("body"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text_or_empty(F.col(text_col)), F.lit(WORD)).cast("long").alias("size"),
    )


def targets(histogram: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, size, n).

    Sharing the excess by weight until nobody is above the cap ends where every open source has the same target per
    weight, `level`. Sources are closed in the order of cap per weight; the first source that stays below the level
    which the rest would reach ends the closing. Windows run over one row per source.
    """
    totals = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    table = F.array(*[F.lit(float(w)) for w in weights])
    weighed = totals.withColumn("weight", table[(F.row_number().over(by_name) - 1) % len(weights)])
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    whole = Window.partitionBy()
    stepped = (
        weighed.withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
        .withColumn("closed_cap", F.sum("cap").over(by_cap) - F.col("cap"))
        .withColumn("open_weight", F.sum("weight").over(whole) - F.sum("weight").over(by_cap) + F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(whole) - F.col("closed_cap")) / F.col("open_weight"))
        .withColumn("stays", F.col("level") * F.col("weight") <= F.col("cap"))
    )
    level = F.min(F.when(F.col("stays"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(whole)
    return stepped.withColumn("final", level["level"]).select(
        "source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("final") * F.col("weight"), F.col("cap"))).alias("target")
    )


def subset_sum(lengths: np.ndarray, available: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take so that the sum is the largest reachable one up to `budget`.

    Bounded knapsack with counts split into powers of two; `first` remembers the step that reached a sum first, which is
    all that walking back needs. Memory is a few bytes per word of the budget.
    """
    taken = np.zeros(len(lengths), dtype=np.int64)
    if budget <= 0:
        return taken
    reached = np.zeros(budget + 1, dtype=bool)
    reached[0] = True
    first = np.full(budget + 1, -1, dtype=np.int32)
    steps: list[tuple[int, int]] = []
    for i in np.flatnonzero((available > 0) & (lengths > 0) & (lengths <= budget)):
        left, piece, length = int(min(available[i], budget // lengths[i])), 1, int(lengths[i])
        while left and not reached[budget]:
            piece = min(piece, left)
            if (weight := piece * length) > budget:
                break
            new = np.flatnonzero(reached[:-weight] & ~reached[weight:]) + weight
            reached[new], first[new] = True, len(steps)
            steps.append((int(i), piece))
            left, piece = left - piece, piece * 2
        if reached[budget]:
            break
    total = int(np.flatnonzero(reached)[-1])
    while total:
        i, piece = steps[first[total]]
        taken[i] += piece
        total -= piece * int(lengths[i])
    return taken


def fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    """Passes and extra documents per length for one source; `rows` has one row per exact length.

    A document may be taken up to `max_repeats` times. Every length first gets its even share of the takes; then single
    takes are given out (while much is left) or given back (until the exact fit has some room), in seeded order.
    """
    rows = rows.sort_values("size", ignore_index=True)
    lengths, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    total, budget = int((lengths * counts).sum()), int(round(rows["target"].iloc[0]))
    most = counts * rows["max_repeats"].to_numpy(np.int64) * (lengths > 0)
    taken = np.zeros(len(rows), dtype=np.int64)
    if total:
        share = counts * (budget / total)
        taken = np.minimum(np.floor(share).astype(np.int64), most)
        rest, random = budget - int((taken * lengths).sum()), np.random.default_rng(SEED)
        for i in np.lexsort((random.permutation(len(rows)), -(share - np.floor(share)))):
            if rest <= DP_WORDS:
                break
            if taken[i] < most[i] and lengths[i] <= rest:
                taken[i] += 1
                rest -= int(lengths[i])
        while rest < min(DP_WORDS, budget):
            for i in random.permutation(np.flatnonzero(taken)):
                taken[i] -= 1
                rest += int(lengths[i])
                if rest >= DP_WORDS:
                    break
        order = random.permutation(len(rows))
        taken[order] += subset_sum(lengths[order], (most - taken)[order], rest)
    passes, extra = taken // counts, taken % counts
    return rows.assign(passes=passes, extra=extra)[[c.split()[0] for c in PLAN.split(", ")]]


def _order(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("id"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    max_repeats: int = 3,
    seed: int = SEED,
) -> DataFrame:
    """(id, body, source, size, source_size, target, repeats, taken): one row per row of `docs`."""
    narrow = staged(sizes(docs, id_col, text_col, source_col), "mix-sizes")
    histogram = narrow.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    goals = targets(histogram, weights, max_repeats).withColumnRenamed("source", "name")
    with_goal = histogram.join(goals, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    with_goal = with_goal.withColumn("max_repeats", F.lit(max_repeats))
    plan = staged(with_goal.groupBy("source").applyInPandas(fit_source, PLAN), "mix-plan")

    named = plan.select(*[F.col(c).alias(f"p_{c}") if c in ("source", "size") else F.col(c) for c in plan.columns])
    same = narrow["source"].eqNullSafe(named["p_source"]) & (narrow["size"] == named["p_size"])
    ordered = narrow.join(named, same).drop("p_source", "p_size").withColumn("h", _order(seed))
    spread = ordered.withColumn("bucket", F.pmod("h", F.ceil(F.col("n") / BUCKET_ROWS)))
    group = ["source", "size", "bucket"]
    filled = spread.groupBy(*group).agg(F.count(F.lit(1)).alias("in_bucket"), F.first("extra").alias("wanted"))
    before = F.sum("in_bucket").over(Window.partitionBy("source", "size").orderBy("bucket")) - F.col("in_bucket")
    quotas = filled.select(*[F.col(c).alias(f"q_{c}") for c in group], (F.col("wanted") - before).alias("quota"))
    match = F.col("source").eqNullSafe(F.col("q_source")) & (F.col("size") == F.col("q_size")) & (F.col("bucket") == F.col("q_bucket"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("h", "id", "body"))
    chosen = spread.withColumn("rank", rank).join(quotas, match)
    repeats = F.col("passes") + F.when(F.col("rank") <= F.col("quota"), 1).otherwise(0)
    return chosen.select(
        F.col("id").alias(id_col),
        "body",
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        repeats.cast("long").alias("repeats"),
        (repeats * F.col("size")).cast("long").alias("taken"),
    )


def mixed_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it. Rows that agree in id, source and text count as one row,
    the one whose columns hash lowest, which then stands for what the mix takes of all of them."""
    counts = mix(docs, id_col, text_col, source_col, **options).groupBy(
        F.xxhash64(F.col(id_col).cast("string"), F.col(source_col).isNull(), source_col).alias("named"), "body"
    )
    taken = counts.agg(F.sum("repeats").alias("repeats")).filter("repeats > 0")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    source = F.col(source_col).cast("string")
    packed = docs.select(
        whole.alias("whole"),
        F.xxhash64(F.col(id_col).cast("string"), source.isNull(), source).alias("named"),
        F.xxhash64(text_or_empty(F.col(text_col))).alias("body"),
    )
    rows = first_of(packed.join(taken, ["named", "body"]), "named", "body", "repeats")
    return rows.select("whole", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))).select("whole.*")
