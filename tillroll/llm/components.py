"""Connected components of a link table, by alternating stars.

Each round hangs every node under the smallest node it knows, first among its larger neighbours, then among its smaller
ones, until nothing moves; the number of rounds grows with the logarithm of the longest chain. Links never leave the
executors; each round is a minimum by key and a join, written to the shared folder so that lineage stays short. The joins
are merge joins whatever the size of the links: a broadcast would bring them to the driver, once more in every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import staged

MAX_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least.hint("merge"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _print(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every linked node but the roots themselves; root is the smallest node of the component."""
    low, high = F.least(a, b), F.greatest(a, b)
    now = staged(links.filter(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "links")
    seen = _print(now)
    for _ in range(MAX_ROUNDS):
        now = staged(_small_star(_large_star(now).distinct()).distinct(), "links")
        before, seen = seen, _print(now)
        if before == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
