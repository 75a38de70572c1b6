"""Quality rules as a bitmask ledger.

`ledger` evaluates every rule once and stores the measurements with one failure bit per rule. Policies are versioned
sets of bits over the stored ledger, so changing a policy needs no second look at any text, and `ablation` tells from
bit counts alone what each rule of a policy removes on its own. Write the ledger as a table before filtering by policies:
on the bare plan, Spark would push such a filter below the measurements and take them again for every rule.

Everything is built from SQL functions on one row at a time: no shuffle, and no row is ever split over tasks. Windows
of three words are compared by 64-bit hashes inside one document only; the chance that two different windows of one
document collide is below 1e-10 even for 20,000 words.

Defined cases: a null text has no words and fails `few_words`; an id may be null or repeated, every row gets its own
ledger row; further columns are ignored; an empty table gives an empty ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import WORD, text_or_empty

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ellipsis_lines")

#: Rule -> it fails. The position in this table is the bit; append new rules, never reorder them.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "short_mean_word": "n_words > 0 AND word_chars < 2 * n_words",
    "long_mean_word": "word_chars > 15 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "ellipsis_lines": "10 * n_ellipsis_lines > 3 * n_lines",
}
BITS = {rule: 1 << i for i, rule in enumerate(RULES)}

#: Version -> its rules. Published versions stay as they are; a change is a new version.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "short_mean_word", "long_mean_word", "symbols"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask(policy: str) -> int:
    return sum(BITS[rule] for rule in POLICIES[policy])


def _repeat_words(words: Column) -> Column:
    """Words inside windows of three that occur twice or more: sort (hash, position), keep equal neighbours."""
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    windows = F.transform(
        starts, lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("p"))
    )
    ordered = F.sort_array(windows)

    def paired(rows: Column) -> Column:
        n = F.size(rows)
        follows = F.zip_with(
            F.slice(rows, 1, n - 1),
            F.slice(rows, 2, n - 1),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])),
        )
        at = F.flatten(F.filter(follows, lambda x: x.isNotNull()))
        covered = F.flatten(F.transform(at, lambda p: F.array(p, p + 1, p + 2)))
        return F.size(F.array_distinct(covered))

    return ordered, paired


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements, fail_bits): one row per row of `docs`."""
    texts = docs.select(F.col(id_col), text_or_empty(F.col(text_col)).alias("body"))
    split = texts.select(
        id_col,
        F.regexp_extract_all("body", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("body", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        F.regexp_count("body", F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
    )
    counted = split.select(
        id_col,
        "n_symbols",
        "words",
        F.size("words").alias("n"),
        F.char_length(F.concat_ws("", "words")).alias("word_chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).alias("n_ellipsis_lines"),
    )
    ordered, paired = _repeat_words(F.col("words"))
    sorted_windows = counted.withColumn("windows", F.when(F.col("n") >= 4, ordered)).drop("words")
    measured = sorted_windows.select(
        id_col,
        F.col("n").cast("long").alias("n_words"),
        F.coalesce(F.when(F.col("n") >= 4, paired(F.col("windows"))), F.lit(0)).cast("long").alias("n_repeat_words"),
        *[F.col(c).cast("long").alias(c) for c in MEASURES if c not in ("n_words", "n_repeat_words")],
    )
    bits = sum(
        (F.when(F.expr(f"coalesce({test}, false)"), F.lit(BITS[rule]).cast("long")).otherwise(F.lit(0).cast("long")))
        for rule, test in RULES.items()
    )
    return measured.select(id_col, *MEASURES, bits.alias("fail_bits"))


def apply_policy(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with `kept`: no rule of the policy failed."""
    return ledger_rows.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0)


def ablation(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of the policy: rows it fails, rows only it fails (kept again without it), rows the policy keeps.

    One aggregation over the ledger with a few counters, whatever the number of rows.
    """
    rules = POLICIES[policy]
    failed = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)))
    counters = [F.count_if(failed == 0).alias("kept")]
    for rule in rules:
        counters.append(F.count_if(failed.bitwiseAND(F.lit(BITS[rule])) != 0).alias(f"f_{rule}"))
        counters.append(F.count_if(failed == BITS[rule]).alias(f"a_{rule}"))
    one = ledger_rows.agg(*counters)
    per_rule = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.col(f"f_{rule}").alias("failed"),
                F.col(f"a_{rule}").alias("failed_alone"),
                F.col("kept"),
            )
            for rule in rules
        ]
    )
    return one.select(F.inline(per_rule))
