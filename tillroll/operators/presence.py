"""References between tables, all answered by one aggregate over key presence.

Every table is read once and gives its tracked columns as narrow rows (number of the domain, key, where). Rows are counted
per key already in the map tasks, so a key of any frequency costs one row per task; after one shuffle a key knows how often each child
column holds it and whether the parent does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profile import stack


@dataclass(frozen=True)
class Reference:
    """Column ``column`` of ``child`` refers to ``key`` of ``parent``."""

    name: str
    child: str
    column: str
    parent: str
    key: str


def key_presence(
    tables: Mapping[str, DataFrame],
    references: Sequence[Reference],
    required: Sequence[tuple[str, str]] = (),
    counted: Sequence[tuple[str, str]] = (),
) -> tuple[DataFrame, dict[tuple[str, str], str], dict[str, int]]:
    """(frame, names, numbers): one row per (domain, key), with a count per tracked (table, column) under the name that
    ``names`` gives; a domain stands in the rows as its number in ``numbers``. A domain is a parent's key; ``required``
    and ``counted`` columns outside of all references are domains of their own, of which a required one only tells null
    from not null. Null is a key like any other.
    """
    domains: dict[tuple[str, str], list[str | None]] = {}

    def track(table: str, column: str, domain: str | None) -> None:
        known = domains.setdefault((table, column), [])
        if domain not in known:
            known.append(domain)

    for r in references:
        track(r.parent, r.key, f"{r.parent}.{r.key}")
        track(r.child, r.column, f"{r.parent}.{r.key}")
    for table, column in counted:
        if (table, column) not in domains:
            track(table, column, f"{table}.{column}")
    for table, column in required:
        if (table, column) not in domains:
            track(table, column, None)
    names = {place: f"_n{i}" for i, place in enumerate(domains)}
    known = [domain or ".".join(place) for place, found in domains.items() for domain in found]
    numbers = {domain: i for i, domain in enumerate(dict.fromkeys(known))}
    parts = []
    for table in dict.fromkeys(table for table, _ in domains):
        entries = []
        for (owner, column), found in domains.items():
            if owner != table:
                continue
            number = int(names[owner, column][2:])
            for domain in found:
                # A column that is only required needs no values, just whether there is one.
                key = F.col(column).cast("string") if domain else F.when(F.col(column).isNotNull(), "")
                where = F.lit(numbers[domain or f"{table}.{column}"]).alias("domain")
                entries.append(F.struct(where, key.alias("key"), F.lit(number).alias("place")))
        parts.append(tables[table].select(F.inline(F.array(*entries))))
    counts = [F.count_if(F.col("place") == int(name[2:])).alias(name) for name in names.values()]
    return stack(parts).groupBy("domain", "key").agg(*counts), names, numbers


def broken_references(
    tables: Mapping[str, DataFrame],
    references: Sequence[Reference],
    required: Sequence[tuple[str, str]] = (),
    repeated: Sequence[tuple[str, str]] = (),
    null_is_key: bool = False,
) -> DataFrame:
    """One row with a column per finding, from one shuffle.

    ``orphans <name>``: child rows whose key the parent lacks; a null key is none, or, with ``null_is_key``, is looked
    for like any other. ``nulls <table>.<column>`` per required column. ``repeats <table>.<column>`` and ``most
    <table>.<column>`` per repeated column: how many keys occur more than once, and the most frequent one's rows (null
    if there is no such key).
    """
    presence, names, numbers = key_presence(tables, references, required, repeated)
    out = []
    for r in references:
        here = F.col("domain") == numbers[f"{r.parent}.{r.key}"]
        missing = here & (F.col(names[r.parent, r.key]) == 0)
        if not null_is_key:
            missing = missing & F.col("key").isNotNull()
        orphans = F.sum(F.when(missing, F.col(names[r.child, r.column])))
        out.append(F.coalesce(orphans, F.lit(0)).cast("bigint").alias(f"orphans {r.name}"))
    # A column in several domains is counted in each of them; the first one answers for it.
    first = {}
    for r in references:
        for place in ((r.parent, r.key), (r.child, r.column)):
            first.setdefault(place, f"{r.parent}.{r.key}")
    for place in required:
        here = F.col("key").isNull() & (F.col("domain") == numbers[first.get(place, ".".join(place))])
        nulls = F.sum(F.when(here, F.col(names[place])))
        out.append(F.coalesce(nulls, F.lit(0)).cast("bigint").alias(f"nulls {'.'.join(place)}"))
    for place in repeated:
        n = F.col(names[place])
        several = F.col("key").isNotNull() & (F.col("domain") == numbers[first.get(place, ".".join(place))]) & (n > 1)
        out.append(F.count_if(several).alias(f"repeats {'.'.join(place)}"))
        out.append(F.max(F.when(several, n)).alias(f"most {'.'.join(place)}"))
    return presence.agg(*out)
