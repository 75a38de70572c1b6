"""Scalar rules: text, time, buckets and labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delay buckets and their labels. Intervals are right-closed; "On Time" covers 1 to 3 days late.
DELAY_EDGES = (-999, -7, 0, 3, 7, 14, 999)
DELAY_LABELS = ("Early >7d", "Early 1-7d", "On Time", "Late 1-3d", "Late 4-7d", "Late >7d")

# The week, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

_TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
_MICROS_PER_DAY = 86_400_000_000


def strip(c: Column) -> Column:
    """Remove every kind of leading and trailing white space (``trim`` removes blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


# Types whose equal values have equal hashes; decimals are named with their digits.
_HASHED = ("string", "tinyint", "smallint", "int", "bigint", "boolean", "date", "timestamp_ntz")


def digestible(kind: str) -> bool:
    """Whether ``row_digest`` takes columns of this type (nested, binary and collated ones it doesn't)."""
    return kind in (*_HASHED, "float", "double", "timestamp") or kind.startswith("decimal(")


def row_digest(columns: Sequence[tuple[str, str]]) -> Column:
    """Two 64-bit hashes over the named columns (name, type): equal for rows that a grouping by these columns holds equal,
    and for other rows only if both hashes collide.

    The values are hashed as they are, without a text of their own. A hash leaves nulls out, so each value is followed by
    whether it is null; the second hash has another start and takes the columns in reverse. Both zeros of a double are one
    value, as in a grouping.
    """
    parts = []
    for name, kind in columns:
        c = F.col(f"`{name}`")
        if kind in ("float", "double"):
            c = c.cast("double") + F.lit(0.0)
        parts += [c, c.isNull()]
    return F.struct(F.xxhash64(*parts).alias("one"), F.xxhash64(F.lit(1), *reversed(parts)).alias("two"))


def parse_timestamp(c: Column, permissive: bool = False) -> Column:
    """Text to timestamp without zone; text of another shape becomes null instead of an error.

    The cast reads no session time zone. ``permissive`` also accepts the other ISO shapes Spark knows.
    """
    parsed = c.try_cast("timestamp_ntz")
    return parsed if permissive else F.when(c.rlike(_TIMESTAMP_SHAPE), parsed)


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded down: 12 hours early is -1, 12 hours late is 0."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    day = F.lit(_MICROS_PER_DAY)
    return F.call_function("div", micros - F.pmod(micros, day), day)


def is_late(delay: Column) -> Column:
    """1 after at least one full day of delay, else 0; an unknown delay counts as not late."""
    return F.coalesce((delay > 0).cast("int"), F.lit(0))


def bucket_number(c: Column, edges: Sequence[float]) -> Column:
    """Number (from 1) of the right-closed interval that holds the value; null outside all of them."""
    chain = F.when(c <= edges[0], None)
    for number, edge in enumerate(edges[1:], start=1):
        chain = chain.when(c <= edge, number)
    return chain.cast("int")


def label_of(number: Column, labels: Sequence[str]) -> Column:
    return F.get(F.array(*map(F.lit, labels)), number - 1)


def clip(c: Column, low: Column, high: Column) -> Column:
    """Limit to [low, high]; null stays null (``least`` and ``greatest`` alone would skip it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, low), high))


def non_negative(c: Column) -> Column:
    return F.when(c < 0, None).otherwise(c)


def total(c: Column) -> Column:
    """Sum that is 0.0 for a group without any value."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def all_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])


def month_of(ts: Column) -> Column:
    # By way of the date: formatting a zoneless timestamp itself would pass through the session time zone.
    return F.date_format(F.to_date(ts), "yyyy-MM")


def day_text(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def second_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; a cast, unlike formatting, leaves the session time zone out."""
    return F.substring(ts.cast("string"), 1, 19)


def strength_label(r: Column) -> Column:
    size = F.abs(r)
    return (
        F.when(size < 0.1, "very weak").when(size < 0.3, "weak").when(size < 0.5, "moderate").when(size >= 0.5, "strong")
    )
