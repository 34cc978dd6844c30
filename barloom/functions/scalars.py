"""Small Column expressions used across operators. All stay in generated JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def divide(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that yields NULL for a zero denominator instead of raising under ANSI mode."""
    return F.try_divide(col(numerator), col(denominator))


def number(value: float) -> str:
    """A double literal in SQL text."""
    return f"{float(value)!r}D"


def total(terms: list[Column]) -> Column:
    """Left-to-right sum of several columns."""
    return reduce(lambda a, b: a + b, terms)


def keep_if(condition: Column, value: Column, other: Column) -> Column:
    """``value`` where the condition is true, ``other`` where it is false or NULL."""
    return F.when(F.coalesce(condition, F.lit(False)), value).otherwise(other)


def epoch_millis_to_ts(value: str | Column) -> Column:
    return F.timestamp_millis(col(value).cast("bigint"))


def stamp(value: str | Column) -> Column:
    """``yyyyMMddHHmmss`` text of a timestamp, as used in artifact names."""
    return F.date_format(col(value), "yyyyMMddHHmmss")


def quoted(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(f"`{name}`")


def all_present(names: list[str]) -> Column:
    """True where every named column is non-NULL."""
    return F.expr(" AND ".join(f"`{name}` IS NOT NULL" for name in names))
