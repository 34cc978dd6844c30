"""Keep-latest semantics for overlapping pulls."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.scalars import quoted

BAR_KEY = ("symbol", "ts")
ORDER_KEY = ("symbol", "ts", "side")


_LEAST = -(1 << 63)

#: Types that an aggregation buffer holds in place, so that a hash aggregate can be used.
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _version_number(df: DataFrame, version: str) -> Column | None:
    """The version as a whole number, for times and whole numbers."""
    kind = df.schema[version].dataType
    value = quoted(version)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(value.cast("timestamp"))
    return value.cast("bigint") if isinstance(kind, T.IntegralType) else None


def keep_latest(
    df: DataFrame,
    keys: Sequence[str] = BAR_KEY,
    version: str = "ingest_ts",
    tie: str | None = None,
) -> DataFrame:
    """One row per key, from the newest version.

    A partial aggregate rather than a window: however often one key was pulled, every task sends
    one row for it. Rows are ordered by fixed-width numbers, so that it is a hash aggregate: the
    version with a hash of the other columns, or, with ``tie`` (a whole number), first the tie among
    equal versions and then the version, in two aggregates over the full range of both. Text columns
    or other versions take a sort. Missing versions and ties come last. Equal rows aside, the result
    repeats.
    """
    keys_ = list(keys)
    rest = [c for c in df.columns if c not in (*keys_, version)]
    number = _version_number(df, version)
    fixed = all(isinstance(df.schema[c].dataType, _FIXED) for c in rest)
    if number is None or not fixed:
        newest = df.groupBy(*keys_).agg(
            F.max(F.struct(version, *[quoted(c) for c in rest])).alias("__row")
        )
        return newest.select(*keys_, "__row.*").select(*[quoted(c) for c in df.columns])
    first = F.coalesce(number, F.lit(_LEAST))
    if tie:
        second = F.coalesce(quoted(tie).cast("bigint"), F.lit(_LEAST))
        ordered = df.withColumns({"__version": first, "__tie": second})
        picked = [F.max_by(quoted(c), "__tie").alias(c) for c in (version, *rest)]
        ordered = ordered.groupBy(*keys_, "__version").agg(*picked)
        order = "__version"
    else:
        second = F.shiftrightunsigned(F.xxhash64(*rest), 16)
        wide = first.cast("decimal(19,0)") * F.lit(Decimal(10**15)) + second
        ordered = df.withColumn("__order", wide.cast("decimal(38,0)"))
        order = "__order"
    newest = [F.max_by(quoted(c), order).alias(c) for c in (version, *rest)]
    return ordered.groupBy(*keys_).agg(*newest).select(*[quoted(c) for c in df.columns])


def merge_latest(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str] = BAR_KEY, version: str = "ingest_ts"
) -> DataFrame:
    """Stored rows and a new pull, newest version per key."""
    return keep_latest(current.unionByName(incoming), keys, version)
