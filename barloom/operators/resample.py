"""Ticks to OHLCV bars, batch or streaming."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.sinks.writers import written


def tick_order(ts: str | Column = "ts", seq: str | Column = "seq") -> Column:
    """One fixed-width ordering key from time and a non-negative sequence number.

    ``min_by`` over a struct needs a sort-based aggregate; a decimal key keeps the aggregation
    buffer fixed-width, so Spark hash-aggregates ticks before the shuffle.
    """
    micros = F.unix_micros(F.col(ts) if isinstance(ts, str) else ts).cast("decimal(19,0)")
    number = (F.col(seq) if isinstance(seq, str) else seq).cast("decimal(19,0)")
    return micros * F.lit(Decimal(10**19)) + number


def resample(ticks: DataFrame, interval: str, order: Column | None = None) -> DataFrame:
    """Aggregate ``(symbol, ts, price, volume)`` rows to one OHLCV bar per window.

    ``order`` decides which tick opens and closes a bar (by default ``ts`` alone). Every
    aggregate combines on the map side, so a hot symbol or a hot window sends one row per task.
    """
    key = F.col(S.TS) if order is None else order
    if ticks.schema[S.TS].dataType.typeName() != "timestamp":
        ticks = ticks.withColumn(S.TS, F.col(S.TS).cast("timestamp"))
    slot = F.window(S.TS, interval)
    # A stream's watermark is that of the whole window; elsewhere its end would only widen every row.
    slot = slot.alias("__slot") if ticks.isStreaming else slot["start"].alias("__start")
    grouped = ticks.groupBy(F.col(S.SYMBOL), slot).agg(
        F.min_by("price", key).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", key).alias("close"),
        F.sum("volume").alias("volume"),
    )
    start = F.col("__slot.start" if ticks.isStreaming else "__start")
    return grouped.select(S.SYMBOL, start.alias(S.TS), *S.OHLCV)


def merged_bars(bars: DataFrame, interval: str, time: Column, slot: Column) -> DataFrame:
    """Bars of one interval from those of a shorter one that divides it."""
    return bars.groupBy(F.col(S.SYMBOL), F.window(slot, interval).alias("__slot")).agg(
        F.min_by("open", time).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", time).alias("close"),
        F.sum("volume").alias("volume"),
    )


def checked_cascade(intervals: Sequence[str]) -> list[int]:
    """Seconds of intervals that each divide the next one."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    seconds = []
    for interval in intervals:
        count, unit = interval.split()
        seconds.append(int(count) * units[unit.rstrip("s")])
    if any(b % a or b <= a for a, b in zip(seconds, seconds[1:])):
        raise ValueError("every interval must be a multiple of the one before")
    return seconds


def resample_cascade(
    ticks: DataFrame, intervals: Sequence[str], order: Column | None = None
) -> dict[str, DataFrame]:
    """Bars of several intervals from one scan of the ticks, each from the shorter one's bars.

    Bars merge: the first opens, the last closes, highs, lows and volumes add up. Every table is
    written, so the ticks are read once and a later interval reads bars only.
    """
    checked_cascade(intervals)
    out: dict[str, DataFrame] = {}
    bars = resample(ticks, intervals[0], order)
    for k, interval in enumerate(intervals):
        if k:
            merged = merged_bars(bars, interval, F.col(S.TS), F.col(S.TS))
            bars = merged.select(S.SYMBOL, F.col("__slot.start").alias(S.TS), *S.OHLCV)
        bars = written(bars, "cascade")
        out[interval] = bars
    return out
