"""Constant bars on a regular grid, for tests and demonstrations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import schema as S


def constant_bars(
    spark: SparkSession, bars: int = 10, symbols: int = 1, features: int = 0, minutes: int = 15
) -> DataFrame:
    """Bars of value 1 every ``minutes`` from 2024-01-01, with ``feature0..`` columns if asked."""
    rows = spark.range(symbols * bars)
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    step = F.expr(f"make_interval(0, 0, 0, 0, 0, CAST(id % {bars} AS INT) * {minutes}, 0)")
    one = F.lit(1.0)
    return rows.select(
        F.concat(F.lit("S"), F.floor(F.col("id") / bars).cast("string")).alias(S.SYMBOL),
        (at + step).alias(S.TS),
        *[one.alias(c) for c in S.OHLCV],
        *[one.alias(f"feature{k}") for k in range(features)],
    )
