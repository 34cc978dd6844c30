"""Bar tables from the general-purpose event and order-line tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.operators.blocks import BLOCK_ROWS, TILE_SECONDS, with_position
from barloom.operators.resample import resample, tick_order
from barloom.session import scratch, shared_dir, shuffles_removed
from barloom.sinks.writers import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_ticks(events: DataFrame, level: float = 0.0, whole: bool = False) -> DataFrame:
    """Events as ticks: symbol = event type, price = ``level`` + value, volume 1 each.

    ``whole`` makes all events one long series named ``all``.
    """
    price = F.col("value") + F.lit(level) if level else F.col("value")
    symbol = F.lit("all") if whole else F.col("event_type")
    return events.select(
        symbol.alias(S.SYMBOL),
        F.col("ts").cast("timestamp").alias(S.TS),
        F.col("event_id").alias("seq"),
        price.alias("price"),
        F.lit(1.0).alias("volume"),
    )


def line_ticks(lineitem: DataFrame, level: float = 0.0) -> DataFrame:
    """Order lines as ticks: symbol = supplier, ``level`` + unit price, quantity as volume.

    A day has no order of its own; lines are ordered by order, part and line number.
    """
    price = F.col("l_extendedprice") / F.col("l_quantity")
    price = price + F.lit(level) if level else price
    order = F.col("l_orderkey").cast("decimal(19,0)") * F.lit(Decimal(10**12))
    part = F.col("l_partkey").cast("decimal(19,0)") * F.lit(Decimal(10))
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias(S.SYMBOL),
        F.col("l_shipdate").cast("timestamp").alias(S.TS),
        (order + part + F.col("l_linenumber")).cast("decimal(38,0)").alias("seq"),
        price.alias("price"),
        F.col("l_quantity").alias("volume"),
    )


def event_bars(
    spark: SparkSession,
    sf_dir: str,
    interval: str = "15 minutes",
    level: float = 0.0,
    whole: bool = False,
) -> DataFrame:
    ticks = event_ticks(table(spark, sf_dir, "events"), level, whole)
    return resample(ticks, interval, tick_order())


def line_bars(spark: SparkSession, sf_dir: str, level: float = 0.0) -> DataFrame:
    return resample(line_ticks(table(spark, sf_dir, "lineitem"), level), "1 day", F.col("seq"))


def stored(bars: DataFrame, tile_seconds: int = TILE_SECONDS) -> DataFrame:
    """The bar table as later stages read it: written once, with row positions.

    Ticks are aggregated once, and everything after reads bars back with pruned columns. Bars without
    positions and the shuffles of both steps are removed, so later stages find the disks free of them.
    """
    spark = bars.sparkSession
    path = shared_dir(spark, "positions")
    with scratch(spark), shuffles_removed(spark):
        placed = with_position(written(bars, "bars"), tile_seconds=tile_seconds)
        return written(placed, "positions", path)


def stored_lines(spark: SparkSession, sf_dir: str, level: float = 0.0) -> DataFrame:
    """The stored bars of order lines; a tile holds as many of their days as a block holds rows."""
    return stored(line_bars(spark, sf_dir, level), BLOCK_ROWS * 86400)
