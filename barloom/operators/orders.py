"""Order planning from limit prices and the current position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.operators.signals import newest_row


def plan_orders(
    prices: DataFrame, positions: DataFrame, lot: float = 0.001, max_pyramiding: int = 3
) -> DataFrame:
    """Rows ``(symbol, side, qty, price)`` to place, at most one per side and symbol.

    ``prices`` has one row per symbol with ``buy_limit_price`` and ``sell_limit_price``;
    ``positions`` has ``symbol, ts, side ('Buy' / 'Sell'), size``, of which the newest row counts.

    * no position: one lot on both sides;
    * below the cap: one lot on the held side, position plus one lot on the other;
    * at the cap: only the other side, for the full cap plus one lot.
    """
    held = newest_row(positions.select(S.SYMBOL, S.TS, "side", "size")).select(
        S.SYMBOL, F.col("side").alias("__held"), F.col("size").alias("__size")
    )
    return order_rows(prices.join(held, S.SYMBOL, "left"), lot, max_pyramiding)


def order_rows(
    joined: DataFrame, lot: float, max_pyramiding: int, keys: Sequence[str] = (S.SYMBOL,)
) -> DataFrame:
    """Orders from prices next to the position held (``__held``, ``__size``), if any; no state."""
    below_cap = F.col("__size") < lot * max_pyramiding

    def quantity(side: str, other: str):  # noqa: ANN202
        return (
            F.when(F.col("__held").isNull(), F.lit(lot))
            .when((F.col("__held") == side) & below_cap, F.lit(lot))
            .when((F.col("__held") == other) & below_cap, F.col("__size") + lot)
            .when(F.col("__held") == other, F.lit(lot * (1 + max_pyramiding)))
        )

    def order(side: str, other: str, price: str):  # noqa: ANN202
        return F.struct(
            F.lit(side.lower()).alias("side"),
            quantity(side, other).alias("qty"),
            F.col(price).alias("price"),
        )

    both = F.array(order("Buy", "Sell", "buy_limit_price"), order("Sell", "Buy", "sell_limit_price"))
    return (
        joined.select(*keys, F.explode(both).alias("o"))
        .select(*keys, "o.side", "o.qty", "o.price")
        .where("qty IS NOT NULL")
    )
