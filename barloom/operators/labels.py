"""Fills and classification labels of limit-price signals."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.scalars import all_present, keep_if
from barloom.operators.blocks import BLOCK_ROWS, Blocks


def add_fills(blocks: Blocks) -> Blocks:
    """Limit prices corrected by the next open, and which orders filled.

    ``long`` / ``short`` say whether the previous row's orders filled in this row,
    ``__next_long`` / ``__next_short`` whether this row's orders fill in the next one. All of it
    follows from one look back and one look ahead, so it costs a single window pass.
    """
    plain = blocks.over()
    blocks = blocks.with_exprs(
        {
            "limit": f"lead(open) {plain}",
            "__next_low": f"lead(low) {plain}",
            "__next_high": f"lead(high) {plain}",
            "__last_buy": f"lag(buy) {plain}",
            "__last_sell": f"lag(sell) {plain}",
        }
    )
    # The previous row's corrected price is bounded by this row's open. Comparisons with a
    # missing neighbour are NULL and count as not filled; least and greatest would skip it.
    bid, ask = F.col("__last_buy"), F.col("__last_sell")
    blocks = blocks.with_columns(
        {
            "buy": F.least("buy", "limit"),
            "sell": F.greatest("sell", "limit"),
            "long": F.when(bid.isNotNull(), F.col("low") < F.least(bid, F.col("open"))),
            "short": F.when(ask.isNotNull(), F.col("high") > F.greatest(ask, F.col("open"))),
        }
    )

    def known(name: str | Column) -> Column:
        return F.coalesce(F.col(name) if isinstance(name, str) else name, F.lit(False))

    blocks = blocks.with_columns(
        {
            "long": known("long"),
            "short": known("short"),
            "__next_long": known(F.col("__next_low") < F.col("buy")),
            "__next_short": known(F.col("__next_high") > F.col("sell")),
        }
    )
    return blocks.drop("__next_low", "__next_high", "__last_buy", "__last_sell")


def _three_class(filled_at: str, won: Column) -> Column:
    return F.when(F.col(filled_at) == 0, 0).when(won, 1).otherwise(-1)


def add_labels(
    blocks: Blocks,
    binary: bool = True,
    sell_label: Literal["mirror", "as_written"] = "mirror",
) -> Blocks:
    """Execution prices and labels: 1 filled and ahead at the next close, -1 filled, 0 not filled.

    ``mirror`` treats the sell side as the buy side turned over. ``as_written`` keeps the
    published formula, which compares twice the price with the next close less one and is
    therefore 1 for nearly every filled sell.
    """
    if sell_label not in ("mirror", "as_written"):
        raise ValueError("sell_label must be 'mirror' or 'as_written'")
    blocks = blocks.with_exprs({"__next_close": f"lead(close) {blocks.over()}"})
    blocks = add_fills(blocks).with_columns(
        {
            "exec_price_buy": keep_if(F.col("__next_long"), F.col("buy"), F.lit(0.0)),
            "exec_price_sell": keep_if(F.col("__next_short"), F.col("sell"), F.lit(0.0)),
        }
    )
    buy, sell, following = F.col("exec_price_buy"), F.col("exec_price_sell"), F.col("__next_close")
    y_buy = _three_class("exec_price_buy", buy < following)
    if sell_label == "mirror":
        y_sell = _three_class("exec_price_sell", sell > following)
    else:
        y_sell = F.when((sell != 0) & (2 * sell > following - 1), 1).otherwise(0)
    if binary:
        y_buy, y_sell = (y_buy == 1).cast("int"), (y_sell == 1).cast("int")
    blocks = blocks.with_columns({"y_buy": y_buy, "y_sell": y_sell})
    return blocks.drop("__next_close", "__next_long", "__next_short")


def labels(
    signal_rows: DataFrame | Blocks,
    binary: bool = True,
    sell_label: Literal["mirror", "as_written"] = "mirror",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Labelled signal rows; rows with a missing value (the last of a series) are dropped."""
    blocks = signal_rows
    if not isinstance(blocks, Blocks):
        blocks = Blocks.of(signal_rows, before=1, after=1, rows=block_rows)
    out = add_labels(blocks, binary, sell_label).own_rows()
    return out.where(all_present(out.columns))
