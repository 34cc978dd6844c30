"""Limit-price signals, pluggable signal functions and model gates."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.functions.scalars import keep_if, quoted
from barloom.operators.blocks import BLOCK, BLOCK_ROWS, LENGTH, POSITION, Blocks, with_position
from barloom.operators.rolling import rolling_max, rolling_min

#: The searched range of window lengths and of the distance in percent.
ENTRY_LENGTHS = (5, 25)
ENTRY_POINTS = (0.1, 15.0)

#: A signal function adds ``buy`` and ``sell`` limit prices to a blocked bar table.
SignalFunction = Callable[..., Blocks]
_SIGNALS: dict[str, SignalFunction] = {}


def register_signal(name: str, lookback: Callable[..., int]) -> Callable[[SignalFunction], SignalFunction]:
    """Make a signal function available by name; ``lookback(**params)`` is its halo length."""

    def add(function: SignalFunction) -> SignalFunction:
        function.lookback = lookback  # type: ignore[attr-defined]
        _SIGNALS[name] = function
        return function

    return add


@register_signal("limit_band", lookback=lambda entry_length, **_: entry_length)
def limit_band(blocks: Blocks, entry_length: int, entry_point: float) -> Blocks:
    """Sell above the recent high and buy below the recent low by ``entry_point`` percent.

    The first ``entry_length`` rows go, one more than the windows need.
    """
    return blocks.with_columns(
        {
            "sell": rolling_max(blocks, "high", entry_length) * F.lit(1 + entry_point / 100),
            "buy": rolling_min(blocks, "low", entry_length) * F.lit(1 - entry_point / 100),
        }
    ).where(F.col(POSITION) >= entry_length)


def signal_blocks(
    bars: DataFrame, name: str = "limit_band", block_rows: int = BLOCK_ROWS, **params: float
) -> Blocks:
    """Blocked signal rows that still carry the one-row halo labels and backtests need."""
    function = _SIGNALS[name]
    positioned = bars if POSITION in bars.columns else with_position(bars)
    before = function.lookback(**params) + 1  # type: ignore[attr-defined]
    return function(Blocks.of(positioned, before=before, after=1, rows=block_rows), **params)


def signals(
    bars: DataFrame, name: str = "limit_band", block_rows: int = BLOCK_ROWS, **params: float
) -> DataFrame:
    """Bars with ``buy`` and ``sell`` limit prices."""
    return signal_blocks(bars, name, block_rows, **params).own_rows()


# -- parameter trials -----------------------------------------------------------------------------


def trial_rows(trials: list[dict]) -> Column:
    """The trial list as a literal array of structs; it travels inside the plan."""
    fields = "trial: int, entry_length: int, entry_point: double"
    text = json.dumps(
        [{k: t[k] for k in ("trial", "entry_length", "entry_point")} for t in trials]
    )
    return F.from_json(F.lit(text), f"array<struct<{fields}>>")


def extremes(blocks: Blocks, lengths: list[int]) -> Blocks:
    """Recent highs and lows for every length that can occur.

    A frame length must be literal; a row whose length is a column then picks its element.
    """
    return blocks.with_columns(
        {
            "__highs": F.array(*[rolling_max(blocks, "high", n) for n in lengths]),
            "__lows": F.array(*[rolling_min(blocks, "low", n) for n in lengths]),
        }
    )


def pick_band(df: DataFrame, lengths: list[int], length: Column, point: Column) -> DataFrame:
    """Limit prices of rows that carry :func:`extremes`, by their own length and distance."""
    slot = F.array_position(F.array(*[F.lit(n) for n in lengths]), length).cast("int")
    edge = point / F.lit(100.0)
    priced = df.where(F.col(POSITION) >= length).withColumns(
        {
            "sell": F.element_at("__highs", slot) * (F.lit(1.0) + edge),
            "buy": F.element_at("__lows", slot) * (F.lit(1.0) - edge),
        }
    )
    return priced.drop("__highs", "__lows")


def trial_signals(blocks: Blocks, trials: list[dict]) -> Blocks:
    """Limit prices for every trial, with ``trial`` as a further series key.

    Trials multiply the rows inside the task that already holds the block, after the windows
    they share: no shuffle, no join.
    """
    lengths = sorted({t["entry_length"] for t in trials})
    blocks = extremes(blocks, lengths)
    df = blocks.df.withColumn("__t", F.explode(trial_rows(trials)))
    df = pick_band(df, lengths, F.col("__t.entry_length"), F.col("__t.entry_point"))
    return blocks.expand(df.withColumn("trial", F.col("__t.trial")).drop("__t"), "trial")


def tuned_signals(
    positioned: DataFrame, best: DataFrame, block_rows: int = BLOCK_ROWS
) -> Blocks:
    """Limit prices from every symbol's own parameters ``(symbol, entry_length, entry_point)``."""
    tuned = best.select(
        S.SYMBOL, F.col("entry_length").alias("__length"), F.col("entry_point").alias("__point")
    )
    lengths = list(range(ENTRY_LENGTHS[0], ENTRY_LENGTHS[1] + 1))
    blocks = Blocks.of(positioned, before=lengths[-1] + 1, after=1, rows=block_rows)
    # One copy of the parameters per block, joined on the partitioning of all windows.
    copies = blocks.df.select(S.SYMBOL, BLOCK).distinct().join(tuned, S.SYMBOL)
    blocks = extremes(blocks.expand(blocks.df.join(copies, [S.SYMBOL, BLOCK])), lengths)
    priced = pick_band(blocks.df, lengths, F.col("__length"), F.col("__point"))
    return blocks.expand(priced.drop("__length", "__point"))


# -- gates ----------------------------------------------------------------------------------------


def gate_prices(df: DataFrame, buy_pred: str = "pred_buy", sell_pred: str = "pred_sell") -> DataFrame:
    """Move a limit price out of reach where the classifier says no."""
    return df.withColumns(
        {
            "buy": keep_if(F.col(buy_pred) != 0, F.col("buy"), F.col("buy") - S.GATE_OFFSET),
            "sell": keep_if(F.col(sell_pred) != 0, F.col("sell"), F.col("sell") + S.GATE_OFFSET),
        }
    )


def live_prices(newest: DataFrame) -> DataFrame:
    """Gate in arithmetic form, on the newest row of each symbol."""
    return newest.withColumns(
        {
            "buy_limit_price": F.col("buy") - (1 - F.col("pred_buy")) * S.GATE_OFFSET,
            "sell_limit_price": F.col("sell") + (1 - F.col("pred_sell")) * S.GATE_OFFSET,
        }
    )


def newest_row(df: DataFrame, keys: tuple[str, ...] = ("symbol",), order: str = "ts") -> DataFrame:
    """The newest row per key.

    Positioned rows need a filter only. Else the newest time per key comes first, as a hash
    aggregate, and rows of that time are picked out; equal times are decided by the other columns.
    """
    if {POSITION, LENGTH} <= set(df.columns):
        return df.where(F.col(POSITION) == F.col(LENGTH) - 1)
    keys_ = list(keys)
    rest = [quoted(c).desc() for c in df.columns if c not in (*keys_, order)]
    newest = df.groupBy(*keys_).agg(F.max(order).alias(order))
    last = df.join(newest, [*keys_, order], "left_semi")
    rank = F.row_number().over(Window.partitionBy(*keys_).orderBy(*(rest or keys_)))
    return last.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
