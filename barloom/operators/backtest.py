"""Vectorised limit-order backtest over any number of series, trials and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.functions.scalars import divide, number
from barloom.operators.blocks import BLOCK, BLOCK_ROWS, POSITION, Blocks
from barloom.operators.labels import add_fills


def add_orders(blocks: Blocks) -> Blocks:
    """Fills, order sign and execution price per row."""
    order = F.when(F.col("long") == F.col("short"), 0).when(F.col("long"), 1).otherwise(-1)
    price = (
        F.when(F.col("__next_short"), F.col("sell"))
        .when(F.col("__next_long"), F.col("buy"))
        .otherwise(F.col("close"))
    )
    blocks = add_fills(blocks).with_columns({"order": order, "exec_price": price})
    return blocks.drop("__next_long", "__next_short")


def add_runs(blocks: Blocks) -> Blocks:
    """Return of each row, and the run of equally signed orders it belongs to, block by block.

    All orders between two sign flips have one sign, so the clamped position is that sign times
    the number of orders since the last flip, at most ``pyramiding``.
    """
    running, plain = blocks.over(running=True), blocks.over()
    earlier = running.replace("UNBOUNDED PRECEDING", "BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    blocks = blocks.with_exprs({"__order": "CASE WHEN own AND order != 0 THEN order END"})
    blocks = blocks.with_exprs(
        {
            "return": f"coalesce(exec_price - lag(exec_price) {plain}, 0D)",
            "__return_at_close": f"coalesce(close - lag(exec_price) {plain}, 0D)",
            "__side": f"last(__order, true) {running}",
            "__flip": f"__order != last(__order, true) {earlier}",
            "__orders": f"count(__order) {running}",
        }
    )
    blocks = blocks.with_exprs(
        {
            "__run": "__orders - coalesce("
            f"max(CASE WHEN __flip THEN __orders - 1 END) {running}, 0L)",
            "__flipped": f"coalesce(max(__flip) {running}, false)",
        }
    )
    return blocks


def run_state(blocks: Blocks) -> DataFrame:
    """The run that reaches into each block from earlier ones: sign and order count."""
    return blocks.block_state(
        summary={
            "__first": f"min_by(__order, {POSITION}) FILTER (WHERE __order IS NOT NULL)",
            "__last": f"max_by(__order, {POSITION}) FILTER (WHERE __order IS NOT NULL)",
            "__tail": f"max_by(__run, {POSITION})",
            "__turned": "max(__flipped)",
        },
        state=[
            {"__side_in": "last(__last, true) OVER earlier", "__sum": "sum(__tail) OVER blocks"},
            {"__reset": "__turned OR coalesce(__first != __side_in, false)"},
            {
                "__count": "__sum - coalesce("
                "max(CASE WHEN __reset THEN __sum - __tail END) OVER blocks, 0L)"
            },
            {
                "__in_side": "coalesce(__side_in, 0)",
                "__in_count": "lag(__count) OVER blocks",
            },
        ],
    )


def add_positions(blocks: Blocks, pyramiding: int, lot: float) -> Blocks:
    """Position after each row, from its run and the run that entered its block."""
    plain = blocks.over()
    side = "coalesce(__side, __in_side)"
    count = (
        "CASE WHEN __side IS NULL THEN coalesce(__in_count, 0L)"
        " WHEN __flipped OR __side != __in_side THEN __run"
        " ELSE __run + coalesce(__in_count, 0L) END"
    )

    def position(side: str, count: str) -> str:
        clamped = f"CAST({side} * least({count}, {pyramiding}L) AS DOUBLE)"
        return f"{clamped} / {number(pyramiding)} * {number(lot)}"

    blocks = blocks.with_exprs(
        {
            "pos": position(side, f"({count})"),
            "__pos_in": f"CASE WHEN __in_count IS NOT NULL THEN {position('__in_side', '__in_count')} END",
        }
    )
    blocks = blocks.with_exprs(
        {"__pos_before": f"CASE WHEN lag(own) {plain} THEN lag(pos) {plain} ELSE __pos_in END"}
    )
    return blocks.drop(
        *["__order", "__side", "__orders", "__flip", "__run", "__flipped"],
        *["__in_side", "__in_count", "__pos_in"],
    )


def add_profit(blocks: Blocks, commission: float) -> Blocks:
    """Commission on the change of position (unknown on the first row) and profit.

    ``profit_at_close`` is the profit a row would have as the last one of its series, where no
    order can fill after it and it is valued at its close.
    """

    def cost(price: str) -> str:
        return f"{price} * {number(commission)} / 100D * abs(pos - __pos_before)"

    blocks = blocks.with_exprs({"commission": cost("exec_price")})
    blocks = blocks.with_exprs(
        {
            "profit": "`return` * pos - commission",
            "profit_at_close": f"__return_at_close * pos - {cost('close')}",
        }
    )
    return blocks.drop("__pos_before", "__return_at_close")


def add_pnl(blocks: Blocks) -> Blocks:
    """Cumulative profit."""
    blocks = blocks.with_exprs(
        {"__inside": f"sum(CASE WHEN own THEN profit END) {blocks.over(running=True)}"}
    )
    blocks = blocks.carry(
        {"__total": "sum(profit)"}, {"__before": "coalesce(sum(__total) OVER earlier, 0D)"}
    )
    blocks = blocks.with_exprs({"pnl": "__inside + __before"})
    return blocks.drop("__inside", "__before")


def trade(blocks: Blocks, account: S.BacktestParams, pyramiding: int) -> Blocks:
    """Everything up to ``profit``; enough for the pnl and sr metrics."""
    blocks = add_runs(add_orders(blocks))
    entered = blocks.expand(blocks.df.join(run_state(blocks), [*blocks.keys, BLOCK]))
    return settle(entered, account, pyramiding)


def settle(entered: Blocks, account: S.BacktestParams, pyramiding: int) -> Blocks:
    """Positions and profit of rows that know their block's entering run."""
    return add_profit(add_positions(entered, pyramiding, account.lot), account.commission)


def backtest(
    signal_rows: DataFrame | Blocks,
    account: S.BacktestParams = S.BacktestParams(),
    pyramiding: int = 3,
    keys: Sequence[str] = ("symbol",),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Signal rows with orders, positions, profit and the pnl curve, per series key.

    ``signal_rows`` is a positioned signal table, or the blocked form of
    :func:`barloom.operators.signals.signal_blocks`, which saves one exchange.
    """
    blocks = signal_rows
    if not isinstance(blocks, Blocks):
        blocks = Blocks.of(signal_rows, before=1, after=1, keys=keys, rows=block_rows)
    return add_pnl(trade(blocks, account, pyramiding).drop("profit_at_close")).own_rows()


def pnl_curve(backtested: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    return backtested.select(*keys, S.TS, "pnl")


# -- metrics --------------------------------------------------------------------------------------


def profit_metrics(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``pnl`` (final cumulative profit) and ``sr`` (mean over population deviation) per key.

    The missing profit of a series' first row is left out of both.
    """
    return rows.groupBy(*keys).agg(
        F.sum("profit").alias("pnl"),
        divide(F.avg("profit"), F.stddev_pop("profit")).alias("sr"),
    )


def max_drawdown(traded: Blocks) -> DataFrame:
    """Largest fall of the pnl curve below its running peak, per key.

    A block reports its total and, counted from its own start, its largest fall, high and low;
    the rest is arithmetic on the block table, so no cumulative pnl is joined back to the rows.
    """
    running = traded.over(running=True)
    blocks = traded.with_exprs({"__inside": f"sum(CASE WHEN own THEN profit END) {running}"})
    blocks = blocks.with_exprs({"__peak": f"max(__inside) {running}"})
    table = blocks.block_state(
        summary={
            "__fall": "max(__peak - __inside)",
            "__high": "max(__inside)",
            "__low": "min(__inside)",
            "__total": "sum(profit)",
        },
        state=[
            {"__base": "coalesce(sum(__total) OVER earlier, 0D)"},
            {"__top": "__base + __high", "__bottom": "__base + __low"},
            {"__deepest": "greatest(__fall, max(__top) OVER earlier - __bottom)"},
        ],
    )
    return table.groupBy(*traded.keys).agg(F.max("__deepest").alias("max_dd"))


def score(traded: Blocks, name: str) -> DataFrame:
    """One named metric of traded rows: ``(keys, metric)``."""
    S.direction_of(name)
    keys = list(traded.keys)
    if name == "max_dd":
        return max_drawdown(traded).withColumnRenamed("max_dd", "metric")
    rows = traded.own_rows(*keys, "profit")
    return profit_metrics(rows, keys).select(*keys, F.col(name).alias("metric"))


def metric(
    signal_rows: DataFrame | Blocks,
    name: str,
    account: S.BacktestParams = S.BacktestParams(),
    pyramiding: int = 3,
    keys: Sequence[str] = ("symbol",),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One named backtest metric per series."""
    blocks = signal_rows
    if not isinstance(blocks, Blocks):
        blocks = Blocks.of(signal_rows, before=1, after=1, keys=keys, rows=block_rows)
    return score(trade(blocks, account, pyramiding), name)
