"""Unbounded running operations on positioned rows, without a whole-series window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from barloom.operators.blocks import BLOCK_ROWS, KEYS, POSITION, Blocks


def cumulative_sum(
    positioned: DataFrame, value: str, output: str, keys: Sequence[str] = KEYS, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Running total; NULL inputs stay NULL and add nothing."""
    blocks = Blocks.of(positioned, keys=keys, rows=rows)
    blocks = blocks.with_exprs({"__inside": f"sum(`{value}`) {blocks.over(running=True)}"})
    blocks = blocks.carry(
        {"__total": f"sum(`{value}`)"}, {"__before": "sum(__total) OVER earlier"}
    )
    both = "coalesce(__inside, 0) + coalesce(__before, 0)"
    blocks = blocks.with_exprs({output: f"CASE WHEN `{value}` IS NOT NULL THEN {both} END"})
    return blocks.drop("__inside", "__before").own_rows()


def forward_fill(
    positioned: DataFrame,
    value: str,
    output: str,
    default: str = "NULL",
    keys: Sequence[str] = KEYS,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Last non-NULL value so far, ``default`` (SQL text) before the first one."""
    blocks = Blocks.of(positioned, keys=keys, rows=rows)
    blocks = blocks.with_exprs({"__inside": f"last(`{value}`, true) {blocks.over(running=True)}"})
    blocks = blocks.carry(
        {"__last": f"max_by(`{value}`, {POSITION}) FILTER (WHERE `{value}` IS NOT NULL)"},
        {"__before": "last(__last, true) OVER earlier"},
    )
    blocks = blocks.with_exprs({output: f"coalesce(__inside, __before, {default})"})
    return blocks.drop("__inside", "__before").own_rows()


def sign_groups(
    positioned: DataFrame,
    sign: str,
    value: str,
    group: str,
    output: str,
    keys: Sequence[str] = KEYS,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Number the stretches between sign flips of one column and sum another inside each.

    A flip is a row whose sign column times the previous row's is negative.
    """
    blocks = Blocks.of(positioned, before=1, keys=keys, rows=rows)
    plain, running = blocks.over(), blocks.over(running=True)
    blocks = blocks.with_exprs(
        {"__flip": f"own AND coalesce(`{sign}` * lag(`{sign}`) {plain} < 0, false)"}
    )
    blocks = blocks.with_exprs({"__group": f"sum(CAST(__flip AS BIGINT)) {running}"})
    stretch = running.replace(f"PARTITION BY {', '.join(keys)}", f"PARTITION BY {', '.join(keys)}, __group")
    blocks = blocks.with_exprs({"__inside": f"sum(CASE WHEN own THEN `{value}` END) {stretch}"})
    series = ", ".join(keys)
    blocks = blocks.carry(
        {"__groups": "max(__group)", "__tail": f"max_by(__inside, {POSITION})"},
        [
            {
                "__group_in": "coalesce(sum(__groups) OVER earlier, 0L)",
                "__segment": "sum(CAST(__groups > 0 AS BIGINT)) OVER blocks",
            },
            {"__open": f"sum(__tail) OVER (PARTITION BY {series}, __segment ORDER BY block)"},
            {"__start": "__group_in", "__sum_in": "lag(__open) OVER blocks"},
        ],
    )
    blocks = blocks.with_exprs(
        {
            group: "__group + __start",
            output: "CASE WHEN __group = 0 THEN __inside + coalesce(__sum_in, 0) ELSE __inside END",
        }
    )
    return blocks.drop("__flip", "__group", "__inside", "__start", "__sum_in").own_rows()
