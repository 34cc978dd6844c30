"""Rolling statistics over the newest ``n`` rows.

Statistics are given as *stages*: lists of ``{column: SQL expression}`` in which a later stage may
look back (``lag``) at columns of an earlier one. Stages of independent statistics are merged, so
the planner sees one Window node per stage, not one per statistic.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.scalars import number
from barloom.operators.blocks import Blocks, full

Stages = list[dict[str, str]]


def lag(blocks: Blocks, name: str, rows: int = 1) -> str:
    return f"lag(`{name}`, {rows}) {blocks.over()}" if rows else f"`{name}`"


# -- simple windows -------------------------------------------------------------------------------


def rolling_max(blocks: Blocks, value: str, n: int) -> Column:
    return full(blocks.last(n), n, value, F.max(value).over(blocks.last(n)))


def rolling_min(blocks: Blocks, value: str, n: int) -> Column:
    return full(blocks.last(n), n, value, F.min(value).over(blocks.last(n)))


def line_endpoint(blocks: Blocks, value: str, n: int) -> str:
    """Value at the newest row of the least-squares line through the last ``n`` rows.

    The fitted end value is a fixed weighted sum of the window: the row ``k`` bars back has
    weight ``2 (2n - 1 - 3k) / (n (n + 1))``.
    """
    return " + ".join(
        f"{lag(blocks, value, k)} * {number(2.0 * (2 * n - 1 - 3 * k) / (n * (n + 1)))}"
        for k in range(n)
    )


def window_values(blocks: Blocks, value: str, n: int) -> str:
    """The last ``n`` values as an array, oldest first."""
    return f"collect_list(`{value}`) {blocks.over(n)}"


def rolling_apply(
    positioned: DataFrame, value: str, n: int, fn: Callable, output: str, rows: int = 2048
) -> DataFrame:
    """Apply a Python function to all full windows of a batch at once.

    ``fn`` gets a numpy table with one window of ``n`` values per row, oldest first, and returns
    one number per row. Rows whose window is not full get NULL.
    """

    def whole(batch: pa.Array) -> pa.Array:
        ends = batch.offsets.to_numpy()
        values = batch.values.to_numpy(zero_copy_only=False)
        complete = np.diff(ends) == n
        table = values[(ends[1:][complete] - n)[:, None] + np.arange(n)]
        result = np.zeros(len(complete))
        if len(table):
            result[complete] = fn(table)
        return pa.array(result, mask=~complete)

    apply = F.arrow_udf(whole, T.DoubleType())

    blocks = Blocks.of(positioned, before=n - 1, rows=rows)
    blocks = blocks.with_exprs({"__window": window_values(blocks, value, n)})
    return blocks.own_rows().withColumn(output, apply("__window")).drop("__window")
