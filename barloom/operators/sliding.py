"""Rolling statistics over whole columns of a block.

Spark deals the bars out to blocks and sorts them; a task then gets one block after the other as an
Arrow table, and every statistic is a few operations on whole columns. A window costs no frame per
row and no list, and the work per bar does not grow with the number of columns of the plan.

Missing values are NaN inside and NULL outside; a window with a missing value or one that is not
full has none. The functions travel to the workers by value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import types as T

from barloom.operators.blocks import BLOCK, OWN, POSITION, Blocks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Mean and central power sums (second to fourth) of ``n`` rows, with ``n`` first.
Moments = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]
#: Output columns of a block from its input columns, by name.
Statistics = Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]


def with_statistics(
    blocks: Blocks,
    inputs: dict[str, str],
    statistics: Sequence[Statistics],
    outputs: Sequence[str],
    keep: Sequence[str],
) -> Blocks:
    """Own rows with the columns ``keep`` and what ``statistics`` make of a block's ``inputs`` (SQL text).

    The grouping is that of the blocks' windows, so the rows are not exchanged again.
    """
    keep, outputs, at = list(keep), list(outputs), POSITION
    texts = [f"CAST({text} AS double) AS `{name}`" for name, text in inputs.items()]
    rows = blocks.df.selectExpr(*[f"`{c}`" for c in keep], *texts)
    doubles = [T.StructField(name, T.DoubleType()) for name in outputs]
    schema = T.StructType([rows.schema[c] for c in keep] + doubles)
    names, own = list(inputs), OWN

    def run(table: pa.Table) -> pa.Table:
        place = table.column(at).to_numpy()
        if np.any(place[1:] < place[:-1]):
            table = table.take(np.argsort(place, kind="stable"))
        values = {name: table.column(name).to_numpy() for name in names}
        made: dict[str, np.ndarray] = {}
        with np.errstate(all="ignore"):
            for statistic in statistics:
                made |= statistic(values)
        columns = [_in_utc(table.column(c)) for c in keep] + [pa.array(made[c], from_pandas=True) for c in outputs]
        return pa.Table.from_arrays(columns, names=keep + outputs).filter(table.column(own))

    return replace(blocks, df=rows.groupBy(*blocks.keys, BLOCK).applyInArrow(run, schema))


def _in_utc(column: pa.ChunkedArray) -> pa.ChunkedArray:
    """Times come in the session's zone and are given back in UTC; the instant is the same."""
    if pa.types.is_timestamp(column.type) and column.type.tz:
        return column.cast(pa.timestamp(column.type.unit, "UTC"))
    return column


def past(x: np.ndarray, rows: int) -> np.ndarray:
    """The value ``rows`` rows earlier."""
    out = np.full(len(x), np.nan)
    if rows < len(x):
        out[rows:] = x[: len(x) - rows]
    return out


def log_change(x: np.ndarray) -> np.ndarray:
    """``ln(v_t) - ln(v_{t-1})``; the logarithm of a non-positive value is missing."""
    logs = np.log(np.where(x > 0, x, np.nan))
    return logs - past(logs, 1)


# -- moments --------------------------------------------------------------------------------------


def merged_moments(a: Moments, b: Moments) -> Moments:
    """Moments of two adjoining row ranges, by the pairwise update formulas of the literature.

    Only differences of means enter, so a far-away level or a constant range costs no precision.
    """
    na, mean_a, a2, a3, a4 = a
    nb, mean_b, b2, b3, b4 = b
    n = na + nb
    d = mean_b - mean_a
    return (
        n,
        mean_a + d * (nb / n),
        a2 + b2 + d * d * (na * nb / n),
        a3 + b3 + d * d * d * (na * nb * (na - nb) / n**2) + d * (na * b2 - nb * a2) * (3 / n),
        a4
        + b4
        + d * d * d * d * (na * nb * (na * na - na * nb + nb * nb) / n**3)
        + d * d * (na * na * b2 + nb * nb * a2) * (6 / n**2)
        + d * (na * b3 - nb * a3) * (4 / n),
    )


def window_parts(n: int, known: Sequence[int]) -> list[int]:
    """Split a window into known shorter ones, longest first: 50 -> 20, 20, 10."""
    parts: list[int] = []
    while sum(parts) < n:
        fitting = [k for k in known if k <= n - sum(parts)]
        if not fitting:
            raise ValueError(f"window {n} cannot be composed of {list(known)}")
        parts.append(max(fitting))
    return parts


def moment_ladder(x: np.ndarray, lengths: Sequence[int]) -> dict[int, Moments]:
    """Mean and central sums over several window lengths.

    The shortest window is taken from shifted copies of the column; every longer one is glued from
    shorter windows that end at earlier rows (20 = 10 + 10, 50 = 20 + 20 + 10, ...). The work per bar
    does not grow with the window length.
    """
    lengths = sorted(set(lengths))
    base = lengths[0]
    gaps = [past(x, k) - x for k in range(1, base)]
    shift = sum(gaps, np.zeros(len(x))) / base
    centred = [-shift] + [gap - shift for gap in gaps]
    squares = [c * c for c in centred]
    ladder = {
        base: (
            base,
            x + shift,
            sum(squares),
            sum(q * c for q, c in zip(squares, centred)),
            sum(q * c * c for q, c in zip(squares, centred)),
        )
    }
    for index, n in enumerate(lengths[1:], start=1):
        first, *rest = window_parts(n, lengths[:index])
        newest = ladder[first]
        for part in rest:
            shifted = (part, *[past(column, newest[0]) for column in ladder[part][1:]])
            newest = merged_moments(shifted, newest)
        ladder[n] = newest
    return ladder


def population_std(m: Moments) -> np.ndarray:
    return np.sqrt(m[2] / m[0])


def sample_skewness(m: Moments) -> np.ndarray:
    """Bias-corrected skewness; 0 for a constant window."""
    n, _, m2, m3, _ = m
    value = (m3 / n) / (m2 / n) ** 1.5 * ((n * (n - 1)) ** 0.5 / (n - 2))
    return np.where(m2 == 0, 0.0, np.where(m2 > 0, value, np.nan))


def sample_kurtosis(m: Moments) -> np.ndarray:
    """Bias-corrected excess kurtosis; -3 for a constant window."""
    n, _, m2, _, m4 = m
    value = ((n + 1) * (n * m4 / (m2 * m2) - 3) + 6) * ((n - 1) / ((n - 2) * (n - 3)))
    return np.where(m2 == 0, -3.0, np.where(m2 > 0, value, np.nan))


def moment_features(
    column: str, averages: Sequence[int], shapes: Sequence[int], band: int, widths: Sequence[int]
) -> Statistics:
    """Moving averages, Bollinger bands, skewness and kurtosis from one ladder of moments."""

    def compute(values: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        ladder = moment_ladder(values[column], [*averages, *shapes, band])
        out = {f"SMA{n}": log_change(ladder[n][1]) for n in averages}
        out |= {f"SKEW{n}": sample_skewness(ladder[n]) for n in shapes}
        out |= {f"KURT{n}": sample_kurtosis(ladder[n]) for n in shapes}
        middle, std = ladder[band][1], population_std(ladder[band])
        for k in widths:
            tag = f"{band}_{k}.0"
            lower, upper = middle - k * std, middle + k * std
            for side, level in (("BBL", lower), ("BBM", middle), ("BBU", upper)):
                out[f"{side}_{tag}"] = log_change(level)
            out[f"BB_{tag}"] = upper - lower
        return out

    return compute


# -- other windows --------------------------------------------------------------------------------


def mean_deviation_scores(x: np.ndarray, scale: float, lengths: dict[str, int]) -> dict[str, np.ndarray]:
    """``(newest - mean) / (scale * mean absolute deviation)`` of the last ``n`` values, by column."""
    before = [past(x, k) for k in range(max(lengths.values()))]
    out = {}
    for name, n in lengths.items():
        mean = sum(reversed(before[:n]), np.zeros(len(x))) / n
        spread = (scale / n) * sum(np.abs(b - mean) for b in before[:n])
        out[name] = np.where(spread != 0, (x - mean) / spread, np.nan)
    return out


def mean_deviation_features(column: str, scale: float, lengths: dict[str, int]) -> Statistics:
    def compute(values: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        return mean_deviation_scores(values[column], scale, lengths)

    return compute


def rank_correlations(x: np.ndarray, lengths: dict[str, int]) -> dict[str, np.ndarray]:
    """Spearman correlations of the last ``n`` values with their time order, by output column.

    With average ranks, ``1 - 6 sum (rank - y)^2 / (n (n^2 - 1))`` equals
    ``(6 K + T / 2) / (n (n^2 - 1))``, where ``K`` sums ``(b - a) sign(x_b - x_a)`` over all pairs
    a < b of the window and ``T`` sums ``t^3 - t`` over the sizes of groups of equal values. Both
    slide: the entering row adds its pairs with the rows before it, the leaving one takes its pairs
    with the rows after it along; a row with ``c`` equals in the window changes ``T`` by
    ``3 c (c + 1)``. They are running sums of whole numbers, so they are exact and start at any row
    of a block.
    """
    size = len(x)
    parts = {name: np.zeros((4, size)) for name in lengths}  # signs in and out, equals in and out
    for k in range(1, min(size, max(lengths.values()))):
        newer, older = x[k:], x[:-k]
        signs = (newer > older).astype(float) - (newer < older)
        signs *= k
        equal = newer == older
        for name, n in lengths.items():
            if k >= n:
                continue
            sums = parts[name]
            sums[0, k:] += signs
            sums[2, k:] += equal
            # The older row of a pair leaves the window n - k rows after the newer one enters.
            left = max(0, size - n)
            sums[1, n:] += signs[:left]
            sums[3, n:] += equal[:left]
    there = np.concatenate([[0], np.cumsum(~np.isnan(x))])
    out = {}
    for name, n in lengths.items():
        enter, leave, same, gone = parts[name]
        pairs = np.cumsum(enter - leave)
        ties = np.cumsum(3 * (same * (same + 1) - gone * (gone + 1)))
        full = np.zeros(size, bool)
        full[n - 1 :] = there[n:] - there[:-n] == n if size >= n else False
        out[name] = np.where(full, (6 * pairs + ties / 2) / (n * (n * n - 1)), np.nan)
    return out


def rank_features(column: str, lengths: dict[str, int]) -> Statistics:
    def compute(values: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        return rank_correlations(values[column], lengths)

    return compute
