"""Exponential means as a blocked scan.

With decay ``d = 1 - alpha`` the weighted sum ``S_t = y_t + d * S_{t-1}`` is the recursion behind
every exponential mean. Inside a block it is a running sum of ``y * d^-offset`` scaled back by
``d^offset``; the sum that enters a block folds the totals of the blocks before it. No row depends
on another task's rows. Older rows and blocks are left out only where their weight is exactly zero
in a double, below ``e^-745``, as it is in the row-by-row recursion.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from barloom.functions.scalars import number
from barloom.operators.blocks import BLOCK, POSITION, Blocks

#: ``d^-offset`` must stay inside a double with room for the data; faster decays fold rows.
_MAX_EXPONENT = 600.0
#: ``e^-746`` is zero in a double.
_ZERO_EXPONENT = 746.0


@dataclass(frozen=True)
class Scan:
    """One exponential sum: input expression as SQL text (NULL counts as 0) and decay."""

    value: str
    decay: float


def decay_of_com(com: float) -> float:
    """Decay for a centre of mass: alpha = 1 / (1 + com)."""
    return 1.0 - 1.0 / (1.0 + com)


def decay_of_length(length: int) -> float:
    """Decay of Wilder's mean: alpha = 1 / length."""
    return 1.0 - 1.0 / length


def decay_of_span(span: int) -> float:
    """Decay for a span: alpha = 2 / (span + 1)."""
    return 1.0 - 2.0 / (span + 1.0)


def _reach(decay: float, rows: int = 1) -> int:
    """Steps of ``rows`` rows after which a weight is zero."""
    return math.ceil(_ZERO_EXPONENT / (-math.log(decay) * rows)) + 1


def _folded(values: str, decay: float) -> str:
    """The sum that a list of inputs, oldest first, leaves behind."""
    return f"aggregate({values}, 0D, (s, y) -> s * {number(decay)} + y)"


def exponential_sums(
    blocks: Blocks, scans: dict[str, Scan], previous: Sequence[str] = ()
) -> Blocks:
    """Add ``S_t`` for every scan, all sharing one window pass and one carry join.

    Scans named in ``previous`` also get ``<name>_before``, the sum of the row before.
    """
    rows = blocks.rows
    offset = f"({POSITION} - {BLOCK} * {rows})"
    series = f"PARTITION BY {', '.join(blocks.keys)} ORDER BY {BLOCK}"
    inputs, local, totals, carried, sums = {}, {}, {}, {}, {}
    for name, scan in scans.items():
        if not 0.0 < scan.decay < 1.0:
            raise ValueError(f"{name}: decay must lie strictly between 0 and 1")
        y, inside, entering = f"__y_{name}", f"__l_{name}", f"__c_{name}"
        d = number(scan.decay)
        inputs[y] = f"CASE WHEN own THEN coalesce({scan.value}, 0D) ELSE 0D END"
        if -math.log(scan.decay) * rows <= _MAX_EXPONENT:
            running = blocks.over(running=True)
            local[inside] = f"pow({d}, {offset}) * sum({y} * pow({d}, -{offset})) {running}"
        else:
            local[inside] = _folded(f"collect_list({y}) {blocks.over(_reach(scan.decay))}", scan.decay)
        totals[f"__t_{name}"] = f"sum({y} * pow({d}, {rows - 1} - {offset}))"
        frame = f"ROWS BETWEEN {_reach(scan.decay, rows)} PRECEDING AND 1 PRECEDING"
        carried[entering] = _folded(
            f"collect_list(__t_{name}) OVER ({series} {frame})", scan.decay**rows
        )
        sums[name] = f"CASE WHEN {entering} = 0D THEN {inside} ELSE {inside} + pow({d}, {offset} + 1) * {entering} END"
    blocks = blocks.with_exprs(inputs).with_exprs(local).carry(totals, carried, "0D").with_exprs(sums)
    before = {
        f"{name}_before": f"CASE WHEN {offset} = 0 THEN __c_{name} ELSE lag({name}) {blocks.over()} END"
        for name in previous
    }
    return blocks.with_exprs(before).drop(*inputs, *local, *carried)


def weight_sum(decay: float, start: int = 0) -> str:
    """Sum of the weights since series row ``start``: ``1 + d + ... + d^(i - start)``."""
    return f"((1D - pow({number(decay)}, {POSITION} - {start} + 1)) / {number(1.0 - decay)})"


def adjusted_mean(name: str, decay: float, start: int = 0, min_rows: int = 1) -> str:
    """Weighted mean with full normalisation (``adjust=True``), NULL before ``min_rows`` values."""
    first = start + min_rows - 1
    return f"CASE WHEN {POSITION} >= {first} THEN {name} / {weight_sum(decay, start)} END"


def seeded_input(value: str, seed: str, length: int, start: int = 0) -> str:
    """Input that turns the plain sum into a mean seeded with a simple average.

    The seed enters at row ``start + length - 1``; later rows enter with weight alpha.
    """
    first = start + length - 1
    alpha = number(2.0 / (length + 1.0))
    return (
        f"CASE WHEN {POSITION} = {first} THEN {seed}"
        f" WHEN {POSITION} > {first} THEN {alpha} * {value} ELSE 0D END"
    )
