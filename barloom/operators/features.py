"""The sixty technical features of a bar series."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import zip_longest

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.functions.scalars import all_present, number, quoted
from barloom.operators import ewm, rolling, sliding
from barloom.operators.blocks import BLOCK_ROWS, LENGTH, POSITION, Blocks, with_position
from barloom.operators.rolling import Stages, lag

#: Longest look-back: a 200-row window, one row earlier for its log difference.
LOOKBACK = 200

#: Groups that read high and low as well and so exist for the close price only.
CLOSE_ONLY = ("atr", "cci")


def positive_ln(value: str) -> str:
    """Logarithm of a positive value, NULL otherwise."""
    return f"CASE WHEN {value} > 0 THEN ln({value}) END"


def log_change(blocks: Blocks, name: str) -> str:
    """``ln(v_t) - ln(v_{t-1})`` of a named column."""
    return f"{positive_ln(f'`{name}`')} - {positive_ln(lag(blocks, name))}"


# -- groups from bounded windows ------------------------------------------------------------------


def _time(blocks: Blocks, target: str) -> Stages:
    day, hour = f"day({S.TS})", f"hour({S.TS})"
    return [
        {
            "day_sin": f"sin({day})",
            "day_cos": f"cos({day})",
            "hour_sin": f"sin({hour})",
            "hour_cos": f"cos({hour})",
        }
    ]


def _log_diff(blocks: Blocks, target: str) -> Stages:
    return [{f"{c}_log_diff": log_change(blocks, c) for c in S.OHLCV}]


def _reg(blocks: Blocks, target: str) -> Stages:
    return [
        {f"__REG{n}": rolling.line_endpoint(blocks, target, n) for n in S.REG_LENGTHS},
        {f"REG{n}": log_change(blocks, f"__REG{n}") for n in S.REG_LENGTHS},
    ]


def _mom(blocks: Blocks, target: str) -> Stages:
    return [{f"MOM{n}": f"`{target}` - {lag(blocks, target, n)}" for n in S.MOM_LENGTHS}]


def _roc(blocks: Blocks, target: str) -> Stages:
    stage = {}
    for n in S.ROC_LENGTHS:
        past = lag(blocks, target, n)
        stage[f"ROC{n}"] = f"try_divide(100D * (`{target}` - {past}), {past})"
    return [stage]


_WINDOWED = {
    "time": _time,
    "log_diff": _log_diff,
    "reg": _reg,
    "mom": _mom,
    "roc": _roc,
}


# -- groups from whole columns of a block ---------------------------------------------------------


def _moments() -> sliding.Statistics:
    return sliding.moment_features(
        "__value", S.SMA_LENGTHS, S.MOMENT_LENGTHS, S.BB_LENGTH, S.BB_WIDTHS
    )


def _cci() -> sliding.Statistics:
    lengths = dict(zip(S.FEATURE_GROUPS["cci"], S.CCI_LENGTHS))
    return sliding.mean_deviation_features("__typical", S.CCI_SCALE, lengths)


def _rci() -> sliding.Statistics:
    return sliding.rank_features("__value", dict(zip(S.FEATURE_GROUPS["rci"], S.RCI_LENGTHS)))


_STATISTICS = {
    "sma": _moments,
    "bb": _moments,
    "bb_width": _moments,
    "skew": _moments,
    "kurt": _moments,
    "cci": _cci,
    "rci": _rci,
}


def _statistics(blocks: Blocks, groups: list[str], target: str, keep: list[str]) -> Blocks:
    """The groups above from one pass over every block; the rows are those of the block itself."""
    makers = [make() for make in dict.fromkeys(_STATISTICS[g] for g in groups)]
    inputs = {"__value": f"`{target}`"}
    if "cci" in groups:
        inputs["__typical"] = "(high + low + close) / 3D"

    names = [name for g in groups for name in S.FEATURE_GROUPS[g]]
    return sliding.with_statistics(blocks, inputs, makers, names, keep)


# -- groups from exponential sums -----------------------------------------------------------------


def _ema_scans(target: str) -> dict[str, ewm.Scan]:
    return {f"__EMA{com}": ewm.Scan(f"`{target}`", ewm.decay_of_com(com)) for com in S.EMA_COMS}


def _ema_levels(target: str) -> dict[str, str]:
    """Every mean now and one row before, as columns of their own: the logarithms read them twice."""
    levels = {}
    for name, scan in _ema_scans(target).items():
        levels[f"{name}_now"] = f"{name} / {ewm.weight_sum(scan.decay)}"
        levels[f"{name}_then"] = f"try_divide({name}_before, {ewm.weight_sum(scan.decay, start=1)})"
    return levels


def _ema(target: str) -> dict[str, str]:
    columns = {}
    for name in _ema_scans(target):
        change = f"({positive_ln(f'{name}_now')}) - ({positive_ln(f'{name}_then')})"
        columns[name[2:]] = f"CASE WHEN {POSITION} > 0 THEN {change} END"
    return columns


def _true_range(blocks: Blocks) -> str:
    """Widest of the bar's range and the moves from the last close; high - low on row 0."""
    previous = lag(blocks, "close")
    return f"greatest(abs(high - low), abs(high - {previous}), abs({previous} - low))"


def _atr_scans(target: str) -> dict[str, ewm.Scan]:
    return {f"__ATR{n}": ewm.Scan("__tr", ewm.decay_of_length(n)) for n in S.ATR_LENGTHS}


def _atr(target: str) -> dict[str, str]:
    return {
        f"ATR{n}": ewm.adjusted_mean(f"__ATR{n}", ewm.decay_of_length(n), min_rows=n)
        for n in S.ATR_LENGTHS
    }


def _rsi_scans(target: str) -> dict[str, ewm.Scan]:
    # The first difference is missing and enters neither sum.
    scans = {}
    for n in S.RSI_LENGTHS:
        d = ewm.decay_of_length(n)
        scans[f"__up{n}"] = ewm.Scan("CASE WHEN __change > 0 THEN __change END", d)
        scans[f"__down{n}"] = ewm.Scan("CASE WHEN __change < 0 THEN -__change END", d)
    return scans


def _rsi(target: str) -> dict[str, str]:
    # Both means share one normalisation, which cancels in the ratio.
    return {
        f"RSI{n}": f"CASE WHEN {POSITION} >= {n} THEN"
        f" try_divide(100D * __up{n}, __up{n} + __down{n}) END"
        for n in S.RSI_LENGTHS
    }


_MACD_MEANS = {"__fast": S.MACD_FAST, "__slow": S.MACD_SLOW}


def _macd_scans(target: str) -> dict[str, ewm.Scan]:
    return {
        name: ewm.Scan(ewm.seeded_input(f"`{target}`", f"{name}_seed", n), ewm.decay_of_span(n))
        for name, n in _MACD_MEANS.items()
    }


def _macd(blocks: Blocks) -> Blocks:
    """Difference of two seeded means, its own seeded mean, and the gap between both."""
    first, length = S.MACD_SLOW - 1, S.MACD_SIGNAL
    # Halo rows carry no exponential sums, so the signal's seed averages own rows only; it is
    # needed once per series, in block 0, which has no halo.
    blocks = blocks.with_exprs(
        {"MACD_12_26_9": f"CASE WHEN own AND {POSITION} >= {first} THEN __fast - __slow END"}
    )
    blocks = blocks.with_exprs({"__signal_seed": f"avg(MACD_12_26_9) {blocks.over(length)}"})
    signal = ewm.seeded_input("MACD_12_26_9", "__signal_seed", length, start=first)
    blocks = ewm.exponential_sums(
        blocks, {"__signal": ewm.Scan(signal, ewm.decay_of_span(length))}
    )
    blocks = blocks.with_exprs(
        {"MACDs_12_26_9": f"CASE WHEN {POSITION} >= {first + length - 1} THEN __signal END"}
    )
    return blocks.with_exprs({"MACD_h12_26_9": "MACD_12_26_9 - MACDs_12_26_9"})


_SCANS = {"ema": _ema_scans, "atr": _atr_scans, "rsi": _rsi_scans, "macd": _macd_scans}


def _exponential(blocks: Blocks, groups: list[str], target: str) -> Blocks:
    """All exponential features: one scan for the prices, a second one for the MACD signal."""
    inputs: dict[str, str] = {}
    if "atr" in groups:
        inputs["__tr"] = _true_range(blocks)
    if "rsi" in groups:
        inputs["__change"] = f"`{target}` - {lag(blocks, target)}"
    if "macd" in groups:
        for name, n in _MACD_MEANS.items():
            inputs[f"{name}_seed"] = f"avg(`{target}`) {blocks.over(n)}"
    scans: dict[str, ewm.Scan] = {}
    for group in groups:
        scans |= _SCANS[group](target)
    before = list(_ema_scans(target)) if "ema" in groups else []
    blocks = ewm.exponential_sums(blocks.with_exprs(inputs), scans, before)
    # One projection each: a generated method of more than 8000 bytes is never compiled by the JVM.
    for group, finish in (("ema", _ema_levels), ("ema", _ema), ("atr", _atr), ("rsi", _rsi)):
        if group in groups:
            blocks = blocks.with_exprs(finish(target))
    return _macd(blocks) if "macd" in groups else blocks


# -- public ---------------------------------------------------------------------------------------


def add_features(blocks: Blocks, groups: Iterable[str], target: str = "close") -> Blocks:
    """Add the features of several groups to a blocked table.

    The exponential groups come first: their carry join then duplicates only a short plan. The
    stages of short looks back are merged, one window pass per stage. Statistics of long windows come
    last, and then the halo is dropped.
    """
    groups = list(groups)
    keep = list(blocks.df.columns)
    exponential = [g for g in groups if g in _SCANS]
    if exponential:
        blocks = _exponential(blocks, exponential, target)
    makers = list(dict.fromkeys(_WINDOWED[g] for g in groups if g in _WINDOWED))
    for stages in zip_longest(*[make(blocks, target) for make in makers], fillvalue={}):
        merged: dict[str, str] = {}
        for stage in stages:
            merged |= stage
        blocks = blocks.with_exprs(merged)
    long = [g for g in groups if g in _STATISTICS]
    if long:
        keep += [name for g in groups if g not in _STATISTICS for name in S.FEATURE_GROUPS[g]]
        blocks = _statistics(blocks, long, target, keep)
    return blocks


def features(
    bars: DataFrame,
    groups: Iterable[str] | None = None,
    target: str = "close",
    drop_incomplete: bool | None = None,
    block_rows: int = BLOCK_ROWS,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Bars with feature columns, one block exchange for all of them.

    ``groups`` picks feature groups (all by default); unused windows are never planned.
    Rows with any NULL go when the full set is asked for, or as ``drop_incomplete`` says.
    With a target other than ``close`` the feature columns carry its name as a prefix and
    the groups that need the whole bar are left out. ``keep`` names further input columns, such
    as the position.
    """
    chosen = list(S.FEATURE_GROUPS) if groups is None else list(groups)
    unknown = [g for g in chosen if g not in S.FEATURE_GROUPS]
    if unknown:
        raise ValueError(f"unknown feature groups {unknown}; choose from {list(S.FEATURE_GROUPS)}")
    if target not in S.OHLCV:
        raise ValueError(f"target must be one of {S.OHLCV}")
    if target != "close":
        chosen = [g for g in chosen if g not in CLOSE_ONLY]
    positioned = bars if POSITION in bars.columns else with_position(bars)
    # The length is the same in a whole series; as a key of the windows it lets short ones pass once.
    keys = (S.SYMBOL, LENGTH)
    blocks = Blocks.of(positioned, before=LOOKBACK, keys=keys, rows=block_rows)
    blocks = add_features(blocks, chosen, target)
    names = [name for g in S.FEATURE_GROUPS if g in chosen for name in S.FEATURE_GROUPS[g]]
    prefix = "" if target == "close" else f"{target}_"
    base = (S.SYMBOL, S.TS, *S.OHLCV, *keep)
    out = blocks.own_rows(*base, *[quoted(name) for name in names])
    if drop_incomplete if drop_incomplete is not None else groups is None:
        out = out.where(all_present(out.columns))
    if prefix:
        out = out.withColumnsRenamed({name: prefix + name for name in names})
    return out
