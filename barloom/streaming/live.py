"""Features and order prices of bars as they arrive, from state kept per symbol.

A trigger reads its own bars only. What older bars contribute is kept as streaming state: the newest
``TAIL`` bars, the exponential sums, and the two seeded means and the signal of the MACD. The
definitions are those of :mod:`barloom.operators.features`, worked out over a symbol's new rows in
numpy; every symbol is a group of its own and the engine spreads them and restores their state.

Bars at or before the newest one seen are repeats of an overlapping pull and are left out; of bars
with one time in a batch one stays. A batch's new bars of a symbol are in memory together, so let
the source bound its batches (``maxFilesPerTrigger``) when it catches up.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barloom import schema as S
from barloom.operators import ewm
from barloom.operators.signals import ENTRY_LENGTHS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Older bars that a feature looks at: the longest mean, and one more for its change.
TAIL = 200
#: Columns with the newest highs and lows, from which a symbol's own signal takes its extremes.
RECENT = {"recent_high": "high", "recent_low": "low"}

# Plain copies: functions that travel to the workers must not need this package there.
_GROUPS = {group: tuple(names) for group, names in S.FEATURE_GROUPS.items()}
_FIELDS, _NAMES = tuple(S.OHLCV), tuple(S.FEATURES)
_SMA, _EMA, _MOM, _ROC, _REG = S.SMA_LENGTHS, S.EMA_COMS, S.MOM_LENGTHS, S.ROC_LENGTHS, S.REG_LENGTHS
_ATR, _RSI, _RCI, _WIDTHS = S.ATR_LENGTHS, S.RSI_LENGTHS, S.RCI_LENGTHS, S.BB_WIDTHS
_CCI, _CCI_SCALE, _MOMENTS = S.CCI_LENGTHS, S.CCI_SCALE, S.MOMENT_LENGTHS
_FAST, _SLOW, _SIGNAL, _KEPT = S.MACD_FAST, S.MACD_SLOW, S.MACD_SIGNAL, ENTRY_LENGTHS[1]
_DECAYS = np.array(
    [ewm.decay_of_com(c) for c in _EMA] + [ewm.decay_of_length(n) for n in (*_ATR, *_RSI, *_RSI)]
)

_STATE = "rows bigint, newest bigint, tail array<double>, sums array<double>, macd array<double>"


class _Windows:
    """The newest ``n`` values before and at every asked-for row."""

    def __init__(self, values: np.ndarray, rows: np.ndarray, first: int):
        self.values, self.rows, self.first = values, rows, first

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Which rows have ``n`` values, and the windows of those."""
        full = (self.first + self.rows >= n - 1) & (self.rows >= n - 1)
        at = self.rows[full]
        return full, self.values[at[:, None] + np.arange(1 - n, 1)]

    def apply(self, n: int, f) -> np.ndarray:  # noqa: ANN001
        out = np.full(len(self.rows), np.nan)
        full, windows = self.of(n)
        if len(windows):
            out[full] = f(windows)
        return out


def _log(x: np.ndarray) -> np.ndarray:
    return np.log(x, out=np.full(len(x), np.nan), where=x > 0)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.full(len(a), np.nan), where=b != 0)


def _rank_correlation(x: np.ndarray) -> np.ndarray:
    """Spearman with the time order, average ranks, a distance at a time."""
    n = x.shape[1]
    pairs, equal = np.zeros(len(x)), np.ones(x.shape)
    for k in range(1, n):
        newer, older = x[:, k:], x[:, :-k]
        pairs += k * np.sign(newer - older).sum(1)
        same = newer == older
        equal[:, k:] += same
        equal[:, :-k] += same
    return (6 * pairs + (equal * equal - 1).sum(1) / 2) / (n * (n * n - 1))


def _endpoint(x: np.ndarray) -> np.ndarray:
    """Newest point of the least-squares line."""
    n = x.shape[1]
    t = np.arange(n) - (n - 1) / 2
    return x @ (1 / n + t * t[-1] / (t * t).sum())


def _moment(x: np.ndarray, power: int) -> np.ndarray:
    """Sample skewness or excess kurtosis; constant windows have the values of their definition."""
    n = x.shape[1]
    centred = x - x.mean(1, keepdims=True)
    flat = x.max(1) == x.min(1)
    m2 = np.where(flat, 1.0, (centred**2).mean(1))
    if power == 3:
        value = math.sqrt(n * (n - 1)) / (n - 2) * (centred**3).mean(1) / m2**1.5
        return np.where(flat, 0.0, value)
    value = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (centred**4).mean(1) / m2**2 - 3 * (n - 1))
    return np.where(flat, -3.0, value)


def _index(x: np.ndarray) -> np.ndarray:
    mean = x.mean(1)
    return _ratio(x[:, -1] - mean, _CCI_SCALE * np.abs(x - mean[:, None]).mean(1))


def _advance(bars: np.ndarray, old: int, first: int, sums: np.ndarray, macd: np.ndarray) -> tuple:
    """Exponential sums before and after every new row, and MACD, signal and state at its end.

    ``macd`` holds the fast and the slow mean, the signal, and the newest values of the MACD.
    """
    high, low, close = bars[:, 1], bars[:, 2], bars[:, 3]
    fast, slow, signal = macd[:3]
    recent = list(macd[3:])
    kept, lines = [sums], []
    for j in range(old, len(bars)):
        place = first + j
        change = close[j] - close[j - 1] if place else 0.0
        width = high[j] - low[j]
        if place:
            width = max(abs(width), abs(high[j] - close[j - 1]), abs(close[j - 1] - low[j]))
        up, down = max(change, 0.0), max(-change, 0.0)
        entering = [close[j]] * len(_EMA) + [abs(width)] * len(_ATR) + [up] * len(_RSI) + [down] * len(_RSI)
        sums = _DECAYS * sums + entering
        kept.append(sums)
        means = []
        for value, n in ((fast, _FAST), (slow, _SLOW)):
            alpha = 2.0 / (n + 1)
            if place == n - 1:
                value = close[j - n + 1 : j + 1].mean()
            elif place >= n:
                value = (1 - alpha) * value + alpha * close[j]
            means.append(value)
        fast, slow = means
        line = fast - slow if place >= _SLOW - 1 else np.nan
        recent = [*recent, line][-_SIGNAL:]
        start = _SLOW + _SIGNAL - 2
        alpha = 2.0 / (_SIGNAL + 1)
        if place == start:
            signal = float(np.mean(recent))
        elif place > start:
            signal = (1 - alpha) * signal + alpha * line
        lines.append((line, signal))
    return np.array(kept), np.array(lines), np.array([fast, slow, signal, *recent])


def _feature_rows(bars: np.ndarray, times: pd.Series, old: int, first: int, kept: np.ndarray, lines: np.ndarray) -> dict:
    """All features of the rows from ``old`` on; ``first`` is the position of the first row."""
    rows = np.arange(old, len(bars))
    place = first + rows
    close = bars[:, 3]
    out: dict[str, np.ndarray] = {}

    def change(level: np.ndarray) -> np.ndarray:
        """Log change; levels start a row before the first new one."""
        logs = _log(level)
        return logs[1:] - logs[:-1]

    both = np.arange(max(old, 1) - 1, len(bars))
    now, with_last = _Windows(close, rows, first), _Windows(close, both, first)

    def changes(n: int, f) -> np.ndarray:  # noqa: ANN001
        level = change(with_last.apply(n, f))
        return level if old else np.append(np.nan, level)

    def back(n: int) -> np.ndarray:
        return np.where(rows >= n, close[np.maximum(rows - n, 0)], np.nan)

    day, hour = times.dt.day.to_numpy(), times.dt.hour.to_numpy()
    for name, f, value in zip(_GROUPS["time"], (math.sin, math.cos) * 2, (day, day, hour, hour)):
        out[name] = np.array([f(v) for v in value.tolist()])
    for k, name in enumerate(_FIELDS):
        logs = _log(bars[:, k])
        out[f"{name}_log_diff"] = np.where(rows > 0, logs[rows] - logs[rows - 1], np.nan)
    for n in _SMA:
        out[f"SMA{n}"] = changes(n, lambda x: x.mean(1))
    for k, n in enumerate(_EMA):
        d = _DECAYS[k]
        after, before = (1 - d ** (place + 1)) / (1 - d), (1 - d**place) / (1 - d)
        level, last = kept[1:, k] / after, _ratio(kept[:-1, k], before)
        out[f"EMA{n}"] = _log(level) - _log(np.nan_to_num(last, nan=-1.0))
    for n in _MOM:
        out[f"MOM{n}"] = close[rows] - back(n)
    for n in _ROC:
        out[f"ROC{n}"] = _ratio(100 * (close[rows] - back(n)), back(n))
    for n in _REG:
        out[f"REG{n}"] = changes(n, _endpoint)
    for k, n in enumerate(_ATR, start=len(_EMA)):
        d = _DECAYS[k]
        out[f"ATR{n}"] = np.where(place >= n - 1, kept[1:, k] / ((1 - d ** (place + 1)) / (1 - d)), np.nan)
    start = len(_EMA) + len(_ATR)
    for k, n in enumerate(_RSI):
        up, down = kept[1:, start + k], kept[1:, start + len(_RSI) + k]
        out[f"RSI{n}"] = np.where(place >= n, _ratio(100 * up, up + down), np.nan)
    for n in _RCI:
        out[f"RCI{n}"] = now.apply(n, _rank_correlation)
    for k in _WIDTHS:
        for side, sign in (("BBL", -k), ("BBM", 0), ("BBU", k)):
            out[f"{side}_20_{k}.0"] = changes(20, lambda x, s=sign: x.mean(1) + s * x.std(1))
        out[f"BB_20_{k}.0"] = now.apply(20, lambda x, s=k: 2 * s * x.std(1))
    line, signal = lines[:, 0], np.where(place >= _SLOW + _SIGNAL - 2, lines[:, 1], np.nan)
    for name, value in zip(_GROUPS["macd"], (line, line - signal, signal)):
        out[name] = value
    typical = _Windows((bars[:, 1] + bars[:, 2] + close) / 3, rows, first)
    for n in _CCI:
        out[f"CCI{n}"] = typical.apply(n, _index)
    for n in _MOMENTS:
        out[f"SKEW{n}"] = now.apply(n, lambda x: _moment(x, 3))
        out[f"KURT{n}"] = now.apply(n, lambda x: _moment(x, 4))
    return out


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy().astype("datetime64[us]").astype(np.int64)


def live_features(bars: DataFrame) -> DataFrame:
    """A stream of bars ``(symbol, ts, open, high, low, close, volume)`` with all features.

    One row per new bar with complete features, and the newest highs and lows as arrays, oldest
    first (:data:`RECENT`).
    """
    numbers = ", ".join(f"`{c}` double" for c in (*_FIELDS, *_NAMES))
    arrays = ", ".join(f"{c} array<double>" for c in RECENT)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(batches)).sort_values(["ts", *_FIELDS]).drop_duplicates("ts", keep="last")
        count, newest, tail = 0, None, np.zeros((0, len(_FIELDS)))
        sums, macd = np.zeros(len(_DECAYS)), np.full(3, np.nan)
        if state.exists:
            count, newest, flat, sums, macd = state.get
            tail = np.array(flat, float).reshape(-1, len(_FIELDS))
            sums, macd = np.array(sums, float), np.array([np.nan if x is None else x for x in macd], float)
            new = new[_micros(new.ts) > newest]
        if new.empty:
            return
        table = np.concatenate([tail, new[list(_FIELDS)].to_numpy(float)])
        old, first = len(tail), count - len(tail)
        kept, lines, macd = _advance(table, old, first, sums, macd)
        values = _feature_rows(table, new.ts, old, first, kept, lines)
        out = pd.DataFrame({"symbol": key[0], "ts": new.ts.to_numpy()})
        for k, c in enumerate(_FIELDS):
            out[c] = table[old:, k]
        out = pd.concat([out, pd.DataFrame({n: values[n] for n in _NAMES})], axis=1)
        for name, k in (("recent_high", 1), ("recent_low", 2)):
            out[name] = [table[max(0, j + 1 - _KEPT) : j + 1, k].tolist() for j in range(old, len(table))]
        last = int(_micros(new.ts)[-1])
        plain = [None if math.isnan(x) else float(x) for x in macd]
        state.update((count + len(new), last, table[-TAIL:].ravel().tolist(), kept[-1].tolist(), plain))
        yield out[~out[list(_NAMES)].isna().any(axis=1)]

    rows = bars.select("symbol", F.col("ts").cast("timestamp").alias("ts"), *_FIELDS)
    return rows.groupBy("symbol").applyInPandasWithState(
        step,
        f"symbol string, ts timestamp, {numbers}, {arrays}",
        _STATE,
        "append",
        GroupStateTimeout.NoTimeout,
    )
