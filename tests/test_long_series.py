"""Series over many blocks: long flat stretches, zero volume, decays that do not suit the block."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from barloom import schema as S
from barloom.operators.blocks import Blocks, with_position
from barloom.operators.ewm import Scan, exponential_sums
from barloom.operators.features import features
from helpers import by_symbol, close_to, to_spark


@pytest.fixture(scope="module")
def flat_bars():
    """Moves for 600 rows, stands still for 1,500, moves again; volume ends after row 900."""
    rng = np.random.default_rng(11)
    n = 2600
    close = 100 + np.round(rng.normal(0, 1, n).cumsum(), 1)
    close[600:2100] = close[600]
    close[2100:] += close[600] - close[2100]
    close = close - close.min() + 5
    open_ = np.append(close[:1], close[:-1])
    still = (np.arange(n) >= 600) & (np.arange(n) < 2100)
    spread = np.where(still, 0.0, 0.5)
    volume = np.where(np.arange(n) < 900, rng.integers(1, 50, n), 0).astype(float)
    volume[2400] = 3.0
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n) * 15, unit="min")
    return pd.DataFrame(
        {
            "symbol": "A", "ts": ts, "open": open_, "high": np.maximum(open_, close) + spread,
            "low": np.minimum(open_, close) - spread, "close": close, "volume": volume,
        }
    )


def log_change(mean: pd.Series) -> pd.Series:
    log = np.log(mean.where(mean > 0))
    return log - log.shift()


@pytest.mark.parametrize("rows", [256, 512, 8192])
def test_exponential_features_over_flat_stretches(spark, flat_bars, rows):
    bars = to_spark(spark, flat_bars)
    got = by_symbol(features(bars, ["ema", "rsi", "atr", "macd"], block_rows=rows))["A"]
    close = flat_bars.close
    for com in S.EMA_COMS:
        close_to(got[f"EMA{com}"], log_change(close.ewm(com=com, adjust=True).mean()), 1e-8)
    move = close.diff()
    for n in S.RSI_LENGTHS:
        up, down = (m.clip(lower=0).ewm(alpha=1 / n, adjust=True).mean() for m in (move, -move))
        want = (100 * up / (up + down)).where(np.arange(len(close)) >= n)
        close_to(got[f"RSI{n}"], want, 1e-8)
    before = close.shift()
    true_range = pd.concat(
        [flat_bars.high - flat_bars.low, (flat_bars.high - before).abs(), (before - flat_bars.low).abs()], axis=1
    ).max(axis=1)
    for n in S.ATR_LENGTHS:
        want = true_range.ewm(alpha=1 / n, adjust=True, min_periods=n).mean()
        close_to(got[f"ATR{n}"], want, 1e-8)

    def seeded(x: np.ndarray, n: int, first: int) -> np.ndarray:
        out = np.full(len(x), np.nan)
        out[first + n - 1] = x[first : first + n].mean()
        for i in range(first + n, len(x)):
            out[i] = out[i - 1] + 2 / (n + 1) * (x[i] - out[i - 1])
        return out

    macd = seeded(close.to_numpy(), 12, 0) - seeded(close.to_numpy(), 26, 0)
    macd[:25] = np.nan
    close_to(got["MACD_12_26_9"], pd.Series(macd), 1e-8)
    close_to(got["MACDs_12_26_9"], pd.Series(seeded(macd, 9, 25)), 1e-8)


@pytest.mark.parametrize("rows", [256, 2048])
def test_volume_that_ends_leaves_no_gaps(spark, flat_bars, rows):
    got = by_symbol(features(to_spark(spark, flat_bars), ["ema"], target="volume", block_rows=rows))["A"]
    for com in S.EMA_COMS:
        want = log_change(flat_bars.volume.ewm(com=com, adjust=True).mean())
        close_to(got[f"volume_EMA{com}"], want, 1e-6)


@pytest.mark.parametrize("decay", [1e-6, 0.3, 0.5, 0.75, 0.999])
@pytest.mark.parametrize("rows", [64, 4096])
def test_any_decay_suits_any_block(spark, decay, rows):
    rng = np.random.default_rng(5)
    x = np.where(rng.random(900) < 0.5, 0.0, rng.normal(0, 10, 900))
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(900), unit="h")
    bars = with_position(to_spark(spark, pd.DataFrame({"symbol": "A", "ts": ts, "x": x})))
    blocks = exponential_sums(Blocks.of(bars, before=3, rows=rows), {"s": Scan("x", decay)}, ["s"])
    got = by_symbol(blocks.own_rows("symbol", "ts", "s", "s_before"))["A"]
    want, total = [], 0.0
    for value in x:
        total = value + decay * total
        want.append(total)
    close_to(got.s, pd.Series(want))
    close_to(got.s_before, pd.Series([0.0, *want[:-1]]))
