"""Small fixtures and row-by-row references."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from barloom import schema as S


def random_bars(seed: int, symbols: dict[str, int], minutes: int = 15) -> pd.DataFrame:
    """Positive random-walk bars with gaps in time; prices on a coarse grid, so ties occur."""
    rng = np.random.default_rng(seed)
    frames = []
    for symbol, n in symbols.items():
        close = 100 + np.round(rng.normal(0, 1, n).cumsum(), 1)
        close = np.maximum(close, 5.0)
        open_ = np.append(close[:1], close[:-1]) + np.round(rng.normal(0, 0.3, n), 1)
        spread = np.round(np.abs(rng.normal(0, 0.7, n)), 1)
        at = pd.Timestamp("2024-01-01") + pd.to_timedelta(
            (np.arange(n) + rng.integers(0, 3, n).cumsum()) * minutes, unit="min"
        )
        frames.append(
            pd.DataFrame(
                {
                    "symbol": symbol,
                    "ts": at,
                    "open": open_,
                    "high": np.maximum(open_, close) + spread,
                    "low": np.minimum(open_, close) - spread,
                    "close": close,
                    "volume": rng.integers(1, 50, n).astype(float),
                }
            )
        )
    return pd.concat(frames).sample(frac=1, random_state=seed)


def to_spark(spark, pdf: pd.DataFrame):
    return spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp"))


def by_symbol(df) -> dict[str, pd.DataFrame]:
    pdf = df.toPandas().sort_values(["symbol", "ts"]).reset_index(drop=True)
    return {k: g.reset_index(drop=True) for k, g in pdf.groupby("symbol")}


def simulate(rows: pd.DataFrame, account: S.BacktestParams, pyramiding: int) -> pd.DataFrame:
    """The backtest one bar at a time, on rows with raw ``buy`` and ``sell``."""
    o, h, l, c = (rows[x].to_numpy(float) for x in S.PRICES)
    n = len(rows)
    buy, sell = rows["buy"].to_numpy(float).copy(), rows["sell"].to_numpy(float).copy()
    for t in range(n - 1):
        buy[t], sell[t] = min(buy[t], o[t + 1]), max(sell[t], o[t + 1])
    filled = [
        (t > 0 and l[t] < buy[t - 1], t > 0 and h[t] > sell[t - 1]) for t in range(n)
    ]
    side = count = 0
    out, last_price, last_pos, pnl = [], None, None, 0.0
    for t in range(n):
        long, short = filled[t]
        order = 0 if long == short else (1 if long else -1)
        if order:
            count = count + 1 if order == side else 1
            side = order
        pos = side * min(count, pyramiding) / pyramiding * account.lot
        next_long, next_short = filled[t + 1] if t + 1 < n else (False, False)
        price = sell[t] if next_short else buy[t] if next_long else c[t]
        profit = np.nan
        if last_price is not None:
            cost = price * account.commission / 100 * abs(pos - last_pos)
            profit = (price - last_price) * pos - cost
            pnl += profit
        out.append((order, pos, price, profit, pnl if last_price is not None else np.nan))
        last_price, last_pos = price, pos
    return pd.DataFrame(out, columns=["order", "pos", "exec_price", "profit", "pnl"])


def close_to(got: pd.Series, want: pd.Series, tolerance: float = 1e-9) -> None:
    a, b = got.astype(float).to_numpy(), want.astype(float).to_numpy()
    b = np.where(np.isfinite(b), b, np.nan)
    assert (np.isnan(a) == np.isnan(b)).all(), "NULLs differ"
    assert np.allclose(a, b, rtol=tolerance, atol=tolerance, equal_nan=True)
