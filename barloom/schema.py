"""Column names, fixed schemas and typed parameter objects."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import types as T

SYMBOL = "symbol"
TS = "ts"
PRICES = ("open", "high", "low", "close")
OHLCV = (*PRICES, "volume")
BASE_COLUMNS = (SYMBOL, TS, *OHLCV)

#: Columns that are never model inputs: the bar itself, signals and labels.
NON_FEATURE_COLUMNS = (
    *BASE_COLUMNS,
    "limit",
    "buy",
    "sell",
    "long",
    "short",
    "exec_price_buy",
    "exec_price_sell",
    "y_buy",
    "y_sell",
)

# The published feature names and window lengths.
SMA_LENGTHS = (10, 20, 50, 100, 200)
EMA_COMS = (10, 20, 50, 100, 200)
REG_LENGTHS = (5, 10)
MOM_LENGTHS = (7, 14)
ROC_LENGTHS = (10, 20)
ATR_LENGTHS = (14, 28)
RSI_LENGTHS = (5, 10, 20)
RCI_LENGTHS = (9, 28, 56)
BB_LENGTH = 20
BB_WIDTHS = (1, 2, 3)
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
CCI_LENGTHS = (14, 28)
CCI_SCALE = 0.015
MOMENT_LENGTHS = (10, 20, 50, 100, 200)

FEATURE_GROUPS: dict[str, tuple[str, ...]] = {
    "time": ("day_sin", "day_cos", "hour_sin", "hour_cos"),
    "log_diff": tuple(f"{c}_log_diff" for c in OHLCV),
    "sma": tuple(f"SMA{n}" for n in SMA_LENGTHS),
    "ema": tuple(f"EMA{n}" for n in EMA_COMS),
    "reg": tuple(f"REG{n}" for n in REG_LENGTHS),
    "bb": tuple(
        f"{side}_{BB_LENGTH}_{k}.0" for k in BB_WIDTHS for side in ("BBL", "BBM", "BBU")
    ),
    "mom": tuple(f"MOM{n}" for n in MOM_LENGTHS),
    "roc": tuple(f"ROC{n}" for n in ROC_LENGTHS),
    "atr": tuple(f"ATR{n}" for n in ATR_LENGTHS),
    "rsi": tuple(f"RSI{n}" for n in RSI_LENGTHS),
    "rci": tuple(f"RCI{n}" for n in RCI_LENGTHS),
    "bb_width": tuple(f"BB_{BB_LENGTH}_{k}.0" for k in BB_WIDTHS),
    "macd": ("MACD_12_26_9", "MACD_h12_26_9", "MACDs_12_26_9"),
    "cci": tuple(f"CCI{n}" for n in CCI_LENGTHS),
    "skew": tuple(f"SKEW{n}" for n in MOMENT_LENGTHS),
    "kurt": tuple(f"KURT{n}" for n in MOMENT_LENGTHS),
}

#: All sixty feature names in output order.
FEATURES: tuple[str, ...] = tuple(name for names in FEATURE_GROUPS.values() for name in names)

BARS_SCHEMA = T.StructType(
    [T.StructField(SYMBOL, T.StringType()), T.StructField(TS, T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in OHLCV]
)

MEASUREMENT_SCHEMA = T.StructType(
    [
        T.StructField(TS, T.TimestampType()),
        T.StructField("measurement", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

TICK_SCHEMA = T.StructType(
    [
        T.StructField(SYMBOL, T.StringType()),
        T.StructField(TS, T.TimestampType()),
        T.StructField("seq", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
    ]
)

#: Price offset that keeps a limit order from ever filling (a fixed value).
GATE_OFFSET = 10000.0

METRICS = ("pnl", "sr", "max_dd")


def direction_of(metric: str) -> str:
    """``maximize`` for pnl and sr, ``minimize`` for max_dd."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose one of {METRICS}")
    return "minimize" if metric == "max_dd" else "maximize"


@dataclass(frozen=True)
class BacktestParams:
    """Account and trading settings; defaults are the pipeline's published ones."""

    jpy: float = 5000.0
    usdjpy: float = 160.0
    lot: float = 0.003
    lot_min: float = 0.001
    commission: float = 0.01
    use_ml: bool = True
    use_binary_label: bool = True
    seed: int = 42

    def __post_init__(self) -> None:
        if self.jpy < 0 or self.usdjpy < 0:
            raise ValueError("jpy and usdjpy must not be negative")
        if self.lot < 0.001 or self.lot_min < 0.001:
            raise ValueError("lot and lot_min must be at least 0.001")
        if self.lot < self.lot_min:
            raise ValueError("lot must not be smaller than lot_min")

    @property
    def usd(self) -> float:
        return self.jpy / self.usdjpy

    @property
    def pyramiding_max(self) -> int:
        return math.floor(self.lot / self.lot_min)


@dataclass(frozen=True)
class OptimizeParams:
    """Search and walk-forward settings; defaults are the pipeline's published ones."""

    pyramiding: int = 3
    optimize_target: str = "pnl"
    optimize_target_clf: str = "sr"
    n_trials: int = 200
    n_trials_clf: int = 100
    class_weight: str = "balanced"
    n_splits: int = 5
    max_train_size: int | None = None
    test_size: int | None = None
    gap: int = 5
    evaluate_ratio: float = 0.25

    def __post_init__(self) -> None:
        if self.pyramiding < 1:
            raise ValueError("pyramiding must be at least 1")
        if self.n_trials < 1 or self.n_trials_clf < 1:
            raise ValueError("n_trials and n_trials_clf must be at least 1")
        direction_of(self.optimize_target)
        direction_of(self.optimize_target_clf)

    @property
    def direction(self) -> str:
        return direction_of(self.optimize_target)

    @property
    def direction_clf(self) -> str:
        return direction_of(self.optimize_target_clf)
