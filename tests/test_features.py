from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from helpers import by_symbol, close_to, random_bars, to_spark

from barloom import schema as S
from barloom.operators.blocks import with_position
from barloom.operators.features import features
from barloom.operators.rolling import rolling_apply
from barloom.operators.sliding import rank_correlations
from barloom.sources.synthetic import constant_bars


@pytest.fixture(scope="module")
def bars(spark):
    return with_position(to_spark(spark, random_bars(1, {"A": 700, "B": 260}))).cache()


@pytest.fixture(scope="module", params=[2048, 256])
def table(request, bars):
    return by_symbol(features(bars, drop_incomplete=False, block_rows=request.param))


def ln(x):
    return np.log(x.where(x > 0))


def rank_corr(x):
    n = len(x)
    ranks = pd.Series(x).rank().to_numpy()
    return 1 - 6 * ((ranks - np.arange(1, n + 1)) ** 2).sum() / (n * (n * n - 1))


def seeded(x, span):
    x = x.copy()
    first = x.first_valid_index()
    x.iloc[first + span - 1] = x.iloc[first : first + span].mean()
    x.iloc[: first + span - 1] = np.nan
    return x.ewm(span=span, adjust=False).mean()


def test_against_pandas(table):
    for g in table.values():
        c = g.close
        for n in (10, 20, 50, 100, 200):
            close_to(g[f"SMA{n}"], ln(c.rolling(n).mean()).diff())
            close_to(g[f"EMA{n}"], ln(c.ewm(com=n).mean()).diff())
            close_to(g[f"SKEW{n}"], c.rolling(n).skew(), 1e-7)
            close_to(g[f"KURT{n}"], c.rolling(n).kurt(), 1e-7)
        for n in (7, 14):
            close_to(g[f"MOM{n}"], c.diff(n))
        for n in (10, 20):
            close_to(g[f"ROC{n}"], 100 * c.diff(n) / c.shift(n))
        for n in (9, 28, 56):
            close_to(g[f"RCI{n}"], c.rolling(n).apply(rank_corr, raw=True))
        for n in (5, 10):
            end = c.rolling(n).apply(lambda y: np.polyval(np.polyfit(range(len(y)), y, 1), len(y) - 1))
            close_to(g[f"REG{n}"], ln(end).diff(), 1e-8)
        up, down = c.diff().clip(lower=0), (-c.diff()).clip(lower=0)
        for n in (5, 10, 20):
            u = up.ewm(alpha=1 / n, min_periods=n).mean()
            v = down.ewm(alpha=1 / n, min_periods=n).mean()
            close_to(g[f"RSI{n}"], 100 * u / (u + v))
        moved = pd.concat([g.high - g.low, (g.high - c.shift()).abs(), (c.shift() - g.low).abs()], axis=1)
        for n in (14, 28):
            close_to(g[f"ATR{n}"], moved.max(axis=1).ewm(alpha=1 / n, min_periods=n).mean())
            tp = (g.high + g.low + c) / 3
            mad = tp.rolling(n).apply(lambda y: np.abs(y - y.mean()).mean(), raw=True)
            close_to(g[f"CCI{n}"], (tp - tp.rolling(n).mean()) / (0.015 * mad), 1e-7)
        macd = seeded(c, 12) - seeded(c, 26)
        signal = seeded(macd, 9)
        close_to(g["MACD_12_26_9"], macd)
        close_to(g["MACDs_12_26_9"], signal)
        close_to(g["MACD_h12_26_9"], macd - signal)
        mean, std = c.rolling(20).mean(), c.rolling(20).std(ddof=0)
        for k in (1, 2, 3):
            close_to(g[f"BBL_20_{k}.0"], ln(mean - k * std).diff())
            close_to(g[f"BBU_20_{k}.0"], ln(mean + k * std).diff())
            close_to(g[f"BB_20_{k}.0"], 2 * k * std, 1e-8)
        close_to(g["volume_log_diff"], ln(g.volume).diff())
        close_to(g["day_sin"], np.sin(g.ts.dt.day))
        close_to(g["hour_cos"], np.cos(g.ts.dt.hour))


def test_names_and_warm_up(spark, bars):
    assert len(S.FEATURES) == 60
    done = features(bars)
    assert done.columns == [*S.BASE_COLUMNS, *S.FEATURES]
    counts = {k: len(g) for k, g in by_symbol(done).items()}
    assert counts == {"A": 500, "B": 60}


def test_constant_prices(spark):
    g = by_symbol(features(constant_bars(spark, bars=250), drop_incomplete=False))["S0"]
    for n in (10, 200):
        assert (g[f"SKEW{n}"].dropna() == 0).all() and (g[f"KURT{n}"].dropna() == -3).all()
        assert g[f"SMA{n}"].notna().sum() == 250 - n
    assert g["RSI5"].isna().all() and g["CCI14"].isna().all()
    assert (g["BB_20_2.0"].dropna() == 0).all()


def test_full_window_starts_at_row_200(spark):
    for n, rows in ((199, 0), (200, 0), (201, 1)):
        g = by_symbol(features(constant_bars(spark, bars=n), ["sma"], drop_incomplete=False))["S0"]
        assert g["SMA200"].notna().sum() == rows


def test_zero_volume_row_is_dropped(spark):
    pdf = random_bars(3, {"A": 260})
    pdf.loc[pdf.ts == pdf.ts.sort_values().iloc[230], "volume"] = 0.0
    done = by_symbol(features(to_spark(spark, pdf)))["A"]
    assert len(done) == 60 - 2


def test_other_target_is_prefixed(bars):
    done = features(bars, ["mom", "atr"], target="volume")
    assert done.columns == [*S.BASE_COLUMNS, "volume_MOM7", "volume_MOM14"]
    with pytest.raises(ValueError):
        features(bars, ["nonsense"])


def test_python_window_function(bars):
    def lean(windows):  # defined here, so that it travels to the workers by value
        return windows[:, -1] - windows.mean(axis=1)

    got = by_symbol(rolling_apply(bars, "close", 9, lean, "r", rows=256))
    for g in got.values():
        close_to(g["r"], g.close.rolling(9).apply(lambda w: w[-1] - w.mean(), raw=True))


def test_every_generated_method_is_compiled_by_the_jvm(spark, bars):
    plan = features(bars)._jdf.queryExecution().sparkPlan()
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(
        spark._jvm.org.apache.spark.sql.execution.QueryExecution.prepareExecutedPlan(spark._jsparkSession, plan)
    )
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_series_of_one_block_are_read_once(spark, bars, tmp_path):
    bars.write.parquet(str(tmp_path / "bars"))
    stored = spark.read.parquet(str(tmp_path / "bars"))
    plan = features(stored, ["macd", "rsi"])._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet .*", plan)
    assert len([scan for scan in scans if "GreaterThan(n,2048)" not in scan]) == 1


def test_rank_correlations_of_ties_and_gaps():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, 120).astype(float)
    x[[30, 31, 77]] = np.nan
    for values in (x, x[:6]):
        for name, got in rank_correlations(values, {"a": 5, "b": 9, "c": 20}).items():
            n = {"a": 5, "b": 9, "c": 20}[name]
            expected = pd.Series(values).rolling(n).apply(rank_corr, raw=True)
            np.testing.assert_allclose(got, expected.to_numpy(), atol=1e-12)


def test_block_statistics_in_another_time_zone(spark, bars):
    def rows():
        table = features(bars, ["rci"]).selectExpr("symbol", "unix_micros(ts) AS at", "RCI9")
        return sorted(map(tuple, table.where("RCI9 IS NOT NULL").collect()))

    expected, zone = rows(), spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
