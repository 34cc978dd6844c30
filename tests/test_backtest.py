from __future__ import annotations

import pandas as pd
import pytest
from helpers import by_symbol, close_to, random_bars, simulate, to_spark

from barloom import schema as S
from barloom.operators import backtest as bt
from barloom.operators import labels as lb
from barloom.operators import running, search
from barloom.operators import signals as sg
from barloom.operators.blocks import with_position
from barloom.operators.folds import bound_exprs, fold_bounds, fold_rows, holdout_bounds
from barloom.operators.search import (
    best_trial,
    fold_scores,
    search_signal,
    signal_trials,
    trial_scores,
)
from barloom.sources.synthetic import constant_bars

ACCOUNT = S.BacktestParams(lot=0.3, lot_min=0.1, commission=0.05)
BAND = {"entry_length": 5, "entry_point": 0.4}


@pytest.fixture(scope="module")
def bars(spark):
    return with_position(to_spark(spark, random_bars(7, {"A": 400, "B": 150}))).cache()


@pytest.fixture(scope="module")
def raw(bars):
    return by_symbol(sg.signals(bars, **BAND))


@pytest.mark.parametrize("rows", [2048, 64, 8])
@pytest.mark.parametrize("pyramiding", [1, 3])
def test_backtest_equals_simulation(bars, raw, rows, pyramiding):
    got = by_symbol(bt.backtest(sg.signal_blocks(bars, block_rows=max(rows, 8), **BAND), ACCOUNT, pyramiding))
    flips = 0
    for symbol, g in got.items():
        want = simulate(raw[symbol], ACCOUNT, pyramiding)
        for column in want.columns:
            close_to(g[column], want[column])
        flips += (g.pos * g.pos.shift() < 0).sum()
    assert flips > 3


@pytest.mark.parametrize("rows", [2048, 16])
def test_metrics(bars, raw, rows):
    blocks = sg.signal_blocks(bars, block_rows=rows, **BAND)
    scores = {m: bt.metric(blocks, m, ACCOUNT, 3).toPandas().set_index("symbol").metric for m in S.METRICS}
    for symbol, g in raw.items():
        sim = simulate(g, ACCOUNT, 3)
        assert scores["pnl"][symbol] == pytest.approx(sim.pnl.iloc[-1])
        assert scores["sr"][symbol] == pytest.approx(sim.profit.mean() / sim.profit.std(ddof=0))
        assert scores["max_dd"][symbol] == pytest.approx((sim.pnl.cummax() - sim.pnl).max())
    with pytest.raises(ValueError):
        bt.metric(blocks, "nonsense")


def _rows(spark, columns: dict[str, list[float]]):
    n = len(columns["open"])
    pdf = pd.DataFrame(columns).assign(
        symbol="X", ts=pd.date_range("2024-01-01", periods=n, freq="15min"), volume=1.0
    )
    return with_position(to_spark(spark, pdf))


def test_both_sides_fill_on_one_bar(spark):
    rows = _rows(spark, {
        "open": [10, 10, 10], "high": [10, 12, 10], "low": [10, 8, 10], "close": [10, 10, 10],
        "buy": [9, 5, 5], "sell": [11, 20, 20],
    })
    g = by_symbol(bt.backtest(rows, ACCOUNT, 3))["X"]
    assert g.long[1] and g.short[1] and g.order[1] == 0
    assert g.exec_price[0] == 11


def test_clamp_and_reversal(spark):
    lows = [10, 8, 8, 8, 8, 8, 10, 10]
    highs = [10] * 6 + [12, 10]
    rows = _rows(spark, {
        "open": [10] * 8, "high": highs, "low": lows, "close": [10] * 8,
        "buy": [9.0] * 8, "sell": [11.0] * 8,
    })
    account = S.BacktestParams(lot=3.0, lot_min=1.0)
    for block_rows in (2048, 2):
        g = by_symbol(bt.backtest(rows, account, 3, block_rows=block_rows))["X"]
        assert list(g.pos) == [0, 1, 2, 3, 3, 3, -1, -1]


def test_labels(bars, raw):
    got = by_symbol(lb.labels(sg.signal_blocks(bars, **BAND), binary=False))
    written = by_symbol(lb.labels(sg.signal_blocks(bars, **BAND), sell_label="as_written"))
    for symbol, g in got.items():
        source = raw[symbol]
        assert len(g) == len(source) - 1
        following = source.close.shift(-1)[:-1]
        buy_filled = source.low.shift(-1)[:-1] < g.buy
        won = g.buy < following
        assert (g.y_buy == buy_filled.astype(int) * (2 * won.astype(int) - 1)).all()
        sell_filled = source.high.shift(-1)[:-1] > g.sell
        ahead = g.sell > following
        assert (g.y_sell == sell_filled.astype(int) * (2 * ahead.astype(int) - 1)).all()
        assert (written[symbol].y_sell == sell_filled.astype(int)).all()


def test_signal_on_constant_bars(spark):
    bars = constant_bars(spark, bars=10)
    got = by_symbol(sg.signals(bars, entry_length=1, entry_point=0.1))["S0"]
    assert {*S.BASE_COLUMNS, "buy", "sell"} <= set(got.columns)
    assert len(got) == 9 and got.sell[0] == pytest.approx(1.001) and got.buy[0] == pytest.approx(0.999)


def test_registered_signal_function(bars):
    @sg.register_signal("last_bar", lookback=lambda **_: 1)
    def last_bar(blocks, edge):
        return blocks.with_exprs({"sell": f"high + {edge}D", "buy": f"low - {edge}D"})

    rows = by_symbol(sg.signals(bars, "last_bar", edge=2.0))["A"]
    assert (rows.sell == rows.high + 2.0).all() and (rows.buy == rows.low - 2.0).all()


# -- running operations ---------------------------------------------------------------------------


@pytest.mark.parametrize("rows", [2048, 16])
def test_running_operations(bars, rows):
    moved = bars.selectExpr("*", "CASE WHEN close > open + 1 THEN 1 WHEN close < open - 1 THEN -1 END AS move")
    total = by_symbol(running.cumulative_sum(moved, "volume", "t", rows=rows))
    held = running.forward_fill(moved, "move", "held", "0", rows=rows)
    filled = by_symbol(held)
    groups = by_symbol(running.sign_groups(held, "held", "volume", "g", "s", rows=rows))
    for symbol in total:
        close_to(total[symbol].t, total[symbol].volume.cumsum())
        g = filled[symbol]
        assert (g.held == g.move.ffill().fillna(0)).all()
        g = groups[symbol]
        number = (g.held * g.held.shift() < 0).cumsum()
        assert number.max() > 5 and (g.g == number).all()
        close_to(g.s, g.volume.groupby(number).cumsum())


# -- folds and search -----------------------------------------------------------------------------


def test_folds_by_hand(bars):
    params = S.OptimizeParams(n_splits=3, gap=2, test_size=40, max_train_size=100)
    got = fold_bounds(bars, params, holdout=False, strict=False).toPandas()
    a = got[got.symbol == "A"].sort_values("fold").reset_index(drop=True)
    assert list(a.test_start_i) == [280, 320, 360] and list(a.test_end_i) == [319, 359, 399]
    assert list(a.train_end_i) == [277, 317, 357] and list(a.train_start_i) == [178, 218, 258]
    rows = fold_rows(bars, params, "train", holdout=False, strict=False).groupBy("symbol", "fold").count()
    assert {r["count"] for r in rows.collect() if r.symbol == "A"} == {100}


def test_fold_error_limit(spark):
    params = S.OptimizeParams(n_splits=3, gap=2, test_size=4)
    short = with_position(constant_bars(spark, bars=14))
    with pytest.raises(Exception, match="too few rows"):
        fold_bounds(short, params, holdout=False).collect()
    enough = with_position(constant_bars(spark, bars=15))
    assert fold_bounds(enough, params, holdout=False).count() == 3
    assert bound_exprs(params, 0, "n")["test_start"] == "(n - 3 * 4)"


def test_holdout(bars):
    got = holdout_bounds(bars, S.OptimizeParams()).toPandas().set_index("symbol")
    times = by_symbol(bars)["A"].ts
    assert got.eval_start["A"] == times[300 + 5] and got.eval_end["A"] == times.iloc[-1]


@pytest.mark.parametrize("target", S.METRICS)
@pytest.mark.parametrize(("rows", "cap"), [(2048, None), (64, None), (64, 70)])
def test_search_equals_simulation(bars, target, rows, cap):
    trials = [
        {"trial": 0, "entry_length": 5, "entry_point": 0.4},
        {"trial": 1, "entry_length": 9, "entry_point": 0.1},
    ]
    params = S.OptimizeParams(n_splits=2, gap=3, optimize_target=target, max_train_size=cap)
    scores = fold_scores(bars, trials, ACCOUNT, params, block_rows=rows)
    got = {(r.symbol, r.trial, r.fold): r.metric for r in scores.collect()}
    assert len(got) == 8
    for trial in trials:
        rows_ = by_symbol(sg.signals(bars, entry_length=trial["entry_length"], entry_point=trial["entry_point"]))
        for symbol, g in rows_.items():
            n = int({"A": 400, "B": 150}[symbol] * 0.75)
            for fold in range(2):
                end = n - (2 - fold) * (n // 3) - 3
                start = max(0, end - cap) if cap else 0
                sim = simulate(g[(g.i >= start) & (g.i < end)].reset_index(drop=True), ACCOUNT, 3)
                want = {
                    "pnl": sim.pnl.iloc[-1],
                    "sr": sim.profit.mean() / sim.profit.std(ddof=0),
                    "max_dd": (sim.pnl.cummax() - sim.pnl).max(),
                }[target]
                assert got[(symbol, trial["trial"], fold)] == pytest.approx(want)


def test_best_trial_and_ties(spark):
    scores = spark.createDataFrame(
        [("A", 0, 1.0), ("A", 1, 3.0), ("A", 2, 3.0), ("A", 3, None)], "symbol string, trial int, metric double"
    )
    assert best_trial(scores, "maximize").first().trial == 1
    assert best_trial(scores, "minimize").first().trial == 0


def test_random_trials_repeat_and_stay_in_range(bars):
    trials = signal_trials(200)
    assert trials == signal_trials(200) and trials[:5] == signal_trials(5)
    assert {5, 25} <= {t["entry_length"] for t in trials}
    assert all(5 <= t["entry_length"] <= 25 and 0.1 <= t["entry_point"] <= 15 for t in trials)
    best = search_signal(bars, trials[:6], ACCOUNT, S.OptimizeParams(n_splits=2)).collect()
    scores = trial_scores(fold_scores(bars, trials[:6], ACCOUNT, S.OptimizeParams(n_splits=2)))
    top = {r.symbol: r.m for r in scores.groupBy("symbol").agg({"metric": "max"}).toDF("symbol", "m").collect()}
    assert {r.symbol: r.metric for r in best} == top


def test_parameter_checks():
    assert S.BacktestParams().usd == pytest.approx(31.25) and S.BacktestParams().pyramiding_max == 3
    for bad in ({"lot": 0.0001}, {"lot": 0.001, "lot_min": 0.002}, {"jpy": -1.0}):
        with pytest.raises(ValueError):
            S.BacktestParams(**bad)
    for bad in ({"pyramiding": 0}, {"n_trials": 0}, {"optimize_target": "x"}):
        with pytest.raises(ValueError):
            S.OptimizeParams(**bad)
    assert S.OptimizeParams(optimize_target="max_dd").direction == "minimize"


@pytest.mark.parametrize("capped", [None, 60])
def test_series_of_one_block_pass_once(spark, monkeypatch, capped):
    """Only blocks of longer series ask which run enters them; the scores are those of short blocks."""
    seen = []
    whole = search.bt.run_state

    def counted(blocks):
        seen.append(blocks.df.select(S.SYMBOL).distinct().count())
        return whole(blocks)

    monkeypatch.setattr(search.bt, "run_state", counted)
    bars = with_position(to_spark(spark, random_bars(5, {"A": 170, "B": 300, "C": 150})))
    params = S.OptimizeParams(n_splits=2, max_train_size=capped)
    trials = search.signal_trials(3)
    got = []
    for rows in (30, 160, 2048):
        scores = fold_scores(bars, trials, ACCOUNT, params, block_rows=rows)
        got.append({(r.symbol, r.trial, r.fold): r.metric for r in scores.collect()})
    assert seen == [3, 2, 0]
    assert len(got[0]) == 18 and got[1] == pytest.approx(got[0]) and got[2] == pytest.approx(got[0])
