"""Proposals against random trials, and their edge cases."""

from __future__ import annotations

import math

import pytest

from barloom import schema as S
from barloom.operators import sampler, search
from helpers import random_bars, to_spark
from barloom.operators.blocks import with_position

SPACE = {"length": ("int", 5, 25), "point": ("log", 0.1, 15.0), "share": ("float", 0.0, 1.0)}
SCHEMA = "symbol string, trial int, length int, point double, share double, metric double"


def objective(length: int, point: float, share: float) -> float:
    """Best at length 18, point 1, share 0.3."""
    return -(((length - 18) / 20) ** 2) - (math.log(point) / 5) ** 2 - (share - 0.3) ** 2


def random_rows(symbol: str, trials: range, seed: int) -> list[tuple]:
    rows = []
    for t in trials:
        drawn = [search.draw(*limits, search.uniform(seed, t, n)) for n, limits in SPACE.items()]
        rows.append((symbol, t, *drawn, objective(*drawn)))
    return rows


def test_proposals_beat_random_trials(spark):
    """Twelve searches of 40 trials: ten random ones and six batches of five, against 40 random ones."""
    seeds = range(12)
    rows = [r for s in seeds for r in random_rows(f"s{s}", range(10), s)]
    for k in range(6):
        history = spark.createDataFrame(rows, SCHEMA)
        found = sampler.next_trials(history, SPACE, 10 + 5 * k, 5, seed=7).collect()
        assert len(found) == 5 * len(seeds)
        rows += [(*r, objective(*r[2:])) for r in found]
    adaptive = [max(r[-1] for r in rows if r[0] == f"s{s}") for s in seeds]
    plain = [max(r[-1] for r in random_rows("x", range(40), s)) for s in seeds]
    assert sum(adaptive) / 12 > sum(plain) / 12
    assert sum(a > p for a, p in zip(adaptive, plain)) >= 8
    for _, _, length, point, share, _ in rows:
        assert 5 <= length <= 25 and 0.1 <= point <= 15 * (1 + 1e-12) and 0 <= share <= 1


def test_proposals_repeat_and_need_no_metric(spark):
    rows = [("a", 0, 7, 1.0, 0.5, None), ("b", 0, 9, 2.0, 0.1, 1.0)]
    history = spark.createDataFrame(rows, SCHEMA)
    first = sampler.next_trials(history, SPACE, 1, 3).orderBy("symbol", "trial").collect()
    again = sampler.next_trials(history.repartition(7), SPACE, 1, 3).orderBy("symbol", "trial").collect()
    assert first == again and len(first) == 6
    assert [r.trial for r in first] == [1, 2, 3] * 2
    pooled = sampler.next_trials(history.drop("symbol"), SPACE, 1, 2, "minimize", keys=())
    assert pooled.columns == ["trial", *SPACE] and pooled.count() == 2


def test_sequential_search_finds_at_least_what_its_random_start_does(spark):
    bars = with_position(to_spark(spark, random_bars(23, {"A": 300, "B": 260})))
    params = S.OptimizeParams(n_splits=2, n_trials=9)
    best = search.sequential_search(bars, params=params, batch=4).collect()
    assert {r.symbol for r in best} == {"A", "B"} and all(0 <= r.trial < 9 for r in best)
    start = search.search_signal(bars, search.signal_trials(4), params=params).collect()
    for symbol in "AB":
        got, told = (next(r.metric for r in rows if r.symbol == symbol) for rows in (best, start))
        assert got >= told - 1e-12
    with pytest.raises(Exception, match="too few rows"):
        search.sequential_search(bars.where("i < 3").withColumn("n", bars["i"] * 0 + 3), params=params)
