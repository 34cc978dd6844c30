"""Boosted trees against growing one split at a time, and the classifiers built on them."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.operators import boost, model, search

COLUMNS = list("abcdef")
ROUNDS = 3
BINS = 16


@pytest.fixture(scope="module")
def table(spark):
    """Rows with a two-class and a three-class label that trees can learn."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, len(COLUMNS))).round(2)
    two = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] > 1)).astype(int)
    three = np.where(x[:, 0] > 0.5, 1, np.where(x[:, 1] > 0.3, -1, 0))
    rows = [(i, *map(float, x[i]), int(two[i]), int(three[i])) for i in range(len(x))]
    schema = "i int, " + ", ".join(f"{c} double" for c in COLUMNS) + ", y_buy int, y_sell int"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="module")
def binned(table):
    """Bins, and the folds a row is learnt from: both, the second, or none."""
    folds = F.when(F.col("i") < 500, 3).when(F.col("i") < 700, 2).otherwise(0)
    edges = boost.quantile_edges(table, COLUMNS, BINS)
    return edges, boost.binned_rows(table, COLUMNS, edges, ["y_buy", "y_sell"], folds, ["i"])


def members(counts) -> list[boost.Member]:
    one = boost.TreeParams(7, 0.3, 1.0, 10, 0.5, 1.0)
    two = boost.TreeParams(20, 0.5, 0.6, 4, max_depth=5)
    return [
        boost.member(one, 0, 0, counts[0, 0]),
        boost.member(two, 0, 1, counts[0, 1]),
        boost.member(two, 1, 0, counts[1, 0], classes=(-1, 0, 1)),
    ]


def plain_scores(m: boost.Member, bins: np.ndarray, labels: np.ndarray, train: np.ndarray) -> np.ndarray:
    """One split at a time, always the best of all leaves, by trying every column and bin."""
    p, mine = m.params, (train >> m.fold & 1) == 1
    scores = np.tile(np.array(m.start), (len(bins), 1))
    for turn in range(ROUNDS):
        g, h = boost.gradients(m, scores[mine], labels[mine, m.label])
        g, h = g / boost.GRID, h / boost.GRID
        added = np.zeros_like(scores)
        for unit in range(m.units):
            columns = np.flatnonzero(boost.sampled_columns(m, turn, unit, bins.shape[1]))
            leaf, depth = np.zeros(len(bins), int), {0: 0}

            def part(gs: float, hs: float) -> float:
                return max(abs(gs) - p.reg_alpha, 0.0) ** 2 / (hs + p.reg_lambda)

            while len(depth) < p.num_leaves:
                best = (0.0, None)
                for at in sorted(depth):
                    inside = leaf[mine] == at
                    if 0 <= p.max_depth <= depth[at]:
                        continue
                    gs, hs, bs = g[inside, unit], h[inside, unit], bins[mine][inside]
                    for f in columns:
                        for b in range(BINS - 1):
                            low = bs[:, f] <= b
                            if min(low.sum(), (~low).sum()) < p.min_child_samples:
                                continue
                            sides = [(gs[s].sum(), hs[s].sum()) for s in (low, ~low)]
                            if min(sides[0][1], sides[1][1]) < p.min_child_weight:
                                continue
                            gain = part(*sides[0]) + part(*sides[1]) - part(gs.sum(), hs.sum())
                            if gain > best[0] + 1e-12:
                                best = (gain, (at, f, b))
                if best[1] is None:
                    break
                at, f, b = best[1]
                fresh = max(depth) + 1
                leaf[(leaf == at) & (bins[:, f] > b)] = fresh
                depth[at] = depth[fresh] = depth[at] + 1
            for at in depth if len(depth) > 1 else ():
                inside = leaf[mine] == at
                total, below = g[inside, unit].sum(), h[inside, unit].sum() + p.reg_lambda
                value = -math.copysign(max(abs(total) - p.reg_alpha, 0.0), total) / below
                added[leaf == at, unit] = value * p.learning_rate
        scores = scores + added
    return scores


def test_trees_equal_growing_one_split_at_a_time(binned):
    _, rows = binned
    counts = boost.train_counts(rows, 2)
    models = members(counts)
    forest, scored = boost.fit(rows, models, ROUNDS, len(COLUMNS), BINS)
    found = sorted(scored.collect(), key=lambda r: r.i)
    bins = np.frombuffer(b"".join(r.bins for r in found), np.uint8).reshape(-1, len(COLUMNS))
    labels, train = np.array([r.labels for r in found]), np.array([r.train for r in found])
    got, start = np.array([r.scores for r in found]), 0
    for m in models:
        want = plain_scores(m, bins, labels, train)
        assert np.abs(got[:, start : start + m.units] - want).max() < 1e-12
        start += m.units
    assert np.array_equal(forest.scores(bins), got)
    again = boost.forest_of(boost.tree_table(scored.sparkSession, forest), models)
    assert again == forest


def test_partitions_do_not_change_a_tree(binned, monkeypatch):
    """Sums of whole numbers: the same trees from one task or many, and from parts of histograms."""
    _, rows = binned
    models = members(boost.train_counts(rows, 2))
    one, _ = boost.fit(rows.coalesce(1), models, 1, len(COLUMNS), BINS)
    monkeypatch.setattr(boost, "HELD", 1)
    many, _ = boost.fit(rows.repartition(9), models, 1, len(COLUMNS), BINS)
    assert one == many


@pytest.mark.parametrize(
    "change", [{"num_leaves": 3}, {"reg_alpha": 20.0}, {"reg_lambda": 30.0}, {"max_depth": 1}, {"colsample": 0.3}, {"min_child_samples": 120}]
)
def test_every_setting_changes_the_trees(binned, change):
    _, rows = binned
    counts = boost.train_counts(rows, 2)[0, 0]
    base = {"num_leaves": 8, "min_child_samples": 5}
    forests = [
        boost.fit(rows, [boost.member(boost.TreeParams(**told), 0, 0, counts)], 1, len(COLUMNS), BINS)[0]
        for told in (base, base | change)
    ]
    assert forests[0].trees != forests[1].trees
    if "num_leaves" in change:
        assert sum(f < 0 for f in forests[1].trees[0][0].feature) == 3
    if "max_depth" in change:
        assert len(forests[1].trees[0][0].feature) == 3


def test_no_split_no_tree(binned):
    """Nothing to learn, one class only, or too strong a penalty: scores stay where they start."""
    _, rows = binned
    strong = boost.member(boost.TreeParams(8, reg_alpha=1e9), 0, 0, {0: 250, 1: 250})
    alone = boost.member(boost.TreeParams(8, min_child_samples=400), 0, 0, {0: 500})
    nobody = boost.member(boost.TreeParams(8), 0, 5, {})
    _, scored = boost.fit(rows, [strong, alone, nobody], 2, len(COLUMNS), BINS)
    assert {tuple(r.scores) for r in scored.select("scores").collect()} == {(0.0, 0.0, 0.0)}
    with pytest.raises(ValueError, match="two leaves"):
        boost.TreeParams(1)


def test_quantile_bins_hold_equal_shares(table, binned):
    edges, rows = binned
    values = np.array([r.a for r in table.select("a").collect()])
    counts = np.bincount(np.searchsorted(edges[0], values, side="left"), minlength=BINS)
    assert len(edges[0]) == BINS - 1 and counts.min() > 900 / BINS * 0.4


def test_three_classes_are_fitted_saved_and_loaded(table, tmp_path):
    params = {f"{n}_{s}": v for s in model.SIDES for n, v in zip(search.CLASSIFIER_SPACE, (8, 0.5, 1.0, 5, 0.1, 0.1, 8))}
    labelled = table.withColumn("y_buy", F.col("y_sell"))
    fitted = model.fit_classifiers(labelled, COLUMNS, params, iterations=8)
    assert [m.classes for m in fitted.forest.members] == [(-1, 0, 1)] * 2
    scored = fitted.predict(labelled)
    assert scored.where("pred_sell = y_sell").count() > 0.95 * scored.count()
    fitted.save(str(tmp_path / "model"))
    assert model.Classifiers.load(str(tmp_path / "model")) == fitted
    ranked = model.importances(fitted, "sell", labelled).collect()
    assert {r.feature for r in ranked[:2]} == {"a", "b"} and sum(r.importance for r in ranked) > 0


def test_searched_models_equal_single_fits(spark):
    """All trials and folds in one job give what each fit alone would."""
    rng = np.random.default_rng(3)
    n = 400
    rows = [
        ("X", i, n, float(i), *(100 + rng.normal(size=4)).tolist(), 1.0, *rng.normal(size=2).tolist(),
         99.0, 101.0, int(rng.integers(2)), int(rng.integers(2))) for i in range(n)
    ]
    schema = (
        "symbol string, i bigint, n bigint, t double, open double, high double, low double, close double,"
        " volume double, p double, q double, buy double, sell double, y_buy int, y_sell int"
    )
    labelled = spark.createDataFrame(rows, schema)
    trials = search.classifier_trials(2, space=search.CLASSIFIER_SPACE | {"reg_alpha": ("log", 0.1, 1.0), "min_child_samples": ("int", 4, 9)})
    params = S.OptimizeParams(n_splits=2, optimize_target_clf="pnl")
    edges = [[-1.0, -0.4, 0.1, 0.6, 1.2]] * 2
    got = {
        r.trial: r.metric
        for r in model.classifier_scores(labelled, ["p", "q"], trials, params=params, iterations=2, edges=edges).collect()
    }
    for t in trials:
        metrics = []
        for fold in range(2):
            train = labelled.where(model.in_fold(params, fold, "train"))
            fitted = model.fit_classifiers(train, ["p", "q"], t, iterations=2, edges=edges)
            gated = model.gate_prices(fitted.predict(labelled.where(model.in_fold(params, fold, "test"))))
            metrics.append(model.bt.metric(gated, "pnl", S.BacktestParams(), params.pyramiding).first().metric)
        assert got[t["trial"]] == pytest.approx(np.mean(metrics), abs=1e-9)
