"""Boosted trees over binned columns, many models at a time.

Every round grows one tree per model (and per class beyond two) on the gradients of its logistic or
softmax loss. Trees grow best-first to a leaf count: the leaf with the largest gain splits next.

* Rows are binned once. A job per wave reads them, adds up gradients, hessians and counts by (model,
  leaf, feature, bin) in its tasks, merges these histograms by (model, leaf), and returns the best
  split of every leaf: one small row per model and leaf, whatever the number of rows.
* A wave looks at all leaves that best-first growth could reach with what is known so far, so a tree
  takes about as many waves as it is deep; all models share a wave. Growth is replayed on the known
  gains until it meets no unknown leaf, so the tree is the one that single steps would give.
* Gradients and hessians are whole multiples of ``1 / GRID``. Sums of whole numbers do not depend on
  their order, so neither partitioning nor a repeated task changes a tree.
* Scores of all models are a column of the rows, written once per round: a lost executor repeats a
  wave. The driver holds trees, never rows.

Leaf values are ``-T(G) / (H + l2)`` with ``T`` shrinking ``G`` by ``l1`` towards zero; a split gains the
sum of ``T(G)^2 / (H + l2)`` of its sides minus that of the leaf. Ties go to the first feature, then the
lowest bin, then the older leaf.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.scalars import quoted
from barloom.session import shared_dir
from barloom.sinks.writers import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Steps of gradients and hessians per unit.
GRID = 1 << 24
BINS = 32
#: Numbers of histograms that a task holds before it passes them on.
HELD = 8_000_000
#: Scores (rows x models) in a file of the rows.
SCORES_PER_FILE = 20_000_000


@dataclass(frozen=True)
class TreeParams:
    """Settings of one model."""

    num_leaves: int = 31
    learning_rate: float = 0.1
    colsample: float = 1.0
    min_child_samples: int = 20
    reg_alpha: float = 0.0
    reg_lambda: float = 0.0
    max_depth: int = -1
    min_child_weight: float = 1e-3

    def __post_init__(self) -> None:
        if self.num_leaves < 2 or not 0 < self.colsample <= 1 or self.reg_alpha < 0 or self.reg_lambda < 0:
            raise ValueError("a tree needs two leaves or more, some columns, and no negative penalty")


@dataclass(frozen=True)
class Member:
    """One model: what it predicts, from which rows, and how it grows.

    ``label`` is a place in the rows' ``labels``; ``classes`` are its values in order, the positive one
    last of two. Rows whose ``train`` has bit ``fold`` are learnt from. ``weights`` are per class.
    """

    params: TreeParams
    label: int
    fold: int
    seed: int = 42
    classes: tuple[int, ...] = (0, 1)
    weights: tuple[float, ...] = (1.0, 1.0)
    start: tuple[float, ...] = (0.0,)

    @property
    def units(self) -> int:
        """Trees per round."""
        return 1 if len(self.classes) == 2 else len(self.classes)


@dataclass
class Tree:
    """A tree as columns by node; leaves have no feature (-1)."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        """The node in which every row of a table of bins ends."""
        feature, threshold, left, right = (
            np.array(x, np.int64) for x in (self.feature, self.bin, self.left, self.right)
        )
        node = np.zeros(len(bins), np.int64)
        moving = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
        while len(moving):
            at = node[moving]
            low = bins[moving, feature[at]] <= threshold[at]
            node[moving] = np.where(low, left[at], right[at])
            moving = moving[feature[node[moving]] >= 0]
        return node


# -- rows -----------------------------------------------------------------------------------------


def quantile_edges(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper bounds of all bins but the last, per column, at equal shares of the rows.

    One pass of bounded summaries; the error of a share is a quarter of a bin.
    """
    shares = [k / bins for k in range(1, bins)]
    plain = df.select(*[quoted(c).alias(f"c{k}") for k, c in enumerate(columns)])
    found = plain.approxQuantile(plain.columns, shares, 0.25 / bins)
    return [sorted(set(x)) for x in found]


def binned_rows(
    df: DataFrame,
    columns: Sequence[str],
    edges: Sequence[Sequence[float]],
    labels: Sequence[str],
    train: Column,
    keep: Sequence[str],
    purpose: str = "binned",
) -> DataFrame:
    """``keep`` columns, ``labels`` (array), ``train`` (bits) and ``bins`` (a byte per column), written.

    A value falls into the first bin whose upper bound it does not exceed.
    """
    bounds = [np.array(e, float) for e in edges]
    if any(len(b) > 255 for b in bounds):
        raise ValueError("a bin's number must fit a byte")
    kept = df.select(
        *[quoted(c) for c in keep],
        F.array(*[F.col(c).cast("int") for c in labels]).alias("labels"),
        train.cast("bigint").alias("train"),
        F.array(*[quoted(c).cast("double") for c in columns]).alias("bins"),
    )
    schema = kept.drop("bins").schema.add("bins", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("bins")
            if not batch.num_rows:
                continue
            values = batch.column(place).flatten().to_numpy(zero_copy_only=False)
            values = values.reshape(batch.num_rows, len(bounds))
            out = np.empty(values.shape, np.uint8)
            for k, b in enumerate(bounds):
                out[:, k] = np.searchsorted(b, values[:, k], side="left")
            bytes_ = pa.array([row.tobytes() for row in out], pa.binary())
            yield batch.set_column(place, "bins", bytes_)

    return written(kept.mapInArrow(run, schema), purpose)


def train_counts(rows: DataFrame, folds: int) -> dict[tuple[int, int], dict[int, int]]:
    """Rows per class, by (label place, fold). One row per pattern of folds and labels is read."""
    counts = rows.groupBy("train", "labels").count().collect()
    out: dict[tuple[int, int], dict[int, int]] = {}
    for r in counts:
        for fold in range(folds):
            if r.train >> fold & 1:
                for k, y in enumerate(r.labels):
                    classes = out.setdefault((k, fold), {})
                    classes[y] = classes.get(y, 0) + r["count"]
    return out


def member(
    params: TreeParams, label: int, fold: int, counts: dict[int, int], seed: int = 42,
    balanced: bool = True, classes: tuple[int, ...] = (0, 1),
) -> Member:
    """A model with class weights ``n / (classes * class count)`` and scores that start at the priors."""
    total = sum(counts.values())
    sizes = [counts.get(c, 0) for c in classes]
    weights = [total / (len(classes) * n) if balanced and n else 1.0 for n in sizes]
    share = [w * n for w, n in zip(weights, sizes)]
    if min(share) <= 0:  # a class is missing: nothing to tell apart
        start = [0.0] * len(classes)
    else:
        start = [math.log(s / sum(share)) for s in share]
    if len(classes) == 2:
        start = [start[1] - start[0]]
    return Member(params, label, fold, seed, classes, tuple(weights), tuple(start))


# -- gradients ------------------------------------------------------------------------------------


def gradients(m: Member, scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number gradients and hessians (rows x units) of a model's loss."""
    hit = labels[:, None] == np.array(m.classes)[None, :]
    weight = (hit * np.array(m.weights)[None, :]).sum(1)[:, None]
    if m.units == 1:
        p = 1.0 / (1.0 + np.exp(-scores))
        g, h = (p - hit[:, 1:]) * weight, p * (1.0 - p) * weight
    else:
        e = np.exp(scores - scores.max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        factor = len(m.classes) / (len(m.classes) - 1)
        g, h = (p - hit) * weight, factor * p * (1.0 - p) * weight
    return np.floor(g * GRID + 0.5), np.floor(h * GRID + 0.5)


def shrunk(g: float | np.ndarray, l1: float) -> float | np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_part(g: np.ndarray, h: np.ndarray, p: TreeParams) -> np.ndarray:
    """What a leaf with these sums takes off the loss, times two."""
    t, below = shrunk(g, p.reg_alpha), h + p.reg_lambda
    return np.divide(t * t, below, out=np.zeros_like(t), where=below > 0)


def leaf_value(g: float, h: float, p: TreeParams) -> float:
    below = h + p.reg_lambda
    return float(-shrunk(g, p.reg_alpha) / below) * p.learning_rate if below > 0 else 0.0


def sampled_columns(m: Member, turn: int, unit: int, count: int) -> np.ndarray:
    """Which columns a tree may use: a share that depends on the seed, the round and the class alone."""
    taken = max(1, round(m.params.colsample * count))
    if taken == count:
        return np.ones(count, bool)
    order = sorted(range(count), key=lambda c: hashlib.md5(f"{m.seed}:{turn}:{unit}:{c}".encode()).hexdigest())
    out = np.zeros(count, bool)
    out[order[:taken]] = True
    return out


def best_split(
    sums: np.ndarray, allowed: np.ndarray, p: TreeParams
) -> tuple[int, int, float, tuple[float, float, int]]:
    """Feature, bin, gain and the left side's sums of a leaf's best split; feature -1 if there is none.

    ``sums`` has gradients, hessians and counts by (feature, bin).
    """
    g, h = sums[0] / GRID, sums[1] / GRID
    gl, hl, nl = g.cumsum(1), h.cumsum(1), sums[2].cumsum(1)
    gt, ht, nt = gl[:, -1:], hl[:, -1:], nl[:, -1:]
    ok = (nl >= p.min_child_samples) & (nt - nl >= p.min_child_samples)
    ok &= (hl >= p.min_child_weight) & (ht - hl >= p.min_child_weight) & allowed[:, None]
    ok[:, -1] = False
    gain = leaf_part(gl, hl, p) + leaf_part(gt - gl, ht - hl, p) - leaf_part(gt, ht, p)
    gain = np.where(ok, gain, -np.inf)
    at = int(gain.argmax())
    f, b = divmod(at, gain.shape[1])
    if not gain[f, b] > 0:
        return -1, -1, 0.0, (0.0, 0.0, 0)
    return f, b, float(gain[f, b]), (float(gl[f, b]), float(hl[f, b]), int(nl[f, b]))


# -- growth ---------------------------------------------------------------------------------------


class _Growing:
    """A tree under construction: every known node, its sums and, once looked at, its best split."""

    def __init__(self, m: Member, allowed: np.ndarray):
        self.member, self.allowed = m, allowed
        self.tree = Tree()
        self.sums: list[tuple[float, float, int] | None] = []
        self.depth: list[int] = []
        self.split: list[tuple | None] = []  # feature, bin, gain, left sums
        self._add(None, 0)
        self.pending = [0]
        self.chosen: list[int] = []

    def _add(self, sums: tuple[float, float, int] | None, depth: int) -> int:
        for column, value in ((self.tree.feature, -1), (self.tree.bin, -1), (self.tree.left, -1), (self.tree.right, -1)):
            column.append(value)
        self.sums.append(sums)
        self.depth.append(depth)
        self.split.append(None)
        return len(self.depth) - 1

    def learn(self, node: int, total: tuple[float, float, int], split: tuple) -> None:
        self.sums[node] = total
        self.split[node] = split

    def _splittable(self, node: int) -> bool:
        p = self.member.params
        deep = 0 <= p.max_depth <= self.depth[node]
        return not deep and self.sums[node][2] >= 2 * p.min_child_samples

    def plan(self) -> list[int]:
        """Nodes that best-first growth splits, by what is known; unknown ones become pending."""
        self.pending = []
        chosen: list[int] = []
        heap = [(-self.split[0][2], 0)] if self.split[0] and self.split[0][0] >= 0 else []
        while heap and len(chosen) < self.member.params.num_leaves - 1:
            _, node = heapq.heappop(heap)
            chosen.append(node)
            if self.tree.left[node] < 0:
                f, b, _, (g, h, n) = self.split[node]
                total = self.sums[node]
                self.tree.feature[node], self.tree.bin[node] = f, b
                self.tree.left[node] = self._add((g, h, n), self.depth[node] + 1)
                rest = (total[0] - g, total[1] - h, total[2] - n)
                self.tree.right[node] = self._add(rest, self.depth[node] + 1)
            for child in (self.tree.left[node], self.tree.right[node]):
                if self.split[child] is None:
                    if self._splittable(child):
                        self.pending.append(child)
                    else:
                        self.split[child] = (-1, -1, 0.0, None)
                elif self.split[child][0] >= 0:
                    heapq.heappush(heap, (-self.split[child][2], child))
        return chosen

    def finished(self, chosen: list[int]) -> Tree:
        """The tree with the chosen splits alone, numbered anew."""
        out, split = Tree(), set(chosen)
        number = {0: 0}
        order = [0]
        for node in order:
            inner = node in split
            if inner:
                for child in (self.tree.left[node], self.tree.right[node]):
                    number[child] = len(order)
                    order.append(child)
            out.feature.append(self.tree.feature[node] if inner else -1)
            out.bin.append(self.tree.bin[node] if inner else -1)
            out.left.append(number[self.tree.left[node]] if inner else -1)
            out.right.append(number[self.tree.right[node]] if inner else -1)
            out.gain.append(self.split[node][2] if inner else 0.0)
            g, h, _ = self.sums[node] or (0.0, 0.0, 0)
            # A tree without a split says nothing.
            out.value.append(0.0 if inner or not chosen else leaf_value(g, h, self.member.params))
        return out


_HISTOGRAM = "unit int, node int, place binary, g binary, h binary, n binary"
_SPLIT = "unit int, node int, feature int, bin int, gain double, gl double, hl double, nl bigint, gt double, ht double, nt bigint"


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    if name == "bins":
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _histograms(
    rows: DataFrame, members: Sequence[Member], growing: list[_Growing], width: int
) -> DataFrame:
    """Histograms of all pending nodes (``_HISTOGRAM``), partly summed by the tasks."""
    starts = np.cumsum([0, *[m.units for m in members]])
    open_ = [
        (k, m, [(u, growing[u].tree, growing[u].pending) for u in range(starts[k], starts[k + 1]) if growing[u].pending])
        for k, m in enumerate(members)
    ]
    open_ = [x for x in open_ if x[2]]
    schema = pa.schema(
        [("unit", pa.int32()), ("node", pa.int32()), *[(c, pa.binary()) for c in ("place", "g", "h", "n")]]
    )

    def flushed(held: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = list(held)
        for k in range(0, len(keys), 500):
            columns: list[list] = [[] for _ in schema]
            for unit, node in keys[k : k + 500]:
                sums = held[unit, node]
                place = np.flatnonzero(sums[2])
                values = (unit, node, place.astype(np.int32).tobytes(), *[s[place].tobytes() for s in sums])
                for column, value in zip(columns, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, scores, labels = (_matrix(batch, c) for c in ("bins", "scores", "labels"))
            train = batch.column(batch.schema.get_field_index("train")).to_numpy()
            cell = bins.astype(np.int64) + np.arange(bins.shape[1]) * width
            size = bins.shape[1] * width
            for k, m, units in open_:
                mine = np.flatnonzero(train >> m.fold & 1)
                if not len(mine):
                    continue
                g, h = gradients(m, scores[mine, starts[k] : starts[k + 1]], labels[mine, m.label])
                for unit, tree, pending in units:
                    node = tree.leaves_of(bins[mine])
                    slot = np.full(len(tree.feature), -1)
                    slot[pending] = np.arange(len(pending))
                    at = slot[node]
                    inside = at >= 0
                    if not inside.any():
                        continue
                    place = (cell[mine[inside]] + at[inside, None] * size).ravel()
                    c = unit - starts[k]
                    total = len(pending) * size
                    sums = [
                        np.bincount(place, np.repeat(x[inside, c], bins.shape[1]), total) for x in (g, h)
                    ] + [np.bincount(place, minlength=total)]
                    table = np.stack([s.astype(np.int64) for s in sums]).reshape(3, len(pending), size)
                    for j in np.unique(at[inside]).tolist():
                        key = (unit, pending[j])
                        held[key] = held[key] + table[:, j] if key in held else table[:, j].copy()
                if len(held) * 3 * size > HELD:
                    yield from flushed(held)
        yield from flushed(held)

    return rows.select("bins", "scores", "labels", "train").mapInArrow(run, _HISTOGRAM)


def _best_splits(
    histograms: DataFrame, growing: list[_Growing], columns: int, width: int
) -> DataFrame:
    """The best split (``_SPLIT``) of every (unit, node) whose histograms are given in parts."""
    params = [g.member.params for g in growing]
    allowed = [g.allowed for g in growing]
    names = [c.split()[0] for c in _SPLIT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(key: tuple[int, int], sums: np.ndarray) -> tuple:
            table = sums.reshape(3, columns, width)
            split = best_split(table, allowed[key[0]], params[key[0]])
            total = table[:, 0].sum(1)
            left = split[3]
            return (*key, *split[:3], *left, total[0] / GRID, total[1] / GRID, int(total[2]))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32()] * 4 + [pa.float64()] * 3 + [pa.int64()] + [pa.float64()] * 2 + [pa.int64()]
            arrays = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(arrays, names)

        key, sums = None, None
        for batch in batches:
            rows = []
            for unit, node, place, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                if (unit, node) != key:
                    if key is not None:
                        rows.append(found(key, sums))
                    key, sums = (unit, node), np.zeros((3, columns * width), np.int64)
                sums[:, np.frombuffer(place, np.int32)] += np.stack([np.frombuffer(x, np.int64) for x in parts])
            yield batch_of(rows)
        if key is not None:
            yield batch_of([found(key, sums)])

    merged = histograms.repartition("unit", "node").sortWithinPartitions("unit", "node")
    return merged.mapInArrow(run, _SPLIT)


def _with_scores(rows: DataFrame, members: Sequence[Member]) -> DataFrame:
    start = [float(s) for m in members for s in m.start]
    return rows.withColumn("scores", F.array(*[F.lit(s) for s in start]))


def _advanced(rows: DataFrame, trees: list[Tree]) -> DataFrame:
    """Rows with the trees' values added to their scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = [np.array(t.value) for t in trees]
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, scores = _matrix(batch, "bins"), _matrix(batch, "scores").copy()
            for k, (tree, value) in enumerate(zip(trees, values)):
                scores[:, k] += value[tree.leaves_of(bins)]
            offsets = np.arange(0, scores.size + 1, scores.shape[1], dtype=np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores.ravel()))
            place = batch.schema.get_field_index("scores")
            yield batch.set_column(place, batch.schema.field(place).name, column)

    return rows.mapInArrow(run, rows.schema)


@dataclass(frozen=True)
class Forest:
    """Fitted models: one list of trees per unit, in order of rounds."""

    members: tuple[Member, ...]
    trees: tuple[tuple[Tree, ...], ...]

    def scores(self, bins: np.ndarray) -> np.ndarray:
        """Raw scores (rows x units) of binned rows."""
        start = [s for m in self.members for s in m.start]
        out = np.tile(np.array(start, float), (len(bins), 1))
        for k, trees in enumerate(self.trees):
            for tree in trees:
                out[:, k] += np.array(tree.value)[tree.leaves_of(bins)]
        return out


def fit(
    rows: DataFrame, members: Sequence[Member], rounds: int, columns: int, width: int = BINS,
    keep_trees: bool = True,
) -> tuple[Forest, DataFrame]:
    """Grow ``rounds`` trees per unit; the models, and the rows with the final ``scores`` of all units.

    ``columns`` and ``width`` are the number of binned columns and of bins. Rows that no model learns
    from are scored all the same, as test rows are.
    """
    units = [(k, u) for k, m in enumerate(members) for u in range(m.units)]
    per_file = max(1000, SCORES_PER_FILE // max(1, len(units)))
    state = _with_scores(rows, members)
    grown: list[list[Tree]] = [[] for _ in units]
    for turn in range(rounds):
        growing = [_Growing(members[k], sampled_columns(members[k], turn, u, columns)) for k, u in units]
        waiting = list(growing)
        while any(g.pending for g in growing):
            splits = _best_splits(_histograms(state, members, growing, width), growing, columns, width)
            seen = {(r.unit, r.node): r for r in splits.collect()}
            for unit, g in enumerate(growing):
                for node in g.pending:
                    r = seen.get((unit, node))  # no row of the model's reaches a node without one
                    total = (r.gt, r.ht, r.nt) if r else (0.0, 0.0, 0)
                    g.learn(node, total, (r.feature, r.bin, r.gain, (r.gl, r.hl, r.nl)) if r else (-1, -1, 0.0, None))
            for g in waiting:
                g.chosen = g.plan()
            waiting = [g for g in waiting if g.pending]
        trees = [g.finished(g.chosen) for g in growing]
        for known, tree in zip(grown, trees):
            if keep_trees:
                known.append(tree)
        advanced = _advanced(state, trees)
        state = _written_state(advanced, per_file)
    return Forest(tuple(members), tuple(map(tuple, grown))), state


def _written_state(state: DataFrame, per_file: int) -> DataFrame:
    path = shared_dir(state.sparkSession, "boost-scores")
    state.write.option("maxRecordsPerFile", per_file).parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def scorer(forest: Forest, edges: Sequence[Sequence[float]]) -> Callable[[Column], Column]:
    """A function from a column of feature arrays to the array of raw scores, in Arrow batches."""
    bounds = [np.array(e, float) for e in edges]

    @F.pandas_udf("array<double>")
    def score(values):  # noqa: ANN001, ANN202 - the decorator reads annotations
        import pandas as pd

        if not len(values):
            return pd.Series([], dtype=object)
        table = np.stack(values.to_numpy())
        bins = np.empty(table.shape, np.uint8)
        for k, b in enumerate(bounds):
            bins[:, k] = np.searchsorted(b, table[:, k], side="left")
        return pd.Series(list(forest.scores(bins)))

    return score


# -- tables of trees ------------------------------------------------------------------------------


def tree_table(spark: SparkSession, forest: Forest) -> DataFrame:
    """``unit, turn, node, feature, bin, low, high, value, gain``: one row per node."""
    rows = [
        (u, turn, k, *node)
        for u, trees in enumerate(forest.trees)
        for turn, t in enumerate(trees)
        for k, node in enumerate(zip(t.feature, t.bin, t.left, t.right, t.value, t.gain))
    ]
    return spark.createDataFrame(
        rows,
        "unit int, turn int, node int, feature int, bin int, low int, high int, value double, gain double",
    )


def forest_of(table: DataFrame, members: Sequence[Member]) -> Forest:
    """Read back what :func:`tree_table` gives; trees are small, rows never pass here."""
    units = sum(m.units for m in members)
    trees: list[dict[int, Tree]] = [{} for _ in range(units)]
    for r in table.orderBy("unit", "turn", "node").collect():
        t = trees[r.unit].setdefault(r.turn, Tree())
        for column, value in zip(
            (t.feature, t.bin, t.left, t.right, t.value, t.gain),
            (r.feature, r.bin, r.low, r.high, r.value, r.gain),
        ):
            column.append(value)
    return Forest(tuple(members), tuple(tuple(t[k] for k in sorted(t)) for t in trees))
