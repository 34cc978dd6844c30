"""Quality scores by positive-unlabelled learning.

Trusted positives are documents labelled as good outside the held-out fold; the unlabelled set is the
web text itself, every document of the table without regard to labels. A linear model on binned text
statistics minimises the non-negative unbiased risk
``prior * E_pos[l(g)] + max(0, E_unl[l(-g)] - prior * E_pos[l(-g)])`` with the logistic loss, for which
the risk inside the maximum's bound is convex. Where a step takes the second term below zero, its
gradient is followed the other way until it is not, so that the model does not fit the unlabelled set as
negatives. The prior is the share of good documents among the labelled rows outside the held-out fold.

Statistics of all documents are written once. Bin edges, means and deviations come from all of them,
and every step of the fit is one Spark aggregate of the risk's sums over all rows: a few hundred numbers
per task, however many rows there are. Sums are whole multiples of ``1 / GRID``, so their order does not
matter. At most ``POSITIVE_ROWS`` labelled documents, chosen by hash of the id, are the positives.
Language, source, id and labels are no inputs of a score.

Null and empty texts have all statistics at zero and a score like any other; very long texts are read
whole. Where there are no trusted positives, every score is the prior. Rows that repeat or share an id
score alike if their texts do, and each counts; a labelled id with several rows is that many positives.
Ties at a bin's edge fall into the lower bin. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import held_out, map_batches, text_or_empty
from barloom.llm.logistic import sigmoid
from barloom.sinks.writers import written

#: Bound of the labelled sample.
POSITIVE_ROWS = 8_000
BINS = 10
#: Share of the rows by which a bin's edge may be off.
EDGE_ERROR = 0.005
STEPS = 40
RIDGE = 1e-4
THRESHOLD = 0.3
#: Steps of the sums per unit.
GRID = 1 << 24

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = b"0123456789"
_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOL = b"#*$%&|<>"
_STOP = b".,;:?"

STATISTICS = (
    "log_words", "mean_word", "upper", "lower", "digits", "symbols", "stops", "exclaims", "pipes",
    "other", "space", "distinct", "top_word", "repeats", "repeated_pairs", "line_words",
    "repeated_lines", "longest_word", "capitals", "ends_in_symbol",
)


def statistics(text: str) -> list[float]:
    """Numbers that describe the form of a text, in the order of ``STATISTICS``."""
    raw = text.encode()
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    size, n = len(raw), len(words)

    def share(of: bytes) -> float:
        return (size - len(raw.translate(None, of))) / size

    upper, lower, digits, symbols = share(_UPPER), share(_LOWER), share(_DIGIT), share(_SYMBOL)
    stops, exclaims, space = share(_STOP), raw.count(b"!") / size, share(_SPACE)
    counts = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    pairs = Counter(zip(words, words[1:]))
    repeated = sum(c for c in pairs.values() if c > 1) / n
    return [
        math.log1p(n),
        (size * (1 - space)) / n,
        upper,
        lower,
        digits,
        symbols,
        stops,
        exclaims,
        raw.count(b"|") / n,
        1 - upper - lower - digits - symbols - stops - exclaims - space,
        space,
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        repeated,
        math.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines),
        math.log1p(max(map(len, counts))),
        sum(c for w, c in counts.items() if w[:1].isupper()) / n,
        sum(c for w, c in counts.items() if w[-1:] in b"#*$%&|<>!") / n,
    ]


@dataclass
class QualityModel:
    """Bin edges for each statistic and the weights of the bins; the last one is the intercept."""

    edges: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def constant(cls, prior: float) -> "QualityModel":
        k = len(STATISTICS)
        weights = np.zeros(k + k * BINS + 1)
        weights[-1] = math.log(prior / (1 - prior))
        return cls(np.zeros((k, BINS - 1)), np.zeros(k), np.ones(k), weights)

    def inputs(self, x: np.ndarray) -> np.ndarray:
        """Standardised statistics, one indicator per bin, and a one."""
        k = len(STATISTICS)
        hot = np.zeros((len(x), k * BINS + 1))
        rows = np.arange(len(x))
        for j in range(k):
            hot[rows, j * BINS + np.searchsorted(self.edges[j], x[:, j])] = 1.0
        hot[:, -1] = 1.0
        return np.hstack([np.clip((x - self.mean) / self.scale, -5, 5), hot])

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.inputs(x) @ self.weights) if len(x) else np.zeros(0)

    def score_of(self, x: str) -> Column:
        """Score of a column of statistics."""
        model = self

        @F.pandas_udf("double")
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for rows in batches:
                table = np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, len(STATISTICS)))
                yield pd.Series(model.predict(table), dtype="float64")

        return scores(F.col(x))

    def score(self, text: str = "text") -> Column:
        """Score of a text column."""
        model = self

        @F.pandas_udf("double")
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                x = np.array([statistics(t) for t in texts], float).reshape(len(texts), -1)
                yield pd.Series(model.predict(x), dtype="float64")

        return scores(text_or_empty(text))


@dataclass
class Sums:
    """What the risk needs of all rows at some weights: means over both sets."""

    unlabelled_loss: float  # l(-g) over the unlabelled rows
    positive_loss: float  # l(-g) over the positives
    unlabelled: np.ndarray  # s * input over the unlabelled rows, s the sigmoid of g
    positive: np.ndarray  # s * input over the positives
    inputs: np.ndarray  # input over the positives
    margin: float  # g over the positives

    def risk(self, prior: float, w: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
        """Unbiased risk with its ridge, the part that must not be negative, and both gradients.

        For the logistic loss ``l(g) = l(-g) - g``, so that the positives' two losses leave ``-g``.
        """
        rest = self.unlabelled_loss - prior * self.positive_loss
        total = prior * (self.positive_loss - self.margin) + rest + RIDGE / 2 * float(w @ w)
        falling = self.unlabelled - prior * self.positive
        return total, rest, prior * (self.positive - self.inputs) + falling + RIDGE * w, falling


def row_sums(model: QualityModel, w: np.ndarray, x: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Whole-number sums over some rows: losses, counts and margins, then three sums of inputs."""
    z = model.inputs(x)
    g = z @ w
    s = sigmoid(g)
    loss = np.logaddexp(0.0, g)
    p = positive.astype(float)
    heads = [loss.sum(), float(len(x)), (loss * p).sum(), p.sum(), (g * p).sum()]
    sums = np.concatenate([heads, s @ z, (s * p) @ z, p @ z])
    return np.floor(sums * GRID + 0.5).astype(np.int64)


def means_of(sums: np.ndarray) -> Sums:
    values = sums / GRID
    unlabelled_loss, rows, positive_loss, positives, margin = values[:5]
    parts = values[5:].reshape(3, -1)
    return Sums(
        unlabelled_loss / rows, positive_loss / positives, parts[0] / rows, parts[1] / positives,
        parts[2] / positives, margin / positives,
    )


def minimise(evaluate: Callable[[np.ndarray], Sums], prior: float, size: int, steps: int = STEPS) -> np.ndarray:
    """Weights of least non-negative risk, by limited-memory quasi-Newton steps.

    A step is halved until the risk falls enough. The same sums give the same weights.
    """
    w = np.zeros(size)
    w[-1] = math.log(prior / (1 - prior))
    value, rest, gradient, falling = evaluate(w).risk(prior, w)
    history: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if rest < 0:  # the other way, and no memory of the steps that led here
            w = w + 0.5 * falling / max(1.0, float(np.linalg.norm(falling)))
            value, rest, gradient, falling = evaluate(w).risk(prior, w)
            history = []
            continue
        direction = _two_loops(gradient, history)
        slope = float(gradient @ direction)
        if slope > -1e-9:
            break
        length = 1.0 if history else min(1.0, 1.0 / float(np.abs(gradient).sum()))
        for _ in range(12):
            at = w + length * direction
            found = evaluate(at).risk(prior, at)
            if found[0] <= value + 1e-4 * length * slope:
                break
            length /= 2
        else:
            break
        if float((found[2] - gradient) @ (at - w)) > 1e-12:
            history = [*history, (at - w, found[2] - gradient)][-10:]
        w, (value, rest, gradient, falling) = at, found
    return w


def _two_loops(gradient: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The descent direction of limited-memory BFGS."""
    q, kept = -gradient, []
    for s, y in reversed(history):
        a = float(s @ q) / float(s @ y)
        q = q - a * y
        kept.append(a)
    if history:
        s, y = history[-1]
        q = q * (float(s @ y) / float(y @ y))
    for (s, y), a in zip(history, reversed(kept)):
        q = q + s * (a - float(y @ q) / float(s @ y))
    return q


def fit_table(rows: DataFrame, prior: float) -> QualityModel:
    """Fit on a written table of all rows' statistics (``x``) and whether they are ``positive``."""
    k = len(STATISTICS)
    columns = [F.col("x")[j].alias(f"x{j}") for j in range(k)]
    flat = rows.select(*columns)
    names = flat.columns
    shares = [b / BINS for b in range(1, BINS)]
    edges = np.array(flat.approxQuantile(names, shares, EDGE_ERROR))
    told = flat.agg(*[F.avg(c) for c in names], *[F.stddev_pop(c) for c in names]).first()
    scale = np.array(told[k:])
    scale[scale == 0] = 1.0
    model = QualityModel(edges, np.array(told[:k]), scale, np.zeros(0))

    def evaluate(w: np.ndarray) -> Sums:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    x = batch.column(0).flatten().to_numpy().reshape(-1, k)
                    sums = row_sums(model, w, x, batch.column(1).to_numpy(zero_copy_only=False))
                    total = sums if total is None else total + sums
            if total is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"]
                )

        parts = rows.select("x", "positive").mapInArrow(run, "place bigint, value bigint")
        found = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
        return means_of(np.array([r.value for r in sorted(found, key=lambda r: r.place)], float))

    model.weights = minimise(evaluate, prior, k + k * BINS + 1)
    return model


def _judged(docs: DataFrame, labels: DataFrame, folds: int, fold: int) -> tuple[DataFrame, float]:
    """All documents' statistics with ``doc_id`` and ``positive``, written, and the prior."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("__id"), F.col("quality").alias("quality"))
    train = known.where(F.col("quality").isNotNull() & ~held_out("__id", folds, fold))
    good, all_ = train.agg(
        F.coalesce(F.sum(F.col("quality").cast("int")), F.lit(0)), F.count(F.lit(1))
    ).first()
    order = F.xxhash64(F.col("__id").cast("string"))
    chosen = train.where("quality = 1").select("__id").distinct().orderBy(order, "__id").limit(POSITIVE_ROWS)

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0), "x": [statistics(t) for t in batch.column(1).to_pylist()]}

        return step

    whole = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    table = map_batches(whole, make, "doc_id bigint, x array<double>")
    # At most ``POSITIVE_ROWS`` numbers: a proven bound for the broadcast.
    marked = chosen.withColumnRenamed("__id", "doc_id").withColumn("positive", F.lit(True))
    rows = table.join(F.broadcast(marked), "doc_id", "left")
    rows = rows.withColumn("positive", F.coalesce("positive", F.lit(False)))
    return written(rows, "quality-statistics"), (good + 1.0) / (all_ + 2.0)


def _fitted(rows: DataFrame, prior: float) -> QualityModel:
    if rows.where("positive").isEmpty():
        return QualityModel.constant(prior)
    return fit_table(rows, prior)


def fit_quality(docs: DataFrame, labels: DataFrame, folds: int, fold: int) -> QualityModel:
    """Fit on labelled positives outside the held-out fold and on all documents as unlabelled ones."""
    return _fitted(*_judged(docs, labels, folds, fold))


def quality_scores(
    docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    rows, prior = _judged(docs, labels, folds, fold)
    scored = rows.select(
        "doc_id",
        held_out("doc_id", folds, fold).alias("held_out"),
        _fitted(rows, prior).score_of("x").alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
