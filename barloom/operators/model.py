"""Buy and sell classifiers: fitting, scoring, importances, hold-out evaluation, packaging."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.functions.scalars import quoted
from barloom.operators import backtest as bt
from barloom.operators import boost
from barloom.operators.blocks import BLOCK_ROWS, LENGTH, POSITION, with_position
from barloom.operators.features import features
from barloom.operators.folds import in_fold
from barloom.operators.scaler import apply_scaler
from barloom.operators.search import CLASSIFIER_SPACE, best_trial
from barloom.operators.signals import gate_prices, live_prices, newest_row, tuned_signals

#: Boosting rounds where none are given.
ITERATIONS = 100
SIDES = ("buy", "sell")
LABELS = tuple(f"y_{side}" for side in SIDES)

Edges = Sequence[Sequence[float]]


def classifier(params: dict, side: str) -> boost.TreeParams:
    """Settings of one side's boosted trees from one trial's parameters."""
    return boost.TreeParams(
        num_leaves=int(params[f"num_leaves_{side}"]),
        learning_rate=float(params[f"learning_rate_{side}"]),
        colsample=float(params[f"colsample_bytree_{side}"]),
        min_child_samples=int(params[f"min_child_samples_{side}"]),
        reg_alpha=float(params[f"reg_alpha_{side}"]),
        reg_lambda=float(params[f"reg_lambda_{side}"]),
        max_depth=int(params[f"max_depth_{side}"]),
    )


def balance_weights(df: DataFrame) -> DataFrame:
    """Class weights ``n / (2 * class count)`` per label, as columns.

    Both sides are counted in one pass; the driver reads one row per pair of label values, four
    for binary labels, and the weights go back into the plan as literals.
    """
    counts = df.groupBy(*[f"y_{side}" for side in SIDES]).count().collect()
    total = sum(r["count"] for r in counts)
    columns = {}
    for side in SIDES:
        sizes: dict[int, int] = {}
        for r in counts:
            sizes[r[f"y_{side}"]] = sizes.get(r[f"y_{side}"], 0) + r["count"]
        pairs = [F.lit(x) for label, n in sizes.items() for x in (label, total / (2.0 * n))]
        columns[f"weight_{side}"] = F.element_at(F.create_map(*pairs), F.col(f"y_{side}"))
    return df.withColumns(columns) if counts else df.withColumns(
        {f"weight_{side}": F.lit(None).cast("double") for side in SIDES}
    )


@dataclass(frozen=True)
class Classifiers:
    """The fitted pair; ``columns`` are the model inputs in order, ``edges`` their bins."""

    forest: boost.Forest
    columns: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]

    def scored(self, df: DataFrame) -> DataFrame:
        """Rows with the raw scores of both sides: ``raw_buy`` and ``raw_sell``, one number per tree
        and round (three for three classes)."""
        values = F.array(*[quoted(c).cast("double") for c in self.columns])
        raw = df.withColumn("__raw", boost.scorer(self.forest, self.edges)(values))
        parts, start = {}, 1
        for side, member in zip(SIDES, self.forest.members):
            parts[f"raw_{side}"] = F.slice("__raw", start, member.units)
            start += member.units
        return raw.withColumns(parts).drop("__raw")

    def predict(self, df: DataFrame) -> DataFrame:
        """Rows with ``pred_buy`` and ``pred_sell``; no join, the model keeps the row.

        Two classes: 1 where the score is above zero. More: the class with the largest score, the
        first of equal ones.
        """
        kept = [quoted(c) for c in df.columns]
        preds = [
            predicted(F.col(f"raw_{side}"), member).alias(f"pred_{side}")
            for side, member in zip(SIDES, self.forest.members)
        ]
        return self.scored(df).select(*kept, *preds)

    def save(self, path: str) -> None:
        """Trees, models, and the names and bins of the inputs in order."""
        spark = SparkSession.active()
        inputs = [(k, c, list(e)) for k, (c, e) in enumerate(zip(self.columns, self.edges))]
        members = [(k, json.dumps(asdict(m))) for k, m in enumerate(self.forest.members)]
        for name, table in (
            ("trees", boost.tree_table(spark, self.forest)),
            ("inputs", spark.createDataFrame(inputs, "place int, name string, edges array<double>")),
            ("members", spark.createDataFrame(members, "place int, member string")),
        ):
            table.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, path: str) -> "Classifiers":
        spark = SparkSession.active()
        inputs = spark.read.parquet(f"{path}/inputs").orderBy("place").collect()
        members = []
        for row in spark.read.parquet(f"{path}/members").orderBy("place").collect():
            told = json.loads(row.member)
            lists = {k: tuple(told[k]) for k in ("classes", "weights", "start")}
            members.append(boost.Member(**told | lists | {"params": boost.TreeParams(**told["params"])}))
        forest = boost.forest_of(spark.read.parquet(f"{path}/trees"), members)
        return cls(forest, tuple(r.name for r in inputs), tuple(tuple(r.edges) for r in inputs))


def predicted(raw: Column, member: boost.Member) -> Column:
    """The class (as a double) that a model's raw scores choose."""
    if member.units == 1:
        return F.when(raw[0] > 0, float(member.classes[1])).otherwise(float(member.classes[0]))
    place = F.array_position(raw, F.array_max(raw)).cast("int")
    return F.element_at(F.array(*[F.lit(float(c)) for c in member.classes]), place)


@dataclass(frozen=True)
class CompositeModel:
    """Everything that turns raw bars into gated limit prices.

    ``parameters`` has ``entry_length`` and ``entry_point`` of every symbol, ``scaler`` the state
    of every symbol and column.
    """

    parameters: DataFrame
    scaler: DataFrame
    classifiers: Classifiers

    def save(self, path: str) -> None:
        names = (S.SYMBOL, "entry_length", "entry_point")
        self.parameters.select(*names).write.mode("overwrite").parquet(f"{path}/parameters")
        self.scaler.write.mode("overwrite").parquet(f"{path}/scaler")
        self.classifiers.save(f"{path}/classifiers")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "CompositeModel":
        return cls(
            spark.read.parquet(f"{path}/parameters"),
            spark.read.parquet(f"{path}/scaler"),
            Classifiers.load(f"{path}/classifiers"),
        )

    def score(self, bars: DataFrame) -> DataFrame:
        """Gated limit prices for the newest bar of every symbol that has parameters."""
        return score_latest(bars, self.scaler, self.classifiers, self.parameters)

    def score_live(self, rows: DataFrame) -> DataFrame:
        """The same from rows of :func:`barloom.streaming.live.live_features`, without older bars.

        ``recent_high`` and ``recent_low`` hold at least as many values as any ``entry_length``.
        """
        scored = self.classifiers.predict(
            apply_scaler(newest_row(rows), self.scaler, self.classifiers.columns)
        )
        joined = scored.join(self.parameters.select(S.SYMBOL, "entry_length", "entry_point"), S.SYMBOL)

        def newest(name: str) -> Column:
            return F.slice(name, -F.col("entry_length"), F.col("entry_length"))

        priced = joined.withColumns(
            {
                "sell": F.array_max(newest("recent_high")) * (1 + F.col("entry_point") / 100),
                "buy": F.array_min(newest("recent_low")) * (1 - F.col("entry_point") / 100),
            }
        )
        return live_prices(priced).select(S.SYMBOL, S.TS, "buy_limit_price", "sell_limit_price")


def _classes(counts: dict[tuple[int, int], dict[int, int]]) -> tuple[int, ...]:
    """Two classes where all labels are 0 or 1, else the three of unfilled, bad and good orders."""
    seen = {c for sizes in counts.values() for c in sizes}
    return (0, 1) if seen <= {0, 1} else (-1, 0, 1)


def fit_classifiers(
    train: DataFrame,
    columns: Sequence[str],
    params: dict,
    seed: int = 42,
    class_weight: str = "balanced",
    iterations: int = ITERATIONS,
    edges: Edges | None = None,
) -> Classifiers:
    """Fit the buy and the sell model on labelled rows of all symbols together.

    Bins have equal shares of the rows unless their ``edges`` are given. Labels may be binary or
    -1, 0, 1. Both models grow in the same jobs.
    """
    if train.isEmpty():
        raise ValueError("no labelled rows are left to fit on; the series are too short")
    edges = edges if edges is not None else boost.quantile_edges(train, columns)
    rows = boost.binned_rows(train, columns, edges, LABELS, F.lit(1), [])
    counts = boost.train_counts(rows, 1)
    classes = _classes(counts)
    members = [
        boost.member(
            classifier(params, side), k, 0, counts[k, 0], seed, class_weight == "balanced", classes
        )
        for k, side in enumerate(SIDES)
    ]
    width = 1 + max(len(e) for e in edges)
    forest, _ = boost.fit(rows, members, iterations, len(columns), width)
    return Classifiers(forest, tuple(columns), tuple(map(tuple, edges)))


def importances(fitted: Classifiers, side: str, df: DataFrame) -> DataFrame:
    """``feature, importance, gain``: splits on every model input, and the loss they took off."""
    first = sum(m.units for m in fitted.forest.members[: SIDES.index(side)])
    splits, gains = [0] * len(fitted.columns), [0.0] * len(fitted.columns)
    for trees in fitted.forest.trees[first : first + fitted.forest.members[SIDES.index(side)].units]:
        for tree in trees:
            for f, gain in zip(tree.feature, tree.gain):
                if f >= 0:
                    splits[f] += 1
                    gains[f] += gain
    return df.sparkSession.createDataFrame(
        list(zip(fitted.columns, splits, gains)), "feature string, importance bigint, gain double"
    ).orderBy(F.desc("importance"), "feature")


def classifier_scores(
    labelled: DataFrame,
    columns: Sequence[str],
    trials: list[dict],
    account: S.BacktestParams = S.BacktestParams(),
    params: S.OptimizeParams = S.OptimizeParams(),
    iterations: int = ITERATIONS,
    edges: Edges | None = None,
) -> DataFrame:
    """Mean gated-backtest metric per trial over the folds' test ranges.

    The models of all trials, folds and sides grow together: a row carries the folds whose train
    range holds it, and every job adds up histograms by (model, leaf, feature, bin). Test rows carry
    their scores along, and all gated backtests are one job keyed by (symbol, trial, fold).
    """
    folds = range(params.n_splits)
    train = sum((F.when(in_fold(params, f, "train"), 1 << f).otherwise(0) for f in folds), F.lit(0))
    tested = F.coalesce(*[F.when(in_fold(params, f, "test"), f) for f in folds])
    edges = edges if edges is not None else boost.quantile_edges(labelled.where(train > 0), columns)
    kept = [S.SYMBOL, *S.PRICES, "buy", "sell", POSITION, LENGTH, "fold"]
    rows = labelled.withColumn("fold", tested).where((train > 0) | F.col("fold").isNotNull())
    rows = boost.binned_rows(rows, columns, edges, LABELS, train, kept)
    counts = boost.train_counts(rows, params.n_splits)
    classes = _classes(counts)
    members = [
        boost.member(
            classifier(t, side), k, f, counts.get((k, f), {}), account.seed,
            params.class_weight == "balanced", classes,
        )
        for t in trials for f in folds for k, side in enumerate(SIDES)
    ]
    width = 1 + max(len(e) for e in edges)
    _, scored = boost.fit(rows, members, iterations, len(columns), width, keep_trees=False)
    # A test row meets the models of its own fold, two per trial.
    per_side = members[0].units
    place = (F.col("__t") * params.n_splits + F.col("fold")) * len(SIDES) * per_side
    chosen = scored.where("fold IS NOT NULL").withColumn("__t", F.explode(F.sequence(F.lit(0), F.lit(len(trials) - 1))))
    for k, side in enumerate(SIDES):
        raw = F.slice("scores", (place + k * per_side + 1).cast("int"), per_side)
        chosen = chosen.withColumn(f"pred_{side}", predicted(raw, members[k]))
    numbers = F.array(*[F.lit(t["trial"]) for t in trials])
    rows = gate_prices(chosen).select(*kept, F.get(numbers, F.col("__t")).alias("trial"))
    per_fold = bt.metric(
        rows, params.optimize_target_clf, account, params.pyramiding, keys=(S.SYMBOL, "trial", "fold")
    )
    return per_fold.groupBy(S.SYMBOL, "trial").agg(F.avg("metric").alias("metric"))


def pooled_scores(scores: DataFrame) -> DataFrame:
    """Mean metric of every trial over all symbols."""
    return scores.groupBy("trial").agg(F.avg("metric").alias("metric"))


def chosen_trial(pooled: DataFrame, trials: list[dict], direction: str) -> dict:
    """Parameters of the best trial; the first trial where no trial has a metric."""
    best = best_trial(pooled, direction, keys=()).first()
    by_number = {t["trial"]: t for t in trials}
    return by_number[best.trial] if best else trials[0]


def tracked_trials(
    spark: SparkSession, trials: list[dict], pooled: DataFrame | None, metric: str
) -> DataFrame:
    """Metric rows ``(symbol, step, key, value)`` of all trials: parameters and pooled metric.

    One row per trial and parameter; classifiers are fitted over all symbols, so the symbol is
    ``*``.
    """
    rows = [
        (t["trial"], name, float(value)) for t in trials for name, value in t.items() if name != "trial"
    ]
    long = spark.createDataFrame(rows, "step int, key string, value double")
    if pooled is not None:
        scored = pooled.select(F.col("trial").alias("step"), F.lit(metric).alias("key"), F.col("metric").alias("value"))
        long = long.unionByName(scored)
    return long.select(F.lit("*").alias(S.SYMBOL), "step", "key", "value")


def tracked_best(spark: SparkSession, params: dict) -> DataFrame:
    """Metric rows of the chosen parameters, as ``best_<name>``."""
    rows = [(f"best_{n}", float(v)) for n, v in params.items() if n != "trial"]
    long = spark.createDataFrame(rows, "key string, value double")
    return long.select(F.lit("*").alias(S.SYMBOL), F.lit(0).alias("step"), "key", "value")


#: Types of the tracked classifier parameters, for reading them back.
PARAMETER_TYPES = {
    f"{name}_{side}": "int" if kind == "int" else "double"
    for side in SIDES
    for name, (kind, _, _) in CLASSIFIER_SPACE.items()
}


def evaluate_holdout(
    signal_rows: DataFrame,
    fitted: Classifiers,
    account: S.BacktestParams = S.BacktestParams(),
    pyramiding: int = 3,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Backtests of hold-out rows with and without the model, as variants ``base`` and ``gated``.

    Both variants run through one backtest, with the variant as a further series key.
    """
    scored = fitted.predict(signal_rows)
    columns = [S.SYMBOL, S.TS, *S.PRICES, "buy", "sell", POSITION, "n"]
    base = scored.select(*columns, F.lit("base").alias("variant"))
    gated = gate_prices(scored).select(*columns, F.lit("gated").alias("variant"))
    return bt.backtest(
        base.unionByName(gated), account, pyramiding, (S.SYMBOL, "variant"), block_rows
    )


def score_latest(
    bars: DataFrame,
    scaler: DataFrame,
    fitted: Classifiers,
    parameters: DataFrame,
) -> DataFrame:
    """Gated limit prices for the newest bar of every symbol, from raw bars.

    ``parameters`` has ``symbol, entry_length, entry_point``. A symbol whose newest bar has no
    complete features, or that has no state or parameters, gets no price.
    """
    positioned = bars if POSITION in bars.columns else with_position(bars)
    newest_features = newest_row(features(positioned, keep=(POSITION, LENGTH)))
    scored = fitted.predict(
        apply_scaler(newest_features.drop(POSITION, LENGTH), scaler, fitted.columns)
    )
    prices = newest_row(
        tuned_signals(positioned, parameters).own_rows(
            S.SYMBOL, S.TS, "buy", "sell", POSITION, LENGTH
        )
    )
    joined = prices.join(scored.select(S.SYMBOL, "pred_buy", "pred_sell"), S.SYMBOL)
    return live_prices(joined).select(S.SYMBOL, S.TS, "buy_limit_price", "sell_limit_price")
