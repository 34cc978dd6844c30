"""Parameter search: trials, walk-forward objective and selection."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.functions.scalars import divide
from barloom.operators import backtest as bt
from barloom.operators.blocks import BLOCK, BLOCK_ROWS, Blocks
from barloom.operators.folds import bound_exprs, checked, fold_rows, train_length
from barloom.operators.sampler import next_trials
from barloom.operators.signals import (
    ENTRY_LENGTHS,
    ENTRY_POINTS,
    extremes,
    pick_band,
    trial_rows,
)
from barloom.sinks.writers import written

# The searched ranges of the classifier's parameters.
CLASSIFIER_SPACE = {
    "num_leaves": ("int", 4, 128),
    "learning_rate": ("float", 0.5, 0.9),
    "colsample_bytree": ("float", 0.5, 0.9),
    "min_child_samples": ("int", 4, 128),
    "reg_alpha": ("log", 1e-1, 1e4),
    "reg_lambda": ("log", 1e-1, 1e4),
    "max_depth": ("int", 4, 64),
}


def uniform(seed: int, trial: int, name: str) -> float:
    """A number in [0, 1) that depends on nothing but its arguments."""
    digest = hashlib.md5(f"{seed}:{trial}:{name}".encode()).hexdigest()
    return int(digest[:8], 16) / 2.0**32


def draw(kind: str, low: float, high: float, u: float) -> float | int:
    """Map a uniform number to an integer, float or log-uniform range."""
    if kind == "int":
        return int(math.floor(low + u * (high - low + 1)))
    if kind == "log":
        return math.exp(math.log(low) + u * (math.log(high) - math.log(low)))
    return low + u * (high - low)


def signal_trials(n_trials: int, seed: int = 42) -> list[dict]:
    """Random signal parameters; the same trial number always gets the same values."""
    return [
        {
            "trial": t,
            "entry_length": draw("int", *ENTRY_LENGTHS, uniform(seed, t, "entry_length")),
            "entry_point": draw("log", *ENTRY_POINTS, uniform(seed, t, "entry_point")),
        }
        for t in range(n_trials)
    ]


#: The searched ranges of the signal's parameters, as the sampler takes them.
SIGNAL_SPACE = {"entry_length": ("int", *ENTRY_LENGTHS), "entry_point": ("log", *ENTRY_POINTS)}


def sequential_search(
    positioned: DataFrame,
    account: S.BacktestParams = S.BacktestParams(),
    params: S.OptimizeParams = S.OptimizeParams(),
    batch: int = 20,
    strict: bool = True,
) -> DataFrame:
    """Best signal parameters per symbol from batches of proposals, ``params.n_trials`` in all.

    The first batch is random; each later one is proposed from the metrics so far, averaged over the
    symbols, and scored for all symbols as one job. The driver holds the trials only.
    """
    trials = signal_trials(min(batch, params.n_trials), account.seed)
    scores = None
    fresh = trials
    while fresh:
        found = written(
            with_parameters(trial_scores(fold_scores(positioned, fresh, account, params, strict)), fresh),
            "sequential",
        )
        scores = found if scores is None else scores.unionByName(found)
        count = min(batch, params.n_trials - len(trials))
        if not count:
            break
        pooled = scores.groupBy("trial", *SIGNAL_SPACE).agg(F.avg("metric").alias("metric"))
        proposed = next_trials(
            pooled, SIGNAL_SPACE, len(trials), count, params.direction, account.seed, keys=()
        )
        fresh = [r.asDict() for r in proposed.orderBy("trial").collect()]
        trials = trials + fresh
    return best_trial(scores, params.direction)


def classifier_trials(n_trials: int, seed: int = 42, space: dict = CLASSIFIER_SPACE) -> list[dict]:
    """Random classifier parameters, one set for buys and one for sells."""
    return [
        {
            "trial": t,
            **{
                f"{name}_{side}": draw(*limits, uniform(seed, t, f"{name}_{side}"))
                for side in ("buy", "sell")
                for name, limits in space.items()
            },
        }
        for t in range(n_trials)
    ]


def fold_scores(
    positioned: DataFrame,
    trials: list[dict],
    account: S.BacktestParams = S.BacktestParams(),
    params: S.OptimizeParams = S.OptimizeParams(),
    strict: bool = True,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Backtest metric of every (symbol, trial, fold) over the fold's train range, as one job.

    Signals are taken over the whole series and then sliced; a backtest restarts in every slice.
    Bars are exchanged once by (symbol, block). Trials multiply rows inside a task, and so do
    folds unless all of them share one backtest. The multiplied rows never meet a shuffle: the
    runs that enter a block are packed into one row per (symbol, block), at most one entry per
    trial and fold, joined to the bars before these are multiplied. Nothing enters a series' only
    block, so series of one block pass once.
    """
    lengths = sorted({t["entry_length"] for t in trials})
    bars = checked(
        positioned.select(S.SYMBOL, *S.PRICES, "i", "n"), params, train_length(params), strict
    )
    several = F.col("n") > block_rows

    def blocked(df: DataFrame) -> Blocks:
        return extremes(Blocks.of(df, before=lengths[-1] + 1, after=1, rows=block_rows), lengths)

    long, bars = blocked(bars.where(several)), blocked(bars)
    shared = params.max_train_size is None
    keys = ("trial",) if shared else ("trial", "fold")

    def runs(df: DataFrame) -> Blocks:
        """Orders and runs of rows multiplied by the trials in ``__t``."""
        df = pick_band(df, lengths, F.col("__t.entry_length"), F.col("__t.entry_point"))
        df = df.withColumn("trial", F.col("__t.trial"))
        df = _until_last_end(df, params) if shared else _in_train_ranges(df, params)
        return bt.add_runs(bt.add_orders(bars.expand(df.drop("n", "__t"), *keys)))

    first = runs(long.df.withColumn("__t", F.explode(trial_rows(trials))))
    state = with_parameters(bt.run_state(first), trials)
    entry = F.struct(*keys, "entry_length", "entry_point", "__in_side", "__in_count")
    packed = state.groupBy(S.SYMBOL, BLOCK).agg(F.collect_list(entry).alias("__entries"))
    entries = F.when(several, F.col("__entries")).otherwise(
        _no_entries(trials, None if shared else params.n_splits, packed)
    )
    entered = bars.df.join(packed, [S.SYMBOL, BLOCK], "left").withColumn("__t", F.explode(entries))
    entered = entered.drop("__entries").withColumns(
        {"__in_side": F.col("__t.__in_side"), "__in_count": F.col("__t.__in_count")}
    )
    traded = bt.settle(runs(entered), account, params.pyramiding)
    if not shared:
        return bt.score(traded, params.optimize_target)
    if params.optimize_target == "max_dd":
        return _expanding_drawdowns(traded, params)
    return _expanding_scores(traded, params)


def _no_entries(trials: list[dict], n_splits: int | None, packed: DataFrame) -> Column:
    """What enters a series' first block, as a literal in the form of ``packed``: no run, in any trial and fold."""
    folds_ = [{}] if n_splits is None else [{"fold": f} for f in range(n_splits)]
    entries = [
        {k: t[k] for k in ("trial", "entry_length", "entry_point")} | fold | {"__in_side": 0}
        for t in trials
        for fold in folds_
    ]
    return F.from_json(F.lit(json.dumps(entries)), packed.schema["__entries"].dataType)


def _in_train_ranges(df: DataFrame, params: S.OptimizeParams) -> DataFrame:
    """Rows once per fold whose train range holds them, or for the fold they already name."""
    named = "fold" in df.schema["__t"].dataType.names
    rows = fold_rows(df, params, role="train", strict=False).drop("role")
    return rows.where(F.col("fold") == F.col("__t.fold")) if named else rows


def _until_last_end(df: DataFrame, params: S.OptimizeParams) -> DataFrame:
    """Rows up to the last train range's end, with every range's end as a column."""
    length = train_length(params)
    ends = {
        f"__end{f}": F.expr(bound_exprs(params, f, length)["train_end"])
        for f in range(params.n_splits)
    }
    return df.withColumns(ends).where(F.col("i") <= F.col(f"__end{params.n_splits - 1}"))


def _expanding_scores(traded: Blocks, params: S.OptimizeParams) -> DataFrame:
    """Scores of train ranges that all start at row 0, from one backtest per trial.

    A longer range repeats every row of a shorter one; only the shorter range's last row differs,
    as nothing fills after it. So each fold sums the common profits up to its last row and takes
    that row's profit at close, and rows are not multiplied by the number of folds.
    """
    sums = []
    for f in range(params.n_splits):
        value = (
            F.when(F.col("i") < F.col(f"__end{f}"), F.col("profit"))
            .when(F.col("i") == F.col(f"__end{f}"), F.col("profit_at_close"))
        )
        if params.optimize_target == "pnl":
            score = F.sum(value)
        else:
            score = divide(F.avg(value), F.stddev_pop(value))
        sums += [score.alias(f"m{f}"), F.max(F.col("i") <= F.col(f"__end{f}")).alias(f"any{f}")]
    wide = traded.own_rows().groupBy(S.SYMBOL, "trial").agg(*sums)
    return _by_fold(wide, params)


def _expanding_drawdowns(traded: Blocks, params: S.OptimizeParams) -> DataFrame:
    """Largest falls of train ranges that all start at row 0, from one backtest per trial.

    A block reports its total and, counted from its own start, its largest fall, high and low; the
    block in which a range ends also reports the fall and low of its rows up to there, the last one
    valued at its close. The rest is arithmetic over the block table.
    """
    running, plain = traded.over(running=True), traded.over()
    blocks = traded.with_exprs({"__inside": f"sum(CASE WHEN own THEN profit END) {running}"})
    blocks = blocks.with_exprs(
        {
            "__peak": f"max(__inside) {running}",
            "__close": "coalesce(__inside, 0D) - coalesce(profit, 0D) + profit_at_close",
        }
    )
    blocks = blocks.with_exprs({"__close_fall": f"greatest(lag(__peak) {plain}, __close) - __close"})
    summary = {
        "__fall": "max(__peak - __inside)",
        "__high": "max(__inside)",
        "__low": "min(__inside)",
        "__total": "sum(profit)",
    }
    last: dict[str, str] = {}
    for f in range(params.n_splits):
        ends = f"__end{f} div {traded.rows} = {BLOCK}"
        inner, at = f"{ends} AND i < __end{f}", f"{ends} AND i = __end{f}"
        summary[f"__fall{f}"] = (
            f"max(CASE WHEN {inner} THEN __peak - __inside WHEN {at} THEN __close_fall END)"
        )
        summary[f"__low{f}"] = f"min(CASE WHEN {inner} THEN __inside WHEN {at} THEN __close END)"
        summary[f"__any{f}"] = f"max(i <= __end{f})"
        summary[f"__ends{f}"] = f"max({ends})"
        last[f"m{f}"] = (
            f"CASE WHEN __ends{f} THEN greatest(__known, __fall{f}, __top_before - __base - __low{f}) END"
        )
        last[f"any{f}"] = f"__any{f}"
    table = blocks.block_state(
        summary,
        [
            {"__base": "coalesce(sum(__total) OVER earlier, 0D)"},
            {"__top": "__base + __high", "__bottom": "__base + __low"},
            {"__top_before": "max(__top) OVER earlier"},
            {"__deepest": "greatest(__fall, __top_before - __bottom)"},
            {"__known": "max(__deepest) OVER earlier"},
            last,
        ],
    )
    most = [F.max(c).alias(c) for f in range(params.n_splits) for c in (f"m{f}", f"any{f}")]
    return _by_fold(table.groupBy(S.SYMBOL, "trial").agg(*most), params)


def _by_fold(wide: DataFrame, params: S.OptimizeParams) -> DataFrame:
    """One row per fold that has rows, from columns ``m<fold>`` and ``any<fold>``."""
    folds_ = ", ".join(f"{f}, m{f}, any{f}" for f in range(params.n_splits))
    long = wide.selectExpr(
        S.SYMBOL, "trial", f"stack({params.n_splits}, {folds_}) AS (fold, metric, occupied)"
    )
    return long.where("occupied").drop("occupied")


def trial_scores(scores: DataFrame) -> DataFrame:
    """Mean metric over folds."""
    return scores.groupBy(S.SYMBOL, "trial").agg(F.avg("metric").alias("metric"))


def with_parameters(scores: DataFrame, trials: list[dict]) -> DataFrame:
    """Attach the trial's parameters, read from a literal map inside the plan."""
    names = [k for k in trials[0] if k != "trial"]
    columns = {}
    for name in names:
        kind = "int" if isinstance(trials[0][name], int) else "double"
        pairs = [F.lit(x) for t in trials for x in (t["trial"], t[name])]
        columns[name] = F.element_at(F.create_map(*pairs), F.col("trial")).cast(kind)
    return scores.withColumns(columns)


def best_trial(
    scores: DataFrame, direction: str, keys: Sequence[str] = (S.SYMBOL,)
) -> DataFrame:
    """The best trial per key; ties go to the lowest trial number. NULL metrics never win.

    A key has one row per trial, so its window is small; the pick is a hash aggregate.
    """
    signed = F.col("metric") if direction == "maximize" else -F.col("metric")
    rest = [c for c in scores.columns if c not in (*keys, "trial")]
    everything = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    top = scores.where("metric IS NOT NULL").withColumn("__top", F.max(signed).over(everything))
    return (
        top.where(signed == F.col("__top"))
        .groupBy(*keys)
        .agg(F.min("trial").alias("trial"), *[F.min_by(c, "trial").alias(c) for c in rest])
        .where("trial IS NOT NULL")
    )


def search_signal(
    positioned: DataFrame,
    trials: list[dict] | None = None,
    account: S.BacktestParams = S.BacktestParams(),
    params: S.OptimizeParams = S.OptimizeParams(),
    strict: bool = True,
) -> DataFrame:
    """Best signal parameters per symbol by mean walk-forward metric."""
    trials = trials if trials is not None else signal_trials(params.n_trials, account.seed)
    scores = trial_scores(fold_scores(positioned, trials, account, params, strict))
    return with_parameters(best_trial(scores, params.direction), trials)
