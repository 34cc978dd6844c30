"""Walk-forward folds and the hold-out slice, as arithmetic on row positions.

A positioned row knows its position ``i`` and its series length ``n``, and fold bounds are
functions of ``n``. Assigning rows to folds therefore needs neither a join nor a shuffle.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.functions.scalars import number
from barloom.operators.blocks import LENGTH, POSITION

#: Fold bound names in the order they are tracked.
BOUNDS = ("train_start", "train_end", "test_start", "test_end")


def train_length(params: S.OptimizeParams) -> str:
    """Rows before the hold-out slice."""
    return f"CAST(floor({LENGTH} * {number(1 - params.evaluate_ratio)}) AS BIGINT)"


def bound_exprs(params: S.OptimizeParams, fold: int, length: str) -> dict[str, str]:
    """First and last positions of one fold's train and test ranges, both inclusive."""
    k = params.n_splits
    size = str(params.test_size) if params.test_size is not None else f"({length} div {k + 1})"
    test_start = f"({length} - {k - fold} * {size})"
    train_stop = f"({test_start} - {params.gap})"
    train_start = "0L"
    if params.max_train_size is not None:
        train_start = f"greatest(0L, {train_stop} - {params.max_train_size})"
    return {
        "train_start": train_start,
        "train_end": f"{train_stop} - 1",
        "test_start": test_start,
        "test_end": f"{test_start} + {size} - 1",
    }


def enough_rows(params: S.OptimizeParams, length: str) -> str:
    """Whether a series can be cut: more rows than folds, and a non-empty first train range."""
    k = params.n_splits
    size = str(params.test_size) if params.test_size is not None else f"({length} div {k + 1})"
    return f"({length} >= {k + 1} AND {length} - {params.gap} - {k} * {size} > 0)"


def checked(df: DataFrame, params: S.OptimizeParams, length: str, strict: bool) -> DataFrame:
    """Drop the rows of series too short to be cut, or fail on them."""
    ok = F.expr(enough_rows(params, length))
    if not strict:
        return df.where(ok)
    problem = F.concat(F.lit("too few rows for the folds of series "), F.col(S.SYMBOL))
    return df.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(problem).cast("boolean")))


def left_out(
    positioned: DataFrame, params: S.OptimizeParams = S.OptimizeParams(), holdout: bool = True
) -> DataFrame:
    """Series too short to be cut, with their lengths: what ``strict=False`` leaves out."""
    length = train_length(params) if holdout else LENGTH
    lengths = positioned.groupBy(S.SYMBOL).agg(F.max(LENGTH).alias(LENGTH))
    return lengths.where(~F.expr(enough_rows(params, length)))


def in_fold(params: S.OptimizeParams, fold: int, role: str) -> Column:
    """Rows of one fold's range, as a plain condition on the position."""
    bounds = bound_exprs(params, fold, train_length(params))
    inside = f"{POSITION} BETWEEN {bounds[f'{role}_start']} AND {bounds[f'{role}_end']}"
    return F.expr(f"{enough_rows(params, train_length(params))} AND {inside}")


def fold_bounds(
    positioned: DataFrame,
    params: S.OptimizeParams = S.OptimizeParams(),
    holdout: bool = True,
    strict: bool = True,
) -> DataFrame:
    """One row per (symbol, fold): the four positions and the four timestamps.

    Only rows that are a bound of some fold survive the map side, at most ``4 k`` per series.
    With ``strict`` a series that is too short raises; otherwise it gets no folds.
    """
    length = train_length(params) if holdout else LENGTH
    marks = []
    for fold in range(params.n_splits):
        for name, position in bound_exprs(params, fold, length).items():
            marks.append(
                f"CASE WHEN {POSITION} = {position} THEN"
                f" named_struct('fold', {fold}, 'bound', '{name}') END"
            )
    hits = (
        checked(positioned, params, length, strict)
        .select(S.SYMBOL, S.TS, POSITION, F.expr(f"array_compact(array({', '.join(marks)}))").alias("m"))
        .where(F.size("m") > 0)
        .select(S.SYMBOL, S.TS, POSITION, F.explode("m").alias("m"))
        .select(S.SYMBOL, S.TS, POSITION, "m.fold", "m.bound")
    )

    def at(name: str, column: str) -> Column:
        return F.max(F.when(F.col("bound") == name, F.col(column)))

    return hits.groupBy(S.SYMBOL, "fold").agg(
        *[at(name, POSITION).alias(f"{name}_i") for name in BOUNDS],
        *[at(name, S.TS).alias(f"{name}_ts") for name in BOUNDS],
    )


def fold_rows(
    positioned: DataFrame,
    params: S.OptimizeParams = S.OptimizeParams(),
    role: Literal["train", "test", "both"] = "both",
    holdout: bool = True,
    strict: bool = True,
) -> DataFrame:
    """Rows with ``fold`` and ``role``; a row appears once per range that contains it."""
    length = train_length(params) if holdout else LENGTH
    roles = ("train", "test") if role == "both" else (role,)
    uses = []
    for fold in range(params.n_splits):
        bounds = bound_exprs(params, fold, length)
        for r in roles:
            uses.append(
                f"CASE WHEN {POSITION} BETWEEN {bounds[f'{r}_start']} AND {bounds[f'{r}_end']}"
                f" THEN named_struct('fold', {fold}, 'role', '{r}') END"
            )
    return (
        checked(positioned, params, length, strict)
        .withColumn("__use", F.explode(F.expr(f"array_compact(array({', '.join(uses)}))")))
        .withColumns({"fold": F.col("__use.fold"), "role": F.col("__use.role")})
        .drop("__use")
    )


def holdout_start(params: S.OptimizeParams) -> Column:
    """Position of the hold-out slice's first row."""
    return F.expr(f"{train_length(params)} + {params.gap}")


def in_holdout(params: S.OptimizeParams) -> Column:
    """Rows of the hold-out slice: ``gap`` rows after the training part, to the end."""
    return F.expr(f"{POSITION} >= {train_length(params)} + {params.gap}")


def holdout_bounds(
    positioned: DataFrame, params: S.OptimizeParams = S.OptimizeParams()
) -> DataFrame:
    """First and last timestamp of the hold-out slice, per symbol."""
    return (
        positioned.where(in_holdout(params))
        .groupBy(S.SYMBOL)
        .agg(F.min(S.TS).alias("eval_start"), F.max(S.TS).alias("eval_end"))
    )


def in_first_train(params: S.OptimizeParams, holdout: bool = True) -> Column:
    """Rows of fold 0's train range, the only ones a leak-free scaler may see."""
    length = train_length(params) if holdout else LENGTH
    bounds = bound_exprs(params, 0, length)
    return F.expr(f"{POSITION} BETWEEN {bounds['train_start']} AND {bounds['train_end']}")


def bound_metrics(bounds: DataFrame, holdout: DataFrame) -> DataFrame:
    """Fold and hold-out bounds as metric rows ``(symbol, key, value, step)`` in epoch seconds."""
    pairs = ", ".join(
        f"'{name}_index', CAST(unix_seconds({name}_ts) AS DOUBLE)" for name in BOUNDS
    )
    folds = bounds.selectExpr(
        S.SYMBOL, f"stack({len(BOUNDS)}, {pairs}) AS (key, value)", "CAST(fold AS BIGINT) AS step"
    )
    ends = holdout.selectExpr(
        S.SYMBOL,
        "stack(2, 'eval_start_index', CAST(unix_seconds(eval_start) AS DOUBLE),"
        " 'eval_end_index', CAST(unix_seconds(eval_end) AS DOUBLE)) AS (key, value)",
        "0L AS step",
    )
    return folds.unionByName(ends)
