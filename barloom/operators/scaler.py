"""Standardisation with a saved, long-form state ``(symbol, column, mean, scale)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.functions.scalars import all_present, quoted
from barloom.operators.blocks import POSITION
from barloom.operators.folds import in_first_train

#: Rows of one series that share a copy of its state when the state is joined back.
PART_ROWS = 65_536


def feature_columns(df: DataFrame, excluded: Sequence[str] = S.NON_FEATURE_COLUMNS) -> list[str]:
    """All columns but the excluded ones and the row position; no data is read."""
    dropped = {*excluded, "i", "n"}
    return [c for c in df.columns if c not in dropped]


def fit_scaler(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean and population deviation per column; a deviation of exactly zero scales by one."""
    columns = list(columns) if columns is not None else feature_columns(df)
    sums = []
    for k, name in enumerate(columns):
        sums.append(F.avg(quoted(name)).alias(f"mean{k}"))
        sums.append(F.stddev_pop(quoted(name)).alias(f"std{k}"))
    wide = df.groupBy(S.SYMBOL).agg(*sums)
    pairs = ", ".join(f"'{name}', mean{k}, std{k}" for k, name in enumerate(columns))
    long = wide.selectExpr(S.SYMBOL, f"stack({len(columns)}, {pairs}) AS (column, mean, std)")
    scale = F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std"))
    return long.select(S.SYMBOL, "column", "mean", scale.alias("scale"))


def join_per_series(df: DataFrame, state: DataFrame) -> DataFrame:
    """Join one state row per symbol to many rows; rows of symbols without state go.

    Positioned rows join on (symbol, part of the series), with one copy of the state for every
    part that exists: the number of tasks of a symbol grows with its rows, and a short symbol has
    one copy. Rows without positions are joined as they are.
    """
    if POSITION not in df.columns:
        return df.join(state, S.SYMBOL)
    parted = df.withColumn("__part", F.floor(F.col(POSITION) / PART_ROWS))
    copies = parted.select(S.SYMBOL, "__part").distinct().join(state, S.SYMBOL)
    return parted.join(copies, [S.SYMBOL, "__part"]).drop("__part")


def without_state(df: DataFrame, state: DataFrame) -> DataFrame:
    """Symbols that have rows but no state, which :func:`join_per_series` leaves out."""
    return df.select(S.SYMBOL).distinct().join(state, S.SYMBOL, "left_anti")


def apply_scaler(df: DataFrame, scaler: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(x - mean) / scale`` for the scaler's columns; other columns and rows pass unchanged.

    ``columns`` names the scaled columns, which must all have a state row per symbol. Rows with a
    missing value are dropped.
    """
    columns = list(columns) if columns is not None else feature_columns(df)

    def of(name: str, part: str):  # noqa: ANN202
        return F.max(F.when(F.col("column") == name, F.col(part)))

    state = scaler.groupBy(S.SYMBOL).agg(
        *[of(name, "mean").alias(f"__mean{k}") for k, name in enumerate(columns)],
        *[of(name, "scale").alias(f"__scale{k}") for k, name in enumerate(columns)],
    )
    joined = join_per_series(df, state)
    place = {name: k for k, name in enumerate(columns)}
    out = joined.select(
        *[
            ((quoted(c) - F.col(f"__mean{place[c]}")) / F.col(f"__scale{place[c]}")).alias(c)
            if c in place
            else quoted(c)
            for c in df.columns
        ]
    )
    return out.where(all_present(out.columns))


def standardise(
    positioned: DataFrame,
    params: S.OptimizeParams = S.OptimizeParams(),
    columns: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Leak-free scaling: state from fold 0's train rows only, applied to all rows."""
    scaler = fit_scaler(
        positioned.where(in_first_train(params)),
        columns if columns is not None else feature_columns(positioned),
    )
    return scaler, apply_scaler(positioned, scaler, columns)


# -- state that grows -----------------------------------------------------------------------------


def day_moments(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``symbol, day, column, rows, mean, m2, low, high`` per day: what merges into scaler state.

    ``m2`` is the sum of squared deviations from the day's mean.
    """
    columns = list(columns) if columns is not None else feature_columns(df)
    sums = []
    for k, name in enumerate(columns):
        c = quoted(name)
        sums += [
            F.count(c).alias(f"rows{k}"), F.avg(c).alias(f"mean{k}"), F.var_pop(c).alias(f"var{k}"),
            F.min(c).alias(f"low{k}"), F.max(c).alias(f"high{k}"),
        ]
    wide = df.groupBy(S.SYMBOL, F.to_date(S.TS).alias("day")).agg(*sums)
    parts = ", ".join(
        f"'{name}', rows{k}, mean{k}, var{k} * rows{k}, low{k}, high{k}" for k, name in enumerate(columns)
    )
    names = "column, rows, mean, m2, low, high"
    return wide.selectExpr(S.SYMBOL, "day", f"stack({len(columns)}, {parts}) AS ({names})").where("rows > 0")


def with_new_days(moments: DataFrame, new: DataFrame) -> DataFrame:
    """Stored day moments and those of new days; a day that comes again replaces the stored one."""
    days = new.select(S.SYMBOL, "day").distinct()
    return moments.join(days, [S.SYMBOL, "day"], "left_anti").unionByName(new)


def scaler_of(moments: DataFrame) -> DataFrame:
    """Scaler state ``(symbol, column, mean, scale)`` from day moments, without reading the rows.

    Means merge by weight; squared deviations add up with those of the days' means from the whole
    mean (pairwise update), so no large sums cancel. A constant column scales by one.
    """
    keys = [S.SYMBOL, "column"]
    whole = Window.partitionBy(*keys)
    # Taken from one day's mean, so that a far level costs no precision.
    placed = moments.withColumns({"__level": F.min("mean").over(whole), "__total": F.sum("rows").over(whole)})
    offset = F.sum(F.col("rows") * (F.col("mean") - F.col("__level"))).over(whole)
    placed = placed.withColumn("__mean", F.col("__level") + offset / F.col("__total"))
    gap = F.col("mean") - F.col("__mean")
    merged = placed.groupBy(*keys).agg(
        F.first("__mean").alias("mean"),
        F.sqrt(F.sum(F.col("m2") + F.col("rows") * gap * gap) / F.sum("rows")).alias("std"),
        (F.min("low") == F.max("high")).alias("constant"),
    )
    scale = F.when(F.col("constant"), F.lit(1.0)).otherwise(F.col("std"))
    return merged.select(S.SYMBOL, "column", "mean", scale.alias("scale"))
