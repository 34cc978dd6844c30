"""Long and wide forms: measurements, metric histories, parameters and exports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.operators.folds import BOUNDS

#: Names of pipeline stage runs, which are never parent runs (fixed values).
STAGE_RUNS = ("preprocess", "train_1st", "train_2nd", "build", "evaluate")


def pivot_fields(
    long: DataFrame, fields: Sequence[str] = S.OHLCV, keys: Sequence[str] = (S.SYMBOL, S.TS)
) -> DataFrame:
    """Rows ``(keys, field, value)`` to one column per listed field, times cut to seconds.

    A key keeps a row when any of its fields exists. The newest point of a second wins.
    """
    second = F.date_trunc("second", F.col(S.TS))
    seen = long.withColumns({"__at": F.col(S.TS), S.TS: second}).where(F.col("field").isin(*fields))

    def pick(field: str) -> Column:
        return F.max_by(
            F.when(F.col("field") == field, F.col("value")),
            F.when(F.col("field") == field, F.col("__at")),
        ).alias(field)

    return seen.groupBy(*keys).agg(*[pick(field) for field in fields])


def align_series(series: Sequence[DataFrame], keys: Sequence[str] = (S.SYMBOL, S.TS)) -> DataFrame:
    """Full outer alignment of separate series on their key."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), series)


def unpivot(df: DataFrame, ids: Sequence[str], names: Sequence[str], prefix: str = "") -> DataFrame:
    """Named columns to rows ``(ids, key, value)``."""
    out = df.unpivot(list(ids), list(names), "key", "value")
    if prefix:
        out = out.withColumn("key", F.concat(F.lit(prefix), "key"))
    return out.withColumn("value", F.col("value").cast("double"))


def fold_table(history: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Metric history ``(run_id, key, value, step)`` to fold bounds as timestamps."""
    names = [f"{b}_index" for b in BOUNDS]
    wide = (
        history.where(F.col("key").isin(*names))
        .groupBy(*keys, F.col("step").alias("fold"))
        .pivot("key", names)
        .agg(F.max("value"))
    )
    return wide.select(*keys, "fold", *[F.timestamp_seconds(n).alias(n) for n in names])


def first_metrics(
    history: DataFrame, names: Sequence[str], keys: Sequence[str] = ("run_id",)
) -> DataFrame:
    """First recorded value of each named metric, one column per name."""
    chosen = history.where(F.col("key").isin(*names))
    return chosen.groupBy(*keys).agg(
        *[
            F.min_by(
                F.when(F.col("key") == n, F.col("value")),
                F.when(F.col("key") == n, F.col("timestamp")),
            ).alias(n)
            for n in names
        ]
    )


def eval_bounds(history: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    names = ["eval_start_index", "eval_end_index"]
    first = first_metrics(history, names, keys)
    return first.select(*keys, *[F.timestamp_seconds(n).alias(n) for n in names])


def best_parameters(
    history: DataFrame, types: dict[str, str], keys: Sequence[str] = ("run_id",)
) -> DataFrame:
    """Tracked ``best_<name>`` values as typed parameter columns."""
    first = first_metrics(history, [f"best_{n}" for n in types], keys)
    return first.select(*keys, *[F.col(f"best_{n}").cast(t).alias(n) for n, t in types.items()])


def previous_run_tag(
    runs: DataFrame, tags: DataFrame, key: str = "source.git.commit", recent: int = 12
) -> DataFrame:
    """Tag value of the second newest parent run among the ``recent`` newest runs, '' if none."""
    newest = runs.orderBy(F.desc("start_time"), "run_uuid").limit(recent)
    rank = F.row_number().over(Window.orderBy(F.desc("start_time"), "run_uuid"))
    previous = (
        newest.where(~F.col("name").isin(*STAGE_RUNS))
        .withColumn("__rank", rank)  # at most ``recent`` rows reach this window
        .where("__rank = 2")
        .select("run_uuid")
    )
    found = tags.where(F.col("key") == key).join(previous, "run_uuid", "left_semi")
    return found.agg(F.coalesce(F.max("value"), F.lit("")).alias("value"))


def latest_artifact(paths: DataFrame, prefix: str, column: str = "path") -> DataFrame:
    """Lexicographically last path under the data folder that contains the prefix."""
    inside = F.col(column).contains("data/") & F.col(column).contains(prefix)
    return paths.where(inside).agg(F.max(column).alias(column))


def pnl_series(
    backtested: DataFrame,
    first: int | Column,
    key: str = "pnl",
    drop_missing: bool = True,
    position: str = "i",
) -> DataFrame:
    """PnL points ``(symbol, key, step, timestamp, value)`` for export.

    ``step`` counts the series' exported rows from 0. Positions are consecutive and the first row
    of a backtest has no profit, so the step is the position less that of the backtest's second
    row; ``first`` is the position of its first one, a number or an expression of the row.
    """
    rows = backtested.where("pnl IS NOT NULL") if drop_missing else backtested
    start = F.lit(first) if isinstance(first, int) else first
    return rows.select(
        S.SYMBOL,
        F.lit(key).alias("key"),
        (F.col(position) - start - (1 if drop_missing else 0)).cast("bigint").alias("step"),
        F.unix_millis(F.col(S.TS).cast("timestamp")).alias("timestamp"),
        F.col("pnl").alias("value"),
    )
