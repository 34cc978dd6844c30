"""Every query of the package over the given tables, by name."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.operators import (
    backtest as bt,
    boost,
    features as ft,
    folds,
    labels as lb,
    model,
    orders,
    resample,
    reshape,
    rolling,
    running,
    sampler,
    scaler,
    search,
    signals as sg,
)
from barloom.operators.upsert import keep_latest
from barloom.plans import market, training
from barloom.session import shared_dir
from barloom.sinks.writers import append_job_log, write_features, write_metrics, written
from barloom.sources import payloads, readers
from barloom.streaming import live, streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed parameters of the registered queries.
INTERVAL = "15 minutes"
LEVEL = 1000.0
LINE_LEVEL = 100000.0
ENTRY_LENGTH, ENTRY_POINT = 10, 0.5
ACCOUNT = S.BacktestParams()
SEARCH = S.OptimizeParams()
TRIALS = [
    {"trial": 0, "entry_length": 5, "entry_point": 0.1},
    {"trial": 1, "entry_length": 10, "entry_point": 0.5},
    {"trial": 2, "entry_length": 15, "entry_point": 1.5},
    {"trial": 3, "entry_length": 25, "entry_point": 0.25},
]
NOW = "2024-01-31 00:00:00"
#: All event types of the given table.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


#: Columns in units of price; rounded to fewer digits, as rounding errors grow with the level.
PRICE_SCALED = tuple(n for g in ("atr", "bb_width", "macd") for n in S.FEATURE_GROUPS[g])
#: Groups of one subtraction or division, equal to the last bit in any engine.
UNROUNDED = ("mom", "roc")
EXACT = (*S.OHLCV, *[n for g in UNROUNDED for n in S.FEATURE_GROUPS[g]])
#: Log changes: small numbers where the price level is high, so they keep more digits.
LOGS = tuple(n for g in ("log_diff", "sma", "ema", "bb", "reg") for n in S.FEATURE_GROUPS[g])
FINE = 9


def out(
    df: DataFrame,
    digits: int | None = 6,
    coarse: tuple[str, ...] = (),
    exact: tuple[str, ...] = (),
    fine: tuple[str, ...] = (),
) -> DataFrame:
    """Comparable output: doubles rounded without negative zero, times without zone.

    ``digits=None`` keeps doubles as they are, where both engines do the same arithmetic.
    ``coarse`` names columns that keep three digits, ``fine`` those that keep nine, ``exact``
    those that are not rounded.
    """
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        kind = field.dataType.simpleString()
        if kind == "double" and digits is not None and field.name not in exact:
            kept = 3 if field.name in coarse else FINE if field.name in fine else digits
            tiny = F.abs(value) < 0.5 * 10.0**-kept
            value = F.when(tiny, F.lit(0.0)).otherwise(F.round(value, kept))
        elif kind == "timestamp":
            value = value.cast("timestamp_ntz")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def event_table(spark: SparkSession, sf_dir: str, level: float = 0.0) -> DataFrame:
    return market.stored(market.event_bars(spark, sf_dir, INTERVAL, level))


# -- bars and positions ---------------------------------------------------------------------------


@query
def resample_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(market.event_bars(spark, sf_dir, "15 minutes"), None)


@query
def resample_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(market.event_bars(spark, sf_dir, "5 minutes"), None)


@query
def resample_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(market.event_bars(spark, sf_dir, "1 hour"), None)


@query
def resample_lines_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(market.line_bars(spark, sf_dir), None)


#: Intervals that grow out of each other.
CASCADE = ("1 minute", "5 minutes", "15 minutes")


@query
def resample_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(market.event_bars(spark, sf_dir, "1 minute"), None)


@query
def resample_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of three intervals from one scan of the ticks."""
    ticks = market.event_ticks(market.table(spark, sf_dir, "events"))
    tables = resample.resample_cascade(ticks, CASCADE, market.tick_order())
    return out(
        functools.reduce(
            DataFrame.unionByName, [t.withColumn("interval", F.lit(name)) for name, t in tables.items()]
        )
    )


@query
def row_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = market.with_position(written(market.line_bars(spark, sf_dir), "bars"))
    return out(bars.select(S.SYMBOL, S.TS, F.col("i").cast("bigint"), F.col("n").cast("bigint")))


# -- running operations ---------------------------------------------------------------------------


@query
def running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = market.with_position(written(market.line_bars(spark, sf_dir), "bars"))
    return out(
        running.cumulative_sum(rows, "volume", "total").select(S.SYMBOL, S.TS, "volume", "total")
    )


def _signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with +1 for a rise of more than 1 %, -1 for such a fall, NULL else."""
    rows = market.with_position(written(market.event_bars(spark, sf_dir, INTERVAL, 100.0), "bars"))
    move = F.col("close") / F.col("open")
    return rows.withColumn("move", F.when(move > 1.01, 1).when(move < 0.99, -1))


@query
def fill_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = running.forward_fill(_signed(spark, sf_dir), "move", "held", "0")
    return out(rows.select(S.SYMBOL, S.TS, "move", "held"))


@query
def sum_between_flips(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = running.forward_fill(_signed(spark, sf_dir), "move", "held", "0")
    rows = running.sign_groups(held, "held", "volume", "stretch", "stretch_volume")
    return out(rows.select(S.SYMBOL, S.TS, "held", "stretch", "stretch_volume"))


@query
def rolling_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = market.with_position(written(market.event_bars(spark, sf_dir, INTERVAL), "bars"))

    def spread(windows):  # noqa: ANN001, ANN202
        return windows.max(axis=1) - windows.min(axis=1)

    return out(
        rolling.rolling_apply(rows, "close", 9, spread, "spread").select(S.SYMBOL, S.TS, "spread")
    )


# -- features -------------------------------------------------------------------------------------


def _feature_query(group: str, lines: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = market.stored_lines(spark, sf_dir) if lines else event_table(spark, sf_dir)
        names = S.FEATURE_GROUPS[group]
        made = ft.features(rows, [group]).select(S.SYMBOL, S.TS, *[F.col(f"`{n}`") for n in names])
        return out(made, None if group in UNROUNDED else 6)

    return run


for _group in S.FEATURE_GROUPS:
    QUERIES[f"feat_{_group}"] = _feature_query(_group, lines=False)
for _group in ("sma", "mom", "roc", "bb_width", "log_diff", "reg"):
    QUERIES[f"feat_lines_{_group}"] = _feature_query(_group, lines=True)


@query
def feat_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sixty features, complete rows only."""
    return out(
        ft.features(event_table(spark, sf_dir, LEVEL)), coarse=PRICE_SCALED, exact=EXACT, fine=LOGS
    )


@query
def feat_lines_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sixty features of every supplier's series; the level keeps every band positive."""
    rows = market.stored_lines(spark, sf_dir, LINE_LEVEL)
    return out(ft.features(rows), coarse=PRICE_SCALED, exact=EXACT, fine=LOGS)


@query
def feat_target_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of another target column carry its name."""
    rows = ft.features(event_table(spark, sf_dir), ["mom", "roc"], target="volume")
    return out(rows.drop(*S.OHLCV))


# -- signals, labels, backtest --------------------------------------------------------------------


def _signal_blocks(spark: SparkSession, sf_dir: str, level: float = 0.0):  # noqa: ANN202
    return sg.signal_blocks(
        event_table(spark, sf_dir, level), entry_length=ENTRY_LENGTH, entry_point=ENTRY_POINT
    )


@query
def signal_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(_signal_blocks(spark, sf_dir).own_rows(S.SYMBOL, S.TS, *S.OHLCV, "sell", "buy"))


@query
def signal_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = sg.Blocks.of(event_table(spark, sf_dir), before=25)
    rows = sg.trial_signals(blocks, TRIALS).own_rows(S.SYMBOL, "trial", S.TS, "sell", "buy")
    return out(rows)


def _label_query(binary: bool, sell_label: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = lb.labels(_signal_blocks(spark, sf_dir), binary, sell_label)
        return out(
            rows.select(
                S.SYMBOL, S.TS, "limit", "buy", "sell", "long", "short",
                "exec_price_buy", "exec_price_sell", "y_buy", "y_sell",
            )
        )

    return run


QUERIES["label_three_class"] = _label_query(False, "mirror")
QUERIES["label_binary"] = _label_query(True, "mirror")
QUERIES["label_as_written"] = _label_query(True, "as_written")


def _backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bt.backtest(_signal_blocks(spark, sf_dir), ACCOUNT, SEARCH.pyramiding)


@query
def backtest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(
        _backtest(spark, sf_dir).select(
            S.SYMBOL, S.TS, "long", "short", "order", "exec_price", "return", "pos",
            "commission", "profit", "pnl",
        )
    )


@query
def backtest_pnl_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(bt.pnl_curve(_backtest(spark, sf_dir)))


def _metric_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        blocks = _signal_blocks(spark, sf_dir)
        scores = bt.metric(blocks, name, ACCOUNT, SEARCH.pyramiding)
        return out(scores.withColumnRenamed("metric", name))

    return run


for _name in S.METRICS:
    QUERIES[f"backtest_{_name}"] = _metric_query(_name)


@query
def backtest_lines_pnl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backtest over many symbols: one per supplier."""
    blocks = sg.signal_blocks(
        market.stored_lines(spark, sf_dir),
        entry_length=ENTRY_LENGTH,
        entry_point=ENTRY_POINT,
    )
    rows = bt.trade(blocks, ACCOUNT, SEARCH.pyramiding).own_rows(S.SYMBOL, "profit")
    return out(bt.profit_metrics(rows, [S.SYMBOL]))


@query
def pnl_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(reshape.pnl_series(_backtest(spark, sf_dir), ENTRY_LENGTH))


# -- one long series over many blocks -------------------------------------------------------------

LONG_INTERVAL = "5 minutes"
SMALL_BLOCK = 256


def long_table(spark: SparkSession, sf_dir: str, level: float = 0.0) -> DataFrame:
    """All events as one series: several thousand bars at sf0.01, so blocks have neighbours."""
    return market.stored(market.event_bars(spark, sf_dir, LONG_INTERVAL, level, whole=True))


def _long_feature_query(group: str, block_rows: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        names = S.FEATURE_GROUPS[group]
        made = ft.features(long_table(spark, sf_dir, LEVEL), [group], block_rows=block_rows)
        shown = made.select(S.SYMBOL, S.TS, *[F.col(f"`{n}`") for n in names])
        return out(shown, coarse=PRICE_SCALED, fine=LOGS)

    return run


def _long_backtest(block_rows: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        blocks = sg.signal_blocks(
            long_table(spark, sf_dir), block_rows=block_rows,
            entry_length=ENTRY_LENGTH, entry_point=ENTRY_POINT,
        )
        result = bt.backtest(blocks, ACCOUNT, SEARCH.pyramiding)
        shown = result.select(S.SYMBOL, S.TS, "order", "pos", "profit", "pnl")
        return out(shown, fine=("pos", "profit", "pnl"))

    return run


def _long_running(block_rows: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = running.cumulative_sum(long_table(spark, sf_dir), "volume", "total", rows=block_rows)
        return out(rows.select(S.SYMBOL, S.TS, "total"))

    return run


def _long_grid(block_rows: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        scores = search.fold_scores(
            long_table(spark, sf_dir), TRIALS, ACCOUNT, SEARCH, strict=False, block_rows=block_rows
        )
        return out(scores)

    return run


for _rows, _suffix in ((2048, ""), (SMALL_BLOCK, "_small_blocks")):
    for _group in ("ema", "rsi", "atr", "macd"):
        QUERIES[f"feat_long_{_group}{_suffix}"] = _long_feature_query(_group, _rows)
    QUERIES[f"backtest_long{_suffix}"] = _long_backtest(_rows)
    QUERIES[f"running_long{_suffix}"] = _long_running(_rows)
    QUERIES[f"grid_long{_suffix}"] = _long_grid(_rows)


@query
def feat_long_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = long_table(spark, sf_dir, LEVEL)
    return out(ft.features(rows), coarse=PRICE_SCALED, exact=EXACT, fine=LOGS)


# -- folds, scaling -------------------------------------------------------------------------------


@query
def fold_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(folds.fold_bounds(event_table(spark, sf_dir), SEARCH, strict=False))


@query
def fold_bounds_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = S.OptimizeParams(n_splits=3, max_train_size=60, test_size=20, gap=2)
    return out(folds.fold_bounds(event_table(spark, sf_dir), params, holdout=False, strict=False))


@query
def holdout_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(folds.holdout_bounds(event_table(spark, sf_dir), SEARCH))


@query
def fold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = folds.fold_rows(event_table(spark, sf_dir), SEARCH, strict=False)
    counted = rows.groupBy(S.SYMBOL, "fold", "role").agg(
        F.count(F.lit(1)).alias("rows"), F.min(S.TS).alias("first_ts"), F.max(S.TS).alias("last_ts"),
        F.sum("close").alias("sum_close"),
    )
    return out(counted)


def _bound_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_table(spark, sf_dir)
    bounds = folds.fold_bounds(rows, SEARCH, strict=False)
    return folds.bound_metrics(bounds, folds.holdout_bounds(rows, SEARCH))


@query
def bound_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(_bound_history(spark, sf_dir))


@query
def fold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(reshape.fold_table(_bound_history(spark, sf_dir), [S.SYMBOL]))


@query
def eval_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _bound_history(spark, sf_dir).withColumn("timestamp", F.lit(0))
    return out(reshape.eval_bounds(history, [S.SYMBOL]))


@query
def left_out_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers whose series are too short for five test ranges of 105 rows."""
    params = S.OptimizeParams(test_size=105)
    rows = market.stored_lines(spark, sf_dir)
    return out(folds.left_out(rows, params).select(S.SYMBOL, F.col("n").cast("bigint")))


_SCALED = ["open", "high", "low", "close", "volume"]


@query
def scale_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_table(spark, sf_dir)
    return out(scaler.fit_scaler(rows.where(folds.in_first_train(SEARCH)), _SCALED))


@query
def scale_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scaled = scaler.standardise(event_table(spark, sf_dir), SEARCH, _SCALED)
    return out(scaled.select(S.SYMBOL, S.TS, *_SCALED))


@query
def scale_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaler state from stored day moments and those of new days; one day comes twice."""
    bars = event_table(spark, sf_dir)
    day, half = F.dayofmonth(S.TS), 15
    stored = written(scaler.day_moments(bars.where(day <= half), S.OHLCV), "moments")
    new = scaler.day_moments(bars.where(day >= half), S.OHLCV)
    return out(scaler.scaler_of(written(scaler.with_new_days(stored, new), "moments")))


# -- search ---------------------------------------------------------------------------------------


@query
def grid_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(search.fold_scores(event_table(spark, sf_dir), TRIALS, ACCOUNT, SEARCH, strict=False))


@query
def grid_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(search.search_signal(event_table(spark, sf_dir), TRIALS, ACCOUNT, SEARCH, strict=False))


@query
def grid_lines_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid over many symbols: one search per supplier."""
    rows = market.stored_lines(spark, sf_dir)
    return out(search.search_signal(rows, TRIALS, ACCOUNT, SEARCH, strict=False))


@query
def tuned_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of every symbol from the parameters its own search found best."""
    rows = event_table(spark, sf_dir)
    best = search.search_signal(rows, TRIALS, ACCOUNT, SEARCH, strict=False)
    return out(sg.tuned_signals(rows, best).own_rows(S.SYMBOL, S.TS, "sell", "buy"))


@query
def best_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = search.search_signal(event_table(spark, sf_dir), TRIALS, ACCOUNT, SEARCH, strict=False)
    rows = best.select(
        S.SYMBOL, F.col("entry_length").cast("double"), "entry_point"
    )
    return out(reshape.unpivot(rows, [S.SYMBOL], ["entry_length", "entry_point"], "best_"))


@query
def trial_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean metric and parameters of every trial, as metric rows with the trial as step."""
    scores = search.fold_scores(event_table(spark, sf_dir), TRIALS, ACCOUNT, SEARCH, strict=False)
    wide = search.with_parameters(search.trial_scores(scores), TRIALS)
    wide = wide.select(
        S.SYMBOL, F.col("trial").alias("step"), F.col("metric").alias("pnl"),
        F.col("entry_length").cast("double"), "entry_point",
    )
    return out(
        reshape.unpivot(wide, [S.SYMBOL, "step"], ["pnl", "entry_length", "entry_point"])
    )


@query
def best_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters read back from their tracked form, and typed."""
    history = best_export(spark, sf_dir).withColumn("timestamp", F.lit(0))
    return out(
        reshape.best_parameters(history, {"entry_length": "int", "entry_point": "double"}, [S.SYMBOL])
    )


#: Searches by the other metrics, and over train ranges of bounded length.
GRID_SEARCHES = {
    "grid_sr_best": replace(SEARCH, optimize_target="sr"),
    "grid_max_dd_best": replace(SEARCH, optimize_target="max_dd"),
    "grid_capped_best": replace(SEARCH, max_train_size=300),
}


def _grid_search(params: S.OptimizeParams) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = market.stored(market.event_bars(spark, sf_dir, INTERVAL))
        return out(search.search_signal(bars, TRIALS, ACCOUNT, params))

    return run


for _name, _params in GRID_SEARCHES.items():
    QUERIES[_name] = _grid_search(_params)


@query
def random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published number of random trials; trial values come from a digest and repeat anywhere."""
    trials = search.signal_trials(SEARCH.n_trials, ACCOUNT.seed)
    return out(search.search_signal(event_table(spark, sf_dir), trials, ACCOUNT, SEARCH, strict=False))


#: Random trials that the registered proposals go on from, and proposals per symbol.
TOLD, PROPOSED = 30, 4


@query
def next_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals per symbol from the metrics of random trials."""
    trials = search.signal_trials(TOLD, ACCOUNT.seed)
    scores = search.fold_scores(event_table(spark, sf_dir), trials, ACCOUNT, SEARCH, strict=False)
    history = written(search.with_parameters(search.trial_scores(scores), trials), "history")
    return out(sampler.next_trials(history, search.SIGNAL_SPACE, TOLD, PROPOSED, SEARCH.direction, ACCOUNT.seed))


# -- stored series, upserts, tracking, orders -----------------------------------------------------


def _measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars in long form, one row per field, 250 ms after the bar's start."""
    bars = market.event_bars(spark, sf_dir, INTERVAL)
    late = bars.withColumn(S.TS, F.col(S.TS) + F.expr("INTERVAL 250 MILLISECONDS"))
    long = late.unpivot([S.SYMBOL, S.TS], list(S.OHLCV), "field", "value")
    return long.withColumn("measurement", F.concat(F.col(S.SYMBOL), F.lit("_15m")))


@query
def scan_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit(NOW).cast("timestamp")
    return out(readers.scan_bars(_measurements(spark, sf_dir), "click_15m", "1w", now), None)


@query
def pivot_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(reshape.pivot_fields(_measurements(spark, sf_dir)), None)


@query
def align_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full outer alignment of the hourly series of all event types, which miss different hours."""
    events = market.table(spark, sf_dir, "events")

    def hourly(kind: str, name: str) -> DataFrame:
        ticks = events.where(F.col("event_type") == kind)
        slot = F.date_trunc("hour", F.col("ts").cast("timestamp")).alias(S.TS)
        user = F.concat(F.lit("u"), (F.col("user_id") % 10).cast("string")).alias(S.SYMBOL)
        return ticks.groupBy(user, slot).agg(F.max("value").alias(name))

    return out(reshape.align_series([hourly(kind, f"top_{kind}") for kind in EVENT_TYPES]))


@query
def keep_latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping pulls: the newest order of every customer and status."""
    pulled = market.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias(S.SYMBOL),
        F.col("o_orderstatus").alias("side"),
        F.col("o_orderdate").cast("timestamp").alias("ingest_ts"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("price"),
    )
    return out(keep_latest(pulled, (S.SYMBOL, "side"), tie="order_id"))


@query
def latest_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest artifact name among names that carry a time stamp."""
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyyMMddHHmmss")
    names = market.table(spark, sf_dir, "events").select(
        F.concat(F.lit("data/"), "event_type", F.lit("_"), stamp, F.lit(".csv")).alias("path")
    )
    return reshape.latest_artifact(names, "click_")


@query
def previous_run_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand in for runs and order lines for their tags."""
    runs = market.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_uuid"),
        F.when(F.col("o_orderstatus") == "O", "preprocess")
        .when(F.col("o_orderstatus") == "P", "build")
        .otherwise("main")
        .alias("name"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("start_time"),
    )
    tags = market.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_uuid"),
        F.lit("source.git.commit").alias("key"),
        F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("value"),
    )
    return reshape.previous_run_tag(runs, tags)


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a position of its type; even-numbered users buy."""
    return market.table(spark, sf_dir, "events").select(
        F.col("event_type").alias(S.SYMBOL),
        F.col("ts").cast("timestamp").alias(S.TS),
        F.when(F.col("user_id") % 2 == 0, "Buy").otherwise("Sell").alias("side"),
        ((F.col("event_id") % 5) / F.lit(1000.0)).alias("size"),
    )


@query
def order_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _signal_blocks(spark, sf_dir).own_rows(S.SYMBOL, S.TS, "buy", "sell", "i", "n")
    newest = sg.newest_row(rows)
    prices = newest.select(
        S.SYMBOL, F.col("buy").alias("buy_limit_price"), F.col("sell").alias("sell_limit_price")
    )
    # One type is taken to hold no position, which is a case of its own in the plan.
    held = _positions(spark, sf_dir).where(F.col(S.SYMBOL) != "view")
    return out(orders.plan_orders(prices, held))


@query
def gated_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in classifier (rising volume) gates the prices before the backtest."""
    rows = _signal_blocks(spark, sf_dir).own_rows()
    gated = sg.gate_prices(
        rows.withColumns(
            {
                "pred_buy": (F.col("close") > F.col("open")).cast("int"),
                "pred_sell": (F.col("close") < F.col("open")).cast("int"),
            }
        )
    )
    result = bt.backtest(gated, ACCOUNT, SEARCH.pyramiding)
    return out(result.select(S.SYMBOL, S.TS, "buy", "sell", "pos", "profit", "pnl"))


@query
def live_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limit prices of the newest bar in the arithmetic form of the gate."""
    rows = _signal_blocks(spark, sf_dir).own_rows(
        S.SYMBOL, S.TS, "open", "close", "buy", "sell", "i", "n"
    )
    newest = sg.newest_row(rows).withColumns(
        {
            "pred_buy": (F.col("close") > F.col("open")).cast("int"),
            "pred_sell": (F.col("close") < F.col("open")).cast("int"),
        }
    )
    return out(sg.live_prices(newest).select(S.SYMBOL, S.TS, "buy_limit_price", "sell_limit_price"))


# -- payloads -------------------------------------------------------------------------------------


def _millis() -> Column:
    return F.unix_millis(F.col(S.TS).cast("timestamp")).cast("string")


@query
def payload_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars wrapped as exchange payloads of one hour each, and parsed back."""
    bars = market.event_bars(spark, sf_dir, INTERVAL)
    fields = [_millis(), *[F.col(c).cast("string") for c in S.OHLCV], F.lit("0")]
    wrapped = (
        bars.withColumn("row", F.array(*fields))
        .groupBy(S.SYMBOL, F.date_trunc("hour", S.TS).alias("hour"))
        .agg(F.to_json(F.struct(F.struct(F.collect_list("row").alias("list")).alias("result"))).alias("value"))
    )
    return out(payloads.parse_bars(wrapped), None)


def _event_payloads(spark: SparkSession, sf_dir: str, amount: str) -> DataFrame:
    events = market.event_ticks(market.table(spark, sf_dir, "events"))
    entry = F.struct(F.col("price").cast("string").alias(amount), _millis().alias("timestamp"))
    listed = F.struct(F.array(entry).alias("list")).alias("result")
    return events.select(S.SYMBOL, F.to_json(F.struct(listed)).alias("value"))


@query
def payload_open_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(payloads.parse_open_interest(_event_payloads(spark, sf_dir, "openInterest")))


@query
def payload_long_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(payloads.parse_long_ratio(_event_payloads(spark, sf_dir, "buyRatio")))


@query
def payload_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a wallet payload; errors are those of type ``error``."""
    events = market.event_ticks(market.table(spark, sf_dir, "events"))
    amount = F.when(F.col(S.SYMBOL) == "error", F.lit(payloads.BALANCE_ERROR)).otherwise(F.col("price"))
    listed = F.struct(F.array(F.struct(amount.cast("string").alias("totalWalletBalance"))).alias("list"))
    wrapped = events.select(
        F.to_json(F.struct(_millis().cast("bigint").alias("time"), listed.alias("result"))).alias("value")
    )
    return out(payloads.parse_balance(wrapped))


def _info_payloads(spark: SparkSession, sf_dir: str, *amounts: Column) -> DataFrame:
    info = F.struct(_millis().alias("createdTime"), "side", *amounts, S.SYMBOL).alias("info")
    return _positions(spark, sf_dir).select(F.to_json(F.struct(info)).alias("value"))


@query
def payload_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("size").cast("string").alias("size")
    return out(payloads.parse_positions(_info_payloads(spark, sf_dir, size, F.lit("1.5").alias("avgPrice"))))


@query
def payload_open_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("size").cast("string").alias("price")
    return out(payloads.parse_open_orders(_info_payloads(spark, sf_dir, price), "model-1"))


#: Which event numbers, modulo the first, have payloads that are broken in which way.
BROKEN, CUT, EMPTY, OTHER, AMOUNT, TIME = 11, 0, 1, 2, 3, 4


def _broken(value: Column) -> Column:
    """Payloads of some events cut off, left empty, or replaced by another document."""
    way = F.col("event_id") % BROKEN
    return (
        F.when(way == CUT, value.substr(F.lit(1), F.length(value) - 3))
        .when(way == EMPTY, " ")
        .when(way == OTHER, '{"other": 1}')
        .otherwise(value)
    )


def _kind_payload(kind: str) -> Column:
    """An event as a payload of one kind, with an unreadable amount or time in some."""
    way = F.col("event_id") % BROKEN
    amount = F.when(way == AMOUNT, "n/a").otherwise(F.col("value").cast("string"))
    time = F.when(way == TIME, "soon").otherwise(_millis())
    if kind == "bars":
        price = F.col("value").cast("string")
        entry = F.array(time, price, price, price, amount, F.lit("1"), F.lit("0"))
    elif kind in ("open_interest", "long_ratio"):
        name = {"open_interest": "openInterest", "long_ratio": "buyRatio"}[kind]
        entry = F.struct(amount.alias(name), time.alias("timestamp"))
    elif kind == "balance":
        entry = F.struct(amount.alias("totalWalletBalance"))
        listed = F.struct(F.array(entry).alias("list")).alias("result")
        value = F.to_json(F.struct(_millis().cast("bigint").alias("time"), listed))
        return F.when(way == TIME, F.regexp_replace(value, r'"time":\d+', '"time":"soon"')).otherwise(value)
    else:
        name = {"positions": "size", "open_orders": "price"}[kind]
        named = [time.alias("createdTime"), F.lit("Buy").alias("side"), amount.alias(name), F.lit("X").alias("symbol")]
        return F.to_json(F.struct(F.struct(*named).alias("info")))
    return F.to_json(F.struct(F.struct(F.array(entry).alias("list")).alias("result")))


@query
def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a payload of every kind, some of them broken: why an entry was rejected, if it was."""
    events = market.table(spark, sf_dir, "events")
    parts = []
    for kind in payloads.PAYLOADS:
        wrapped = events.select("event_id", _broken(_kind_payload(kind)).alias("value"))
        rows = payloads.judged(wrapped, kind, keep=("event_id",))
        parts.append(rows.select(F.lit(kind).alias("kind"), "event_id", "reason"))
    return functools.reduce(DataFrame.unionByName, parts)


# -- classifiers ----------------------------------------------------------------------------------

#: Signal parameters of the classifier queries.
MODEL_LENGTH, MODEL_POINT = 5, 0.05
#: Upper bounds of the classifiers' bins, in deviations, the same for all inputs.
MODEL_EDGES = [round(-3.0137 + 0.2 * k, 4) for k in range(boost.BINS - 1)]
#: Settings of the fitted pair; SQL grows the same trees split by split.
MODEL_ROUNDS = 3
MODEL_PARAMS = {
    f"{name}_{side}": value
    for side, values in (("buy", (5, 0.5, 0.8, 20, 0.1, 1.0, 8)), ("sell", (4, 0.9, 0.5, 10, 2.0, 0.5, 8)))
    for name, value in zip(search.CLASSIFIER_SPACE, values)
}
#: The searched trials: the published ranges, with few leaves.
SEARCH_ROUNDS = 2
SEARCH_TRIALS = search.classifier_trials(
    12, ACCOUNT.seed, search.CLASSIFIER_SPACE | {"num_leaves": ("int", 2, 4), "reg_alpha": ("log", 0.1, 100.0)}
)


@dataclass(frozen=True)
class Prepared:
    """Stages of a training run over all events as one series of 15-minute bars."""

    bars: DataFrame
    scaler: DataFrame
    best: DataFrame
    signalled: DataFrame
    labelled: DataFrame

    def fitted(self, params: dict = MODEL_PARAMS, rounds: int = MODEL_ROUNDS) -> model.Classifiers:
        return training.fit_last_fold(
            self.labelled, params, ACCOUNT, SEARCH, rounds, [MODEL_EDGES] * len(S.FEATURES)
        )

    def scores(self) -> DataFrame:
        """Metrics of the searched trials."""
        return model.classifier_scores(
            self.labelled, scaler.feature_columns(self.labelled), SEARCH_TRIALS, ACCOUNT, SEARCH,
            SEARCH_ROUNDS, [MODEL_EDGES] * len(S.FEATURES),
        )


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    bars = market.stored(market.event_bars(spark, sf_dir, INTERVAL, LEVEL, whole=True))
    table = market.stored(ft.features(bars))
    state, scaled = scaler.standardise(table, SEARCH)
    state, scaled = written(state, "scaler"), written(scaled, "scaled")
    best = spark.createDataFrame(
        [("all", MODEL_LENGTH, MODEL_POINT)], "symbol string, entry_length int, entry_point double"
    )
    return Prepared(bars, state, best, *training.tuned_rows(scaled, best))


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lb.labels(_signal_blocks(spark, sf_dir)).select(S.SYMBOL, S.TS, "y_buy", "y_sell")
    return out(model.balance_weights(rows).select(S.SYMBOL, S.TS, "y_buy", "y_sell", "weight_buy", "weight_sell"))


@query
def classifier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the final classifiers are fitted on, with their labels."""
    rows = prepared(spark, sf_dir).labelled.where(
        folds.in_fold(SEARCH, SEARCH.n_splits - 1, "train")
    )
    return out(rows.select(S.SYMBOL, S.TS, "buy", "sell", "y_buy", "y_sell"))


def _sides(raw: str = "raw") -> list[Column]:
    return [F.col(f"{raw}_{side}")[0].alias(f"score_{side}") for side in model.SIDES]


@query
def boost_first_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits of both models' first trees, with their gains."""
    forest = prepared(spark, sf_dir).fitted(rounds=1).forest
    table = boost.tree_table(spark, forest).where("feature >= 0")
    names = F.array(*[F.lit(c) for c in S.FEATURES])
    side = F.when(F.col("unit") == 0, "buy").otherwise("sell")
    return out(table.select(side.alias("side"), F.get(names, F.col("feature")).alias("feature"), "bin", "gain"))


@query
def boost_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw scores of all labelled rows after one round and after three."""
    stages = prepared(spark, sf_dir)
    parts = []
    for rounds in (1, MODEL_ROUNDS):
        scored = stages.fitted(rounds=rounds).scored(stages.labelled)
        parts.append(scored.select(S.SYMBOL, S.TS, F.lit(rounds).alias("rounds"), *_sides()))
    return out(parts[0].unionByName(parts[1]))


@query
def classifier_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and classes of the hold-out rows, last bar included."""
    stages = prepared(spark, sf_dir)
    fitted = stages.fitted()
    held = stages.signalled.where(folds.in_holdout(SEARCH))
    scored = fitted.scored(held).select(S.SYMBOL, S.TS, *_sides())
    classes = fitted.predict(held).select(S.SYMBOL, S.TS, "pred_buy", "pred_sell")
    return out(scored.join(classes, [S.SYMBOL, S.TS]))


@query
def classifier_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits on every model input, and what they gained."""
    stages = prepared(spark, sf_dir)
    fitted = stages.fitted()
    sides = [
        model.importances(fitted, side, stages.labelled).withColumn("side", F.lit(side))
        for side in model.SIDES
    ]
    return out(sides[0].unionByName(sides[1]).select("side", "feature", "importance", "gain"))


@query
def classifier_holdout_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backtest of the hold-out slice without the model."""
    stages = prepared(spark, sf_dir)
    curves = model.evaluate_holdout(
        stages.signalled.where(folds.in_holdout(SEARCH)), stages.fitted(), ACCOUNT
    )
    rows = curves.where("variant = 'base'")
    return out(rows.select(S.SYMBOL, S.TS, "pos", "profit", "pnl"))


@query
def classifier_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backtest of the hold-out slice with the model's gate on the prices."""
    stages = prepared(spark, sf_dir)
    curves = model.evaluate_holdout(
        stages.signalled.where(folds.in_holdout(SEARCH)), stages.fitted(), ACCOUNT
    )
    rows = curves.where("variant = 'gated'")
    return out(rows.select(S.SYMBOL, S.TS, "buy", "sell", "pos", "profit", "pnl"))


@query
def classifier_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean test metric of every trial over all folds; all models grow together."""
    return out(prepared(spark, sf_dir).scores().select(S.SYMBOL, "trial", "metric"))


@query
def best_classifier_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search's winner, tracked as ``best_<name>``, written, read back and typed."""
    pooled = written(model.pooled_scores(prepared(spark, sf_dir).scores()), "pooled")
    chosen = model.chosen_trial(pooled, SEARCH_TRIALS, SEARCH.direction_clf)
    path = shared_dir(spark, "metrics")
    write_metrics(model.tracked_best(spark, chosen), path, "run", "best-classifier")
    history = spark.read.parquet(path)
    return out(reshape.best_parameters(history, model.PARAMETER_TYPES, ["run_id"]))


@query
def latest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gated limit prices of the newest bar from a saved and loaded model."""
    stages = prepared(spark, sf_dir)
    path = shared_dir(spark, "model")
    model.CompositeModel(stages.best, stages.scaler, stages.fitted()).save(path)
    return out(model.CompositeModel.load(spark, path).score(stages.bars))


# -- written and read back ------------------------------------------------------------------------


@query
def scan_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relation of the session's catalog, read by name."""
    market.table(spark, sf_dir, "customer").createOrReplaceTempView("relation_customer")
    return readers.read_relation(spark, "relation_customer").where("c_nationkey = 3").select("c_custkey", "c_name")


@query
def feature_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written as CSV and read by the CSV source."""
    names = [*S.OHLCV, *S.FEATURE_GROUPS["mom"]]
    rows = ft.features(event_table(spark, sf_dir), ["mom"])
    path = write_features(rows, shared_dir(spark, "features"), "features", "20240101000000", csv=True)
    return out(readers.read_bar_csv(spark, path, tuple(names), by_folder=True))


@query
def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows of every event type; an entry that is written again replaces itself."""
    path = shared_dir(spark, "log")
    types = [r.event_type for r in market.table(spark, sf_dir, "events").select("event_type").distinct().collect()]
    for kind in (*types, *types):
        append_job_log(spark, path, "recorder", f"pulled {kind}", entry=kind)
    return spark.read.parquet(path).select("name", "message", "entry")


# -- streams --------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = market.table(spark, sf_dir, "events").schema
    return market.event_ticks(
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )


@query
def stream_resample_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended bars: those whose end the watermark has passed.

    Append mode leaves out what the watermark has not closed; the SQL restates that. All bars are
    in :func:`stream_resample_complete`.
    """
    bars = streams.stream_resample(
        _event_stream(spark, sf_dir), INTERVAL, "10 minutes", market.tick_order()
    )
    return out(streams.run_available(bars, "stream-bars"), None)


@query
def stream_resample_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bars, the whole result in every trigger."""
    bars = market.resample(_event_stream(spark, sf_dir), "1 hour", market.tick_order())
    return out(streams.run_available(bars, "stream-bars", mode="complete"), None)


@query
def stream_cascade_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute bars through chained windows of one and five minutes."""
    bars = streams.stream_cascade(
        _event_stream(spark, sf_dir), CASCADE, "10 minutes", market.tick_order()
    )
    return out(streams.run_available(bars, "cascade-bars"))


@query
def stream_order_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per bar from a stream of limit prices and one of positions, for bars that are closed."""
    rows = _signal_blocks(spark, sf_dir).own_rows(S.SYMBOL, S.TS, "buy", "sell")
    path = shared_dir(spark, "price-rows")
    rows.select(
        S.SYMBOL, S.TS, F.col("buy").alias("buy_limit_price"), F.col("sell").alias("sell_limit_price")
    ).write.parquet(path)
    prices = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    schema = market.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    held = events.where("event_type <> 'view'").select(
        F.col("event_type").alias(S.SYMBOL), S.TS,
        F.when(F.col("user_id") % 2 == 0, "Buy").otherwise("Sell").alias("side"),
        ((F.col("event_id") % 5) / 1000.0).alias("size"),
    )
    return out(streams.run_available(streams.stream_order_plan(prices, held, INTERVAL), "order-plans"))


@query
def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress rows of a stream over three pulled files: batch numbers and rows read."""
    events = market.table(spark, sf_dir, "events")
    pulled, path = shared_dir(spark, "pulled"), shared_dir(spark, "progress")
    for k in range(3):
        events.where(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(pulled)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(pulled)
    log = streams.ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        query = (
            stream.writeStream.queryName("pulls").format("noop").trigger(availableNow=True)
            .option("checkpointLocation", shared_dir(spark, "progress-checkpoint")).start()
        )
        query.awaitTermination()
        log.wait(query)
    finally:
        spark.streams.removeListener(log)
    rows = spark.read.parquet(path).where("rows > 0")
    return rows.select("name", "batch", "rows", (F.col("millis") >= 0).alias("timed"))


@query
def stream_live_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features of bars that arrive in five batches, each overlapping the one before."""
    bars = event_table(spark, sf_dir, LEVEL)
    pulled = shared_dir(spark, "pulled-bars")
    for k in range(5):
        part = bars.where((F.col("i") * 5 >= k * F.col("n") - 50) & (F.col("i") * 5 < (k + 1) * F.col("n")))
        part.select(*S.BASE_COLUMNS).coalesce(1).write.mode("append").parquet(pulled)
    schema = spark.read.parquet(pulled).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(pulled)
    rows = streams.run_available(live.live_features(stream), "live-features").drop(*live.RECENT)
    return out(rows, coarse=PRICE_SCALED, exact=EXACT, fine=LOGS)


@query
def stream_payload_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bar payloads in text files, some of them broken, streamed into a table and its dead letters."""
    events = market.table(spark, sf_dir, "events")
    entry = F.array(
        (F.col("event_id") * 1000).cast("string"),
        *[F.when(F.col("event_id") % BROKEN == AMOUNT, "n/a").otherwise(F.col("value").cast("string"))] * 4,
        F.lit("1"), F.lit("0"),
    )
    value = F.to_json(F.struct(F.struct(F.array(entry).alias("list")).alias("result")))
    source, path, letters = (shared_dir(spark, f"payload-{x}") for x in ("files", "rows", "rejects"))
    events.select(_broken(value)).repartition(3).write.text(source)
    streams.stream_payload_table(
        spark, source, "bars", "all", path, letters, shared_dir(spark, "payload-checkpoint")
    ).awaitTermination()
    rows = spark.read.parquet(path).select(F.lit("row").alias("outcome"), "close")
    bad = spark.read.parquet(letters).select(F.col("reason").alias("outcome"), F.lit(None).cast("double").alias("close"))
    return out(
        rows.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"), F.sum("close").alias("total"))
    )


@query
def stream_upsert_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks merged keep-latest by type and minute, one micro-batch per pulled file."""
    events = market.table(spark, sf_dir, "events")
    pulled = shared_dir(spark, "pulled")
    events.repartition(3, F.col("event_id") % 3).write.parquet(pulled)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(pulled)
    rows = market.event_ticks(stream).select(
        S.SYMBOL,
        F.date_trunc("minute", S.TS).alias(S.TS),
        F.col("seq").alias("version"),
        "price",
    )
    path = shared_dir(spark, "stream-upsert")
    streams.stream_upsert(
        rows, path, shared_dir(spark, "stream-upsert-checkpoint"), version="version"
    ).awaitTermination()
    return out(spark.read.parquet(path).select(S.SYMBOL, S.TS, "version", "price"))
