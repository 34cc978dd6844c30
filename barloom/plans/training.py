"""The training run from bars to evaluated models, and the ingestion run, as plain functions.

Stages hand over written tables, so a lost executor or a restarted driver repeats one stage only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.operators import features as ft
from barloom.operators import folds, model, reshape, scaler, search
from barloom.operators import labels as lb
from barloom.operators import signals as sg
from barloom.operators.blocks import POSITION
from barloom.plans.market import stored
from barloom.sinks.writers import append_job_log, upsert, write_features, write_metrics, written
from barloom.sources.payloads import parse_bars
from barloom.sources.readers import newest_artifact


@dataclass(frozen=True)
class TrainingRun:
    """What a run leaves behind."""

    bars: DataFrame
    best: DataFrame
    model: model.CompositeModel
    classifier_params: dict
    curves: DataFrame
    left_out: DataFrame
    metrics_path: str
    model_path: str


def preprocess(
    spark: SparkSession,
    bars: DataFrame,
    root: str,
    run_id: str,
    params: S.OptimizeParams,
    reuse: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Features, fold bounds and leak-free scaling: positioned bars, scaler, scaled rows.

    With ``reuse`` the newest stored features are read instead of being calculated, if there are
    any.
    """
    stamp = spark.sql("SELECT date_format(current_timestamp(), 'yyyyMMddHHmmss')").first()[0]
    positioned = bars if "i" in bars.columns else stored(bars)
    features_path = newest_artifact(spark, root, "features_") if reuse else None
    if features_path is None:
        features_path = write_features(
            ft.features(positioned, keep=(POSITION,)), root, "features", stamp
        )
    table = stored(spark.read.parquet(features_path))
    bounds = folds.fold_bounds(table, params, strict=False)
    history = folds.bound_metrics(bounds, folds.holdout_bounds(table, params))
    write_metrics(history, f"{root}/metrics", run_id, "bounds")
    state, scaled = scaler.standardise(table, params)
    state, scaled = written(state, "scaler"), written(scaled, "scaled")
    write_features(scaled, root, f"preprocess_{run_id}", stamp)
    return positioned, state, scaled


def tuned_rows(
    scaled: DataFrame, best: DataFrame, binary: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Signal rows with every symbol's own parameters, and the labelled ones among them.

    Labels need the next bar, so a symbol's last signal row is in the first table only.
    """
    signalled = written(sg.tuned_signals(scaled, best).own_rows(), "signals")
    return signalled, written(lb.labels(signalled, binary), "labels")


def fit_last_fold(
    labelled: DataFrame,
    classifier_params: dict,
    account: S.BacktestParams,
    params: S.OptimizeParams,
    iterations: int,
    edges: model.Edges | None = None,
) -> model.Classifiers:
    """Both classifiers on the last fold's train range."""
    rows = labelled.where(folds.in_fold(params, params.n_splits - 1, "train"))
    columns = scaler.feature_columns(labelled)
    return model.fit_classifiers(
        rows, columns, classifier_params, account.seed, params.class_weight, iterations, edges
    )


def _track(rows: DataFrame, path: str, run_id: str, kind: str) -> None:
    write_metrics(rows.withColumn("step", F.col("step").cast("bigint")), path, run_id, kind)


def train(
    spark: SparkSession,
    bars: DataFrame,
    root: str,
    run_id: str,
    account: S.BacktestParams = S.BacktestParams(),
    params: S.OptimizeParams = S.OptimizeParams(),
    iterations: int = model.ITERATIONS,
    reuse: bool = False,
) -> TrainingRun:
    """Preprocess, search signal and classifier parameters, fit, and evaluate on the hold-out.

    Symbols too short for the folds are listed in ``left_out``, not trained on.
    """
    positioned, state, scaled = preprocess(spark, bars, root, run_id, params, reuse)
    short = written(folds.left_out(scaled, params), "left-out")
    metrics = f"{root}/metrics"

    # Signal parameters, per symbol; every trial and the best values are tracked.
    trials = search.signal_trials(params.n_trials, account.seed)
    scores = written(
        search.trial_scores(search.fold_scores(scaled, trials, account, params, strict=False)),
        "trials",
    )
    tracked = search.with_parameters(scores, trials).withColumnRenamed("metric", params.optimize_target)
    names = [params.optimize_target, "entry_length", "entry_point"]
    doubles = tracked.withColumns({n: F.col(n).cast("double") for n in names})
    _track(
        reshape.unpivot(doubles.withColumnRenamed("trial", "step"), [S.SYMBOL, "step"], names),
        metrics, run_id, "signal-trials",
    )
    best = written(
        search.with_parameters(search.best_trial(scores, params.direction), trials), "best"
    )
    exported = best.withColumns({n: F.col(n).cast("double") for n in names[1:]})
    exported = reshape.unpivot(exported, [S.SYMBOL], names[1:], "best_")
    _track(exported.withColumn("step", F.lit(0)), metrics, run_id, "best-signal")

    # Labels of the tuned signal, then the classifiers' parameters, tracked for all symbols as one.
    signalled, labelled = tuned_rows(scaled, best, account.use_binary_label)
    columns = scaler.feature_columns(labelled)
    found = search.classifier_trials(params.n_trials_clf, account.seed)
    pooled = None
    if len(found) > 1:
        pooled = written(
            model.pooled_scores(
                model.classifier_scores(labelled, columns, found, account, params, iterations)
            ),
            "classifier-trials",
        )
    rows = model.tracked_trials(spark, found, pooled, params.optimize_target_clf)
    _track(rows, metrics, run_id, "classifier-trials")
    chosen = found[0] if pooled is None else model.chosen_trial(pooled, found, params.direction_clf)
    _track(model.tracked_best(spark, chosen), metrics, run_id, "best-classifier")

    # Final fit on the last fold's train range, evaluation on the hold-out's signal rows.
    fitted = fit_last_fold(labelled, chosen, account, params, iterations)
    composite = model.CompositeModel(best, state, fitted)
    model_path = f"{root}/0/{run_id}/artifacts/model"
    composite.save(model_path)
    for side in model.SIDES:
        table = model.importances(fitted, side, labelled)
        table.write.mode("overwrite").parquet(f"{root}/0/{run_id}/artifacts/importances_{side}")
    held_out = signalled.where(folds.in_holdout(params))
    curves = written(model.evaluate_holdout(held_out, fitted, account, params.pyramiding), "curves")
    start = folds.holdout_start(params)
    for variant, key in (("base", "pnl"), ("gated", "pnl_with_2nd")):
        points = reshape.pnl_series(curves.where(F.col("variant") == variant), start, key)
        write_metrics(points, metrics, run_id, f"curve-{variant}")
    return TrainingRun(positioned, best, composite, chosen, curves, short, metrics, model_path)


def ingest(
    spark: SparkSession, payload_path: str, bars_path: str, log_path: str, symbol: str
) -> DataFrame:
    """Parse pulled bar payloads, merge them keep-latest, and log the job."""
    append_job_log(spark, log_path, "recorder", "start")
    text = spark.read.text(payload_path, wholetext=True).withColumn(S.SYMBOL, F.lit(symbol))
    bars = parse_bars(text).withColumn("ingest_ts", F.current_timestamp())
    upsert(spark, bars, bars_path)
    append_job_log(spark, log_path, "recorder", "end")
    return spark.read.parquet(bars_path)
