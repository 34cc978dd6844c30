"""Sources, sinks, scaling, models and streams."""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from helpers import by_symbol, close_to, random_bars, to_spark
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.operators import model, orders, reshape, scaler, search
from barloom.operators import labels as lb
from barloom.operators import signals as sg
from barloom.operators.blocks import Blocks, with_position
from barloom.operators.features import features
from barloom.operators.folds import in_holdout
from barloom.operators.resample import resample, tick_order
from barloom.operators.upsert import ORDER_KEY, keep_latest
from barloom.plans import training
from barloom.sinks.writers import (
    append_job_log,
    upsert,
    write_epoch,
    write_features,
    write_metrics,
    written,
)
from barloom.sources import payloads, readers
from barloom.sources.synthetic import constant_bars
from barloom.streaming import streams


# -- layout ---------------------------------------------------------------------------------------


def test_positions_with_many_tiles_and_gaps(spark):
    pdf = random_bars(5, {"A": 500, "B": 3})
    got = by_symbol(with_position(to_spark(spark, pdf), tile_seconds=3600))
    for symbol, n in (("A", 500), ("B", 3)):
        assert list(got[symbol].i) == list(range(n)) and (got[symbol].n == n).all()


def test_blocks_hold_a_bounded_number_of_rows(spark):
    rows = with_position(to_spark(spark, random_bars(5, {"A": 500, "B": 3})))
    blocks = Blocks.of(rows, before=10, after=1, rows=64)
    sizes = blocks.df.groupBy("symbol", "block").count().toPandas()
    assert sizes["count"].max() <= 64 + 11 and len(sizes) == 8 + 1
    assert blocks.own_rows().count() == 503
    with pytest.raises(ValueError):
        Blocks.of(rows, before=65, rows=64)


def test_feature_plan_shuffles_bars_once(spark, tmp_path):
    path = str(tmp_path / "bars")
    with_position(to_spark(spark, random_bars(5, {"A": 500}))).write.parquet(path)
    plan = features(spark.read.parquet(path), ["skew", "bb", "mom"])._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("Exchange hashpartitioning") == 1
    read = text[text.index("ReadSchema") :].split("\n")[0]
    assert "open" in read  # base columns are part of the result
    narrow = features(spark.read.parquet(path), ["mom"]).select("symbol", "MOM7")
    read = narrow._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert "close" in read and "volume" not in read.split("\n")[0]


# -- sources --------------------------------------------------------------------------------------


def test_bar_payload(spark):
    text = json.dumps(
        {"result": {"list": [["1704067200000", "1", "2", "0.5", "1.5", "10", "99"], ["1704066300000", "3", "4", "2.5", "3.5", "20", "98"]]}}
    )
    df = spark.createDataFrame([("X", text)], "symbol string, value string")
    got = payloads.parse_bars(df).orderBy("ts").toPandas()
    assert list(got.open) == [3.0, 1.0] and list(got.volume) == [20.0, 10.0]
    assert got.ts[1] == pd.Timestamp("2024-01-01")


def test_balance_error_becomes_null(spark):
    rows = [json.dumps({"time": 1704067200000, "result": {"list": [{"totalWalletBalance": v}]}}) for v in ("12.5", "-99999")]
    rows.append(json.dumps({"time": 1704067200000, "result": {"list": []}}))
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    got = payloads.parse_balance(df).toPandas()
    assert list(got.is_error) == [False, True, True] and got.balance[0] == 12.5 and got.balance[1:].isna().all()


def test_csv_round_trip(spark, tmp_path):
    pdf = random_bars(2, {"A": 20})
    pdf.rename(columns={"ts": "date"})[["date", "symbol", *S.OHLCV]].to_csv(tmp_path / "bars.csv", index=False)
    got = by_symbol(readers.read_bar_csv(spark, str(tmp_path / "bars.csv")))["A"]
    want = pdf.sort_values("ts").reset_index(drop=True)
    assert (got.ts == want.ts).all()
    close_to(got.close, want.close)
    assert readers.artifact_path("s3://b/", "r1", "ss/x") == "s3://b/0/r1/ss/x"


def test_artifact_listing(spark, tmp_path):
    root = tmp_path / "data"
    root.mkdir()
    for name in ("features_20240101000000.csv", "features_20240201000000.csv", "preprocess_20240301000000.csv"):
        (root / name).write_text("x")
    latest = reshape.latest_artifact(readers.list_artifacts(spark, str(root)), "features_").first().path
    assert latest.endswith("features_20240201000000.csv")


def test_scan_rejects_unknown_lookback(spark):
    with pytest.raises(ValueError):
        readers.scan_bars(spark.createDataFrame([], S.MEASUREMENT_SCHEMA), "m", "3d", F.current_timestamp())


def test_previous_run_tag_without_second_parent(spark):
    runs = spark.createDataFrame([("a", "main", 2), ("b", "build", 1)], "run_uuid string, name string, start_time bigint")
    tags = spark.createDataFrame([("a", "source.git.commit", "c0")], "run_uuid string, key string, value string")
    assert reshape.previous_run_tag(runs, tags).first().value == ""
    more = runs.union(spark.createDataFrame([("c", "main", 5)], runs.schema))
    assert reshape.previous_run_tag(more, tags).first().value == "c0"


# -- sinks ----------------------------------------------------------------------------------------


def _pull(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, at string, ingest_ts int, close double")
    return df.select("symbol", F.col("at").cast("timestamp").alias("ts"), "ingest_ts", "close")


def test_upsert_keeps_newest_and_rewrites_touched_days(spark, tmp_path):
    path = str(tmp_path / "bars")
    first = [("X", "2024-01-01 00:00:00", 1, 1.0), ("X", "2024-01-02 00:00:00", 1, 2.0)]
    second = [("X", "2024-01-02 00:00:00", 2, 2.5), ("X", "2024-01-02 00:15:00", 2, 3.0), ("X", "2024-01-02 00:15:00", 1, 9.0)]
    upsert(spark, _pull(spark, first), path)
    upsert(spark, _pull(spark, second), path)
    upsert(spark, _pull(spark, second), path)  # a repeated pull changes nothing
    got = spark.read.parquet(path).orderBy("ts").toPandas()
    assert list(got.close) == [1.0, 2.5, 3.0]


def test_orders_created_together_do_not_replace_each_other(spark):
    rows = spark.createDataFrame([("X", 1, "Buy", 1, 5.0), ("X", 1, "Sell", 1, 6.0), ("X", 1, "Buy", 2, 5.5)], "symbol string, ts int, side string, ingest_ts int, price double")
    got = keep_latest(rows, ORDER_KEY).orderBy("side").collect()
    assert [r.price for r in got] == [5.5, 6.0]


def test_feature_and_log_files(spark, tmp_path):
    table = features(constant_bars(spark, bars=30, symbols=2), ["time", "mom"])
    path = write_features(table, str(tmp_path), "features", "20240101000000")
    assert path.endswith("data/features_20240101000000")
    assert spark.read.parquet(path).count() == 60
    as_csv = write_features(table, str(tmp_path), "features_csv", "20240101000000", csv=True)
    names = tuple(c for c in table.columns if c not in ("symbol", "ts"))
    again = readers.read_bar_csv(spark, as_csv, names, by_folder=True)
    assert again.exceptAll(table).isEmpty() and again.count() == 60
    assert readers.newest_artifact(spark, str(tmp_path), "features_2").endswith("features_20240101000000")
    assert readers.newest_artifact(spark, str(tmp_path), "none") is None


def test_repeated_writes_replace_their_rows(spark, tmp_path):
    log, history, plan = (str(tmp_path / n) for n in ("log", "metrics", "orders"))
    for message in ("start", "end"):
        append_job_log(spark, log, "recorder", message)
    for _ in range(2):
        append_job_log(spark, log, "recorder", "batch 3", entry="recorder-3")
    assert spark.read.parquet(log).count() == 3
    metrics = spark.createDataFrame([("X", "pnl", 1.0, 0)], "symbol string, key string, value double, step int")
    for run, kind in (("run-1", "a"), ("run-1", "a"), ("run-1", "b"), ("run-2", "a")):
        write_metrics(metrics, history, run, kind)
    assert sorted(r.run_id for r in spark.read.parquet(history).collect()) == ["run-1", "run-1", "run-2"]
    for epoch in (0, 1, 1):
        write_epoch(metrics, plan, epoch)
    assert spark.read.parquet(plan).count() == 2


# -- scaling, orders ------------------------------------------------------------------------------


def test_scaler_of_constant_features(spark):
    bars = constant_bars(spark, bars=10, features=5)
    state = scaler.fit_scaler(bars)
    assert state.count() == 5 and {r.scale for r in state.collect()} == {1.0}
    scaled = scaler.apply_scaler(bars, state)
    assert scaled.columns == bars.columns and "buy" not in scaled.columns
    assert scaled.agg(F.sum(F.abs("feature0")), F.count("*")).first()[:] == (0.0, 10)


def test_scaler_sees_first_train_range_only(spark):
    rows = with_position(to_spark(spark, random_bars(9, {"A": 200})))
    params = S.OptimizeParams(n_splits=3)
    state, scaled = scaler.standardise(rows, params, ["close"])
    g = by_symbol(rows)["A"]
    train = g.close[: 150 - 3 * (150 // 4) - 5]
    row = state.first()
    assert row["mean"] == pytest.approx(train.mean()) and row["scale"] == pytest.approx(train.std(ddof=0))
    close_to(by_symbol(scaled)["A"].close, (g.close - train.mean()) / train.std(ddof=0))


@pytest.mark.parametrize(
    ("side", "size", "want"),
    [
        (None, None, {"buy": 1.0, "sell": 1.0}),
        ("Buy", 2.0, {"buy": 1.0, "sell": 3.0}),
        ("Sell", 2.0, {"buy": 3.0, "sell": 1.0}),
        ("Buy", 3.0, {"sell": 4.0}),
        ("Sell", 3.0, {"buy": 4.0}),
    ],
)
def test_order_rules(spark, side, size, want):
    prices = spark.createDataFrame([("X", 9.0, 11.0)], "symbol string, buy_limit_price double, sell_limit_price double")
    held = [("X", 5, side, size), ("X", 1, "Buy", 0.5)] if side else []
    positions = spark.createDataFrame(held, "symbol string, ts int, side string, size double")
    plan = orders.plan_orders(prices, positions, lot=1.0, max_pyramiding=3).collect()
    assert {r.side: r.qty for r in plan} == want
    assert all(r.price == (9.0 if r.side == "buy" else 11.0) for r in plan)


# -- models ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def trained(spark):
    bars = with_position(to_spark(spark, random_bars(11, {"A": 420, "B": 400})))
    table = written(with_position(features(bars, ["mom", "roc", "rsi", "bb_width"], drop_incomplete=True)), "t")
    state, scaled = scaler.standardise(table)
    rows = lb.labels(sg.signal_blocks(scaled, entry_length=3, entry_point=0.05))
    rows = written(rows, "t")
    columns = scaler.feature_columns(rows)
    params = search.classifier_trials(1)[0] | {"max_depth_buy": 2, "max_depth_sell": 2}
    fitted = model.fit_classifiers(rows.where(~in_holdout(S.OptimizeParams())), columns, params, iterations=2)
    return bars, written(state, "t"), rows, fitted


def test_predictions_keep_rows_and_saved_models_agree(spark, trained, tmp_path):
    _, _, rows, fitted = trained
    scored = fitted.predict(rows)
    assert scored.count() == rows.count()
    assert scored.columns == [*rows.columns, "pred_buy", "pred_sell"]
    fitted.save(str(tmp_path / "model"))
    again = model.Classifiers.load(str(tmp_path / "model")).predict(rows)
    assert scored.exceptAll(again).isEmpty()
    ranked = model.importances(fitted, "sell", rows)
    assert {r.feature for r in ranked.collect()} == set(fitted.columns)


def test_holdout_variants(trained):
    _, _, rows, fitted = trained
    part = rows.where(in_holdout(S.OptimizeParams()))
    got = model.evaluate_holdout(part, fitted)
    assert {r["variant"]: r["count"] for r in got.groupBy("variant").count().collect()} == {
        "base": part.count(), "gated": part.count(),
    }
    empty = rows.where("i < 0")
    with pytest.raises(ValueError, match="too short"):
        model.fit_classifiers(empty, fitted.columns, search.classifier_trials(1)[0])


def test_class_weights(trained):
    rows = trained[2]
    got = model.balance_weights(rows).select("y_buy", "weight_buy").distinct().toPandas().set_index("y_buy")
    n = rows.count()
    for label, count in rows.groupBy("y_buy").count().collect():
        assert got.weight_buy[label] == pytest.approx(n / (2 * count))


def test_classifier_search_scores_every_trial(trained):
    rows, fitted = trained[2], trained[3]
    trials = [t | {"max_depth_buy": 1, "max_depth_sell": 1} for t in search.classifier_trials(2)]
    params = S.OptimizeParams(n_splits=2)
    scores = model.classifier_scores(rows, fitted.columns, trials, params=params, iterations=1)
    assert model.chosen_trial(model.pooled_scores(scores).where("trial < 0"), trials, "maximize") == trials[0]
    assert {(r.symbol, r.trial) for r in scores.collect()} == {(s, t) for s in "AB" for t in (0, 1)}


def test_live_tick_scores_newest_bar_and_plans_orders(spark, trained, tmp_path):
    bars, state, _, fitted = trained
    tuned = spark.createDataFrame([("A", 5, 0.1), ("B", 7, 0.3)], "symbol string, entry_length int, entry_point double")
    composite = model.CompositeModel(tuned, state, fitted)
    composite.save(str(tmp_path / "composite"))
    composite = model.CompositeModel.load(spark, str(tmp_path / "composite"))
    pulled = tmp_path / "pulled"
    timed = bars.select(*S.BASE_COLUMNS, F.lit(1).alias("ingest_ts"))
    timed.where("i < n - 2").coalesce(1).write.parquet(str(pulled))
    timed.where("i >= n - 2").coalesce(1).write.mode("append").parquet(str(pulled))
    schema = spark.read.parquet(str(pulled)).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(pulled))
    paths = {k: str(tmp_path / k) for k in ("bars", "orders", "checkpoint")}
    none = lambda s: s.createDataFrame([], "symbol string, ts timestamp, side string, size double")
    streams.stream_orders(
        stream, paths["bars"], paths["orders"], paths["checkpoint"], composite, none
    ).awaitTermination()
    stored = spark.read.parquet(paths["bars"])
    assert stored.count() == bars.count()
    assert streams.recent_days(spark, paths["bars"], 50).count() < stored.count()
    plans = spark.read.parquet(paths["orders"])
    assert [r.epoch for r in plans.select("epoch").distinct().orderBy("epoch").collect()] == [0, 1]
    plan = plans.where("epoch = 1").toPandas()
    assert sorted(zip(plan.symbol, plan.side)) == [("A", "buy"), ("A", "sell"), ("B", "buy"), ("B", "sell")]
    newest = {
        s: by_symbol(sg.signals(bars, entry_length=n, entry_point=p))[s]
        for s, n, p in (("A", 5, 0.1), ("B", 7, 0.3))
    }
    for _, row in plan.iterrows():
        last = newest[row.symbol].iloc[-1]
        offset = row.price - last[row.side]
        assert min(abs(offset), abs(abs(offset) - S.GATE_OFFSET)) < 1e-6


# -- streams --------------------------------------------------------------------------------------


def _ticks(spark, path, rows):
    pdf = pd.DataFrame(rows, columns=["ts", "seq", "price"]).assign(symbol="X", volume=1.0)
    pdf["ts"] = pd.to_datetime(pdf.ts)
    to_spark(spark, pdf).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    path, checkpoint = str(tmp_path / "ticks"), str(tmp_path / "checkpoint")
    target = str(tmp_path / "bars")
    _ticks(spark, path, [("2024-01-01 00:01", 1, 5.0), ("2024-01-01 00:03", 2, 7.0), ("2024-01-01 00:20", 3, 6.0)])
    schema = spark.read.parquet(path).schema

    def run():
        ticks = spark.readStream.schema(schema).parquet(path)
        bars = streams.stream_resample(ticks, "5 minutes", "1 minute", tick_order())
        query = (
            bars.writeStream.format("parquet").option("path", target)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    run()
    _ticks(spark, path, [("2024-01-01 02:00", 4, 8.0)])
    run()
    _ticks(spark, path, [("2024-01-01 03:00", 5, 9.0)])
    run()
    _ticks(spark, path, [("2024-01-01 00:02", 6, 99.0), ("2024-01-01 04:00", 7, 1.0)])
    run()
    _ticks(spark, path, [("2024-01-02 00:00", 8, 1.0)])
    run()
    got = spark.read.parquet(target).orderBy("ts").toPandas()
    on_time = spark.read.parquet(path).where("seq NOT IN (6, 8)")
    want = resample(on_time, "5 minutes", tick_order()).orderBy("ts").toPandas()
    pd.testing.assert_frame_equal(got, want)
    assert got.high[0] == 7.0


def test_stream_payloads_upsert_and_log(spark, tmp_path):
    source = tmp_path / "payloads"
    source.mkdir()
    bar = lambda ms, c: [str(ms), "1", "2", "0.5", str(c), "10", "0"]
    pulls = [[bar(1704067200000, 1.0), bar(1704068100000, 2.0)], [bar(1704068100000, 2.5), bar(1704069000000, 3.0)]]
    for k, rows in enumerate(pulls):
        (source / f"{k}.json").write_text(json.dumps({"result": {"list": rows}}))
        bars = streams.stream_payloads(spark, str(source), "bars", "X").withColumn("ingest_ts", F.lit(k))
        streams.stream_upsert(
            bars, str(tmp_path / "bars"), str(tmp_path / "checkpoint"), log_path=str(tmp_path / "log")
        ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "bars")).orderBy("ts").toPandas()
    assert list(got.close) == [1.0, 2.5, 3.0]
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_recent_bars(spark):
    rows = to_spark(spark, random_bars(5, {"A": 30, "B": 3}))
    assert streams.recent_bars(rows, 10).count() == 13


# -- end to end -----------------------------------------------------------------------------------


def test_training_run(spark, tmp_path):
    bars = to_spark(spark, random_bars(21, {"A": 520, "B": 480}))
    params = S.OptimizeParams(n_splits=2, n_trials=3, n_trials_clf=2, gap=2)
    run = training.train(spark, bars, str(tmp_path), "run1", params=params, iterations=1)
    assert run.left_out.isEmpty()
    assert run.best.count() == 2 and set(run.best.columns) >= {"entry_length", "entry_point", "metric"}
    history = spark.read.parquet(run.metrics_path)
    keys = {r.key for r in history.select("key").distinct().collect()}
    assert {"train_start_index", "eval_end_index", "pnl", "pnl_with_2nd", "best_entry_length"} <= keys
    typed = reshape.best_parameters(
        history.where("symbol <> '*'"), {"entry_length": "int", "entry_point": "double"}, ["symbol"]
    )
    assert typed.orderBy("symbol").collect() == run.best.select(*typed.columns).orderBy("symbol").collect()
    assert reshape.fold_table(history, ["symbol"]).count() == 4
    assert {r.variant for r in run.curves.select("variant").distinct().collect()} == {"base", "gated"}
    last = {r.symbol: r.ts for r in run.bars.where("i = n - 1").collect()}
    for variant in ("base", "gated"):
        ends = run.curves.where(F.col("variant") == variant).groupBy("symbol").agg(F.max("ts").alias("ts"))
        assert {r.symbol: r.ts for r in ends.collect()} == last
    chosen = reshape.best_parameters(history, model.PARAMETER_TYPES, ["run_id"]).first().asDict()
    assert {k: pytest.approx(v) for k, v in chosen.items() if k != "run_id"} == {
        k: v for k, v in run.classifier_params.items() if k != "trial"
    }
    assert spark.read.parquet(f"{tmp_path}/0/run1/artifacts/importances_buy").count() == 60
    prices = model.CompositeModel.load(spark, run.model_path).score(run.bars)
    assert prices.count() == 2
    _, _, scaled = training.preprocess(spark, run.bars, str(tmp_path), "run2", params, reuse=True)
    assert scaled.count() > 0


def test_ingestion_run(spark, tmp_path):
    source = tmp_path / "pulled"
    source.mkdir()
    rows = [[str(1704067200000 + 900000 * k), "1", "2", "0.5", "1.5", "10", "0"] for k in range(5)]
    (source / "a.json").write_text(json.dumps({"result": {"list": rows}}))
    paths = str(tmp_path / "bars"), str(tmp_path / "log")
    training.ingest(spark, str(source), *paths, "X")
    assert training.ingest(spark, str(source), *paths, "X").count() == 5
    assert spark.read.parquet(paths[1]).count() == 4


# -- bounded files, unreadable payloads -----------------------------------------------------------


def _files(path) -> list[str]:
    return [str(f) for f in path.rglob("part-*") if not f.name.endswith(".crc")]


def test_short_symbols_have_one_file_each(spark, tmp_path):
    """1,000 symbols of 50 rows over 200 partitions: a file per symbol, with or without positions."""
    rows = spark.range(50_000).select(
        (F.col("id") % 1000).cast("string").alias("symbol"),
        F.timestamp_seconds(F.col("id") * 900).alias("ts"),
        F.floor(F.col("id") / 1000).alias("i"),
        F.lit(1.0).alias("x"),
    )
    spark.conf.set("spark.sql.shuffle.partitions", 200)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = write_features(rows, str(tmp_path), "placed", "1")
        write_features(rows.drop("i"), str(tmp_path), "dated", "1")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(_files(tmp_path / "data" / "placed_1")) == 1000
    assert len(_files(tmp_path / "data" / "dated_1")) <= 2000
    assert spark.read.parquet(placed).columns == ["ts", "x", "symbol"]


def test_log_and_epochs_do_not_grow_by_folders(spark, tmp_path):
    log, plan = tmp_path / "log", tmp_path / "plan"
    for k in range(5):
        append_job_log(spark, str(log), "recorder", f"m{k}", entry=f"e{k % 4}")
        write_epoch(spark.range(2), str(plan), k % 4)
    assert len(_files(log)) == 1 and len(_files(plan)) == 1
    assert {r.message for r in spark.read.parquet(str(log)).collect()} == {"m1", "m2", "m3", "m4"}
    assert spark.read.parquet(str(plan)).count() == 8


def test_upserted_days_have_few_files(spark, tmp_path):
    path = tmp_path / "bars"
    rows = [(f"S{s}", f"2024-01-0{1 + s % 2} 00:{m:02d}:00", 1, 1.0) for s in range(40) for m in range(50)]
    for _ in range(2):
        upsert(spark, _pull(spark, rows).repartition(16), str(path))
    assert spark.read.parquet(str(path)).count() == 2000
    assert len(_files(path)) <= 16


@pytest.mark.parametrize("tie", ["seq", None])
def test_keep_latest_over_the_whole_range_of_numbers(spark, tie):
    rows = [
        ("a", 6 * 10**18, 1, 1.0), ("a", 5 * 10**18, 9, 2.0), ("b", -(2**63), -5, 3.0), ("b", 2**63 - 1, -9, 4.0),
        ("c", 7, -3, 5.0), ("c", 7, -8, 6.0), ("c", None, 99, 7.0), ("d", None, None, 8.0),
    ]
    df = spark.createDataFrame(rows, "symbol string, version bigint, seq bigint, price double")
    got = {r.symbol: r.price for r in keep_latest(df, ["symbol"], "version", tie).collect()}
    assert got["a"] == 1.0 and got["b"] == 4.0 and got["d"] == 8.0
    assert got["c"] == 5.0 if tie else got["c"] in (5.0, 6.0)


def test_recent_days_are_those_of_each_symbol(spark, tmp_path):
    """A symbol that stopped long ago does not widen the others' days."""
    rows = [("old", f"2020-01-{d:02d} 00:00:00", 1, 1.0) for d in range(1, 6)]
    rows += [("new", f"2024-01-{d:02d} 00:00:00", 1, 1.0) for d in range(1, 29)]
    upsert(spark, _pull(spark, rows), str(tmp_path / "bars"))
    recent = streams.recent_days(spark, str(tmp_path / "bars"), 3)
    assert {r.symbol: r["count"] for r in recent.groupBy("symbol").count().collect()} == {"old": 3, "new": 3}


BAD_BARS = {
    "": "empty",
    "not json": "not of the layout",
    '{"result": {"list": [[': "not of the layout",
    '{"result": {}}': "no entries",
    '{"result": {"list": [["1704067200000", "1", "2", "0.5"]]}}': "bad close",
    '{"result": {"list": [["1704067200000", "n/a", "2", "0.5", "1", "1", "0"]]}}': "bad open",
    '{"result": {"list": [["soon", "1", "2", "0.5", "1", "1", "0"]]}}': "bad ts",
    '{"result": {"list": [["99999999999999999", "1", "2", "0.5", "1", "1", "0"]]}}': "bad ts",
    '{"result": {"list": [["1704067200000", "1", "NaN", "0.5", "1", "1", "0"]]}}': "bad high",
    '{"result": {"list": [["1704067200000", "1", "2", "0.5", "1", "Infinity", "0"]]}}': "bad volume",
}


def test_unreadable_payloads_are_set_apart(spark):
    from barloom.sources import payloads

    good = '{"result": {"list": [["1704067200000", "1", "2", "0.5", "1.5", "1", "0"], ["x"]]}}'
    rows = spark.createDataFrame([(t,) for t in (*BAD_BARS, good, '{"result": {"list": []}}')], "value string")
    judged = payloads.judged(rows.union(spark.createDataFrame([(None,)], "value string")), "bars")
    assert [r.close for r in payloads.accepted(judged, "bars").collect()] == [1.5]
    bad = {(r.raw, r.reason) for r in payloads.rejects(judged).collect()}
    assert bad == {*BAD_BARS.items(), (good, "bad ts"), (None, "empty")}
    texts = ["junk", '{"info": null}', '{"info": {"createdTime": "1", "side": "", "size": "2", "avgPrice": "", "symbol": "X"}}',
             '{"info": {"createdTime": "1", "size": "2", "avgPrice": "?", "symbol": "X"}}', '{"info": {"createdTime": "1", "size": "2"}}']
    info = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [r.size for r in payloads.parse_positions(info).collect()] == [2.0]
    reasons = [r.reason for r in payloads.judged(info, "positions").collect()]
    assert reasons == ["not of the layout", "no entries", None, "bad avg_price", "bad symbol"]
    wallet = spark.createDataFrame(
        [(f'{{"time": 1, "result": {{"list": [{x}]}}}}',) for x in ('{"totalWalletBalance": "?"}', '{"totalWalletBalance": "-99999"}', "", '{"totalWalletBalance": "5"}')],
        "value string",
    )
    assert [(r.balance, r.is_error) for r in payloads.parse_balance(wallet).collect()] == [(None, True), (None, True), (5.0, False)]


def test_stream_with_junk_files_ends_with_the_good_rows(spark, tmp_path):
    source = tmp_path / "payloads"
    source.mkdir()
    paths = [str(tmp_path / n) for n in ("bars", "rejects", "checkpoint")]
    bar = lambda ms: json.dumps({"result": {"list": [[str(ms), "1", "2", "0.5", "1", "1", "0"]]}})
    for k, text in enumerate([bar(0) + "\njunk\n" + bar(900_000), "\x00\x01", bar(900_000)]):
        (source / f"{k}.json").write_text(text)
        streams.stream_payload_table(spark, str(source), "bars", "X", *paths).awaitTermination()
    assert spark.read.parquet(paths[0]).count() == 2
    bad = spark.read.parquet(paths[1]).collect()
    assert sorted((r.raw, r.reason, r.file[-6:]) for r in bad) == [
        ("\x00\x01", "not of the layout", "1.json"), ("junk", "not of the layout", "0.json"),
    ]


# -- features from kept state ---------------------------------------------------------------------


def _feed(spark, path, bars, low, high):
    part = bars.where((F.col("i") >= low) & (F.col("i") < high)).select(*S.BASE_COLUMNS)
    part.repartition(2).coalesce(1).write.mode("append").parquet(path)


def test_live_features_equal_the_batch_after_every_restart(spark, tmp_path):
    """Single bars, overlapping pulls and repeated bars, one query run per pull."""
    from barloom.streaming.live import RECENT, live_features

    bars = with_position(to_spark(spark, random_bars(17, {"A": 280, "B": 230})))
    want = features(bars).toPandas().set_index(["symbol", "ts"]).sort_index()
    path, target, checkpoint = (str(tmp_path / n) for n in ("bars", "rows", "checkpoint"))
    for low, high in ((0, 3), (0, 150), (140, 201), (201, 202), (202, 203), (150, 240), (239, 280)):
        _feed(spark, path, bars, low, high)
        stream = spark.readStream.schema(bars.select(*S.BASE_COLUMNS).schema).parquet(path)
        query = (
            live_features(stream).writeStream.format("parquet").option("path", target)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        assert query.lastProgress is None or query.lastProgress["numInputRows"] <= 2 * (high - low)
    got = spark.read.parquet(target).toPandas().set_index(["symbol", "ts"]).sort_index()
    assert got.index.equals(want.index)
    for name in want.columns:
        np.testing.assert_allclose(got[name], want[name], rtol=1e-7, atol=1e-9, err_msg=name)
    assert set(got.columns) - set(want.columns) == set(RECENT)
    last = got.iloc[-1]
    assert len(last.recent_high) == 25 and last.recent_high[-1] == last.high


def test_live_orders_need_no_history(spark, trained, tmp_path):
    bars, state, _, fitted = trained
    tuned = spark.createDataFrame([("A", 5, 0.1), ("B", 25, 0.3)], "symbol string, entry_length int, entry_point double")
    composite = model.CompositeModel(tuned, state, fitted)
    none = lambda s: s.createDataFrame([], "symbol string, ts timestamp, side string, size double")
    path, target, checkpoint = (str(tmp_path / n) for n in ("bars", "orders", "checkpoint"))
    for low, high in ((0, 399), (399, 400), (400, 1000)):
        _feed(spark, path, bars, low, high)
        stream = spark.readStream.schema(bars.select(*S.BASE_COLUMNS).schema).parquet(path)
        streams.stream_live_orders(stream, target, checkpoint, composite, none).awaitTermination()
    plans = spark.read.parquet(target).toPandas()
    assert plans.groupby(["epoch", "symbol"]).size().to_dict() == {(0, "A"): 2, (0, "B"): 2, (1, "A"): 2, (1, "B"): 2, (2, "A"): 2}
    want = {r.symbol: r for r in composite.score(bars).collect()}
    for symbol, epoch in (("A", 2), ("B", 1)):
        rows = plans[(plans.symbol == symbol) & (plans.epoch == epoch)].set_index("side").price
        assert rows["buy"] == pytest.approx(want[symbol].buy_limit_price)
        assert rows["sell"] == pytest.approx(want[symbol].sell_limit_price)


# -- tables that grow -----------------------------------------------------------------------------


def test_cascade_equals_direct_resampling(spark):
    from barloom.operators.resample import checked_cascade, resample_cascade

    rng = np.random.default_rng(4)
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.sort(rng.integers(0, 86400, 500)), unit="s")
    pdf = pd.DataFrame({"symbol": rng.choice(["A", "B"], 500), "ts": ts, "seq": range(500), "price": rng.normal(size=500), "volume": 1.0})
    ticks = to_spark(spark, pdf)
    for interval, bars in resample_cascade(ticks, ["1 minute", "5 minutes", "1 hour", "1 day"], tick_order()).items():
        want = resample(ticks, interval, tick_order())
        assert bars.exceptAll(want).isEmpty() and bars.count() == want.count()
    for wrong in (["5 minutes", "1 minute"], ["2 minutes", "5 minutes"], ["1 hour", "1 hour"]):
        with pytest.raises(ValueError, match="multiple"):
            checked_cascade(wrong)


def test_scaler_state_from_day_moments(spark):
    """Merged days equal one pass over all rows, at a far level too; constants scale by one."""
    bars = to_spark(spark, random_bars(13, {"A": 500, "B": 40})).withColumns(
        {"far": F.col("close") + 1e9, "flat": F.lit(0.1), "gaps": F.when(F.col("close") > 100, F.col("close"))}
    )
    columns = ["close", "far", "flat", "gaps"]
    cut = F.to_date("ts") < "2024-01-04"
    stored = written(scaler.day_moments(bars.where(cut), columns), "moments")
    again = scaler.day_moments(bars.where(F.to_date("ts") >= "2024-01-03"), columns)
    state = scaler.scaler_of(scaler.with_new_days(stored, again)).toPandas().set_index(["symbol", "column"])
    want = scaler.fit_scaler(bars, columns).toPandas().set_index(["symbol", "column"])
    assert set(state.index) == set(want.dropna().index)
    for key in state.index:
        assert state["mean"][key] == pytest.approx(want["mean"][key], rel=1e-12)
        assert state.scale[key] == pytest.approx(want.scale[key], rel=1e-6) or key[1] == "flat"
    assert set(state.xs("flat", level="column").scale) == {1.0}


def test_progress_log_replaces_replayed_batches(spark, tmp_path):
    log = streams.ProgressLog(spark, str(tmp_path / "log"))
    row = ("q", "r", 0, 5, 10, None, "2024-01-01T00:00:00.000Z")
    for rows in ([row, ("q", "r", 1, 7, 11, "2024-01-01T00:00:00.000Z", "2024-01-02T00:00:00.000Z")], [("q", "r2", 0, 5, 12, None, "2024-01-01T00:00:05.000Z")], []):
        log.rows.extend(rows)
        log.flush()
    got = {(r.batch, r.rows, r.millis) for r in spark.read.parquet(str(tmp_path / "log")).collect()}
    assert got == {(0, 5, 12), (1, 7, 11)} and len(_files(tmp_path / "log")) == 2


def test_stored_bars_leave_one_table_and_no_shuffle(spark):
    """Bars without positions and the shuffles on the way are gone, the session's setting is as before."""
    import time

    from barloom import session
    from barloom.plans.market import stored

    root = Path(session.shared_dir(spark, "x").rsplit("/", 1)[0].removeprefix("file:"))
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def tables() -> set:
        return {p.name for p in root.iterdir()} if root.is_dir() else set()

    def shuffled() -> set:
        return {f.name for d in local for f in Path(d).rglob("shuffle_*.data")}

    pdf = random_bars(5, {"A": 500, "B": 3}).rename(columns={"close": "price"}).assign(seq=0)
    bars = resample(to_spark(spark, pdf), "1 hour", tick_order())
    known, files, setting = tables(), shuffled(), spark.conf.get(session._SHUFFLE_CLEANUP)
    rows = stored(bars)
    assert [name.split("-")[0] for name in tables() - known] == ["positions"]
    until = time.time() + 20
    while shuffled() - files and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - files
    assert spark.conf.get(session._SHUFFLE_CLEANUP) == setting
    assert rows.drop("i", "n").exceptAll(bars).isEmpty() and rows.count() == bars.count()


def test_resampling_shuffles_the_start_of_a_window_alone(spark):
    """The end of a window follows from its start; with it every row of the exchange is wider."""
    pdf = random_bars(5, {"A": 50}).rename(columns={"close": "price"}).assign(seq=0)
    pdf.loc[pdf.index[:5], "ts"] = pd.NaT
    bars = resample(to_spark(spark, pdf), "1 hour", tick_order())
    exchange = bars._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(")[1]
    assert "window" not in exchange.split("\n")[0] and bars.count() > 0
    assert bars.where("ts IS NULL").isEmpty()


def test_merges_and_triggers_leave_nothing_behind(spark, tmp_path):
    """What a merge or a micro-batch writes on its way is removed, also when it fails."""
    from barloom.session import scratch, shared_dir

    root = shared_dir(spark, "x").rsplit("/", 1)[0]

    def tables() -> set:
        import os

        return set(os.listdir(root.removeprefix("file:"))) if os.path.isdir(root.removeprefix("file:")) else set()

    before = tables()
    rows = [("X", "2024-01-01 00:00:00", 1, 1.0)]
    for _ in range(2):
        upsert(spark, _pull(spark, rows), str(tmp_path / "bars"))
        append_job_log(spark, str(tmp_path / "log"), "recorder", "m", entry="e")
        write_epoch(spark.range(2), str(tmp_path / "plan"), 0)
    source = tmp_path / "payloads"
    source.mkdir()
    (source / "a.json").write_text("junk")
    paths = [str(tmp_path / n) for n in ("rows", "rejects", "checkpoint")]
    streams.stream_payload_table(spark, str(source), "bars", "X", *paths).awaitTermination()
    with pytest.raises(ZeroDivisionError):
        with scratch(spark):
            written(spark.range(1), "left")
            1 / 0  # noqa: B018
    assert tables() == before
    assert spark.read.parquet(str(tmp_path / "bars")).count() == 1
