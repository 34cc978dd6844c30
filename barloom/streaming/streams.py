"""Structured Streaming forms: resampling, payload parsing, upserts, live scoring and job log."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from barloom import schema as S
from barloom.operators.blocks import with_position
from barloom.operators.model import CompositeModel
from barloom.operators.orders import order_rows, plan_orders
from barloom.operators.resample import checked_cascade, merged_bars, resample
from barloom.operators.upsert import BAR_KEY
from barloom.session import scratch, shared_dir
from barloom.sinks.writers import append_job_log, merge_log, upsert, write_epoch, written
from barloom.sources import payloads
from barloom.sources.payloads import parse_bars, parse_long_ratio, parse_open_interest
from barloom.streaming.live import live_features

PARSERS = {
    "bars": parse_bars,
    "open_interest": parse_open_interest,
    "long_ratio": parse_long_ratio,
}


def stream_resample(
    ticks: DataFrame, interval: str, lateness: str = "10 minutes", order: Column | None = None
) -> DataFrame:
    """Tumbling OHLCV bars with a watermark; rows behind it are dropped by the engine.

    In append mode a bar comes out once the watermark has passed its end.
    """
    timed = ticks.withColumn(S.TS, F.col(S.TS).cast("timestamp")).withWatermark(S.TS, lateness)
    return resample(timed, interval, order)


def stream_cascade(
    ticks: DataFrame, intervals: Sequence[str], lateness: str = "10 minutes", order: Column | None = None
) -> DataFrame:
    """Bars of the last interval through chained windows, each from the bars of the one before.

    Ticks are kept as state of the shortest interval only, the longer ones hold bars. In append mode
    a bar comes out once the watermark has passed its end.
    """
    checked_cascade(intervals)
    timed = ticks.withColumn(S.TS, F.col(S.TS).cast("timestamp")).withWatermark(S.TS, lateness)
    key = F.col(S.TS) if order is None else order
    bars = timed.groupBy(F.col(S.SYMBOL), F.window(S.TS, intervals[0]).alias("__slot")).agg(
        F.min_by("price", key).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", key).alias("close"),
        F.sum("volume").alias("volume"),
    )
    for interval in intervals[1:]:
        started = bars.withColumn("__time", F.col("__slot.start"))
        bars = merged_bars(started, interval, F.col("__time"), F.col("__slot"))
    return bars.select(S.SYMBOL, F.col("__slot.start").alias(S.TS), *S.OHLCV)


def _payload_lines(spark: SparkSession, path: str, symbol: str) -> DataFrame:
    lines = spark.readStream.text(path)
    return lines.select("value", F.lit(symbol).alias(S.SYMBOL), F.col("_metadata.file_path").alias("file"))


def stream_payloads(spark: SparkSession, path: str, kind: str, symbol: str) -> DataFrame:
    """Payload text files, one JSON document per line, parsed as they arrive."""
    return PARSERS[kind](_payload_lines(spark, path, symbol))


def stream_payload_table(
    spark: SparkSession, source: str, kind: str, symbol: str, path: str, rejects_path: str, checkpoint: str
) -> StreamingQuery:
    """Payload files into a keep-latest table, and what cannot be read into a table of its own.

    Rejected rows have the text, the reason and the file; a replayed batch replaces them. Bars of a
    later batch win over earlier ones.
    """
    keep = (S.SYMBOL, "file")

    def store(batch: DataFrame, epoch: int) -> None:
        with scratch(spark):
            rows = written(payloads.judged(batch, kind, keep=keep), "judged")
            good = payloads.accepted(rows, kind, keep).drop("file").withColumn("ingest_ts", F.lit(epoch))
            if not good.isEmpty():
                upsert(spark, good, path)
            bad = payloads.rejects(rows, keep)
            if not bad.isEmpty():
                write_epoch(bad, rejects_path, epoch)

    return (
        _payload_lines(spark, source, symbol)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_available(
    stream: DataFrame, purpose: str, mode: str = "append", checkpoint: str | None = None
) -> DataFrame:
    """Run a stream over everything available now into a parquet table, and read that table."""
    spark = stream.sparkSession
    target = shared_dir(spark, purpose)
    writer = stream.writeStream.outputMode(mode).option(
        "checkpointLocation", checkpoint or shared_dir(spark, f"{purpose}-checkpoint")
    )
    if mode == "complete":
        # Every trigger holds the whole result, so it replaces the table.
        query = writer.trigger(availableNow=True).foreachBatch(
            lambda batch, epoch: batch.write.mode("overwrite").parquet(target)
        ).start()
    else:
        query = writer.trigger(availableNow=True).format("parquet").option("path", target).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def stream_upsert(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = BAR_KEY,
    version: str = "ingest_ts",
    log_path: str | None = None,
    job: str = "recorder",
) -> StreamingQuery:
    """Keep-latest merge of every micro-batch into a table; a repeated batch changes nothing."""

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if not batch.isEmpty():
            upsert(spark, batch, path, keys, version)
        if log_path is not None:
            append_job_log(spark, log_path, job, f"batch {epoch}", entry=f"{job}-{epoch}")

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def recent_bars(bars: DataFrame, count: int) -> DataFrame:
    """The newest ``count`` bars of every symbol, by position and not by a per-symbol sort."""
    positioned = with_position(bars)
    return positioned.where(F.col("i") >= F.col("n") - count).drop("i", "n")


def recent_days(spark: SparkSession, bars_path: str, count: int) -> DataFrame:
    """Stored bars of the days that hold every symbol's newest ``count`` bars.

    Rows are counted per symbol and day from the symbol column alone. Every symbol has days of its
    own, so one that is no longer pulled makes nobody read further back; the earliest of these days
    still prunes the table's folders.
    """
    bars = spark.read.parquet(bars_path)
    newer = (
        Window.partitionBy(S.SYMBOL).orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)
    )
    days = bars.groupBy(S.SYMBOL, "day").count()
    needed = days.withColumn("newer", F.coalesce(F.sum("count").over(newer), F.lit(0)))
    needed = written(needed.where(F.col("newer") < count).select(S.SYMBOL, "day"), "recent-days")
    listed = [r.day for r in needed.select("day").distinct().collect()]
    return bars.where(F.col("day").isin(listed)).join(needed, [S.SYMBOL, "day"], "left_semi")


def stream_orders(
    rows: DataFrame,
    bars_path: str,
    orders_path: str,
    checkpoint: str,
    model: CompositeModel,
    positions: Callable[[SparkSession], DataFrame],
    lot: float = 0.001,
    max_pyramiding: int = 3,
    window: int | None = None,
) -> StreamingQuery:
    """Per trigger: store new bars, score the newest bar of every symbol, plan its orders.

    Scores come from the whole stored history, or, with a ``window``, from that many newest bars
    per symbol (exponential features then start anew with the window). A replayed trigger
    replaces its own orders.
    """

    def tick(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        upsert(spark, batch, bars_path)
        with scratch(spark):
            if window is None:
                bars = spark.read.parquet(bars_path).select(*S.BASE_COLUMNS)
            else:
                bars = recent_bars(recent_days(spark, bars_path, window).select(*S.BASE_COLUMNS), window)
            prices = model.score(written(bars, "live-bars"))
            write_epoch(plan_orders(prices, positions(spark), lot, max_pyramiding), orders_path, epoch)

    return (
        rows.writeStream.foreachBatch(tick)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_live_orders(
    bars: DataFrame,
    orders_path: str,
    checkpoint: str,
    model: CompositeModel,
    positions: Callable[[SparkSession], DataFrame],
    lot: float = 0.001,
    max_pyramiding: int = 3,
) -> StreamingQuery:
    """Per trigger: score the newest bar of every symbol that has new bars, and plan its orders.

    Features come from state kept per symbol (:func:`barloom.streaming.live.live_features`), so a
    trigger reads its own bars and no stored history. A replayed trigger replaces its own orders.
    """

    def tick(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        with scratch(spark):
            prices = model.score_live(written(batch, "live-rows"))
            write_epoch(plan_orders(prices, positions(spark), lot, max_pyramiding), orders_path, epoch)

    return (
        live_features(bars)
        .writeStream.foreachBatch(tick)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_order_plan(
    prices: DataFrame,
    positions: DataFrame,
    interval: str,
    lateness: str = "10 minutes",
    lot: float = 0.001,
    max_pyramiding: int = 3,
) -> DataFrame:
    """A stream of order rows ``symbol, ts, side, qty, price`` from two streams, per bar interval.

    ``prices`` has limit prices per bar start, ``positions`` rows ``symbol, ts, side, size`` at any
    time. The newest position of a symbol in a bar's interval is an aggregate that closes with the
    watermark; prices join it outer, so a bar without a position gets its orders once the watermark
    tells that none can come any more. Late rows of either side are left out.
    """
    held = (
        positions.select(S.SYMBOL, F.col(S.TS).cast("timestamp").alias(S.TS), "side", "size")
        .withWatermark(S.TS, lateness)
        .groupBy(F.col(S.SYMBOL).alias("__symbol"), F.window(S.TS, interval).alias("__held_in"))
        .agg(F.max(F.struct(S.TS, "side", "size")).alias("__newest"))
        .select("__symbol", "__held_in", F.col("__newest.side").alias("__held"), F.col("__newest.size").alias("__size"))
    )
    timed = prices.withColumn(S.TS, F.col(S.TS).cast("timestamp")).withWatermark(S.TS, lateness)
    timed = timed.select(
        S.SYMBOL, "buy_limit_price", "sell_limit_price", F.window(S.TS, interval).alias("__bar")
    )
    on = (F.col(S.SYMBOL) == F.col("__symbol")) & (F.col("__bar") == F.col("__held_in"))
    joined = timed.join(held, on, "left_outer").withColumn(S.TS, F.col("__bar.start"))
    return order_rows(joined, lot, max_pyramiding, (S.SYMBOL, S.TS))


class ProgressLog(StreamingQueryListener):
    """Rows about every micro-batch of named queries, in a table of bounded files.

    ``name, run, batch, rows, millis, watermark, ts``: a batch that is replayed replaces its row. Add
    it with ``spark.streams.addListener``; rows are kept until a query ends or ``every`` are there.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self.rows: list[tuple] = []
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        self.ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        p = event.progress
        self.rows.append(
            (p.name, str(p.runId), p.batchId, p.numInputRows, p.batchDuration, p.eventTime.get("watermark"), p.timestamp)
        )
        if len(self.rows) >= self.every:
            self.flush()

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        self.flush()
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Return once the rows of a query that has ended are written."""
        self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds)

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if not rows:
            return
        table = self.spark.createDataFrame(
            rows,
            "name string, run string, batch bigint, rows bigint, millis bigint, watermark string, ts string",
        )
        times = {c: F.col(c).cast("timestamp") for c in ("watermark", S.TS)}
        merge_log(table.withColumns(times), self.path, ["name", "batch"])
