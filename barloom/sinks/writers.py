"""Writers. Each returns the path or table it wrote, so that the next stage can read it."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.operators.blocks import LENGTH, POSITION
from barloom.operators.upsert import BAR_KEY, keep_latest, merge_latest
from barloom.session import scratch, shared_dir


def written(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """Write a table to the cluster's shared folder and read it back.

    Cuts lineage between the stages of a flow: a lost executor re-reads the written files instead
    of recomputing the stages before, and several uses of a table compute it once. ``path`` names
    another folder than a new one for the purpose.
    """
    path = path or shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of one symbol in a file of features.
FILE_ROWS = 65_536
#: Files of one day in a table that is merged into, at most; a day's rows are dealt over them.
DAY_FILES = 8
#: Micro-batches whose rows share a folder.
EPOCHS = 256


def write_features(
    df: DataFrame, root: str, name: str, run_stamp: str, csv: bool = False
) -> str:
    """Features or preprocessed rows under ``<root>/data/<name>_<stamp>``, one folder per symbol.

    A symbol has one file per ``FILE_ROWS`` rows of its series where rows know their position (which is
    not written), else one per year: short symbols have one file, and a hot symbol is many tasks.
    CSV files carry the time as ``date``, as :func:`read_bar_csv` expects it.
    """
    path = f"{root.rstrip('/')}/data/{name}_{run_stamp}"
    placed = POSITION in df.columns
    part = F.floor(F.col(POSITION) / FILE_ROWS) if placed else F.year(S.TS)
    dealt = df.repartition(S.SYMBOL, part).drop(*([POSITION, LENGTH] if placed else []))
    if csv:
        dated = dealt.withColumnRenamed(S.TS, "date")
        rest = [f"`{c}`" for c in dated.columns if c not in (S.SYMBOL, "date")]
        dated.select(S.SYMBOL, "date", *rest).write.partitionBy(S.SYMBOL).csv(path, header=True)
    else:
        dealt.write.partitionBy(S.SYMBOL).parquet(path)
    return path


def upsert(
    spark: SparkSession,
    incoming: DataFrame,
    path: str,
    keys: Sequence[str] = BAR_KEY,
    version: str = "ingest_ts",
) -> str:
    """Keep-latest merge into a parquet table partitioned by day; only touched days are rewritten.

    The merged days are written to a new folder first and then replace the old ones, because a
    job must not overwrite files it reads. A day has at most ``DAY_FILES`` files.
    """
    dated = keep_latest(incoming, keys, version).withColumn("day", F.to_date(S.TS))
    salt = F.pmod(F.xxhash64(*keys), F.lit(DAY_FILES))
    if not _exists(spark, path):
        dated.repartition("day", salt).write.partitionBy("day").parquet(path)
        return path
    with scratch(spark):
        current = spark.read.parquet(path)
        touched = current.join(dated.select("day").distinct(), "day", "left_semi")
        merged = written(
            merge_latest(touched.select(*dated.columns), dated, keys, version), "upsert"
        )
        _replace(merged.repartition("day", salt), path, "day")
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def job_log_rows(spark: SparkSession, name: str, message: str | Column) -> DataFrame:
    """One log row at the current time."""
    text = F.lit(message) if isinstance(message, str) else message
    return spark.range(1).select(
        F.current_timestamp().alias(S.TS), F.lit(name).alias("name"), text.alias("message")
    )


def _replace(rows: DataFrame, path: str, *parts: str) -> None:
    """Write rows so that the partitions they fall into hold these rows alone.

    A repeated write, such as that of a replayed micro-batch, leaves the table as it is.
    """
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def append_job_log(
    spark: SparkSession, path: str, name: str, message: str, entry: str | None = None
) -> str:
    """Add a row to the job log, one file per day.

    A named entry replaces itself when it is written again, also on a later day: it stays in the
    day of its first row. One writer at a time.
    """
    row = job_log_rows(spark, name, message).withColumn("entry", F.lit(entry or uuid.uuid4().hex))
    first = None
    if entry is not None and _exists(spark, path):
        known = spark.read.parquet(path).where(F.col("entry") == entry)
        first = known.agg(F.min("day")).first()[0]
    day = F.to_date(S.TS) if first is None else F.lit(first)
    return _merge(row.withColumn("day", day), path, ["entry"])


def merge_log(rows: DataFrame, path: str, keys: Sequence[str]) -> str:
    """Put a few log rows (with ``ts``) into a table of one file per day, in place of those with the
    same keys on these days. One writer at a time."""
    return _merge(rows.withColumn("day", F.to_date(S.TS)), path, keys)


def _merge(rows: DataFrame, path: str, keys: Sequence[str]) -> str:
    """Put a few rows into their days' files, in place of those with the same keys."""
    spark = rows.sparkSession
    with scratch(spark):
        rows = written(rows, "log-rows")
        if _exists(spark, path):
            days = [r.day for r in rows.select("day").distinct().collect()]
            old = spark.read.parquet(path).where(F.col("day").isin(days))
            old = old.join(F.broadcast(rows.select(*keys).distinct()), list(keys), "left_anti")
            rows = written(old.select(*rows.columns).unionByName(rows), "merged")
        _replace(rows.repartition("day"), path, "day")
    return path


def write_epoch(rows: DataFrame, path: str, epoch: int) -> str:
    """Rows of one micro-batch; a replayed batch replaces its rows.

    ``EPOCHS`` micro-batches share a folder and its file, so their number does not grow with every
    trigger.
    """
    spark, part = rows.sparkSession, epoch // EPOCHS
    rows = rows.withColumns({"epoch": F.lit(epoch), "epochs": F.lit(part)})
    with scratch(spark):
        if _exists(spark, path):
            old = spark.read.parquet(path).where((F.col("epochs") == part) & (F.col("epoch") != epoch))
            rows = written(old.select(*rows.columns).unionByName(rows), "merged")
        _replace(rows.coalesce(1), path, "epochs")
    return path


def write_metrics(rows: DataFrame, path: str, run_id: str, kind: str = "metrics") -> str:
    """Metric rows ``(run_id, symbol, key, value, step, timestamp)`` of one run and kind.

    Writing a kind of a run again replaces its rows. Rows without a time of their own (epoch
    milliseconds) get the current one.
    """
    if "timestamp" not in rows.columns:
        rows = rows.withColumn("timestamp", F.unix_millis(F.current_timestamp()))
    named = rows.withColumns({"run_id": F.lit(run_id), "run": F.lit(run_id), "kind": F.lit(kind)})
    _replace(named, path, "run", "kind")
    return path
