"""Table readers: stored measurements, CSV with a time key, relational tables, artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import schema as S
from barloom.operators.reshape import pivot_fields

#: Look-back names of the measurement scan (fixed values).
LOOKBACKS = {
    "15m": "15 minutes",
    "1h": "1 hour",
    "2h": "2 hours",
    "4h": "4 hours",
    "6h": "6 hours",
    "8h": "8 hours",
    "12h": "12 hours",
    "1d": "1 day",
    "1w": "7 days",
    "1y": "365 days",
}


def scan_bars(
    long: DataFrame, measurement: str, start: str, now: Column, symbol: str | Column | None = None
) -> DataFrame:
    """Bars of one measurement newer than ``now - start``, pivoted from long form.

    All three filters are plain predicates, so on a parquet table partitioned by measurement
    they prune partitions and row groups. ``now`` is an argument so that results repeat.
    """
    if start not in LOOKBACKS:
        raise ValueError(f"start must be one of {list(LOOKBACKS)}")
    since = now - F.expr(f"INTERVAL {LOOKBACKS[start]}")
    rows = long.where(
        (F.col("measurement") == measurement)
        & F.col("field").isin(*S.OHLCV)
        & (F.col(S.TS) >= since)
    )
    if S.SYMBOL not in long.columns:
        rows = rows.withColumn(S.SYMBOL, F.lit(symbol if symbol is not None else measurement))
    return pivot_fields(rows)


def read_bar_csv(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...] = S.OHLCV,
    symbol: str | None = None,
    by_folder: bool = False,
) -> DataFrame:
    """CSV files with a ``date`` column and double columns, with an explicit schema.

    The symbol is given, a column after the date, or (``by_folder``) the name of the folder, as
    the feature sink writes it.
    """
    date, name = T.StructField("date", T.TimestampType()), T.StructField(S.SYMBOL, T.StringType())
    values = [T.StructField(c, T.DoubleType()) for c in columns]
    if by_folder:
        fields = [date, *values, name]
    else:
        fields = [date, *([name] if symbol is None else []), *values]
    raw = spark.read.csv(path, header=True, schema=T.StructType(fields), enforceSchema=False)
    key = F.col(S.SYMBOL) if symbol is None else F.lit(symbol).alias(S.SYMBOL)
    return raw.select(key, F.col("date").alias(S.TS), *[F.col(f"`{c}`") for c in columns])


def newest_artifact(spark: SparkSession, root: str, prefix: str) -> str | None:
    """Folder or file below ``<root>/data`` whose name starts with the prefix, the last by name."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/data/{prefix}*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [str(status.getPath().toString()) for status in files.globStatus(pattern) or []]
    return max(found, default=None)


def artifact_path(root: str, run_id: str, path: str) -> str:
    """Where a run keeps an artifact."""
    return f"{root.rstrip('/')}/0/{run_id}/{path}"


def read_relation(spark: SparkSession, table: str, **jdbc: str) -> DataFrame:
    """A relational table: JDBC when connection options are given, else a catalog table."""
    if jdbc:
        return spark.read.format("jdbc").options(dbtable=table, **jdbc).load()
    return spark.table(table)


def list_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """Paths below a folder; only the listing is read, never the content."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    )
    return files.select("path")
