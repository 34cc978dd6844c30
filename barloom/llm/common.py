"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: what all contracts call a word.
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(text: str = "text") -> Column:
    """The whole text; a missing one counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words, on the JVM."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


#: Bytes of an Arrow batch that are turned into Python objects at once.
PIECE_BYTES = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let the session send rows to Python in Arrow batches of about ``PIECE_BYTES`` from now on.

    Spark's default is ten thousand rows or 64 MB. A task holds a batch of whole texts outside the heap
    while it grows, as bytes to be sent and in Python, and neither process gives all of it back.
    A session that has smaller batches keeps them.
    """
    now = spark.conf.get(_BATCH_BYTES, None)
    limited = now is not None and not now.startswith("-")
    if not limited or spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) > PIECE_BYTES:
        spark.conf.set(_BATCH_BYTES, str(PIECE_BYTES))


def give_back() -> None:
    """What Arrow and the C library keep of freed memory goes back to the system: workers live on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pieces(batch: pa.RecordBatch | pa.Array) -> Iterator:
    """Consecutive slices of about ``PIECE_BYTES``; an empty batch is one."""
    rows = max(1, len(batch) * PIECE_BYTES // max(1, batch.nbytes))
    for start in range(0, max(1, len(batch)), rows):
        yield batch.slice(start, rows)


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict[str, Any]]], schema: str
) -> DataFrame:
    """Apply ``make()`` once per task and its result to every Arrow batch of the task.

    The function returns the output columns of a batch as lists or numpy arrays. It sees a batch in
    pieces of about ``PIECE_BYTES``, as Python's copies of thousands of whole texts take far more memory
    than the batch.
    """
    small_batches(df.sparkSession)
    target = T._parse_datatype_string(schema)
    names = target.fieldNames()
    arrow = _arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for piece in pieces(batch):
                out = step(piece)
                arrays = [pa.array(out[c], type=arrow.field(c).type) for c in names]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        del step
        give_back()

    return df.mapInArrow(run, target)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    kinds = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()),
        "array<double>": pa.list_(pa.float64()),
    }
    return pa.schema([pa.field(f.name, kinds[f.dataType.simpleString()]) for f in schema])


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether the row belongs to the fold that labels are never learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold


def running_total(
    df: DataFrame, series: list[str], bucket: str, order: list[str], value: str, out: str
) -> DataFrame:
    """Exact running sum of ``value`` per series, without a whole series in one task.

    ``bucket`` cuts every series into consecutive ranges of ``order``. Sums per range are added up
    on the small range table; the rows of one range are summed in one window. Rows that tie in
    ``order`` are taken in any order, so give a key that only equal rows share.
    """
    ranges = df.groupBy(*series, bucket).agg(F.sum(value).alias("__sum"))
    before = (
        Window.partitionBy(*series)
        .orderBy(bucket)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = ranges.select(
        *series, bucket, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start")
    )
    inside = (
        Window.partitionBy(*series, bucket)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        df.join(starts, [*series, bucket])
        .withColumn(out, F.col("__start") + F.sum(value).over(inside))
        .drop("__start")
    )


def look_up(
    rows: DataFrame, table: DataFrame, key: str, values: list[str], weight: str
) -> DataFrame:
    """Left join of ``rows`` with one row per key, for keys that may hold a third of all rows.

    ``weight`` is the number of rows that have the key. Fewer than a thousand keys can each have
    more than a thousandth of the rows: they are broadcast, and their rows spread over the join.
    """
    total = table.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    large = table.where(F.col(weight) > total / 1000).select(
        F.col(key), F.lit(True).alias("__found"), *[F.col(v).alias(f"__{v}") for v in values]
    )
    settled = rows.join(F.broadcast(large), key, "left")
    # A key that no row of the table has: the row's own hash, next to a mark.
    own = F.struct(F.lit(1).alias("mark"), F.xxhash64(*rows.columns).alias("spread"))
    free = F.struct(F.lit(0).alias("mark"), F.xxhash64(key).alias("spread"))
    settled = settled.withColumn("__at", F.when(F.col("__found"), own).otherwise(free))
    settled = settled.withColumn("__key", F.when(F.col("__found").isNull(), F.col(key)))
    small = table.select(
        F.struct(F.lit(0).alias("mark"), F.xxhash64(key).alias("spread")).alias("__at"),
        F.col(key).alias("__key"),
        *[F.col(v).alias(f"__small_{v}") for v in values],
    )
    joined = settled.join(small, ["__at", "__key"], "left")
    return joined.select(
        *rows.columns, *[F.coalesce(f"__{v}", f"__small_{v}").alias(v) for v in values]
    )
