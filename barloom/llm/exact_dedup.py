"""Exact duplicates through an extendible-hash index on shared files.

1. Every text gets a 64-bit hash. Counts by its leading bits give the directory: it starts with one
   bucket and doubles while a bucket is overfull and holds more than one hash.
2. Input tasks pre-aggregate equal texts (one entry for each distinct text, largest id and count),
   so a text that a third of all rows share is one entry per task, not one per row.
3. Entries go to the task that owns their bucket, a range of hash keys, sorted by hash. The owner
   chains the entries of one hash and compares their bytes: equal bytes merge, others lengthen the
   chain. Directory and index are Parquet tables in the shared folder.
4. Documents look up their group by SHA-256. Groups of over a thousandth of all rows, at most a
   thousand of them, are broadcast; all others are joined.

A null text equals an empty one; very long texts are compared byte by byte as others are. Of equal texts the row with the largest id stays; of fully
repeated rows (id and text) one stays. An empty table gives an empty result. Other columns are not
read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import give_back, look_up, pieces, small_batches, text_or_empty
from barloom.sinks.writers import written

#: Entries that a bucket should hold, and leading bits that the directory may use at most: its
#: slots are bounded whatever the input; beyond that buckets grow, and the owners' sort spills.
BUCKET_ROWS = 1_000
DIRECTORY_BITS = 20
#: Bytes of text that an input task holds for pre-aggregation.
HELD_BYTES = 32 << 20


@dataclass(frozen=True)
class Bucket:
    """Directory slots ``first <= slot < end`` at full depth, which share ``depth`` leading bits."""

    first: int
    end: int
    depth: int


def build_directory(
    counts: dict[int, tuple[int, int, int]], capacity: int, bits: int
) -> list[Bucket]:
    """Buckets after all splits, in key order.

    ``counts`` has rows, lowest hash and highest hash for each slot at full depth. A bucket splits
    while it holds more than ``capacity`` rows of more than one hash.
    """
    slots = 1 << bits
    rows, low, high = np.zeros(slots, np.int64), [None] * slots, [None] * slots
    for slot, (n, a, b) in counts.items():
        rows[slot], low[slot], high[slot] = n, a, b
    before = np.concatenate([[0], np.cumsum(rows)])
    filled = np.flatnonzero(rows)

    def one_hash(first: int, end: int) -> bool:
        inside = filled[np.searchsorted(filled, first) : np.searchsorted(filled, end)]
        return len(inside) == 0 or len(inside) == 1 and low[inside[0]] == high[inside[0]]

    done, open_ = [], [Bucket(0, slots, 0)]
    while open_:
        b = open_.pop()
        full = before[b.end] - before[b.first] > capacity
        if full and b.depth < bits and not one_hash(b.first, b.end):
            middle = (b.first + b.end) // 2
            open_ += [Bucket(middle, b.end, b.depth + 1), Bucket(b.first, middle, b.depth + 1)]
        else:
            done.append(b)
    return done


def directory_bits(rows: int, bucket_rows: int) -> int:
    """Leading bits to count by: eight slots for each bucket that the rows would fill."""
    return min(DIRECTORY_BITS, max(4, (rows // bucket_rows).bit_length() + 3))


def text_hash(text: Column) -> Column:
    """The 64-bit key of the index."""
    return F.xxhash64(text)


def _slot(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits)


def _pre_aggregate(starts: np.ndarray, bits: int):
    """Entries of one input task: equal texts merged, each with its bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows = list(held.items())
            keys = np.array([r[1][0] for r in rows], np.int64)
            slots = (keys.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
            out = pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(np.searchsorted(starts, slots, "right") - 1, pa.int32()),
                    "key": pa.array(keys, pa.int64()),
                    "text": pa.array([r[0] for r in rows], pa.string()),
                    "keep_id": pa.array([r[1][1] for r in rows], pa.int64()),
                    "group_size": pa.array([r[1][2] for r in rows], pa.int64()),
                }
            )
            held.clear()
            return out

        for batch in batches:
            rows = (row for piece in pieces(batch) for row in zip(*(c.to_pylist() for c in piece.columns)))
            for key, doc, text in rows:
                entry = held.get(text)
                if entry is None:
                    held[text] = [key, doc, 1]
                    size += len(text) + 200
                else:
                    entry[2] += 1
                    if entry[1] is None or doc is not None and doc > entry[1]:
                        entry[1] = doc
            if size > HELD_BYTES:
                yield from pieces(flush())
                size = 0
        if held:
            yield from pieces(flush())
        give_back()

    return run


def _chain_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of the buckets that one owner reads in key order."""
    now, chain, out = None, [], []

    def close() -> None:
        for place, (text, keep, n) in enumerate(chain):
            digest = hashlib.sha256(text.encode()).hexdigest()
            out.append((now[0], now[1], place, digest, keep, n))
        chain.clear()

    def flush() -> pa.RecordBatch:
        names = ("bucket", "key", "chain", "text_sha256", "keep_id", "group_size")
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        columns = zip(*out) if out else [[]] * len(names)
        batch = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)
        out.clear()
        return batch

    for batch in batches:
        rows = (row for piece in pieces(batch) for row in zip(*(c.to_pylist() for c in piece.columns)))
        for bucket, key, text, keep, n in rows:
            if now != (bucket, key):
                if now is not None:
                    close()
                now = (bucket, key)
            for entry in chain:
                if entry[0] == text:
                    entry[1] = max((x for x in (entry[1], keep) if x is not None), default=None)
                    entry[2] += n
                    break
            else:
                chain.append([text, keep, n])
        if out:
            yield flush()
    if now is not None:
        close()
    yield flush()
    give_back()


def build_index(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_rows: int = BUCKET_ROWS,
    hash_of=text_hash,
) -> tuple[DataFrame, DataFrame]:
    """Directory and index, both written to the shared folder."""
    spark = docs.sparkSession
    small_batches(spark)
    bits = directory_bits(docs.count(), bucket_rows)
    keyed = docs.select(
        hash_of(text_or_empty(text)).alias("key"),
        F.col(doc_id).cast("bigint").alias("doc_id"),
        text_or_empty(text).alias("text"),
    )
    counts = (
        keyed.groupBy(_slot(F.col("key"), bits).alias("slot"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("a"), F.max("key").alias("b"))
        .collect()  # one row for each slot of the directory at most
    )
    buckets = build_directory({r.slot: (r.n, r.a, r.b) for r in counts}, bucket_rows, bits)
    directory = written(
        spark.createDataFrame(
            [(i, b.first, b.end, b.depth) for i, b in enumerate(buckets)],
            "bucket int, first_slot bigint, end_slot bigint, depth int",
        ),
        "dedup-directory",
    )
    starts = np.array([b.first for b in buckets], np.int64)
    entries = keyed.mapInArrow(
        _pre_aggregate(starts, bits),
        "bucket int, key bigint, text string, keep_id bigint, group_size bigint",
    )
    # Without a given number, small partitions are joined and large ones kept, whatever the input.
    owned = entries.repartition("bucket").sortWithinPartitions("bucket", "key")
    index = owned.mapInArrow(
        _chain_buckets,
        "bucket int, key bigint, chain int, text_sha256 string, keep_id bigint, group_size bigint",
    )
    return directory, written(index, "dedup-index")


def exact_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_rows: int = BUCKET_ROWS,
    hash_of=text_hash,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    _, index = build_index(docs, doc_id, text, bucket_rows, hash_of)
    rows = (
        docs.select(
            F.col(doc_id).cast("bigint").alias("doc_id"),
            F.sha2(text_or_empty(text), 256).alias("text_sha256"),
        )
        .groupBy("doc_id", "text_sha256")
        .agg(F.count(F.lit(1)).alias("__copies"))
    )
    groups = index.select("text_sha256", "keep_id", "group_size")
    found = look_up(
        rows, groups.withColumn("__rows", F.col("group_size")), "text_sha256", ["keep_id", "group_size"], "__rows"
    ).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("__copy") == 1)
    return found.select("doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256")
