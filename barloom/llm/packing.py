"""Best-fit packing of documents into sequences, bulk-synchronously.

1. Tasks tokenize whole texts, append the end id and cut documents that are longer than a sequence;
   only the first piece of a cut document may be shorter than a sequence.
2. Pieces are ordered by length and numbered within a length: counts per (length, range of hashes)
   are added up on the small table of ranges, and a range is numbered on its own.
3. Lengths and gaps are whole numbers up to the capacity, so a superstep handles all pieces of one
   length at once, longest first. All of them look for their successor among the sorted gaps, the
   smallest gap that holds them; pieces that want the same gaps are served by rank, the gaps are
   updated and sorted again, and the next length follows. Pieces without a gap open new sequences.
   A superstep reads and writes runs (ranks of a length, sequences with equal gaps), whose number
   depends on the capacity and not on the number of documents.
4. Every piece finds its run in a distributed successor sweep: the last run of its length that
   starts at or before its rank gives sequence and offset.

The outcome is that of one-at-a-time best-fit decreasing. Null and empty texts have the end id
alone; very long ones are cut into pieces. Pieces of equal length, and gaps of equal size, are taken by
rank. Rows that repeat are packed each. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import map_batches, running_total, text_or_empty
from barloom.llm.token_counts import TokenIds
from barloom.sinks.writers import written

CAPACITY = 1024
END_ID = 2
#: Pieces that one window partition numbers.
RANGE_ROWS = 20_000


@dataclass(frozen=True)
class Run:
    """Pieces ``first_rank <= rank < first_rank + count`` of one length and where they go.

    ``each`` of them share a sequence: rank ``r`` goes to ``sequence + (r - first_rank) // each``,
    at ``offset`` plus its place there times the length.
    """

    length: int
    first_rank: int
    count: int
    sequence: int
    each: int
    offset: int


def pack_lengths(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Runs of all pieces and the number of sequences; ``counts`` has the pieces of each length."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # free space: (first sequence, sequences)
    sizes: list[int] = []  # free spaces that some sequence has, sorted
    runs: list[Run] = []
    opened = 0

    def add(free: int, first: int, n: int) -> None:
        if n and free:
            if free not in gaps:
                gaps[free] = []
                bisect.insort(sizes, free)
            gaps[free].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        at = bisect.bisect_left(sizes, length)
        wanted = sizes[at:]
        for free in wanted:
            if not left:
                break
            each = free // length
            waiting = gaps.pop(free)
            sizes.remove(free)
            while waiting:
                first, n = waiting.pop()
                if not left:
                    add(free, first, n)
                    continue
                full = min(n, left // each)
                if full:
                    runs.append(Run(length, rank, full * each, first, each, capacity - free))
                    add(free - each * length, first, full)
                    rank, left = rank + full * each, left - full * each
                if full < n and left:  # fewer pieces than one sequence takes
                    runs.append(Run(length, rank, left, first + full, left, capacity - free))
                    add(free - left * length, first + full, 1)
                    rank, left, full = rank + left, 0, full + 1
                add(free, first + full, n - full)
        if left:
            each = capacity // length
            full, rest = divmod(left, each)
            if full:
                runs.append(Run(length, rank, full * each, opened, each, 0))
                add(capacity - each * length, opened, full)
            if rest:
                runs.append(Run(length, rank + full * each, rest, opened + full, rest, 0))
                add(capacity - rest * length, opened + full, 1)
            opened += full + (rest > 0)
    return runs, opened


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of one document."""
    total = len(ids)
    first = total % capacity or capacity
    starts = [0, *range(first, total, capacity)]
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], total])]


def pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, doc_id: str, text: str
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece."""

    def make():
        tokenizer = TokenIds(tokenizer_path)

        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(tokenizer.encode(value.as_py()), end_id).astype("<u4")
                for i, (start, length) in enumerate(cut(ids, capacity)):
                    out["doc_id"].append(doc)
                    out["piece"].append(i)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(ids[start : start + length].tobytes()))
            return out

        return step

    whole = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text")
    )
    return map_batches(
        whole, make, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    cut_up = written(pieces(docs, tokenizer_path, capacity, end_id, doc_id, text), "pack-pieces")
    ranges = max(1, -(-cut_up.count() // range_rows))
    hashed = cut_up.withColumn(
        "range", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(ranges))
    ).withColumn("one", F.lit(1).cast("bigint"))
    ranked = running_total(
        hashed, ["length"], "range", ["doc_id", "piece", "ids_crc32"], "one", "rank"
    ).drop("range", "one")

    # One row for each length up to the capacity.
    counts = {r.length: r["count"] for r in cut_up.groupBy("length").count().collect()}
    runs, _ = pack_lengths(counts, capacity)
    runs.sort(key=lambda r: (r.length, r.first_rank))
    table = {
        name: np.array([getattr(r, name) for r in runs], np.int64)
        for name in ("length", "first_rank", "sequence", "each", "offset")
    }
    start_of = np.searchsorted(table["length"], np.arange(capacity + 2))

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            length = columns["length"].to_numpy(zero_copy_only=False)
            rank = columns.pop("rank").to_numpy(zero_copy_only=False) - 1
            run = np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                here = length == one
                first, end = start_of[one], start_of[one + 1]
                starts = table["first_rank"][first:end]
                run[here] = first + np.searchsorted(starts, rank[here], "right") - 1
            place = rank - table["first_rank"][run]
            columns["sequence_id"] = table["sequence"][run] + place // table["each"][run]
            columns["offset"] = table["offset"][run] + place % table["each"][run] * length
            return columns

        return step

    return map_batches(
        ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank"),
        make,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint,"
        " sequence_id bigint, offset bigint",
    )
