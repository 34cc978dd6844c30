"""Exact removal of long repeated byte strings, by suffix arrays over shards of like content.

A byte goes when a string of ``LEAST`` bytes that covers it starts anywhere else in the corpus.

* Sharding by content. A window is a string of ``LEAST`` bytes; its key is the least hash of its
  grams (strings of ``GRAMS[0]`` bytes). Equal windows have equal keys wherever they stand.
  Neighbouring windows with one key form a segment, about 140 windows on average.
* Keys are aggregated with counts and extremes of the segments' 128-bit digests. A key that only one
  segment has is settled (unless its gram occurs twice in the segment). If all segments of a key are
  equal, every window in them is repeated. Only what is left, different segments under one key, is
  compared by its bytes, one copy of every distinct segment.
* Comparison. A task concatenates the segments of whole keys, with end marks, and sorts their
  suffixes to ``LEAST`` bytes. From the Burrows-Wheeler transform, threshold-bounded interval
  expansion derives the common prefixes of neighbouring suffixes by increasing value: starting with
  the interval of the empty string, every interval of a string ``w`` gives those of all ``cw``, breadth
  first, through ranks in a wavelet tree; an interval of length ``l + 1`` whose end has no value yet
  sets it to ``l`` and is expanded further. The expansion stops at ``LEAST``: neighbours without a
  value share at least that many bytes, and both windows are repeated.
* A key with more than ``GROUP_BYTES`` of different segments (a line or template that a large share of
  the corpus holds) never meets in one task: its segments are cut anew by the least hash of the next
  longer grams in ``GRAMS``, down to single windows, which are equal or not.

Texts are known by their 128-bit digest. Copies that a task meets again are left out there; a text
with several copies is removed whole if it has a window at all. Documents without repeats, and those
without any byte left, need no second look at their text; the texts of the others are joined once.

Null counts as empty. Texts shorter than ``LEAST`` bytes stay whole. Very long texts are many segments.
Rows that repeat whole or share a text are all removed, as every string in them starts in another
row too. Bytes are judged on the input; ties do not arise. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import look_up, map_batches, text_or_empty
from barloom.llm.runs import WaveletTree
from barloom.sinks.writers import written

LEAST = 400
#: Bytes of the grams that give keys; the next ones cut groups that are too large for a task.
GRAMS = (128, 256)
#: Bytes of different segments that may meet under one key in one task.
GROUP_BYTES = 2_000_000
#: Bytes of whole groups that are sorted together.
CHUNK_BYTES = 1_000_000
#: Texts of which a task remembers that their segments are out already.
REMEMBERED = 200_000

_END = 255  # never a byte of UTF-8
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_RANGES = "array<struct<low:bigint,high:bigint>>"


def _symbols() -> np.ndarray:
    """A random odd number for every byte value."""
    return np.random.RandomState(7).randint(0, 2**62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


class Segmenter:
    """Cuts texts into segments: stretches of windows that share their key."""

    def __init__(self, gram: int, least: int = LEAST):
        self.gram, self.least = gram, least
        self.symbols = _symbols()
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, size: int) -> None:
        if size > len(self.power):
            size = max(size, 2 * len(self.power))
            inverse = pow(_BASE, -1, 2**64)
            self.power, self.inverse = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)]), dtype=np.uint64)
                for b in (_BASE, inverse)
            )

    def grams(self, data: bytes) -> np.ndarray:
        """Hash of the gram at every place: prefix sums of a polynomial, mixed."""
        size = len(data)
        self._powers(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(self.symbols[np.frombuffer(data, np.uint8)] * self.power[:size], out=sums[1:])
        x = (sums[self.gram :] - sums[: -self.gram]) * self.inverse[: size - self.gram + 1]
        x = (x ^ (x >> np.uint64(32))) * _MIX
        return x ^ (x >> np.uint64(29))

    def cut(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys, first windows, ends of windows (exclusive), and whether a key's gram is there twice."""
        if len(data) < self.least:
            none = np.zeros(0, np.int64)
            return none.view(np.uint64), none, none, none.astype(bool)
        x = self.grams(data)
        width = self.least - self.gram + 1
        key = _sliding(np.minimum, x, width)
        low = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        high = np.append(low[1:], len(key))
        keys = key[low]
        twice = np.zeros(len(low), bool)
        # A place gives a key when the largest key of the windows around it is its own hash.
        around = np.concatenate([np.zeros(width - 1, np.uint64), key, np.zeros(width - 1, np.uint64)])
        places = np.flatnonzero(_sliding(np.maximum, around, width) == x)
        if len(places) > len(low):
            first = np.maximum(places - width + 1, 0)
            at = np.searchsorted(low, first, side="right") - 1
            while True:  # the windows before may have a smaller key
                other = keys[at] != x[places]
                if not other.any():
                    break
                at[other] += 1
            count = np.bincount(at, minlength=len(low))
            twice = count > 1
        return keys, low, high, twice


def _sliding(of: Callable, x: np.ndarray, width: int) -> np.ndarray:
    """Least or largest value of every stretch of ``width`` values, by doubling."""
    span, size = 1, len(x) - width + 1
    while 2 * span <= width:
        x = of(x[:-span], x[span:])
        span *= 2
    return of(x[:size], x[width - span : width - span + size]) if span < width else x[:size]


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` in order of the ``depth`` bytes from them on (end marks at the end)."""
    total = len(text)
    padded = np.concatenate([text, np.full(depth + 8, _END, np.uint8)])
    eight = np.zeros(total, np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k : k + total]
    order = np.argsort(eight)
    ordered = eight[order]
    slots, placed, length = np.arange(total), order, 8
    rank = np.full(total + depth, total, np.int64)  # beyond the end: one range of its own
    while True:
        fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        first = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        rank[placed] = slots[first][group]
        open_ = np.diff(np.append(first, len(slots)))[group] > 1
        slots, placed = slots[open_], placed[open_]
        if length >= depth or not len(slots):
            return order
        step = min(length, depth - length)
        key = rank[placed] * (total + 1) + rank[placed + step]
        by = np.argsort(key)
        placed, ordered = placed[by], key[by]
        order[slots] = placed
        length += step


def common_prefixes(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Common prefix of every suffix with the one before it in order, or ``least`` if not shorter.

    Prefixes do not reach over end marks; what stands beside a suffix that meets one before ``least``
    may stay unset and is not to be read.
    """
    total = len(text)
    last = text[order - 1]  # the Burrows-Wheeler transform, cyclic
    values = np.unique(text)
    code = np.zeros(256, np.int64)
    code[values] = np.arange(len(values))
    tree = WaveletTree(code[last])
    counts = np.bincount(code[text], minlength=len(values))
    starts = np.cumsum(counts) - counts
    bottom = _bottom(len(values), tree.bits, counts)
    shift = starts - bottom
    prefix = np.full(total + 1, -1, np.int32)
    prefix[0] = prefix[total] = 0
    end_code = int(code[_END]) if values[-1] == _END else -1
    low, high = np.zeros(1, np.int64), np.full(1, total, np.int64)
    for length in range(least):
        found_low, found_high, symbol = _children(tree, low, high)
        if end_code >= 0:
            inner = symbol != end_code
            if length == 0:
                prefix[starts[end_code]] = 0
            found_low, found_high, symbol = found_low[inner], found_high[inner], symbol[inner]
        low, high = found_low + shift[symbol], found_high + shift[symbol]
        unset = prefix[high] < 0
        if length == 0:
            unset = np.ones(len(high), bool)  # the last interval ends where the array does
        prefix[high[unset]] = length
        low, high = low[unset], high[unset]
        if not len(low):
            break
    prefix[prefix < 0] = least
    return prefix[:total]


def _bottom(size: int, bits: int, counts: np.ndarray) -> np.ndarray:
    """Where the occurrences of every symbol start below the tree's last level."""
    reverse = np.array([int(f"{c:0{bits}b}"[::-1], 2) for c in range(size)], np.int64)
    by = np.argsort(reverse)
    out = np.zeros(size, np.int64)
    out[by] = np.cumsum(counts[by]) - counts[by]
    return out


def _children(
    tree: WaveletTree, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges below the tree and symbols of all that occur in the intervals."""
    symbol = np.zeros(len(low), np.int64)
    for zeros in tree.zeros:
        z_low, z_high, total = zeros[low].astype(np.int64), zeros[high].astype(np.int64), int(zeros[-1])
        o_low, o_high = total + low - z_low, total + high - z_high
        zero, one = z_high > z_low, o_high > o_low
        low = np.concatenate([z_low[zero], o_low[one]])
        high = np.concatenate([z_high[zero], o_high[one]])
        symbol = np.concatenate([symbol[zero] * 2, symbol[one] * 2 + 1])
    return low, high, symbol


def repeated_windows(segments: list[bytes], least: int = LEAST) -> list[np.ndarray]:
    """Starts in every segment of windows that occur again, in it or in another one."""
    lengths = np.array([len(s) for s in segments], np.int64)
    text = np.frombuffer(b"".join(s + b"\xff" for s in segments), np.uint8)
    order = sorted_suffixes(text, least)
    prefix = common_prefixes(text, order, least)
    ends = np.cumsum(lengths + 1)
    starts = ends - lengths - 1
    owner = np.repeat(np.arange(len(segments)), lengths + 1)
    whole = (ends[owner] - 1 - np.arange(len(text)) >= least)[order]
    pair = np.zeros(len(text) + 1, bool)
    pair[1:-1] = (prefix[1:] >= least) & whole[1:] & whole[:-1]
    places = np.sort(order[pair[:-1] | pair[1:]])
    cuts = np.searchsorted(places, starts)
    return [p - s for p, s in zip(np.split(places, cuts[1:]), starts.tolist())]


def ranges_of(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of consecutive places, as firsts and ends (exclusive)."""
    if not len(places):
        return places, places
    breaks = np.flatnonzero(np.diff(places) > 1)
    return places[np.append(0, breaks + 1)], places[np.append(breaks, len(places) - 1)] + 1


def removed_spans(low: np.ndarray, high: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the windows starting in the ranges cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(low, high)):
        end = b - 1 + least
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((a, end))
    return out


def _digests(pieces: Iterator[bytes]) -> tuple[list[int], list[int]]:
    one, two = [], []
    for piece in pieces:
        value = xxhash.xxh3_128_intdigest(piece)
        one.append((value >> 64) - 2**63)
        two.append((value & (2**64 - 1)) - 2**63)
    return one, two


_SEGMENTS = "key array<bigint>, one array<bigint>, two array<bigint>, low array<bigint>, high array<bigint>, twice array<int>"


def _cut_columns(cut: Segmenter, data: bytes) -> tuple:
    """Values of the columns in ``_SEGMENTS`` for one text."""
    keys, low, high, twice = cut.cut(data)
    view, least = memoryview(data), cut.least
    lows, highs = low.tolist(), high.tolist()
    if cut.gram == least:  # a segment is one window, maybe several times in a row
        one, two = _digests(view[a : a + least] for a in lows)
    else:
        one, two = _digests(view[a : b - 1 + least] for a, b in zip(lows, highs))
    return keys.view(np.int64), one, two, low, high, twice.astype(np.int32)


def signatures(docs: DataFrame, doc_id: str, text: str, least: int, gram: int) -> DataFrame:
    """``doc_id, t, n_bytes, sha256`` of every row, and its segments unless the task met the text before."""

    def make():
        cut, met = Segmenter(gram, least), set()
        nothing = (None,) * 6

        def step(batch: pa.RecordBatch) -> dict:
            t, size, sha, found = [], [], [], []
            for value in batch.column(1).to_pylist():
                data = value.encode()
                name = xxhash.xxh3_128_digest(data)
                t.append(name)
                size.append(len(data))
                sha.append(hashlib.sha256(data).hexdigest())
                if name in met or len(data) < least:
                    found.append(nothing)
                    continue
                if len(met) >= REMEMBERED:
                    met.clear()
                met.add(name)
                found.append(_cut_columns(cut, data))
            columns = zip(("key", "one", "two", "low", "high", "twice"), zip(*found) if found else [[]] * 6)
            return {"doc_id": batch.column(0), "t": t, "n_bytes": size, "sha256": sha} | dict(columns)

        return step

    whole = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return map_batches(whole, make, f"doc_id bigint, t binary, n_bytes bigint, sha256 string, {_SEGMENTS}")


def _exploded(signed: DataFrame, owner: str) -> DataFrame:
    """One row per segment."""
    names = ("key", "one", "two", "low", "high", "twice")
    zipped = F.explode(F.arrays_zip(*names)).alias("s")
    return signed.where("key IS NOT NULL").select(owner, zipped).select(owner, *[f"s.{c}" for c in names])


def _shared_keys(segments: DataFrame) -> DataFrame:
    """``key, equal`` of keys that may hold repeats; ``equal``: all their segments are alike."""
    ends = [f(c).alias(f"{c}_{n}") for c in ("one", "two") for n, f in (("min", F.min), ("max", F.max))]
    keys = segments.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.max("twice").alias("twice"), *ends)
    alike = (F.col("one_min") == F.col("one_max")) & (F.col("two_min") == F.col("two_max"))
    return keys.where("rows > 1 OR twice > 0").select("key", (alike & (F.col("rows") > 1)).alias("equal"))


@dataclass(frozen=True)
class _Level:
    """Segments that share their key with others, and what is known about them."""

    live: DataFrame  # owner, low, high, one, two, key, equal
    distinct: DataFrame  # one, two, key, owner, low, high, copies: one row per content of unequal keys


def _compare(segments: DataFrame, owner: str, last: bool) -> _Level:
    if last:  # a segment is one window, so equal digests are all there is to find
        window = ["key", "one", "two"]
        shared = segments.groupBy(*window).agg(F.count(F.lit(1)).alias("rows"), F.max("twice").alias("twice"))
        shared = shared.where("rows > 1 OR twice > 0").select(*window, F.lit(True).alias("equal"))
        live = segments.join(shared, window)
    else:
        live = segments.join(_shared_keys(segments), "key")
    live = written(live, "repeats-live")
    first = F.min(F.struct(owner, "low", "high")).alias("first")
    distinct = live.where("NOT equal").groupBy("one", "two", "key").agg(first, F.count(F.lit(1)).alias("copies"))
    return _Level(live, written(distinct.select("one", "two", "key", "copies", "first.*"), "repeats-distinct"))


def _searched(contents: DataFrame, least: int) -> DataFrame:
    """``one, two, ranges`` of contents (``key, one, two, bytes``) that hold repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("one", pa.int64()), ("two", pa.int64()), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64()))]
        )

        def flushed(rows: list[tuple]) -> pa.RecordBatch:
            found = repeated_windows([r[3] for r in rows], least) if rows else []
            kept = [(r[1], r[2], *ranges_of(p)) for r, p in zip(rows, found) if len(p)]
            columns = list(zip(*kept)) if kept else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        waiting: list[tuple] = []
        size, key = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > CHUNK_BYTES and row[0] != key:
                    yield flushed(waiting)
                    waiting, size = [], 0
                key = row[0]
                waiting.append(row)
                size += len(row[3])
        yield flushed(waiting)

    sorted_ = contents.select("key", "one", "two", "bytes").repartition("key").sortWithinPartitions("key")
    found = sorted_.mapInArrow(run, "one bigint, two bigint, low array<bigint>, high array<bigint>")
    return found.select("one", "two", F.arrays_zip("low", "high").cast(_RANGES).alias("ranges"))


def _owner_ranges(level: _Level, contents: DataFrame, owner: str) -> DataFrame:
    """``owner, ranges``: repeated windows of every owner that has any."""
    whole = level.live.where("equal").select(owner, F.array(F.struct("low", "high")).cast(_RANGES).alias("ranges"))
    partly = level.live.where("NOT equal").select(
        owner, "low", "high", F.struct("one", "two").alias("content")
    )
    named = contents.select(F.struct("one", "two").alias("content"), "ranges", "copies")
    found = look_up(partly, named, "content", ["ranges"], "copies").where("ranges IS NOT NULL")
    shifted = F.transform(
        "ranges", lambda r: F.struct((r.low + F.col("low")).alias("low"), (r.high + F.col("low")).alias("high"))
    )
    ranges = whole.unionByName(found.select(owner, shifted.cast(_RANGES).alias("ranges")))
    merged = F.array_distinct(F.flatten(F.collect_set("ranges")))
    return ranges.groupBy(owner).agg(merged.alias("ranges"))


def _cut_again(contents: DataFrame, least: int, gram: int) -> DataFrame:
    """Segments of the contents by longer grams; a content is its own owner."""

    def make():
        cut = Segmenter(gram, least)

        def step(batch: pa.RecordBatch) -> dict:
            found = [_cut_columns(cut, data) for data in batch.column(1).to_pylist()]
            names = ("key", "one", "two", "low", "high", "twice")
            return {"id": batch.column(0)} | dict(zip(names, zip(*found) if found else [[]] * 6))

        return step

    ids = contents.select("id", "bytes")
    return map_batches(ids, make, f"id string, {_SEGMENTS}")


def _repeated_contents(
    level: _Level, contents: DataFrame, least: int, grams: tuple[int, ...], group_bytes: int
) -> DataFrame:
    """``one, two, copies, ranges`` of contents (with ``bytes``) that hold repeated windows.

    A content with copies is repeated whole; it is compared all the same, for what others share with it.
    """
    sized = contents.withColumn("size", F.col("high") - F.col("low") + least - 1)
    groups = sized.groupBy("key").agg(F.sum("size").alias("group"))
    large = written(groups.where(F.col("group") > group_bytes), "repeats-large")
    if large.isEmpty():
        found = _searched(sized, least)
    else:
        found = _searched(sized.join(large, "key", "left_anti"), least).unionByName(
            _repeated_by_longer_grams(sized.join(large, "key", "left_semi"), least, grams, group_bytes)
        )
    whole = F.array(F.struct(F.lit(0).alias("low"), (F.col("high") - F.col("low")).alias("high"))).cast(_RANGES)
    copied = level.distinct.where("copies > 1").select("one", "two", "copies", whole.alias("ranges"))
    single = level.distinct.where("copies = 1").select("one", "two", "copies")
    return found.join(single, ["one", "two"]).select("one", "two", "copies", "ranges").unionByName(copied)


def _repeated_by_longer_grams(
    contents: DataFrame, least: int, grams: tuple[int, ...], group_bytes: int
) -> DataFrame:
    """``one, two, ranges`` of the contents of groups that are too large for one task."""
    name = F.concat(F.hex("one"), F.lit("-"), F.hex("two")).alias("id")
    again = written(contents.select("one", "two", "bytes", name), "repeats-again")
    gram, rest = (grams[0], grams[1:]) if grams else (least, ())
    cut = written(_cut_again(again, least, gram), "repeats-cut")
    level = _compare(_exploded(cut, "id"), "id", last=gram == least)
    if gram == least:
        inner = _no_contents(level)
    else:
        parts = level.distinct.join(again.select("id", "bytes"), "id")
        parts = parts.withColumn("bytes", _piece("low", "high", least))
        inner = _repeated_contents(level, written(parts, "repeats-parts"), least, rest, group_bytes)
    owners = _owner_ranges(level, written(inner, "repeats-contents"), "id")
    return again.join(owners, "id").select("one", "two", "ranges")


def _piece(low: str, high: str, least: int) -> Column:
    """The bytes of the windows from ``low`` to ``high`` (exclusive)."""
    return F.expr(f"substring(bytes, int({low}) + 1, int({high} - {low}) + {least - 1})")


def _no_contents(level: _Level) -> DataFrame:
    empty = level.distinct.where("false")
    return empty.select("one", "two", "copies", F.array().cast(_RANGES).alias("ranges"))


def _with_texts(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``wanted`` (one row per text digest ``t``) with the texts' bytes."""

    def make():
        met: set[bytes] = set()

        def step(batch: pa.RecordBatch) -> dict:
            t, out = [], []
            for value in batch.column(0).to_pylist():
                data = value.encode()
                name = xxhash.xxh3_128_digest(data)
                if name not in met:
                    if len(met) >= REMEMBERED:
                        met.clear()
                    met.add(name)
                    t.append(name)
                    out.append(data)
            return {"t": t, "bytes": out}

        return step

    texts = map_batches(docs.select(text_or_empty(text).alias("text")), make, "t binary, bytes binary")
    return texts.join(wanted, "t")


def repeated_ranges(
    docs: DataFrame,
    least: int = LEAST,
    doc_id: str = "doc_id",
    text: str = "text",
    grams: tuple[int, ...] = GRAMS,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Removed bytes of every row: ``doc_id, t, n_bytes, sha256, kept_sha256, spans``.

    ``spans`` are the maximal removed runs of bytes; ``kept_sha256`` is the digest of what is left,
    ``sha256`` that of the whole text.
    """
    signed = written(signatures(docs, doc_id, text, least, grams[0]), "repeats-signatures")
    level = _compare(_exploded(signed, "t"), "t", last=grams[0] == least)

    copies = signed.groupBy("t").agg(F.count(F.lit(1)).alias("copies"), F.max("n_bytes").alias("n_bytes"))
    several = written(copies.where(f"copies > 1 AND n_bytes >= {least}"), "repeats-copies")

    # Texts that some repeat may touch, each once, with the segments that are to be compared.
    parts = level.distinct.groupBy("t").agg(F.collect_list(F.struct("one", "two", "key", "low", "high")).alias("parts"))
    touched = level.live.select("t").distinct().join(parts, "t", "left")
    texts = written(_with_texts(docs, written(touched, "repeats-touched"), doc_id, text).dropDuplicates(["t"]), "repeats-texts")
    contents = (
        texts.where("parts IS NOT NULL")
        .withColumn("part", F.explode("parts"))
        .select("part.*", _piece("part.low", "part.high", least).alias("bytes"))
    )
    found = _repeated_contents(level, contents, least, grams[1:], group_bytes)
    ranges = _owner_ranges(level, written(found, "repeats-contents"), "t")
    ranges = ranges.join(several.select("t"), "t", "left_anti")

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            out = {"t": batch.column(0), "kept_sha256": [], "low": [], "high": []}
            for data, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans = removed_spans([r["low"] for r in found], [r["high"] for r in found], least)
                kept, at = hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                out["kept_sha256"].append(kept.hexdigest())
                out["low"].append([a for a, _ in spans])
                out["high"].append([b for _, b in spans])
            return out

        return step

    partly = map_batches(
        texts.select("t", "bytes").join(ranges, "t"),
        make,
        "t binary, kept_sha256 string, low array<bigint>, high array<bigint>",
    ).select("t", "kept_sha256", F.arrays_zip("low", "high").cast(_RANGES).alias("spans"), F.lit(1).cast("bigint").alias("copies"))
    entirely = several.select(
        "t", F.sha2(F.lit(""), 256).alias("kept_sha256"),
        F.array(F.struct(F.lit(0).alias("low"), F.col("n_bytes").alias("high"))).cast(_RANGES).alias("spans"),
        "copies",
    )
    verdicts = written(partly.unionByName(entirely), "repeats-verdicts")
    rows = signed.select("doc_id", "t", "n_bytes", "sha256")
    judged = look_up(rows, verdicts, "t", ["kept_sha256", "spans"], "copies")
    return judged.withColumns(
        {
            "kept_sha256": F.coalesce("kept_sha256", "sha256"),
            "spans": F.coalesce("spans", F.array().cast(_RANGES)),
        }
    )


def span_counts(judged: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x.high - x.low)
    return judged.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256"
    )
