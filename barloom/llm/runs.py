"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends, of at
least ``LEAST`` words and ``TIMES`` periods. Such a run of period ``2^k <= q < 2^(k+1)`` holds a
block of ``2^k`` words that starts at a multiple of ``2^k`` and occurs again ``q`` words later,
still inside the run. So every dyadic block asks for its occurrences in the window after it:

* A suffix array over the words of a chunk of documents, sorted by document first, is built by
  doubling. The names of all stretches of ``2^k`` words on the way are kept: the name of a block is
  the start of its range in the array, and comparing names level by level gives the length of the
  common extension of two places, forwards and backwards.
* A wavelet tree over the array (places within the document) answers range successor: how many
  occurrences lie before a place, and which is the next one.
* Three or more occurrences in a window form a progression whose difference is the block's own
  period. Only its first two members and the shifts that align the ends of the two periodic
  stretches around the block and around the progression can be periods of a run.
* A candidate period is extended in both directions; of candidates with one extent the smallest
  period is the run's. Blocks of the first level also find the shorter periods.

A run repeats two thirds of its words, at least ``LEAST * 2 / 3`` in a row, within the document.
Documents in which no stretch of that length occurs twice (by hash, so a chance match only costs
time) have no run and skip the search.

Documents are independent of each other: no shuffle, and a task holds a chunk of ``CHUNK_WORDS``
words or one longer document. Words are runs of non-space characters. Null and empty texts have no
words and no run. Rows that share an id or repeat whole are judged row by row; ties between runs go
to the smaller start, then the smaller period. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import map_batches, text_or_empty

LEAST = 24
TIMES = 3
#: Words of the documents that are searched together.
CHUNK_WORDS = 400_000

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]
_MIX, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)


class Suffixes:
    """Sorted suffixes of several documents, names of their dyadic stretches, and a wavelet tree.

    ``words`` holds the documents' word numbers, each followed by an end mark of its own; ``doc``
    is the document of every place, ``offset`` the place where that document starts.
    """

    def __init__(self, words: np.ndarray, doc: np.ndarray, offset: np.ndarray):
        self.order, self.names = _sorted_suffixes(doc * (int(words.max()) + 1) + words)
        self.tree = WaveletTree(self.order - offset[self.order])

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from ``i`` and ``j`` (different places) on."""
        at = i.copy()
        shift = j - i
        for k in range(len(self.names) - 1, -1, -1):
            name = self.names[k]
            at += (name[at] == name[at + shift]).astype(np.int64) << k
        return at - i

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree just before ``i`` and ``j`` (``i < j``)."""
        at = i.copy()
        shift = j - i
        for k in range(len(self.names) - 1, -1, -1):
            name, before = self.names[k], at - (1 << k)
            held = np.maximum(before, 0)
            at -= ((before >= 0) & (name[held] == name[held + shift])).astype(np.int64) << k
        return i - at


def _sorted_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array by doubling, and per level the name of the stretch at every place.

    A name is the first position of the stretch's range in the array. Suffixes that are alone in
    their range are settled and leave the sort.
    """
    total = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    slots = np.arange(total)
    name = np.empty(total, np.int64)
    names: list[np.ndarray] = []
    placed, length = order, 1
    while True:
        fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        first = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        name[placed] = slots[first][group]
        names.append(name.astype(np.int32))
        sizes = np.diff(np.append(first, len(slots)))
        open_ = sizes[group] > 1
        slots, placed = slots[open_], placed[open_]
        if not len(slots):
            return order, names
        key = name[placed] * total + name[placed + length]
        by = np.argsort(key)
        placed, ordered = placed[by], key[by]
        order[slots] = placed
        length *= 2


class WaveletTree:
    """Counts and order statistics of the values in ranges of an array, for many queries at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero)]).astype(np.int32))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values of ``[low, high)`` are smaller than ``value``."""
        every = value >> self.bits > 0
        found = np.where(every, high - low, 0)
        low, high = low.copy(), np.where(every, low, high)
        for level, zeros in enumerate(self.zeros):
            one = (value >> (self.bits - 1 - level)) & 1 == 1
            z_low, z_high, total = zeros[low], zeros[high], zeros[-1]
            found = found + np.where(one, z_high - z_low, 0)
            low = np.where(one, total + low - z_low, z_low)
            high = np.where(one, total + high - z_high, z_high)
        return found

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The value at place ``n`` (from 0) of the sorted range; together with ``below``: successor."""
        value = np.zeros(len(low), np.int64)
        for level, zeros in enumerate(self.zeros):
            z_low, z_high, total = zeros[low], zeros[high], zeros[-1]
            one = n >= z_high - z_low
            n = np.where(one, n - (z_high - z_low), n)
            low = np.where(one, total + low - z_low, z_low)
            high = np.where(one, total + high - z_high, z_high)
            value |= one.astype(np.int64) << (self.bits - 1 - level)
        return value


def _candidates(
    index: Suffixes, starts: np.ndarray, lengths: np.ndarray, least: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and candidate periods, level by level."""
    first = (least // 3).bit_length() - 1
    for k in range(first, len(index.names)):
        m, name = 1 << k, index.names[k]
        blocks = lengths // m
        if not blocks.any():
            return
        number = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        base = np.repeat(starts, blocks)
        at = number * m
        size = np.bincount(name, minlength=len(name))
        low = name[base + at].astype(np.int64)
        several = size[low] > 1
        base, at, low = base[several], at[several], low[several]
        high = low + size[low]
        near = 1 if k == first else m
        before = index.tree.below(low, high, at + near)
        inside = index.tree.below(low, high, at + 2 * m) - before
        for n in range(2 * m if k == first else 2):
            some = inside > n
            if not some.any():
                break
            base, at, low, high, before, inside = (
                x[some] for x in (base, at, low, high, before, inside)
            )
            place = index.tree.nth(low, high, before + n)
            yield base + at, place - at
            if k > first and n == 0:
                one = place
        if k > first and (inside > 2).any():
            many = inside > 2
            here = (base + at)[many]
            there = (base + one[some])[many]
            step = (place - one[some])[many]
            left = (there - index.backward(there, there + step)) - (here - index.backward(here, here + step))
            right = (there + index.forward(there, there + step)) - (here + index.forward(here, here + step))
            for period in (left, right):
                fits = (period >= m) & (period < 2 * m)
                yield here[fits], period[fits]


def runs_of(
    documents: list[np.ndarray], least: int = LEAST, times: int = TIMES
) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of all runs of every document, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    lengths = np.array([len(d) for d in documents], np.int64)
    if not lengths.sum():
        return out
    starts = np.cumsum(lengths + 1) - lengths - 1
    end = 1 + max(int(d.max()) for d in documents if len(d))
    words = np.concatenate([np.append(d, end) for d in documents])
    doc = np.repeat(np.arange(len(documents)), lengths + 1)
    index = Suffixes(words, doc, starts[doc])
    found = list(_candidates(index, starts, lengths, least))
    if not found:
        return out
    at, period = (np.concatenate(x).astype(np.int64) for x in zip(*found))
    low = at - index.backward(at, at + period)
    high = at + period + index.forward(at, at + period)
    good = high - low >= np.maximum(least, times * period)
    low, high, period = low[good], high[good], period[good]
    by = np.lexsort((period, high, low))
    low, high, period = low[by], high[by], period[by]
    fresh = np.ones(len(low), bool)
    fresh[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    low, high, period = low[fresh], high[fresh], period[fresh]
    by = np.lexsort((period, low))
    for s, e, q in zip(low[by].tolist(), high[by].tolist(), period[by].tolist()):
        d = int(doc[s])
        out[d].append((s - int(starts[d]), e - s, q))
    return out


def may_have_runs(documents: list[np.ndarray], width: int) -> np.ndarray:
    """Whether some stretch of ``width`` words occurs twice in a document, by hash."""
    lengths = np.array([len(d) for d in documents], np.int64)
    doc = np.repeat(np.arange(len(documents)), lengths)
    out = np.zeros(len(documents), bool)
    x = np.concatenate(documents).astype(np.uint64) if len(doc) else np.zeros(0, np.uint64)
    if len(x) <= width:
        return out
    x = (x + np.uint64(1)) * _STEP
    part, whole, done = x, None, 0
    span, rest = 1, width
    while rest:
        if rest & 1:
            whole = part if whole is None else _joined(whole, part[done:], done)
            done += span
        rest >>= 1
        if rest:
            part, span = _joined(part, part[span:], span), span * 2
    inside = np.arange(len(whole)) + width <= np.repeat(np.cumsum(lengths), lengths)[: len(whole)]
    key = _spread(whole[inside] + doc[: len(whole)][inside].astype(np.uint64) * _MIX)
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(twice):
        place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        out[doc[: len(whole)][inside][twice[place] == key]] = True
    return out


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _joined(left: np.ndarray, right: np.ndarray, span: int) -> np.ndarray:
    """Hashes of stretches from those of their first ``span`` words and of the rest."""
    size = min(len(left), len(right))
    return _spread(left[:size] * np.uint64(2 * span + 0x9E3779B1) + right[:size])


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    kept = np.cumsum(drop[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


def find_runs(
    docs: DataFrame,
    least: int = LEAST,
    times: int = TIMES,
    rewrite: Rewrite | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """``doc_id, n_words, start, length, period, collapsed`` of every row.

    The three arrays list the runs by start, then period; ``collapsed`` is the text without the
    repetitions, its words joined by one space. ``rewrite`` may replace a document's words first.
    """
    if times < 3 or least < times:
        raise ValueError("runs have at least three periods")

    def make():
        def searched(ids: list, words: list[list[bytes]]) -> Iterator[tuple]:
            number: dict[bytes, int] = defaultdict(count().__next__)
            coded = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words]
            runs: list[list] = [[] for _ in words]
            maybe = np.flatnonzero(may_have_runs(coded, least - least // 3)).tolist()
            for d, found in zip(maybe, runs_of([coded[d] for d in maybe], least, times)):
                runs[d] = found
            for i, w, r in zip(ids, words, runs):
                yield i, len(w), r, b" ".join(collapsed(w, r)).decode()

        def step(batch: pa.RecordBatch) -> dict:
            rows: list[tuple] = []
            ids, words, total = [], [], 0
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                split = value.encode().split()
                split = rewrite(i, split) if rewrite else split
                if total and total + len(split) > chunk_words:
                    rows.extend(searched(ids, words))
                    ids, words, total = [], [], 0
                ids.append(i)
                words.append(split)
                total += len(split)
            rows.extend(searched(ids, words))
            columns = {"doc_id": [r[0] for r in rows], "n_words": [r[1] for r in rows]}
            for k, name in enumerate(("start", "length", "period")):
                columns[name] = [[x[k] for x in r[2]] for r in rows]
            return columns | {"collapsed": [r[3] for r in rows]}

        return step

    whole = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return map_batches(
        whole,
        make,
        "doc_id bigint, n_words bigint, start array<bigint>, length array<bigint>,"
        " period array<bigint>, collapsed string",
    )


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by checksum of its id, repeats a stretch of its words up to its end."""
    if doc_id is None or not words:
        return words
    checksum = zlib.crc32(str(doc_id).encode())
    if checksum % 10:
        return words
    part = checksum // 10
    first = part % len(words)
    rest = len(words) - first
    period = 1 + rest // (3 + part % 8)
    return words[:first] + (words[first : first + period] * (rest // period + 1))[:rest]


def run_digests(found: DataFrame) -> DataFrame:
    """One row per document: its number of runs, the most repetitive one, and digests."""
    runs = F.transform(
        F.sequence(F.lit(1), F.size("start")),
        lambda i: F.struct(*[F.element_at(c, i).alias(c) for c in ("start", "length", "period")]),
    )
    runs = F.when(F.size("start") > 0, runs).otherwise(F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>"))

    def before(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        tied = F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])
        return F.when(left != right, F.signum(right - left)).otherwise(F.signum(tied)).cast("int")

    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("start") > 0, "\n").otherwise(""))
    best = F.get(F.array_sort(runs, before), F.lit(0))
    rows = found.select("doc_id", F.size("start").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed"), "collapsed")
    return rows.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
