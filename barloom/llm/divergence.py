"""Quality rules by distribution divergence.

Every document gets two histograms: bytes by character class and words by common word. The common
words of a language are its ``TOP`` most frequent ones, counted over all its documents; all others are
one bin. The reference of a language is the sum of these histograms over all its documents. A document fails
when the Jensen-Shannon distance (base 2, 0 to 1) of a histogram from its language's reference is
above a threshold. Short texts have rough histograms, so the thresholds widen for them and texts
below a least number of words are not judged. The base rules (least words, share of repeated
words) come first.

Null and empty texts have no words and fail the base rules. A missing language is a language of its
own. Very long texts are read whole. Words that are equally frequent are taken in byte order. Repeated
rows each count in the reference. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import map_batches, text_or_empty
from barloom.sinks.writers import written

MIN_WORDS = 50
REPEATED_PERCENT = 50
#: Distances that fail a document. Sampling alone moves the histograms of a text of ``n`` words by
#: about ``1 / sqrt(n)``, so that much (times the factor) is added, and below ``GUARD_WORDS`` words
#: no histogram is judged.
MAX_CHARACTERS, NOISE_CHARACTERS = 0.16, 1.0
MAX_WORDS, NOISE_WORDS = 0.17, 2.0
GUARD_WORDS = 100

#: Common words of a language; those of all languages fit a table that tasks can hold.
TOP = 30
#: Distinct words that a task counts before it passes the counts on.
COUNTED = 300_000

_WHITE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
#: Classes of bytes, listed in order; all others are the last class.
CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c\r",
    b"\n", b".,;:?'\"()-", b"!", b"#*$%&", b"|<>", bytes(range(128, 256)),
)
_CLASS_OF = bytes(
    next((i for i, c in enumerate(CLASSES) if b in c), len(CLASSES)) for b in range(256)
)
_MARKS = b".,;:!?\"'()-"


def character_histogram(raw: bytes) -> np.ndarray:
    classes = np.frombuffer(raw.translate(_CLASS_OF), np.uint8)
    return np.bincount(classes, minlength=len(CLASSES) + 1)


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words that lie in a window of three words that occurs more than once."""
    if len(ids) < 4:
        return 0
    if distinct < 2_000_000:
        windows = (ids[:-2] * distinct + ids[1:-1]) * distinct + ids[2:]
    else:
        _, windows = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]]), axis=1, return_inverse=True)
        windows = windows.reshape(-1)
    _, at, times = np.unique(windows, return_inverse=True, return_counts=True)
    found = times[at.reshape(-1)] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : shift + len(found)] |= found
    return int(covered.sum())


def plain_word(word: bytes) -> bytes:
    """How a word counts as common: A-Z as a-z, marks around it left out."""
    return word.lower().strip(_MARKS)


def common_words(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, words``: the ``top`` most frequent words of every language (``lang, text``), written.

    Tasks count first and pass on one row per word; ranks are cut within the tasks, too.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            langs, words = zip(*seen) if seen else ((), ())
            out = [pa.array(langs, pa.string()), pa.array(words, pa.binary()), pa.array(list(seen.values()), pa.int64())]
            seen.clear()
            return pa.RecordBatch.from_arrays(out, ["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                for word, n in Counter(text.encode().split()).items():
                    plain = plain_word(word)
                    if plain:
                        seen[lang, plain] += n
                if len(seen) > COUNTED:
                    yield rows()
        yield rows()

    counts = docs.select("lang", "text").mapInArrow(count, "lang string, word binary, n bigint")
    counts = counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    best = counts.withColumn("place", place).where(F.col("place") <= top)
    listed = F.array_sort(F.collect_list(F.struct("place", "word")))["word"]
    return written(best.groupBy("lang").agg(listed.alias("words")), "divergence-words")


def measure(text: str, place: dict[bytes, int], top: int = TOP) -> dict:
    """Base numbers and histograms of one text; ``place`` numbers its language's common words."""
    raw = text.encode()
    words = raw.split()
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    times = np.bincount(ids, minlength=len(seen))
    common = np.zeros(top + 1, np.int64)
    for word, n in zip(seen, times.tolist()):
        common[place.get(plain_word(word), -1)] += n
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(map(text.count, _WHITE)),
        "n_symbols": sum(map(text.count, _SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(ids, len(seen)),
        "characters": character_histogram(raw),
        "common": common,
    }


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of the rows of two tables of counts; 0 where a row is empty."""
    p_sum, q_sum = p.sum(1, keepdims=True), q.sum(1, keepdims=True)
    p, q = p / np.maximum(p_sum, 1), q / np.maximum(q_sum, 1)
    m = (p + q) / 2

    def entropy(x: np.ndarray) -> np.ndarray:
        return -(x * np.log2(np.where(x > 0, x, 1.0))).sum(1)

    d = np.sqrt(np.clip(entropy(m) - (entropy(p) + entropy(q)) / 2, 0, 1))
    return np.where((p_sum[:, 0] > 0) & (q_sum[:, 0] > 0), d, 0.0)


_BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def measures(docs: DataFrame, doc_id: str, text: str, lang: str, top: int = TOP) -> DataFrame:
    """Base numbers and both histograms of every row."""

    def make():
        places: dict[tuple, dict[bytes, int]] = {}

        def step(batch: pa.RecordBatch) -> dict:
            rows = []
            for value, words in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                key = tuple(words or ())
                if key not in places:
                    if len(places) > 1000:
                        places.clear()
                    places[key] = {w: i for i, w in enumerate(key)}
                rows.append(measure(value, places[key], top))
            out = {"doc_id": batch.column(0), "lang": batch.column(1)}
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            out |= {k: [r[k] for r in rows] for k in names}
            return out | {k: [r[k] for r in rows] for k in ("characters", "common")}

        return step

    whole = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit("")).alias("lang"),
        text_or_empty(text).alias("text"),
    )
    # One row per language: the planner broadcasts it if its size allows that.
    told = whole.join(common_words(whole, top), "lang", "left")
    return map_batches(
        told.select("doc_id", "lang", "text", "words"),
        make,
        f"doc_id bigint, lang string, {_BASE}, characters array<bigint>, common array<bigint>",
    )


def references(measured: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, ref_characters, ref_common``: sums over all documents of a language.

    Tasks add up their rows first; a language that holds most rows is one row per task then.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            if not langs:
                continue
            tables = [batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(len(langs), -1) for i in (1, 2)]
            table = np.hstack(tables)
            at = np.array(langs)
            for lang in set(langs):
                sums[lang] = sums.get(lang, 0) + table[at == lang].sum(0)
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array(list(sums), pa.string()),
                "sums": pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64())),
            }
        )

    k = len(CLASSES) + 1
    partial = measured.select("lang", "characters", "common").mapInArrow(
        add_up, "lang string, sums array<bigint>"
    )
    total = (
        partial.select("lang", F.posexplode("sums").alias("at", "n"))
        .groupBy("lang", "at")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("sums"))
        .select("lang", F.col("sums.n").alias("sums"))
    )
    return total.select(
        "lang",
        F.slice("sums", 1, k).alias("ref_characters"),
        F.slice("sums", k + 1, top + 1).alias("ref_common"),
    )


def divergence_rules(
    docs: DataFrame,
    max_characters: float = MAX_CHARACTERS,
    max_words: float = MAX_WORDS,
    guard_words: int = GUARD_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    top: int = TOP,
) -> DataFrame:
    """Base numbers, ``base_failed``, both distances and ``kept`` of every row."""
    measured = written(measures(docs, doc_id, text, lang, top), "divergence-measures")
    # One row per language, written: the planner broadcasts it if its size allows that.
    joined = measured.join(written(references(measured, top), "divergence-references"), "lang")

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            out = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}

            def table(name: str) -> np.ndarray:
                flat = out[name].flatten().to_numpy(zero_copy_only=False)
                return flat.reshape(batch.num_rows, -1).astype(float) if batch.num_rows else np.zeros((0, 1))

            return out | {
                "character_distance": distance(table("characters"), table("ref_characters")),
                "word_distance": distance(table("common"), table("ref_common")),
            }

        return step

    told = map_batches(
        joined.drop("lang"), make, f"doc_id bigint, {_BASE}, character_distance double, word_distance double"
    )
    words = F.col("n_words")
    failed = (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * words)
    noise = 1 / F.sqrt(F.greatest(words, F.lit(1)))
    far = (words >= guard_words) & (
        (F.col("character_distance") > max_characters + NOISE_CHARACTERS * noise)
        | (F.col("word_distance") > max_words + NOISE_WORDS * noise)
    )
    return told.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far)
