"""Toxicity scores on text restored by a noisy channel.

Tokens that may be disguised (letters next to digits, symbols or separators at any place, symbols
alone, spaced-out letters, repeated letters) become character lattices, after other punctuation
around them is gone: an arc for the character itself, for each letter that it may stand for, for
dropping a separator, for any letter that a star masks and for shortening a run. Viterbi finds the best path under a trigram character language
model, and the restored words are scored along with the plain ones.

The language model counts the letters of every document, labelled or not. The score is a logistic
regression over evidence of word beginnings and whole words (log odds of being used in toxic
documents), learnt from labelled rows outside the held-out fold. Evidence and regression use at
most ``TRAIN_ROWS`` labelled rows, chosen by hash of the id; scoring reads every whole text.
Language, source, id and labels are no inputs of a score.

Null and empty texts score like texts without evidence; very long ones are scored whole. Of readings
with equal scores the decoder keeps the first. Without labelled rows of both classes every
score is the smoothed share of toxic labels. Repeated rows score alike. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import give_back, held_out, map_batches, pieces, small_batches, text_or_empty
from barloom.llm.logistic import Logistic, fit_logistic
from barloom.sinks.writers import written

#: Labelled rows that a fit uses at most, and word forms that the evidence table holds at most.
TRAIN_ROWS = 12_000
EVIDENCE_ROWS = 60_000
#: Toxic documents that must use a form, and the log odds that count as evidence.
MIN_DOCS = 4
MIN_ODDS = 1.0
THRESHOLD = 0.3
#: Tokens and words that a task remembers; a worker lives on with what its largest task took.
CACHE_ROWS = 100_000
#: Characters of text that are counted at once, and distinct n-grams that a task holds.
CHUNK_CHARACTERS, FLUSH_GRAMS = 1 << 20, 500_000

#: Letters that a character may stand for.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = " .-_*/"
#: Log costs of the channel: a substituted letter, a dropped separator, a shortened run, a masked
#: letter. A longer run of stars is decoration and masks nothing.
_SUBSTITUTE, _DROP, _SHORTEN, _MASKED = -1.5, -0.3, -0.5, -2.5
_MASK, _MASK_RUN = "*", 8

_LETTERS = re.compile(r"[^\W\d_]+")
_LEET_CLASS = "[" + re.escape("".join(LEET)) + "]"
_LEET = re.compile(_LEET_CLASS)
_CORE_CLASS = r"(?:[^\W_]|" + _LEET_CLASS + ")"
_CORE = re.compile(rf"{_CORE_CLASS}(?:.*{_CORE_CLASS})?", re.DOTALL)
_HIDING = re.compile("[" + re.escape("".join(LEET) + SEPARATORS) + "]")
_RUN = re.compile(r"([^\W\d_])\1\1")
_GAP_CLASS = r"[\s" + re.escape(SEPARATORS.strip()) + "]"
_SINGLE_CLASS = r"[^\s" + re.escape(SEPARATORS.strip()) + "]"
_SPACED = re.compile(rf"(?<![^\W_]){_SINGLE_CLASS}(?:{_GAP_CLASS}++{_SINGLE_CLASS}){{2,}}(?![^\W_])")
_GAP = re.compile(_GAP_CLASS + "+")
_STARS = re.compile(re.escape(_MASK) + "+")


@dataclass
class CharacterModel:
    """Trigram probabilities of letters inside words, with bigram and unigram backing."""

    tri: dict[str, float]
    bi: dict[str, float]
    uni: dict[str, float]
    memo: dict[str, float] = field(default_factory=dict)
    after: dict[str, str] = field(default_factory=dict)

    @classmethod
    def fit(cls, counts: Counter) -> "CharacterModel":
        by = {1: Counter(), 2: Counter(), 3: Counter()}
        for gram, n in counts.items():
            by[len(gram)][gram] += n
        total = sum(by[1].values()) or 1
        uni = {g: n / total for g, n in by[1].items()}
        heads = {k: Counter() for k in (2, 3)}
        for k in (2, 3):
            for g, n in by[k].items():
                heads[k][g[:-1]] += n
        bi = {g: n / heads[2][g[0]] for g, n in by[2].items()}
        tri = {g: n / heads[3][g[:2]] for g, n in by[3].items()}
        return cls(tri, bi, uni)

    def cost(self, before: str, letter: str) -> float:
        """Log probability of a letter after the two before it (``^`` starts a word)."""
        key = before + letter
        known = self.memo.get(key)
        if known is None:
            p = (
                0.6 * self.tri.get(key, 0.0)
                + 0.3 * self.bi.get(key[-2:], 0.0)
                + 0.1 * self.uni.get(letter, 0.0)
                + 1e-5
            )
            known = self.memo[key] = math.log(p)
        return known

    def maskable(self, before: str) -> str:
        """Letters that a masked one after ``before`` may be: those that follow it in some word."""
        if not self.after:
            found: dict[str, list[str]] = {}
            for head, letter in self.bi:
                found.setdefault(head, []).append(letter)
            self.after.update((head, "".join(sorted(set(x) - {"$"}))) for head, x in found.items())
        return self.after.get(before, "")

    def decode(self, token: str) -> str:
        """Most likely plain text of a disguised token (lower case)."""
        # A state is the last two letters; it keeps its log probability and the text so far as a
        # chain of (text before, character), so that long tokens are not copied at every step.
        states: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
        last = len(token) - 1
        stars = {i for m in _STARS.finditer(token) if len(m.group()) <= _MASK_RUN for i in range(*m.span())}
        for i, c in enumerate(token):
            new: dict[str, tuple[float, tuple | None]] = {}

            def offer(state: str, p: float, text: tuple | None) -> None:
                if state not in new or p > new[state][0]:
                    new[state] = (p, text)

            inside = 0 < i < last
            repeated = i > 0 and token[i - 1] == c
            for state, (p, text) in states.items():
                if c.isalpha():
                    offer(state[1] + c, p + self.cost(state, c), (text, c))
                else:
                    if c in SEPARATORS and inside:
                        offer(state, p + _DROP, text)
                    offer("^^", p + self.cost(state, "$"), (text, " "))
                for letter in LEET.get(c, ""):
                    # A symbol that repeats stands for its letter again, at no further cost.
                    change = 0.0 if repeated and state[1] == letter else _SUBSTITUTE
                    offer(state[1] + letter, p + change + self.cost(state, letter), (text, letter))
                if inside and i in stars:
                    for letter in self.maskable(state[1]):
                        offer(state[1] + letter, p + _MASKED + self.cost(state, letter), (text, letter))
                if repeated and text:
                    offer(state, p + _SHORTEN, text)
            states = new
        ends = [(p + self.cost(s, "$"), text) for s, (p, text) in states.items()]
        best = max(p for p, _ in ends)
        return max(_joined(text) for p, text in ends if p == best)


def _joined(text: tuple | None) -> str:
    """The characters of a chain, first one first."""
    letters = []
    while text:
        text, letter = text
        letters.append(letter)
    return "".join(reversed(letters))


def word_grams(words: list[str]) -> Counter:
    """Letter n-grams of words, word ends included."""
    counts: Counter = Counter()
    for word, n in Counter(words).items():
        whole = "^^" + word + "$"
        for i in range(2, len(whole)):
            counts[whole[i]] += n
            counts[whole[i - 1 : i + 1]] += n
            counts[whole[i - 2 : i + 1]] += n
    return counts


class GramCounter:
    """The counts of :func:`word_grams` over lower-case texts, by whole arrays of characters."""

    #: Trigrams of an alphabet that are counted in a table; larger alphabets are sorted.
    TABLE = 1 << 22

    def __init__(self) -> None:
        self.numbers = np.full(0x110000, -1, np.int32)
        self.letters = [""]  # number 0 is what is no letter: a word's start or its end
        self.counts: Counter = Counter()

    def add(self, texts: list[str]) -> None:
        joined = "\n\n" + "\n".join(texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = self.numbers[codes]
        for code in np.unique(codes[at < 0]).tolist():
            letter = _LETTERS.fullmatch(chr(code))
            self.numbers[code] = len(self.letters) if letter else 0
            if letter:
                self.letters.append(chr(code))
        at = self.numbers[codes].astype(np.int64)
        here, one = at[2:], at[1:-1]
        two = np.where(one > 0, at[:-2], 0)
        inside = (here > 0) | (one > 0)
        size = len(self.letters)
        keys = ((two * size + one) * size + here)[inside]
        if size**3 <= self.TABLE:
            table = np.bincount(keys, minlength=1)
            found = np.flatnonzero(table)
            times = table[found]
        else:
            found, times = np.unique(keys, return_counts=True)
        parts = zip((found // size**2).tolist(), (found // size % size).tolist(), (found % size).tolist())
        for part, n in zip(parts, times.tolist()):
            self.counts[part] += n

    def grams(self) -> Counter:
        grams: Counter = Counter()
        for (two, one, here), n in self.counts.items():
            a, b, c = self.letters[two] or "^", self.letters[one] or "^", self.letters[here] or "$"
            grams[c] += n
            grams[b + c] += n
            grams[a + b + c] += n
        return grams


def forms(word: str) -> list[str]:
    """Beginnings of four to eight letters and the whole word."""
    return ["^" + word[:k] for k in range(4, min(8, len(word)) + 1)] + ["^" + word + "$"]


def disguised(token: str) -> bool:
    """Whether a token gets a lattice of more than one path."""
    if token.isalpha():
        return bool(_RUN.search(token))
    if _LETTERS.search(token):
        return bool(_HIDING.search(token) or _RUN.search(token))
    # Without letters: two symbols or a symbol and digits that stand for letters, like ``@$$``.
    standing = set(_LEET.findall(token))
    return len(standing) > 1 and not all(c.isdigit() for c in standing)


def readings(token: str) -> set[str]:
    """Disguised forms in a token, without the punctuation around it.

    A bracket before and an exclamation mark behind may be letters or punctuation: both are read.
    """
    core = _CORE.search(token)
    if core is None:
        return set()
    inner = _CORE.search(core.group().lstrip("(").rstrip("!("))
    return {m.group() for m in (core, inner) if m and disguised(m.group())}


def plain_words(text: str, model: CharacterModel, memo: dict[str, list[str]]) -> set[str]:
    """Distinct words of a text, those that its disguised tokens decode to included."""
    low = text.lower()
    words: set[str] = set()
    for token in set(low.split()):
        found = memo.get(token)
        if found is None:
            found = _LETTERS.findall(token)
            if _RUN.search(token) or not token.isalpha():
                for reading in readings(token):
                    found = found + _LETTERS.findall(model.decode(reading))
            if len(memo) > CACHE_ROWS:
                memo.clear()
            memo[token] = found
        words.update(found)
    for m in _SPACED.finditer(low):
        # A run of separators is one; a star in it stays, because it may mask a letter.
        spelt = _GAP.sub(lambda gap: _MASK if _MASK in gap.group() else " ", m.group())
        words.update(_LETTERS.findall(model.decode(spelt)))
    return words


def evidence(words: set[str], odds: dict[str, float], memo: dict[str, float]) -> list[float]:
    """Inputs of the regression: the strongest words, their number, sum and share."""
    strong = []
    for word in words:
        s = memo.get(word)
        if s is None:
            s = max((odds.get(f, 0.0) for f in forms(word)), default=0.0)
            if len(memo) > CACHE_ROWS:
                memo.clear()
            memo[word] = s
        if s > 0:
            strong.append(s)
    strong.sort(reverse=True)
    top = (strong + [0.0, 0.0, 0.0])[:3]
    n = len(words)
    clear = sum(1 for s in strong if s > 3.0)
    return [*top, math.log1p(sum(strong)), math.log1p(clear), clear / (n + 5.0), math.log1p(n)]


@dataclass
class ToxicityModel:
    """What scoring needs: character model, evidence table and regression."""

    characters: CharacterModel
    odds: dict[str, float]
    regression: Logistic

    def scorer(self) -> Callable[[Iterable[str]], np.ndarray]:
        decoded: dict[str, list[str]] = {}
        strengths: dict[str, float] = {}

        def score(texts: Iterable[str]) -> np.ndarray:
            rows = [
                evidence(plain_words(t, self.characters, decoded), self.odds, strengths)
                for t in texts
            ]
            return self.regression.predict(np.array(rows, float).reshape(len(rows), -1))

        return score

    def score(self, text: str = "text") -> Column:
        """Score of a text column."""
        make = self.scorer

        @F.arrow_udf("double")
        def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            run = make()
            for texts in batches:
                found = run(t for piece in pieces(texts) for t in piece.to_pylist())
                yield pa.array(found, pa.float64())
            del run
            give_back()

        return scores(text_or_empty(text))


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    folds: int,
    fold: int,
    rows: int = TRAIN_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``label, text`` of at most ``rows`` labelled documents outside the held-out fold, written."""
    chosen = (
        labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isNotNull() & ~held_out("__id", folds, fold))
        .groupBy("__id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64(F.col("__id").cast("string")), "__id")
        .limit(rows)
    )
    # At most ``rows`` pairs of two numbers: a proven bound for the broadcast.
    sample = docs.select(F.col(doc_id).alias("__id"), text_or_empty(text).alias("text")).join(
        F.broadcast(chosen), "__id"
    )
    return written(sample.select("label", "text"), "training-sample")


def character_model(docs: DataFrame, text: str = "text") -> CharacterModel:
    """Letter n-grams of the whole text of every row; the driver gets one row per distinct n-gram."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = GramCounter()
        chunk: list[str] = []
        read = 0

        def counted() -> pa.RecordBatch:
            counts = counter.grams()
            counter.counts.clear()
            return pa.RecordBatch.from_pydict(
                {"form": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
            )

        for batch in batches:
            for document in (t for piece in pieces(batch) for t in piece.column(0).to_pylist()):
                chunk.append(document.lower())
                read += len(document)
                if read > CHUNK_CHARACTERS:
                    counter.add(chunk)
                    chunk, read = [], 0
                if len(counter.counts) > FLUSH_GRAMS:
                    yield counted()
        counter.add(chunk)
        yield counted()
        give_back()

    small_batches(docs.sparkSession)
    found = docs.select(text_or_empty(text).alias("text")).mapInArrow(grams, "form string, n bigint")
    rows = found.groupBy("form").agg(F.sum("n").alias("n")).collect()
    return CharacterModel.fit(Counter({r.form: r.n for r in rows}))


def fit_toxicity(sample: DataFrame, docs: DataFrame, text: str = "text") -> ToxicityModel:
    """Fit on ``label, text`` rows and on the letters of all ``docs``.

    All counting runs as Spark jobs, small tables come back.
    """
    small_batches(docs.sparkSession)
    totals = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        share = (toxic + 1.0) / (toxic + clean + 2.0)
        return ToxicityModel(CharacterModel({}, {}, {}), {}, Logistic.constant(share, 7))

    characters = character_model(docs, text)

    def count_forms(rows: DataFrame, only: set[str] | None, most: int) -> dict[str, int]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: Counter = Counter()
            memo: dict[str, list[str]] = {}
            for batch in batches:
                for text in (t for piece in pieces(batch) for t in piece.column(0).to_pylist()):
                    words = plain_words(text, characters, memo)
                    found = {f for w in words for f in forms(w)}
                    counts.update(found if only is None else found & only)
            yield pa.RecordBatch.from_pydict(
                {"form": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
            )

        found = rows.select("text").mapInArrow(run, "form string, n bigint")
        top = (
            found.groupBy("form").agg(F.sum("n").alias("n")).where(F.col("n") >= (MIN_DOCS if only is None else 1))
            .orderBy(F.desc("n"), "form").limit(most)
        )
        return {r.form: r.n for r in top.collect()}

    used = count_forms(sample.where("label = 1"), None, EVIDENCE_ROWS)
    clean_use = count_forms(sample.where("label = 0"), set(used), EVIDENCE_ROWS)
    odds = {}
    for form, n in used.items():
        # A form's weight counts against a prior of one toxic and several clean documents.
        value = math.log((n + 0.2) / (toxic + 1.0)) - math.log((clean_use.get(form, 0) + 0.5) / (clean + 1.0))
        if value > MIN_ODDS:
            odds[form] = value
    def rows_of():
        memo: dict[str, list[str]] = {}
        strengths: dict[str, float] = {}

        def step(batch: pa.RecordBatch) -> dict:
            texts = batch.column(1).to_pylist()
            return {
                "label": batch.column(0),
                "x": [evidence(plain_words(t, characters, memo), odds, strengths) for t in texts],
            }

        return step

    inputs = map_batches(sample.select("label", "text"), rows_of, "label int, x array<double>").collect()
    x = np.array([r.x for r in inputs])
    y = np.array([r.label for r in inputs], float)
    return ToxicityModel(characters, odds, fit_logistic(x, y))


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 4,
    fold: int = 2,
    threshold: float = THRESHOLD,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    model = fit_toxicity(training_sample(docs, labels, "toxic", folds, fold, train_rows), docs)
    scored = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out("doc_id", folds, fold).alias("held_out"),
        model.score("text").alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
