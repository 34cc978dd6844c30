"""Personal data: fixed patterns, and a linear-chain conditional random field for disguised forms.

The base spans are those of four patterns (email, ip, card, phone), leftmost and non-overlapping for
each kind, with their checks. Around every digit, at-sign or dot in disguise a window of tokens goes
to the random field: labels are begin, inside and outside for each kind, features are words and word
shapes of a token and its neighbours. It is fitted on a small labelled table by maximum likelihood
and decoded by Viterbi over numpy batches of windows. A decoded span is added if it passes the check
of its kind once its disguise is removed and if it overlaps no base span.

Positions are code points, ends exclusive. Null and empty texts have no spans. Very long runs of
digits or letters take time in proportion to their length. Of decoded spans that overlap, and of paths
with equal scores, the first stays. Repeated rows are judged alike. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import map_batches, text_or_empty

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: Rows of the labelled table that a fit reads at most.
EXAMPLE_ROWS = 5_000
#: Characters on either side of a trigger that the random field sees at least.
REACH = 48
WINDOWS_AT_ONCE = 256

Span = tuple[str, int, int]

# -- fixed patterns -------------------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def small_part(part: str) -> bool:
    """Whether a run of digits is at most 255; runs of any length."""
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or 0) <= 255


def _emails(text: str) -> list[Span]:
    """The local part reaches back from the at-sign to the end of the match before."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns, by kind and start."""
    spans = _emails(text) if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(map(small_part, m.group().split("."))):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return spans


# -- tokens and features --------------------------------------------------------------------------

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")
#: Every spelling of an at-sign or a dot that ``_AT_WORD`` and ``_DOT_WORD`` accept; a bare ``at`` and a
#: plain dot only together, around a name.
_TRIGGER = re.compile(
    r"[0-9@]|(?<![^\W_])(?:dot|punto|punkt|point)(?![^\W_])|[(\[{<]\s*+(?:at|\.)\s*+[)\]}>]|arroba|arobase"
    r"|(?<=\s)at(?=\s++[a-z0-9-]++\s*+\.\s*+[a-z0-9-])",
    re.I,
)


def windows(text: str) -> list[tuple[int, int]]:
    """Parts of a text around triggers; parts that touch are one, and none crosses a line.

    A part reaches ``REACH`` characters to either side of its triggers, and on from there to the next
    white space, so that no run of characters is cut however long it is.
    """
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        if out and m.start() + REACH <= out[-1][1]:
            continue
        first = text.rfind("\n", 0, m.start()) + 1
        last = text.find("\n", m.end())
        last = len(text) if last < 0 else last
        start, end = max(first, m.start() - REACH), min(last, m.end() + REACH)
        free = max(first, out[-1][1] if out else 0)  # what lies before is in a part already
        while start > free and not text[start - 1].isspace():
            start -= 1
        while end < last and not text[end].isspace():
            end += 1
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def shape(token: str) -> str:
    """Word shape: letter case or number size; other characters stand for themselves."""
    if token.isdecimal():
        n = len(token)
        size = str(n) if n < 5 else "5-7" if n < 8 else "8-15" if n < 16 else "16-19" if n < 20 else "20+"
        return "d" + size + ("s" if small_part(token) else "")
    if token.isalpha():
        case = "x" if token.islower() else "X" if token.isupper() else "Xx"
        return case + ("1" if len(token) == 1 else "")
    return token


def token_features(tokens: list[str], spaced: list[bool]) -> list[list[str]]:
    """Features of every token: own word and shape, and shapes of up to four neighbours a side."""
    n = len(tokens)
    shapes = ["_" if s else "" for s in spaced]
    shapes = [a + shape(t) for a, t in zip(shapes, tokens)]
    words = [t.lower() if t.isalpha() else "" for t in tokens]

    def at(values: list[str], i: int) -> str:
        return values[i] if 0 <= i < n else "^"

    rows = []
    for i in range(n):
        f = [f"w={words[i]}", f"s={shapes[i]}", "bias"]
        f += [f"w{d}={at(words, i + d)}" for d in (-3, -2, -1, 1, 2, 3)]
        f += [f"s{d}={at(shapes, i + d)}" for d in (-4, -3, -2, -1, 1, 2, 3, 4)]
        f += [
            f"s-1,0={at(shapes, i - 1)},{shapes[i]}",
            f"s0,1={shapes[i]},{at(shapes, i + 1)}",
            f"s-1,1={at(shapes, i - 1)},{at(shapes, i + 1)}",
        ]
        rows.append(f)
    return rows


def tokenized(text: str) -> tuple[list[tuple[int, int]], list[list[str]]]:
    """Places of tokens and their features."""
    places = [m.span() for m in _TOKEN.finditer(text)]
    tokens = [text[a:b] for a, b in places]
    spaced = [a > 0 and text[a - 1].isspace() for a, _ in places]
    return places, token_features(tokens, spaced)


# -- the random field -----------------------------------------------------------------------------

_S = len(LABELS)
_NEVER = -1e9


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """Penalties that forbid an inside label at the start or after another kind."""
    start, move = np.zeros(_S), np.zeros((_S, _S))
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            start[j] = _NEVER
            for i, before in enumerate(LABELS):
                if before[2:] != label[2:]:
                    move[i, j] = _NEVER
    return start, move


@dataclass
class RandomField:
    """Feature numbers, emission weights (features x labels) and transition weights."""

    features: dict[str, int]
    emission: np.ndarray
    transition: np.ndarray

    def emissions(self, rows: list[list[str]]) -> np.ndarray:
        known = self.features
        out = np.zeros((len(rows), _S))
        for i, row in enumerate(rows):
            out[i] = self.emission[[known[f] for f in row if f in known]].sum(0)
        return out

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of every sequence, by Viterbi over padded batches of similar length."""
        start, move = _allowed()
        move = move + self.transition
        best: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sequences)
        order = sorted((i for i, s in enumerate(sequences) if len(s)), key=lambda i: len(sequences[i]))
        for at in range(0, len(order), WINDOWS_AT_ONCE):
            some = order[at : at + WINDOWS_AT_ONCE]
            sizes = np.array([len(sequences[i]) for i in some])
            longest = int(sizes.max())
            e = np.zeros((len(some), longest, _S))
            for k, i in enumerate(some):
                e[k, : sizes[k]] = sequences[i]
            score = start + e[:, 0]
            back = np.zeros((len(some), longest, _S), np.int8)
            for t in range(1, longest):
                paths = score[:, :, None] + move
                back[:, t] = paths.argmax(1)
                score = np.where((t < sizes)[:, None], paths.max(1) + e[:, t], score)
            for k, i in enumerate(some):
                path = np.zeros(sizes[k], np.int64)
                path[-1] = score[k].argmax()
                for t in range(sizes[k] - 1, 0, -1):
                    path[t - 1] = back[k, t, path[t]]
                best[i] = path
        return best


def fit_field(
    rows: list[tuple[str, list[Span]]], steps: int = 150, rate: float = 0.1, ridge: float = 1e-3
) -> RandomField:
    """Maximum likelihood with a ridge penalty, by full-batch Adam."""
    tokens, gold = [], []
    for text, spans in rows:
        places, features = tokenized(text)
        labels = []
        for a, b in places:
            inside = next(((k, s) for k, s, e in spans if s <= a and b <= e), None)
            labels.append(
                0 if inside is None else LABELS.index(("B-" if a == inside[1] else "I-") + inside[0])
            )
        if places:
            tokens.append(features)
            gold.append(labels)
    seen = Counter(f for s in tokens for row in s for f in row)
    number = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n > 1))}
    sizes = np.array(list(map(len, tokens)))
    n, longest = len(tokens), int(sizes.max())
    mask = np.arange(longest) < sizes[:, None]
    rows_ = [row for s in tokens for row in s]
    at = np.full((len(rows_), max(map(len, rows_))), len(number))  # the last row of weights stays zero
    for i, row in enumerate(rows_):
        ids = [number[f] for f in row if f in number]
        at[i, : len(ids)] = ids
    y = np.zeros((n, longest), np.int64)
    y[mask] = np.concatenate([np.array(g) for g in gold])

    def per_feature(values: np.ndarray) -> np.ndarray:
        """Sum of token values (tokens x labels) for each feature."""
        flat, k = at.ravel(), at.shape[1]
        sums = [np.bincount(flat, np.repeat(v, k), len(number) + 1) for v in values.T]
        return np.stack(sums, 1)

    start, never = _allowed()
    opening, both = np.exp(start), mask[:, 1:]
    target = per_feature(np.eye(_S)[y[mask]])
    pairs = np.zeros((_S, _S))
    np.add.at(pairs, (y[:, :-1][both], y[:, 1:][both]), 1.0)
    w, move = np.zeros((len(number) + 1, _S)), np.zeros((_S, _S))
    moments = [np.zeros_like(v) for v in (w, w, move, move)]
    for step in range(1, steps + 1):
        e = np.zeros((n, longest, _S))
        e[mask] = w[at].sum(1)
        e = np.exp(e - e.max(2, keepdims=True))  # a factor per token cancels in all chances
        m = np.exp(move + never)
        # Forward and backward sums, scaled to one at every token.
        forward, backward = np.zeros_like(e), np.ones_like(e)
        norm = np.ones((n, longest))
        now = opening * e[:, 0]
        for t in range(longest):
            if t:
                now = np.where(mask[:, t, None], forward[:, t - 1] @ m * e[:, t], forward[:, t - 1])
            norm[:, t] = now.sum(1)
            forward[:, t] = now / norm[:, t, None]
        expected_pairs = np.zeros_like(m)
        for t in range(longest - 2, -1, -1):
            ahead = e[:, t + 1] * backward[:, t + 1] / norm[:, t + 1, None] * mask[:, t + 1, None]
            expected_pairs += (forward[:, t].T @ ahead) * m
            backward[:, t] = np.where(mask[:, t + 1, None], ahead @ m.T, 1.0)
        chance = forward * backward
        chance /= chance.sum(2, keepdims=True)
        gradients = (
            (target - per_feature(chance[mask])) / n - ridge * w,
            (pairs - expected_pairs) / n - ridge * move,
        )
        for k, (value, g) in enumerate(zip((w, move), gradients)):
            first, second = moments[2 * k], moments[2 * k + 1]
            first *= 0.9
            first += 0.1 * g
            second *= 0.999
            second += 0.001 * g * g
            value += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w[-1] = 0.0
    return RandomField(number, w, move)


# -- added spans ----------------------------------------------------------------------------------

_AT_WORD = re.compile(r"\s*(?:[(\[{<]\s*(?:at|@)\s*[)\]}>]|(?<=\s)(?:at|arroba|arobase)(?=\s)|@)\s*", re.I)
_DOT_WORD = re.compile(r"\s*(?:[(\[{<]\s*(?:dot|\.)\s*[)\]}>]|(?<=\s)(?:dot|punto|punkt|point)(?=\s)|\.)\s*", re.I)
_PLAIN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def passes(kind: str, value: str) -> bool:
    """Whether a decoded span is what it claims to be once its disguise is removed."""
    if kind == "email":
        return bool(_PLAIN_EMAIL.fullmatch(_DOT_WORD.sub(".", _AT_WORD.sub("@", value))))
    if kind == "ip":
        parts = _DOT_WORD.sub(".", value).split(".")
        return len(parts) == 4 and all(p.isdecimal() and p.isascii() and small_part(p) for p in parts)
    digits = "".join(_DIGIT.findall(value))
    if re.search(r"[^\W\d_]", value):
        return False
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    separated = len(re.findall(r"[0-9]+", value)) > 1
    return 8 <= len(digits) <= 15 and (separated or value.startswith("+"))


def overlaps(span: Span, others: list[Span]) -> bool:
    return any(a < span[2] and span[1] < b for _, a, b in others)


def finder(field: RandomField) -> Callable[[list[str]], list[tuple[list[Span], list[Span]]]]:
    """Base and added spans of many texts."""

    def find(texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        base = [base_spans(t) for t in texts]
        owner, places, sequences = [], [], []
        for i, text in enumerate(texts):
            for a, b in windows(text):
                where, features = tokenized(text[a:b])
                owner.append(i)
                places.append([(a + x, a + y) for x, y in where])
                sequences.append(field.emissions(features))
        added: list[list[Span]] = [[] for _ in texts]
        for i, where, path in zip(owner, places, field.decode(sequences)):
            t = 0
            while t < len(path):
                label = LABELS[path[t]]
                first = t
                t += 1
                if label[0] != "B":
                    continue
                while t < len(path) and LABELS[path[t]] == "I-" + label[2:]:
                    t += 1
                span = (label[2:], where[first][0], where[t - 1][1])
                fits = passes(span[0], texts[i][span[1] : span[2]])
                if fits and not overlaps(span, base[i]) and not overlaps(span, added[i]):
                    added[i].append(span)
        return list(zip(base, added))

    return find


def joined(spans: list[Span]) -> str:
    """``kind:start:end`` by kind as listed, then start, joined by commas."""
    in_order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in in_order)


def fit_examples(examples: DataFrame, most: int = EXAMPLE_ROWS) -> RandomField:
    """Fit on a labelled table (``text, spans``) of at most ``most`` rows."""
    rows = []
    for r in examples.orderBy("text").limit(most).collect():
        parts = [s.split(":") for s in (r.spans or "").split(",") if s]
        rows.append((r.text or "", [(k, int(a), int(b)) for k, a, b in parts]))
    return fit_field(rows)


def find_pii(
    docs: DataFrame, field: RandomField, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, counts and hash of the base spans, all spans, and how many were added."""

    def make():
        find = finder(field)

        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {f"n_{k}": [] for k in KINDS}
            out |= {"doc_id": batch.column(0), "base_sha256": [], "spans": [], "n_added": []}
            for base, added in find(batch.column(1).to_pylist()):
                counts = Counter(s[0] for s in base)
                for k in KINDS:
                    out[f"n_{k}"].append(counts[k])
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(base + added))
                out["n_added"].append(len(added))
            return out

        return step

    whole = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text")
    )
    return map_batches(
        whole,
        make,
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint,"
        " base_sha256 string, spans string, n_added bigint",
    )
