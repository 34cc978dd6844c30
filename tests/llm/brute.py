"""Plain versions of the corpus operators for small tables."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from barloom.llm.queries import BYTE_BPE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
TOKENIZER = Tokenizer.from_file(BYTE_BPE)


def token_ids(text: str | None) -> list[int]:
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def shingles(text: str | None, size: int = 4) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(sets: dict[int, frozenset], percent: int = 85) -> dict[int, int]:
    root = {i: i for i in sets}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        common = Counter(j for x in s for j in holders[x])
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for x in s:
            holders[x].append(i)
    return {i: find(i) for i in sets}


def mix(rows: list[tuple[int, str | None, int]]) -> dict[int, tuple[int, float, int]]:
    """Source size, target and taken words of (id, source, size) rows with distinct ids."""
    sizes: dict = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    target: dict = {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(2.0 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if share[s] > 2.0 * sizes[s]}
        if not over:
            target = share | {s: 2.0 * sizes[s] for s in capped}
            break
        capped |= over
    offers = []
    for k, s in enumerate(names):
        mine = sorted((r for r in rows if r[1] == s), key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest())
        words = 0
        for turn in range(2):
            for doc, _, size in mine:
                words += size
                if size and target[s]:
                    offers.append((words / target[s], k, turn, words, doc, size))
    taken: Counter = Counter()
    served, budget = 0, sum(target.values())
    for *_, doc, size in sorted(offers):
        served += size
        if served > budget:
            break
        taken[doc] += size
    return {doc: (sizes[s], target[s], taken[doc]) for doc, s, _ in rows}


def best_fit_decreasing(lengths: list[int], capacity: int) -> int:
    gaps, opened = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        if at < len(gaps):
            free = gaps.pop(at) - length
        else:
            free, opened = capacity - length, opened + 1
        bisect.insort(gaps, free)
    return opened


def check_packing(pieces, texts: list[tuple[int, str | None]], capacity: int = 1024) -> None:
    """Pieces (a pandas table) rebuild the ids of all documents and fill sequences without gaps."""
    import zlib

    left = Counter()
    for doc, text in texts:
        ids = np.array([*token_ids(text), 2], "<u4")
        n = len(ids)
        first = n if n <= capacity else n % capacity or capacity
        starts = [0, *range(first, n, capacity)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
            left[(doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    got = Counter(pieces[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None))
    assert got == left
    placed = pieces.sort_values(["sequence_id", "offset"])
    end = placed.offset + placed.length
    before = end.groupby(placed.sequence_id).shift(fill_value=0)
    assert (before == placed.offset).all() and end.max() <= capacity
    assert pieces.sequence_id.nunique() == best_fit_decreasing(list(pieces.length), capacity)


def luhn(digits: str) -> bool:
    doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def base_pii(text: str) -> list[tuple[str, int, int]]:
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def base_quality(text: str) -> tuple[int, int, int, int, int]:
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )
