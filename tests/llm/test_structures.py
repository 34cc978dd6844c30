"""Repeated strings, periodic runs and the manifest against plain versions, and on odd tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF

import __spark_entry__ as entry
from barloom.llm import exact_dedup, merkle, repeats, runs
from barloom.llm.common import PIECE_BYTES, map_batches, pieces, small_batches, text_or_empty

# -- plain versions -------------------------------------------------------------------------------


def plain_removal(texts: list[str | None], least: int) -> list[tuple]:
    """Bytes, removed bytes, spans and digest of the rest, by counting every window."""
    data = [(t or "").encode() for t in texts]
    windows = Counter(d[i : i + least] for d in data for i in range(len(d) - least + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - least + 1):
            if windows[d[i : i + least]] > 1:
                gone[i : i + least] = True
        kept = bytes(x for x, g in zip(d, gone) if not g)
        starts = int((gone & ~np.append(False, gone[:-1])).sum())
        out.append((len(d), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return out


def plain_runs(words: list, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """Every period's stretches of equal words; the smallest period of an extent is the run's."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // times + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        start = None
        for i, x in enumerate(same):
            if x and start is None:
                start = i
            if not x and start is not None:
                if i + q - start >= max(least, times * q):
                    found.setdefault((start, i + q), q)
                start = None
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id: int | None, text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    rest = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        len(found), *best, 1000 * best[1] // best[2] if found else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest(),
    )


def hashed(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The last node, and per first node its siblings to the left and right of every level."""
    paths: list[list[tuple[str, str]]] = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        groups = [range(i, min(i + 16, len(nodes))) for i in range(0, len(nodes), 16)]
        for group in groups:
            for i in group:
                pair = "".join(nodes[j] for j in group if j < i), "".join(nodes[j] for j in group if j > i)
                for leaf in under[i]:
                    paths[leaf].append(pair)
        nodes = [hashed(*(nodes[i] for i in g)) for g in groups]
        under = [[leaf for i in g for leaf in under[i]] for g in groups]
    return nodes[0], paths


def plain_manifest(rows: list) -> Counter:
    def field(value) -> str:
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(r, text) -> str:
        return hashed(*(field(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))

    def order(value) -> tuple:
        return (value is not None, value.encode() if isinstance(value, str) else value or 0)

    sources = sorted({r.source for r in rows}, key=order)
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r.source == s), key=lambda r: (order(r.doc_id), leaf(r, r.text)))
        trees[s] = own, *plain_tree([leaf(r, r.text) for r in own])
    root, upper = plain_tree([trees[s][1] for s in sources])
    out: Counter = Counter()
    lower = {i: i + 32 for i in range(65, 91)}
    for s, above in zip(sources, upper):
        own, subroot, paths = trees[s]
        for r, path in zip(own, paths):
            path = path + above
            told = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
            h = leaf(r, r.text.translate(lower) if told and r.text else r.text)
            for left, right in path:
                h = hashed(left, h, right)
            proof = hashed(*(x for pair in path for x in pair))
            out[(r.doc_id, leaf(r, r.text), subroot, root, proof, h, h == root)] += 1
    return out


# -- repeated strings -----------------------------------------------------------------------------


def random_segments(rng: np.random.Generator) -> list[bytes]:
    letters = int(rng.integers(1, 5))

    def some(most: int) -> bytes:
        return bytes(rng.integers(97, 97 + letters, int(rng.integers(0, most))).astype(np.uint8))

    pool = [some(60) for _ in range(3)]
    return [
        b"".join(pool[int(rng.integers(3))] if rng.integers(2) else some(40) for _ in range(int(rng.integers(1, 5))))
        for _ in range(int(rng.integers(1, 8)))
    ]


def test_interval_expansion_finds_every_repeated_window():
    rng = np.random.default_rng(1)
    for _ in range(150):
        segments, least = random_segments(rng), int(rng.integers(3, 30))
        windows = Counter(s[i : i + least] for s in segments for i in range(len(s) - least + 1))
        want = [[i for i in range(len(s) - least + 1) if windows[s[i : i + least]] > 1] for s in segments]
        assert [p.tolist() for p in repeats.repeated_windows(segments, least)] == want


def test_common_prefixes_are_those_of_sorted_suffixes():
    rng = np.random.default_rng(2)
    for _ in range(50):
        data = bytes(rng.integers(97, 100, 200).astype(np.uint8)) + b"\xff"
        text = np.frombuffer(data, np.uint8)
        order = repeats.sorted_suffixes(text, 300)
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        got = repeats.common_prefixes(text, order, 12)
        for k in range(1, len(data)):
            a, b = data[order[k - 1] :], data[order[k] :]
            shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            if len(a) > 12 and len(b) > 12:
                assert got[k] == min(shared, 12)


def test_equal_windows_have_equal_keys():
    rng = np.random.default_rng(3)
    for _ in range(60):
        least = int(rng.integers(3, 30))
        for gram in {max(1, least // 3), least}:
            cut, keys = repeats.Segmenter(gram, least), {}
            for s in random_segments(rng):
                found = list(zip(*cut.cut(s)))
                assert [i for _, a, b, _ in found for i in range(a, b)] == list(range(len(s) - least + 1))
                for key, a, b, twice in found:
                    assert twice == ((cut.grams(s)[a : b + least - gram] == key).sum() > 1)
                    assert all(keys.setdefault(s[i : i + least], key) == key for i in range(a, b))


def test_repeats_of_the_given_table(spark, texts):
    got = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op11_repeats"](spark, SF).collect()}
    for (doc, _), want in zip(texts, plain_removal([t for _, t in texts], 400)):
        assert got[doc] == want


def test_passages_of_over_fifty_words_go_by_their_bytes(spark, make_docs, tmp_path):
    """Shared by two documents, 399 bytes stay and 400 go, whatever the number of words."""
    rng = np.random.default_rng(5)

    def text(size: int) -> str:
        return " ".join(str(x) for x in rng.integers(10_000, 99_999, size // 6 + 1))[: size - 1] + "."

    shared = {size: text(size) for size in (330, 399, 400, 460)}
    assert all(len(p.split()) > 50 for p in shared.values())
    rows = [
        (len(shared) * k + i, f"{text(600)}{'ab'[k]}{p}{'cd'[k]}{text(600)}")
        for k in range(2)
        for i, p in enumerate(shared.values())
    ] + [(8, text(2000))]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op11_repeats"](spark, str(tmp_path)).collect()}
    assert [got[i][1:3] for i, _ in rows] == 2 * [(0, 0), (0, 0), (400, 1), (460, 1)] + [(0, 0)]
    assert [got[i] for i, _ in rows] == plain_removal([t for _, t in rows], 400)


@pytest.mark.parametrize("group_bytes", [400, 2_000_000])
def test_large_groups_are_cut_by_longer_grams(spark, make_docs, group_bytes):
    """A passage in every document, once periodic, and copies: whatever the groups, the same rows."""
    rng = np.random.default_rng(4)

    def words(n: int) -> str:
        return " ".join(str(x) for x in rng.integers(0, 50, n))

    common, line = words(30), words(8)
    rows = [(i, f"{words(20)} {line} {words(20)} {common} {words(9)}") for i in range(30)]
    rows += [(30, "ab" * 100), (31, "ab" * 60 + "c"), (32, rows[0][1]), (33, rows[1][1] + "é漢"), (34, None), (35, "x")]
    found = repeats.repeated_ranges(make_docs(rows), least=40, grams=(12, 24), group_bytes=group_bytes)
    got = {r.doc_id: tuple(r)[1:] for r in repeats.span_counts(found).collect()}
    for (doc, _), want in zip(rows, plain_removal([t for _, t in rows], 40)):
        assert got[doc] == want


def test_repeats_of_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    want = Counter((r.doc_id, *w) for r, w in zip(rows, plain_removal([r.text for r in rows], 50)))
    found = repeats.repeated_ranges(odd_docs, least=50, grams=(16, 32))
    assert Counter(tuple(r) for r in repeats.span_counts(found).collect()) == want
    assert repeats.repeated_ranges(no_docs).count() == 0


# -- periodic runs --------------------------------------------------------------------------------


def random_words(rng: np.random.Generator) -> np.ndarray:
    """Random, repeated, nested periodic and Fibonacci words."""
    kind, n, letters = rng.integers(4), int(rng.integers(0, 220)), int(rng.integers(1, 6))
    if kind == 0:
        return rng.integers(0, letters, n)
    if kind == 1:
        parts = [np.tile(rng.integers(0, letters, int(rng.integers(1, 40))), int(rng.integers(1, 8))) for _ in range(4)]
        return np.concatenate(parts)
    if kind == 2:
        inner = np.tile(rng.integers(0, 2, int(rng.integers(1, 5))), int(rng.integers(2, 9)))
        outer = np.tile(np.append(inner, rng.integers(0, 3, int(rng.integers(0, 4)))), int(rng.integers(2, 7)))
        if rng.integers(2):
            outer[rng.integers(len(outer))] = 7
        return np.concatenate([rng.integers(0, 3, 15), outer, rng.integers(0, 3, 15)])
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return np.tile(np.array(b[:n], np.int64), int(rng.integers(1, 4)))


@pytest.mark.parametrize("least,times", [(24, 3), (12, 3), (30, 4)])
def test_runs_match_every_period(least, times):
    rng = np.random.default_rng(5)
    for _ in range(60):
        documents = [random_words(rng).astype(np.int64) for _ in range(6)]
        want = [plain_runs(d.tolist(), least, times) for d in documents]
        assert runs.runs_of(documents, least, times) == want
        maybe = runs.may_have_runs(documents, least - least // 3)
        assert all(m or not w for m, w in zip(maybe, want))


def test_wavelet_tree_counts_and_selects():
    rng = np.random.default_rng(6)
    values = rng.integers(0, 37, 300)
    tree = runs.WaveletTree(values)
    low = rng.integers(0, 299, 200)
    high = low + 1 + rng.integers(0, 300 - low)
    limit = rng.integers(0, 80, 200)
    nth = rng.integers(0, high - low)
    for a, b, x, k, below, value in zip(low, high, limit, nth, tree.below(low, high, limit), tree.nth(low, high, nth)):
        assert below == (values[a:b] < x).sum()
        assert value == np.sort(values[a:b])[k]


def test_runs_of_the_given_table(spark, texts):
    got = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op12_runs"](spark, SF).collect()}
    for doc, text in texts:
        if len((text or "").split()) < 3000:
            assert got[doc] == plain_row(doc, text)


def test_runs_of_odd_rows(odd_docs, no_docs, make_docs):
    found = runs.run_digests(runs.find_runs(odd_docs, rewrite=runs.repeat_tail, chunk_words=20)).collect()
    short = Counter(tuple(r) for r in found if r.doc_id not in (5, 6))
    want = Counter((r.doc_id, *plain_row(r.doc_id, r.text)) for r in odd_docs.collect() if r.doc_id not in (5, 6))
    assert short == want and len(found) == odd_docs.count()
    assert runs.find_runs(no_docs).count() == 0
    # The same extent twice as repetitive, ties, and two runs with one start.
    rows = [(1, "a b " * 30), (2, "a b c " * 9 + "x " + "d e f " * 9), (3, "a " * 30 + "b " + "a " * 30 + "b " + "a " * 30 + "b")]
    for r in runs.run_digests(runs.find_runs(make_docs(rows))).collect():
        text = dict(rows)[r.doc_id]
        found = plain_runs(text.split())
        assert r.n_runs == len(found)
        assert r.collapsed_sha256 == plain_row(None, text)[-1]


def test_many_long_texts_in_one_batch(spark, make_docs):
    """Words are searched in chunks, so a batch of long texts is not one search."""
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 9000, 20_000)) + " z" * 30) for i in range(200)]
    got = runs.find_runs(make_docs(rows), chunk_words=50_000).select("n_words", "start", "length").collect()
    assert {(r.n_words, tuple(r.start), tuple(r.length)) for r in got} == {(20_030, (20_000,), (30,))}


# -- manifest -------------------------------------------------------------------------------------


def test_manifest_of_the_given_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = Counter(tuple(r) for r in entry.queries()["op13_merkle"](spark, SF).collect())
    assert got == plain_manifest(rows)


@pytest.mark.parametrize("sources", [1, 3, 40])
def test_manifest_of_many_sizes(spark, make_docs, sources, monkeypatch):
    """Last runs of one node, single leaves, one source, and more sources than a run holds."""
    rows = [(i, f"T {i}", "en", f"s{i % sources}" if i % 7 else None) for i in range(16 * 17 + 1)]
    docs = make_docs(rows)
    changed = docs["text"].substr(1, 0)
    got = merkle.verified_manifest(docs, docs["doc_id"] < 0, changed).collect()
    want = {k[:5] for k in plain_manifest(docs.collect())}
    assert {tuple(r)[:5] for r in got} == want
    assert all(r.verified and r.folded_root == r.root for r in got)
    told = merkle.verified_manifest(docs, docs["doc_id"] == 5, changed).where("NOT verified").collect()
    assert [r.doc_id for r in told] == [5] and told[0].folded_root != told[0].root


def test_manifest_of_odd_rows(spark, odd_docs, no_docs, make_docs):
    from pyspark.sql import functions as F

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for docs in (odd_docs, make_docs([(1, None, None, None)]), make_docs([(None, "A", None, "é"), (None, "A", None, "z")])):
        got = merkle.verified_manifest(docs, tampered, F.translate("text", upper, upper.lower()))
        assert Counter(tuple(r) for r in got.collect()) == plain_manifest(docs.collect())
    assert merkle.manifest(no_docs).count() == 0


# -- batches of whole texts -----------------------------------------------------------------------


def test_a_function_sees_few_whole_texts_at_once(spark):
    rows = [(i, chr(97 + i % 26) * 100_000) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)

    def make():
        def step(batch):
            size = sum(len(t) for t in batch.column(1).to_pylist())
            return {"doc_id": batch.column(0), "size": [size] * len(batch)}

        return step

    got = map_batches(docs, make, "doc_id bigint, size bigint").collect()
    assert sorted(r.doc_id for r in got) == list(range(200))
    assert max(r.size for r in got) <= PIECE_BYTES


def test_pieces_cover_a_batch():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * PIECE_BYTES, None, "y"] * 3})
    assert [t for p in pieces(batch) for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert [len(p) for p in pieces(batch.slice(0, 0))] == [0]


def test_spark_sends_few_whole_texts_at_once(spark):
    """Also to operators that read Spark's batches as they come: counted in the worker, not in pieces."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = [(i, chr(97 + i % 26) * 100_000) for i in range(200)] + [(200, "x" * (2 * PIECE_BYTES))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64m")
        exact_dedup.exact_duplicates(docs)
        got = docs.select(text_or_empty()).mapInArrow(sizes, "n bigint, size bigint").collect()
        assert sum(r.n for r in got) == len(rows)
        assert max(r.size for r in got if r.n > 1) <= 3 * PIECE_BYTES  # the long text may end a batch
        assert sorted(r.size for r in got)[-2] <= PIECE_BYTES + 200_000
        spark.conf.set(key, "1m")
        small_batches(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)
