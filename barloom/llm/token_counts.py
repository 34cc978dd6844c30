"""Token counts by a map-side two-tier lookup.

A byte-level BPE cuts a text into pre-tokens that are encoded on their own, so a text's token count
is the sum of its pre-tokens' lengths. Tier one is a broadcast table of the lengths of frequent
pre-tokens; tier two is a cache in each Python worker that encodes what the table lacks. No
pre-token is shuffled: the table comes from one bounded summary per task.

* Every document is read and counted whole. The table decides speed alone: with an empty table all
  counts are the same.
* A text that holds an added token of the tokenizer, or a character whose class differs between
  Unicode versions, is given to the library as it is.
* Null and empty texts have no bytes and no tokens. Very long texts are cut into pre-tokens as others
  are, and counted whole. Ties between frequent pre-tokens change the table, not a count. Repeated rows
  are counted each. An empty table
  of documents gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import map_batches, text_or_empty

#: Fixed value: the published split pattern of this tokenizer family.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose letter, number and space classes agree in all Unicode versions in use here.
_UNSURE = re.compile(
    r"[^\u0000-\u0557\u0590-\u0870\u2000-\u207f\u20a0-\ua7c0\uac00-\ud7a0\uf900-\uffff]"
)

#: Rows of the broadcast table, and words that a task's summary may hold.
TABLE_ROWS = 16_384
SUMMARY_WORDS = 100_000
#: Pre-tokens that a worker's cache may hold before it starts anew.
CACHE_ROWS = 400_000


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _added_tokens(path: str) -> tuple[str, ...]:
    with open(path, encoding="utf-8") as f:
        return tuple(t["content"] for t in json.load(f)["added_tokens"])


def _unsure(text: str) -> bool:
    return not text.isascii() and _UNSURE.search(text) is not None


def _byte_of() -> dict[str, int]:
    """Bytes behind the printable characters of a byte-level vocabulary, by its published rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}


class TokenIds:
    """Ids of whole texts as the tokenizer gives them.

    Where ids follow the order of the merges, the vocabulary is also a table of ranks, which
    another library encodes several times faster, to the same ids. Texts with added tokens or
    with characters whose class differs between Unicode versions go to the tokenizer itself, and
    so do all texts of a vocabulary in another order.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        self.tokenizer, self.added = _tokenizer(path), _added_tokens(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte_of = _byte_of()
        known = {w: i for w, i in model["vocab"].items() if w not in self.added}
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.fast = None
        if [known[m] for m in merges] == list(range(256, 256 + len(merges))):
            ranks = {bytes(byte_of[c] for c in w): i for w, i in known.items()}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={}
            )

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or _unsure(text) or any(t in text for t in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


class WordSummary:
    """Lossy counting: frequent words of a stream in bounded memory."""

    def __init__(self, most: int) -> None:
        self.most, self.floor, self.counts = most, 0, Counter()

    def add(self, words: list[str]) -> None:
        self.counts.update(words)
        while len(self.counts) > self.most:
            self.floor = self.floor + 1 if self.floor < 4 else self.floor * 2
            self.counts = Counter({w: n for w, n in self.counts.items() if n > self.floor})


def frequent_pre_tokens(docs: DataFrame, text: str = "text", rows: int = TABLE_ROWS) -> list[str]:
    """Frequent pre-tokens of all documents, at most ``rows`` of them.

    Each task sums up its words in a bounded summary and passes on its ``rows`` most frequent ones.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = WordSummary(SUMMARY_WORDS)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                summary.add(value.split(" "))
        top = heapq.nlargest(
            rows, ((n, w) for w, n in summary.counts.items() if w.isalpha() and len(w) <= 64)
        )
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array([w for _, w in top], pa.string()), "n": pa.array([n for n, _ in top], pa.int64())}
        )

    words = (
        docs.select(text_or_empty(text).alias("text"))
        .mapInArrow(summarise, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(rows)
    )
    return [" " + r.word for r in words.collect()]


class PreTokenLengths:
    """Token count of a text from the two tiers."""

    def __init__(self, path: str, table: dict[str, int]) -> None:
        self.tokenizer, self.added = _tokenizer(path), _added_tokens(path)
        self.pattern = regex.compile(PRE_TOKEN)
        self.table, self.cache = table, {}

    def encode(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]

    def count(self, text: str) -> int:
        if _unsure(text) or any(t in text for t in self.added):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        table, cached = self.table, self.cache
        total, misses = 0, []
        for piece in self.pattern.findall(text):
            n = table.get(piece) or cached.get(piece)
            if n:
                total += n
            else:
                misses.append(piece)
        if misses:
            if len(cached) > CACHE_ROWS:
                cached.clear()
            new = list(set(misses))
            cached.update(zip(new, self.encode(new)))
            total += sum(map(cached.__getitem__, misses))
        return total


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 512,
    doc_id: str = "doc_id",
    text: str = "text",
    table_rows: int = TABLE_ROWS,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document."""
    frequent = frequent_pre_tokens(docs, text, table_rows) if table_rows else []
    lengths = PreTokenLengths(tokenizer_path, {})
    table = docs.sparkSession.sparkContext.broadcast(dict(zip(frequent, lengths.encode(frequent))))

    def make():
        counter = PreTokenLengths(tokenizer_path, table.value)

        def step(batch: pa.RecordBatch) -> dict:
            texts = batch.column(1).to_pylist()
            return {
                "doc_id": batch.column(0),
                "n_bytes": batch.column(2),
                "n_tokens": [counter.count(t) for t in texts],
            }

        return step

    whole = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        text_or_empty(text).alias("text"),
        F.octet_length(text_or_empty(text)).cast("bigint").alias("n_bytes"),
    )
    counted = map_batches(whole, make, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
