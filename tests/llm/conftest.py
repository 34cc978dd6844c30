from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " ref bigint, n string, text_sha256 string, cells string, __found int, size string, label int"
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A table of documents from (id, text) or (id, text, lang, source) rows, with extra columns
    whose names the operators use themselves."""

    def make(rows):
        full = [(*r, *("en", "web")[len(r) - 2 :])[:4] + (7,) * 2 + ("x",) * 3 + (3, "y", 1) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i}" for i in range(30_000))
    return make_docs(
        [
            (1, "a b c d e f g h"), (2, "a b c d e f g h"), (2, "a b c d e f g h"), (3, None), (4, ""),
            (5, long), (6, long + " end"), (7, " \t\n"), (8, "Ünï çödé 漢字 😀 e\u0301"), (9, "one two"),
            (10, "one two", None, None), (None, "a b c d e f g h", None, "s"), (11, "x" * 200_000),
            (12, "1" * 50_000), (13, "<|endoftext|> a<|endoftext|>"), (None, None, None, None),
        ]
    )


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 9)] + [(None, 1, 1), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def texts():
    """Documents of the smallest given table."""
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
