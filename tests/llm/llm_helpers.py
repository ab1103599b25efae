"""Fixtures and plain helpers of these tests."""

import duckdb
import pytest

SF_SMALL = "/root/testdata/sf0.001"

LONG = "word " * 60_000 + "x" * 30_000


@pytest.fixture(scope="session")
def documents():
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    return dict(rows)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like results."""
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, LONG), (6, "one two three"),
        (6, "one two three"), (6, "other words here now"), (None, "one two three"), (None, None),
        (7, "Ünïcode 中文 text <|endoftext|> 'll"), (8, "one two three"),
    ]
    rows = [(i, t, "en", "src", None, 1, "fp", 2.0, "w", 3) for i, t in rows]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, shard int, fp string,"
        " score double, word string, n_tokens long"
    )
    return spark.createDataFrame(rows, schema)


class Union:
    """Smallest member of each set."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
