from __future__ import annotations

import os
import random

import duckdb
import pytest

FOLDER = os.environ.get("LLM_TEST_DIR", "/root/testdata/sf0.01")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(name: str) -> list[tuple]:
    return duckdb.sql(f"SELECT * FROM '{FOLDER}/{name}.parquet'").fetchall()


@pytest.fixture(scope="session")
def documents() -> list[tuple]:
    return rows_of("documents")


def odd_documents() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    rng = random.Random(3)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "Épsilon"]) for _ in range(30_000))
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, " \t\n ", None, "a", 3),
        (4, base, "en", "a", 1),
        (5, base, "en", "b", 1),
        (6, base.upper(), "en", "b", 1),
        (7, base + " thirteen", "en", None, 1),
        (8, long, "en", "a", 1),
        (9, "word", "en", "é", 1),
        (10, "ends with a single odd byte \x00 and \x1f and nbsp\xa0here", "en", "a", 1),
        (11, "x" * 100_000, "en", "c", 1),
        (12, "two words", "en", "c", None),
        (None, "no id here", "en", "c", 1),
        (14, "mail a.b@c.de or 10.0.0.1, +49 30 1234567, 4111 1111 1111 1111 end", "de", "a", 1),
    ]
    return rows + [rows[3], rows[8]]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with extra columns whose names operators use inside."""
    more = [(*r, "s", 1.5, [1], 7) for r in odd_documents()]
    return spark.createDataFrame(more, SCHEMA + ", size string, score double, sig array<int>, rep int")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
