from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from matchlake.llm.scratch import prepare  # noqa: E402


@pytest.fixture(scope="session")
def session(spark):
    prepare(spark)
    return spark


DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_documents(session):
    """Nulls, empty and long texts, repeated rows, near and exact copies, a clashing extra column."""
    base = " ".join(f"word{i}" for i in range(120))
    near = base.replace("word60", "other")
    long_ = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, near, "en", "b", 1), (4, None, "en", "b", 1), (5, "", None, None, 1),
        (6, "  \t\n ", "de", "c", 1), (7, "one two", "de", "c", 1), (8, "One TWO", "de", None, 1), (9, long_, "de", "a", 1),
        (10, "12345 678 !!", "fr", "a", 1), (11, "x", "fr", "d", 1), (11, "x", "fr", "d", 1), (None, base, "en", None, 1), (None, "null id", None, "d", 1),
        (12, "é ü ß 日本語 　 text ▁ piece <|endoftext|> </s>", "fr", "d", 1), (13, base + " tail", "en", "é", None),
    ]
    extra = session.createDataFrame([(*r, "x") for r in rows], DOC + ", size string")
    return extra


@pytest.fixture(scope="session")
def no_documents(session):
    return session.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def documents(session):
    return session.read.parquet("/root/testdata/sf0.001/documents.parquet")
