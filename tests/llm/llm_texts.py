"""Texts and fixtures for the tests of this folder: small documents with the odd cases that every operator has to take."""

from __future__ import annotations

import random
import re

import pytest

from wattloom.llm.storage import importable

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    words = [f"w{rng.randint(0, vocabulary)}x" for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 12]).capitalize() for i in range(0, n, 12))


def fold(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(FOLD))


def odd_rows() -> list[tuple]:
    """NULLs in every column, empty and blank texts, a very long text, ties and repeated rows."""
    texts = [None, "", "  \n\t\n", "one", "Two words", prose(1, 60), prose(1, 60), prose(2, 200), "x" * 5000, prose(3, 20_000), "é ü ß     日本語\n" * 40]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, prose(4, 50), None, None, None), (None, None, None, None, None), (50, prose(5, 90), None, None, 0)]


@pytest.fixture(autouse=True)
def _package_on_workers(spark):
    importable(spark)


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def docs(spark):
    def make(*texts, source="s"):
        return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)], SCHEMA)

    return make
