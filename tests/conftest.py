"""Session and small-table helpers."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="wattloom-warehouse-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """``table("a INT, b STRING", (1, "x"), ...)``."""

    def make(schema: str, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def values(df, *columns):
    """The rows as a list of tuples, sorted with NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
