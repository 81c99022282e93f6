"""Query registry and access to the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The given Parquet tables as attributes: ``t.orders``, ``t.events`` ..."""

    NAMES = (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
    )

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in Tables.NAMES:
            raise AttributeError(name)
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]


QueryBody = Callable[[Tables], DataFrame]


@dataclass
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


_entries: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryBody], QueryBody]:
    """Register a query; without ``sql`` only its rows are checked."""

    def register(body: QueryBody) -> QueryBody:
        if name in _entries:
            raise ValueError(f"two queries are named {name}")
        _entries[name] = Entry(lambda spark, folder: body(Tables(spark, folder)), sql)
        return body

    return register


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: entry.run for name, entry in _entries.items()}


def all_sql() -> dict[str, str]:
    return {name: entry.sql for name, entry in _entries.items() if entry.sql is not None}
