"""Row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.columns import quoted


def drop_null(df: DataFrame, subset: str | Sequence[str]) -> DataFrame:
    """Drop rows with NULL or NaN in any of the named columns."""
    return df.na.drop(subset=[subset] if isinstance(subset, str) else list(subset))


def drop_null_any(df: DataFrame) -> DataFrame:
    """Keep complete rows only."""
    return df.na.drop("any")


def filter_eq(df: DataFrame, equals: Mapping[str, object]) -> DataFrame:
    """Keep rows that equal every given value."""
    for name, value in equals.items():
        df = df.where(F.col(quoted(name)) == F.lit(value))
    return df


def complete_days(df: DataFrame, count: str = "energy_count", n: int = 48) -> DataFrame:
    """Keep days with exactly ``n`` readings; the count column becomes an integer."""
    return df.withColumn(count, F.col(count).try_cast("int")).where(F.col(count) == n)


def time_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows from ``start`` up to but excluding ``end``; the bounds reach the file scan."""
    kind = df.schema[column].dataType.simpleString()
    low, high = F.lit(start).cast(kind), F.lit(end).cast(kind)
    return df.where((F.col(column) >= low) & (F.col(column) < high))


def filter_in(df: DataFrame, column: str, values: Sequence[object] | DataFrame) -> DataFrame:
    """Keep rows whose value is in a literal list, or in the first column of a table."""
    if isinstance(values, DataFrame):
        wanted = values.select(F.col(quoted(values.columns[0])).alias("_wanted"))
        return df.join(wanted, F.col(quoted(column)) == F.col("_wanted"), "left_semi")
    return df.where(F.col(quoted(column)).isin(list(values)))


def filter_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(quoted(column)).isNotNull())


def one_entity(df: DataFrame, column: str, value: object) -> DataFrame:
    """All rows of one household (or any other key)."""
    return df.where(F.col(quoted(column)) == F.lit(value))
