"""Filling missing values.

Statistics come from one aggregate that is attached as a scalar subquery: Spark runs it once and
hands the result to every task as a value, so filling adds no join and no shuffle of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.operators.columns import quoted


def with_statistics(
    df: DataFrame, statistics: Mapping[str, Column], source: DataFrame | None = None, name: str = "_s"
) -> DataFrame:
    """Add one struct column holding named aggregates over ``source`` (the table itself by default)."""
    record = F.struct(*[e.alias(n) for n, e in statistics.items()])
    return df.withColumn(name, (source if source is not None else df).agg(record.alias(name)).scalar())


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL and NaN by constants."""
    return df.na.fill(dict(values))


def fill_label(df: DataFrame, column: str, label: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(quoted(column)), F.lit(label)))


def fill_stat(df: DataFrame, statistics: Mapping[str, Column], source: DataFrame | None = None) -> DataFrame:
    """Fill each column with an aggregate expression over ``source`` (the table itself by default)."""
    known = with_statistics(df, statistics, source)
    filled = {c: F.coalesce(_no_nan(df, c), F.col("_s").getField(c)) for c in statistics}
    return known.withColumns(filled).drop("_s")


def fill_mean(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Fill with the mean of the whole column."""
    names = [columns] if isinstance(columns, str) else list(columns)
    return fill_stat(df, {c: F.avg(_no_nan(df, c)) for c in names})


def fill_mode(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Fill with the most frequent value, the smallest one on ties.

    Counts are taken per (column, value), so no task holds all the distinct values of a column.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    filled = {}
    for c in names:
        counts = df.where(F.col(quoted(c)).isNotNull()).groupBy(F.col(quoted(c)).alias("_v")).count()
        mode = counts.agg(F.min_by("_v", F.struct(-F.col("count"), F.col("_v")))).scalar()
        filled[c] = F.coalesce(F.col(quoted(c)), mode)
    return df.withColumns(filled)


def _no_nan(df: DataFrame, column: str) -> Column:
    value = F.col(quoted(column))
    if df.schema[column].dataType.typeName() in ("double", "float"):
        return F.when(~F.isnan(value), value)
    return value
