"""Wide tables with the column values given up front, so that no extra job looks for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.operators.columns import quoted


def _list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def listed(column: str, values: Sequence[object]) -> Column:
    """The pivot column; a value that is not listed is an error, NULL too (list ``None`` to give it a column)."""
    c, known = F.col(quoted(column)), [v for v in values if v is not None]
    good = F.coalesce(c.isin(known), F.lit(None in values))
    text = F.concat(F.lit(f"{column} has a value without a column: "), F.coalesce(c.cast("string"), F.lit("NULL")))
    return F.when(good, c).otherwise(F.raise_error(text))


def pivot_mean(
    df: DataFrame, rows: str | Sequence[str], column: str, value: str, values: Sequence[object]
) -> DataFrame:
    """Mean per row key, one column per group; ``None`` in ``values`` gives the column ``null``."""
    known = df.withColumn(column, listed(column, values))
    return known.groupBy(*_list(rows)).pivot(column, list(values)).agg(F.avg(quoted(value)))


def pivot_unique(
    df: DataFrame, index: str | Sequence[str], column: str, value: str, values: Sequence[object]
) -> DataFrame:
    """A grid of single values; two rows for one cell are an error."""
    cell = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"more than one {value} for a cell"))
    ).otherwise(F.max(quoted(value)))
    cells = df.withColumn(column, listed(column, values)).groupBy(*_list(index), column).agg(cell.alias("_cell"))
    return cells.groupBy(*_list(index)).pivot(column, list(values)).agg(F.max("_cell"))


def group_mode(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """Most frequent non-null value per group, the smallest on ties; counted before it is compared."""
    counts = df.where(F.col(quoted(value)).isNotNull()).groupBy(*keys, quoted(value)).count()
    best = F.min_by(quoted(value), F.struct(-F.col("count"), F.col(quoted(value))))
    return counts.groupBy(*keys).agg(best.alias(name or value))


def pivot_mode(
    df: DataFrame, index: str | Sequence[str], column: str, value: str, values: Sequence[object]
) -> DataFrame:
    """Most frequent value per cell."""
    modes = group_mode(df.withColumn(column, listed(column, values)), [*_list(index), column], value, "_mode")
    return modes.groupBy(*_list(index)).pivot(column, list(values)).agg(F.max("_mode"))


def crosstab(df: DataFrame, a: str, b: str, values: Sequence[object]) -> DataFrame:
    """Row counts of a by b, zero where there are none; rows with a NULL on either side are left out."""
    known = df.na.drop(subset=[a, b])
    wide = known.withColumn(b, listed(b, values)).groupBy(a).pivot(b, list(values)).count()
    return wide.na.fill(0, subset=[str(v) for v in values])


def size_unstack(df: DataFrame, key: str, column: str, values: Sequence[object]) -> DataFrame:
    """Row counts per key, one zero-filled column per group."""
    return crosstab(df, key, column, values)
