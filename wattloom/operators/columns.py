"""Projections and reshaping."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from wattloom.functions.values import ratio


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(quoted(c)) for c in columns])


def quoted(name: str) -> str:
    """A column name that is safe to resolve even with dots or spaces in it."""
    return "`" + name.replace("`", "``") + "`"


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*names)


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Drop the columns whose name matches a regular expression from its start."""
    return project(df, [c for c in df.columns if not re.match(pattern, c)])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast in place; a value that does not fit becomes NULL."""
    return df.withColumns({c: F.col(quoted(c)).try_cast(t) for c, t in types.items()})


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add computed columns in one projection."""
    return df.withColumns(dict(columns))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def columns_like(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def unpivot(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "Acorn", value: str = "Value"
) -> DataFrame:
    """Wide to long: one row per id row and value column; NULL values are kept."""
    return df.unpivot(
        [F.col(quoted(c)) for c in ids], [F.col(quoted(c)) for c in values], variable, value
    )


def transpose(
    df: DataFrame,
    key: str,
    keys: Sequence[object],
    columns: Sequence[str],
    variable: str = "variable",
) -> DataFrame:
    """Columns become rows and the values of ``key`` become columns, in one aggregation.

    ``keys`` lists the key values; each should occur once (the first non-null value is taken otherwise).
    """
    long = unpivot(df, [key], columns, variable, "_value")
    return long.groupBy(variable).pivot(key, list(keys)).agg(F.first("_value", ignorenulls=True))


def wide_ratio(
    df: DataFrame,
    efficiency: DataFrame,
    ids: Sequence[str],
    groups: Sequence[str],
    group_key: str,
    current: str,
    potential: str,
    suffix: str = "_Potential",
) -> DataFrame:
    """Add ``{group}{suffix}`` = value * current / potential beside each group column.

    ``efficiency`` has one row per group. The few factors a wide table needs are looked up as one map,
    so the wide table is neither melted nor joined. Groups without a row get NULL.
    """
    factors = (
        efficiency.where(F.col(quoted(group_key)).isin(list(groups)))
        .select(
            F.col(quoted(group_key)).alias("_group"),
            ratio(F.col(quoted(current)), F.col(quoted(potential))).alias("_factor"),
        )
        .where("_factor IS NOT NULL")
        .agg(F.map_from_entries(F.collect_set(F.struct("_group", "_factor"))).alias("_factors"))
        .scalar()
    )
    if missing := [g for g in groups if g not in df.columns]:
        raise ValueError(f"no column for the groups {missing}")
    added = {
        g + suffix: F.col(quoted(g)) * F.try_element_at(F.col("_factors"), F.lit(g)) for g in groups
    }
    known = project(df, [*ids, *groups]).withColumn("_factors", factors)
    return known.withColumns(added).drop("_factors")


def inline_rows(one_row: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into several rows, one per mapping of output names to expressions."""
    structs = [F.struct(*[e.alias(n) for n, e in row.items()]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))
