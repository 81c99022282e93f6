"""Casts, arithmetic, flags and lookups on columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_numeric(c: str | Column) -> Column:
    """Text to double; what cannot be read, and NaN, become NULL."""
    number = as_column(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b with NULL for a zero divisor."""
    return F.try_divide(as_column(a), as_column(b))


def flag_when(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is unknown)."""
    return F.when(condition, 1).otherwise(0)


def map_values(c: str | Column, table: Mapping[str, object]) -> Column:
    """Look each value up in a literal table; values without an entry become NULL."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), as_column(c))


def map_values_2level(c: str | Column, first: Mapping[str, str], second: Mapping[str, object]) -> Column:
    """Two lookups in a row, composed into one table when the plan is built."""
    return map_values(c, {key: second[mid] for key, mid in first.items() if mid in second})


def guarded_product(a: str | Column, b: str | Column) -> Column:
    """a * b, NULL when either is NULL or b is zero."""
    return as_column(a) * F.nullif(as_column(b), F.lit(0.0))


def round_half_even(c: str | Column, digits: int = 2) -> Column:
    return F.bround(as_column(c), digits)


def max_of_values(c: str | Column) -> Column:
    """Largest value of a map."""
    return F.array_max(F.map_values(as_column(c)))


def min_of_values(c: str | Column) -> Column:
    """Smallest value of a map."""
    return F.array_min(F.map_values(as_column(c)))


def field(c: str | Column, path: str) -> Column:
    """A value inside nested structs or maps, by dotted path; a missing map key gives NULL."""
    value = as_column(c)
    for name in path.split("."):
        value = value[name]
    return value
