"""Text functions on columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattloom.functions.values import as_column


def replace_prefix(c: str | Column, old: str, new: str) -> Column:
    """Replace a leading ``old`` by ``new``."""
    return F.regexp_replace(as_column(c), "^" + re.escape(old), new.replace("\\", "\\\\").replace("$", "\\$"))


def concat_label(a: str | Column, b: str | Column, sep: str = ": ") -> Column:
    """a + sep + b; NULL if either is NULL."""
    return F.concat(as_column(a), F.lit(sep), as_column(b))


def strip_unit(c: str | Column) -> Column:
    """Drop surrounding blanks and the signs % and °, then read an integer."""
    return F.regexp_replace(F.trim(as_column(c)), "[%°]", "").try_cast("int")


def clean_reading(readings: str | Column) -> Column:
    """One figure from an array of one or two readings such as ``['40%', '60%']``; NULL otherwise."""
    numbers = F.transform(as_column(readings), strip_unit)
    return (
        F.when(F.size(numbers) == 2, (numbers[0] + numbers[1]) / F.lit(2.0))
        .when(F.size(numbers) == 1, F.get(numbers, F.lit(0)).cast("double"))
    )
