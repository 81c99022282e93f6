"""Table profile: shape, summary, gaps, correlations and distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from wattloom.operators.columns import numeric_columns
from wattloom.operators.profiling import (
    box_stats,
    corr_matrix,
    describe,
    histogram,
    null_counts,
    table_shape,
)

PARTS = ("shape", "describe", "nulls", "correlations", "boxes", "histograms")


def table_profile(
    df: DataFrame, columns: Sequence[str] | None = None, parts: Sequence[str] = PARTS, bins: int = 30
) -> dict[str, DataFrame]:
    """The chosen parts of a profile by name, over the numeric columns unless some are named.

    Each part is a lazy table of its own; the histograms are named ``histogram_`` and the column.
    """
    numeric = list(columns) if columns is not None else numeric_columns(df)
    makers = {
        "shape": lambda: {"shape": table_shape(df)},
        "describe": lambda: {"describe": describe(df, numeric)},
        "nulls": lambda: {"nulls": null_counts(df)},
        "correlations": lambda: {"correlations": corr_matrix(df, numeric)},
        "boxes": lambda: {"boxes": box_stats(df, numeric)},
        "histograms": lambda: {f"histogram_{c}": histogram(df, c, bins) for c in numeric},
    }
    found: dict[str, DataFrame] = {}
    for part in parts:
        found.update(makers[part]())
    return found
