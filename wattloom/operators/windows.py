"""Lags, rolling windows and shares of a group."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wattloom.functions.values import ratio
from wattloom.operators.columns import quoted
from wattloom.operators.joins import attach

Feature = Callable[[WindowSpec], Column]


def lag_of(column: str, k: int = 1) -> Feature:
    """The value k rows back."""
    return lambda w: F.lag(column, k).over(w)


def rolling(column: str, n: int, fn: Callable[[Column], Column] = F.sum, min_periods: int = 1) -> Feature:
    """Aggregate over this row and the n-1 rows before it; NULL until ``min_periods`` values are seen."""

    def over(w: WindowSpec) -> Column:
        frame = w.rowsBetween(-(n - 1), 0)
        result = fn(F.col(quoted(column))).over(frame)
        if min_periods <= 1:
            return result
        return F.when(F.count(quoted(column)).over(frame) >= min_periods, result)

    return over


def rolling_sum(column: str, n: int) -> Feature:
    return rolling(column, n, F.sum)


def rolling_mean(column: str, n: int) -> Feature:
    return rolling(column, n, F.avg)


def rolling_std(column: str, n: int) -> Feature:
    return rolling(column, n, F.stddev_samp)


def rolling_mean_full(column: str, n: int) -> Feature:
    """Mean of the last n rows, NULL unless all n hold a value."""
    return rolling(column, n, F.avg, min_periods=n)


def trend(rolled: str | Column, lagged: str | Column) -> Column:
    """An n-row sum less the previous row's value."""
    a = F.col(rolled) if isinstance(rolled, str) else rolled
    b = F.col(lagged) if isinstance(lagged, str) else lagged
    return a - b


def relative_change(lagged: str, current: str) -> Column:
    """(previous - current) / (previous + 1)."""
    return ratio(F.col(lagged) - F.col(current), F.col(lagged) + F.lit(1))


def window_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    features: Mapping[str, Feature],
    chunk: Column | None = None,
    lookback: int = 0,
) -> DataFrame:
    """Add window columns per series, all over one sort.

    ``order`` must order the rows of a series uniquely. Without ``chunk`` a series is handled by one
    task, which suits series bounded by a calendar (one row per household and day). For series that can
    grow without bound give ``chunk``, an expression that never decreases along ``order`` (the hour or
    day of a timestamp, say), and ``lookback``, the number of earlier rows any feature reaches. Every series is
    then cut: each chunk is handled on its own, after the last ``lookback`` rows before it are copied in.
    """
    if chunk is None:
        spec = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({name: make(spec) for name, make in features.items()})

    rows = df.withColumn("_chunk", chunk)
    both = rows.withColumn("_carried", F.lit(False))
    if lookback > 0:
        carried = _carried_rows(rows, keys, order, lookback)
        both = both.unionByName(carried.withColumn("_carried", F.lit(True)))
    spec = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    done = both.withColumns({name: make(spec) for name, make in features.items()})
    return done.where(~F.col("_carried")).drop("_carried", "_chunk")


def _carried_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str], depth: int) -> DataFrame:
    """For each chunk, the last ``depth`` rows of the chunks before it, labelled with that chunk."""
    part = [*keys, "_chunk"]
    latest = Window.partitionBy(*part).orderBy(*[F.col(o).desc() for o in order])
    whole_row = F.struct(*[F.col(quoted(c)) for c in rows.columns if c != "_chunk"])
    tails = (
        rows.withColumn("_back", F.row_number().over(latest))
        .where(F.col("_back") <= depth)
        .groupBy(*part)
        .agg(F.sort_array(F.collect_list(F.struct(-F.col("_back"), whole_row.alias("_row")))).alias("_tail"))
    )
    # A chunk has at least one row, so the last `depth` chunks always hold enough of them.
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(-depth, -1)
    earlier = F.flatten(F.collect_list("_tail").over(before))
    carried = tails.select("_chunk", earlier.alias("_rows")).select(
        "_chunk",
        F.explode(
            F.slice("_rows", F.greatest(F.size("_rows") - depth, F.lit(0)) + 1, F.lit(depth))
        ).alias("_entry"),
    )
    return carried.select("_entry._row.*", "_chunk")


def calendar_lag(df: DataFrame, keys: Sequence[str], day: str, column: str, k: int, name: str) -> DataFrame:
    """The value exactly k calendar days back, NULL when that day is missing.

    Needs one row per key and day.
    """
    earlier = df.select(
        *keys, F.date_add(F.col(day), k).alias(day), F.col(quoted(column)).alias(name)
    )
    return df.join(earlier, [*keys, day], "left")


def share_of_group(
    df: DataFrame, keys: Sequence[str], value: str, total: str = "Total", share: str = "Percentage"
) -> DataFrame:
    """Add the group's total and each row's fraction of it.

    Totals are aggregated first and joined back, because a window would bring each whole group into one
    task. NULL keys form a group; a zero total gives a NULL fraction.
    """
    totals = df.groupBy(*[quoted(k) for k in keys]).agg(F.sum(quoted(value)).alias(total))
    return attach(df, totals, keys).withColumn(share, ratio(F.col(quoted(value)), F.col(total)))
