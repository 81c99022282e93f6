"""Exact quantiles that never gather a group: two scans and a window over a few candidates.

The first scan keeps a mergeable rank sketch for each group and column. The sketch's error is at most ``1 / accuracy`` of the
rows, so asked a little below and a little above each wanted rank it gives a bracket that must hold the rank's value. The second
scan counts: a value inside a bracket by value, all values between two brackets as one. Both counts are summed in each
task first. What is left for a group is one row for each gap and for each different value in a bracket, at most about
``8 / accuracy`` of the rows for each rank, whatever the distribution; a running sum over those finds the ranks. A group of
fewer than ``_SMALL`` sketch errors is bracketed whole. A rank outside its bracket would be an error, never a wrong figure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.operators.columns import quoted
from wattloom.operators.joins import attach

ACCURACY = 10_000
_SMALL = 2  # times ``accuracy`` rows


def quantiles(
    df: DataFrame,
    columns: str | Sequence[str],
    probs: Sequence[float] = (0.25, 0.5, 0.75),
    keys: Sequence[str] = (),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Linearly interpolated quantiles in long form: keys, variable, prob, value.

    NULL and NaN are left out; a group without values yields no row. Both scans read only the named columns.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    wanted = [float(p) for p in probs]
    key_columns = [quoted(k) for k in keys]
    data = df.select(
        *key_columns,
        *[_finite(F.col(quoted(c)).cast("double")).alias(f"_c{i}") for i, c in enumerate(names)],
    )
    state = data.groupBy(*key_columns).agg(*[_brackets(f"_c{i}", wanted, accuracy).alias(f"_b{i}") for i in range(len(names))])
    part = [*key_columns, "_i"]
    below = F.sum("_rows").over(Window.partitionBy(*part).orderBy("_from").rowsBetween(Window.unboundedPreceding, -1))
    placed = (
        _counted(data, state, keys, len(names), len(wanted))
        .withColumn("_below", F.coalesce(below, F.lit(0)))
        .withColumn("_upto", F.col("_below") + F.col("_rows"))
    )
    # A quantile lies between two neighbouring ranks, counted from zero.
    position = [F.lit(p) * (F.col("_n") - 1) for p in wanted]
    ranks = [r for x in position for r in (F.floor(x), F.ceil(x))]
    value = F.coalesce("_x", F.raise_error(F.lit("a rank lies outside its bracket")).cast("double"))
    found = placed.groupBy(*part, "_n").agg(
        *[F.max(F.when((F.col("_below") <= r) & (F.col("_upto") > r), value)).alias(f"_r{j}") for j, r in enumerate(ranks)]
    )
    results = []
    for j, p in enumerate(wanted):
        low, high = F.col(f"_r{2 * j}"), F.col(f"_r{2 * j + 1}")
        x = F.lit(p) * (F.col("_n") - 1)
        results.append(F.struct(F.lit(p).alias("prob"), (low + (x - F.floor(x)) * (high - low)).alias("value")))
    variable = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("_i") + 1)
    return found.select(*key_columns, variable.alias("variable"), F.inline(F.array(*results)))


def _finite(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def _brackets(column: str, probs: Sequence[float], accuracy: int) -> Column:
    """The number of values and, for each quantile, a value at or below its lower rank and one at or above its upper rank.

    A quantile's ranks and the sketch's idea of it differ by two ranks at most, and the sketch by one error; in a group of
    ``_SMALL`` errors' rows or more, three errors cover both.
    """
    margin = 3.0 / accuracy
    asked = [q for p in probs for q in (max(0.0, p - margin), min(1.0, p + margin))]
    small, answers = F.count(column) < _SMALL * accuracy, F.percentile_approx(column, asked, accuracy)
    ends = [F.when(small, end).otherwise(answers[2 * j + k]).alias(f"_{'lh'[k]}{j}") for j in range(len(probs)) for k, end in enumerate((F.min(column), F.max(column)))]
    return F.struct(F.count(column).alias("_n"), *ends)


def _counted(data: DataFrame, state: DataFrame, keys: Sequence[str], columns: int, brackets: int) -> DataFrame:
    """(keys, _i, _n, _x, _from, _rows): rows by value inside brackets, and by the gap between brackets elsewhere, where ``_x`` is NULL."""
    key_columns = [quoted(k) for k in keys]
    if keys:
        wide = attach(data, state, keys)
    else:
        wide = data.withColumn("_state", state.select(F.struct(*state.columns)).scalar())
        wide = wide.select(*data.columns, "_state.*")
    entries = []
    for i in range(columns):
        x, low, high = F.col(f"_c{i}"), [F.col(f"_b{i}._l{j}") for j in range(brackets)], [F.col(f"_b{i}._h{j}") for j in range(brackets)]
        inside = (x >= low[0]) & (x <= high[0])
        gap = (x > high[0]).cast("int")
        for a, b in zip(low[1:], high[1:]):
            inside, gap = inside | ((x >= a) & (x <= b)), gap + (x > b).cast("int")
        entries.append(F.struct(F.lit(i).alias("_i"), F.col(f"_b{i}._n").alias("_n"), x.alias("_from"), F.when(inside, x).alias("_x"), F.when(~inside, gap).alias("_gap")))
    long = wide.select(*key_columns, F.inline(F.array(*entries))).where("_from IS NOT NULL")
    return long.groupBy(*key_columns, "_i", "_n", "_x", "_gap").agg(F.min("_from").alias("_from"), F.count(F.lit(1)).alias("_rows"))


def approximate_quantiles(
    df: DataFrame, column: str, probs: Sequence[float], keys: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """Sketched quantiles in one pass, for when an exact figure is not needed."""
    wanted = [float(p) for p in probs]
    key_columns = [quoted(k) for k in keys]
    found = df.groupBy(*key_columns).agg(F.percentile_approx(quoted(column), wanted, accuracy).alias("_q"))
    rows = [F.struct(F.lit(p).alias("prob"), F.col("_q")[j].alias("value")) for j, p in enumerate(wanted)]
    return found.select(*key_columns, F.inline(F.array(*rows)))
