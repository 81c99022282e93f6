"""Group-bys and whole-table statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.values import ratio
from wattloom.operators.columns import numeric_columns, quoted


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _grouped(df: DataFrame, keys: Sequence[str], drop_null_keys: bool) -> DataFrame:
    return df.na.drop(subset=list(keys)) if drop_null_keys else df


def group_mean(
    df: DataFrame, keys: str | Sequence[str], column: str, name: str | None = None, drop_null_keys: bool = False
) -> DataFrame:
    ks = _keys(keys)
    return _grouped(df, ks, drop_null_keys).groupBy(*ks).agg(F.avg(quoted(column)).alias(name or column))


def group_sum(
    df: DataFrame, keys: str | Sequence[str], columns: str | Sequence[str], drop_null_keys: bool = False
) -> DataFrame:
    ks = _keys(keys)
    sums = [F.sum(quoted(c)).alias(c) for c in _keys(columns)]
    return _grouped(df, ks, drop_null_keys).groupBy(*ks).agg(*sums)


def group_count(df: DataFrame, key: str, column: str, drop_null_keys: bool = True) -> DataFrame:
    """Non-null values per key."""
    return _grouped(df, [key], drop_null_keys).groupBy(key).agg(F.count(quoted(column)).alias(column))


def group_count2(df: DataFrame, category: str, hue: str) -> DataFrame:
    return df.groupBy(category, hue).count()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counts = df.where(F.col(quoted(column)).isNotNull()).groupBy(column).count()
    return counts.orderBy(F.desc("count"), F.asc(quoted(column)))


def distinct(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[quoted(c) for c in columns]).distinct()


def row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row table; use ``df.count()`` for a number."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def global_stats(df: DataFrame, column: str) -> DataFrame:
    c = F.col(quoted(column))
    return df.agg(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"))


def group_mean_all_numeric(df: DataFrame, keys: str | Sequence[str], drop_null_keys: bool = True) -> DataFrame:
    """Mean of every numeric column per group."""
    ks = _keys(keys)
    means = [F.avg(quoted(c)).alias(c) for c in numeric_columns(df) if c not in ks]
    return _grouped(df, ks, drop_null_keys).groupBy(*[quoted(k) for k in ks]).agg(*means)


def trend_mean_ci(df: DataFrame, x: str, y: str) -> DataFrame:
    """Mean of y per x with a normal 95% interval; a single value has no interval."""
    value = F.col(quoted(y))
    half = F.lit(1.96) * ratio(F.stddev_samp(value), F.sqrt(F.count(value)))
    return df.groupBy(quoted(x)).agg(
        F.avg(value).alias("mean"),
        (F.avg(value) - half).alias("ci_low"),
        (F.avg(value) + half).alias("ci_high"),
    )


#: P(X <= k) of a Poisson variable of mean 1, for k = 0, 1, ..., in 65,536ths.
_POISSON = tuple(round(65536 * math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1))) for k in range(8))


def bootstrap_weights(df: DataFrame, key: str, replicates: int, output: str, seed: int = 42) -> DataFrame:
    """Add an array of how often each replicate draws the row: Poisson numbers of mean 1, fixed by a hash of the row's key alone.

    One MD5 gives sixteen bits for each of eight replicates.
    """
    name = F.coalesce(F.col(quoted(key)).cast("string"), F.lit(""))
    hashes = F.array(*[F.md5(F.concat(F.lit(f"{seed}:{block}:"), name).cast("binary")) for block in range(-(-replicates // 8))])
    draws = F.flatten(F.transform(hashes, lambda h: F.array(*[F.substring(h, 4 * i + 1, 4) for i in range(8)])))
    # Four hexadecimal digits in lower case stand in the order of their numbers, so none is converted.
    limits = [f"{limit:04x}" for limit in _POISSON if limit < 65536]

    def times(draw: Column) -> Column:
        below = F.when(draw < limits[0], 0)
        for k, limit in enumerate(limits[1:], 1):
            below = below.when(draw < limit, k)
        return below.otherwise(len(limits))

    return df.withColumn(output, F.transform(F.slice(draws, 1, replicates), times))


def bootstrap_mean_ci(
    df: DataFrame, x: str, y: str, key: str, replicates: int = 200, level: float = 0.95, seed: int = 42
) -> DataFrame:
    """Mean of y per x with a percentile bootstrap interval.

    A Poisson bootstrap: each replicate weighs every row by its own number, so all replicates are plain sums of one
    aggregate (two numbers a replicate from each task) and no row is ever copied or drawn on one machine. The result is the same on
    any partitioning. A replicate that draws no row of a group is left out of its interval. ``key`` names a row.
    """
    rows = df.select(F.col(quoted(x)).alias("_x"), F.col(quoted(y)).cast("double").alias("_y"), F.col(quoted(key)).alias("_key"))
    rows = bootstrap_weights(rows.where(F.col("_y").isNotNull()), "_key", replicates, "_w", seed).drop("_key")
    weights = [F.get("_w", F.lit(b)) for b in range(replicates)]
    sums = rows.groupBy("_x").agg(
        F.avg("_y").alias("mean"),
        F.array(*[F.sum(w * F.col("_y")) for w in weights]).alias("_sums"),
        F.array(*[F.sum(w) for w in weights]).alias("_counts"),
    )
    means = F.zip_with("_sums", "_counts", lambda total, n: F.when(n > 0, total / n))
    ordered = sums.withColumn("_means", F.array_sort(F.filter(means, lambda m: m.isNotNull())))

    def at(p: float) -> Column:
        place = F.lit(p) * (F.size("_means") - 1)
        low, high = (F.get("_means", f(place).cast("int")) for f in (F.floor, F.ceil))
        return low + (place - F.floor(place)) * (high - low)

    tail = (1 - level) / 2
    return ordered.select(F.col("_x").alias(x), "mean", at(tail).alias("ci_low"), at(1 - tail).alias("ci_high"))


def hourly_actual_vs_potential(
    df: DataFrame, group: str, ts: str, actual: str, potential: str
) -> DataFrame:
    """Mean actual, mean potential and actual - potential per group and hour of day."""
    return (
        df.groupBy(quoted(group), F.hour(quoted(ts)).alias("hour"))
        .agg(F.avg(quoted(actual)).alias("actual"), F.avg(quoted(potential)).alias("potential"))
        .withColumn("difference", F.col("actual") - F.col("potential"))
    )


def word_freq(df: DataFrame, column: str, stop_words: Sequence[str] = ()) -> DataFrame:
    """How often each lower-cased word of any script occurs; words are counted in each task before the shuffle."""
    words = df.select(F.explode(F.split(F.lower(quoted(column)), r"(?U)\W+")).alias("word"))
    words = words.where(F.col("word") != "")
    if stop_words:
        words = words.where(~F.col("word").isin(list(stop_words)))
    return words.groupBy("word").count()


def rmse(actual: str | Column, predicted: str | Column) -> Column:
    """Root mean squared error, as an aggregate expression."""
    a = F.col(quoted(actual)) if isinstance(actual, str) else actual
    p = F.col(quoted(predicted)) if isinstance(predicted, str) else predicted
    return F.sqrt(F.avg((a - p) * (a - p)))


def rmse_pct_of_mean(actual: str, predicted: str) -> Column:
    """Root mean squared error in percent of the mean actual value."""
    return ratio(rmse(actual, predicted), F.avg(quoted(actual))) * F.lit(100.0)
