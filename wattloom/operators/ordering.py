"""Sorting, limits, batches, set operations and splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.operators.columns import quoted
from wattloom.shared import materialize


def order_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.col(quoted(c)) for c in columns])


def order_by_time(df: DataFrame, ts: str, *ties: str) -> DataFrame:
    return order_by(df, ts, *ties)


def top_k(df: DataFrame, column: str, k: int, tie: str) -> DataFrame:
    """The k largest values; each task keeps its own k before they are merged."""
    return df.orderBy(F.desc(quoted(column)), F.asc(quoted(tie))).limit(k)


def limit(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows by ``order``."""
    return order_by(df, *order).limit(n)


def order_by_list(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Rows in the order of a given list; listed values without a row appear with NULLs."""
    listed = [F.struct(F.lit(i).alias("_ordinal"), F.lit(v).alias(column)) for i, v in enumerate(values)]
    frame = df.sparkSession.range(1).select(F.inline(F.array(*listed)))
    rest = [c for c in df.columns if c != column]
    joined = frame.join(df, column, "left").orderBy("_ordinal")
    return joined.select(column, *[F.col(quoted(c)) for c in rest])


def batches(df: DataFrame, key: str, size: int, shards: int) -> DataFrame:
    """Number disjoint slices of at most ``size`` rows: adds the columns shard and batch.

    Rows are spread by a hash of their (unique) key over ``shards`` shards, and each shard is cut into slices in
    key order; all slices of a shard are full except its last. Choose shards that a task can sort.
    """
    spec = Window.partitionBy("shard").orderBy(F.col(quoted(key)))
    numbered = df.withColumn("shard", (_mixed(key, 42) % F.lit(shards)).cast("int"))
    number = F.row_number().over(spec) - 1
    return numbered.withColumn("batch", F.floor(number / F.lit(size)).cast("int"))


def global_rank(df: DataFrame, *columns: str, rank: str = "rank") -> DataFrame:
    """Number all rows from 0 in the order of ``columns``, over any number of tasks.

    Rows are dealt out by ranges of the order and written with their place within their range; the ranges' sizes, one
    row a range, give each range's first number. Rows that are equal in all columns named are numbered in any order.
    """
    kept = df.columns
    order = [F.col(quoted(c)) for c in columns]
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id of a row is its task and its place there
    placed = dealt.withColumn("_id", F.monotonically_increasing_id())
    placed = materialize(placed.withColumns({"_range": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id"), "ranges")
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_range").alias("_of"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    numbered = placed.join(starts, F.col("_range") == F.col("_of"))
    return numbered.select(*[F.col(quoted(c)) for c in kept if c != rank], (F.col("_start") + F.col("_place")).alias(rank))


def slices(df: DataFrame, size: int, *columns: str) -> DataFrame:
    """Cut rows in the order of ``columns`` into numbered slices of exactly ``size`` rows, but for the last: adds ``slice``."""
    ranked = global_rank(df, *columns, rank="_rank")
    return ranked.withColumn("slice", F.floor(F.col("_rank") / F.lit(size)).cast("bigint")).drop("_rank")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of tables with the same columns; duplicates stay."""
    return reduce(DataFrame.unionByName, frames)


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return a.subtract(b)


def split_fraction(key: str, seed: int = 42) -> Column:
    """A number in [0, 1) fixed by the key alone, in thousandths."""
    return (_mixed(key, seed) % F.lit(1000)) / F.lit(1000.0)


def _mixed(key: str, seed: int) -> Column:
    """32 bits of a hash of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(quoted(key)).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def split(df: DataFrame, weights: Sequence[float], key: str, seed: int = 42) -> list[DataFrame]:
    """Disjoint, complete parts in the given proportions.

    The part depends on the key, not on how the rows are spread over tasks, so it is the same after a
    retry and on any cluster.
    """
    total = float(sum(weights))
    edges, running = [0.0], 0.0
    for w in weights:
        running += w
        edges.append(running / total)
    edges[-1] = 1.0
    fraction = split_fraction(key, seed)
    return [df.where((fraction >= lo) & (fraction < hi)) for lo, hi in zip(edges, edges[1:])]
