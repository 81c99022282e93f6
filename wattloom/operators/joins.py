"""Equi-joins.

Strategy is left to Catalyst: file-backed dimensions are broadcast when their statistics say they fit,
everything else is a shuffled join whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.dates import parse_mixed_date
from wattloom.operators.columns import quoted


def left_join(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join on columns of the same name; the key comes first in the result."""
    return a.join(b, on=on, how="left")


def left_join_on(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """Left join on differently named keys; the right key is dropped."""
    return _join_on(a, b, a_key, b_key, "left")


def inner_join(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return a.join(b, on=on, how="inner")


def join_instants(a: DataFrame, b: DataFrame, a_ts: str, b_ts: str) -> DataFrame:
    """Inner join on time where the sides differ in type; both become timestamps before the join."""
    left = a.withColumn(a_ts, F.col(a_ts).try_cast("timestamp_ntz"))
    right = b.withColumn(b_ts, F.col(b_ts).try_cast("timestamp_ntz"))
    return _join_on(left, right, a_ts, b_ts, "inner")


def keep_matching(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """Rows of ``a`` whose key occurs in ``b``; repeated keys in ``b`` do not repeat rows."""
    keys = b.select(F.col(quoted(b_key)).alias("_match"))
    return a.join(keys, F.col(quoted(a_key)) == F.col("_match"), "left_semi")


def left_from_dense(dim: DataFrame, facts: DataFrame, dim_key: str, facts_key: str) -> DataFrame:
    """Every row of the dense side, with its facts where there are any; the facts key is kept.

    Facts are the left side of an inner join, so a key with very many facts can be split and a small dense side broadcast;
    rows of the dense side without facts are added from an anti join against the distinct keys of the facts.
    """
    same = F.col(quoted(dim_key)) == F.col(quoted(facts_key))
    found = facts.join(dim, same).select(*[F.col(quoted(c)) for c in (*dim.columns, *facts.columns)])
    bare = dim.join(facts.select(quoted(facts_key)).distinct(), same, "left_anti")
    gaps = [F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields]
    return found.unionAll(bare.select(*[F.col(quoted(c)) for c in dim.columns], *gaps))


def star_join(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Left join a fact table to several dimensions in turn, each on its own key."""
    return reduce(lambda rows, dim: left_join(rows, dim[0], dim[1]), dimensions, fact)


def left_join_default(
    a: DataFrame, b: DataFrame, a_key: str, b_key: str, column: str, default: str
) -> DataFrame:
    """Left join that labels rows without a match."""
    joined = left_join_on(a, b, a_key, b_key)
    return joined.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def unique_lookup(df: DataFrame, key: str, order: str, keep: str = "first") -> DataFrame:
    """One row per key: the first or the last by ``order``; partly aggregated before the shuffle."""
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    pick = F.min_by if keep == "first" else F.max_by
    rest = [c for c in df.columns if c != key]
    row = F.struct(*[F.col(quoted(c)) for c in rest])
    best = df.groupBy(F.col(quoted(key))).agg(pick(row, F.struct(F.col(quoted(order)), row)).alias("_row"))
    return best.select(F.col(quoted(key)), "_row.*").select(*[F.col(quoted(c)) for c in df.columns])


def join_on_dates(a: DataFrame, b: DataFrame, a_text: str, b_text: str, how: str = "inner") -> DataFrame:
    """Join on dates written in mixed text formats; ``a``'s column becomes a date."""
    left = a.withColumn(a_text, parse_mixed_date(a_text))
    right = b.withColumn(b_text, parse_mixed_date(b_text))
    return _join_on(left, right, a_text, b_text, how)


def join_all_entities(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Every household's rows joined to the shared calendar at once."""
    return inner_join(a, b, on)


def join_twice(a: DataFrame, dim: DataFrame, a_key: str, dim_key: str) -> DataFrame:
    """``a`` reduced to the keys of ``dim`` and shown along every row of ``dim``; one join does both."""
    return left_from_dense(dim, a, dim_key, a_key)


def attach(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join where NULL keys match each other; ``b`` has one row per key and adds its other columns."""
    renamed = {k: f"_key_{i}" for i, k in enumerate(keys)}
    right = b.withColumnsRenamed(renamed)
    condition = reduce(
        lambda x, y: x & y, [F.col(quoted(k)).eqNullSafe(F.col(r)) for k, r in renamed.items()]
    )
    return a.join(right, condition, "left").drop(*renamed.values())


def _join_on(a: DataFrame, b: DataFrame, a_key: str, b_key: str, how: str) -> DataFrame:
    right = b.withColumnRenamed(b_key, "_right_key")
    return a.join(right, F.col(quoted(a_key)) == F.col("_right_key"), how).drop("_right_key")
