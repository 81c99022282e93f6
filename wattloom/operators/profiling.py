"""Table profiles: counts, distributions, correlations."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.operators.columns import inline_rows, quoted
from wattloom.operators.imputation import with_statistics
from wattloom.operators.quantiles import quantiles


def _number(column: str) -> Column:
    value = F.col(quoted(column)).cast("double")
    return F.when(~F.isnan(value), value)


def table_shape(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, with the row and column counts beside it."""
    fields = df.schema.fields
    counted = df.agg(F.count(F.lit(1)).alias("_rows"))
    return inline_rows(
        counted,
        [
            {
                "position": F.lit(i),
                "column": F.lit(f.name),
                "type": F.lit(f.dataType.simpleString()),
                "rows": F.col("_rows"),
                "columns": F.lit(len(fields)),
            }
            for i, f in enumerate(fields)
        ],
    )


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, in one scan."""
    counted = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in df.columns])
    return inline_rows(
        counted, [{"column": F.lit(c), "nulls": F.col(quoted(c))} for c in df.columns]
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of numeric columns, one row per column."""
    stats = df.agg(
        *[
            F.struct(
                F.count(_number(c)).alias("count"),
                F.avg(_number(c)).alias("mean"),
                F.stddev_samp(_number(c)).alias("std"),
                F.min(_number(c)).alias("min"),
                F.max(_number(c)).alias("max"),
            ).alias(f"_s{i}")
            for i, c in enumerate(columns)
        ]
    )
    basic = inline_rows(
        stats,
        [
            {"variable": F.lit(c), **{k: F.col(f"_s{i}.{k}") for k in ("count", "mean", "std", "min", "max")}}
            for i, c in enumerate(columns)
        ],
    )
    return basic.join(quartiles(df, columns), "variable", "left").select(
        "variable", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """variable, p25, p50, p75."""
    long = quantiles(df, columns, (0.25, 0.5, 0.75))
    return long.groupBy("variable").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
          for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))]
    )


def _pearson(a: Column, b: Column) -> Column:
    """Pairwise-complete correlation; NULL when either side does not vary.

    That is told by the extremes: merged partial means of equal values can differ in their last bit, and so leave a deviation above 0.
    """
    a_pair, b_pair = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    varies = (F.min(a_pair) < F.max(a_pair)) & (F.min(b_pair) < F.max(b_pair))
    return F.when(varies, F.try_divide(F.covar_pop(a, b), F.stddev_pop(a_pair) * F.stddev_pop(b_pair)))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs in one scan: a, b, corr. Meant for up to some fifty columns."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    once = df.agg(*[_pearson(_number(columns[i]), _number(columns[j])).alias(f"_r{i}_{j}") for i, j in pairs])
    rows = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            rows.append({"a": F.lit(a), "b": F.lit(b), "corr": F.col(f"_r{min(i, j)}_{max(i, j)}")})
    return inline_rows(once, rows)


def corr_with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, ascending."""
    once = df.agg(*[_pearson(_number(c), _number(target)).alias(f"_r{i}") for i, c in enumerate(columns)])
    rows = [{"variable": F.lit(c), "corr": F.col(f"_r{i}")} for i, c in enumerate(columns)]
    return inline_rows(once, rows).orderBy("corr", "variable")


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width counts over the range of the column: bin, lower, upper, count; empty bins included."""
    values = df.select(_number(column).alias("_x")).where("_x IS NOT NULL")
    low, high = F.min("_x"), F.max("_x")
    half = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    edges = values.agg(
        (low - half).alias("lo"), ((high - low + 2 * half) / F.lit(float(bins))).alias("width")
    )
    placed = values.withColumn("_e", edges.select(F.struct("lo", "width")).scalar()).select(
        F.least(F.floor((F.col("_x") - F.col("_e.lo")) / F.col("_e.width")), F.lit(bins - 1)).cast("int").alias("bin")
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    frame = edges.select("lo", "width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("upper"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
    )


def kde(df: DataFrame, column: str, grid: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian density curve with Scott's bandwidth: point, x, density.

    A fast Gauss transform: values fall into boxes one bandwidth wide, and one aggregate sums the first ``_MOMENTS`` powers of
    their distances from the box's middle, so the cost is rows times powers, not rows times points. A box gives its part of the curve
    by a Hermite series at the points within ``_REACH`` bandwidths. The series leaves out less than 1.1 * 0.5^m / sqrt(m!) a row
    at m powers, 4e-13 for 18, and points beyond the reach get less than 1e-17 a row.
    """
    values = df.select(_number(column).alias("_x")).where("_x IS NOT NULL")
    bandwidth = F.nullif(F.stddev_samp("_x"), F.lit(0.0)) * F.pow(F.count("_x"), F.lit(-0.2))
    extent = values.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"), bandwidth.alias("h"), F.count("_x").alias("n")).select(
        "h", "n",
        (F.col("lo") - cut * F.col("h")).alias("start"),
        ((F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / F.lit(float(max(grid - 1, 1)))).alias("step"),
    )
    known = values.withColumn("_e", extent.select(F.struct("h", "start", "step")).scalar())
    z = (F.col("_x") - F.col("_e.start")) / F.col("_e.h")
    boxed = known.select((F.col("_e.step") / F.col("_e.h")).alias("_dz"), F.floor(z).alias("_box"), (z - F.floor(z) - 0.5).alias("_u"))
    power, powers = F.lit(1.0), []
    for _ in range(_MOMENTS):
        powers.append(power)
        power = power * F.col("_u")
    boxes = boxed.groupBy("_box", "_dz").agg(F.array(*[F.sum(x) for x in powers]).alias("_moments"))
    middle = F.col("_box") + 0.5
    first = F.greatest(F.ceil((middle - _REACH) / F.col("_dz")), F.lit(0))
    last = F.least(F.floor((middle + _REACH) / F.col("_dz")), F.lit(grid - 1))
    near = boxes.where(first <= last).select(F.explode(F.sequence(first, last)).alias("_point"), middle.alias("_middle"), "_dz", "_moments")
    t = F.col("_point") * F.col("_dz") - F.col("_middle")
    sums = near.groupBy("_point").agg(F.sum(F.exp(-0.5 * t * t) * _hermite_sum(t)).alias("_mass"))
    frame = extent.select("*", F.posexplode(F.array_repeat(F.lit(0), grid)).alias("point", "_"))
    return frame.join(sums, F.col("point") == F.col("_point"), "left").select(
        "point",
        (F.col("start") + F.col("point") * F.col("step")).alias("x"),
        F.when(F.col("h").isNotNull(), F.coalesce("_mass", F.lit(0.0)) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"),
    )


_MOMENTS, _REACH = 18, 9.0


def _hermite_sum(t: Column) -> Column:
    """The sum of moment m times He_m(t) / m!, by the recursion He_m+1 = t He_m - m He_m-1."""
    start = F.struct(F.lit(0.0).alias("before"), F.lit(1.0).alias("now"), F.lit(1.0).alias("factor"), F.lit(0.0).alias("total"), F.lit(0.0).alias("m"))

    def step(s: Column, moment: Column) -> Column:
        return F.struct(
            s.now.alias("before"), (t * s.now - s.m * s.before).alias("now"), (s.factor / (s.m + 1)).alias("factor"),
            (s.total + moment * s.now * s.factor).alias("total"), (s.m + 1).alias("m"),
        )

    return F.aggregate("_moments", start, step, lambda s: s.total)


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, the most extreme values within 1.5 IQR of the box, and the count beyond them."""
    boxes = {
        f"{p}_{i}": F.max(F.when(F.col("variable") == c, F.col(p)))
        for i, c in enumerate(columns)
        for p in ("p25", "p50", "p75")
    }
    numbers = df.select(*[_number(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    known = with_statistics(numbers, boxes, quartiles(df, columns), "_q")
    stats = []
    for i in range(len(columns)):
        value, q1, q3 = F.col(f"_c{i}"), F.col(f"_q.p25_{i}"), F.col(f"_q.p75_{i}")
        reach = F.lit(1.5) * (q3 - q1)
        inside = (value >= q1 - reach) & (value <= q3 + reach)
        stats.append(
            F.struct(
                F.max(q1).alias("q1"),
                F.max(F.col(f"_q.p50_{i}")).alias("median"),
                F.max(q3).alias("q3"),
                F.min(F.when(inside, value)).alias("whisker_low"),
                F.max(F.when(inside, value)).alias("whisker_high"),
                F.count_if(~inside).alias("outliers"),
            ).alias(f"_s{i}")
        )
    names = ("q1", "median", "q3", "whisker_low", "whisker_high", "outliers")
    return inline_rows(
        known.agg(*stats),
        [{"variable": F.lit(c), **{n: F.col(f"_s{i}.{n}") for n in names}} for i, c in enumerate(columns)],
    )
