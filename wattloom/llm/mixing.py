"""Mixing sources to target weights by systematic sampling.

Each source has a target size. A document's expected copies are its source's target over its source's
size. Within a source, documents are put in order of (size, id) and their expected copies summed up along
the order; one offset per source, drawn from the seed, is added; a document is emitted once for each whole
number that its step crosses. As sizes rise along the order, the sizes taken follow the target to within
about one document.

The prefix sum is distributed: rows are dealt by ranges of (source, size, id), ranked within their range,
and shifted by the counts of the ranges before, of which there are as many as partitions and sources. No
task holds a source.

Defined results: NULL text has size 0; NULL source is a source of its own, last in order; documents of
size 0 and sources without words take 0; ranks among equal rows are arbitrary but each gets its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.storage import stored, unused
from wattloom.llm.text import WORD

WEIGHTS = (5, 2, 1)


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: int = 3
) -> DataFrame:
    """(source, source_size, target) of (source, source_size), one row a source.

    Sources in code-point order, NULL last, weigh ``weights`` in turn and share ``share`` of all sizes. No target
    is over ``most`` times its source's size; what is over goes to the others by weight until none is. Such
    targets are min(level * weight, most * size) for one level: taking sources by rising most * size / weight, the
    level is what the sources not yet capped must share, at the first place where it fits.
    """
    # one row a source: the windows below run over the sources, never over documents
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    ranked = sizes.withColumn("_weight", weight.cast("long")).withColumn("_cap", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        ranked.withColumn("_all", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("_weight").over(onward))
        .withColumn("_fits", F.col("_level") <= F.col("_cap") / F.col("_weight"))
        .withColumn("_at", F.row_number().over(by_ratio))
        .withColumn("_level", F.min(F.when(F.col("_fits"), F.struct("_at", "_level"))).over(everything)["_level"])
        .select(
            "source", "source_size",
            F.least(F.coalesce(F.col("_level") * F.col("_weight"), F.col("_cap").cast("double")), F.col("_cap").cast("double")).alias("target"),
        )
    )


def offset(source: Column, seed: int) -> Column:
    """A number from 0 to below 1 for each source, the same in every run with this seed."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\u0000null")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def mix_copies(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: int = 3, seed: int = 7,
    id_column: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken), one row for each row of ``docs``."""
    narrow = docs.select(F.col(id_column).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(
        narrow.repartitionByRange(parts, F.col("source").asc_nulls_last(), "size", "id").withColumn("part", F.spark_partition_id()),
        "mix-order",
    )
    in_parts = dealt.groupBy("source", "part").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("words"))
    targets = source_targets(in_parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        in_parts.withColumn("_before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .select(F.col("source").alias("_source"), F.col("part").alias("_part"), "_before", "source_size", "target")
    )
    rank = F.row_number().over(Window.partitionBy("part", "source").orderBy("size", "id"))
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    upto = lambda n: F.floor(n * F.col("_step") + F.col("_offset"))
    return (
        dealt.withColumn("_rank", rank)
        .join(shifts, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
        .withColumn("_step", step)
        .withColumn("_offset", offset(F.col("source"), seed))
        .withColumn("copies", F.when(F.col("size") > 0, F.least(upto(F.col("_rank")) - upto(F.col("_rank") - 1), F.lit(most).cast("long"))).otherwise(F.lit(0)))
        .select("id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed_rows(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself: each row of ``docs`` once per copy, with ``copy`` counting from 1.

    Rows with equal id, source and size count as one row here.
    """
    copies = mix_copies(docs, seed=seed).where(F.col("copies") > 0).groupBy("id", "source", "size").agg(F.max("copies").alias("_copies"))
    id_, source, size, times, n_words = (unused(c, docs.columns) for c in ("_id", "_source", "_size", "_copies", "_n_words"))
    copies = copies.toDF(id_, source, size, times)
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & F.col("source").eqNullSafe(F.col(source)) & (F.col(n_words) == F.col(size))
    joined = docs.withColumn(n_words, word_count()).join(copies, same)
    return joined.select(*(c for c in docs.columns if c.lower() != "copy"), F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))).alias("copy"))
