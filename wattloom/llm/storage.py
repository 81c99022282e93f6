"""Tables written on the way, in the folder that the driver and all executors share."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from wattloom.shared import scratch_path

_ROWS_AT_ONCE = 2_000  # rows of an Arrow batch: texts are long, and batches lie beside Spark's own memory
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, if they see that folder, and bound their batches.

    On a cluster without it, hand the package to the executors with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > _ROWS_AT_ONCE:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_ROWS_AT_ONCE))
    return spark


def write_table(df: DataFrame, path: str, *partitions: str) -> str:
    """Write Parquet to ``path`` (by the given partition columns) and return the path."""
    df.write.partitionBy(*partitions).parquet(path) if partitions else df.write.parquet(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder: cuts lineage and outlives lost executors."""
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, scratch_path(df.sparkSession, label)))


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete tables that this package wrote and nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Tables of one call, deleted when nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        """As ``stored``, and remembered under the label (an earlier table of that label can be dropped with ``drop``)."""
        path = write_table(df, scratch_path(self.spark, label))
        self.paths.setdefault(label, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, label: str, keep: int = 0) -> None:
        """Delete the label's tables but for the last ``keep``."""
        held = self.paths.pop(label, [])
        last = held[len(held) - keep :] if keep else []
        remove(self.spark, *held[: len(held) - len(last)])
        if last:
            self.paths[label] = last

    def clear(self) -> None:
        for label in list(self.paths):
            self.drop(label)


def unused(name: str, columns: list[str]) -> str:
    """``name``, or with a number behind it, so that no column is called that (whatever the case)."""
    taken, out, n = {c.lower() for c in columns}, name, 0
    while out.lower() in taken:
        n += 1
        out = f"{name}{n}"
    return out
