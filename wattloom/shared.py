"""The shared scratch folder.

No operator forces a broadcast. Catalyst broadcasts a join side by itself when its size is under
``spark.sql.autoBroadcastJoinThreshold`` (by estimate, or by what adaptive execution has measured), and otherwise plans a
shuffled join whose hot keys adaptive execution splits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where that is unset, a folder in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and gives exact statistics."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
