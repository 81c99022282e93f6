"""Tables to Parquet, CSV, text and the catalog."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.columns import quoted
from wattloom.shared import scratch_path
from wattloom.sources.files import exists, join_files, local_path, part_files, remove_path, rename, touch
from wattloom.sources.readers import NO_VALUE

#: Rows of one CSV file of a key, and files of one writing task.
FILE_ROWS, TASK_FILES = 500_000, 500
#: The characters that Spark writes as their number in the name of a key's folder.
ESCAPED = r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]"


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet, optionally in partition folders.

    With partition columns the rows are first rebalanced on them, so each folder gets few files while
    adaptive execution still splits a folder that is too large for one task.
    """
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed CSV part files in one folder."""
    df.write.mode(mode).option("header", True).csv(path)


def write_single_csv(df: DataFrame, path: str, *order: str) -> None:
    """Exactly one headed CSV file at ``path``, in the order of the columns named.

    Tasks write the parts in parallel, without headers; the file system then joins them in order behind the header: by its own
    concatenation where it has one, else as a stream of bytes, so no task or process ever holds the rows.
    """
    spark = df.sparkSession
    parts = scratch_path(spark, "csv-parts")
    rows = df.orderBy(*[F.col(quoted(c)) for c in order]) if order else df
    rows.write.option("header", False).csv(f"{parts}/rows")
    names = [F.struct(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(df.columns)])]
    spark.range(1).coalesce(1).select(F.inline(F.array(*names))).write.option("header", False).csv(f"{parts}/header")
    files = [f for folder in ("header", "rows") for f in sorted(part_files(spark, f"{parts}/{folder}"))]
    join_files(spark, files, path)
    remove_path(spark, parts)


def write_csv_by_key(df: DataFrame, path: str, key: str, mode: str = "overwrite") -> None:
    """One CSV folder per key value; a key with very many rows is spread over several files.

    To open a file costs more than to fill it, so tasks are dealt by their number of files and not by bytes: a size would put the
    folders of many short keys into few tasks. Hadoop's local file system moreover starts four processes (``chmod``) for every file it
    creates, so on local paths the tasks open the files themselves; names, folders and bytes are those of Spark's own writer.
    """
    spark = df.sparkSession
    counts = df.groupBy(F.col(quoted(key)).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    parts = F.ceil(F.col("_rows") / F.lit(FILE_ROWS))
    found = counts.agg(F.count(F.lit(1)).alias("keys"), F.max(parts).alias("most"), F.sum(parts).alias("files")).first()
    tasks = max(spark.sparkContext.defaultParallelism, -(-(found.files or 0) // TASK_FILES), found.most or 0)
    dealt = df.repartition(tasks, quoted(key))
    if (found.most or 0) > 1:
        long = counts.where(parts > 1).select("_key", parts.alias("_parts"))
        part = F.pmod(F.xxhash64(*[quoted(c) for c in df.columns]), F.coalesce("_parts", F.lit(1))).alias("_part")
        known = df.join(long, F.col(quoted(key)).eqNullSafe(F.col("_key")), "left")
        dealt = known.select(*[quoted(c) for c in df.columns], part).repartition(tasks, quoted(key), "_part").drop("_part")
    writer = dealt.write.mode(mode)
    replaces = mode == "overwrite" and spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    if local_path(spark, path) is None or (exists(spark, path) and not replaces):
        writer.partitionBy(key).option("header", True).csv(path)
        return
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    _write_folders(dealt, local_path(spark, staged), key)
    touch(spark, f"{staged}/_SUCCESS")
    if exists(spark, path):
        remove_path(spark, path)
    rename(spark, staged, path)


def _write_folders(df: DataFrame, root: str, key: str) -> None:
    """A folder per key value under ``root``, each with one headed CSV file of every task that holds the key.

    A file is moved into place when it is complete, under a name that a repeated task gives it again.
    """
    name = key if key in df.columns else next(c for c in df.columns if c.lower() == key.lower())
    others = [c for c in df.columns if c != name]
    header = df.sparkSession.range(1).select(F.to_csv(F.struct(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(others)]))).first()[0]
    value = F.coalesce(F.nullif(F.col(quoted(name)).cast("string"), F.lit("")), F.lit(NO_VALUE))
    line = F.to_csv(F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(others)]))
    if len(others) == 1:  # CSV has no line for a row of nothing but one NULL
        line = F.when(F.col(quoted(others[0])).isNotNull(), line)
    lines = df.select(value.alias("value"), line.alias("line"))
    escaped, run = re.compile(ESCAPED), uuid.uuid4().hex

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        file, attempt = f"part-{task.partitionId():05d}-{run}.csv", f"{root}/_temporary/{task.taskAttemptId()}"
        folder_of = lambda text: escaped.sub(lambda found: f"%{ord(found[0]):02X}", text)
        os.makedirs(f"{root}/_temporary", exist_ok=True)
        here, out, files = None, None, 0

        def close() -> None:
            folder = f"{root}/{folder_of(key)}={folder_of(here)}"
            out.close()
            os.makedirs(folder, exist_ok=True)
            os.replace(attempt, f"{folder}/{file}")

        for part in parts:
            for text, line in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if text != here:
                    if out:
                        close()
                    here, out, files = text, open(attempt, "w", encoding="utf-8", newline="\n"), files + 1
                    out.write(header + "\n")
                if line is not None:
                    out.write(line + "\n")
        if out:
            close()
        yield pa.RecordBatch.from_pydict({"files": [files]})

    lines.sortWithinPartitions("value").mapInArrow(write, "files bigint").write.format("noop").mode("overwrite").save()
    remove_path(df.sparkSession, f"{root}/_temporary")


def write_text(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """One value per line; rows with NULL are written as empty lines."""
    lines = df.select(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("value"))
    lines.write.mode(mode).text(path)


def register_table(
    df: DataFrame, name: str, path: str | None = None, database: str | None = None, mode: str = "overwrite"
) -> str:
    """Save as a Parquet table that can be queried by name; returns the name."""
    full = f"{database}.{name}" if database else name
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(full)
    return full
