"""Line dedup over levelled sorted runs of line hashes.

Every distinct line of a document gives one 128-bit hash of its key. Documents come in batches. A batch
is counted (documents by hash), merge-anti-joined with the *settled* hashes (already found in
enough documents, which need no more counting), and what is left is written as a sorted run of level 0.
When a level holds ``fanout`` runs they are merged into one: hashes that have reached the limit become
settled, the rest is a run of the next level. So each hash is rewritten once a level, and
the unsettled part of old runs is deleted when their merge is written.

All runs are parts of one table that is bucketed and sorted by hash. A batch is shuffled once, when it is counted; anti-joins
and merges then go bucket by bucket and shuffle nothing. Runs can be saved and loaded again, so a later batch adds to all earlier ones.

The counts are exact, so the order of batches does not matter. Hot lines are counted map-side first; the
joins of lines with frequent hashes and of texts with their hits are plain merge joins at every size, whose hot keys adaptive execution splits.

Defined results: NULL or empty text is one empty line and never dropped; lines whose key is shorter than
``min_key`` stay; repeated rows count as separate documents; a document whose lines all go keeps the empty
text; rows with a NULL id keep their row. Ids may be of any type that can be joined on.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from wattloom.llm.storage import Scratch, remove, stored, unused, write_table
from wattloom.shared import scratch_path

STRIPPED = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """The line without blanks at its ends, A-Z in lower case."""
    return line.strip(STRIPPED).lower()


def line_hash(line: bytes, min_key: int) -> bytes | None:
    """128 bits of the key, or None where the key has fewer than ``min_key`` code points."""
    key = line_key(line)
    return xxhash.xxh3_128_digest(key) if len(key) >= min_key and len(key.decode()) >= min_key else None


def document_lines(docs: DataFrame, min_key: int, batches: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, batch, h): one row for each distinct line key of each row."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, batch, hashes = [], [], []
            for i, b, value in zip(*(part.column(k).to_pylist() for k in (0, 1)), part.column(2).cast(pa.binary())):
                found = {line_hash(x, min_key) for x in (value.as_py() or b"").split(b"\n")} - {None}
                ids += [i] * len(found)
                batch += [b] * len(found)
                hashes += found
                if len(hashes) > 50_000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, id_type), pa.array(batch, pa.int32()), pa.array(hashes, pa.binary())], names
                    )
                    ids, batch, hashes = [], [], []
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(batch, pa.int32()), pa.array(hashes, pa.binary())], names
            )

    kind = docs.schema[id_column].dataType
    id_type, names = to_arrow_type(kind), ["id", "batch", "h"]
    batch = F.pmod(F.xxhash64(id_column), F.lit(batches)).cast("int")
    return docs.select(F.col(id_column).alias("id"), batch.alias("batch"), F.col(text).alias("text")).mapInArrow(
        rows, T.StructType([T.StructField("id", kind), T.StructField("batch", T.IntegerType()), T.StructField("h", T.BinaryType())])
    )


class LineRuns:
    """Levelled sorted runs of (hash, documents); hashes in ``min_documents`` or more are settled."""

    def __init__(self, spark: SparkSession, min_documents: int, fanout: int = 3, buckets: int | None = None):
        self.spark, self.min_documents, self.fanout = spark, min_documents, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels, self.runs = [0], 0  # runs of each level, and of all
        self.name, self.path = f"line_runs_{uuid.uuid4().hex}", scratch_path(spark, "line-runs")

    def _write(self, run: DataFrame, level: int) -> None:
        """Add a run of (h, documents, settled) to a level."""
        placed = run.withColumns({"level": F.lit(level), "run": F.lit(self.runs)})
        writer = placed.write.format("parquet").mode("append").partitionBy("settled", "level", "run").bucketBy(self.buckets, "h").sortBy("h")
        writer.option("path", self.path).saveAsTable(self.name)
        self.runs += 1
        self.levels[level] += 1

    def _read(self, settled: int) -> DataFrame:
        return self.spark.table(self.name).where(F.col("settled") == settled)

    def counted(self, hashes: DataFrame) -> DataFrame:
        """(h, documents) of the hashes that are not settled, from one row for each document and line."""
        found = hashes.groupBy("h").agg(F.count(F.lit(1)).alias("documents"))
        if self.buckets != int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            found = found.repartition(self.buckets, "h")  # runs of another session
        return found.join(self._read(1).select("h").hint("merge"), "h", "left_anti") if self.runs else found

    def add(self, hashes: DataFrame) -> None:
        """Count a batch with one row for each document and line, and put it on level 0."""
        self._write(self.counted(hashes).withColumn("settled", F.lit(0)), 0)
        level = 0
        while self.levels[level] >= self.fanout:
            self._compact(level)
            level += 1

    def merged(self, level: int | None = None) -> DataFrame:
        """(h, documents, settled) of the unsettled hashes of a level, or of all levels."""
        runs = self._read(0) if level is None else self._read(0).where(F.col("level") == level)
        summed = runs.groupBy("h").agg(F.sum("documents").alias("documents"))
        return summed.withColumn("settled", (F.col("documents") >= self.min_documents).cast("int"))

    def _compact(self, level: int) -> None:
        if level + 1 == len(self.levels):
            self.levels.append(0)
        self._write(self.merged(level), level + 1)
        remove(self.spark, f"{self.path}/settled=0/level={level}")
        self.spark.catalog.refreshTable(self.name)
        self.levels[level] = 0

    def remove(self) -> None:
        """Delete all runs."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove(self.spark, self.path)
        self.levels, self.runs = [0], 0

    def frequent(self) -> DataFrame:
        """(h): all hashes found in enough documents, settled or by the sum over the runs of all levels."""
        if not self.runs:
            return self.spark.createDataFrame([], "h binary")
        return self._read(1).select("h").union(self.merged().where("settled = 1").select("h"))

    def save(self, path: str) -> None:
        """Write down where the runs are, to ``load`` them in another session."""
        row = (self.path, self.buckets, self.runs, self.levels)
        self.spark.createDataFrame([row], "path string, buckets int, runs int, levels array<int>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, min_documents: int, fanout: int = 3) -> LineRuns:
        """Runs that were saved; batches can be added to them."""
        saved = spark.read.parquet(path).first()
        runs = cls(spark, min_documents, fanout, saved.buckets)
        runs.path, runs.runs, runs.levels = saved.path, saved.runs, list(saved.levels)
        spark.sql(
            f"CREATE TABLE {runs.name} (h BINARY, documents BIGINT, settled INT, level INT, run INT) USING parquet PARTITIONED BY (settled, level, run) "
            f"CLUSTERED BY (h) SORTED BY (h) INTO {saved.buckets} BUCKETS LOCATION '{saved.path}'"
        )
        spark.catalog.recoverPartitions(runs.name)
        return runs


def drop_frequent_lines(
    docs: DataFrame, min_documents: int = 10, min_key: int = 1, batches: int = 6, fanout: int = 3,
    id_column: str = "doc_id", text: str = "text", earlier: LineRuns | None = None,
) -> DataFrame:
    """``docs`` with the text cut, and ``n_lines``, ``n_dropped``, ``kept_sha256`` added (replacing equal names).

    Lines whose key is found in ``min_documents`` documents or more go from every document. With the runs of ``earlier``
    documents, those count too, and the runs are kept with these documents added; else they are deleted at the end.
    """
    spark = docs.sparkSession
    scratch, path = Scratch(spark), scratch_path(spark, "lines")
    counted = document_lines(docs, min_key, batches, id_column, text)
    lines = spark.read.schema(counted.schema).parquet(write_table(counted, path, "batch"))
    runs = LineRuns(spark, min_documents, fanout) if earlier is None else earlier
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch).select("h"))
    frequent = scratch.stored(runs.frequent(), "frequent")
    hits = stored(lines.join(frequent.hint("merge"), "h").groupBy("id").agg(F.collect_set("h").alias("frequent")), "line-hits")
    scratch.clear()
    remove(spark, path)
    if earlier is None:
        runs.remove()
    return _cut(docs, hits, min_key, id_column, text)


def _cut(docs: DataFrame, hits: DataFrame, min_key: int, id_column: str, text: str) -> DataFrame:
    added = ["n_lines", "n_dropped", "kept_sha256"]
    kept_columns = [c for c in docs.columns if c not in added]
    of, frequent = unused("_of", docs.columns), unused("_frequent", docs.columns)
    hits = hits.select(F.col("id").alias(of), F.col("frequent").alias(frequent)).hint("merge")
    joined = docs.select(*kept_columns).join(hits, F.col(id_column).eqNullSafe(F.col(of)), "left")
    schema = docs.select(*kept_columns).schema
    at = kept_columns.index(text)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, numbers = [], ([], [], [])
            for value, found in zip(part.column(at).cast(pa.binary()), part.column(part.num_columns - 1).to_pylist()):
                raw = value.as_py()
                lines, gone = (raw or b"").split(b"\n"), set(found or ())
                kept = [x for x in lines if line_hash(x, min_key) not in gone] if gone else lines
                whole = b"\n".join(kept)
                texts.append(None if raw is None else whole.decode())
                for to, x in zip(numbers, (len(lines), len(lines) - len(kept), hashlib.sha256(whole).hexdigest())):
                    to.append(x)
            columns = part.columns[:-1]
            columns[at] = pa.array(texts, part.column(at).type)
            types = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(x, t) for x, t in zip(numbers, types))], [*kept_columns, *added]
            )

    for name, kind in zip(added, ("long", "long", "string")):
        schema = schema.add(name, kind)
    return joined.select(*kept_columns, frequent).mapInArrow(cut, schema)


def without_frequent_lines(docs: DataFrame, min_documents: int = 10) -> DataFrame:
    """``docs`` with the frequent lines cut from the text, and ``n_chars`` (where there) counted anew; its own columns only."""
    cut = drop_frequent_lines(docs, min_documents)
    columns = [F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return cut.select(*columns)
