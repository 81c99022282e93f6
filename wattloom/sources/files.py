"""Whole files, by the file system that Spark itself uses for their path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import IllegalArgumentException, UnsupportedOperationException
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def local_path(spark: SparkSession, path: str) -> str | None:
    """The plain path where ``path`` is on the local file system, else None."""
    place, system = _place(spark, path)
    where = system.makeQualified(place).toUri()
    return where.getPath() if where.getScheme() == "file" else None


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    place, system = _place(spark, path)
    system.create(place, True).close()


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """The paths of a written folder's data files."""
    place, system = _place(spark, folder)
    return [str(s.getPath()) for s in system.listStatus(place) if not str(s.getPath().getName()).startswith(("_", "."))]


def remove_path(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder to a path that does not exist yet."""
    source, system = _place(spark, old)
    target = _place(spark, new)[0]
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"could not move {old} to {new}")


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return bool(system.exists(place))


def join_files(spark: SparkSession, files: Sequence[str], path: str) -> None:
    """One file at ``path`` with the bytes of ``files`` in order; it appears whole or not at all."""
    beside = f"{path}.joining"
    first, system = _place(spark, files[0])
    whole = _place(spark, beside)[0]
    try:
        others = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(files) - 1)
        for i, file in enumerate(files[1:]):
            others[i] = _place(spark, file)[0]
        system.concat(first, others)
        system.rename(first, whole)
    except (UnsupportedOperationException, IllegalArgumentException):  # no concatenation, or not of these files
        out = system.create(whole, True)
        try:
            for file in files:
                part, of = _place(spark, file)
                data = of.open(part)
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, out, 1 << 20, False)
                finally:
                    data.close()
        finally:
            out.close()
    if exists(spark, path):
        remove_path(spark, path)
    rename(spark, beside, path)
