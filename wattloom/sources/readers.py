"""Tables from CSV, Parquet, JSON and the catalog, always with a given schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattloom import schemas
from wattloom.functions.values import to_numeric

LATIN_1 = "ISO-8859-1"
#: What Spark names the folder of rows whose key has no value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | StructType,
    encoding: str = "UTF-8",
    sep: str = ",",
    quote: str = '"',
    **options: str,
) -> DataFrame:
    """Headed CSV: one file, a folder, or an explicit list of files.

    A header that does not name the schema's columns in order is an error, never a shift of values.
    """
    paths = path if isinstance(path, str) else list(path)
    return spark.read.schema(schema).csv(
        paths, header=True, sep=sep, quote=quote, encoding=encoding, enforceSchema=False, **options
    )


def read_csv_dir(spark: SparkSession, folder: str, schema: str | StructType, pattern: str = "*.csv") -> DataFrame:
    """Every matching file of a folder as one table, in a single scan."""
    return read_csv(spark, folder, schema, pathGlobFilter=pattern)


def read_csv_by_key(spark: SparkSession, path: str, schema: str | StructType, key: str, kind: str = "string", **options: str) -> DataFrame:
    """The folders of ``write_csv_by_key`` as one table: the columns of ``schema``, then the key as ``kind``.

    The key is taken from each file's path in the tasks. Spark's own inference of partitions keeps all folders in one list of the
    driver, in time that grows with the square of their number. Files are read whole, since one that may be cut into splits
    costs a copy of all settings, however short it is.
    """
    rows = read_csv(spark, path, schema, recursiveFileLookup=True, multiLine=True, **options)
    plain = lambda text: F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)  # percent signs twice: of the path, and of Spark's folder names
    value = plain(F.substring_index(plain(folder), "=", -1))
    return rows.select("*", F.nullif(value, F.lit(NO_VALUE)).cast(kind).alias(key))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """All columns of a catalog table, in table order."""
    return spark.table(name)


def read_forecast_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Forecast documents, one row per forecast day."""
    documents = spark.read.schema(schemas.FORECAST_DOCUMENT).json(path, multiLine=multi_line)
    return explode_forecast(documents)


def explode_forecast(documents: DataFrame, column: str = "list") -> DataFrame:
    """One row per element of the forecast array."""
    return documents.select(F.explode(column).alias("_day")).select("_day.*")


def read_halfhourly(spark: SparkSession, folder: str) -> DataFrame:
    """Half-hourly block files: LCLid, tstp, energy. Unreadable figures become NULL."""
    text = read_csv_dir(spark, folder, schemas.HALFHOURLY_TEXT)
    return text.select(
        "LCLid",
        F.col("tstp").try_cast("timestamp_ntz").alias("tstp"),
        to_numeric(F.trim(F.col("energy(kWh/hh)"))).alias("energy"),
    )
