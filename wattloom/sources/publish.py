"""Tables published with a manifest: readers see a whole table, before and after.

A manifest is one JSON document that lists the files of a table and how to read them. A publication writes all new files beside the
table first, under a name of its own, and then writes the manifest. Files are never changed, so a run that fails at any point
leaves the old manifest and all its files as they were.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattloom.sources.files import exists, join_files, part_files, remove_path
from wattloom.sources.readers import read_csv

MANIFEST = "manifest.json"


def write_manifest(spark: SparkSession, path: str, uris: Sequence[str]) -> None:
    """A manifest of headed, comma-separated files; it appears whole or not at all."""
    settings = {"format": "CSV", "delimiter": ",", "textqualifier": '"', "containsHeader": "true"}
    text = json.dumps({"fileLocations": [{"URIs": list(uris)}], "globalUploadSettings": settings})
    staged = f"{path}.{uuid.uuid4().hex}"
    spark.range(1).coalesce(1).select(F.lit(text).alias("value")).write.text(staged)
    join_files(spark, part_files(spark, staged), path)
    remove_path(spark, staged)


def manifest_of(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def read_manifest(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The rows of all files that a manifest lists, by its delimiter and text qualifier; folders may be listed too."""
    found = manifest_of(spark, path)
    settings = {"format": "CSV", "delimiter": ",", "textqualifier": '"', "containsHeader": "true", **found.get("globalUploadSettings", {})}
    if settings["format"].upper() != "CSV" or str(settings["containsHeader"]).lower() != "true":
        raise ValueError(f"{path} does not list headed CSV files")
    files = [uri for place in found["fileLocations"] for uri in place.get("URIs", [])]
    files += [prefix for place in found["fileLocations"] for prefix in place.get("URIPrefixes", [])]
    if not files:
        return spark.createDataFrame([], schema)
    return read_csv(spark, files, schema, sep=settings["delimiter"], quote=settings["textqualifier"])


def publish(df: DataFrame, folder: str, key: str | None = None) -> None:
    """Publish a table in ``folder``; with ``key``, only the key values in hand are replaced and all others stay.

    Old files that the new manifest no longer lists are left to ``tidy``, so that readers of the old one can finish.
    """
    spark, path = df.sparkSession, f"{folder}/{MANIFEST}"
    kept: list[str] = []
    if key is None:
        places = {f"{folder}/data-{uuid.uuid4().hex}": df}
    else:
        values = [r[0] for r in df.select(key).distinct().orderBy(key).collect()]  # one a folder: as many as the table has parts
        if None in values:
            raise ValueError(f"{key} is NULL in some rows")
        places = {f"{folder}/{key}-{v}-{uuid.uuid4().hex}": df.where(F.col(key) == F.lit(v)) for v in values}
        if exists(spark, path):
            replaced = tuple(f"/{key}-{v}-" for v in values)
            kept = [u for u in manifest_of(spark, path)["fileLocations"][0]["URIs"] if not any(r in u for r in replaced)]
    for place, rows in places.items():
        rows.write.option("header", True).csv(place)
    written = [f for place in places for f in sorted(part_files(spark, place))]
    write_manifest(spark, path, kept + written)


def tidy(spark: SparkSession, folder: str) -> list[str]:
    """Delete data folders that the manifest does not list any more; returns their paths."""
    listed = manifest_of(spark, f"{folder}/{MANIFEST}")["fileLocations"][0]["URIs"]
    gone = [f for f in part_files(spark, folder) if not f.endswith(MANIFEST) and not any(u.startswith(f + "/") for u in listed)]
    for f in gone:
        remove_path(spark, f)
    return gone
