"""Readers and writers."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from conftest import values
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from wattloom import schemas, shared
from wattloom.sources import files, publish, readers, writers


def _files(path, suffix):
    return sorted(f for _, _, names in os.walk(path) for f in names if f.endswith(suffix))


def test_halfhourly_blocks(spark, tmp_path):
    (tmp_path / "block_0.csv").write_text(
        "LCLid,tstp,energy(kWh/hh)\nMAC000002,2013-01-01 00:00:00.0000000, 0.219 \nMAC000002,2013-01-01 00:30:00.0000000,Null\n"
    )
    (tmp_path / "block_1.csv").write_text("LCLid,tstp,energy(kWh/hh)\nMAC000003,bad,0.5\n")
    (tmp_path / "notes.txt").write_text("not,a,block\n")
    assert values(readers.read_halfhourly(spark, str(tmp_path))) == [
        ("MAC000002", datetime(2013, 1, 1), 0.219), ("MAC000002", datetime(2013, 1, 1, 0, 30), None), ("MAC000003", None, 0.5),
    ]


def test_latin1_and_quotes(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes('"MAIN CATEGORIES","v"\n"£20,000 – é","1"\n'.replace("–", "-").encode("latin-1"))
    got = readers.read_csv(spark, str(path), "`MAIN CATEGORIES` STRING, v INT", encoding=readers.LATIN_1)
    assert values(got) == [("£20,000 - é", 1)]


def test_file_list(spark, tmp_path):
    for name, row in (("a", "1"), ("b", "2"), ("c", "3")):
        (tmp_path / f"{name}.csv").write_text(f"x\n{row}\n")
    assert values(readers.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "c.csv")], "x INT")) == [(1,), (3,)]


def test_details_schema_has_seventeen_codes(spark, tmp_path):
    (tmp_path / "d.csv").write_text(",".join(["M", "C", "R", *schemas.ACORN_CODES]) + "\n")
    assert len(readers.read_csv(spark, str(tmp_path / "d.csv"), schemas.ACORN_DETAILS).columns) == 20


def test_forecast_document(spark, tmp_path):
    day = {"dt": 1743336000, "sunrise": 1743313200, "sunset": 1743359367, "temp": {"day": 15.57, "max": 16.09},
           "feels_like": {"day": 14.49, "night": 6.27}, "pressure": 1021}
    (tmp_path / "f.json").write_text(json.dumps({"city": "x", "list": [day, {**day, "dt": 1743422400}]}, indent=1))
    got = readers.read_forecast_json(spark, str(tmp_path / "f.json"))
    assert got.count() == 2 and got.first().feels_like == {"day": 14.49, "night": 6.27}


def test_partitioned_parquet_and_keyed_csv(spark, table, tmp_path):
    df = table("k STRING, v INT", ("a", 1), ("b", 2), ("a", 3))
    writers.write_parquet(df, str(tmp_path / "p"), ["k"])
    assert sorted(d for d in os.listdir(tmp_path / "p") if d.startswith("k=")) == ["k=a", "k=b"]
    assert values(spark.read.parquet(str(tmp_path / "p")).select("k", "v")) == values(df)
    writers.write_csv_by_key(df, str(tmp_path / "c"), "k")
    assert values(readers.read_csv(spark, str(tmp_path / "c"), "v INT, k STRING").select("k", "v")) == values(df)


def test_csv_by_key_uses_every_core_and_splits_long_keys(spark, tmp_path, monkeypatch):
    df = spark.range(400).selectExpr("cast(id AS INT) AS v", "concat('k', id % 40) AS k")
    writers.write_csv_by_key(df, str(tmp_path / "short"), "k")
    files = _files(tmp_path / "short", ".csv")
    assert len(files) == 40 and len({f.split("-")[1] for f in files}) > 2
    monkeypatch.setattr(writers, "FILE_ROWS", 100)
    skewed = df.selectExpr("v", "if(v < 350, 'long', if(v < 375, k, null)) AS k")
    writers.write_csv_by_key(skewed, str(tmp_path / "long"), "k")
    by_key = {d: len(_files(tmp_path / "long" / d, ".csv")) for d in os.listdir(tmp_path / "long") if "=" in d}
    assert by_key.pop("k=long") > 1 and set(by_key.values()) == {1}
    assert values(readers.read_csv(spark, str(tmp_path / "long"), "v INT, k STRING").select("k", "v")) == values(skewed, "k", "v")


def _tree(path):
    return {d: [sorted(open(os.path.join(at, f)).read().split("\n")) for f in names if f.endswith(".csv")]
            for at, _, names in os.walk(path) if "=" in (d := os.path.basename(at))}


def test_csv_by_key_has_the_folders_and_bytes_of_sparks_writer_and_is_read_by_path(spark, table, tmp_path):
    df = table("`K y` STRING, v INT, `t, x` STRING, `d.d` DOUBLE", ("a", 1, "x,y", 1.5), ("a/b:c%{}[]^+ %2B", 2, 'q"u\\o', 1e-7), (None, 3, None, None),
               ("ü =?*#'~ +", 4, " lead ", 1e20), ("a", 5, "line\nbreak", None), ("=", 6, "", -0.0))
    spark_s, ours = str(tmp_path / "spark"), str(tmp_path / "ours")
    df.repartition(1).write.partitionBy("K y").option("header", True).csv(spark_s)
    for _ in range(2):  # the second replaces the first
        writers.write_csv_by_key(df, ours, "K y")
        assert _tree(ours) == _tree(spark_s) and len(_tree(ours)) == 5
    assert sorted(os.listdir(tmp_path)) == ["ours", "spark"] and os.path.exists(f"{ours}/_SUCCESS")
    schema = "v INT, `t, x` STRING, `d.d` DOUBLE"
    got = readers.read_csv_by_key(spark, ours, schema, "K y")
    assert got.columns == ["v", "t, x", "d.d", "K y"] and dict(values(got, "v", "`K y`")) == dict(values(df, "v", "`K y`"))
    assert values(got) == values(readers.read_csv(spark, spark_s, f"{schema}, `K y` STRING", multiLine=True))
    writers.write_csv_by_key(df, ours, "K y", "append")
    assert readers.read_csv_by_key(spark, ours, schema, "K y").count() == 12
    with pytest.raises(AnalysisException):
        writers.write_csv_by_key(df, ours, "K y", "error")
    alone = table("k INT, v STRING", (1, None), (2, "b"))
    writers.write_csv_by_key(alone, ours, "k")  # a NULL alone has no line
    assert values(readers.read_csv_by_key(spark, ours, "v STRING", "k", "int")) == [("b", 2)] and _tree(ours)["k=1"] == [["", "v"]]
    writers.write_csv_by_key(alone.where("k > 2"), ours, "k")
    assert readers.read_csv_by_key(spark, ours, "v STRING", "k", "int").count() == 0


def test_csv_by_key_starts_no_process_for_a_file(spark, tmp_path, monkeypatch):
    def refused(*_):
        raise AssertionError("Hadoop's local file system creates these files, at four processes each")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", refused)
    writers.write_csv_by_key(spark.range(500).selectExpr("id AS v", "id AS k"), str(tmp_path / "c"), "k")
    monkeypatch.undo()
    # folders are no partitions: of those the driver's inference takes time by the square of their number
    got = readers.read_csv_by_key(spark, str(tmp_path / "c"), "v BIGINT", "k", "bigint")
    assert got.where("k = v").count() == 500 and "PartitionFilters: []" in got.where("k > 3")._jdf.queryExecution().toString()


def test_csv_is_part_files_at_any_size(spark, table, tmp_path):
    writers.write_csv(table("v INT", (1,), (2,), (3,)).repartition(3), str(tmp_path / "small"))
    many = spark.range(0, 100_001, 1, 3).selectExpr("cast(id AS INT) AS v")
    writers.write_csv(many, str(tmp_path / "large"))
    assert len(_files(tmp_path / "large", ".csv")) == 3
    assert readers.read_csv(spark, str(tmp_path / "small"), "v INT").count() == 3
    assert readers.read_csv(spark, str(tmp_path / "large"), "v INT").distinct().count() == 100_001


def test_csv_with_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Tariff,TariffDateTime\nHigh,1/2/24 0:00\n")
    assert readers.read_csv(spark, str(tmp_path / "t.csv"), "Tariff STRING, TariffDateTime STRING").count() == 1
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, str(tmp_path / "t.csv"), "TariffDateTime STRING, Tariff STRING").collect()


def test_text_and_table(spark, table, tmp_path):
    writers.write_text(table("f STRING", ("b",), (None,), ("a",)), str(tmp_path / "t"), "f")
    assert values(spark.read.text(str(tmp_path / "t"))) == [("",), ("a",), ("b",)]
    name = writers.register_table(table("b INT, a INT", (1, 2)), "registered_for_test", path=str(tmp_path / "tab"))
    assert readers.read_table(spark, name).columns == ["b", "a"]
    spark.sql(f"DROP TABLE {name}")


def test_scratch_is_in_the_warehouse_where_no_folder_is_named(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared.scratch_dir(spark) == (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch")


def test_one_headed_file_in_order(spark, tmp_path):
    df = spark.range(0, 500, 1, 9).select((F.lit(500) - F.col("id")).alias("n"), F.concat(F.lit('a,"'), "id").alias("t, x"))
    path = str(tmp_path / "deep" / "one.csv")
    writers.write_single_csv(df, path, "n")
    writers.write_single_csv(df, path, "n")  # replaces the file
    lines = (tmp_path / "deep" / "one.csv").read_text().splitlines()
    assert lines[0] == 'n,"t, x"' and [int(x.split(",")[0]) for x in lines[1:]] == list(range(1, 501))
    assert os.listdir(tmp_path / "deep") in (["one.csv"], [".one.csv.crc", "one.csv"], ["one.csv", ".one.csv.crc"])
    assert readers.read_csv(spark, path, "n BIGINT, `t, x` STRING", escape='"').count() == 500
    writers.write_single_csv(df.where("n < 0"), path)
    assert (tmp_path / "deep" / "one.csv").read_text().splitlines() == ['n,"t, x"']


def test_publication_replaces_only_what_is_in_hand(spark, tmp_path, monkeypatch):
    folder, schema = str(tmp_path / "table"), "k INT, day STRING"
    read = lambda: values(publish.read_manifest(spark, f"{folder}/{publish.MANIFEST}", schema))
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    publish.publish(rows((1, "mon"), (2, "tue"), (3, "tue")), folder, "day")
    publish.publish(rows((4, "tue"), (5, "wed")), folder, "day")
    assert read() == [(1, "mon"), (4, "tue"), (5, "wed")]
    monkeypatch.setattr(publish, "write_manifest", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        publish.publish(rows((9, "mon")), folder, "day")
    assert read() == [(1, "mon"), (4, "tue"), (5, "wed")]
    assert len(publish.tidy(spark, folder)) == 2 and read() == [(1, "mon"), (4, "tue"), (5, "wed")]
    monkeypatch.undo()
    publish.publish(rows((7, "sun")), folder)
    assert read() == [(7, "sun")]
    with pytest.raises(ValueError, match="NULL"):
        publish.publish(rows((7, None)), folder, "day")


def test_manifest_settings(spark, tmp_path):
    (tmp_path / "a.txt").write_text("k|t\n1|'x|y'\n")
    manifest = {"fileLocations": [{"URIs": [str(tmp_path / "a.txt")]}], "globalUploadSettings": {"format": "CSV", "delimiter": "|", "textqualifier": "'", "containsHeader": "true"}}
    (tmp_path / "m.json").write_text(json.dumps(manifest, indent=2))
    assert values(publish.read_manifest(spark, str(tmp_path / "m.json"), "k INT, t STRING")) == [(1, "x|y")]
    manifest["globalUploadSettings"]["containsHeader"] = "false"
    (tmp_path / "m.json").write_text(json.dumps(manifest))
    with pytest.raises(ValueError, match="headed"):
        publish.read_manifest(spark, str(tmp_path / "m.json"), "k INT, t STRING")
    assert files.exists(spark, str(tmp_path / "m.json")) and not files.exists(spark, str(tmp_path / "none"))
