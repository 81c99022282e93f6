"""Registered queries against SQL, and the pipeline stage by stage."""

import os
from collections import Counter

import pytest
from llm_texts import SCHEMA, _package_on_workers, fold, odd_rows, prose  # noqa: F401
from sql_check import compare, connect

import __spark_entry__ as entry_points
import corpus_pipeline
from wattloom.llm import queries

FOLDER = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_all_are_registered():
    named = entry_points.queries()
    assert "pipeline" in named and {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES}
    assert set(queries.QUERIES) <= set(named) and set(queries.SQL) <= set(entry_points.oracle_sql())


@tables
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.SQL[name]) is None


@pytest.fixture
def folder(spark, tmp_path):
    """Clean prose, junk, a shared line, near copies and a benchmark passage."""
    item, rows, labels = prose(5000, 40), [], []
    for i in range(160):
        text = prose(i, 80 + i % 50, 4000)
        rows.append((i, f"Shared line here\n{text}" if i % 2 else text, "en", f"s{i % 4}" if i % 9 else None, 0))
        labels.append((i, 1, 0))
    for i in range(200, 280):
        rows.append((i, " ".join(f"{w}###" for w in prose(i, 60).split()), "en", "s1", 0))
        labels.append((i, 0, 0))
    words = rows[7][1].split(" ")
    rows.append((300, " ".join([*words[:-1], "other"]), "en", "s2", 0))
    rows.append((301, rows[8][1], "en", "s2", 0))
    rows.append((302, prose(900, 50, 4000) + " " + item + " " + prose(901, 50, 4000), "en", "s3", 0))
    write = lambda name, data, schema: spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    write("documents", rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    write("labels", labels, "doc_id bigint, quality int, toxic int")
    write("benchmark", [(1, item), (2, None)], "item_id bigint, text string")
    return str(tmp_path), rows


def test_each_stage_takes_effect(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = {r.doc_id: r for r in docs.collect()}
    good = {i for i, *_ in rows if not 200 <= i < 280}
    assert set(seen["quality_classifier"]) == good
    assert set(seen["line_dedup"]) == good
    assert all("Shared line" not in r.text and r.n_chars == len(r.text) for r in seen["line_dedup"].values())
    assert set(seen["ngram_jaccard_join"]) == good - {300, 301}
    assert set(seen["benchmark_decontamination"]) == good - {300, 301, 302}
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    copies = Counter(r.doc_id for r in mixed)
    assert set(copies) <= good - {300, 301, 302} and max(copies.values()) <= 3
    total = sum(len(fold(r.text)) for r in seen["benchmark_decontamination"].values())
    assert abs(sum(len(fold(r.text)) for r in mixed) - total) < 0.1 * total


def test_run_is_the_stages_one_after_another(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    assert sorted(map(str, docs.collect())) == sorted(map(str, corpus_pipeline.run(spark, path).collect()))


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_odd_rows_empty_tables_and_clashing_names_pass_all_stages(spark, tmp_path, rows):
    """NULLs everywhere, texts of all lengths, repeated rows, and columns with the names that stages use inside."""
    clashing = ["_line_id", "_gone", "_size", "_n_words", "_OF", "_frequent", "id", "component_id", "score", "h", "rank"]
    values = [(*r, *(["x"] * len(clashing))) for r in (odd_rows() if rows == "odd" else [])]
    docs = spark.createDataFrame(values, f"{SCHEMA}, " + ", ".join(f"{c} string" for c in clashing))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(60)] + [(None, 1, 0), (3, None, None)] if rows == "odd" else []
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    benchmark = [(1, None), (None, "a b"), (2, "")] if rows == "odd" else []
    spark.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    here = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, here, str(tmp_path))
        assert after.columns[: len(here.columns)] == here.columns, name
        here = spark.createDataFrame(after.collect(), after.schema)
    assert (here.count() > 0) == (rows == "odd")
    assert all(r[c] == "x" for r in here.collect() for c in clashing)
