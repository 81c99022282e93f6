import hashlib
from collections import Counter

from llm_texts import _package_on_workers, docs, empty, odd  # noqa: F401
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from wattloom.llm import line_dedup


def brute(texts, limit):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    lines = [(t or "").split("\n") for t in texts]
    df = Counter(k for ls in lines for k in {key(x) for x in ls} - {""})
    out = []
    for ls in lines:
        kept = [x for x in ls if df[key(x)] < limit]
        out.append((len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_counts_equal_brute_force_at_any_batching(spark, docs):
    texts = ["Head\nbody one\n\nfoot", " head \nBODY TWO\nÄ", "HEAD\t\nä\nhead", None, "", "\n\n", "only", "head\nfoot", "Ä\nhead"]
    for batches, fanout in ((1, 2), (3, 2), (5, 3), (4, 9)):
        got = line_dedup.drop_frequent_lines(docs(*texts), 3, batches=batches, fanout=fanout).orderBy("doc_id").collect()
        assert [(r.n_lines, r.n_dropped, r.kept_sha256) for r in got] == brute(texts, 3)


def batches(spark, *groups):
    return [spark.createDataFrame([(k.encode(),) for k in keys], "h binary") for keys in groups]


def keys(df):
    return sorted(bytes(r.h).decode() for r in df.collect())


def test_runs_settle_and_are_merged(spark):
    runs = line_dedup.LineRuns(spark, min_documents=2, fanout=2)
    for batch in batches(spark, "ab", "ac", "ad", "b"):
        runs.add(batch)
    assert runs.levels[0] == 0 and sum(runs.levels) < 2 and keys(runs._read(1)) == ["a", "b"]
    assert keys(runs.frequent()) == ["a", "b"]
    runs.remove()
    assert keys(runs.frequent()) == []


def test_runs_are_merged_without_an_exchange(spark):
    runs = line_dedup.LineRuns(spark, min_documents=3, fanout=3)
    for batch in batches(spark, "aab", "abc", "bcd", "de", "d"):
        runs.add(batch)
    assert keys(runs._read(1)) == ["a", "b"] and runs.levels == [2, 1]
    for merge in (runs.merged(0), runs.merged()):
        assert "Exchange" not in plan_of(merge) and "Bucketed: true" in plan_of(merge)
    assert {bytes(r.h).decode(): r.documents for r in runs.merged().collect()} == {"c": 2, "d": 3, "e": 1}
    (more,) = batches(spark, "ax")
    assert plan_of(runs.counted(more)).count("Exchange hashpartitioning") == 1 and keys(runs.counted(more)) == ["x"]
    runs.remove()


@pytest.mark.parametrize("partitions", ["4", "7"])
def test_a_later_batch_is_added_to_saved_runs(spark, docs, tmp_path, partitions):
    runs = line_dedup.LineRuns(spark, min_documents=3, fanout=2)
    line_dedup.drop_frequent_lines(docs("one\ntwo", "one\nthree"), 3, batches=3, earlier=runs).collect()
    runs.save(f"{tmp_path}/runs")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        again = line_dedup.LineRuns.load(spark, f"{tmp_path}/runs", 3, 2)
        got = line_dedup.drop_frequent_lines(docs("one\nfour", "two\nthree"), 3, batches=2, earlier=again).orderBy("doc_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [r.text for r in got] == ["four", "two\nthree"]
    again.remove()


def test_texts_are_cut_by_one_plan_at_any_size(docs):
    plan = plan_of(line_dedup.drop_frequent_lines(docs("a\nb", "b"), 2))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_ids_may_be_text(docs):
    named = docs("a\nb", "b").withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert [(r.doc_id, r.text) for r in line_dedup.drop_frequent_lines(named, 2).orderBy("doc_id").collect()] == [("d0", "a"), ("d1", "")]


def test_odd_rows(odd):
    clashing = odd.withColumn("n_lines", F.lit("mine")).withColumn("_frequent", F.lit(1)).withColumn("h", F.lit(2)).withColumn("id", F.lit(3))
    got = line_dedup.drop_frequent_lines(clashing.withColumnRenamed("lang", "_OF"), 3)
    rows = got.collect()
    assert len(rows) == odd.count() and got.columns.count("n_lines") == 1
    assert all(r.n_lines == 1 and r.n_dropped == 0 for r in rows if not r.text and r.doc_id in (0, 1))
    assert [r.n_dropped for r in rows if r.doc_id == 5] == [5, 5, 5]  # with document 6, four have the lines
    assert line_dedup.without_frequent_lines(odd, 3).columns == odd.columns


def test_empty(empty):
    assert line_dedup.drop_frequent_lines(empty).count() == 0


@pytest.mark.parametrize("limit", [1, 100])
def test_all_or_nothing_goes(docs, limit):
    rows = line_dedup.drop_frequent_lines(docs("a\nb", "b\nc"), limit).orderBy("doc_id").collect()
    assert [r.text for r in rows] == (["", ""] if limit == 1 else ["a\nb", "b\nc"])
