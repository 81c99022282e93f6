"""Operators on small tables with the awkward cases: NULL keys, zero totals, gaps, ties, duplicates."""

from __future__ import annotations

import hashlib
import random
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from wattloom.operators import aggregates as agg
from wattloom.operators import columns as co
from wattloom.operators import filters as fl
from wattloom.operators import imputation as im
from wattloom.operators import joins as jn
from wattloom.operators import ordering as od
from wattloom.operators import pivots as pv
from wattloom.operators import profiling as pr
from wattloom.operators import quantiles as qn
from wattloom.operators import windows as wn
from wattloom.operators.quantiles import approximate_quantiles, quantiles


# Columns -------------------------------------------------------------------------------------------


def test_unpivot_keeps_nulls_and_pivot_undoes_it(table):
    wide = table("k STRING, `ACORN-A` DOUBLE, `ACORN-B` DOUBLE", ("x", 1.0, None), ("y", 3.0, 4.0))
    long = co.unpivot(wide, ["k"], co.columns_like(wide, "ACORN-"))
    assert values(long) == [("x", "ACORN-A", 1.0), ("x", "ACORN-B", None), ("y", "ACORN-A", 3.0), ("y", "ACORN-B", 4.0)]
    back = long.groupBy("k").pivot("Acorn", ["ACORN-A", "ACORN-B"]).agg(F.first("Value"))
    assert values(back) == values(wide)


def test_cast_drop_and_rename(table):
    df = table("a STRING, `Unnamed: 0` INT, `b c` STRING", ("1", 1, "x"), ("z", 2, "2"))
    cast = co.cast_columns(co.drop_matching(df, "^Unnamed:"), {"a": "int", "b c": "double"})
    assert cast.columns == ["a", "b c"] and values(cast) == [(None, 2.0), (1, None)]
    assert co.rename(cast, {"b c": "b"}).columns == ["a", "b"]
    assert co.numeric_columns(cast) == ["a", "b c"]
    assert co.drop_columns(df, "a", "nothing").columns == ["Unnamed: 0", "b c"]


def test_transpose(table):
    df = table("r STRING, a INT, b INT", ("x", 1, 2), ("y", 3, 4))
    assert values(co.transpose(df, "r", ["x", "y"], ["a", "b"])) == [("a", 1, 3), ("b", 2, 4)]


def test_wide_ratio(table):
    wide = table("t INT, A DOUBLE, B DOUBLE", (1, 10.0, 6.0), (2, None, 3.0))
    rated = table("g STRING, cur DOUBLE, pot DOUBLE", ("A", 50.0, 100.0), ("C", 1.0, 1.0), ("B", 1.0, 0.0))
    with pytest.raises(ValueError, match="no column"):
        co.wide_ratio(wide, rated, ["t"], ["A", "B", "Z"], "g", "cur", "pot")
    got = co.wide_ratio(wide, rated, ["t"], ["A", "B"], "g", "cur", "pot")
    assert got.columns == ["t", "A", "B", "A_Potential", "B_Potential"]
    assert values(got) == [(1, 10.0, 6.0, 5.0, None), (2, None, 3.0, None, None)]


def test_pivots_refuse_unlisted_values(table):
    df = table("r INT, g STRING, v DOUBLE", (1, "a", 1.0), (1, "b", 2.0), (2, None, 3.0))
    assert pv.pivot_mean(df, "r", "g", "v", ["a", "b", None]).columns == ["r", "a", "b", "null"]
    for values_listed in (["a", "b"], ["a", None]):
        with pytest.raises(Exception, match="without a column"):
            pv.pivot_mean(df, "r", "g", "v", values_listed).collect()


# Filters and filling -------------------------------------------------------------------------------


def test_null_filters(table):
    df = table("a DOUBLE, b STRING", (1.0, "x"), (None, "y"), (float("nan"), "z"), (2.0, None))
    assert values(fl.drop_null(df, "a"), "b") == [(None,), ("x",)]
    assert values(fl.drop_null_any(df)) == [(1.0, "x")]
    assert fl.filter_not_null(df, "b").count() == 3


def test_complete_days(table):
    df = table("d STRING, energy_count STRING", ("a", "48"), ("b", "46"), ("c", "50"), ("d", "x"))
    got = fl.complete_days(df)
    assert values(got) == [("a", 48)] and dict(got.dtypes)["energy_count"] == "int"


def test_time_range_is_half_open_and_pushed_down(spark, table, tmp_path):
    path = str(tmp_path / "r")
    table("t TIMESTAMP_NTZ", *[(datetime(2013, m, 1),) for m in range(1, 9)]).write.parquet(path)
    got = fl.time_range(spark.read.parquet(path), "t", "2013-01-01", "2013-07-01")
    assert got.count() == 6
    assert "GreaterThanOrEqual(t," in plan_of(got) and "LessThan(t," in plan_of(got)


def test_filter_in_list_and_table(table):
    df = table("k STRING", ("a",), ("b",), ("c",), (None,))
    assert values(fl.filter_in(df, "k", ["a", "c"])) == [("a",), ("c",)]
    ids = table("id STRING", ("a",), ("a",), ("z",))
    assert values(fl.filter_in(df, "k", ids)) == [("a",)]


def test_fills(table):
    df = table("k INT, x DOUBLE, s STRING", (1, 1.0, "b"), (2, None, "a"), (3, float("nan"), None), (4, 3.0, None))
    assert values(im.fill_mean(df, "x"), "k", "x") == [(1, 1.0), (2, 2.0), (3, 2.0), (4, 3.0)]
    assert values(im.fill_mode(df, "s"), "k", "s") == [(1, "b"), (2, "a"), (3, "a"), (4, "a")]
    assert values(im.fill_label(df, "s", "none"), "k", "s")[2:] == [(3, "none"), (4, "none")]
    assert values(im.fill_const(df, {"x": 0.0, "s": "u"}), "x") == [(0.0,), (0.0,), (1.0,), (3.0,)]


def test_fill_stat_formulas(table):
    df = table("a DOUBLE, b DOUBLE, v DOUBLE", (4.0, 1.0, None), (8.0, 3.0, 5.0))
    got = im.fill_stat(df, {"v": F.avg("a") * F.avg("b")})
    assert values(got, "v") == [(12.0,), (5.0,)]
    assert "CartesianProduct" not in plan_of(got) and "NestedLoop" not in plan_of(got)


# Joins ---------------------------------------------------------------------------------------------


def test_left_join_keeps_rows_and_null_keys_do_not_match(table):
    a = table("k STRING, v INT", ("x", 1), (None, 2), ("z", 3))
    b = table("k STRING, w INT", ("x", 10), (None, 20))
    assert values(jn.left_join(a, b, "k")) == [(None, 2, None), ("x", 1, 10), ("z", 3, None)]
    other = b.withColumnRenamed("k", "j")
    assert jn.left_join_on(a, other, "k", "j").columns == ["k", "v", "w"]
    assert values(jn.attach(a, b, ["k"])) == [(None, 2, 20), ("x", 1, 10), ("z", 3, None)]


def test_join_instants_across_types(table):
    a = table("id STRING, tstp STRING", ("MAC000002", "2013-01-01 00:00:00"), ("MAC000002", "2012-10-12 00:30:00"), ("m", "bad"))
    b = table("TariffDateTime TIMESTAMP_NTZ, Tariff STRING", (datetime(2013, 1, 1), "Normal"))
    assert values(jn.join_instants(a, b, "tstp", "TariffDateTime")) == [("MAC000002", datetime(2013, 1, 1), "Normal")]


def test_keep_matching_does_not_fan_out(table):
    a = table("t INT", (1,), (2,), (2,))
    b = table("u INT", (2,), (2,), (3,))
    assert values(jn.keep_matching(a, b, "t", "u")) == [(2,), (2,)]
    assert values(jn.join_twice(a, b, "t", "u")) == [(2, 2)] * 4 + [(3, None)]
    assert values(jn.left_from_dense(b, a, "u", "t").select("u", "t")) == [(2, 2)] * 4 + [(3, None)]


def test_unique_lookup(table):
    df = table("k STRING, o INT, v STRING", ("a", 2, "late"), ("a", 1, "early"), ("b", 1, None))
    assert values(jn.unique_lookup(df, "k", "o", "first")) == [("a", 1, "early"), ("b", 1, None)]
    assert values(jn.unique_lookup(df, "k", "o", "last")) == [("a", 2, "late"), ("b", 1, None)]
    with pytest.raises(ValueError):
        jn.unique_lookup(df, "k", "o", "middle")


def test_left_join_default(table):
    a = table("d INT", (1,), (2,))
    h = table("h INT, Type STRING", (1, "Easter"))
    assert values(jn.left_join_default(a, h, "d", "h", "Type", "No Holiday")) == [(1, "Easter"), (2, "No Holiday")]


def test_join_on_dates(table):
    a = table("d STRING, v INT", ("2012-10-12", 1), ("13/10/2012", 2), ("junk", 3))
    b = table("e STRING, w INT", ("12/10/2012", 10), ("2012-10-13", 20), ("junk", 30))
    assert values(jn.join_on_dates(a, b, "d", "e")) == [(date(2012, 10, 12), 1, 10), (date(2012, 10, 13), 2, 20)]


# Aggregates, profiles, pivots ----------------------------------------------------------------------


def test_null_group_keys_and_all_null_sums(table):
    df = table("g STRING, v DOUBLE", ("a", 1.0), ("a", 3.0), (None, 5.0), ("b", None))
    assert values(agg.group_mean(df, "g", "v")) == [(None, 5.0), ("a", 2.0), ("b", None)]
    assert values(agg.group_mean(df, "g", "v", drop_null_keys=True)) == [("a", 2.0), ("b", None)]
    assert values(agg.group_sum(df, "g", "v")) == [(None, 5.0), ("a", 4.0), ("b", None)]
    assert values(agg.group_count(df, "g", "v")) == [("a", 2), ("b", 0)]
    assert [tuple(r) for r in agg.value_counts(df, "g").collect()] == [("a", 2), ("b", 1)]
    assert agg.row_count(df).first()[0] == 4


def test_corr_of_a_constant_is_null(table):
    df = table("a DOUBLE, b DOUBLE, c DOUBLE", (1.0, 2.0, 7.0), (2.0, 4.1, 7.0), (3.0, None, 7.0), (4.0, 7.9, 7.0))
    got = {(r.a, r.b): r["corr"] for r in pr.corr_matrix(df, ["a", "b", "c"]).collect()}
    frame = df.toPandas()
    assert got[("a", "b")] == pytest.approx(frame.a.corr(frame.b)) and got[("a", "b")] == got[("b", "a")]
    assert got[("a", "a")] == pytest.approx(1.0)
    assert got[("a", "c")] is None and got[("c", "c")] is None
    ordered = [r.variable for r in pr.corr_with_target(df, ["a", "b", "c"], "a").collect()]
    assert ordered == ["c", "b", "a"]


def test_corr_of_a_constant_in_many_partitions_is_null(spark):
    df = spark.range(0, 100_003, 1, 32).select(
        F.lit(0.1).alias("a"), F.lit(30.0).alias("b"), (F.xxhash64("id") % 1000).cast("double").alias("x"), F.when(F.col("id") < 2, F.col("id") / 10.0).alias("few"))
    got = {r.variable: r["corr"] for r in pr.corr_with_target(df, ["a", "b", "x", "few"], "x").collect()}
    assert got["a"] is None and got["b"] is None and got["x"] == pytest.approx(1.0) and abs(got["few"]) == pytest.approx(1.0)


def test_null_counts_and_shape(table):
    df = table("a INT, b STRING", (1, None), (None, None))
    assert values(pr.null_counts(df)) == [("a", 1), ("b", 2)]
    assert values(pr.table_shape(df)) == [(0, "a", "int", 2, 2), (1, "b", "string", 2, 2)]


def test_histogram_edges(table):
    df = table("x DOUBLE", *[(v,) for v in (0.0, 1.0, 2.0, 9.9, 10.0, None)])
    counts, edges = np.histogram([0.0, 1.0, 2.0, 9.9, 10.0], bins=5)
    got = sorted(pr.histogram(df, "x", 5).collect(), key=lambda r: r.bin)
    assert [r["count"] for r in got] == list(counts)
    assert [r.lower for r in got] == pytest.approx(edges[:-1])
    flat = sorted(pr.histogram(table("x DOUBLE", (3.0,), (3.0,)), "x", 2).collect(), key=lambda r: r.bin)
    assert [(r.lower, r.upper, r["count"]) for r in flat] == [(2.5, 3.0, 0), (3.0, 3.5, 2)]


def test_kde_matches_the_formula(table):
    xs = np.array([1.0, 2.0, 2.5, 4.0, 9.0])
    got = sorted(pr.kde(table("x DOUBLE", *[(float(v),) for v in xs]), "x", grid=7).collect(), key=lambda r: r.point)
    h = xs.std(ddof=1) * len(xs) ** -0.2
    grid = np.linspace(xs.min() - 3 * h, xs.max() + 3 * h, 7)
    want = [np.mean(np.exp(-0.5 * ((xs - g) / h) ** 2)) / (h * np.sqrt(2 * np.pi)) for g in grid]
    assert [r.x for r in got] == pytest.approx(grid) and [r.density for r in got] == pytest.approx(want)


def test_kde_by_boxes_is_within_its_bound(table):
    rng = np.random.default_rng(4)
    xs = np.concatenate([rng.normal(0, 1, 800), rng.normal(60, 0.01, 50), [500.0], np.zeros(300)])
    got = sorted(pr.kde(table("x DOUBLE", *[(float(v),) for v in xs], (None,), (float("nan"),)), "x").collect(), key=lambda r: r.point)
    h = xs.std(ddof=1) * len(xs) ** -0.2
    for r in got:
        want = np.exp(-0.5 * ((r.x - xs) / h) ** 2).mean() / (h * np.sqrt(2 * np.pi))
        assert abs(r.density - want) < 1e-11 / h and len(got) == 200
    flat = pr.kde(table("x DOUBLE", (2.0,), (2.0,)), "x", grid=3).collect()
    assert [r.density for r in flat] == [None] * 3


def test_describe_and_boxes_match_pandas(table):
    random.seed(3)
    xs = [random.gauss(0, 1) for _ in range(200)] + [50.0, -40.0]
    df = table("x DOUBLE, y DOUBLE", *[(v, float(i % 7)) for i, v in enumerate(xs)])
    frame = df.toPandas()
    for row in pr.describe(df, ["x", "y"]).collect():
        want = frame[row.variable].describe()
        got = [row["count"], row["mean"], row["std"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]]
        assert got == pytest.approx(list(want))
    box = {r.variable: r for r in pr.box_stats(df, ["x", "y"]).collect()}
    q1, q3 = frame.x.quantile([0.25, 0.75])
    inside = frame.x[(frame.x >= q1 - 1.5 * (q3 - q1)) & (frame.x <= q3 + 1.5 * (q3 - q1))]
    assert (box["x"].whisker_low, box["x"].whisker_high) == (inside.min(), inside.max())
    assert box["x"].outliers == len(frame) - len(inside) and box["y"].outliers == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_match_pandas(table, seed):
    random.seed(seed)
    rows = [("hot", random.choice([-1, 1]) * random.expovariate(1.0) ** 9) for _ in range(4000)]
    rows += [("hot", 0.5)] * 1500 + [("small", float(i)) for i in range(2500)] + [(None, 2.0)] * 2100
    rows += [("hot", None), ("hot", float("nan")), ("empty", None)]
    df = table("g STRING, v DOUBLE", *rows).repartition(5)
    probs = (0.01, 0.25, 0.5, 0.75, 0.999)
    got = quantiles(df, "v", probs, ["g"]).collect()
    frame = pd.DataFrame(rows, columns=["g", "v"])
    frame["g"] = frame["g"].fillna("-")
    want = frame.dropna().groupby("g")["v"].quantile(list(probs))
    assert len(got) == 15
    for r in got:
        assert r.value == pytest.approx(want[(r.g or "-", r.prob)], abs=1e-12)
    overall = quantiles(df, "v", probs).collect()
    assert {r.prob: pytest.approx(r.value) for r in overall} == dict(frame.dropna()["v"].quantile(list(probs)))


def test_quantiles_with_far_outliers_and_close_values(spark):
    """Outliers of 1e300 must not leave the bulk to the last window, which sees a few neighbouring doubles at most."""
    df = spark.range(20_000).selectExpr("CASE id WHEN 0 THEN -1e300 WHEN 1 THEN 1e300 ELSE 1.0D + id * 1e-12 END AS v")
    got = quantiles(df, "v", (0.0, 0.5, 1.0)).collect()
    assert [r.value for r in got] == [-1e300, pytest.approx(1.0 + 10_000.5e-12, abs=1e-15), 1e300]


@pytest.mark.parametrize("accuracy", [10, 60, 10_000])
def test_quantiles_of_groups_beyond_the_sketch(spark, accuracy):
    """Brackets narrower than the groups, with ties, heavy values and close quantiles: still exact."""
    rng = random.Random(accuracy)
    rows = [(i % 3, rng.choice([1.0, 1.0, 2.5, rng.random() * 100, rng.gauss(0, 1e-9), -(10.0 ** rng.randint(-300, 300))])) for i in range(6000)]
    rows += [(3, float(v)) for v in range(5)] + [(4, None), (5, 7.0)]
    frame = pd.DataFrame(rows, columns=["g", "v"])
    probs = (0.0, 0.01, 0.25, 0.251, 0.5, 0.75, 0.999, 1.0)
    df = spark.createDataFrame(rows, "g INT, v DOUBLE").repartition(7)
    got = {(r.g, r.prob): r.value for r in quantiles(df, "v", probs, ["g"], accuracy).collect()}
    want = frame.dropna().groupby("g")["v"].quantile(list(probs))
    assert got.keys() == set(want.index) and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in got)


def test_quantiles_scan_twice_and_count_few(spark, tmp_path):
    spark.range(50_000).select((F.col("id") % 40_000).cast("double").alias("v"), F.rand(1).alias("w")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = quantiles(df, ["v", "w"], (0.25, 0.5, 0.75))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    data = df.select(F.col("v").alias("_c0"))
    state = data.agg(qn._brackets("_c0", [0.25, 0.5, 0.75], 10_000).alias("_b0"))
    assert qn._counted(data, state, [], 1, 3).count() < 0.005 * 50_000


def test_approximate_quantiles(table):
    df = table("v DOUBLE", *[(float(i),) for i in range(101)])
    assert values(approximate_quantiles(df, "v", [0.0, 0.5, 1.0])) == [(0.0, 0.0), (0.5, 50.0), (1.0, 100.0)]


def test_pivots(table):
    df = table("t INT, g STRING, v INT", (1, "a", 1), (1, "a", 3), (2, "b", 5), (2, None, 9))
    assert values(pv.pivot_mean(df, "t", "g", "v", ["a", "b", None])) == [(1, 2.0, None, None), (2, None, 5.0, 9.0)]
    assert values(pv.crosstab(df, "t", "g", ["a", "b"])) == [(1, 2, 0), (2, 0, 1)]
    with pytest.raises(Exception, match="more than one v"):
        pv.pivot_unique(df, "t", "g", "v", ["a", "b", None]).collect()
    assert values(pv.pivot_unique(df.where("t = 2"), "t", "g", "v", ["a", "b", None])) == [(2, None, 5, 9)]


def test_mode_ties_go_to_the_smallest(table):
    df = table("d STRING, h STRING, v INT", *[("Mon", "a", v) for v in (2, 1, 1, 2, None, None, None)], ("Tue", "a", 0))
    assert values(pv.pivot_mode(df, "d", "h", "v", ["a", "b"])) == [("Mon", 1, None), ("Tue", 0, None)]


def test_trend_interval(table):
    df = table("x INT, y DOUBLE", (1, 1.0), (1, 3.0), (2, 5.0))
    got = values(agg.trend_mean_ci(df, "x", "y"))
    assert got[0][:2] == (1, 2.0) and got[0][2] == pytest.approx(2 - 1.96 * 2**0.5 / 2**0.5)
    assert got[1] == (2, 5.0, None, None)


def test_bootstrap_draws_convert_no_digits(spark):
    df = spark.range(50).selectExpr("id AS k")
    weighed = agg.bootstrap_weights(df, "k", 12, "w")
    assert "conv(" not in plan_of(weighed)
    for row in weighed.collect():
        digits = [hashlib.md5(f"42:{b // 8}:{row.k}".encode()).hexdigest()[4 * (b % 8) :][:4] for b in range(12)]
        assert row.w == [sum(int(d, 16) >= limit for limit in agg._POISSON) for d in digits]


def test_bootstrap_interval_is_the_same_on_any_partitioning(spark):
    rng = random.Random(6)
    rows = [(i, i % 2, rng.gauss(i % 2, 1)) for i in range(800)] + [(9000, 2, 5.0), (9001, 3, None), (9002, None, 1.0)]
    df = spark.createDataFrame(rows, "k INT, g INT, y DOUBLE")
    found = {r.g: (r.mean, r.ci_low, r.ci_high) for r in agg.bootstrap_mean_ci(df.repartition(3), "g", "y", "k", 120).collect()}
    again = {r.g: (r.mean, r.ci_low, r.ci_high) for r in agg.bootstrap_mean_ci(df.repartition(9), "g", "y", "k", 120).collect()}
    assert found.keys() == {0, 1, 2, None} and all(found[g] == pytest.approx(again[g]) for g in found)
    assert found[2] == (5.0, 5.0, 5.0)
    for g in (0, 1):
        mean, low, high = found[g]
        half = 1.96 / 20  # 400 rows of deviation 1
        assert low < mean < high and abs((high - low) / 2 - half) < 0.35 * half
    weights = agg.bootstrap_weights(df, "k", 40, "w").collect()
    drawn = np.array([r.w for r in weights])
    assert abs(drawn.mean() - 1) < 0.03 and abs(drawn.var() - 1) < 0.05


def test_words_and_errors(table):
    df = table("s STRING", ("Rain, rain the sun",), (None,), ("the sun.",))
    assert values(agg.word_freq(df, "s", ["the"])) == [("rain", 2), ("sun", 2)]
    two = table("a DOUBLE, p DOUBLE", (3.0, 1.0), (5.0, 5.0))
    got = two.agg(agg.rmse("a", "p").alias("e"), agg.rmse_pct_of_mean("a", "p").alias("pct")).first()
    assert got.e == pytest.approx(2**0.5) and got.pct == pytest.approx(100 * 2**0.5 / 4)


# Windows -------------------------------------------------------------------------------------------


def test_shares_sum_to_one_and_zero_totals_are_null(table):
    df = table("g STRING, v DOUBLE", ("a", 1.0), ("a", 3.0), ("z", 0.0), ("z", 0.0), ("n", None), (None, 2.0))
    got = values(wn.share_of_group(df, ["g"], "v"))
    assert got == [(None, 2.0, 2.0, 1.0), ("a", 1.0, 4.0, 0.25), ("a", 3.0, 4.0, 0.75), ("n", None, None, None),
                   ("z", 0.0, 0.0, None), ("z", 0.0, 0.0, None)]


def test_partial_and_full_frames(table):
    rows = [("h", date(2013, 1, 1) + timedelta(days=i), float(i)) for i in range(15)] + [("s", date(2013, 1, 1), 4.0)]
    df = table("k STRING, d DATE, v DOUBLE", *rows)
    got = wn.window_features(
        df, ["k"], ["d"],
        {"lag": wn.lag_of("v"), "s3": wn.rolling_sum("v", 3), "sd": wn.rolling_std("v", 14),
         "full": wn.rolling_mean_full("v", 14)},
    ).where("k = 'h'").orderBy("d").collect()
    assert [r.lag for r in got][:3] == [None, 0.0, 1.0]
    assert [r.s3 for r in got][:4] == [0.0, 1.0, 3.0, 6.0]
    assert got[0].sd is None and got[1].sd == pytest.approx(0.5**0.5)
    assert [r.full for r in got][:13] == [None] * 13 and [r.full for r in got][13:] == [6.5, 7.5]


@pytest.mark.parametrize("width", [1, 3, 40])
def test_chunked_windows_equal_whole_ones(table, width):
    random.seed(width)
    rows = []
    for k, n in (("hot", 300), ("cold", 4), (None, 20)):
        day = 0
        for i in range(n):
            day += random.choice([0, 0, 1, 2, 30])
            rows.append((k, day, i, random.choice([None, random.random()])))
    df = table("k STRING, day INT, id INT, v DOUBLE", *rows).repartition(6)
    features = {
        "lag_1": wn.lag_of("v"), "lag_7": wn.lag_of("v", 7), "sum_5": wn.rolling_sum("v", 5),
        "std_9": wn.rolling_std("v", 9), "full_4": wn.rolling_mean_full("v", 4),
    }
    whole = wn.window_features(df, ["k"], ["day", "id"], features)
    cut = wn.window_features(
        df, ["k"], ["day", "id"], features, chunk=F.floor(F.col("day") / F.lit(width)), lookback=8
    )
    assert cut.columns == whole.columns

    def rounded(frame):
        return values(frame.select("k", "day", "id", "v", *[F.round(c, 9).alias(c) for c in features]))

    assert rounded(cut) == rounded(whole)


def test_windows_share_one_exchange(table):
    df = table("k STRING, d DATE, v DOUBLE", ("a", date(2013, 1, 1), 1.0))
    features = {f"s{n}": wn.rolling_sum("v", n) for n in (3, 7, 14, 30)} | {"l": wn.lag_of("v")}
    assert plan_of(wn.window_features(df, ["k"], ["d"], features)).count("Exchange") == 1


def test_calendar_lag_skips_gaps(table):
    df = table("k STRING, d DATE, v DOUBLE", ("a", date(2013, 1, 1), 1.0), ("a", date(2013, 1, 3), 3.0), ("a", date(2013, 1, 4), 4.0))
    got = wn.calendar_lag(df, ["k"], "d", "v", 1, "y").orderBy("d").collect()
    assert [r.y for r in got] == [None, None, 3.0]


def test_change(table):
    df = table("l DOUBLE, x DOUBLE", (3.0, 1.0), (-1.0, 1.0), (None, 1.0))
    assert [r[0] for r in df.select(wn.relative_change("l", "x")).collect()] == [0.5, None, None]


# Order, sets, splits -------------------------------------------------------------------------------


def test_order_by_list_shows_missing_values(table):
    df = table("d STRING, n INT", ("Tue", 2), ("Mon", 1))
    assert [tuple(r) for r in od.order_by_list(df, "d", ["Mon", "Tue", "Wed"]).collect()] == [("Mon", 1), ("Tue", 2), ("Wed", None)]


def test_top_k_and_limit(table):
    df = table("k STRING, v INT", ("b", 2), ("a", 2), ("c", 9))
    assert [r.k for r in od.top_k(df, "v", 2, "k").collect()] == ["c", "a"]
    assert [r.k for r in od.limit(df, 2, "k").collect()] == ["a", "b"]


def test_batches_are_disjoint_and_complete(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    got = od.batches(df, "k", 30, shards=4).toPandas()
    assert sorted(got.k) == list(range(1000)) and got.shard.nunique() == 4
    sizes = got.groupby(["shard", "batch"]).size()
    assert sizes.max() == 30
    assert all((s.iloc[:-1] == 30).all() for _, s in sizes.groupby(level=0))


def test_global_rank_and_exact_slices(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 1.0, rng.random()]), "x") for i in range(1003)]
    df = spark.createDataFrame(rows, "k INT, v DOUBLE, rank STRING").repartition(7)
    ranked = {r.k: r.rank for r in od.global_rank(df, "v", "k").collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert ranked == {k: i for i, (k, *_) in enumerate(order)}
    cut = od.slices(df, 100, "v", "k")
    assert cut.columns == ["k", "v", "rank", "slice"]
    assert {r.slice: r["count"] for r in cut.groupBy("slice").count().collect()} == {**{i: 100 for i in range(10)}, 10: 3}
    assert od.global_rank(df.where("k < 0"), "k").count() == 0


def test_sets(table):
    a, b = table("x INT", (1,), (1,), (2,)), table("x INT", (2,), (3,))
    assert values(od.union_all([a, b, b])) == [(1,), (1,), (2,), (2,), (2,), (3,), (3,)]
    assert values(od.except_distinct(a, b)) == [(1,)]


@pytest.mark.parametrize("step", [1, 64, 1000])
def test_splits_and_shards_of_regular_keys_are_even(spark, step):
    df = spark.range(0, 20_000 * step, step).withColumnRenamed("id", "k")
    train, _ = od.split(df, [0.8, 0.2], "k")
    assert abs(train.count() / 20_000 - 0.8) < 0.05
    shards = od.batches(df, "k", 100, shards=8).groupBy("shard").count().toPandas()["count"]
    assert len(shards) == 8 and shards.max() < 1.1 * 2500 and shards.min() > 0.9 * 2500


@pytest.mark.parametrize("key", ["id", "name"])
def test_split_is_disjoint_complete_and_stable(spark, key):
    df = spark.range(5000).select("id", F.concat(F.lit("MAC"), F.col("id").cast("string")).alias("name"))
    train, test = od.split(df, [0.8, 0.2], key)
    again, _ = od.split(df.repartition(7), [0.8, 0.2], key)
    ids = lambda d: {r.id for r in d.select("id").collect()}
    assert ids(train) | ids(test) == set(range(5000)) and not ids(train) & ids(test)
    assert ids(train) == ids(again) and 0.75 < len(ids(train)) / 5000 < 0.85
