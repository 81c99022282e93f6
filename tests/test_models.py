"""Feature preparation and tree models."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from conftest import plan_of, values
from pyspark.ml.functions import vector_to_array

from wattloom.catalog import all_queries
from wattloom.ml import boosting
from wattloom.ml import features as ft
from wattloom.ml import trees as tr
from wattloom.plans import modelling


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(600):
        x, noise = rng.random(), rng.random()
        kind = rng.choice(["rain", "snow", None])
        label = 3.0 * x + (1.0 if kind == "rain" else 0.0) if i % 50 else None
        data.append((i, f"MAC{i % 4}", x, noise, kind, label))
    return spark.createDataFrame(
        data, "split_key BIGINT, LCLid STRING, x DOUBLE, noise DOUBLE, kind STRING, energy_mean DOUBLE"
    ).cache()


def test_assembling_and_invalid_values(table):
    df = table("a DOUBLE, B DOUBLE", (1.0, 2.0), (None, 3.0))
    assert ft.assemble(df, ["A", "b"], handle_invalid="skip").count() == 1
    kept = ft.assemble(df, ["a", "b"], handle_invalid="keep").select(vector_to_array("features")).collect()
    assert kept[1][0][0] != kept[1][0][0]
    with pytest.raises(ValueError, match="missing"):
        ft.assemble(df, ["a", "missing"])


def test_scalers(table):
    df = ft.assemble(table("a DOUBLE, b DOUBLE", (1.0, 5.0), (3.0, 5.0), (5.0, 5.0)), ["a", "b"])
    scaled, _ = ft.minmax_scale(df)
    assert [list(r[0]) for r in scaled.select(vector_to_array("scaled_features")).collect()] == [[0.0, 0.5], [0.5, 0.5], [1.0, 0.5]]
    by_sd, _ = ft.standard_scale(df)
    assert [r[0][0] for r in by_sd.select(vector_to_array("scaled_features")).collect()] == [0.5, 1.5, 2.5]


def test_category_codes(table):
    df = table("k STRING", ("b",), ("b",), ("c",), ("a",), (None,))
    model = ft.index_categories(df, ["K"]).fit(df)
    new = table("k STRING", ("b",), ("a",), ("c",), ("zz",), (None,))
    assert [r.k_indexed for r in model.transform(new).collect()] == [0.0, 1.0, 2.0, 3.0, 3.0]
    coded = ft.label_encode(df.na.drop(), ["k"])
    assert dict(values(coded, "k", "k_code")) == {"a": 0.0, "b": 1.0, "c": 2.0}


def test_forest_learns_and_survives_storage(rows, tmp_path):
    path = str(tmp_path / "model")
    trained = modelling.train_and_evaluate(rows, ["x", "noise"], trees=10, depth=5, model_path=path)
    result = trained.evaluation.first()
    assert result.rmse < 0.7 and result.rows > 80
    importance = tr.feature_importance(trained.model, rows).collect()
    assert importance[0].Feature == "x" and sum(r.Importance for r in importance) == pytest.approx(1.0)
    loaded = tr.load_model(path)
    assert values(tr.predict(loaded, trained.test), "split_key", "prediction") == values(
        tr.predict(trained.model, trained.test), "split_key", "prediction")
    modelling.export_actual_vs_predicted(trained, str(tmp_path / "csv"), ["MAC1", "MAC3"], date="split_key")
    assert sorted(d for d in os.listdir(tmp_path / "csv") if "=" in d) == ["LCLid=MAC1", "LCLid=MAC3"]


def test_boosting_learns(rows):
    model = tr.train_boosted_trees(rows, ["x", "noise"], "energy_mean", rounds=10)
    scored = tr.predict(model, rows.na.drop(subset=["energy_mean"]))
    spread = scored.selectExpr("stddev(energy_mean) AS s", "sqrt(avg(pow(energy_mean - prediction, 2))) AS e").first()
    assert spread.e < 0.8 * spread.s


def test_screening(rows, tmp_path):
    screening = modelling.screen_features(rows, ["x", "noise"], ["kind"], trees=10, depth=5)
    assert [r.Feature for r in screening.importance.collect()] == ["x", "kind", "noise"]
    assert screening.correlations.collect()[-1].variable == "x"
    modelling.write_top_features(screening, str(tmp_path / "top"), 2)
    assert values(rows.sparkSession.read.text(str(tmp_path / "top"))) == [("kind",), ("x",)]


def test_feature_sets(rows):
    got = tr.compare_feature_sets(rows, {"good": ["x"], "bad": ["noise"]}, "energy_mean", "split_key", trees=5, depth=4)
    errors = {r.feature_set: r.rmse for r in got.collect()}
    assert errors["good"] < errors["bad"]


def test_forecast_scoring(spark, rows, table, tmp_path):
    train = rows.selectExpr(
        "split_key", "energy_mean", *[f"x + {i} AS {c}" for i, c in enumerate(modelling.lookups.FORECAST_FEATURES)]
    )
    model = tr.train_random_forest(train.na.drop(), modelling.lookups.FORECAST_FEATURES, "energy_mean", trees=3, depth=3)
    days = table(
        "dt BIGINT, sunrise BIGINT, sunset BIGINT, temp STRUCT<day: DOUBLE, max: DOUBLE>, feels_like MAP<STRING, DOUBLE>, pressure DOUBLE",
        (1743336000, 1743313200, 1743359367, (15.57, 16.09), {"day": 14.49, "night": 6.27}, 1021.0),
    )
    scored = modelling.forecast_consumption(model, days, str(tmp_path / "f"))
    assert scored.columns == ["Date", "Predicted_Energy_Consumption"] and scored.count() == 1


class Asked(Exception):
    """Raised in place of a model, with what it was asked to be."""


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
@pytest.mark.parametrize(
    "name",
    ["m7_train_random_forest", "m8_train_boosted_trees", "m9_feature_importance", "m10_compare_feature_sets", "m11_predict",
     "m12_score_forecast", "m13_actual_vs_predicted", "k6_save_and_load_model", "x9_train_evaluate_export",
     "x10_screen_features", "x10_top_features", "x11_score_forecast"],
)
def test_registered_queries_ask_for_whole_models(spark, name, monkeypatch):
    def asked(**parameters):
        raise Asked(parameters)

    monkeypatch.setattr(tr, "RandomForestRegressor", asked)
    monkeypatch.setattr(tr, "GBTRegressor", asked)
    with pytest.raises(Asked) as got:
        all_queries()[name](spark, "/root/testdata/sf0.001")
    wanted = {"maxIter": 600, "maxDepth": 5} if name.startswith("m8") else {"numTrees": 100, "maxDepth": 10}
    assert wanted.items() <= got.value.args[0].items()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
def test_screening_reads_every_weather_column(spark):
    got = {r.Feature: r.Importance for r in all_queries()["x10_screen_features"](spark, "/root/testdata/sf0.001").collect()}
    assert {"dewPoint", "visibility", "moonPhase", "temperatureMax", "is_holiday"} <= got.keys()
    assert abs(sum(got.values()) - 1) < 1e-6


def boosted_by_hand(x, y, rounds, depth, alpha, l2, min_weight, step):
    """The same trees over plain arrays, with a cut at every value."""
    p = np.full(len(y), y.mean())
    soft = lambda g: np.sign(g) * max(abs(g) - alpha, 0)

    def leaf(rows, left):
        g, h = (p - y)[rows].sum(), len(rows)
        best = (1e-9, None)
        for f in range(x.shape[1]) if left else ():
            for cut in sorted(set(x[:, f])):
                a, b = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(len(a), len(b)) >= min_weight:
                    worth = lambda r: soft((p - y)[r].sum()) ** 2 / (len(r) + l2)
                    gain = worth(a) + worth(b) - worth(rows)
                    if gain > best[0] + 1e-9 * abs(best[0]):
                        best = (gain, (a, b))
        if best[1] is None:
            out[rows] = -soft(g) / (h + l2)
        else:
            for side in best[1]:
                leaf(side, left - 1)

    for _ in range(rounds):
        out = np.zeros(len(y))
        leaf(np.arange(len(y)), depth)
        p = p + step * out
    return p


@pytest.mark.parametrize(("alpha", "l2"), [(0.0, 0.0), (3.0, 1.5), (40.0, 1.5)])
def test_regularised_trees_equal_those_by_hand(spark, alpha, l2):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (400, 3)).astype(float)
    y = x[:, 0] * 0.7 + np.where(x[:, 1] > 5, 2.0, -1.0) * (x[:, 2] > 3) + rng.normal(0, 0.3, 400)
    rows = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "k INT, A DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE")
    model = boosting.train_regularised_trees(rows, ["a", "b", "c"], "y", "k", 12, 3, 0.3, alpha, l2, 1.0, 1.0)
    got = np.array([r.prediction for r in model.predict(rows).orderBy("k").collect()])
    assert np.allclose(got, boosted_by_hand(x, y, 12, 3, alpha, l2, 5, 0.3), atol=1e-9)
    leaves = [w for f, w in zip(model.feature[0], model.weight[0]) if f < 0]
    assert alpha < 10 or 0.0 in leaves
    assert sum(model.importance().values()) == sum(f >= 0 for tree in model.feature for f in tree)


def test_regularised_trees_on_any_partitioning_and_with_gaps(spark, monkeypatch):
    monkeypatch.setattr(boosting, "WRITE_EVERY", 2)
    rng = random.Random(2)
    data = [(str(i), rng.random(), rng.choice([None, 1.0, float("nan"), 2.0]), rng.random()) for i in range(300)]
    rows, found = spark.createDataFrame(data, "k STRING, a DOUBLE, b DOUBLE, y DOUBLE"), []
    for n in (1, 5):
        model = boosting.train_regularised_trees(rows.repartition(n), ["a", "b"], "y", "k", rounds=5, depth=2, alpha=0.1)
        found.append({r.k: r.prediction for r in model.predict(rows).collect()})
    assert all(found[0][k] is None or abs(found[0][k] - v) < 1e-9 for k, v in found[1].items())
    assert {k for k, _, b, _ in data if b is None or b != b} == {k for k, v in found[0].items() if v is None}
    nothing = boosting.train_regularised_trees(rows.where("a > 5"), ["a", "b"], "y", "k", rounds=2)
    assert nothing.feature == [] and nothing.predict(rows).where("prediction = 0").count() > 0


def test_forest_merges_equal_rows_and_does_not_depend_on_partitions(spark):
    rng = random.Random(11)
    days = [(float(d % 2), rng.random() * 9) for d in range(12)]
    data = [(i, *days[i % 12], "ab"[i % 2], days[i % 12][1] + rng.random()) for i in range(12 * 200)] + [(-1, None, 1.0, "a", 5.0), (-2, 1.0, 1.0, "a", None)]
    rows = spark.createDataFrame(data, "k BIGINT, flag DOUBLE, Warm DOUBLE, kind STRING, y DOUBLE")
    indexed = ft.index_categories(rows, ["kind"]).fit(rows).transform(rows)
    names = ["flag", "warm", "kind_indexed"]
    points = tr._points(indexed, names, "y", "k")
    found = points.groupBy("Warm").agg({"*": "count", "_weight": "sum"}).collect()
    assert len(found) == 12 and all(row["sum(_weight)"] == 200 and row["count(1)"] <= tr.BUNDLES for row in found)
    assert points.selectExpr("sum(y * _weight)").first()[0] == pytest.approx(sum(d[4] for d in data[:-2]))
    scored = []
    for n in (1, 7):
        model = tr.train_random_forest(indexed.repartition(n), names, "y", trees=5, depth=4, key="k")
        scored.append([r.prediction for r in tr.predict(model, indexed.where("k >= 0")).orderBy("k").collect()])
    assert scored[0] == pytest.approx(scored[1], abs=1e-9)
    assert points.schema["kind_indexed"].metadata["ml_attr"]["type"] == "nominal"


def test_boosting_merges_equal_rows_and_counts_them_in_its_nodes(spark, monkeypatch):
    rng, given = random.Random(12), []
    data = [(i, float(i % 6), float(i % 3), (i % 6) * 2.0 + rng.random()) for i in range(6 * 100)] + [(-1, None, 1.0, 5.0), (-2, 1.0, 1.0, None)]
    rows = spark.createDataFrame(data, "k BIGINT, Warm DOUBLE, b DOUBLE, y DOUBLE")
    pipeline = tr._pipeline

    class Recorded:
        def __init__(self, *parts):
            self.stages = pipeline(*parts)

        def fit(self, points):
            given.append(points)
            return self.stages.fit(points)

    monkeypatch.setattr(tr, "_pipeline", Recorded)
    model = tr.train_boosted_trees(rows, ["warm", "b"], "y", rounds=30, key="k")
    found = given[0].groupBy("Warm").agg({"*": "count", "_weight": "sum"}).collect()
    assert len(found) == 6 and all(row["sum(_weight)"] == 100 and row["count(1)"] <= tr.BOOSTED_BUNDLES for row in found)
    means = {w: np.mean([d[3] for d in data[:-2] if d[1] == w]) for w in map(float, range(6))}
    scored = tr.predict(model, rows.where("k >= 0")).select("Warm", "prediction").distinct().collect()
    assert len(scored) == 6 and all(abs(r.prediction - means[r.Warm]) < 0.2 for r in scored)
    few = tr.train_boosted_trees(rows.where("k BETWEEN 0 AND 8"), ["warm", "b"], "y", rounds=2, key="k")
    assert all(tree.numNodes == 1 for tree in few.stages[-1].trees)


def test_boosting_tasks_do_not_carry_the_plan_of_their_points(spark, rows, monkeypatch):
    given, pipeline = [], tr._pipeline

    class Recorded:
        def __init__(self, *parts):
            self.stages = pipeline(*parts)

        def fit(self, points):
            given.append(points)
            return self.stages.fit(points)

    monkeypatch.setattr(tr, "_pipeline", Recorded)
    model = tr.train_boosted_trees(rows, ["x", "noise"], "energy_mean", rounds=3, key="split_key")
    assert "Exchange" not in plan_of(given[0]) and "Scan parquet" not in plan_of(given[0])
    dealt = tr._points(rows, ["x", "noise"], "energy_mean", "split_key", tr.BOOSTED_BUNDLES)
    assert given[0].rdd.glom().collect() == dealt.rdd.glom().collect() and len(model.stages[-1].trees) == 3
