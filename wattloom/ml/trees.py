"""Tree regressions, their evaluation and their storage.

Training is Spark ML's distributed tree growing: features are binned once and each level of the trees
is one aggregation over the executors, so no batch ever reaches the driver.

Trees are fitted on points: rows whose features are all equal go down every tree together, so they are merged first into at most
``BUNDLES`` points (``BOOSTED_BUNDLES`` for boosting, which reads all of them in every level of every round) that weigh as many rows as they hold and have those rows' mean label. A split's worth differs from that over the rows
by what lies within a point, which no split changes. What a tree draws are points, so equal rows are drawn by the bundle; a table whose rows all differ has a
point a row. Each task of a level sends its statistics of all open nodes, whatever rows it holds, so points are dealt over no more tasks than
the cluster has cores or ``TASK_POINTS`` asks for: more files of input mean no more statistics.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.ml.features import resolve_columns
from wattloom.operators.aggregates import rmse
from wattloom.operators.columns import quoted
from wattloom.operators.filters import filter_in
from wattloom.operators.ordering import split
from wattloom.shared import materialize, scratch_dir

#: Points that rows of equal features make at most, in a forest and in boosting, and points of one training task.
BUNDLES, BOOSTED_BUNDLES, TASK_POINTS = 64, 4, 1_000_000


def _pipeline(df: DataFrame, features: Sequence[str], estimator) -> Pipeline:
    """Assembler and trees. Gaps pass the assembler; ``predict`` leaves such rows without a prediction."""
    assembler = VectorAssembler(inputCols=resolve_columns(df, features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, estimator])


def train_random_forest(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
    key: str | None = None,
) -> PipelineModel:
    """Random forest that considers every feature at each split; ``key`` names a row, for the bundle it is drawn with."""
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed,
        featureSubsetStrategy="all", weightCol="_weight",
    )
    return _pipeline(train, features, forest).fit(_points(train, features, label, key, BUNDLES))


def train_boosted_trees(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    rounds: int = 600,
    depth: int = 5,
    step: float = 0.1,
    row_sample: float = 0.85,
    column_sample: float = 0.85,
    min_rows: int = 5,
    seed: int = 42,
    key: str | None = None,
) -> PipelineModel:
    """Gradient-boosted trees with row and column sampling; ``key`` names a row, for the bundle it is drawn with.

    A node keeps ``min_rows`` rows, which is a share of all weight as points hold several.
    """
    points = _cut(_points(train, features, label, key, BOOSTED_BUNDLES))
    rows = points.agg(F.sum("_weight")).first()[0] or 0.0
    least = {"minWeightFractionPerNode": (min_rows - 0.5) / rows} if rows >= 2 * min_rows else {"minInstancesPerNode": min_rows}
    boosted = GBTRegressor(
        featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step,
        subsamplingRate=row_sample, featureSubsetStrategy=str(column_sample), weightCol="_weight", seed=seed, **least,
    )
    return _pipeline(train, features, boosted).fit(points)


def _points(df: DataFrame, features: Sequence[str], label: str, key: str | None, bundles: int = BUNDLES) -> DataFrame:
    """The features, the mean label and the number of rows as ``_weight`` of each bundle of rows with equal features.

    Dealt and sorted by value, so a forest does not depend on how its input is spread.
    """
    names = resolve_columns(df, features)
    named = F.xxhash64(*([quoted(key)] if key else [quoted(c) for c in [*names, label]]))
    known = df.select(
        *[F.col(quoted(c)) for c in names], F.col(quoted(label)).cast("double").alias("_label"), F.pmod(named, F.lit(bundles)).cast("int").alias("_bundle")
    ).na.drop()
    by = [quoted(c) for c in dict.fromkeys([*names, "_bundle"])]
    merged = known.groupBy(*by).agg(F.avg("_label").alias("_label"), F.count(F.lit(1)).cast("double").alias("_weight"))
    stored = materialize(merged, "points")
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-stored.count() // TASK_POINTS))
    dealt = stored.repartition(tasks, *by).sortWithinPartitions(*by)
    kinds = {f.name: f.metadata for f in df.schema.fields}
    return dealt.select(*[F.col(quoted(c)).alias(c, metadata=kinds[c]) for c in names], F.col("_label").alias(label), "_weight")


def _cut(points: DataFrame) -> DataFrame:
    """The same rows in the same tasks, read from the shared folder: no task of any round carries the plan they come from.

    Boosting cuts the lineage of its own sums in the same folder.
    """
    spark = points.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark))
    return points.checkpoint()


def feature_importance(model: PipelineModel, df: DataFrame, suffix: str = "_indexed") -> DataFrame:
    """Feature, Importance by original column name, largest first.

    The model carries one figure per feature, so this table is as short as the feature list.
    """
    assembler, trees = model.stages[-2], model.stages[-1]
    figures = trees.featureImportances.toArray().tolist()
    rows = [
        F.struct(F.lit(n.removesuffix(suffix)).alias("Feature"), F.lit(float(v)).alias("Importance"))
        for n, v in zip(assembler.getInputCols(), figures)
    ]
    table = df.sparkSession.range(1).select(F.inline(F.array(*rows)))
    return (
        table.groupBy("Feature")
        .agg(F.sum("Importance").alias("Importance"))
        .orderBy(F.desc("Importance"), "Feature")
    )


def predict(model: PipelineModel, df: DataFrame, output: str = "prediction") -> DataFrame:
    """Add the model's prediction to every row: NULL where a feature is NULL or NaN."""
    inputs = model.stages[-2].getInputCols()
    scored = model.transform(df).drop("features")
    gap = reduce(
        lambda a, b: a | b, [F.col(quoted(c)).isNull() | F.isnan(F.col(quoted(c)).cast("double")) for c in inputs]
    )
    found = F.when(~gap, F.col("prediction"))
    columns = [found.alias(output) if c == "prediction" else F.col(quoted(c)) for c in scored.columns]
    return scored.select(*columns)


def compare_feature_sets(
    df: DataFrame,
    sets: Mapping[str, Sequence[str]],
    label: str,
    key: str,
    weights: Sequence[float] = (0.8, 0.2),
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
) -> DataFrame:
    """Test error of one forest per named feature set: feature_set, features, rmse.

    All sets are scored on the same test rows: those without a gap in any feature of any set.
    """
    train, test = split(df, weights, key, seed)
    every = dict.fromkeys(c for features in sets.values() for c in resolve_columns(df, features))
    test = test.na.drop(subset=[*every, label])
    results = []
    for name, features in sets.items():
        model = train_random_forest(train, features, label, trees, depth, seed, key)
        scored = predict(model, test)
        results.append(
            scored.agg(rmse(label, "prediction").alias("rmse")).select(
                F.lit(name).alias("feature_set"), F.lit(len(features)).alias("features"), "rmse"
            )
        )
    combined = results[0]
    for other in results[1:]:
        combined = combined.unionByName(other)
    return combined


def score_forecast(model: PipelineModel, forecast: DataFrame, date: str = "date") -> DataFrame:
    """Date, Predicted_Energy_Consumption for each forecast day."""
    return predict(model, forecast).select(
        F.col(date).alias("Date"), F.col("prediction").alias("Predicted_Energy_Consumption")
    )


def actual_vs_predicted(
    model: PipelineModel,
    df: DataFrame,
    entity: str,
    date: str,
    label: str,
    ids: Sequence[object] | DataFrame | None = None,
) -> DataFrame:
    """Entity, Date, Actual, Predicted; for chosen ids, or for all."""
    rows = df if ids is None else filter_in(df, entity, ids)
    return predict(model, rows).select(
        entity, F.col(date).alias("Date"), F.col(label).alias("Actual"), F.col("prediction").alias("Predicted")
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
