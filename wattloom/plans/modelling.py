"""Training, screening and scoring jobs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom import lookups
from wattloom.ml.features import index_categories, resolve_columns
from wattloom.ml.trees import (
    actual_vs_predicted,
    feature_importance,
    predict,
    save_model,
    score_forecast,
    train_random_forest,
)
from wattloom.operators.aggregates import rmse, rmse_pct_of_mean
from wattloom.operators.columns import numeric_columns
from wattloom.operators.filters import drop_null
from wattloom.operators.imputation import fill_const
from wattloom.operators.ordering import split
from wattloom.operators.profiling import corr_with_target
from wattloom.plans.daily_features import forecast_features
from wattloom.sources.writers import write_csv, write_csv_by_key, write_text


@dataclass
class Trained:
    """A fitted model with its error on the held-out rows."""

    model: PipelineModel
    test: DataFrame
    evaluation: DataFrame


def train_and_evaluate(
    rows: DataFrame,
    features: Sequence[str] = lookups.FORECAST_FEATURES,
    label: str = "energy_mean",
    key: str = "split_key",
    weights: Sequence[float] = (0.8, 0.2),
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
    model_path: str | None = None,
) -> Trained:
    """Split by key, train a forest on the first part, report its error on the second.

    The feature list is explicit: columns made from the target exist in the feature table but are not
    used unless asked for.
    """
    known = drop_null(rows, label)
    train, test = split(known, weights, key, seed)
    model = train_random_forest(train, features, label, trees, depth, seed, key)
    if model_path:
        save_model(model, model_path)
    complete = test.na.drop(subset=resolve_columns(test, features))
    evaluation = predict(model, complete).agg(
        F.count(F.lit(1)).alias("rows"),
        rmse(label, "prediction").alias("rmse"),
        rmse_pct_of_mean(label, "prediction").alias("rmse_pct_of_mean"),
    )
    return Trained(model, complete, evaluation)


def export_actual_vs_predicted(
    trained: Trained, path: str, ids: Sequence[object] | DataFrame | None, entity: str = "LCLid",
    date: str = "day", label: str = "energy_mean",
) -> None:
    """One CSV folder per chosen household."""
    write_csv_by_key(actual_vs_predicted(trained.model, trained.test, entity, date, label, ids), path, entity)


@dataclass
class Screening:
    """Which features matter for the target."""

    correlations: DataFrame
    importance: DataFrame
    model: PipelineModel


def screen_features(
    rows: DataFrame,
    numeric: Sequence[str],
    categories: Sequence[str] = lookups.SCREENING_CATEGORIES,
    label: str = "energy_mean",
    key: str = "split_key",
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
) -> Screening:
    """Correlation with the target and forest importances over numeric and indexed text features."""
    names = resolve_columns(rows, categories)
    labelled = fill_const(drop_null(rows, label), {c: "unknown" for c in names})
    indexed = index_categories(labelled, names).fit(labelled).transform(labelled)
    features = [*resolve_columns(rows, numeric), *[f"{c}_indexed" for c in names]]
    train, _ = split(indexed, (0.8, 0.2), key, seed)
    model = train_random_forest(train, features, label, trees, depth, seed, key)
    others = [c for c in numeric_columns(rows) if c not in (label, key)]
    return Screening(
        corr_with_target(rows, others, label), feature_importance(model, indexed), model
    )


def write_top_features(screening: Screening, path: str, k: int = 15) -> None:
    """The names of the k most important features, one per line."""
    best = screening.importance.orderBy(F.desc("Importance"), "Feature").limit(k)
    write_text(best, path, "Feature")


def forecast_consumption(model: PipelineModel, days: DataFrame, path: str | None = None) -> DataFrame:
    """Predicted use for each day of a parsed forecast, written as one CSV when a path is given."""
    scored = score_forecast(model, forecast_features(days))
    if path:
        write_csv(scored, path)
    return scored
