"""The model jobs on a label that trees hit exactly, so that SQL can say what every one of them returns.

The label is a step of one feature. Each tree splits there and its leaves have one value each, whatever rows a tree draws, so
predictions are the label, only that feature is of importance, and errors are 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom import lookups
from wattloom.catalog.job_queries import FEATURE_VIEWS, FEATURES_SQL, feature_rows
from wattloom.catalog.join_queries import parsed_holidays_sql
from wattloom.catalog.model_queries import SCREENED, screening_features
from wattloom.catalog.registry import Tables, query
from wattloom.catalog.source_queries import FORECAST_DAYS_SQL, forecast_days
from wattloom.catalog.stand_ins import r, with_views
from wattloom.ml import trees as tr
from wattloom.operators.ordering import split
from wattloom.plans import modelling
from wattloom.plans.daily_features import forecast_features
from wattloom.shared import materialize, scratch_path
from wattloom.sources import readers

STEP, TREES = "CASE WHEN is_weekend = 1 THEN 3.0 ELSE 1.5 END", 20
KEY = """CAST('0x' || substr(md5('42:' || "LCLid" || ':' || strftime(day, '%Y-%m-%d')), 1, 8) AS BIGINT) % 1000"""


def step_sql(sql: str, **more: str) -> str:
    """Over ``steps``: the daily features, the label as ``step``, and whether a row is held out."""
    steps = f"SELECT *, CAST({STEP} AS DOUBLE) AS step, {KEY} >= 800 AS held_out FROM features"
    return with_views(sql, *FEATURE_VIEWS, calendar=parsed_holidays_sql(), features=FEATURES_SQL, steps=steps, **more)


def with_step(rows: DataFrame) -> DataFrame:
    key = F.concat_ws(":", "LCLid", F.date_format("day", "yyyy-MM-dd"))
    return materialize(rows.withColumns({"energy_mean": F.expr(STEP).cast("double"), "split_key": key}), "steps")


def step_forest(t: Tables):
    rows = with_step(feature_rows(t))
    train, test = split(rows, [0.8, 0.2], "split_key")
    return tr.train_random_forest(train, lookups.FORECAST_FEATURES, "energy_mean", TREES, key="split_key"), rows, test


HELD_OUT = step_sql('SELECT "LCLid", day, step AS energy_mean, step AS prediction FROM steps WHERE held_out')
DAYS = with_views(
    """SELECT CAST(make_timestamp(dt * 1000000) AS DATE) AS "Date",
              CASE WHEN temp_max + sunset + sunrise + feels_day + pressure + temp_day IS NULL THEN NULL
                   WHEN isodow(make_timestamp(dt * 1000000)) >= 6 THEN 3.0::DOUBLE ELSE 1.5::DOUBLE END AS "Predicted_Energy_Consumption" FROM days""",
    days=FORECAST_DAYS_SQL,
)


@query("m7_forest_on_steps", HELD_OUT)
def m7(t: Tables) -> DataFrame:
    model, _, test = step_forest(t)
    return tr.predict(model, test).select("LCLid", "day", "energy_mean", r("prediction").alias("prediction"))


@query("k6_saved_forest_on_steps", HELD_OUT)
def k6(t: Tables) -> DataFrame:
    model, _, test = step_forest(t)
    path = scratch_path(t.spark, "model")
    tr.save_model(model, path)
    return tr.predict(tr.load_model(path), test).select("LCLid", "day", "energy_mean", r("prediction").alias("prediction"))


def _importance_sql(names: list[str]) -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS "Feature", {float(c == 'is_weekend')}::DOUBLE AS "Importance" """ for c in names)


@query("m9_importance_on_steps", _importance_sql(lookups.FORECAST_FEATURES))
def m9(t: Tables) -> DataFrame:
    model, rows, _ = step_forest(t)
    return tr.feature_importance(model, rows).withColumn("Importance", r("Importance"))


SETS = {"all": lookups.FORECAST_FEATURES, "calendar": ["is_holiday", "is_weekend"], "step": ["is_weekend"]}


@query("m10_sets_on_steps", " UNION ALL ".join(f"SELECT '{k}' AS feature_set, CAST({len(v)} AS INTEGER) AS features, 0.0::DOUBLE AS rmse" for k, v in SETS.items()))
def m10(t: Tables) -> DataFrame:
    found = tr.compare_feature_sets(with_step(feature_rows(t)), SETS, "energy_mean", "split_key", trees=TREES)
    return found.withColumn("rmse", r("rmse"))


@query("m11_predict_on_steps", step_sql('SELECT "LCLid", day, step AS expected FROM steps'))
def m11(t: Tables) -> DataFrame:
    model, rows, _ = step_forest(t)
    return tr.predict(model, rows, "expected").select("LCLid", "day", r("expected").alias("expected"))


@query("m12_forecast_on_steps", DAYS)
def m12(t: Tables) -> DataFrame:
    model, _, _ = step_forest(t)
    scored = tr.score_forecast(model, forecast_features(forecast_days(t, "m12s")))
    return scored.withColumn("Predicted_Energy_Consumption", r("Predicted_Energy_Consumption"))


@query("m13_actual_on_steps", step_sql('SELECT "LCLid", day AS "Date", step AS "Actual", step AS "Predicted" FROM steps WHERE held_out'))
def m13(t: Tables) -> DataFrame:
    model, _, test = step_forest(t)
    return tr.actual_vs_predicted(model, test, "LCLid", "day", "energy_mean").withColumn("Predicted", r("Predicted"))


@query(
    "x9_export_on_steps",
    step_sql('SELECT "LCLid", count(*) AS exported, sum(step) AS actual, sum(step) AS predicted, 0.0::DOUBLE AS rmse FROM steps WHERE held_out GROUP BY 1'),
)
def x9(t: Tables) -> DataFrame:
    trained = modelling.train_and_evaluate(with_step(feature_rows(t)), trees=TREES)
    path = scratch_path(t.spark, "x9")
    modelling.export_actual_vs_predicted(trained, path, None)
    exported = readers.read_csv_by_key(t.spark, path, "Date DATE, Actual DOUBLE, Predicted DOUBLE", "LCLid")
    sums = exported.groupBy("LCLid").agg(F.count(F.lit(1)).alias("exported"), F.sum("Actual").alias("actual"), F.sum("Predicted").alias("predicted"))
    return sums.withColumn("predicted", r("predicted")).withColumn("rmse", trained.evaluation.select(r("rmse").alias("rmse")).scalar())


def _screening(t: Tables) -> modelling.Screening:
    return modelling.screen_features(with_step(screening_features(t)), SCREENED, ["precipType", "Type", "month"], trees=TREES)


@query("x10_screen_on_steps", _importance_sql([*SCREENED, "precipType", "Type", "month"]))
def x10(t: Tables) -> DataFrame:
    return _screening(t).importance.withColumn("Importance", r("Importance"))


@query("x10_top_on_steps", "SELECT 'is_weekend' AS value")
def x10_top(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "x10s")
    modelling.write_top_features(_screening(t), path, 1)
    return t.spark.read.text(path)


@query("x11_score_on_steps", DAYS)
def x11(t: Tables) -> DataFrame:
    model, _, _ = step_forest(t)
    path = scratch_path(t.spark, "x11s")
    modelling.forecast_consumption(model, forecast_days(t, "x11s"), path)
    scored = readers.read_csv(t.spark, path, "Date DATE, Predicted_Energy_Consumption DOUBLE")
    return scored.withColumn("Predicted_Energy_Consumption", r("Predicted_Energy_Consumption"))
