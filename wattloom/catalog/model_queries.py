"""Feature preparation and models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom import lookups
from wattloom.catalog.job_queries import FEATURE_VIEWS, FEATURES_SQL, feature_rows, series_rows
from wattloom.catalog.join_queries import parsed_holidays_sql
from wattloom.catalog.registry import Tables, query
from wattloom.catalog.source_queries import forecast_days
from wattloom.catalog.stand_ins import daily, holidays, r, rounded, screening_weather, sr, with_views
from wattloom.ml import boosting
from wattloom.ml import features as ft
from wattloom.ml import trees as tr
from wattloom.operators.ordering import split
from wattloom.operators.profiling import corr_with_target
from wattloom.plans import modelling
from wattloom.plans.daily_features import daily_weather_features, forecast_features, household_series_features
from wattloom.shared import materialize, scratch_path
from wattloom.sources import readers


def line_vectors(t: Tables, handle_invalid: str = "error") -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax")
    return ft.assemble(rows, ["l_quantity", "l_discount", "l_tax"], handle_invalid=handle_invalid)


def elements(df: DataFrame, column: str, n: int) -> DataFrame:
    values = vector_to_array(column)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", *[r(values[i]).alias(f"f{i}") for i in range(n)])


@query(
    "m1_assemble",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {sr('l_quantity')} AS f0, {sr('l_discount')} AS f1, {sr('l_tax')} AS f2
        FROM lineitem""",
)
def m1(t: Tables) -> DataFrame:
    return elements(line_vectors(t), "features", 3)


def _scaled_sql(expression: str) -> str:
    cells = ", ".join(
        f"{sr(expression.format(c=c))} AS f{i}" for i, c in enumerate(("l_quantity", "l_discount", "l_tax"))
    )
    return f"SELECT l_orderkey, l_linenumber, l_partkey, {cells} FROM lineitem"


@query("m2_minmax_scale", _scaled_sql("({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())"))
def m2(t: Tables) -> DataFrame:
    scaled, _ = ft.minmax_scale(line_vectors(t))
    return elements(scaled, "scaled_features", 3)


@query("m3_standard_scale", _scaled_sql("{c} / stddev_samp({c}) OVER ()"))
def m3(t: Tables) -> DataFrame:
    scaled, _ = ft.standard_scale(line_vectors(t, "keep"))
    return elements(scaled, "scaled_features", 3)


@query(
    "m4_index_categories",
    """WITH codes AS (SELECT p_type AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) AS code
                      FROM part WHERE p_type <> 'PROMO' GROUP BY 1)
       SELECT p_partkey, coalesce(code, (SELECT max(code) + 1 FROM codes)) AS p_type_indexed
       FROM part LEFT JOIN codes ON p_type = v""",
)
def m4(t: Tables) -> DataFrame:
    known = t.part.where(F.col("p_type") != "PROMO")
    indexed = ft.index_categories(known, ["P_TYPE"]).fit(known).transform(t.part)
    return indexed.select("p_partkey", "p_type_indexed")


@query(
    "m5_label_encode",
    "SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS DOUBLE) AS p_brand_code FROM part",
)
def m5(t: Tables) -> DataFrame:
    return ft.label_encode(t.part, ["p_brand"]).select("p_partkey", "p_brand_code")


@query(
    "m6_split",
    """SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 1000 < 800 THEN 'train' ELSE 'test' END AS part
       FROM orders""",
)
def m6(t: Tables) -> DataFrame:
    train, test = split(t.orders.select("o_orderkey"), [0.8, 0.2], "o_orderkey", 42)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def model_rows(t: Tables) -> DataFrame:
    """The daily feature table, written once: training reads its input several times."""
    keyed = feature_rows(t).withColumn("split_key", F.xxhash64("LCLid", "day"))
    return materialize(keyed, "features")


def forest(rows: DataFrame):
    train, test = split(rows, [0.8, 0.2], "split_key")
    return tr.train_random_forest(train, lookups.FORECAST_FEATURES, "energy_mean", key="split_key"), test


@query("m7_train_random_forest")
def m7(t: Tables) -> DataFrame:
    model, test = forest(model_rows(t))
    return tr.predict(model, test).select("LCLid", "day", "energy_mean", "prediction")


@query("m8_train_boosted_trees")
def m8(t: Tables) -> DataFrame:
    series = household_series_features(series_rows(t))
    rows = materialize(series.withColumn("split_key", F.xxhash64("LCLid", "day")), "series")
    train, test = split(rows, [0.9, 0.1], "split_key")
    model = tr.train_boosted_trees(train, lookups.SERIES_FEATURES, "energy_sum", key="split_key")
    return tr.predict(model, test).select("LCLid", "day", "energy_sum", "prediction")


BOOSTED_ROUNDS, BOOSTED_ALPHA = 4, 60.0


def _boosted_sql() -> str:
    """Stumps over two features of few values, one round after the other: best cut by gain, weights by soft threshold."""
    soft = lambda g: f"sign({g}) * greatest(abs({g}) - {BOOSTED_ALPHA}, 0)"
    score = lambda g, h: f"pow(greatest(abs({g}) - {BOOSTED_ALPHA}, 0), 2) / ({h} + 1.5)"
    views = {
        "r0": """SELECT l_orderkey, l_linenumber, l_linenumber::DOUBLE AS f0, l_discount AS f1, l_extendedprice / 100000.0 AS y,
                        avg(l_extendedprice / 100000.0) OVER () AS p FROM lineitem"""
    }
    for t in range(BOOSTED_ROUNDS):
        views[f"h{t}"] = f"""SELECT f, v, sum(p - y) AS g, count(*) AS h FROM (SELECT 0 AS f, f0 AS v, p, y FROM r{t} UNION ALL SELECT 1, f1, p, y FROM r{t}) GROUP BY 1, 2"""
        views[f"c{t}"] = f"""SELECT f, v, sum(g) OVER (PARTITION BY f ORDER BY v) AS gl, sum(h) OVER (PARTITION BY f ORDER BY v) AS hl,
                                    sum(g) OVER (PARTITION BY f) AS ga, sum(h) OVER (PARTITION BY f) AS ha FROM h{t}"""
        views[f"b{t}"] = f"""SELECT f, v, -({soft('gl')}) / (hl + 1.5) AS wl, -({soft('(ga - gl)')}) / (ha - hl + 1.5) AS wr
                             FROM c{t} WHERE hl >= 5 AND ha - hl >= 5
                             ORDER BY round({score('gl', 'hl')} + {score('(ga - gl)', '(ha - hl)')} - {score('ga', 'ha')}, 7) DESC, f, v LIMIT 1"""
        views[f"r{t + 1}"] = f"""SELECT r.* EXCLUDE (p), p + 0.1 * CASE WHEN CASE WHEN f = 0 THEN f0 ELSE f1 END <= v THEN wl ELSE wr END AS p FROM r{t} r, b{t}"""
    return with_views(f"SELECT l_orderkey, l_linenumber, {sr('p', 5)} AS prediction FROM r{BOOSTED_ROUNDS}", **views)


@query("m8_regularised_trees", _boosted_sql())
def m8_regularised(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_linenumber").cast("double").alias("f0"), F.col("l_discount").alias("f1"),
        (F.col("l_extendedprice") / 100000.0).alias("y"), F.concat_ws(":", "l_orderkey", "l_linenumber").alias("row_key"),
    )
    model = boosting.train_regularised_trees(
        rows, ["f0", "f1"], "y", "row_key", rounds=BOOSTED_ROUNDS, depth=1, alpha=BOOSTED_ALPHA, row_sample=1.0, column_sample=1.0
    )
    return model.predict(rows).select("l_orderkey", "l_linenumber", r("prediction", 5).alias("prediction"))


@query("m9_feature_importance")
def m9(t: Tables) -> DataFrame:
    rows = model_rows(t)
    model, _ = forest(rows)
    return tr.feature_importance(model, rows)


@query("m10_compare_feature_sets")
def m10(t: Tables) -> DataFrame:
    coded = ft.label_encode(model_rows(t), ["precipType"]).drop("precipType").withColumnRenamed(
        "precipType_code", "precipType"
    )
    return tr.compare_feature_sets(materialize(coded, "coded"), lookups.FEATURE_SETS, "energy_mean", "split_key")


@query("m11_predict")
def m11(t: Tables) -> DataFrame:
    rows = model_rows(t)
    model, _ = forest(rows)
    return tr.predict(model, rows, "expected").select("LCLid", "day", "expected")


@query("m12_score_forecast")
def m12(t: Tables) -> DataFrame:
    model, _ = forest(model_rows(t))
    return tr.score_forecast(model, forecast_features(forecast_days(t, "m12")))


@query("m13_actual_vs_predicted")
def m13(t: Tables) -> DataFrame:
    model, test = forest(model_rows(t))
    return tr.actual_vs_predicted(model, test, "LCLid", "day", "energy_mean")


@query("k6_save_and_load_model")
def k6(t: Tables) -> DataFrame:
    rows = model_rows(t)
    model, test = forest(rows)
    path = scratch_path(t.spark, "model")
    tr.save_model(model, path)
    return tr.predict(tr.load_model(path), test).select("LCLid", "day", "prediction")


@query("x9_train_evaluate_export")
def x9(t: Tables) -> DataFrame:
    trained = modelling.train_and_evaluate(model_rows(t))
    path = scratch_path(t.spark, "x9")
    modelling.export_actual_vs_predicted(trained, path, None)
    exported = readers.read_csv_by_key(t.spark, path, "Date DATE, Actual DOUBLE, Predicted DOUBLE", "LCLid")
    per_household = exported.groupBy("LCLid").agg(F.count(F.lit(1)).alias("exported"))
    return per_household.withColumn("rmse", trained.evaluation.select("rmse").scalar())


SCREENED = [
    "temperatureMax", "temperatureMin", "temperatureHigh", "temperatureLow", "apparentTemperatureMax",
    "apparentTemperatureMin", "apparentTemperatureHigh", "apparentTemperatureLow", "humidity", "cloudCover",
    "uvIndex", "pressure", "windSpeed", "windBearing", "is_weekend", "is_holiday", "temp_variation",
    "temp_humidity_interaction", "temp_cloudcover_interaction", "temp_uvindex_interaction", "daylight_duration",
    "temp_daylight_interaction",
]
SCREENED += ["dewPoint", "visibility", "moonPhase"]


def screening_features(t: Tables) -> DataFrame:
    return daily_weather_features(daily(t), screening_weather(t), holidays(t))


def screening_rows(t: Tables) -> DataFrame:
    return materialize(screening_features(t).withColumn("split_key", F.xxhash64("LCLid", "day")), "screening")


@query("x10_screen_features")
def x10(t: Tables) -> DataFrame:
    screening = modelling.screen_features(screening_rows(t), SCREENED)
    return screening.importance


@query("x10_top_features")
def x10_top(t: Tables) -> DataFrame:
    screening = modelling.screen_features(screening_rows(t), SCREENED)
    path = scratch_path(t.spark, "x10")
    modelling.write_top_features(screening, path, 15)
    return t.spark.read.text(path)


@query(
    "x10_correlations",
    with_views(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS variable, {sr(f'corr("{c}", energy_mean)', 4)} AS corr FROM features JOIN screening USING (date)""" for c in SCREENED
        ),
        *FEATURE_VIEWS, "screening", calendar=parsed_holidays_sql(), features=FEATURES_SQL,
    ),
)
def x10_correlations(t: Tables) -> DataFrame:
    return rounded(corr_with_target(screening_features(t), SCREENED, "energy_mean"), digits=4)


@query("x11_score_forecast")
def x11_score(t: Tables) -> DataFrame:
    model, _ = forest(model_rows(t))
    path = scratch_path(t.spark, "x11")
    modelling.forecast_consumption(model, forecast_days(t, "x11"), path)
    return readers.read_csv(t.spark, path, "Date DATE, Predicted_Energy_Consumption DOUBLE")
