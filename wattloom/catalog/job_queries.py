"""End-to-end jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom import lookups
from wattloom.catalog.aggregate_queries import (
    CALENDAR_SQL,
    TIMES,
    box_sql,
    corr_sql,
    describe_sql,
    histogram_sql,
    unstack_sql,
)
from wattloom.catalog.column_queries import FACTORS_SQL, LONG_DETAILS_SQL, RATIO_GROUPS
from wattloom.catalog.join_queries import parsed_holidays_sql
from wattloom.catalog.registry import Tables, query
from wattloom.catalog.source_queries import FORECAST_DAYS_SQL, forecast_days
from wattloom.catalog.stand_ins import (
    acorn_information,
    daily,
    details,
    event_days,
    holidays,
    households,
    property_efficiency,
    property_types,
    r,
    readings,
    rounded,
    sr,
    tariff,
    weather,
    with_views,
)
from wattloom.plans import daily_features as feats
from wattloom.plans import demographics as demo
from wattloom.plans import profiles
from wattloom.plans import tariffs as tf
from wattloom.shared import scratch_path

EFFICIENCY_SQL = """
    SELECT "Acorn", sum("Current Efficiency" * share) AS "Efficiency_Value",
           sum("Potential Efficiency" * share) AS "Potential_Value",
           sum("Potential Efficiency" * share) - sum("Current Efficiency" * share) AS "Difference_Value"
    FROM (SELECT *, "Value" / nullif(sum("Value") OVER (PARTITION BY "Acorn"), 0) AS share FROM long
          WHERE "MAIN CATEGORIES" = 'HOUSING' AND "CATEGORIES" = 'House Type')
    LEFT JOIN property_efficiency ON "REFERENCE" = "Housing Type"
    GROUP BY 1"""


@query(
    "x1_enrich_halfhourly",
    with_views(
        f"""SELECT "Acorn", "LCLid", tstp, energy, "stdorToU", "Acorn_grouped", "Acorn Category", "Tariff",
                   {sr('"Efficiency_Value"', 4)} AS "Efficiency_Value", {sr('"Potential_Value"', 4)} AS "Potential_Value",
                   {sr('"Difference_Value"', 4)} AS "Difference_Value"
            FROM readings JOIN tariff ON tstp = "TariffDateTime" LEFT JOIN households USING ("LCLid")
                 LEFT JOIN acorn_information USING ("Acorn") LEFT JOIN efficiency USING ("Acorn")""",
        "readings", "tariff", "households", "acorn_information", "details", "property_efficiency",
        long=LONG_DETAILS_SQL, efficiency=EFFICIENCY_SQL,
    ),
)
def x1(t: Tables) -> DataFrame:
    efficiency = demo.efficiency_by_group(details(t), property_efficiency(t))
    enriched = tf.enrich_halfhourly(readings(t), households(t), acorn_information(t), tariff(t), efficiency)
    return rounded(enriched, "Efficiency_Value", "Potential_Value", "Difference_Value", digits=4)


@query(
    "x2_demographic_share",
    with_views(
        f"""SELECT *, {sr('sum("Value") OVER g', 4)} AS "Total",
                   {sr('"Value" / nullif(sum("Value") OVER g, 0)')} AS "Percentage"
            FROM long WINDOW g AS (PARTITION BY "MAIN CATEGORIES", "CATEGORIES", "Acorn")""",
        "details", long=LONG_DETAILS_SQL,
    ),
)
def x2(t: Tables) -> DataFrame:
    return rounded(rounded(demo.demographic_share(details(t)), "Total", digits=4), "Percentage")


@query(
    "x3_efficiency_by_group",
    with_views(
        f"""SELECT "Acorn", {sr('"Efficiency_Value"', 4)} AS "Efficiency_Value",
                   {sr('"Potential_Value"', 4)} AS "Potential_Value", {sr('"Difference_Value"', 4)} AS "Difference_Value"
            FROM efficiency""",
        "details", "property_efficiency", long=LONG_DETAILS_SQL, efficiency=EFFICIENCY_SQL,
    ),
)
def x3(t: Tables) -> DataFrame:
    return rounded(demo.efficiency_by_group(details(t), property_efficiency(t)), digits=4)


USAGE_SQL = """
    SELECT * FROM readings LEFT JOIN households USING ("LCLid") LEFT JOIN acorn_information USING ("Acorn")
    WHERE tstp IN (SELECT "TariffDateTime" FROM tariff)"""
USAGE_VIEWS = ("readings", "households", "acorn_information", "tariff")


@query(
    "x4_tariff_slot_usage",
    with_views(
        f"""SELECT "TariffDateTime", "Tariff", tstp, "LCLid", "Acorn", "Acorn_grouped", "Acorn Category", "stdorToU",
                   {sr('mean_energy', 4)} AS mean_energy
            FROM tariff LEFT JOIN (
              SELECT tstp, "LCLid", "Acorn", "Acorn_grouped", "Acorn Category", "stdorToU", avg(energy) AS mean_energy
              FROM usage GROUP BY ALL) ON "TariffDateTime" = tstp""",
        *USAGE_VIEWS, usage=USAGE_SQL,
    ),
)
def x4(t: Tables) -> DataFrame:
    usage = tf.tariff_slot_usage(readings(t), households(t), acorn_information(t), tariff(t))
    return rounded(usage, "mean_energy", digits=4)


def _slot_pivot_sql(group: str, values: list[str | None]) -> str:
    test = lambda v: f'"{group}" IS NULL' if v is None else f""""{group}" = '{v}'"""
    cells = ", ".join(f"""avg(CASE WHEN {test(v)} THEN energy END) AS "{v or 'null'}" """ for v in values)
    values = [v or "null" for v in values]
    shown = ", ".join(f"""{sr(f'"{v}"', 4)} AS "{v}" """ for v in values)
    return with_views(
        f"""SELECT "TariffDateTime" AS "Datetime", "Tariff", {shown}
            FROM tariff LEFT JOIN (SELECT tstp, {cells} FROM usage GROUP BY 1) ON "TariffDateTime" = tstp""",
        *USAGE_VIEWS, usage=USAGE_SQL,
    )


def _slot_pivot(t: Tables, group: str, values: list[str | None]) -> DataFrame:
    wide = tf.tariff_slot_pivot(
        readings(t), households(t), acorn_information(t), tariff(t), group, values
    )
    return rounded(wide, digits=4)


ALL_CODES = [*lookups.ACORN_PROFILE, "ACORN-", None]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", None]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", None]


@query("x5_slot_pivot_acorn", _slot_pivot_sql("Acorn", ALL_CODES))
def x5_acorn(t: Tables) -> DataFrame:
    return _slot_pivot(t, "Acorn", ALL_CODES)


@query("x5_slot_pivot_grouped", _slot_pivot_sql("Acorn_grouped", SEGMENTS))
def x5_grouped(t: Tables) -> DataFrame:
    return _slot_pivot(t, "Acorn_grouped", SEGMENTS)


@query("x5_slot_pivot_category", _slot_pivot_sql("Acorn Category", REGIONS))
def x5_category(t: Tables) -> DataFrame:
    return _slot_pivot(t, "Acorn Category", REGIONS)


def _as_blocks(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.option("header", True).csv(path)
    return path


@query(
    "x6_combine_halfhourly",
    with_views(
        'SELECT "LCLid", tstp, CASE WHEN energy < 400 THEN energy END AS energy FROM readings', "readings"
    ),
)
def x6_halfhourly(t: Tables) -> DataFrame:
    energy = F.when(F.col("energy") < 400, F.col("energy").cast("string")).otherwise("Null")
    text = readings(t).select("LCLid", F.col("tstp").cast("string"), energy.alias("energy(kWh/hh)"))
    return feats.combine_halfhourly(t.spark, _as_blocks(text, "x6a"))


@query(
    "x6_combine_daily",
    with_views(
        f"""SELECT "LCLid", CAST(day AS VARCHAR) AS day, energy_count, {sr('energy_mean', 4)} AS energy_mean,
                   {sr('energy_sum', 4)} AS energy_sum FROM event_days WHERE energy_count = 2""",
        "event_days",
    ),
)
def x6_daily(t: Tables) -> DataFrame:
    missing = F.lit(None).cast("double")
    text = event_days(t).select(
        "LCLid", F.col("day").cast("string").alias("day"), missing.alias("energy_median"), "energy_mean", "energy_max",
        "energy_count", missing.alias("energy_std"), "energy_sum", "energy_min",
    )
    kept = feats.combine_daily(t.spark, _as_blocks(text, "x6b"), 2)
    return rounded(kept.select("LCLid", "day", "energy_count", "energy_mean", "energy_sum"), digits=4)


FEATURES_SQL = """
    SELECT *, "temperatureMax" - "temperatureMin" AS temp_variation,
           humidity * "temperatureMax" AS temp_humidity_interaction,
           "cloudCover" * "temperatureMax" AS temp_cloudcover_interaction,
           "uvIndex" * "temperatureMax" AS temp_uvindex_interaction,
           is_weekend * energy_mean AS weekend_energy_interaction,
           is_holiday * energy_mean AS holiday_energy_interaction,
           daylight_duration * "temperatureMax" AS temp_daylight_interaction
    FROM (
      SELECT "LCLid", day, energy_mean, energy_max, energy_count, energy_sum, energy_min,
             time, strptime("sunriseTime", '%d/%m/%Y %H:%M') AS "sunriseTime",
             strptime("sunsetTime", '%d/%m/%Y %H:%M') AS "sunsetTime", "temperatureMax", "temperatureMin",
             "temperatureHigh", "temperatureLow", "apparentTemperatureMax", "apparentTemperatureMin",
             "apparentTemperatureHigh", "apparentTemperatureLow", humidity,
             coalesce("cloudCover", (SELECT avg("cloudCover") FROM weather)) AS "cloudCover",
             coalesce("uvIndex", 0.0) AS "uvIndex", pressure, "windSpeed", "windBearing", "precipType", date,
             coalesce("Type", 'No Holiday') AS "Type", dayname(day) AS day_of_week, monthname(day) AS month,
             CASE WHEN month(day) IN (12, 1, 2) THEN 'Winter' WHEN month(day) <= 5 THEN 'Spring'
                  WHEN month(day) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season,
             CAST(CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
             CAST(CASE WHEN "Type" IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS is_holiday,
             date_diff('second', strptime("sunriseTime", '%d/%m/%Y %H:%M'),
                       strptime("sunsetTime", '%d/%m/%Y %H:%M')) / 3600.0 AS daylight_duration
      FROM daily JOIN (SELECT *, CAST(strptime(time, '%d/%m/%Y %H:%M') AS DATE) AS date FROM weather) ON day = date
           LEFT JOIN calendar ON day = holiday
      WHERE pressure IS NOT NULL)"""
FEATURE_VIEWS = ("daily", "weather", "holidays")
FEATURE_DOUBLES = [
    "energy_mean", "energy_max", "energy_sum", "energy_min", "humidity", "cloudCover", "pressure", "windSpeed",
    "temp_variation", "temp_humidity_interaction", "temp_cloudcover_interaction", "temp_uvindex_interaction",
    "weekend_energy_interaction", "holiday_energy_interaction", "daylight_duration", "temp_daylight_interaction",
]


def _replace_sql(columns: list[str], digits: int) -> str:
    return "* REPLACE (" + ", ".join(f'{sr(chr(34) + c + chr(34), digits)} AS "{c}"' for c in columns) + ")"


def feature_rows(t: Tables) -> DataFrame:
    return feats.daily_weather_features(daily(t), weather(t), holidays(t))


@query(
    "x7_daily_weather_features",
    with_views(
        f"SELECT {_replace_sql(FEATURE_DOUBLES, 4)} FROM features",
        *FEATURE_VIEWS, calendar=parsed_holidays_sql(), features=FEATURES_SQL,
    ),
)
def x7(t: Tables) -> DataFrame:
    return rounded(feature_rows(t), *FEATURE_DOUBLES, digits=4)


def _frame(n: int) -> str:
    return f"OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


SERIES_SQL = f"""
    SELECT "LCLid", day, energy_sum, "temperatureMax", "temperatureMin", humidity, "cloudCover",
           lag(energy_sum, 1) OVER w AS lag_1_day, lag(energy_sum, 2) OVER w AS lag_2_day,
           lag(energy_sum, 7) OVER w AS lag_7_day, sum(energy_sum) {_frame(3)} AS rolling_energy_3d,
           sum(energy_sum) {_frame(7)} AS rolling_energy_7d, sum(energy_sum) {_frame(14)} AS rolling_energy_14d,
           sum(energy_sum) {_frame(30)} AS rolling_energy_30d, avg(energy_sum) {_frame(14)} AS rolling_energy_mean_14d,
           stddev_samp(energy_sum) {_frame(14)} AS rolling_energy_std_14d
    FROM features WINDOW w AS (PARTITION BY "LCLid" ORDER BY day)"""
SERIES_COLUMNS = [c for c in lookups.SERIES_FEATURES if c not in ("day_of_week", "is_weekend", "month", "hour")]


@query(
    "x8_household_series_features",
    with_views(
        f"""SELECT "LCLid", day, CAST(dayofweek(day) + 1 AS INTEGER) AS day_of_week,
                   CAST(CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
                   CAST(month(day) AS INTEGER) AS month, CAST(dayofyear(day) % 24 AS INTEGER) AS hour,
                   {', '.join(f'{sr(f"coalesce({c}, 0)", 4)} AS {c}' for c in ('lag_1_day', 'lag_2_day', 'lag_7_day'))},
                   {', '.join(f'{sr(c, 4)} AS {c}' for c in ('rolling_energy_3d', 'rolling_energy_7d', 'rolling_energy_14d', 'rolling_energy_30d', 'rolling_energy_mean_14d'))},
                   {sr('coalesce(rolling_energy_std_14d, (SELECT stddev_samp(energy_sum) FROM features))', 4)} AS rolling_energy_std_14d,
                   {sr('coalesce(rolling_energy_3d - lag_1_day, 0)', 4)} AS energy_trend_3d,
                   {sr('coalesce(rolling_energy_7d - lag_1_day, 0)', 4)} AS energy_trend_7d,
                   {sr('coalesce((lag_1_day - energy_sum) / (lag_1_day + 1), 0)', 4)} AS daily_energy_change,
                   {sr('"temperatureMax" - "temperatureMin"', 4)} AS temperature_variability,
                   {sr('humidity * "temperatureMax"', 4)} AS humidity_temp_interaction,
                   {sr('"cloudCover" * "temperatureMax"', 4)} AS cloud_temp_interaction
            FROM series""",
        *FEATURE_VIEWS, calendar=parsed_holidays_sql(), features=FEATURES_SQL, series=SERIES_SQL,
    ),
)
def x8(t: Tables) -> DataFrame:
    series = feats.household_series_features(series_rows(t))
    return rounded(series.select("LCLid", "day", *lookups.SERIES_FEATURES), *SERIES_COLUMNS, digits=4)


def series_rows(t: Tables) -> DataFrame:
    """Daily rows with the time of a reading, whose hour goes round with the day of the year."""
    hour = F.lpad((F.dayofyear("day") % 24).cast("string"), 2, "0")
    time = F.concat(F.date_format("day", "yyyy-MM-dd "), hour, F.lit(":30:00"))
    return feature_rows(t).select(
        "LCLid", "day", "energy_sum", "temperatureMax", "temperatureMin", "humidity", "cloudCover", time.alias("time")
    )


@query(
    "x11_forecast_features",
    with_views(
        f"""SELECT CAST(make_timestamp(dt * 1000000) AS DATE) AS date,
                   CAST(CASE WHEN isodow(make_timestamp(dt * 1000000)) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
                   {sr('temp_max * (sunset - sunrise) / 3600.0', 4)} AS temp_daylight_interaction,
                   CAST(0 AS INTEGER) AS is_holiday, temp_max AS "temperatureMax",
                   greatest(feels_day, feels_night, feels_morn) AS "apparentTemperatureMax",
                   least(feels_day, feels_night, feels_morn) AS "apparentTemperatureMin",
                   feels_day AS "apparentTemperatureHigh", temp_day AS "temperatureHigh",
                   CAST(pressure AS INTEGER) AS pressure, {sr('(sunset - sunrise) / 3600.0', 4)} AS daylight_duration
            FROM days""",
        days=FORECAST_DAYS_SQL,
    ),
)
def x11(t: Tables) -> DataFrame:
    days = feats.forecast_features(forecast_days(t, "x11"))
    return rounded(days, "temp_daylight_interaction", "daylight_duration", digits=4)


def _profile_sql() -> str:
    parts = []
    labels = {
        "acorn": '"Acorn"',
        "lifestyle": lookups.LIFESTYLES,
        "housing": lookups.HOUSING_TYPES,
        "tenure": lookups.TENURES,
        "income": lookups.INCOMES,
        "income_band": {
            code: lookups.INCOME_BANDS[income]
            for code, income in lookups.INCOMES.items() if income in lookups.INCOME_BANDS
        },
    }
    for name, label in labels.items():
        if isinstance(label, dict):
            label = 'CASE "Acorn" ' + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in label.items()) + " END"
        parts.append(
            f"""SELECT '{name}' AS grouping, strftime(tstp, '%H:%M') AS time_of_day, {label} AS "group",
                       {sr('avg(energy)', 4)} AS energy FROM period WHERE {label} IS NOT NULL GROUP BY 2, 3"""
        )
    return with_views(
        " UNION ALL ".join(parts), "readings", "households",
        period="""SELECT * FROM readings JOIN households USING ("LCLid")
                  WHERE tstp >= TIMESTAMP '2024-01-03' AND tstp < TIMESTAMP '2024-01-24'""",
    )


@query("x12_time_of_day_profiles", _profile_sql())
def x12(t: Tables) -> DataFrame:
    return rounded(
        tf.time_of_day_profiles(readings(t), households(t), "2024-01-03", "2024-01-24"), "energy", digits=4
    )


def _actual_vs_potential_sql() -> str:
    cells = ", ".join(f"""avg(CASE WHEN "Acorn" = '{g}' THEN energy END) AS "{g}" """ for g in RATIO_GROUPS)
    long = " UNION ALL ".join(
        f"""SELECT '{g}' AS "group", "Datetime", "{g}" AS actual,
                   "{g}" * (SELECT factor FROM factors WHERE "Acorn" = '{g}') AS potential FROM wide"""
        for g in RATIO_GROUPS
    )
    return with_views(
        f"""SELECT "group", CAST(hour("Datetime") AS INTEGER) AS hour, {sr('avg(actual)', 4)} AS actual,
                   {sr('avg(potential)', 4)} AS potential, {sr('avg(actual) - avg(potential)', 4)} AS difference,
                   {sr('any_value(p25)', 4)} AS p25, {sr('any_value(p50)', 4)} AS p50, {sr('any_value(p75)', 4)} AS p75
            FROM long JOIN quarts USING ("group") GROUP BY 1, 2""",
        *USAGE_VIEWS, "property_types", "property_efficiency",
        usage=USAGE_SQL, factors=FACTORS_SQL,
        wide=f"""SELECT "TariffDateTime" AS "Datetime", pivoted.* EXCLUDE (tstp) FROM tariff
                 LEFT JOIN (SELECT tstp, {cells} FROM usage GROUP BY 1) AS pivoted ON "TariffDateTime" = tstp""",
        long=long,
        quarts="""SELECT "group", quantile_cont(actual, 0.25) AS p25, quantile_cont(actual, 0.5) AS p50,
                         quantile_cont(actual, 0.75) AS p75 FROM long GROUP BY 1""",
    )


@query("x13_actual_vs_potential", _actual_vs_potential_sql())
def x13(t: Tables) -> DataFrame:
    wide = tf.tariff_slot_pivot(
        readings(t), households(t), acorn_information(t), tariff(t), "Acorn", RATIO_GROUPS
    )
    both = tf.potential_use(wide, property_efficiency(t), property_types(t), "rank", RATIO_GROUPS)
    return rounded(tf.actual_vs_potential(both, RATIO_GROUPS), digits=4)


@query(
    "x14_daily_tariff_grid",
    with_views(
        'SELECT "Date", '
        + ", ".join(f"""max(CASE WHEN "Time" = '{h}' THEN "TariffNumeric" END) AS "{h}" """ for h in TIMES)
        + " FROM calendar GROUP BY 1",
        "tariff", calendar=CALENDAR_SQL,
    ),
)
def x14_grid(t: Tables) -> DataFrame:
    return tf.daily_tariff_grid(tariff(t))


@query(
    "x14_weekly_tariff_mode",
    with_views(
        'SELECT d AS "DayOfWeek", '
        + ", ".join(f"""max(CASE WHEN "Time" = '{h}' THEN "TariffNumeric" END) AS "{h}" """ for h in TIMES)
        + """ FROM (SELECT unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']) AS d)
              LEFT JOIN modes ON d = "DayOfWeek" WHERE k = 1 OR k IS NULL GROUP BY 1""",
        "tariff", calendar=CALENDAR_SQL,
        modes="""SELECT *, row_number() OVER (PARTITION BY "DayOfWeek", "Time" ORDER BY n DESC, "TariffNumeric") AS k
                 FROM (SELECT "DayOfWeek", "Time", "TariffNumeric", count(*) AS n FROM calendar GROUP BY 1, 2, 3)""",
    ),
)
def x14_mode(t: Tables) -> DataFrame:
    return tf.weekly_tariff_mode(tariff(t))


@query("x14_frequency_by_time", unstack_sql("Time"))
def x14_time(t: Tables) -> DataFrame:
    return tf.tariff_frequency(tariff(t), "Time")


@query("x14_frequency_by_weekday", unstack_sql("DayOfWeek"))
def x14_weekday(t: Tables) -> DataFrame:
    return tf.tariff_frequency(tariff(t), "DayOfWeek")


@query("x14_frequency_by_month", unstack_sql("Month"))
def x14_month(t: Tables) -> DataFrame:
    return tf.tariff_frequency(tariff(t), "Month")


PROFILED = ["energy_mean", "energy_max", "energy_count", "energy_sum", "energy_min"]


def _profile(t: Tables, part: str, name: str | None = None) -> DataFrame:
    return rounded(profiles.table_profile(daily(t), PROFILED, [part])[name or part], digits=4)


@query("x15_profile_describe", with_views(describe_sql("daily", PROFILED), "daily"))
def x15_describe(t: Tables) -> DataFrame:
    return _profile(t, "describe")


@query("x15_profile_correlations", with_views(corr_sql("daily", PROFILED, 4), "daily"))
def x15_correlations(t: Tables) -> DataFrame:
    return _profile(t, "correlations")


@query("x15_profile_boxes", with_views(box_sql("daily", PROFILED), "daily"))
def x15_boxes(t: Tables) -> DataFrame:
    return _profile(t, "boxes")


def _histogram(column: str, name: str) -> None:
    sql = histogram_sql("daily", column, 30).replace("WITH e AS", with_views("", "daily").rstrip() + ", e AS", 1)
    query(name, sql)(lambda t: _profile(t, "histograms", f"histogram_{column}"))


_histogram("energy_sum", "x15_profile_histogram")
for _column in PROFILED:
    if _column != "energy_sum":
        _histogram(_column, f"x15_profile_histogram_{_column}")

WEATHER_COLUMNS = [
    "time", "sunriseTime", "sunsetTime", "uvIndexTime", "temperatureMax", "temperatureMin", "temperatureHigh", "temperatureLow",
    "apparentTemperatureMax", "apparentTemperatureMin", "apparentTemperatureHigh", "apparentTemperatureLow", "humidity", "cloudCover",
    "uvIndex", "pressure", "windSpeed", "windBearing", "precipType",
]


@query(
    "x15_profile_nulls",
    with_views(
        " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS nulls FROM weather""" for c in WEATHER_COLUMNS),
        "weather",
    ),
)
def x15_nulls(t: Tables) -> DataFrame:
    return profiles.table_profile(weather(t), parts=["nulls"])["nulls"]


@query(
    "x15_profile_shape",
    with_views(
        " UNION ALL ".join(
            f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS "column", '{k}' AS type, count(*) AS rows,
                CAST(7 AS INTEGER) AS columns FROM daily"""
            for i, (c, k) in enumerate(
                [("LCLid", "string"), ("day", "date"), ("energy_mean", "double"), ("energy_max", "double"),
                 ("energy_count", "int"), ("energy_sum", "double"), ("energy_min", "double")]
            )
        ),
        "daily",
    ),
)
def x15_shape(t: Tables) -> DataFrame:
    return _profile(t, "shape")


def _smooth(column: str) -> str:
    frame = 'OVER (PARTITION BY "LCLid" ORDER BY day ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)'
    return f"CASE WHEN count({column}) {frame} = 14 THEN {sr(f'avg({column}) {frame}', 4)} END"


@query(
    "x16_smoothed_weather",
    with_views(
        f"""SELECT "LCLid", day, {_smooth('"temperatureMin"')} AS temp_min_smooth,
                   {_smooth('"temperatureMax"')} AS temp_max_smooth, {_smooth('energy_sum')} AS energy_smooth
            FROM daily JOIN (SELECT *, CAST(strptime(time, '%d/%m/%Y %H:%M') AS DATE) AS day FROM weather) USING (day)""",
        "daily", "weather",
    ),
)
def x16(t: Tables) -> DataFrame:
    dated = weather(t).select(
        F.to_date(feats.parse_ts("time", feats.STAMP)).alias("day"), "temperatureMin", "temperatureMax"
    )
    smooth = feats.smoothed_weather(daily(t).select("LCLid", "day", "energy_sum"), dated)
    return rounded(
        smooth.select("LCLid", "day", "temp_min_smooth", "temp_max_smooth", "energy_smooth"), digits=4
    )


@query(
    "x17_daily_with_households",
    with_views(
        f"""SELECT "Acorn", "LCLid", day, energy_count, {sr('energy_sum', 4)} AS energy_sum, "stdorToU", "Acorn_grouped",
                   file, "Acorn Category", r_regionkey
            FROM event_days LEFT JOIN households USING ("LCLid")
                 LEFT JOIN (SELECT * FROM acorn_information LEFT JOIN region ON "Acorn Category" = r_name) USING ("Acorn")""",
        "event_days", "households", "acorn_information",
    ),
)
def x17(t: Tables) -> DataFrame:
    categories = t.region.select(F.col("r_name").alias("Acorn Category"), "r_regionkey")
    days = event_days(t).select("LCLid", "day", "energy_count", r("energy_sum", 4).alias("energy_sum"))
    return tf.daily_with_households(days, households(t), acorn_information(t), categories)
