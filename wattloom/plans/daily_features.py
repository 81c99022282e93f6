"""Daily consumption with weather and calendar features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom import schemas
from wattloom.functions.dates import (
    day_name,
    day_of_week,
    epoch_hours_between,
    epoch_to_date,
    hour_of,
    hours_between,
    is_weekend,
    month_name,
    month_of,
    parse_mixed_date,
    parse_ts,
    season,
    to_day,
)
from wattloom.functions.values import field, flag_when, guarded_product, max_of_values, min_of_values
from wattloom.operators.filters import complete_days, drop_null, drop_null_any
from wattloom.operators.imputation import fill_const, fill_mean, with_statistics
from wattloom.operators.joins import inner_join, left_join_default
from wattloom.operators.windows import (
    lag_of,
    relative_change,
    rolling_mean,
    rolling_mean_full,
    rolling_std,
    rolling_sum,
    trend,
    window_features,
)
from wattloom.sources.readers import read_csv_dir, read_halfhourly

STAMP = "dd/MM/yyyy HH:mm"
NO_HOLIDAY = "No Holiday"


def combine_halfhourly(spark, folder: str) -> DataFrame:
    """All half-hourly block files as one typed table."""
    return read_halfhourly(spark, folder)


def combine_daily(spark, folder: str, readings: int = 48) -> DataFrame:
    """All daily block files as one table, complete days only."""
    return complete_days(read_csv_dir(spark, folder, schemas.DAILY), "energy_count", readings)


def holiday_calendar(bank_holidays: DataFrame) -> DataFrame:
    """One row per holiday date: holiday, Type (the alphabetically first of several names)."""
    dated = bank_holidays.select(parse_mixed_date("Bank holidays").alias("holiday"), "Type")
    return dated.where(F.col("holiday").isNotNull()).groupBy("holiday").agg(F.min("Type").alias("Type"))


def daily_weather_features(daily: DataFrame, weather: DataFrame, bank_holidays: DataFrame) -> DataFrame:
    """Complete daily rows joined to that day's weather, with calendar and weather features.

    Weather gaps are filled over the weather table itself before the join; days that still miss a value
    are dropped, which also drops days without weather, so the join is an inner one.
    """
    days = weather
    filled = fill_const(fill_mean(days, "cloudCover"), {"uvIndex": 0.0})
    dated = filled.withColumn("date", to_day(parse_ts("time", STAMP))).drop("uvIndexTime")
    use = daily.withColumn("day", parse_mixed_date(F.col("day").cast("string")))
    rows = drop_null_any(use.join(dated, F.col("day") == F.col("date"), "inner"))
    rows = left_join_default(rows, holiday_calendar(bank_holidays), "day", "holiday", "Type", NO_HOLIDAY)
    rows = rows.withColumns(
        {
            "day_of_week": day_name("day"),
            "month": month_name("day"),
            "season": season("day"),
            "is_weekend": is_weekend("day"),
            "is_holiday": flag_when(F.col("Type") != NO_HOLIDAY),
            "sunriseTime": parse_ts("sunriseTime", STAMP),
            "sunsetTime": parse_ts("sunsetTime", STAMP),
        }
    )
    warmest = F.col("temperatureMax")
    rows = rows.withColumns(
        {
            "temp_variation": warmest - F.col("temperatureMin"),
            "temp_humidity_interaction": F.col("humidity") * warmest,
            "temp_cloudcover_interaction": F.col("cloudCover") * warmest,
            "temp_uvindex_interaction": F.col("uvIndex") * warmest,
            "weekend_energy_interaction": F.col("is_weekend") * F.col("energy_mean"),
            "holiday_energy_interaction": F.col("is_holiday") * F.col("energy_mean"),
            "daylight_duration": hours_between("sunriseTime", "sunsetTime"),
        }
    )
    return rows.withColumn("temp_daylight_interaction", F.col("daylight_duration") * warmest)


def household_series_features(
    rows: DataFrame,
    entity: str = "LCLid",
    day: str = "day",
    energy: str = "energy_sum",
    time: str | None = "time",
    chunk: Column | None = None,
) -> DataFrame:
    """Lags, rolling sums and trends of each household's daily use, with gaps filled.

    Windows count rows. All of them share one sort; a household has one row per day, so a series is
    bounded by the calendar (pass ``chunk``, the year of ``day`` say, to cut a longer one). Rows without
    a figure take part in the windows and are dropped afterwards.
    """
    typed = rows.withColumn(time, F.col(time).try_cast("timestamp_ntz")) if time else rows
    series = window_features(
        typed,
        [entity],
        [day],
        {
            "lag_1_day": lag_of(energy, 1),
            "lag_2_day": lag_of(energy, 2),
            "lag_7_day": lag_of(energy, 7),
            "rolling_energy_3d": rolling_sum(energy, 3),
            "rolling_energy_7d": rolling_sum(energy, 7),
            "rolling_energy_14d": rolling_sum(energy, 14),
            "rolling_energy_30d": rolling_sum(energy, 30),
            "rolling_energy_mean_14d": rolling_mean(energy, 14),
            "rolling_energy_std_14d": rolling_std(energy, 14),
        },
        chunk=chunk,
        lookback=29,
    )
    derived = series.withColumns(
        {
            "day_of_week": day_of_week(day),
            "is_weekend": is_weekend(day),
            "month": month_of(day),
            "hour": hour_of(time) if time else F.lit(0),
            "energy_trend_3d": trend("rolling_energy_3d", "lag_1_day"),
            "energy_trend_7d": trend("rolling_energy_7d", "lag_1_day"),
            "daily_energy_change": relative_change("lag_1_day", energy),
            "temperature_variability": F.col("temperatureMax") - F.col("temperatureMin"),
            "humidity_temp_interaction": F.col("humidity") * F.col("temperatureMax"),
            "cloud_temp_interaction": F.col("cloudCover") * F.col("temperatureMax"),
        }
    )
    kept = drop_null(derived, energy)
    # The statistics read the input columns only, so they do not repeat the window stage.
    known = with_statistics(
        kept,
        {
            "energy": F.avg(energy),
            "energy_sd": F.stddev_samp(energy),
            "temp_max": F.avg("temperatureMax"),
            "temp_min": F.avg("temperatureMin"),
            "humidity": F.avg("humidity"),
            "cloud": F.avg("cloudCover"),
        },
        source=drop_null(rows, energy),
    )
    s = {n: F.col(f"_s.{n}") for n in ("energy", "energy_sd", "temp_max", "temp_min", "humidity", "cloud")}
    fills = {
        **{c: F.lit(0.0) for c in ("lag_1_day", "lag_2_day", "lag_7_day")},
        **{c: s["energy"] for c in (
            "rolling_energy_3d", "rolling_energy_7d", "rolling_energy_14d", "rolling_energy_30d",
            "rolling_energy_mean_14d",
        )},
        "rolling_energy_std_14d": s["energy_sd"],
        **{c: F.lit(0.0) for c in ("energy_trend_3d", "energy_trend_7d", "daily_energy_change")},
        "temperature_variability": s["temp_max"] - s["temp_min"],
        "humidity_temp_interaction": s["humidity"] * s["temp_max"],
        "cloud_temp_interaction": s["cloud"] * s["temp_max"],
    }
    return known.withColumns({c: F.coalesce(F.col(c), v) for c, v in fills.items()}).drop("_s")


def smoothed_weather(
    daily: DataFrame, weather: DataFrame, on: str = "day", entity: str = "LCLid", n: int = 14,
    columns: Sequence[tuple[str, str]] = (
        ("temperatureMin", "temp_min_smooth"),
        ("temperatureMax", "temp_max_smooth"),
        ("energy_sum", "energy_smooth"),
    ),
) -> DataFrame:
    """Every household's days joined to the weather, with n-row means that wait for n values."""
    joined = inner_join(daily, weather, on)
    return window_features(
        joined, [entity], [on], {name: rolling_mean_full(c, n) for c, name in columns}
    )


def forecast_features(days: DataFrame) -> DataFrame:
    """Model features of each forecast day; ``days`` comes from ``read_forecast_json``.

    The forecast has no holiday information, so ``is_holiday`` is 0.
    """
    dated = days.select(
        "*",
        epoch_to_date("dt").alias("date"),
        epoch_hours_between("sunrise", "sunset").alias("daylight_duration"),
    )
    return dated.select(
        "date",
        is_weekend("date").alias("is_weekend"),
        guarded_product(field("temp", "max"), "daylight_duration").alias("temp_daylight_interaction"),
        F.lit(0).alias("is_holiday"),
        field("temp", "max").alias("temperatureMax"),
        max_of_values("feels_like").alias("apparentTemperatureMax"),
        min_of_values("feels_like").alias("apparentTemperatureMin"),
        field("feels_like", "day").alias("apparentTemperatureHigh"),
        field("temp", "day").alias("temperatureHigh"),
        F.col("pressure").cast("int").alias("pressure"),
        "daylight_duration",
    )
