"""Explicit schemas (DDL text) of the input tables, so that no read infers types."""

from __future__ import annotations

HALFHOURLY_TEXT = "LCLid STRING, tstp STRING, `energy(kWh/hh)` STRING"

DAILY = (
    "LCLid STRING, day STRING, energy_median DOUBLE, energy_mean DOUBLE, energy_max DOUBLE,"
    " energy_count STRING, energy_std DOUBLE, energy_sum DOUBLE, energy_min DOUBLE"
)

HOUSEHOLDS = (
    "LCLid STRING, stdorToU STRING, Acorn STRING, Acorn_grouped STRING, file STRING"
)

ACORN_INFORMATION = "Acorn STRING, `Acorn Category` STRING"

TARIFF_TEXT = "TariffDateTime STRING, Tariff STRING"

PROPERTY_EFFICIENCY = (
    "`Housing Type` STRING, `Current Efficiency` DOUBLE, `Potential Efficiency` DOUBLE, Difference DOUBLE"
)

ACORN_PROPERTY_TYPE = "Acorn STRING, `Housing Type` STRING"

BANK_HOLIDAYS = "`Bank holidays` STRING, Type STRING"

ACORN_CODES = [f"ACORN-{letter}" for letter in "ABCDEFGHIJKLMNOPQ"]

ACORN_DETAILS = (
    "`MAIN CATEGORIES` STRING, CATEGORIES STRING, REFERENCE STRING, "
    + ", ".join(f"`{code}` DOUBLE" for code in ACORN_CODES)
)

WEATHER_DAILY_TEXT = (
    "temperatureMax DOUBLE, temperatureMaxTime STRING, windBearing DOUBLE, icon STRING, dewPoint DOUBLE,"
    " temperatureMinTime STRING, cloudCover DOUBLE, windSpeed DOUBLE, pressure DOUBLE,"
    " apparentTemperatureMinTime STRING, apparentTemperatureHigh DOUBLE, precipType STRING,"
    " visibility DOUBLE, humidity DOUBLE, apparentTemperatureHighTime STRING,"
    " apparentTemperatureLow DOUBLE, apparentTemperatureMax DOUBLE, uvIndex DOUBLE, time STRING,"
    " sunsetTime STRING, temperatureLow DOUBLE, temperatureMin DOUBLE, temperatureHigh DOUBLE,"
    " sunriseTime STRING, temperatureHighTime STRING, uvIndexTime STRING, summary STRING,"
    " temperatureLowTime STRING, apparentTemperatureMin DOUBLE, apparentTemperatureMaxTime STRING,"
    " apparentTemperatureLowTime STRING, moonPhase DOUBLE"
)

FORECAST_DOCUMENT = (
    "list ARRAY<STRUCT<dt: BIGINT, sunrise: BIGINT, sunset: BIGINT,"
    " temp: STRUCT<day: DOUBLE, max: DOUBLE>, feels_like: MAP<STRING, DOUBLE>, pressure: DOUBLE>>"
)
