"""Jobs on small domain tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from wattloom import lookups
from wattloom.plans import daily_features as feats
from wattloom.plans import demographics as demo
from wattloom.plans import profiles
from wattloom.plans import tariffs as tf


@pytest.fixture
def domain(table):
    """A few readings around the first tariff hour, two households, their groups."""
    start = datetime(2013, 1, 1)
    half = timedelta(minutes=30)
    return {
        "readings": table(
            "LCLid STRING, tstp TIMESTAMP_NTZ, energy DOUBLE",
            ("MAC000002", start, 0.219), ("MAC000002", start + half, 0.241), ("MAC000002", start + 2 * half, 0.191),
            ("MAC000002", datetime(2012, 10, 12, 0, 30), 0.0), ("MAC005492", start, 0.5), ("MAC005492", start + half, None),
            ("MAC999999", start, 0.7),
        ),
        "households": table(
            "LCLid STRING, stdorToU STRING, Acorn STRING, Acorn_grouped STRING, file STRING",
            ("MAC000002", "Std", "ACORN-A", "Affluent", "block_0"), ("MAC005492", "ToU", "ACORN-", "ACORN-", "block_0"),
        ),
        "acorn": table("Acorn STRING, `Acorn Category` STRING", ("ACORN-A", "Luxury Lifestyles"), ("ACORN-B", "Luxury Lifestyles")),
        "tariff": table(
            "TariffDateTime TIMESTAMP_NTZ, Tariff STRING",
            (start, "Normal"), (start + half, "Normal"), (start + 2 * half, "Normal"), (start + 3 * half, "High"),
        ),
        "efficiency": table(
            "Acorn STRING, Efficiency_Value DOUBLE, Potential_Value DOUBLE, Difference_Value DOUBLE", ("ACORN-A", 60.0, 80.0, 20.0)
        ),
    }


def test_enrichment(domain):
    got = tf.enrich_halfhourly(
        domain["readings"], domain["households"], domain["acorn"], domain["tariff"], domain["efficiency"]
    )
    assert got.columns == tf.ENRICHED
    rows = {(r.LCLid, r.tstp.strftime("%H:%M")): r for r in got.collect()}
    assert len(rows) == 5 and ("MAC005492", "00:30") not in rows
    known, partly, unknown = rows[("MAC000002", "00:30")], rows[("MAC005492", "00:00")], rows[("MAC999999", "00:00")]
    assert (known.energy, known.Tariff, known["Acorn Category"], known.Difference_Value) == (0.241, "Normal", "Luxury Lifestyles", 20.0)
    assert (partly.Acorn, partly["Acorn Category"], partly.Efficiency_Value) == ("ACORN-", None, None)
    assert (unknown.Acorn, unknown.stdorToU, unknown.energy) == (None, None, 0.7)


def test_slot_usage_and_pivot(domain, table):
    args = (domain["readings"], domain["households"], domain["acorn"], domain["tariff"])
    usage = tf.tariff_slot_usage(*args)
    assert usage.columns == ["TariffDateTime", "Tariff", "tstp", "LCLid", "Acorn", "Acorn_grouped", "Acorn Category", "stdorToU", "mean_energy"]
    assert usage.count() == 6 and usage.where("LCLid IS NULL").count() == 1
    twice = tf.tariff_slot_usage(domain["readings"], domain["households"].union(domain["households"]), *args[2:])
    assert values(twice) == values(usage)
    wide = tf.tariff_slot_pivot(*args, "Acorn", ["ACORN-A", "ACORN-", None])
    assert wide.columns == ["Datetime", "Tariff", "ACORN-A", "ACORN-", "null"]
    assert values(wide.select("ACORN-A", "ACORN-", "null")) == [(None, None, None), (0.191, None, None), (0.219, 0.5, 0.7), (0.241, None, None)]


def test_daily_with_households(domain, table):
    daily = table("LCLid STRING, day DATE, energy_sum DOUBLE", ("MAC000002", date(2013, 1, 1), 5.0), ("x", date(2013, 1, 1), 1.0))
    categories = table("`Acorn Category` STRING, note STRING", ("Luxury Lifestyles", "top"))
    got = tf.daily_with_households(daily, domain["households"], domain["acorn"], categories)
    assert values(got, "Acorn", "LCLid", "note") == [(None, "x", None), ("ACORN-A", "MAC000002", "top")]


@pytest.fixture
def details(table):
    return table(
        "`MAIN CATEGORIES` STRING, CATEGORIES STRING, REFERENCE STRING, `ACORN-A` DOUBLE, `ACORN-B` DOUBLE",
        ("HOUSING", "House Type", "Flat", 1.0, 0.0), ("HOUSING", "House Type", "House", 3.0, 0.0),
        ("HOUSING", "House Tenure", "Owned", 5.0, 7.0), ("FAMILY", "House Type", "Flat", 9.0, None),
    )


def test_shares_and_efficiency(details, table):
    shares = demo.demographic_share(details)
    assert shares.count() == 8
    assert shares.columns == ["MAIN CATEGORIES", "CATEGORIES", "REFERENCE", "Acorn", "Value", "Total", "Percentage"]
    assert values(shares.where("Acorn = 'ACORN-B'"), "REFERENCE", "Percentage") == [
        ("Flat", None), ("Flat", None), ("House", None), ("Owned", 1.0)]
    rated = table(
        "`Housing Type` STRING, `Current Efficiency` DOUBLE, `Potential Efficiency` DOUBLE, Difference DOUBLE",
        ("Flat", 60.0, 70.0, 10.0), ("House", 50.0, 80.0, 30.0),
    )
    assert values(demo.efficiency_by_group(details, rated)) == [("ACORN-A", 52.5, 77.5, 25.0), ("ACORN-B", None, None, None)]


def test_time_of_day_profiles(domain):
    got = tf.time_of_day_profiles(domain["readings"], domain["households"], "2013-01-01", "2013-07-01")
    assert ("lifestyle", "00:00", "Luxury Lifestyles", 0.219) in values(got, "grouping", "time_of_day", "group", "energy")
    assert got.where("grouping = 'income_band'").select("group").distinct().collect()[0][0] == "High Income"
    assert values(tf.time_of_day_profile(domain["readings"], domain["households"], "2013-01-01", "2013-07-01")) == [
        ("00:00", "ACORN-", 0.5), ("00:00", "ACORN-A", 0.219), ("00:30", "ACORN-", None), ("00:30", "ACORN-A", 0.241),
        ("01:00", "ACORN-A", 0.191),
    ]


def test_actual_vs_potential(table):
    wide = table(
        "Datetime TIMESTAMP_NTZ, A DOUBLE, B DOUBLE",
        (datetime(2013, 1, 1, 0), 1.0, 2.0), (datetime(2013, 1, 2, 0), 3.0, None), (datetime(2013, 1, 1, 5), 5.0, 4.0),
    )
    kinds = table("Acorn STRING, `Housing Type` STRING, rank INT", ("A", "Flat", 1), ("A", "House", 2), ("B", "None", 1))
    rated = table("`Housing Type` STRING, `Current Efficiency` DOUBLE, `Potential Efficiency` DOUBLE", ("Flat", 40.0, 50.0), ("House", 60.0, 80.0))
    both = tf.potential_use(wide, rated, kinds, "rank", ["A", "B"])
    assert values(both, "A_Potential") == [(0.5,), (1.5,), (2.5,)]  # 40 from the first, 80 from the last
    got = {(r.group, r.hour): r for r in tf.actual_vs_potential(both, ["A", "B"]).collect()}
    assert (got[("A", 0)].actual, got[("A", 0)].potential, got[("A", 0)].difference) == (2.0, 1.0, 1.0)
    assert (got[("A", 5)].p25, got[("A", 5)].p50, got[("A", 5)].p75) == (2.0, 3.0, 4.0)
    assert got[("B", 0)].potential is None and got[("B", 5)].p50 == 3.0


def test_tariff_calendars(table):
    slots = [datetime(2013, 1, 7) + timedelta(days=7 * w, minutes=30 * s) for w in range(4) for s in range(2)]
    bands = ["Low", "High", "High", "Low", "Low", "High", "High", "Low"]
    tariff = table("TariffDateTime TIMESTAMP_NTZ, Tariff STRING", *zip(slots, bands))
    grid = tf.daily_tariff_grid(tariff)
    assert len(grid.columns) == 49 and grid.count() == 4
    weekly = tf.weekly_tariff_mode(tariff).collect()
    assert [r.DayOfWeek for r in weekly] == lookups.WEEKDAYS
    assert (weekly[0]["00:00"], weekly[0]["00:30"], weekly[1]["00:00"]) == (0, 0, None)  # ties: 2 Low, 2 High
    assert [tuple(r) for r in tf.tariff_frequency(tariff, "Time").collect()] == [("00:00", 2, 0, 2), ("00:30", 2, 0, 2)]
    by_day = [tuple(r) for r in tf.tariff_frequency(tariff, "DayOfWeek").collect()]
    assert by_day[0] == ("Monday", 4, 0, 4) and by_day[6] == ("Sunday", None, None, None)
    assert [r.Month for r in tf.tariff_frequency(tariff, "Month").collect()] == ["2013-01"]


WEATHER = (
    "time STRING, sunriseTime STRING, sunsetTime STRING, uvIndexTime STRING, temperatureMax DOUBLE, temperatureMin DOUBLE,"
    " humidity DOUBLE, cloudCover DOUBLE, uvIndex DOUBLE"
)


def test_daily_weather_features(table):
    daily = table(
        "LCLid STRING, day STRING, energy_mean DOUBLE, energy_sum DOUBLE",
        ("a", "2012-12-25", 0.5, 24.0), ("a", "26/12/2012", 0.25, 12.0), ("a", "29/12/2012", 0.1, 4.8),
        ("b", "25/12/2012", None, 1.0), ("b", "01/06/2013", 0.5, 1.0),
    )
    weather = table(
        WEATHER,
        ("25/12/2012 00:00", "25/12/2012 08:00", "25/12/2012 16:00", None, 10.0, 4.0, 0.5, None, 2.0),
        ("26/12/2012 00:00", "26/12/2012 08:00", "26/12/2012 16:30", None, 8.0, 4.0, 0.5, 0.4, None),
        ("29/12/2012 00:00", "29/12/2012 08:00", "29/12/2012 16:30", None, 6.0, 4.0, 0.5, 0.2, 1.0),
    )
    holidays = table("`Bank holidays` STRING, Type STRING", ("25/12/2012", "Christmas Day"), ("2012-12-25", "Another"), ("?", "x"))
    got = {r.day: r for r in feats.daily_weather_features(daily, weather, holidays).collect()}
    assert sorted(got) == [date(2012, 12, 25), date(2012, 12, 26), date(2012, 12, 29)]
    first, second, third = (got[d] for d in sorted(got))
    assert (first.Type, first.is_holiday, second.Type, second.is_holiday) == ("Another", 1, "No Holiday", 0)
    assert first.cloudCover == pytest.approx(0.3) and second.uvIndex == 0.0
    assert (first.daylight_duration, first.temp_daylight_interaction) == (8.0, 80.0)
    assert (third.is_weekend, third.weekend_energy_interaction, first.weekend_energy_interaction) == (1, 0.1, 0.0)
    assert (first.day_of_week, first.month, first.season, first.temp_variation) == ("Tuesday", "December", "Winter", 6.0)
    assert "uvIndexTime" not in first.asDict()


def test_household_series(table):
    days = [date(2013, 1, 1) + timedelta(days=i) for i in range(40)]
    rows = [("a", d, float(i), 10.0, 4.0, 0.5, 0.25) for i, d in enumerate(days)]
    rows += [("b", days[0], 7.0, None, 4.0, None, 0.25), ("b", days[1], None, 10.0, 4.0, 0.5, 0.25)]
    df = table(
        "LCLid STRING, day DATE, energy_sum DOUBLE, temperatureMax DOUBLE, temperatureMin DOUBLE, humidity DOUBLE, cloudCover DOUBLE",
        *rows,
    )
    got = feats.household_series_features(df, time=None)
    whole = {(r.LCLid, r.day): r for r in got.collect()}
    assert len(whole) == 41 and ("b", days[1]) not in whole
    b = whole[("b", days[0])]
    energy = pd.Series([float(i) for i in range(40)] + [7.0])
    assert b.rolling_energy_std_14d == pytest.approx(energy.std()) and b.lag_1_day == 0.0 and b.daily_energy_change == 0.0
    assert b.temperature_variability == pytest.approx(10.0 - 4.0) and b.humidity_temp_interaction == pytest.approx(5.0)
    a = whole[("a", days[39])]
    assert a.rolling_energy_30d == sum(range(10, 40)) and a.lag_7_day == 32.0
    assert a.energy_trend_3d == (37 + 38 + 39) - 38 and a.daily_energy_change == pytest.approx(-1 / 39)
    chunked = feats.household_series_features(df, time=None, chunk=F.trunc("day", "month"))
    columns = ["LCLid", "day", *lookups.SERIES_FEATURES]
    assert values(chunked.select(columns)) == values(got.select(columns))


def test_smoothing_waits_for_fourteen_days(table):
    days = [date(2013, 1, 1) + timedelta(days=i) for i in range(15)]
    use = table("LCLid STRING, day DATE, energy_sum DOUBLE", *[(k, d, float(i)) for k in "ab" for i, d in enumerate(days)])
    weather = table("day DATE, temperatureMin DOUBLE, temperatureMax DOUBLE", *[(d, 1.0, 2.0) for d in days])
    got = feats.smoothed_weather(use, weather).where("LCLid = 'a'").orderBy("day").collect()
    assert [r.energy_smooth for r in got] == [None] * 13 + [6.5, 7.5] and got[14].temp_max_smooth == 2.0


def test_forecast_features(table):
    days = table(
        "dt BIGINT, sunrise BIGINT, sunset BIGINT, temp STRUCT<day: DOUBLE, max: DOUBLE>, feels_like MAP<STRING, DOUBLE>, pressure DOUBLE",
        (1743336000, 1743313200, 1743359367, (15.57, 16.09), {"day": 14.49, "night": 6.27, "morn": 7.0}, 1021.0),
        (1744545600, None, 1744569367, (12.51, 14.15), {"day": 10.7, "eve": 10.86, "night": 1.93}, 1016.0),
    )
    first, second = sorted(feats.forecast_features(days).collect(), key=lambda r: r.date)
    assert (first.date, first.is_weekend, first.pressure) == (date(2025, 3, 30), 1, 1021)
    assert first.daylight_duration == pytest.approx(12.824166666666667)
    assert first.temp_daylight_interaction == pytest.approx(206.34084166666668)
    assert (second.apparentTemperatureMax, second.apparentTemperatureHigh, second.daylight_duration) == (10.86, 10.7, None)
    assert second.temp_daylight_interaction is None


def test_profile_parts(table):
    df = table("x DOUBLE, y INT, s STRING", (1.0, 2, "a"), (3.0, None, "b"))
    parts = profiles.table_profile(df, bins=2)
    assert sorted(parts) == ["boxes", "correlations", "describe", "histogram_x", "histogram_y", "nulls", "shape"]
    assert values(parts["nulls"]) == [("s", 0), ("x", 0), ("y", 1)]


def test_no_cross_joins_or_python_in_the_jobs(domain, details, table):
    plans = [
        plan_of(tf.enrich_halfhourly(domain["readings"], domain["households"], domain["acorn"], domain["tariff"], domain["efficiency"])),
        plan_of(tf.time_of_day_profiles(domain["readings"], domain["households"], "2013-01-01", "2013-07-01")),
        plan_of(demo.demographic_share(details)),
    ]
    for plan in plans:
        for bad in ("CartesianProduct", "NestedLoop", "PythonUDF", "ArrowEval", "BatchEvalPython"):
            assert bad not in plan
