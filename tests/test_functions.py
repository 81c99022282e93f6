"""Column functions on rows worked out by hand."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wattloom import lookups
from wattloom.functions import dates as dt
from wattloom.functions import text as tx
from wattloom.functions import values as vl


def test_bad_numbers_become_null(table):
    df = table("x STRING", ("0.219",), ("Null",), ("",), ("NaN",), (None,), (" 0.5 ",))
    assert [r[0] for r in df.select(vl.to_numeric("x")).collect()] == [0.219, None, None, None, None, 0.5]


def test_ratio_by_zero_is_null(table):
    df = table("a DOUBLE, b DOUBLE", (1.0, 0.0), (0.0, 0.0), (1.0, 4.0), (None, 2.0))
    assert [r[0] for r in df.select(vl.ratio("a", "b")).collect()] == [None, None, 0.25, None]


def test_flags_are_zero_for_unknown(table):
    df = table("x STRING", ("No Holiday",), ("Easter",), (None,))
    assert [r[0] for r in df.select(vl.flag_when(F.col("x") != "No Holiday")).collect()] == [0, 1, 0]


def test_lookups_leave_unknown_codes_null(table):
    df = table("Acorn STRING", ("ACORN-A",), ("ACORN-U",), ("ACORN-",), (None,))
    found = [r[0] for r in df.select(vl.map_values("Acorn", lookups.LIFESTYLES)).collect()]
    assert found == ["Luxury Lifestyles", "Low Income Living", None, None]


def test_incomes_without_band(table):
    df = table("Acorn STRING", *[(code,) for code in lookups.INCOMES])
    band = vl.map_values_2level("Acorn", lookups.INCOMES, lookups.INCOME_BANDS)
    missing = [r[0] for r in df.select("Acorn", band.alias("b")).where("b IS NULL").collect()]
    assert missing == ["ACORN-H", "ACORN-P"]


def test_half_even_rounding(table):
    df = table("x DOUBLE", (0.5,), (1.5,), (2.5,), (-0.5,))
    assert [abs(r[0]) for r in df.select(vl.round_half_even("x", 0)).collect()] == [0.0, 2.0, 2.0, 0.0]


def test_forecast_day_numbers(table):
    df = table("m DOUBLE, d DOUBLE", (16.09, 12.824166666666667), (10.0, 0.0), (10.0, None))
    got = [r[0] for r in df.select(vl.guarded_product("m", "d")).collect()]
    assert got[0] == pytest.approx(206.34084166666668) and got[1:] == [None, None]


def test_nested_and_map_values(table):
    df = table(
        "f MAP<STRING, DOUBLE>, t STRUCT<max: DOUBLE, day: DOUBLE>",
        ({"day": 10.7, "night": 1.93, "eve": 10.86}, (14.15, 12.51)),
    )
    got = df.select(
        vl.max_of_values("f"), vl.min_of_values("f"), vl.field("f", "day"), vl.field("t", "max"), vl.field("f", "noon")
    ).first()
    assert tuple(got) == (10.86, 1.93, 10.7, 14.15, None)


def test_mixed_dates(table):
    df = table(
        "x STRING", ("2012-10-12",), ("13/10/2012",), ("04/03/2013",), ("4/3/2013",), ("junk",), (None,), (" 2013-01-01 ",)
    )
    assert [r[0] for r in df.select(dt.parse_mixed_date("x")).collect()] == [
        date(2012, 10, 12), date(2012, 10, 13), date(2013, 3, 4), date(2013, 3, 4), None, None, date(2013, 1, 1),
    ]


def test_timestamps_by_pattern(table):
    df = table("x STRING", ("1/1/13 0:00",), ("12/31/13 23:30",), ("x",))
    assert [r[0] for r in df.select(dt.parse_ts("x")).collect()] == [
        datetime(2013, 1, 1), datetime(2013, 12, 31, 23, 30), None,
    ]
    long = table("x STRING", ("2012-10-12 00:30:00.0000000",), ("bad",))
    assert [r[0] for r in long.select(dt.parse_ts_coerce("x")).collect()] == [datetime(2012, 10, 12, 0, 30), None]


def test_calendar_parts(table):
    df = table("d DATE", (date(2025, 3, 30),), (date(2025, 3, 31),), (date(2024, 12, 7),))
    got = df.select(
        dt.day_of_week("d"), dt.day_of_week("d", "monday0"), dt.is_weekend("d"), dt.day_name("d"), dt.month_name("d"),
        dt.season("d"), dt.month_period("d"), dt.format_date("d"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (1, 6, 1, "Sunday", "March", "Spring", "2025-03", "30/03/2025"),
        (2, 0, 0, "Monday", "March", "Spring", "2025-03", "31/03/2025"),
        (7, 5, 1, "Saturday", "December", "Winter", "2024-12", "07/12/2024"),
    ]
    with pytest.raises(ValueError):
        dt.day_of_week("d", "tuesday")


def test_durations(table):
    df = table("a TIMESTAMP_NTZ, b TIMESTAMP_NTZ", (datetime(2013, 1, 1, 8), datetime(2013, 1, 1, 16, 30)), (None, datetime(2013, 1, 1)))
    assert [r[0] for r in df.select(dt.hours_between("a", "b")).collect()] == [8.5, None]
    seconds = table("a BIGINT, b BIGINT", (1743313200, 1743359367), (0, 5), (5, 0), (None, 5))
    got = [r[0] for r in seconds.select(dt.epoch_hours_between("a", "b")).collect()]
    assert got[0] == pytest.approx(12.824166666666667) and got[1:] == [None, None, None]


def test_epoch_date_ignores_the_session_zone(spark, table):
    df = table("s BIGINT", (1743292800,), (-1,))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert [r[0] for r in df.select(dt.epoch_to_date("s")).collect()] == [date(2025, 3, 30), date(1969, 12, 31)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_text_functions(table):
    df = table("a STRING, b STRING", ("ACORN-A", "x"), ("No ACORN-B", None))
    got = [tuple(r) for r in df.select(tx.replace_prefix("a", "ACORN-", "Acorn "), tx.concat_label("a", "b")).collect()]
    assert got == [("Acorn A", "ACORN-A: x"), ("No ACORN-B", None)]


def test_clean_readings(table):
    df = table("x ARRAY<STRING>", (["40%", " 61% "],), (["12°"],), (["n/a"],), ([],), (["1", "2", "3"],), (None,))
    assert [r[0] for r in df.select(tx.clean_reading("x")).collect()] == [50.5, 12.0, None, None, None, None]
