"""Date, time, text and value functions on columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.catalog.registry import Tables, query
from wattloom.catalog.source_queries import FORECAST_DAYS_SQL, forecast_days
from wattloom.catalog.stand_ins import r, sr, with_views
from wattloom.functions import dates as dt
from wattloom.functions import text as tx
from wattloom.functions import values as vl


@query(
    "d1_parse_ts",
    """SELECT event_id, CASE WHEN event_id % 6 = 5 THEN NULL ELSE date_trunc('minute', ts) END AS us_style,
              date_trunc('minute', ts) AS uk_style FROM events""",
)
def d1(t: Tables) -> DataFrame:
    us = F.when(F.col("event_id") % 6 == 5, "not a time").otherwise(F.date_format("ts", "M/d/yy H:mm"))
    return t.events.select(
        "event_id",
        dt.parse_ts(us).alias("us_style"),
        dt.parse_ts(F.date_format("ts", "dd/MM/yyyy HH:mm"), "dd/MM/yyyy HH:mm").alias("uk_style"),
    )


@query(
    "d2_parse_mixed_date",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderdate AS DATE) END AS day FROM orders",
)
def d2(t: Tables) -> DataFrame:
    kind = F.col("o_orderkey") % 4
    text = (
        F.when(kind == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(kind == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(kind == 2, F.date_format("o_orderdate", "d/M/yyyy"))
        .otherwise("junk")
    )
    return t.orders.select("o_orderkey", dt.parse_mixed_date(text).alias("day"))


@query(
    "d3_format_date",
    "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS uk, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders",
)
def d3(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", dt.format_date("o_orderdate").alias("uk"), dt.format_date("o_orderdate", "yyyy-MM-dd").alias("iso")
    )


@query("d4_to_day", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def d4(t: Tables) -> DataFrame:
    return t.events.select("event_id", dt.to_day("ts").alias("day"))


@query(
    "d5_day_and_month_name",
    "SELECT o_orderkey, dayname(o_orderdate) AS day_name, monthname(o_orderdate) AS month_name FROM orders",
)
def d5(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", dt.day_name("o_orderdate").alias("day_name"), dt.month_name("o_orderdate").alias("month_name")
    )


@query(
    "d6_day_of_week",
    """SELECT o_orderkey, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS sunday1,
              CAST(isodow(o_orderdate) - 1 AS INTEGER) AS monday0,
              CAST(CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend
       FROM orders""",
)
def d6(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        dt.day_of_week("o_orderdate").alias("sunday1"),
        dt.day_of_week("o_orderdate", "monday0").alias("monday0"),
        dt.is_weekend("o_orderdate").alias("is_weekend"),
    )


@query(
    "d7_month_and_hour",
    "SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour FROM events",
)
def d7(t: Tables) -> DataFrame:
    return t.events.select("event_id", dt.month_of("ts").alias("month"), dt.hour_of("ts").alias("hour"))


@query("d8_time_of_day", "SELECT event_id, strftime(ts, '%H:%M') AS time_of_day FROM events")
def d8(t: Tables) -> DataFrame:
    return t.events.select("event_id", dt.time_of_day("ts").alias("time_of_day"))


@query("d9_month_period", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS period FROM orders")
def d9(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dt.month_period("o_orderdate").alias("period"))


@query(
    "d10_season",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) <= 5 THEN 'Spring'
                               WHEN month(o_orderdate) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season FROM orders""",
)
def d10(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dt.season("o_orderdate").alias("season"))


@query("d11_epoch_to_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def d11(t: Tables) -> DataFrame:
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    return t.events.select("event_id", dt.epoch_to_date(epoch).alias("day"))


@query(
    "d12_hours_between",
    f"""SELECT event_id,
               {sr("(epoch(date_trunc('second', ts)) - epoch(date_trunc('day', ts))) / 3600.0")} AS hours,
               CASE WHEN event_id % 3 <> 0 THEN {sr("(epoch(date_trunc('second', ts)) - epoch(date_trunc('day', ts))) / 3600.0")} END AS epoch_hours
        FROM events""",
)
def d12(t: Tables) -> DataFrame:
    midnight = F.to_date("ts").cast("timestamp_ntz")
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    start = F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(
        F.unix_seconds(F.to_date("ts").cast("timestamp"))
    )
    return t.events.select(
        "event_id",
        r(dt.hours_between(midnight, F.col("ts"))).alias("hours"),
        r(dt.epoch_hours_between(start, second)).alias("epoch_hours"),
    )


@query(
    "d13_parse_ts_coerce",
    "SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN date_trunc('second', ts) END AS ts FROM events",
)
def d13(t: Tables) -> DataFrame:
    text = F.when(F.col("event_id") % 4 == 0, "bad").otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(".0000000"))
    )
    return t.events.select("event_id", dt.parse_ts_coerce(text).alias("ts"))


@query("c1_replace_prefix", "SELECT p_partkey, 'Acorn ' || substr(p_brand, 7) AS brand FROM part")
def c1(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", tx.replace_prefix("p_brand", "Brand#", "Acorn ").alias("brand"))


@query(
    "c2_concat_label",
    "SELECT p_partkey, CASE WHEN p_size > 5 THEN p_type || ': ' || p_brand END AS label FROM part",
)
def c2(t: Tables) -> DataFrame:
    brand = F.when(F.col("p_size") > 5, F.col("p_brand"))
    return t.part.select("p_partkey", tx.concat_label("p_type", brand).alias("label"))


@query(
    "c3_round_half_even",
    """SELECT event_id, CAST(CASE WHEN (event_id % 2001) % 2 = 0 THEN (event_id % 2001) / 2.0
                                  WHEN ((event_id % 2001) // 2) % 2 = 0 THEN (event_id % 2001) // 2
                                  ELSE (event_id % 2001) // 2 + 1 END AS DOUBLE) AS whole
       FROM events""",
)
def c3(t: Tables) -> DataFrame:
    half = (F.col("event_id") % 2001) / F.lit(2.0)
    return t.events.select("event_id", vl.round_half_even(half, 0).alias("whole"))


@query(
    "c4_clean_reading",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN (user_id + user_id % 7) / 2.0 WHEN 1 THEN CAST(user_id AS DOUBLE)
                        ELSE NULL END AS reading
       FROM events""",
)
def c4(t: Tables) -> DataFrame:
    user = F.col("user_id").cast("string")
    kind = F.col("event_id") % 4
    two = F.array(F.concat(F.lit(" "), user, F.lit("%")), F.concat((F.col("user_id") % 7).cast("string"), F.lit("%")))
    found = (
        F.when(kind == 0, two)
        .when(kind == 1, F.array(F.concat(user, F.lit("°"))))
        .when(kind == 2, F.array(F.lit("n/a")))
        .otherwise(F.array().cast("array<string>"))
    )
    return t.events.select("event_id", tx.clean_reading(found).alias("reading"))


@query(
    "c5_max_min_of_values",
    with_views(
        """SELECT dt, temp_day, greatest(feels_day, feels_night, feels_morn) AS warmest,
                  least(feels_day, feels_night, feels_morn) AS coldest FROM days""",
        days=FORECAST_DAYS_SQL,
    ),
)
def c5(t: Tables) -> DataFrame:
    return forecast_days(t, "c5").select(
        "dt", vl.field("temp", "day").alias("temp_day"), vl.max_of_values("feels_like").alias("warmest"),
        vl.min_of_values("feels_like").alias("coldest"),
    )


@query(
    "c6_guarded_product",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
               {sr('l_quantity * nullif(l_tax, 0)', 4)} AS product FROM lineitem""",
)
def c6(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", r(vl.guarded_product("l_quantity", "l_tax"), 4).alias("product")
    )


@query("c7_field", "SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events")
def c7(t: Tables) -> DataFrame:
    parsed = t.events.select("event_id", F.struct(F.from_json("props", "k INT").alias("props")).alias("event"))
    return parsed.select("event_id", vl.field("event", "props.k").alias("k"))
