"""Equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.catalog.registry import Tables, query
from wattloom.catalog.stand_ins import (
    acorn_information,
    daily,
    event_days,
    holidays,
    households,
    r,
    readings,
    rounded,
    sr,
    tariff,
    weather,
    with_views,
)
from wattloom.operators import joins as jn
from wattloom.plans.daily_features import holiday_calendar


@query(
    "j1_left_join",
    with_views(
        """SELECT "Acorn", "LCLid", "stdorToU", "Acorn_grouped", file, "Acorn Category"
           FROM households LEFT JOIN acorn_information USING ("Acorn")""",
        "households", "acorn_information",
    ),
)
def j1(t: Tables) -> DataFrame:
    return jn.left_join(households(t), acorn_information(t), "Acorn")


@query(
    "j2_left_join_on",
    """SELECT o_orderkey, o_custkey, c_mktsegment
       FROM orders LEFT JOIN (SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0)
         ON o_custkey = c_custkey""",
)
def j2(t: Tables) -> DataFrame:
    some = t.customer.where(F.col("c_custkey") % 3 != 0).select("c_custkey", "c_mktsegment")
    return jn.left_join_on(t.orders.select("o_orderkey", "o_custkey"), some, "o_custkey", "c_custkey")


@query(
    "j3_inner_join",
    with_views(
        'SELECT "LCLid", tstp, energy, "Acorn", "stdorToU" FROM readings JOIN households USING ("LCLid")',
        "readings", "households",
    ),
)
def j3(t: Tables) -> DataFrame:
    return jn.inner_join(readings(t), households(t).select("LCLid", "Acorn", "stdorToU"), "LCLid")


@query(
    "j4_join_instants",
    with_views(
        'SELECT "LCLid", tstp, energy, "Tariff" FROM readings JOIN tariff ON tstp = "TariffDateTime"',
        "readings", "tariff",
    ),
)
def j4(t: Tables) -> DataFrame:
    text = readings(t).withColumn("tstp", F.date_format("tstp", "yyyy-MM-dd HH:mm:ss"))
    return jn.join_instants(text, tariff(t), "tstp", "TariffDateTime")


@query(
    "j5_keep_matching",
    with_views(
        'SELECT "LCLid", tstp, energy FROM readings WHERE tstp IN (SELECT "TariffDateTime" FROM tariff)',
        "readings", "tariff",
    ),
)
def j5(t: Tables) -> DataFrame:
    return jn.keep_matching(readings(t), tariff(t), "tstp", "TariffDateTime")


@query(
    "j6_left_from_dense",
    with_views(
        f"""SELECT "TariffDateTime", "Tariff", tstp, {sr('energy', 4)} AS energy
            FROM tariff LEFT JOIN (SELECT tstp, avg(energy) AS energy FROM readings GROUP BY 1)
              ON "TariffDateTime" = tstp""",
        "readings", "tariff",
    ),
)
def j6(t: Tables) -> DataFrame:
    means = readings(t).groupBy("tstp").agg(F.avg("energy").alias("energy"))
    return rounded(jn.left_from_dense(tariff(t), means, "TariffDateTime", "tstp"), "energy", digits=4)


@query(
    "j7_star_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, p_brand, s_name, o_orderstatus
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
                     LEFT JOIN orders ON l_orderkey = o_orderkey""",
)
def j7(t: Tables) -> DataFrame:
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    joined = jn.star_join(
        fact,
        [
            (t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"),
            (t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey"),
            (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey"),
        ],
    )
    return joined.select(*fact.columns, "p_brand", "s_name", "o_orderstatus")


def parsed_holidays_sql() -> str:
    """The holiday dates written out in ISO form, the first name kept where a date occurs twice."""
    return """SELECT holiday, min("Type") AS "Type" FROM (
        SELECT coalesce(TRY_CAST("Bank holidays" AS DATE),
                        CAST(try_strptime("Bank holidays", '%-d/%-m/%Y') AS DATE)) AS holiday, "Type"
        FROM holidays) WHERE holiday IS NOT NULL GROUP BY 1"""


@query(
    "j8_left_join_default",
    with_views(
        """SELECT "LCLid", day, energy_count, coalesce("Type", 'No Holiday') AS "Type"
           FROM daily LEFT JOIN calendar ON day = holiday""",
        "daily", "holidays", calendar=parsed_holidays_sql(),
    ),
)
def j8(t: Tables) -> DataFrame:
    rows = daily(t).select("LCLid", "day", "energy_count")
    return jn.left_join_default(rows, holiday_calendar(holidays(t)), "day", "holiday", "Type", "No Holiday")


@query(
    "j9_unique_lookup",
    """SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey,
              arg_max(o_orderstatus, o_orderkey) AS o_orderstatus, 'last' AS kept FROM orders GROUP BY 1
       UNION ALL
       SELECT o_custkey, min(o_orderkey), arg_min(o_orderstatus, o_orderkey), 'first' FROM orders GROUP BY 1""",
)
def j9(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    first = jn.unique_lookup(rows, "o_custkey", "o_orderkey", "first").withColumn("kept", F.lit("first"))
    last = jn.unique_lookup(rows, "o_custkey", "o_orderkey", "last").withColumn("kept", F.lit("last"))
    return first.unionByName(last)


@query(
    "j10_join_on_dates",
    with_views(
        f"""SELECT "LCLid", day, {sr('energy_sum', 4)} AS energy_sum, "temperatureMax"
            FROM daily JOIN (SELECT *, CAST(strptime(time, '%d/%m/%Y %H:%M') AS DATE) AS d FROM weather) ON day = d""",
        "daily", "weather",
    ),
)
def j10(t: Tables) -> DataFrame:
    odd = F.dayofmonth("day") % 2 == 1
    text = daily(t).select(
        "LCLid",
        F.when(odd, F.date_format("day", "yyyy-MM-dd")).otherwise(F.date_format("day", "dd/MM/yyyy")).alias("day"),
        r("energy_sum", 4).alias("energy_sum"),
    )
    dated = weather(t).select(F.substring("time", 1, 10).alias("date"), "temperatureMax")
    return jn.join_on_dates(text, dated, "day", "date")


@query(
    "j11_join_all_entities",
    with_views(
        f"""SELECT day, "LCLid", energy_count, {sr('mean_use', 4)} AS mean_use
            FROM event_days JOIN (SELECT day, avg(energy_sum) AS mean_use FROM event_days GROUP BY 1) USING (day)""",
        "event_days",
    ),
)
def j11(t: Tables) -> DataFrame:
    days = event_days(t)
    calendar = days.groupBy("day").agg(r(F.avg("energy_sum"), 4).alias("mean_use"))
    return jn.join_all_entities(days.select("LCLid", "day", "energy_count"), calendar, "day")


@query(
    "j12_join_twice",
    with_views(
        """SELECT "TariffDateTime", "Tariff", "LCLid", tstp, energy FROM tariff
           LEFT JOIN (SELECT * FROM readings WHERE tstp IN (SELECT "TariffDateTime" FROM tariff))
             ON "TariffDateTime" = tstp""",
        "readings", "tariff",
    ),
)
def j12(t: Tables) -> DataFrame:
    return jn.join_twice(readings(t), tariff(t), "tstp", "TariffDateTime")
