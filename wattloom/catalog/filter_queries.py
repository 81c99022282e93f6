"""Filters and filling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.catalog.registry import Tables, query
from wattloom.catalog.stand_ins import event_days, r, rounded, sr, weather, with_views
from wattloom.operators import filters as flt
from wattloom.operators import imputation as imp


def gappy_orders(t: Tables) -> DataFrame:
    """Orders with holes: a missing price, a NaN price, a missing status."""
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey",
        F.when(key % 7 == 0, F.lit(None).cast("double"))
        .when(key % 7 == 1, F.lit(float("nan")))
        .otherwise(F.col("o_totalprice")).alias("price"),
        F.when(key % 5 != 0, F.col("o_orderstatus")).alias("status"),
    )


GAPPY_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 NOT IN (0, 1) THEN o_totalprice END AS price,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS status
    FROM orders"""


@query("f1_drop_null", with_views("SELECT * FROM gappy WHERE price IS NOT NULL", gappy=GAPPY_SQL))
def f1(t: Tables) -> DataFrame:
    return flt.drop_null(gappy_orders(t), "price")


@query(
    "f2_drop_null_any",
    with_views("SELECT * FROM gappy WHERE price IS NOT NULL AND status IS NOT NULL", gappy=GAPPY_SQL),
)
def f2(t: Tables) -> DataFrame:
    return flt.drop_null_any(gappy_orders(t))


@query(
    "f3_filter_eq",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_returnflag = 'R' AND l_linestatus = 'F'""",
)
def f3(t: Tables) -> DataFrame:
    kept = flt.filter_eq(t.lineitem, {"l_returnflag": "R", "l_linestatus": "F"})
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "f4_complete_days",
    with_views(
        f'SELECT "LCLid", day, energy_count, {sr("energy_sum", 4)} AS energy_sum FROM event_days WHERE energy_count = 3',
        "event_days",
    ),
)
def f4(t: Tables) -> DataFrame:
    text = event_days(t).withColumn("energy_count", F.col("energy_count").cast("string"))
    kept = flt.complete_days(text, "energy_count", 3)
    return kept.select("LCLid", "day", "energy_count", r("energy_sum", 4).alias("energy_sum"))


@query(
    "f5_time_range",
    """SELECT event_id, ts, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'""",
)
def f5(t: Tables) -> DataFrame:
    return flt.time_range(t.events, "ts", "2024-01-05", "2024-01-12").select("event_id", "ts", "value")


@query(
    "f6_filter_in",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (1, 5, 8, 13, 21, 34, 55, 89)",
)
def f6(t: Tables) -> DataFrame:
    return flt.filter_in(t.orders, "o_custkey", [1, 5, 8, 13, 21, 34, 55, 89]).select("o_orderkey", "o_custkey")


@query(
    "f6_filter_in_table",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def f6_table(t: Tables) -> DataFrame:
    wanted = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return flt.filter_in(t.orders, "o_custkey", wanted).select("o_orderkey", "o_custkey")


@query("f7_filter_not_null", with_views("SELECT o_orderkey, status FROM gappy WHERE status IS NOT NULL", gappy=GAPPY_SQL))
def f7(t: Tables) -> DataFrame:
    return flt.filter_not_null(gappy_orders(t), "status").select("o_orderkey", "status")


@query("f8_one_entity", "SELECT event_id, ts, value FROM events WHERE user_id = 7")
def f8(t: Tables) -> DataFrame:
    return flt.one_entity(t.events, "user_id", 7).select("event_id", "ts", "value")


@query(
    "n1_fill_const",
    with_views(
        "SELECT o_orderkey, coalesce(price, 0.0) AS price, coalesce(status, 'unknown') AS status FROM gappy",
        gappy=GAPPY_SQL,
    ),
)
def n1(t: Tables) -> DataFrame:
    return imp.fill_const(gappy_orders(t), {"price": 0.0, "status": "unknown"})


@query(
    "n2_fill_mean",
    with_views(
        f"""SELECT o_orderkey, {sr('coalesce(price, (SELECT avg(price) FROM gappy))', 3)} AS price, status FROM gappy""",
        gappy=GAPPY_SQL,
    ),
)
def n2(t: Tables) -> DataFrame:
    return rounded(imp.fill_mean(gappy_orders(t), "price"), "price", digits=3)


@query(
    "n3_fill_label",
    with_views("SELECT o_orderkey, coalesce(status, 'No Holiday') AS status FROM gappy", gappy=GAPPY_SQL),
)
def n3(t: Tables) -> DataFrame:
    return imp.fill_label(gappy_orders(t), "status", "No Holiday").select("o_orderkey", "status")


@query(
    "n4_fill_stat",
    with_views(
        f"""SELECT time,
                   {sr('coalesce(CASE WHEN "uvIndex" > 5 THEN variation END, (SELECT avg("temperatureMax") - avg("temperatureMin") FROM weather))', 4)} AS variation,
                   {sr('coalesce(CASE WHEN "uvIndex" > 5 THEN humid END, (SELECT avg(humidity) * avg("temperatureMax") FROM weather))', 4)} AS humid,
                   {sr('coalesce(pressure, (SELECT stddev_samp(pressure) FROM weather))', 4)} AS pressure
            FROM (SELECT *, "temperatureMax" - "temperatureMin" AS variation, humidity * "temperatureMax" AS humid
                  FROM weather)""",
        "weather",
    ),
)
def n4(t: Tables) -> DataFrame:
    base = weather(t)
    sunny = F.col("uvIndex") > 5
    rows = base.select(
        "time",
        F.when(sunny, F.col("temperatureMax") - F.col("temperatureMin")).alias("variation"),
        F.when(sunny, F.col("humidity") * F.col("temperatureMax")).alias("humid"),
        "pressure",
    )
    filled = imp.fill_stat(
        rows,
        {
            "variation": F.avg("temperatureMax") - F.avg("temperatureMin"),
            "humid": F.avg("humidity") * F.avg("temperatureMax"),
            "pressure": F.stddev_samp("pressure"),
        },
        source=base,
    )
    return rounded(filled, "variation", "humid", "pressure", digits=4)


@query(
    "n5_fill_mode",
    with_views(
        """SELECT o_orderkey,
                  coalesce(status, (SELECT status FROM gappy WHERE status IS NOT NULL GROUP BY 1
                                    ORDER BY count(*) DESC, status LIMIT 1)) AS status
           FROM gappy""",
        gappy=GAPPY_SQL,
    ),
)
def n5(t: Tables) -> DataFrame:
    return imp.fill_mode(gappy_orders(t), "status").select("o_orderkey", "status")
