"""Sorting, limits, batches, set operations, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom import lookups
from wattloom.catalog.registry import Tables, query
from wattloom.catalog.stand_ins import readings, with_views
from wattloom.functions.dates import day_name
from wattloom.operators import ordering as od


@query("l1_order_by", "SELECT o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY 1, 2")
def l1(t: Tables) -> DataFrame:
    return od.order_by(t.orders.select("o_orderdate", "o_orderkey", "o_totalprice"), "o_orderdate", "o_orderkey")


@query("l2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def l2(t: Tables) -> DataFrame:
    return od.top_k(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 20, "o_orderkey")


@query("l3_limit", "SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 20")
def l3(t: Tables) -> DataFrame:
    return od.limit(t.events.select("event_id", "ts", "value"), 20, "ts", "event_id")


@query(
    "l4_order_by_list",
    """SELECT d AS day, n FROM (SELECT unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday',
                                               'Sunday']) AS d)
       LEFT JOIN (SELECT dayname(o_orderdate) AS day, count(*) AS n FROM orders
                  WHERE isodow(o_orderdate) <> 3 GROUP BY 1) ON d = day""",
)
def l4(t: Tables) -> DataFrame:
    counts = (
        t.orders.where(F.weekday("o_orderdate") != 2)
        .groupBy(day_name("o_orderdate").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return od.order_by_list(counts, "day", lookups.WEEKDAYS)


@query(
    "l5_order_by_time",
    with_views('SELECT tstp, "LCLid", energy FROM readings ORDER BY 1, 2', "readings"),
)
def l5(t: Tables) -> DataFrame:
    return od.order_by_time(readings(t).select("tstp", "LCLid", "energy"), "tstp", "LCLid")


@query(
    "l6_batches",
    """SELECT o_orderkey, shard,
              CAST(floor((row_number() OVER (PARTITION BY shard ORDER BY o_orderkey) - 1) / 100.0) AS INTEGER) AS batch
       FROM (SELECT o_orderkey, CAST(CAST('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 16 AS INTEGER) AS shard
             FROM orders)""",
)
def l6(t: Tables) -> DataFrame:
    return od.batches(t.orders.select("o_orderkey"), "o_orderkey", 100, shards=16)


@query(
    "l6_exact_slices",
    """SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) / 250.0) AS BIGINT) AS slice FROM orders""",
)
def l6_exact(t: Tables) -> DataFrame:
    return od.slices(t.orders.select("o_orderdate", "o_orderkey"), 250, "o_orderdate", "o_orderkey").select("o_orderkey", "slice")


@query("l3_global_rank", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS rank FROM orders")
def l3_rank(t: Tables) -> DataFrame:
    return od.global_rank(t.orders.select("o_totalprice", "o_orderkey"), "o_totalprice", "o_orderkey").select("o_orderkey", "rank")


@query(
    "u1_union_all",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' UNION ALL
       SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F' UNION ALL
       SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'""",
)
def u1(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    status = F.col("o_orderstatus")
    parts = [rows.where(c).drop("o_orderstatus") for c in (status == "F", status != "F", status == "P")]
    return od.union_all(parts)


@query(
    "u2_except_distinct",
    "SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45",
)
def u2(t: Tables) -> DataFrame:
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select("l_partkey")
    return od.except_distinct(returned, t.lineitem.where(F.col("l_quantity") > 45).select("l_partkey"))
