"""Sources and sinks: whole tables written out and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.catalog.registry import Tables, query
from wattloom.catalog.stand_ins import readings, with_views
from wattloom.functions.values import field
from wattloom.operators.aggregates import group_count2
from wattloom.shared import scratch_path
from wattloom.sources import publish, readers, writers

ORDERS_CSV = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


def _csv(df: DataFrame, label: str, **options: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.options(header=True, **options).csv(path)
    return path


def _table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@query("s1_read_csv", ORDERS_SQL)
def s1(t: Tables) -> DataFrame:
    return readers.read_csv(t.spark, _csv(t.orders.select(*ORDER_COLUMNS), "s1"), ORDERS_CSV)


@query(
    "s2_read_csv_dir",
    with_views('SELECT "LCLid", tstp, energy FROM readings', "readings"),
)
def s2(t: Tables) -> DataFrame:
    text = readings(t).select(
        "LCLid",
        F.date_format("tstp", "yyyy-MM-dd HH:mm:ss").alias("tstp"),
        F.col("energy").cast("string").alias("energy(kWh/hh)"),
    )
    return readers.read_halfhourly(t.spark, _csv(text, "s2"))


@query(
    "s3_read_csv_latin1",
    "SELECT o_orderkey, '£' || CAST(o_custkey AS VARCHAR) || ' é' AS label FROM orders",
)
def s3(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey", F.concat(F.lit("£"), F.col("o_custkey").cast("string"), F.lit(" é")).alias("label")
    )
    path = _csv(rows, "s3", encoding=readers.LATIN_1)
    return readers.read_csv(t.spark, path, "o_orderkey BIGINT, label STRING", encoding=readers.LATIN_1)


@query("s4_read_csv_list", ORDERS_SQL)
def s4(t: Tables) -> DataFrame:
    rows = t.orders.select(*ORDER_COLUMNS)
    done = F.col("o_orderstatus") == "F"
    paths = [_csv(rows.where(done), "s4a", quoteAll="true"), _csv(rows.where(~done), "s4b", quoteAll="true")]
    return readers.read_csv(t.spark, paths, ORDERS_CSV, sep=",", quote='"')


@query(
    "s5_read_parquet",
    "SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY 1, 2",
)
def s5(t: Tables) -> DataFrame:
    return group_count2(readers.read_parquet(t.spark, f"{t.folder}/lineitem.parquet"), "l_returnflag", "l_linestatus")


def forecast_documents(t: Tables) -> DataFrame:
    """One forecast document per event, two days in each."""
    day = F.unix_seconds(F.col("ts").cast("timestamp"))
    midnight = day - day % 86400

    def entry(offset: int, shift: float):
        return F.struct(
            (day + offset * 86400).alias("dt"),
            F.when(F.col("event_id") % 10 != 0, midnight + offset * 86400 + 21600).alias("sunrise"),
            (midnight + offset * 86400 + 64800 + F.col("user_id") % 100 * 36).alias("sunset"),
            F.struct((F.col("value") + shift).alias("day"), (F.col("value") + shift + 1.5).alias("max")).alias("temp"),
            F.create_map(
                F.lit("day"), F.col("value") + shift - 2.0, F.lit("night"), F.col("value") - 7.0,
                F.lit("morn"), F.col("value") * 0.5,
            ).alias("feels_like"),
            (F.lit(1000.0) + F.col("user_id") % 40).alias("pressure"),
        )

    return t.events.select(F.array(entry(0, 0.0), entry(1, 0.25)).alias("list"))


FORECAST_DAYS_SQL = """
    SELECT epoch_s + k * 86400 AS dt,
           CASE WHEN event_id % 10 <> 0 THEN epoch_s - epoch_s % 86400 + k * 86400 + 21600 END AS sunrise,
           epoch_s - epoch_s % 86400 + k * 86400 + 64800 + user_id % 100 * 36 AS sunset,
           value + k * 0.25 AS temp_day, value + k * 0.25 + 1.5 AS temp_max,
           value + k * 0.25 - 2.0 AS feels_day, value - 7.0 AS feels_night, value * 0.5 AS feels_morn,
           CAST(1000 + user_id % 40 AS DOUBLE) AS pressure
    FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s FROM events), (VALUES (0), (1)) AS d(k)"""


def forecast_days(t: Tables, label: str) -> DataFrame:
    path = scratch_path(t.spark, label)
    forecast_documents(t).write.json(path)
    return readers.read_forecast_json(t.spark, path, multi_line=False)


@query(
    "s6_read_forecast_json",
    with_views(
        "SELECT dt, sunrise, sunset, temp_day, temp_max, feels_day, feels_night, pressure FROM days",
        days=FORECAST_DAYS_SQL,
    ),
)
def s6(t: Tables) -> DataFrame:
    days = forecast_days(t, "s6")
    return days.select(
        "dt", "sunrise", "sunset", field("temp", "day").alias("temp_day"), field("temp", "max").alias("temp_max"),
        field("feels_like", "day").alias("feels_day"), field("feels_like", "night").alias("feels_night"), "pressure",
    )


@query("s7_read_table", ORDERS_SQL)
def s7(t: Tables) -> DataFrame:
    name = writers.register_table(
        t.orders.select(*ORDER_COLUMNS), _table_name("orders"), path=scratch_path(t.spark, "s7")
    )
    return readers.read_table(t.spark, name)


@query(
    "k1_write_parquet",
    "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month FROM orders",
)
def k1(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "k1")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    writers.write_parquet(rows, path, partition_by=["month"])
    return t.spark.read.schema("o_orderkey BIGINT, o_totalprice DOUBLE, month STRING").parquet(path)


@query("k2_write_single_csv", ORDERS_SQL)
def k2(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "k2")
    writers.write_csv(t.orders.select(*ORDER_COLUMNS), path)
    return readers.read_csv(t.spark, path, ORDERS_CSV)


@query("k2_write_one_file", ORDERS_SQL)
def k2_one_file(t: Tables) -> DataFrame:
    path = f"{scratch_path(t.spark, 'k2')}/orders.csv"
    writers.write_single_csv(t.orders.select(*ORDER_COLUMNS), path, "o_orderkey")
    return readers.read_csv(t.spark, path, ORDERS_CSV)


@query(
    "k4_publish_and_read_manifest",
    """SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, o_orderpriority FROM orders""",
)
def k4_publish(t: Tables) -> DataFrame:
    """All orders published by priority, then one priority anew."""
    folder = scratch_path(t.spark, "k4")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    publish.publish(rows, folder, "o_orderpriority")
    urgent = rows.where("o_orderpriority LIKE '1%'").withColumn("o_totalprice", -F.col("o_totalprice"))
    publish.publish(urgent, folder, "o_orderpriority")
    publish.tidy(t.spark, folder)
    return publish.read_manifest(t.spark, f"{folder}/{publish.MANIFEST}", "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING")


@query("k3_write_csv_by_key", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def k3(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "k3")
    writers.write_csv_by_key(
        t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority"), path, "o_orderpriority"
    )
    return readers.read_csv(t.spark, path, "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING")


@query(
    "k4_register_table",
    "SELECT l_returnflag, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1",
)
def k4(t: Tables) -> DataFrame:
    name = writers.register_table(
        t.lineitem.select("l_returnflag", "l_quantity"), _table_name("lines"), path=scratch_path(t.spark, "k4")
    )
    return t.spark.sql(f"SELECT l_returnflag, sum(l_quantity) AS quantity FROM {name} GROUP BY l_returnflag")


@query("k5_write_text", "SELECT c_name AS value FROM customer")
def k5(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "k5")
    writers.write_text(t.customer, path, "c_name")
    return t.spark.read.text(path)
