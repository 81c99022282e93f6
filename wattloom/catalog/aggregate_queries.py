"""Group-bys, profiles and pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom import lookups
from wattloom.catalog.registry import Tables, query
from wattloom.catalog.stand_ins import (
    households,
    r,
    readings,
    rounded,
    sr,
    tariff,
    with_views,
)
from wattloom.functions.dates import day_name, time_of_day, to_day
from wattloom.functions.values import map_values
from wattloom.operators import aggregates as agg
from wattloom.operators import pivots as pv
from wattloom.operators import profiling as prof
from wattloom.operators.quantiles import quantiles
from wattloom.plans.tariffs import half_hours, time_of_day_profile

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def keyed_orders(t: Tables) -> DataFrame:
    """Orders with a NULL status in every fifth row."""
    return t.orders.select(
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("status"), "o_totalprice", "o_custkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"),
    )


KEYED_SQL = """
    SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS status, o_totalprice, o_custkey,
           CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS priority
    FROM orders"""


@query(
    "a1_group_mean",
    with_views(
        f"""SELECT status, {sr('avg(o_totalprice)', 3)} AS price, 'kept' AS nulls FROM keyed GROUP BY 1
            UNION ALL
            SELECT status, {sr('avg(o_totalprice)', 3)}, 'dropped' FROM keyed WHERE status IS NOT NULL GROUP BY 1""",
        keyed=KEYED_SQL,
    ),
)
def a1(t: Tables) -> DataFrame:
    rows = keyed_orders(t)
    kept = agg.group_mean(rows, "status", "o_totalprice", "price").withColumn("nulls", F.lit("kept"))
    dropped = agg.group_mean(rows, "status", "o_totalprice", "price", drop_null_keys=True)
    return rounded(kept.unionByName(dropped.withColumn("nulls", F.lit("dropped"))), digits=3)


@query(
    "a2_group_sum",
    f"""SELECT l_returnflag, l_linestatus, {sr('sum(l_quantity)', 2)} AS l_quantity,
               {sr('sum(l_extendedprice)', 2)} AS l_extendedprice FROM lineitem GROUP BY 1, 2""",
)
def a2(t: Tables) -> DataFrame:
    return rounded(
        agg.group_sum(t.lineitem, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"]), digits=2
    )


@query("a3_group_count", with_views("SELECT status, count(priority) AS priority FROM keyed WHERE status IS NOT NULL GROUP BY 1", keyed=KEYED_SQL))
def a3(t: Tables) -> DataFrame:
    return agg.group_count(keyed_orders(t), "status", "priority")


@query("a4_group_count2", with_views("SELECT status, priority, count(*) AS count FROM keyed GROUP BY 1, 2", keyed=KEYED_SQL))
def a4(t: Tables) -> DataFrame:
    return agg.group_count2(keyed_orders(t), "status", "priority")


@query(
    "a5_value_counts",
    with_views("SELECT priority, count(*) AS count FROM keyed WHERE priority IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1", keyed=KEYED_SQL),
)
def a5(t: Tables) -> DataFrame:
    return agg.value_counts(keyed_orders(t), "priority")


@query("a6_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def a6(t: Tables) -> DataFrame:
    return agg.distinct(t.lineitem, "l_partkey", "l_suppkey")


@query("a7_row_count", "SELECT count(*) AS rows FROM lineitem")
def a7(t: Tables) -> DataFrame:
    return agg.row_count(t.lineitem)


@query("a8_global_stats", f"SELECT {sr('avg(l_quantity)')} AS mean, {sr('stddev_samp(l_quantity)')} AS std FROM lineitem")
def a8(t: Tables) -> DataFrame:
    return rounded(agg.global_stats(t.lineitem, "l_quantity"))


@query(
    "a9_null_counts",
    with_views(
        """SELECT 'status' AS "column", count(*) - count(status) AS nulls FROM keyed UNION ALL
           SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM keyed UNION ALL
           SELECT 'o_custkey', count(*) - count(o_custkey) FROM keyed UNION ALL
           SELECT 'priority', count(*) - count(priority) FROM keyed""",
        keyed=KEYED_SQL,
    ),
)
def a9(t: Tables) -> DataFrame:
    return prof.null_counts(keyed_orders(t))


NUMERIC_LINES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def describe_sql(table: str, columns: list[str], digits: int = 4) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, count("{c}") AS count, {sr(f'avg("{c}")', digits)} AS mean,
            {sr(f'stddev_samp("{c}")', digits)} AS std, {sr(f'min("{c}")', digits)} AS min,
            {sr(f'quantile_cont("{c}", 0.25)', digits)} AS p25, {sr(f'quantile_cont("{c}", 0.5)', digits)} AS p50,
            {sr(f'quantile_cont("{c}", 0.75)', digits)} AS p75, {sr(f'max("{c}")', digits)} AS max FROM {table}"""
        for c in columns
    )


@query("a10_describe", describe_sql("lineitem", NUMERIC_LINES))
def a10(t: Tables) -> DataFrame:
    return rounded(prof.describe(t.lineitem, NUMERIC_LINES), digits=4)


def corr_sql(table: str, columns: list[str], digits: int = 6) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b, {sr(f'corr("{a}", "{b}")', digits)} AS corr FROM {table}"""
        for a in columns for b in columns
    )


@query("a11_corr_matrix", corr_sql("lineitem", NUMERIC_LINES))
def a11(t: Tables) -> DataFrame:
    return rounded(prof.corr_matrix(t.lineitem, NUMERIC_LINES))


@query(
    "a12_corr_with_target",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, {sr(f'corr("{c}", l_extendedprice)')} AS corr FROM lineitem"""
        for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")
    ),
)
def a12(t: Tables) -> DataFrame:
    return rounded(
        prof.corr_with_target(t.lineitem, ["l_quantity", "l_discount", "l_tax", "l_linenumber"], "l_extendedprice")
    )


@query(
    "a13_quantiles",
    " UNION ALL ".join(
        f"""SELECT 'l_extendedprice' AS variable, CAST({p} AS DOUBLE) AS prob,
            {sr(f'quantile_cont(l_extendedprice, {p})', 4)} AS value FROM lineitem"""
        for p in (0.25, 0.5, 0.75)
    ),
)
def a13(t: Tables) -> DataFrame:
    return rounded(quantiles(t.lineitem, "l_extendedprice"), "value", digits=4)


@query(
    "a13_quantiles_by_group",
    " UNION ALL ".join(
        f"""SELECT l_returnflag, l_linestatus, 'l_extendedprice' AS variable, CAST({p} AS DOUBLE) AS prob,
            {sr(f'quantile_cont(l_extendedprice, {p})', 4)} AS value FROM lineitem GROUP BY 1, 2"""
        for p in (0.1, 0.5, 0.9)
    ),
)
def a13_by_group(t: Tables) -> DataFrame:
    # Two counting steps whatever the size, so that the check covers them.
    found = quantiles(t.lineitem, "l_extendedprice", (0.1, 0.5, 0.9), ["l_returnflag", "l_linestatus"])
    return rounded(found, "value", digits=4)


def histogram_sql(table: str, column: str, bins: int, digits: int = 4) -> str:
    return f"""
        WITH e AS (SELECT min({column}) AS lo, (max({column}) - min({column})) / {bins}.0 AS w FROM {table}),
        c AS (SELECT CAST(least(floor(({column} - lo) / w), {bins} - 1) AS INTEGER) AS bin, count(*) AS n
              FROM {table}, e WHERE {column} IS NOT NULL GROUP BY 1),
        f AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))
        SELECT f.bin, {sr('lo + f.bin * w', digits)} AS lower, {sr('lo + (f.bin + 1) * w', digits)} AS upper,
               coalesce(n, 0) AS count
        FROM f CROSS JOIN e LEFT JOIN c ON f.bin = c.bin"""


@query("a14_histogram", histogram_sql("orders", "o_totalprice", 30))
def a14(t: Tables) -> DataFrame:
    return rounded(prof.histogram(t.orders, "o_totalprice", 30), "lower", "upper", digits=4)


@query(
    "a15_kde",
    f"""WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi,
                          stddev_samp(o_totalprice) * pow(count(*), -0.2) AS h FROM orders),
        g AS (SELECT CAST(range AS INTEGER) AS point, lo - 3 * h + range * (hi - lo + 6 * h) / 49.0 AS x, h
              FROM range(50), s)
        SELECT point, {sr('any_value(x)', 3)} AS x,
               {sr('1e6 * avg(exp(-0.5 * pow((o_totalprice - x) / h, 2))) / (any_value(h) * sqrt(2 * pi()))', 4)} AS density
        FROM g, orders GROUP BY point""",
)
def a15(t: Tables) -> DataFrame:
    curve = prof.kde(t.orders, "o_totalprice", grid=50)
    return curve.select("point", r("x", 3).alias("x"), r(F.col("density") * 1e6, 4).alias("density"))


def box_sql(table: str, columns: list[str], digits: int = 4) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, {sr('any_value(q1)', digits)} AS q1, {sr('any_value(q2)', digits)} AS median,
            {sr('any_value(q3)', digits)} AS q3,
            {sr(f'min("{c}") FILTER ("{c}" >= q1 - 1.5 * (q3 - q1) AND "{c}" <= q3 + 1.5 * (q3 - q1))', digits)} AS whisker_low,
            {sr(f'max("{c}") FILTER ("{c}" >= q1 - 1.5 * (q3 - q1) AND "{c}" <= q3 + 1.5 * (q3 - q1))', digits)} AS whisker_high,
            count(*) FILTER ("{c}" < q1 - 1.5 * (q3 - q1) OR "{c}" > q3 + 1.5 * (q3 - q1)) AS outliers
            FROM {table}, (SELECT quantile_cont("{c}", 0.25) AS q1, quantile_cont("{c}", 0.5) AS q2,
                                  quantile_cont("{c}", 0.75) AS q3 FROM {table})"""
        for c in columns
    )


@query("a16_box_stats", box_sql("events", ["value"]) + " UNION ALL " + box_sql("events", ["user_id"]))
def a16(t: Tables) -> DataFrame:
    return rounded(prof.box_stats(t.events, ["value", "user_id"]), digits=4)


def pivot_mean_sql(values: list[str], column: str, value: str) -> str:
    return ", ".join(f"""{sr(f"avg(CASE WHEN {column} = '{v}' THEN {value} END)", 4)} AS "{v}" """ for v in values)


@query(
    "a17_pivot_mean",
    with_views(
        f"""SELECT tstp, {pivot_mean_sql(SEGMENTS, '"Acorn_grouped"', 'energy')}
            FROM readings LEFT JOIN households USING ("LCLid") GROUP BY 1""",
        "readings", "households",
    ),
)
def a17(t: Tables) -> DataFrame:
    rows = readings(t).join(households(t).select("LCLid", "Acorn_grouped"), "LCLid", "left")
    return rounded(pv.pivot_mean(rows, "tstp", "Acorn_grouped", "energy", SEGMENTS), digits=4)


TIMES = half_hours()
CALENDAR_SQL = """
    SELECT *, CAST("TariffDateTime" AS DATE) AS "Date", strftime("TariffDateTime", '%H:%M') AS "Time",
           dayname("TariffDateTime") AS "DayOfWeek", strftime("TariffDateTime", '%Y-%m') AS "Month",
           CAST(CASE "Tariff" WHEN 'Low' THEN 0 WHEN 'Normal' THEN 1 WHEN 'High' THEN 2 END AS INTEGER) AS "TariffNumeric"
    FROM tariff"""


@query(
    "a18_pivot_unique",
    with_views(
        'SELECT "Date", '
        + ", ".join(f"""max(CASE WHEN "Time" = '{h}' THEN "TariffNumeric" END) AS "{h}" """ for h in TIMES)
        + " FROM calendar GROUP BY 1",
        "tariff", calendar=CALENDAR_SQL,
    ),
)
def a18(t: Tables) -> DataFrame:
    rows = tariff(t).select(
        to_day("TariffDateTime").alias("Date"), time_of_day("TariffDateTime").alias("Time"),
        map_values("Tariff", lookups.TARIFF_RANK).alias("TariffNumeric"),
    )
    return pv.pivot_unique(rows, "Date", "Time", "TariffNumeric", TIMES)


@query(
    "a19_pivot_mode",
    """WITH n AS (SELECT dayname(o_orderdate) AS day, o_orderstatus AS status, o_orderpriority AS p, count(*) AS c
                  FROM orders GROUP BY 1, 2, 3),
       m AS (SELECT day, status, p, row_number() OVER (PARTITION BY day, status ORDER BY c DESC, p) AS k FROM n)
       SELECT day, max(CASE WHEN status = 'F' THEN p END) AS "F", max(CASE WHEN status = 'O' THEN p END) AS "O",
              max(CASE WHEN status = 'P' THEN p END) AS "P"
       FROM m WHERE k = 1 GROUP BY 1""",
)
def a19(t: Tables) -> DataFrame:
    rows = t.orders.select(day_name("o_orderdate").alias("day"), "o_orderstatus", "o_orderpriority")
    return pv.pivot_mode(rows, "day", "o_orderstatus", "o_orderpriority", ["F", "O", "P"])


@query(
    "a20_crosstab",
    with_views(
        """SELECT "Acorn", count(*) FILTER ("stdorToU" = 'Std') AS "Std", count(*) FILTER ("stdorToU" = 'ToU') AS "ToU"
           FROM households GROUP BY 1""",
        "households",
    ),
)
def a20(t: Tables) -> DataFrame:
    return pv.crosstab(households(t), "Acorn", "stdorToU", ["Std", "ToU"])


def unstack_sql(key: str) -> str:
    counts = ", ".join(f"""count(*) FILTER ("Tariff" = '{v}') AS "{v}" """ for v in lookups.TARIFF_RANK)
    return with_views(f'SELECT "{key}", {counts} FROM calendar GROUP BY 1', "tariff", calendar=CALENDAR_SQL)


@query("a21_size_unstack", unstack_sql("Time"))
def a21(t: Tables) -> DataFrame:
    rows = tariff(t).select(time_of_day("TariffDateTime").alias("Time"), "Tariff")
    return pv.size_unstack(rows, "Time", "Tariff", list(lookups.TARIFF_RANK))


@query(
    "a22_trend_mean_ci",
    f"""SELECT CAST(l_shipdate AS DATE) AS day, {sr('avg(l_quantity)', 4)} AS mean,
               {sr('avg(l_quantity) - 1.96 * stddev_samp(l_quantity) / sqrt(count(l_quantity))', 4)} AS ci_low,
               {sr('avg(l_quantity) + 1.96 * stddev_samp(l_quantity) / sqrt(count(l_quantity))', 4)} AS ci_high
        FROM lineitem GROUP BY 1""",
)
def a22(t: Tables) -> DataFrame:
    rows = t.lineitem.select(to_day("l_shipdate").alias("day"), "l_quantity")
    return rounded(agg.trend_mean_ci(rows, "day", "l_quantity"), digits=4)


def _bootstrap_sql(replicates: int) -> str:
    drawn = " + ".join(f"CASE WHEN draw >= {limit} THEN 1 ELSE 0 END" for limit in agg._POISSON)
    return f"""
        WITH rows AS (SELECT l_returnflag AS flag, l_quantity AS y, l_orderkey || ':' || l_linenumber AS key FROM lineitem),
        drawn AS (SELECT flag, y, b, CAST('0x' || substr(md5('42:' || (b // 8) || ':' || key), 4 * (b % 8) + 1, 4) AS INTEGER) AS draw
                  FROM rows, (SELECT unnest(range({replicates})) AS b)),
        replicate AS (SELECT flag, b, sum(y * w) / sum(w) AS m FROM (SELECT *, {drawn} AS w FROM drawn) GROUP BY 1, 2 HAVING sum(w) > 0),
        means AS (SELECT flag, avg(y) AS mean FROM rows GROUP BY 1)
        SELECT flag, {sr('any_value(mean)')} AS mean, {sr('quantile_cont(m, 0.025)')} AS ci_low, {sr('quantile_cont(m, 0.975)')} AS ci_high
        FROM replicate JOIN means USING (flag) GROUP BY 1"""


@query("a22_bootstrap_mean_ci", _bootstrap_sql(48))
def a22_bootstrap(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_returnflag").alias("flag"), "l_quantity", F.concat_ws(":", "l_orderkey", "l_linenumber").alias("key"))
    return rounded(agg.bootstrap_mean_ci(rows, "flag", "l_quantity", "key", 48))


@query(
    "a23_group_mean_all_numeric",
    f"""SELECT p_type, p_brand, {sr('avg(p_partkey)', 3)} AS p_partkey, {sr('avg(p_size)', 4)} AS p_size,
               {sr('avg(p_retailprice)', 3)} AS p_retailprice FROM part GROUP BY 1, 2""",
)
def a23(t: Tables) -> DataFrame:
    means = agg.group_mean_all_numeric(t.part, ["p_type", "p_brand"])
    return rounded(rounded(means, "p_partkey", "p_retailprice", digits=3), "p_size", digits=4)


@query(
    "a24_hourly_actual_vs_potential",
    f"""SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, {sr('avg(value)', 4)} AS actual,
               {sr('avg(value * 0.8 + user_id)', 4)} AS potential,
               {sr('avg(value) - avg(value * 0.8 + user_id)', 4)} AS difference
        FROM events GROUP BY 1, 2""",
)
def a24(t: Tables) -> DataFrame:
    rows = t.events.withColumn("potential_value", F.col("value") * 0.8 + F.col("user_id"))
    return rounded(
        agg.hourly_actual_vs_potential(rows, "event_type", "ts", "value", "potential_value"), digits=4
    )


@query(
    "a25_word_freq",
    r"""SELECT word, count(*) AS count FROM (
            SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}_]+')) AS word FROM documents)
        WHERE word NOT IN ('', 'the', 'of', 'and') GROUP BY 1""",
)
def a25(t: Tables) -> DataFrame:
    return agg.word_freq(t.documents, "text", ["the", "of", "and"])


@query(
    "a26_time_of_day_profile",
    with_views(
        f"""SELECT strftime(tstp, '%H:%M') AS time_of_day, "Acorn" AS "group", {sr('avg(energy)', 4)} AS energy
            FROM readings JOIN households USING ("LCLid")
            WHERE tstp >= TIMESTAMP '2024-01-03' AND tstp < TIMESTAMP '2024-01-24' GROUP BY 1, 2""",
        "readings", "households",
    ),
)
def a26(t: Tables) -> DataFrame:
    profile = time_of_day_profile(readings(t), households(t), "2024-01-03", "2024-01-24", "acorn")
    return rounded(profile, "energy", digits=4)


@query("a27_rmse", f"SELECT {sr('sqrt(avg(pow(l_extendedprice - 1500 * l_quantity, 2)))', 3)} AS rmse FROM lineitem")
def a27(t: Tables) -> DataFrame:
    return t.lineitem.agg(r(agg.rmse(F.col("l_extendedprice"), F.lit(1500.0) * F.col("l_quantity")), 3).alias("rmse"))


@query(
    "a28_rmse_pct_of_mean",
    f"""SELECT l_returnflag,
               {sr('100 * sqrt(avg(pow(l_extendedprice - 1500 * l_quantity, 2))) / avg(l_extendedprice)', 5)} AS pct
        FROM lineitem GROUP BY 1""",
)
def a28(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("guess", F.lit(1500.0) * F.col("l_quantity"))
    return rows.groupBy("l_returnflag").agg(r(agg.rmse_pct_of_mean("l_extendedprice", "guess"), 5).alias("pct"))


@query(
    "a29_table_shape",
    " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS "column", '{k}' AS type, count(*) AS rows,
            CAST(6 AS INTEGER) AS columns FROM orders"""
        for i, (c, k) in enumerate(
            [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
             ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
        )
    ),
)
def a29(t: Tables) -> DataFrame:
    return prof.table_shape(t.orders)
