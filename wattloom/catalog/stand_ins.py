"""Domain tables derived from the test tables, as DataFrames and as SQL.

Each function has a SQL twin in ``SQL``; ``with_views`` puts the twins a query needs in front of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.catalog.registry import Tables
from wattloom.schemas import ACORN_CODES


def r(c: str | Column, digits: int = 6) -> Column:
    """Round for comparison.

    A nudge far below the last digit keeps halves from falling either way with the order of a sum, and
    adding zero turns -0.0 into 0.0.
    """
    value = F.col(c) if isinstance(c, str) else c
    return F.round(value + F.lit(_nudge(digits)), digits) + F.lit(0.0)


def _nudge(digits: int) -> float:
    return float(f"1.37e-{digits + 2}")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round the named columns (all double columns when none are named)."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: r(F.col(f"`{c}`"), digits) for c in names})


def _first_slot() -> Column:
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def half_hour(ts: str) -> Column:
    """The half hour that a time falls in; NULL stays NULL."""
    minutes = (slot_number(ts) * 30).cast("int")
    return F.timestamp_add("MINUTE", minutes, _first_slot())


def slot_number(ts: str | Column) -> Column:
    """Half hours since 2024-01-01."""
    return F.floor(F.timestamp_diff("MICROSECOND", _first_slot(), F.col(ts) if isinstance(ts, str) else ts) / F.lit(1.8e9))


def acorn_code(nationkey: str) -> Column:
    """ACORN-A .. ACORN-U for nations 0 to 20, the bare ACORN- for the rest."""
    letter = F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTU"), F.col(nationkey) + 1, F.lit(1))
    return F.concat(F.lit("ACORN-"), F.when(F.col(nationkey) < 21, letter).otherwise(""))


def readings(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").cast("string").alias("LCLid"),
        half_hour("ts").alias("tstp"),
        F.col("value").alias("energy"),
    )


def households(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("LCLid"),
        F.when(F.col("c_custkey") % 5 == 0, "ToU").otherwise("Std").alias("stdorToU"),
        acorn_code("c_nationkey").alias("Acorn"),
        F.col("c_mktsegment").alias("Acorn_grouped"),
        F.concat(F.lit("block_"), (F.col("c_custkey") % 7).cast("string")).alias("file"),
    )


def acorn_information(t: Tables) -> DataFrame:
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return nations.where(F.col("n_nationkey") < 21).select(
        acorn_code("n_nationkey").alias("Acorn"), F.col("r_name").alias("Acorn Category")
    )


def tariff(t: Tables) -> DataFrame:
    """Priced slots: the slots seen and the same slots 40 days on, every seventh one missing."""
    slot = t.events.select(half_hour("ts").alias("_slot"))
    both = F.array(F.col("_slot"), F.col("_slot") + F.expr("INTERVAL 40 DAYS"))
    slots = slot.select(F.explode(both).alias("TariffDateTime")).distinct()
    slots = slots.where(slot_number("TariffDateTime") % 7 != 3)
    hour = F.hour("TariffDateTime")
    return slots.select(
        "TariffDateTime",
        F.when(hour.between(16, 19), "High").when(hour <= 5, "Low").otherwise("Normal").alias("Tariff"),
    )


def details(t: Tables) -> DataFrame:
    """Wide demographic figures: quantities per part class, one column per code."""
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    figures = [
        F.sum(F.when(F.col("l_suppkey") % 17 == i, F.col("l_quantity"))).alias(code)
        for i, code in enumerate(ACORN_CODES)
    ]
    return rows.groupBy(
        F.when(F.col("p_size") % 3 == 0, "HOUSING").otherwise("POPULATION").alias("MAIN CATEGORIES"),
        F.when(F.col("p_size") % 2 == 0, "House Type").otherwise("House Tenure").alias("CATEGORIES"),
        F.col("p_type").alias("REFERENCE"),
    ).agg(*figures)


def property_efficiency(t: Tables) -> DataFrame:
    return (
        t.part.where(F.col("p_type") != "PROMO")
        .groupBy(F.col("p_type").alias("Housing Type"))
        .agg(
            F.avg(F.col("p_size").cast("double")).alias("Current Efficiency"),
            F.avg(F.col("p_retailprice") / 10.0).alias("Potential Efficiency"),
        )
    )


def property_types(t: Tables) -> DataFrame:
    """Several housing types for a demographic group, in a stated order."""
    kinds = F.element_at(
        F.array(*[F.lit(k) for k in ("STANDARD", "MEDIUM", "ECONOMY", "SMALL", "LARGE")]),
        (F.col("s_suppkey") % 5 + 1).cast("int"),
    )
    return t.supplier.where(F.col("s_nationkey") < 21).select(
        acorn_code("s_nationkey").alias("Acorn"), kinds.alias("Housing Type"), F.col("s_suppkey").alias("rank")
    )


def daily(t: Tables) -> DataFrame:
    """Daily use: orders by household and day."""
    price = F.col("o_totalprice") / F.lit(10000.0)
    return t.orders.groupBy(
        F.concat(F.lit("MAC"), F.col("o_custkey").cast("string")).alias("LCLid"),
        F.to_date("o_orderdate").alias("day"),
    ).agg(
        F.avg(price).alias("energy_mean"),
        F.max(price).alias("energy_max"),
        F.count(F.lit(1)).cast("int").alias("energy_count"),
        F.sum(price).alias("energy_sum"),
        F.min(price).alias("energy_min"),
    )


def weather(t: Tables) -> DataFrame:
    """Daily weather: line items by shipping date, with gaps and text times."""
    rows = t.lineitem.groupBy(F.to_date("l_shipdate").alias("d")).agg(
        F.max("l_quantity").alias("qmax"),
        F.min("l_quantity").alias("qmin"),
        F.avg("l_discount").alias("humidity"),
        F.avg("l_tax").alias("cloud"),
        F.max("l_linenumber").alias("uv"),
        F.avg(F.col("l_extendedprice") / 1000.0).alias("pressure"),
        F.sum("l_discount").alias("windSpeed"),
        F.max("l_tax").alias("windBearing"),
        F.min("l_returnflag").alias("flag"),
        F.count(F.lit(1)).alias("n"),
    )
    at = lambda hour: F.concat(F.date_format("d", "dd/MM/yyyy"), F.lit(hour))
    return rows.select(
        at(" 00:00").alias("time"),
        at(" 06:15").alias("sunriseTime"),
        F.concat(F.date_format("d", "dd/MM/yyyy "), F.when(F.col("n") % 2 == 0, "18:45").otherwise("20:05"))
        .alias("sunsetTime"),
        F.when(F.col("n") % 3 == 0, at(" 12:00")).alias("uvIndexTime"),
        (F.col("qmax") - 20.0).alias("temperatureMax"),
        (F.col("qmin") - 20.0).alias("temperatureMin"),
        (F.col("qmax") - 21.0).alias("temperatureHigh"),
        (F.col("qmin") - 19.0).alias("temperatureLow"),
        (F.col("qmax") - 23.0).alias("apparentTemperatureMax"),
        (F.col("qmin") - 22.0).alias("apparentTemperatureMin"),
        (F.col("qmax") - 24.0).alias("apparentTemperatureHigh"),
        (F.col("qmin") - 25.0).alias("apparentTemperatureLow"),
        "humidity",
        F.when(F.dayofmonth("d") != 11, F.col("cloud")).alias("cloudCover"),
        F.when(F.dayofmonth("d") != 12, F.col("uv").cast("double")).alias("uvIndex"),
        F.when(F.dayofmonth("d") != 13, F.col("pressure")).alias("pressure"),
        "windSpeed", "windBearing",
        F.when(F.col("flag") == "A", "rain").otherwise("snow").alias("precipType"),
    )


def screening_weather(t: Tables) -> DataFrame:
    """``weather`` with the columns that only the feature screening reads."""
    more = t.lineitem.groupBy(F.to_date("l_shipdate").alias("d")).agg(
        (F.avg("l_quantity") - 25.0).alias("dewPoint"), (F.avg("l_extendedprice") / 5000.0).alias("visibility")
    )
    phase = F.pmod(F.datediff("d", F.lit("1992-01-04").cast("date")), F.lit(29)) / F.lit(29.0)
    dated = more.select(
        F.concat(F.date_format("d", "dd/MM/yyyy"), F.lit(" 00:00")).alias("time"), "dewPoint", "visibility",
        phase.alias("moonPhase"),
    )
    return weather(t).join(dated, "time", "left")


HOLIDAYS = (
    ("1996-12-25", "Christmas Day"),
    ("01/01/1997", "New Year's Day"),
    ("1/1/1997", "Bank Day"),
    ("04/03/1998", "Founders Day"),
    ("unknown", "Unreadable"),
)


def holidays(t: Tables) -> DataFrame:
    """A short calendar in mixed text formats: one date twice, one unreadable."""
    rows = [F.struct(F.lit(d).alias("Bank holidays"), F.lit(k).alias("Type")) for d, k in HOLIDAYS]
    return t.spark.range(1).select(F.inline(F.array(*rows)))


def event_days(t: Tables) -> DataFrame:
    """Use per household and day from events."""
    return t.events.groupBy(
        F.col("user_id").cast("string").alias("LCLid"), F.to_date("ts").alias("day")
    ).agg(
        F.sum("value").alias("energy_sum"),
        F.avg("value").alias("energy_mean"),
        F.max("value").alias("energy_max"),
        F.min("value").alias("energy_min"),
        F.count("value").cast("int").alias("energy_count"),
    )


def _acorn_sql(column: str) -> str:
    return (
        f"'ACORN-' || CASE WHEN {column} < 21 THEN substr('ABCDEFGHIJKLMNOPQRSTU', {column} + 1, 1) ELSE '' END"
    )


SQL: dict[str, str] = {
    "readings": """
        SELECT CAST(user_id AS VARCHAR) AS "LCLid", time_bucket(INTERVAL 30 MINUTE, ts) AS tstp,
               value AS energy FROM events""",
    "households": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS "LCLid",
               CASE WHEN c_custkey % 5 = 0 THEN 'ToU' ELSE 'Std' END AS "stdorToU",
               {_acorn_sql('c_nationkey')} AS "Acorn", c_mktsegment AS "Acorn_grouped",
               'block_' || CAST(c_custkey % 7 AS VARCHAR) AS file FROM customer""",
    "acorn_information": f"""
        SELECT {_acorn_sql('n_nationkey')} AS "Acorn", r_name AS "Acorn Category"
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 21""",
    "tariff": """
        SELECT "TariffDateTime",
               CASE WHEN hour("TariffDateTime") BETWEEN 16 AND 19 THEN 'High'
                    WHEN hour("TariffDateTime") <= 5 THEN 'Low' ELSE 'Normal' END AS "Tariff"
        FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS "TariffDateTime" FROM events
              UNION SELECT time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 40 DAY FROM events)
        WHERE (date_diff('minute', TIMESTAMP '2024-01-01 00:00:00', "TariffDateTime") // 30) % 7 <> 3""",
    "details": f"""
        SELECT CASE WHEN p_size % 3 = 0 THEN 'HOUSING' ELSE 'POPULATION' END AS "MAIN CATEGORIES",
               CASE WHEN p_size % 2 = 0 THEN 'House Type' ELSE 'House Tenure' END AS "CATEGORIES",
               p_type AS "REFERENCE",
               {', '.join(f'sum(CASE WHEN l_suppkey % 17 = {i} THEN l_quantity END) AS "{c}"'
                          for i, c in enumerate(ACORN_CODES))}
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
    "property_efficiency": """
        SELECT p_type AS "Housing Type", avg(CAST(p_size AS DOUBLE)) AS "Current Efficiency",
               avg(p_retailprice / 10.0) AS "Potential Efficiency"
        FROM part WHERE p_type <> 'PROMO' GROUP BY 1""",
    "property_types": f"""
        SELECT {_acorn_sql('s_nationkey')} AS "Acorn",
               ['STANDARD', 'MEDIUM', 'ECONOMY', 'SMALL', 'LARGE'][s_suppkey % 5 + 1] AS "Housing Type",
               s_suppkey AS rank
        FROM supplier WHERE s_nationkey < 21""",
    "daily": """
        SELECT 'MAC' || CAST(o_custkey AS VARCHAR) AS "LCLid", CAST(o_orderdate AS DATE) AS day,
               avg(o_totalprice / 10000.0) AS energy_mean, max(o_totalprice / 10000.0) AS energy_max,
               CAST(count(*) AS INTEGER) AS energy_count, sum(o_totalprice / 10000.0) AS energy_sum,
               min(o_totalprice / 10000.0) AS energy_min
        FROM orders GROUP BY 1, 2""",
    "weather": """
        SELECT strftime(d, '%d/%m/%Y') || ' 00:00' AS time, strftime(d, '%d/%m/%Y') || ' 06:15' AS "sunriseTime",
               strftime(d, '%d/%m/%Y ') || CASE WHEN n % 2 = 0 THEN '18:45' ELSE '20:05' END AS "sunsetTime",
               CASE WHEN n % 3 = 0 THEN strftime(d, '%d/%m/%Y') || ' 12:00' END AS "uvIndexTime",
               qmax - 20 AS "temperatureMax", qmin - 20 AS "temperatureMin", qmax - 21 AS "temperatureHigh",
               qmin - 19 AS "temperatureLow", qmax - 23 AS "apparentTemperatureMax",
               qmin - 22 AS "apparentTemperatureMin", qmax - 24 AS "apparentTemperatureHigh",
               qmin - 25 AS "apparentTemperatureLow", humidity,
               CASE WHEN day(d) <> 11 THEN cloud END AS "cloudCover",
               CASE WHEN day(d) <> 12 THEN CAST(uv AS DOUBLE) END AS "uvIndex",
               CASE WHEN day(d) <> 13 THEN pressure END AS pressure,
               "windSpeed", "windBearing",
               CASE WHEN flag = 'A' THEN 'rain' ELSE 'snow' END AS "precipType"
        FROM (SELECT CAST(l_shipdate AS DATE) AS d, max(l_quantity) AS qmax, min(l_quantity) AS qmin,
                     avg(l_discount) AS humidity, avg(l_tax) AS cloud, max(l_linenumber) AS uv,
                     avg(l_extendedprice / 1000.0) AS pressure, sum(l_discount) AS "windSpeed",
                     max(l_tax) AS "windBearing", min(l_returnflag) AS flag, count(*) AS n
              FROM lineitem GROUP BY 1)""",
    "screening": """
        SELECT CAST(l_shipdate AS DATE) AS date, avg(l_quantity) - 25.0 AS "dewPoint", avg(l_extendedprice) / 5000.0 AS visibility,
               any_value(date_diff('day', DATE '1992-01-04', CAST(l_shipdate AS DATE)) % 29 + 29) % 29 / 29.0 AS "moonPhase"
        FROM lineitem GROUP BY 1""",
    "holidays": """
        SELECT * FROM (VALUES ('1996-12-25', 'Christmas Day'), ('01/01/1997', 'New Year''s Day'),
                              ('1/1/1997', 'Bank Day'), ('04/03/1998', 'Founders Day'),
                              ('unknown', 'Unreadable')) AS h("Bank holidays", "Type")""",
    "event_days": """
        SELECT CAST(user_id AS VARCHAR) AS "LCLid", CAST(ts AS DATE) AS day, sum(value) AS energy_sum,
               avg(value) AS energy_mean, max(value) AS energy_max, min(value) AS energy_min,
               CAST(count(value) AS INTEGER) AS energy_count
        FROM events GROUP BY 1, 2""",
}


def with_views(sql: str, *names: str, **more: str) -> str:
    """``WITH`` the named stand-ins, and further named sub-queries, in front of a query."""
    parts = [f"{n} AS ({SQL[n]})" for n in names] + [f"{n} AS ({s})" for n, s in more.items()]
    return "WITH " + ",\n".join(parts) + "\n" + sql


def sr(expression: str, digits: int = 6) -> str:
    """SQL twin of ``r``."""
    return f"(round(({expression}) + {_nudge(digits):.3e}, {digits}) + 0.0)"
