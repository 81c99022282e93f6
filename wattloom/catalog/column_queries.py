"""Projections and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom import lookups
from wattloom.catalog.registry import Tables, query
from wattloom.catalog.stand_ins import (
    details,
    households,
    property_efficiency,
    property_types,
    r,
    readings,
    rounded,
    sr,
    with_views,
)
from wattloom.functions.dates import is_weekend
from wattloom.functions.values import flag_when, map_values, map_values_2level, ratio, to_numeric
from wattloom.operators import columns as ops
from wattloom.operators.joins import inner_join, unique_lookup
from wattloom.plans.demographics import DETAIL_KEYS
from wattloom.schemas import ACORN_CODES


@query("p1_project", "SELECT o_orderkey, o_totalprice FROM orders")
def p1(t: Tables) -> DataFrame:
    return ops.project(t.orders, ["o_orderkey", "o_totalprice"])


@query("p2_drop_columns", "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer")
def p2(t: Tables) -> DataFrame:
    return ops.drop_columns(t.customer, "c_name", "c_acctbal", "no_such_column")


@query("p3_drop_matching", "SELECT o_orderkey, o_custkey FROM orders")
def p3(t: Tables) -> DataFrame:
    stray = t.orders.select(
        F.col("o_orderkey").alias("Unnamed: 0"), "o_orderkey", "o_custkey", F.col("o_totalprice").alias("Unnamed: 2")
    )
    return ops.drop_matching(stray, r"^Unnamed:")


@query("p4_rename", "SELECT o_orderkey AS id, o_totalprice AS price FROM orders")
def p4(t: Tables) -> DataFrame:
    return ops.rename(t.orders.select("o_orderkey", "o_totalprice"), {"o_orderkey": "id", "o_totalprice": "price"})


@query(
    "p5_cast_columns",
    """SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS price_text,
              TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rank,
              TRY_CAST(o_orderstatus AS DOUBLE) AS status
       FROM orders""",
)
def p5(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey",
        F.col("o_totalprice").alias("price_text"),
        F.substring("o_orderpriority", 1, 1).alias("rank"),
        F.col("o_orderstatus").alias("status"),
    )
    return ops.cast_columns(rows, {"price_text": "string", "rank": "int", "status": "double"})


@query(
    "p6_to_numeric_coerce",
    """SELECT event_id, CASE WHEN event_id % 5 IN (0, 1, 2) THEN NULL ELSE value END AS number FROM events""",
)
def p6(t: Tables) -> DataFrame:
    text = (
        F.when(F.col("event_id") % 5 == 0, "Null")
        .when(F.col("event_id") % 5 == 1, "")
        .when(F.col("event_id") % 5 == 2, "NaN")
        .otherwise(F.col("value").cast("string"))
    )
    return t.events.select("event_id", to_numeric(text).alias("number"))


@query(
    "p7_derive",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {sr('l_extendedprice * (1 - l_discount)', 4)} AS net,
               {sr('l_extendedprice / nullif(l_quantity, 0)', 4)} AS unit, l_quantity - l_linenumber AS gap
        FROM lineitem""",
)
def p7(t: Tables) -> DataFrame:
    rows = ops.derive(
        t.lineitem,
        {
            "net": r(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4),
            "unit": r(ratio("l_extendedprice", "l_quantity"), 4),
            "gap": F.col("l_quantity") - F.col("l_linenumber"),
        },
    )
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "net", "unit", "gap")


@query(
    "p8_flag_when",
    """SELECT o_orderkey, CAST(CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
              CAST(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END AS INTEGER) AS is_open
       FROM orders""",
)
def p8(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        is_weekend("o_orderdate").alias("is_weekend"),
        flag_when(F.col("o_orderstatus") != "F").alias("is_open"),
    )


def _case(column: str, table: dict[str, object]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v if isinstance(v, int) else repr(v)}" for k, v in table.items())
    return f"CASE {column} {arms} END"


@query(
    "p9_map_values",
    with_views(
        f"""SELECT "LCLid", {_case('"Acorn"', lookups.LIFESTYLES)} AS lifestyle,
                   {_case('"Acorn"', lookups.HOUSING_TYPES)} AS housing, {_case('"Acorn"', lookups.TENURES)} AS tenure,
                   {_case('"Acorn"', lookups.INCOMES)} AS income
            FROM households""",
        "households",
    ),
)
def p9(t: Tables) -> DataFrame:
    return households(t).select(
        "LCLid",
        map_values("Acorn", lookups.LIFESTYLES).alias("lifestyle"),
        map_values("Acorn", lookups.HOUSING_TYPES).alias("housing"),
        map_values("Acorn", lookups.TENURES).alias("tenure"),
        map_values("Acorn", lookups.INCOMES).alias("income"),
    )


@query(
    "p10_map_values_2level",
    with_views(
        f"""SELECT "LCLid", {_case('income', lookups.INCOME_BANDS)} AS band
            FROM (SELECT "LCLid", {_case('"Acorn"', lookups.INCOMES)} AS income FROM households)""",
        "households",
    ),
)
def p10(t: Tables) -> DataFrame:
    band = map_values_2level("Acorn", lookups.INCOMES, lookups.INCOME_BANDS)
    return households(t).select("LCLid", band.alias("band"))


@query(
    "p11_numeric_columns",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
)
def p11(t: Tables) -> DataFrame:
    return ops.project(t.lineitem, ops.numeric_columns(t.lineitem))


@query("p12_columns_like", "SELECT p_name, p_partkey, p_size, p_brand, p_type, p_retailprice FROM part")
def p12(t: Tables) -> DataFrame:
    both = t.part.withColumn("stray", F.lit(1))
    return ops.project(both, ops.columns_like(both, "p_"))


DETAIL_KEYS_SQL = '"MAIN CATEGORIES", "CATEGORIES", "REFERENCE"'
LONG_DETAILS_SQL = " UNION ALL ".join(
    f"""SELECT {DETAIL_KEYS_SQL}, '{c}' AS "Acorn", "{c}" AS "Value" FROM details""" for c in ACORN_CODES
)


@query("p13_unpivot", with_views(LONG_DETAILS_SQL, "details"))
def p13(t: Tables) -> DataFrame:
    return ops.unpivot(details(t), DETAIL_KEYS, ACORN_CODES)


@query(
    "p14_transpose",
    with_views(
        """SELECT variable, max(CASE WHEN s = 'F' THEN v END) AS "F", max(CASE WHEN s = 'O' THEN v END) AS "O",
                  max(CASE WHEN s = 'P' THEN v END) AS "P"
           FROM (SELECT s, 'orders' AS variable, orders AS v FROM sums UNION ALL
                 SELECT s, 'customers', customers FROM sums)
           GROUP BY 1""",
        sums="""SELECT o_orderstatus AS s, count(*) AS orders, count(DISTINCT o_custkey) AS customers
                FROM orders GROUP BY 1""",
    ),
)
def p14(t: Tables) -> DataFrame:
    sums = t.orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("customers")
    )
    return ops.transpose(sums, "o_orderstatus", ["F", "O", "P"], ["orders", "customers"])


RATIO_GROUPS = [*(f"ACORN-{letter}" for letter in "ABCDEFGHIJKLMNOPQRSTU"), "ACORN-"]

FACTORS_SQL = """
    SELECT "Acorn", first_current / last_potential AS factor
    FROM (SELECT "Acorn", arg_min("Current Efficiency", rank) AS first_current,
                 arg_max("Potential Efficiency", rank) AS last_potential
          FROM property_types JOIN property_efficiency USING ("Housing Type") GROUP BY 1)"""


def wide_means_sql(groups: list[str]) -> str:
    cells = ", ".join(f"""avg(CASE WHEN "Acorn" = '{g}' THEN energy END) AS "{g}" """ for g in groups)
    return f"""SELECT tstp AS "Datetime", {cells} FROM readings JOIN households USING ("LCLid") GROUP BY 1"""


@query(
    "p15_wide_ratio",
    with_views(
        'SELECT "Datetime", '
        + ", ".join(f'{sr(chr(34) + g + chr(34))} AS "{g}"' for g in RATIO_GROUPS)
        + ", "
        + ", ".join(
            f"""{sr(f'"{g}" * (SELECT factor FROM factors WHERE "Acorn" = {g!r})')} AS "{g}_Potential" """
            for g in RATIO_GROUPS
        )
        + " FROM wide",
        "readings", "households", "property_types", "property_efficiency",
        factors=FACTORS_SQL, wide=wide_means_sql(RATIO_GROUPS),
    ),
)
def p15(t: Tables) -> DataFrame:
    joined = inner_join(readings(t), households(t), "LCLid")
    wide = joined.groupBy(F.col("tstp").alias("Datetime")).pivot("Acorn", RATIO_GROUPS).agg(F.avg("energy"))
    rated = inner_join(property_types(t), property_efficiency(t), "Housing Type")
    first = unique_lookup(rated, "Acorn", "rank", "first").select("Acorn", "Current Efficiency")
    last = unique_lookup(rated, "Acorn", "rank", "last").select("Acorn", "Potential Efficiency")
    factors = inner_join(first, last, "Acorn")
    return rounded(
        ops.wide_ratio(
            wide, factors, ["Datetime"], RATIO_GROUPS, "Acorn", "Current Efficiency", "Potential Efficiency"
        )
    )
