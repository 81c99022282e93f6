"""Demographic shares and property efficiency per demographic group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.columns import columns_like, unpivot
from wattloom.operators.filters import filter_eq
from wattloom.operators.joins import left_join_on
from wattloom.operators.windows import share_of_group

DETAIL_KEYS = ["MAIN CATEGORIES", "CATEGORIES", "REFERENCE"]


def demographic_share(details: DataFrame, prefix: str = "ACORN-") -> DataFrame:
    """Each figure of the wide demographic table as a share of its category and group."""
    long = unpivot(details, DETAIL_KEYS, columns_like(details, prefix))
    long = long.withColumn("Value", F.col("Value").try_cast("double"))
    return share_of_group(long, ["MAIN CATEGORIES", "CATEGORIES", "Acorn"], "Value")


def efficiency_by_group(details: DataFrame, property_efficiency: DataFrame) -> DataFrame:
    """Current and potential efficiency per group, weighted by the group's mix of house types.

    The house-type rows are picked before the shares are taken: they are whole categories, so the
    totals are the same and only that small part is melted.
    """
    houses = filter_eq(details, {"MAIN CATEGORIES": "HOUSING", "CATEGORIES": "House Type"})
    shares = demographic_share(houses)
    rated = left_join_on(
        shares.select("Acorn", "REFERENCE", "Percentage"),
        property_efficiency.select("Housing Type", "Current Efficiency", "Potential Efficiency"),
        "REFERENCE",
        "Housing Type",
    )
    weighted = rated.groupBy("Acorn").agg(
        F.sum(F.col("Current Efficiency") * F.col("Percentage")).alias("Efficiency_Value"),
        F.sum(F.col("Potential Efficiency") * F.col("Percentage")).alias("Potential_Value"),
    )
    return weighted.withColumn("Difference_Value", F.col("Potential_Value") - F.col("Efficiency_Value"))
