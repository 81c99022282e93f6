"""Half-hourly readings against tariffs and household groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom import lookups
from wattloom.functions.dates import day_name, month_period, time_of_day, to_day
from wattloom.functions.values import map_values, map_values_2level, ratio
from wattloom.operators.aggregates import group_mean, hourly_actual_vs_potential
from wattloom.operators.columns import quoted, wide_ratio
from wattloom.operators.filters import drop_null, time_range
from wattloom.operators.joins import (
    inner_join,
    join_instants,
    keep_matching,
    left_from_dense,
    left_join,
    star_join,
    unique_lookup,
)
from wattloom.operators.ordering import order_by_list, order_by_time
from wattloom.operators.pivots import pivot_mean, pivot_mode, pivot_unique, size_unstack
from wattloom.operators.profiling import quartiles
from wattloom.shared import materialize

ENRICHED = [
    "Acorn",
    "LCLid",
    "tstp",
    "energy",
    "stdorToU",
    "Acorn_grouped",
    "Acorn Category",
    "Tariff",
    "Efficiency_Value",
    "Potential_Value",
    "Difference_Value",
]


def enrich_halfhourly(
    readings: DataFrame,
    households: DataFrame,
    acorn_information: DataFrame,
    tariff: DataFrame,
    efficiency: DataFrame,
) -> DataFrame:
    """Readings with tariff, household, demographic category and efficiency.

    The tariff join comes first: it is the one that drops rows.
    """
    priced = join_instants(drop_null(readings, "energy"), tariff, "tstp", "TariffDateTime")
    joined = star_join(
        priced,
        [
            (households.drop("file"), "LCLid"),
            (acorn_information.select("Acorn", "Acorn Category"), "Acorn"),
            (efficiency, "Acorn"),
        ],
    )
    return joined.select(*[quoted(c) for c in ENRICHED])


def household_readings(
    readings: DataFrame, households: DataFrame, acorn_information: DataFrame, tariff: DataFrame
) -> DataFrame:
    """Readings whose instant has a tariff, with household and category."""
    priced = keep_matching(drop_null(readings, "energy"), tariff, "tstp", "TariffDateTime")
    return star_join(
        priced, [(households.drop("file"), "LCLid"), (acorn_information.select("Acorn", "Acorn Category"), "Acorn")]
    )


def tariff_slot_usage(
    readings: DataFrame, households: DataFrame, acorn_information: DataFrame, tariff: DataFrame
) -> DataFrame:
    """Mean use per slot and household, shown along every tariff slot."""
    priced = keep_matching(drop_null(readings, "energy"), tariff, "tstp", "TariffDateTime")
    means = group_mean(priced, ["tstp", "LCLid"], "energy", "mean_energy")
    # The group columns depend on the household alone, so they are joined to the means, not the readings.
    described = star_join(
        means,
        [
            (households.select("LCLid", "Acorn", "Acorn_grouped", "stdorToU").distinct(), "LCLid"),
            (acorn_information.select("Acorn", "Acorn Category").distinct(), "Acorn"),
        ],
    ).select("tstp", "LCLid", "Acorn", "Acorn_grouped", "`Acorn Category`", "stdorToU", "mean_energy")
    return left_from_dense(tariff, described, "TariffDateTime", "tstp")


def tariff_slot_pivot(
    readings: DataFrame,
    households: DataFrame,
    acorn_information: DataFrame,
    tariff: DataFrame,
    group: str,
    values: Sequence[str],
) -> DataFrame:
    """Mean use per tariff slot, one column per value of a household group."""
    rows = household_readings(readings, households, acorn_information, tariff)
    wide = pivot_mean(rows, "tstp", group, "energy", values)
    dense = left_from_dense(tariff, wide, "TariffDateTime", "tstp").drop("tstp")
    return dense.withColumnRenamed("TariffDateTime", "Datetime")


def daily_with_households(
    daily: DataFrame, households: DataFrame, acorn_information: DataFrame, categories: DataFrame
) -> DataFrame:
    """Daily use joined to household, demographic and category tables."""
    groups = left_join(acorn_information, categories, "Acorn Category")
    return left_join(left_join(daily, households, "LCLid"), groups, "Acorn")


PROFILE_GROUPS: Mapping[str, Mapping[str, str] | None] = {
    "acorn": None,
    "lifestyle": lookups.LIFESTYLES,
    "housing": lookups.HOUSING_TYPES,
    "tenure": lookups.TENURES,
    "income": lookups.INCOMES,
}


def time_of_day_profile(
    readings: DataFrame, households: DataFrame, start: str, end: str, grouping: str = "acorn"
) -> DataFrame:
    """Mean use per time of day and household group: time_of_day, group, energy."""
    return time_of_day_profiles(readings, households, start, end, [grouping]).drop("grouping")


def time_of_day_profiles(
    readings: DataFrame,
    households: DataFrame,
    start: str,
    end: str,
    groupings: Sequence[str] = (*PROFILE_GROUPS, "income_band"),
) -> DataFrame:
    """The profiles of several groupings in one pass: grouping, time_of_day, group, energy.

    Readings are summed per household and time of day before the household join, then per demographic
    code; every grouping is a roll-up of that small table. Codes without an entry in a grouping are left
    out of it.
    """
    period = time_range(readings, "tstp", start, end)
    sums = period.groupBy("LCLid", time_of_day("tstp").alias("time_of_day")).agg(
        F.sum("energy").alias("_sum"), F.count("energy").alias("_count")
    )
    base = (
        inner_join(sums, households.select("LCLid", "Acorn"), "LCLid")
        .groupBy("time_of_day", "Acorn")
        .agg(F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"))
    )
    labels = [F.struct(F.lit(g).alias("grouping"), _group_label(g).alias("group")) for g in groupings]
    spread = base.select("time_of_day", "_sum", "_count", F.inline(F.array(*labels)))
    return (
        spread.where(F.col("group").isNotNull())
        .groupBy("grouping", "time_of_day", "group")
        .agg(ratio(F.sum("_sum"), F.sum("_count")).alias("energy"))
    )


def _group_label(grouping: str):
    if grouping == "income_band":
        return map_values_2level("Acorn", lookups.INCOMES, lookups.INCOME_BANDS)
    table = PROFILE_GROUPS[grouping]
    return F.col("Acorn") if table is None else map_values("Acorn", table)


def potential_use(
    wide: DataFrame, efficiency: DataFrame, property_types: DataFrame, order: str, groups: Sequence[str]
) -> DataFrame:
    """Add each group's potential use beside its actual use on a wide slot table.

    A group with several housing types takes the current figure of the first and the potential figure
    of the last, by ``order`` (a column of ``property_types``).
    """
    rated = inner_join(property_types, efficiency, "Housing Type").select(
        "Acorn", F.col(order).alias("_order"), "Current Efficiency", "Potential Efficiency"
    )
    current = unique_lookup(rated, "Acorn", "_order", "first").select("Acorn", "Current Efficiency")
    potential = unique_lookup(rated, "Acorn", "_order", "last").select("Acorn", "Potential Efficiency")
    factors = inner_join(current, potential, "Acorn")
    return wide_ratio(
        wide, factors, ["Datetime"], groups, "Acorn", "Current Efficiency", "Potential Efficiency"
    )


def actual_vs_potential(with_potential: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Hourly actual, potential and difference per group, with the quartiles of the actual use.

    Means, potentials and groups come from one pass over the wide table, the quartiles from others, so this
    job writes the wide table once.
    """
    with_potential = materialize(with_potential, "with-potential")
    pairs = F.array(
        *[
            F.struct(
                F.lit(g).alias("group"),
                F.col(quoted(g)).alias("_actual"),
                F.col(quoted(g + "_Potential")).alias("_potential"),
            )
            for g in groups
        ]
    )
    long = with_potential.select("Datetime", F.inline(pairs))
    hourly = hourly_actual_vs_potential(long, "group", "Datetime", "_actual", "_potential")
    long_quartiles = quartiles(with_potential, groups)
    return hourly.join(long_quartiles.withColumnRenamed("variable", "group"), "group", "left")


def tariff_calendar(tariff: DataFrame) -> DataFrame:
    """Tariff slots with date, time of day, weekday, month and tariff rank."""
    return tariff.withColumns(
        {
            "Date": to_day("TariffDateTime"),
            "Time": time_of_day("TariffDateTime"),
            "DayOfWeek": day_name("TariffDateTime"),
            "Month": month_period("TariffDateTime"),
            "TariffNumeric": map_values("Tariff", lookups.TARIFF_RANK),
        }
    )


def half_hours() -> list[str]:
    """The 48 half-hour labels of a day."""
    return [f"{h:02d}:{m:02d}" for h in range(24) for m in (0, 30)]


def daily_tariff_grid(tariff: DataFrame, times: Sequence[str] | None = None) -> DataFrame:
    """Date by time of day; two tariffs for one slot are an error."""
    return pivot_unique(tariff_calendar(tariff), "Date", "Time", "TariffNumeric", times or half_hours())


def weekly_tariff_mode(tariff: DataFrame, times: Sequence[str] | None = None) -> DataFrame:
    """Weekday by time of day, the most frequent tariff; all seven days in order."""
    grid = pivot_mode(tariff_calendar(tariff), "DayOfWeek", "Time", "TariffNumeric", times or half_hours())
    return order_by_list(grid, "DayOfWeek", lookups.WEEKDAYS)


def tariff_frequency(tariff: DataFrame, by: str) -> DataFrame:
    """Slots per tariff by ``Time``, ``DayOfWeek`` or ``Month``, in calendar order."""
    counts = size_unstack(tariff_calendar(tariff), by, "Tariff", list(lookups.TARIFF_RANK))
    if by == "DayOfWeek":
        return order_by_list(counts, by, lookups.WEEKDAYS)
    return order_by_time(counts, by)
