"""Lags, rolling windows and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.catalog.column_queries import LONG_DETAILS_SQL
from wattloom.catalog.registry import Tables, query
from wattloom.catalog.stand_ins import details, event_days, r, rounded, sr, with_views
from wattloom.functions.values import to_numeric
from wattloom.operators import windows as win
from wattloom.operators.columns import unpivot
from wattloom.plans.demographics import DETAIL_KEYS
from wattloom.schemas import ACORN_CODES


def by_day(t: Tables, features: dict[str, win.Feature]) -> DataFrame:
    """Windows over a household's days: one row per day, so a series is bounded by the calendar."""
    series = event_days(t).select("LCLid", "day", "energy_sum")
    return rounded(win.window_features(series, ["LCLid"], ["day"], features), digits=4)


def by_event(t: Tables, features: dict[str, win.Feature], lookback: int) -> DataFrame:
    """Windows over a household's single events; long series are cut into hours."""
    rows = t.events.select("user_id", "ts", "event_id", "value")
    found = win.window_features(
        rows, ["user_id"], ["ts", "event_id"], features, chunk=F.date_trunc("hour", "ts"), lookback=lookback
    )
    return rounded(found, digits=4)


def day_sql(columns: str) -> str:
    return with_views(
        f"""SELECT "LCLid", day, {sr('energy_sum', 4)} AS energy_sum, {columns} FROM event_days
            WINDOW w AS (PARTITION BY "LCLid" ORDER BY day)""",
        "event_days",
    )


def over(fn: str, column: str, n: int, order: str = "day", part: str = '"LCLid"') -> str:
    return f"{fn}({column}) OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def over_events(fn: str, n: int) -> str:
    return over(fn, "value", n, "ts, event_id", "user_id")


@query(
    "w1_share_of_group",
    with_views(
        f"""SELECT *, {sr('sum("Value") OVER g', 4)} AS "Total",
                   {sr('"Value" / nullif(sum("Value") OVER g, 0)')} AS "Percentage"
            FROM long WINDOW g AS (PARTITION BY "MAIN CATEGORIES", "CATEGORIES", "Acorn")""",
        "details", long=LONG_DETAILS_SQL,
    ),
)
def w1(t: Tables) -> DataFrame:
    long = unpivot(details(t), DETAIL_KEYS, ACORN_CODES)
    shares = win.share_of_group(long, ["MAIN CATEGORIES", "CATEGORIES", "Acorn"], "Value")
    return rounded(rounded(shares, "Total", digits=4), "Percentage")


@query("w2_lag", day_sql(", ".join(f"{sr(f'lag(energy_sum, {k}) OVER w', 4)} AS lag_{k}" for k in (1, 2, 7))))
def w2(t: Tables) -> DataFrame:
    return by_day(t, {f"lag_{k}": win.lag_of("energy_sum", k) for k in (1, 2, 7)})


@query(
    "w2_lag_events",
    f"""SELECT user_id, ts, event_id, value,
               {sr('lag(value, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id)', 4)} AS lag_1,
               {sr('lag(value, 7) OVER (PARTITION BY user_id ORDER BY ts, event_id)', 4)} AS lag_7
        FROM events""",
)
def w2_events(t: Tables) -> DataFrame:
    return by_event(t, {"lag_1": win.lag_of("value", 1), "lag_7": win.lag_of("value", 7)}, 7)


@query(
    "w2_calendar_lag",
    with_views(
        f"""SELECT a."LCLid", a.day, {sr('a.energy_sum', 4)} AS energy_sum, {sr('b.energy_sum', 4)} AS week_ago
            FROM event_days a LEFT JOIN event_days b ON a."LCLid" = b."LCLid" AND a.day = b.day + INTERVAL 7 DAY""",
        "event_days",
    ),
)
def w2_calendar(t: Tables) -> DataFrame:
    series = event_days(t).select("LCLid", "day", r("energy_sum", 4).alias("energy_sum"))
    return win.calendar_lag(series, ["LCLid"], "day", "energy_sum", 7, "week_ago")


@query("w3_rolling_sum", day_sql(", ".join(f"{sr(over('sum', 'energy_sum', n), 4)} AS sum_{n}" for n in (3, 7, 14, 30))))
def w3(t: Tables) -> DataFrame:
    return by_day(t, {f"sum_{n}": win.rolling_sum("energy_sum", n) for n in (3, 7, 14, 30)})


@query(
    "w3_rolling_sum_events",
    "SELECT user_id, ts, event_id, value, "
    + ", ".join(f"{sr(over_events('sum', n), 4)} AS sum_{n}" for n in (3, 14))
    + " FROM events",
)
def w3_events(t: Tables) -> DataFrame:
    return by_event(t, {f"sum_{n}": win.rolling_sum("value", n) for n in (3, 14)}, 13)


@query(
    "w4_rolling_mean_std",
    day_sql(f"""{sr(over('avg', 'energy_sum', 14), 4)} AS mean_14, {sr(over('stddev_samp', 'energy_sum', 14), 4)} AS std_14"""),
)
def w4(t: Tables) -> DataFrame:
    return by_day(t, {"mean_14": win.rolling_mean("energy_sum", 14), "std_14": win.rolling_std("energy_sum", 14)})


@query(
    "w5_rolling_mean_full",
    day_sql(
        f"""CASE WHEN {over('count', 'energy_sum', 14)} = 14 THEN {sr(over('avg', 'energy_sum', 14), 4)} END AS smooth"""
    ),
)
def w5(t: Tables) -> DataFrame:
    return by_day(t, {"smooth": win.rolling_mean_full("energy_sum", 14)})


@query(
    "w6_trend_and_change",
    day_sql(
        f"""{sr(over('sum', 'energy_sum', 3) + ' - lag(energy_sum, 1) OVER w', 4)} AS trend_3,
            {sr('(lag(energy_sum, 1) OVER w - energy_sum) / (lag(energy_sum, 1) OVER w + 1)', 4)} AS change"""
    ),
)
def w6(t: Tables) -> DataFrame:
    series = event_days(t).select("LCLid", "day", "energy_sum")
    found = win.window_features(
        series, ["LCLid"], ["day"], {"lag_1": win.lag_of("energy_sum", 1), "sum_3": win.rolling_sum("energy_sum", 3)}
    )
    return rounded(
        found.select(
            "LCLid", "day", "energy_sum", win.trend("sum_3", "lag_1").alias("trend_3"),
            win.relative_change("lag_1", "energy_sum").alias("change"),
        ),
        digits=4,
    )


@query(
    "w7_rolling_precip_7d",
    f"""SELECT user_id, ts, event_id, {sr(f"coalesce({over('sum', 'rain', 7, 'ts, event_id', 'user_id')}, 0)", 4)} AS rain_7
        FROM (SELECT *, CASE WHEN event_id % 4 <> 0 THEN value END AS rain FROM events)""",
)
def w7(t: Tables) -> DataFrame:
    text = F.when(F.col("event_id") % 4 == 0, "rain").otherwise(F.col("value").cast("string"))
    rows = t.events.select("user_id", "ts", "event_id", to_numeric(text).alias("rain"))
    found = win.window_features(
        rows, ["user_id"], ["ts", "event_id"], {"rain_7": win.rolling_sum("rain", 7)},
        chunk=F.to_date("ts"), lookback=6,
    )
    return found.select("user_id", "ts", "event_id", r(F.coalesce("rain_7", F.lit(0.0)), 4).alias("rain_7"))
