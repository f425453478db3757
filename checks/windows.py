"""Spine, lookback, aggregation and time features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import spineloom as sl
from checks.fixtures import (
    EVENTS_RUN_DATE,
    MID_RUN_DATE,
    ORDERS_RUN_DATE,
    Part,
    check,
    events,
    events_gaps,
    events_holes,
    joined,
    orders,
    orders_gaps,
    shipments,
    tidy,
    with_views,
)

SINCE_7 = "event_date >= DATE '2024-01-31' - 7"
SINCE_30 = "event_date >= DATE '2024-01-31' - 30"
MID_SINCE_7 = "event_date >= DATE '2024-01-20' - 7"


def slope_sql(date: str, value: str, run_date: str, days: int) -> str:
    """n, sums and the quotient spelled out; rows without a value count in n, sum(x) and sum(x*x)."""
    x = f"date_diff('day', DATE '{run_date}' - {days}, {date})::DOUBLE"
    n, sx, sxx = "COUNT(*)", f"SUM({x})", f"SUM({x} * {x})"
    sy, sxy = f"SUM({value})", f"SUM({x} * {value})"
    return (
        f"CASE WHEN {n} * {sxx} - {sx} * {sx} <> 0"
        f" THEN ({n} * {sxy} - {sx} * {sy}) / ({n} * {sxx} - {sx} * {sx}) ELSE 0.0 END"
    )


def event_aggregates(df: DataFrame, specs: list[dict], run_date: str = EVENTS_RUN_DATE, **options) -> DataFrame:
    return tidy(sl.aggregate_features(df, specs, "user_id", "event_date", run_date, **options))


def agg(name: str, column: str, function: str, days: int | None = None) -> dict:
    return {"name": name, "source_column": column, "function": function, "window_days": days}


@check("entity_spine", with_views("SELECT DISTINCT user_id FROM evt_holes", "evt_holes"))
def entity_spine(spark, sf_dir):
    return sl.entity_spine(events_holes(spark, sf_dir), "user_id")


@check(
    "lookback_filter",
    "SELECT event_id, user_id, event_type, value FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20' - 7",
)
def lookback_filter(spark, sf_dir):
    recent = sl.lookback(events(spark, sf_dir), "ts", MID_RUN_DATE, 7)
    return recent.select("event_id", "user_id", "event_type", "value")


@check(
    "left_join_spine",
    with_views(
        joined("ord", "o_custkey", [Part("spend_30d", "SUM(o_totalprice)", "ord", "order_date >= DATE '2001-08-02' - 30")], 6),
        "ord",
    ),
)
def left_join_spine(spark, sf_dir):
    df = orders(spark, sf_dir)
    recent = sl.lookback(df, "order_date", ORDERS_RUN_DATE, 30)
    spend = recent.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spend_30d"))
    return tidy(sl.left_join_spine(sl.entity_spine(df, "o_custkey"), spend, "o_custkey"), 6)


# One check per function, over all rows and over a lookback window, on events with gaps, missing users and dates.
_SQL_FUNCTION = {
    "sum": ("SUM", True),
    "mean": ("AVG", True),
    "count": ("COUNT", False),
    "stddev": ("STDDEV_SAMP", True),
    "min": ("MIN", True),
    "max": ("MAX", True),
}


def _register_function(function: str) -> None:
    sql, double = _SQL_FUNCTION[function]

    @check(
        f"agg_{function}_alltime",
        with_views(
            joined("evt_holes", "user_id", [Part("feature", f"{sql}(value)", "evt_holes", double=double)]), "evt_holes"
        ),
    )
    def all_time(spark, sf_dir):
        return event_aggregates(events_holes(spark, sf_dir), [agg("feature", "value", function)], MID_RUN_DATE)

    @check(
        f"agg_{function}_window",
        with_views(
            joined("evt_holes", "user_id", [Part("feature", f"{sql}(value)", "evt_holes", MID_SINCE_7, double)]),
            "evt_holes",
        ),
    )
    def windowed(spark, sf_dir):
        return event_aggregates(events_holes(spark, sf_dir), [agg("feature", "value", function, 7)], MID_RUN_DATE)

    @check(
        f"agg_{function}_sparse",
        with_views(
            joined(
                "ord_gaps",
                "o_custkey",
                [Part("feature", f"{sql}(o_totalprice)", "ord_gaps", "order_date >= DATE '2001-08-02' - 30", double)],
                5,
            ),
            "ord_gaps",
        ),
    )
    def sparse(spark, sf_dir):
        spec = [agg("feature", "o_totalprice", function, 30)]
        df = orders_gaps(spark, sf_dir)
        return tidy(sl.aggregate_features(df, spec, "o_custkey", "order_date", ORDERS_RUN_DATE), 5)


for _function in _SQL_FUNCTION:
    _register_function(_function)


@check(
    "agg_multi_window",
    with_views(
        joined(
            "ship",
            "l_suppkey",
            [
                Part("lines", "COUNT(l_orderkey)", "ship", double=False),
                Part("quantity_90d", "SUM(l_quantity)", "ship", "ship_date >= DATE '2001-08-02' - 90"),
                Part("discount_mean_365d", "AVG(l_discount)", "ship", "ship_date >= DATE '2001-08-02' - 365"),
                Part("quantity_stddev", "STDDEV_SAMP(l_quantity)", "ship"),
                Part("price_max_30d", "MAX(l_extendedprice)", "ship", "ship_date >= DATE '2001-08-02' - 30"),
                Part("price_min_today", "MIN(l_extendedprice)", "ship", "ship_date >= DATE '2001-08-02' - 0"),
                Part("lines_90d", "COUNT(l_orderkey)", "ship", "ship_date >= DATE '2001-08-02' - 90", double=False),
            ],
        ),
        "ship",
    ),
)
def agg_multi_window(spark, sf_dir):
    specs = [
        agg("lines", "l_orderkey", "count"),
        agg("quantity_90d", "l_quantity", "sum", 90),
        agg("discount_mean_365d", "l_discount", "mean", 365),
        agg("quantity_stddev", "l_quantity", "stddev"),
        agg("price_max_30d", "l_extendedprice", "max", 30),
        agg("price_min_today", "l_extendedprice", "min", 0),
        agg("lines_90d", "l_orderkey", "count", 90),
    ]
    return tidy(sl.aggregate_features(shipments(spark, sf_dir), specs, "l_suppkey", "ship_date", ORDERS_RUN_DATE))


@check(
    "agg_text_column",
    with_views(
        joined(
            "evt_gaps",
            "user_id",
            [
                Part("first_type", "MIN(event_type)", "evt_gaps", double=False),
                Part("last_type_7d", "MAX(event_type)", "evt_gaps", SINCE_7, double=False),
                Part("types_7d", "COUNT(event_type)", "evt_gaps", SINCE_7, double=False),
                Part("type_mean", "AVG(TRY_CAST(event_type AS DOUBLE))", "evt_gaps"),
            ],
        ),
        "evt_gaps",
    ),
)
def agg_text_column(spark, sf_dir):
    specs = [
        agg("first_type", "event_type", "min"),
        agg("last_type_7d", "event_type", "max", 7),
        agg("types_7d", "event_type", "count", 7),
        agg("type_mean", "event_type", "mean"),
    ]
    return event_aggregates(events_gaps(spark, sf_dir), specs)


def times(df: DataFrame, specs: list[dict], run_date: str = EVENTS_RUN_DATE, **options) -> DataFrame:
    return tidy(sl.time_features(df, specs, "user_id", "event_date", run_date, **options))


def time(name: str, column: str, kind: str, days: int | None = None) -> dict:
    return {"name": name, "source_column": column, "feature_type": kind, "window_days": days}


@check(
    "tw_days_diff",
    with_views(
        "SELECT user_id, CASE WHEN user_id IS NOT NULL THEN"
        " CAST(date_diff('day', MAX(event_date), DATE '2024-01-20') AS INTEGER) END AS days_since_last"
        " FROM evt_holes GROUP BY user_id",
        "evt_holes",
    ),
)
def tw_days_diff(spark, sf_dir):
    return times(events_holes(spark, sf_dir), [time("days_since_last", "ignored", "days_diff")], MID_RUN_DATE)


@check(
    "tw_rolling_mean",
    with_views(joined("evt_holes", "user_id", [Part("mean_7d", "AVG(value)", "evt_holes", MID_SINCE_7)]), "evt_holes"),
)
def tw_rolling_mean(spark, sf_dir):
    return times(events_holes(spark, sf_dir), [time("mean_7d", "value", "rolling_mean")], MID_RUN_DATE)


@check(
    "tw_rolling_slope",
    with_views(
        joined(
            "evt", "user_id", [Part("slope_30d", slope_sql("event_date", "value", "2024-01-31", 30), "evt", SINCE_30)]
        ),
        "evt",
    ),
)
def tw_rolling_slope(spark, sf_dir):
    return times(events(spark, sf_dir), [time("slope_30d", "value", "rolling_slope")])


@check(
    "tw_rolling_slope_nulls",
    with_views(
        joined(
            "ord_gaps",
            "o_custkey",
            [
                Part(
                    "slope_90d",
                    slope_sql("order_date", "o_totalprice", "2001-08-02", 90),
                    "ord_gaps",
                    "order_date >= DATE '2001-08-02' - 90",
                )
            ],
            5,
        ),
        "ord_gaps",
    ),
)
def tw_rolling_slope_nulls(spark, sf_dir):
    spec = [time("slope_90d", "o_totalprice", "rolling_slope", 90)]
    return tidy(sl.time_features(orders_gaps(spark, sf_dir), spec, "o_custkey", "order_date", ORDERS_RUN_DATE), 5)


@check(
    "tw_future_rows",
    with_views(
        joined(
            "evt_gaps",
            "user_id",
            [
                Part("mean_7d", "AVG(value)", "evt_gaps", MID_SINCE_7),
                Part("slope_7d", slope_sql("event_date", "value", "2024-01-20", 7), "evt_gaps", MID_SINCE_7),
                Part(
                    "days_since_last",
                    "CAST(date_diff('day', MAX(event_date), DATE '2024-01-20') AS INTEGER)",
                    "evt_gaps",
                    double=False,
                ),
            ],
        ),
        "evt_gaps",
    ),
)
def tw_future_rows(spark, sf_dir):
    specs = [
        time("mean_7d", "value", "rolling_mean", 7),
        time("slope_7d", "value", "rolling_slope", 7),
        time("days_since_last", "event_date", "days_diff"),
    ]
    return times(events_gaps(spark, sf_dir), specs, MID_RUN_DATE)


@check(
    "tw_capped",
    with_views(
        joined(
            "evt_gaps",
            "user_id",
            [
                Part("mean_7d", "AVG(value)", "evt_gaps", f"{MID_SINCE_7} AND event_date <= DATE '2024-01-20'"),
                Part(
                    "slope_7d",
                    slope_sql("event_date", "value", "2024-01-20", 7),
                    "evt_gaps",
                    f"{MID_SINCE_7} AND event_date <= DATE '2024-01-20'",
                ),
            ],
        ),
        "evt_gaps",
    ),
)
def tw_capped(spark, sf_dir):
    specs = [time("mean_7d", "value", "rolling_mean", 7), time("slope_7d", "value", "rolling_slope", 7)]
    return times(events_gaps(spark, sf_dir), specs, MID_RUN_DATE, cap_at_run_date=True)


@check(
    "agg_text_date",
    joined(
        "events",
        "user_id",
        [
            Part("value_all", "SUM(value)", "events"),
            Part("value_7d", "SUM(value)", "dated", "d >= DATE '2024-01-31' - 7"),
        ],
    ).replace("FROM dated", "FROM (SELECT *, CASE WHEN event_type <> 'click' THEN CAST(ts AS DATE) END AS d FROM events)"),
)
def agg_text_date(spark, sf_dir):
    """Dates as text; those of clicks are malformed, so these rows count as undated."""
    text = F.date_format("ts", "yyyy-MM-dd")
    df = events(spark, sf_dir).withColumn("event_date", F.when(F.col("event_type") == "click", F.concat(F.lit("on "), text)).otherwise(text))
    specs = [agg("value_all", "value", "sum"), agg("value_7d", "value", "sum", 7)]
    return event_aggregates(df, specs)
