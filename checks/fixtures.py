"""Views of the given tables, once as DataFrames and once as SQL.

The tables hold no NULLs, so the ``*_gaps`` views blank values by a condition on other columns of the same row. No view
leaves out a row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

EVENTS_RUN_DATE = "2024-01-31"
MID_RUN_DATE = "2024-01-20"  # inside the data: later events exist
ORDERS_RUN_DATE = "2001-08-02"


@dataclass(frozen=True)
class Check:
    query: Query
    sql: str


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"query {name!r} registered twice")
        CHECKS[name] = Check(query, sql)
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("event_date", F.col("ts").cast("date"))


def events_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumns(
        {
            "value": F.when(~F.col("props").endswith("7}"), F.col("value")),
            "event_type": F.when(~F.col("props").endswith("4}"), F.col("event_type")),
        }
    )


def events_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps, and events without a user or without a date as well."""
    return events_gaps(spark, sf_dir).withColumns(
        {
            "user_id": F.when(F.col("props") != '{"k": 5}', F.col("user_id")),
            "event_date": F.when(F.col("props") != '{"k": 6}', F.col("event_date")),
        }
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("order_date", F.col("o_orderdate").cast("date"))


def orders_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders have no price yet; an unspecified priority is missing."""
    return orders(spark, sf_dir).withColumns(
        {
            "o_totalprice": F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")),
            "o_orderpriority": F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")),
        }
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("ship_date", F.col("l_shipdate").cast("date"))


SQL_VIEWS = {
    "evt": "SELECT *, CAST(ts AS DATE) AS event_date FROM events",
    "evt_gaps": """SELECT event_id, ts, user_id, props, CAST(ts AS DATE) AS event_date,
        CASE WHEN props LIKE '%7}' THEN NULL ELSE value END AS value,
        CASE WHEN props LIKE '%4}' THEN NULL ELSE event_type END AS event_type FROM events""",
    "evt_holes": """SELECT event_id, ts, props,
        CASE WHEN props = '{"k": 5}' THEN NULL ELSE user_id END AS user_id,
        CASE WHEN props = '{"k": 6}' THEN NULL ELSE CAST(ts AS DATE) END AS event_date,
        CASE WHEN props LIKE '%7}' THEN NULL ELSE value END AS value,
        CASE WHEN props LIKE '%4}' THEN NULL ELSE event_type END AS event_type FROM events""",
    "ord": "SELECT *, CAST(o_orderdate AS DATE) AS order_date FROM orders",
    "ord_gaps": """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice,
        NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders""",
    "ship": "SELECT *, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem",
}


def with_views(sql: str, *names: str, **extra: str) -> str:
    """Prefix a statement with the named views, and further ones given as keyword arguments, in that order."""
    parts = [f"{n} AS ({SQL_VIEWS[n]})" for n in names] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH {', '.join(parts)} {sql}"


@dataclass(frozen=True)
class Part:
    """One feature the long way round: its own filter, its own group-by, its own left join."""

    name: str
    value: str
    source: str
    where: str = "TRUE"
    double: bool = True


def joined(spine: str, key: str, parts: Sequence[Part], digits: int = 8, extra: str = "") -> str:
    """Left-join one subquery per feature onto the distinct keys of ``spine``."""
    columns = ", ".join(
        f"ROUND(p{i}.{p.name}, {digits}) + 0.0 AS {p.name}" if p.double else f"p{i}.{p.name}"
        for i, p in enumerate(parts)
    )
    joins = " ".join(
        f"LEFT JOIN (SELECT {key}, {p.value} AS {p.name} FROM {p.source} WHERE {p.where} GROUP BY {key}) p{i}"
        f" ON s.{key} = p{i}.{key}"
        for i, p in enumerate(parts)
    )
    return f"SELECT s.{key}, {columns}{extra} FROM (SELECT DISTINCT {key} FROM {spine}) s {joins}"


def tidy(df: DataFrame, digits: int = 8) -> DataFrame:
    """Round every DOUBLE column so that the order of a sum does not show; + 0.0 turns -0.0 into 0.0."""
    return df.select(
        *[
            (F.round(name, digits) + F.lit(0.0)).alias(name) if dtype == "double" else F.col(name)
            for name, dtype in df.dtypes
        ]
    )
