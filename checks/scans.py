"""Sources: Parquet, CSV, date partitions, lookback ranges and the row gate."""

from __future__ import annotations

from pyspark.sql import functions as F

import spineloom as sl
from checks.fixtures import check, events, shipments, table
from spineloom.durable import fresh_path

ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


def order_row(df):
    """All order columns; inferred CSV keys may come as INT and are widened to the type of the table."""
    keys = {name: F.col(name).cast("bigint") for name in ("o_orderkey", "o_custkey")}
    date = F.col("o_orderdate").cast("date").cast("string").alias("order_date")
    return df.withColumns(keys).select(*ORDER_COLUMNS.split(", "), date)


ORDER_SQL = f"SELECT {ORDER_COLUMNS}, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date FROM orders"


@check("scan_parquet", ORDER_SQL)
def scan_parquet(spark, sf_dir):
    return order_row(sl.read_raw(spark, f"{sf_dir}/orders.parquet"))


@check("scan_csv", ORDER_SQL)
def scan_csv(spark, sf_dir):
    path = fresh_path(spark, "csv")
    table(spark, sf_dir, "orders").write.option("header", True).csv(path)
    return order_row(sl.read_raw(spark, path, "csv"))


@check("scan_csv_schema", ORDER_SQL)
def scan_csv_schema(spark, sf_dir):
    """With a schema given, the inference pass over the files is spared."""
    path = fresh_path(spark, "csv")
    source = table(spark, sf_dir, "orders")
    source.write.option("header", True).csv(path)
    return order_row(sl.read_raw(spark, path, "csv", schema=source.schema))


def partitioned_events(spark, sf_dir: str, input_format: str = "parquet") -> str:
    path = fresh_path(spark, "events")
    df = events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "event_date")
    # Rebalancing gathers a date in few files but splits one that is too large for a task.
    daily = df.withColumnRenamed("event_date", "date").hint("rebalance", "date")
    daily.write.option("header", True).partitionBy("date").format(input_format).save(path)
    return path


def event_row(df):
    keys = {name: F.col(name).cast("bigint") for name in ("event_id", "user_id")}
    return df.withColumns(keys).select("event_id", "user_id", "event_type", "value", F.col("date").cast("string").alias("date"))


EVENT_SQL = """SELECT event_id, user_id, event_type, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS "date" FROM events"""


@check("scan_partition", f"{EVENT_SQL} WHERE CAST(ts AS DATE) = DATE '2024-01-20'")
def scan_partition(spark, sf_dir):
    return event_row(sl.read_raw(spark, partitioned_events(spark, sf_dir), run_date="2024-01-20"))


@check("scan_partition_csv", f"{EVENT_SQL} WHERE CAST(ts AS DATE) = DATE '2024-01-20'")
def scan_partition_csv(spark, sf_dir):
    return event_row(sl.read_raw(spark, partitioned_events(spark, sf_dir, "csv"), "csv", run_date="2024-01-20"))


@check("scan_all_partitions", EVENT_SQL)
def scan_all_partitions(spark, sf_dir):
    return event_row(sl.read_raw(spark, partitioned_events(spark, sf_dir)))


@check("scan_lookback", f"{EVENT_SQL} WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-20' - 7 AND DATE '2024-01-20'")
def scan_lookback(spark, sf_dir):
    path = partitioned_events(spark, sf_dir)
    return event_row(sl.read_raw(spark, path, run_date="2024-01-20", lookback_days=7))


@check("scan_lookback_csv", f"{EVENT_SQL} WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-20' - 7 AND DATE '2024-01-20'")
def scan_lookback_csv(spark, sf_dir):
    """Only the directories of the eight days are listed, and their files alone decide on the types."""
    path = partitioned_events(spark, sf_dir, "csv")
    return event_row(sl.read_raw(spark, path, "csv", run_date="2024-01-20", lookback_days=7))


@check(
    "ingest_row_gate",
    """SELECT l_orderkey, l_linenumber, l_quantity, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_date
    FROM lineitem""",
)
def ingest_row_gate(spark, sf_dir):
    gated = sl.require_rows(shipments(spark, sf_dir), 100)
    return gated.select("l_orderkey", "l_linenumber", "l_quantity", F.col("ship_date").cast("string"))


@check(
    "landing_gate",
    """SELECT event_id, user_id, event_type, value, CAST(ts AS DATE)::VARCHAR AS event_date, '2024-01-31' AS "date" FROM events
    UNION ALL SELECT event_id, user_id, event_type, value, CAST(ts AS DATE)::VARCHAR, '2024-01-30' FROM events WHERE value > 1""",
)
def landing_gate(spark, sf_dir):
    """Two days are landed, their checks taken while they are written; a third run, too full of gaps, is not published."""
    root = fresh_path(spark, "landed")
    df = events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "event_date")
    keys = ("user_id", "event_date")
    sl.land_day(df.where("value > 1"), root, "2024-01-30", *keys)
    sl.land_day(df, root, "2024-01-31", *keys, min_row_count=100)
    try:
        sl.land_day(df.withColumn("value", F.when(F.col("value") > 1000, F.col("value"))), root, "2024-01-31", *keys)
    except sl.DataQualityError:
        landed = sl.read_landed(spark, root, "2024-01-31", lookback_days=1)
        dates = {c: F.col(c).cast("string") for c in ("event_date", "date")}
        return landed.withColumns(dates).select("event_id", "user_id", "event_type", "value", "event_date", "date")
    raise AssertionError("a day full of gaps was published")
