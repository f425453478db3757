"""Null handling and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

import spineloom as sl
from checks.fixtures import (
    EVENTS_RUN_DATE,
    Part,
    check,
    events,
    events_gaps,
    events_holes,
    joined,
    orders_gaps,
    table,
    with_views,
)

EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value")
MEDIAN = "(SELECT quantile_disc(value, 0.5) FROM evt_gaps)"


def rule(column: str, strategy: str, fill_value=None, add_indicator: bool = False) -> dict:
    return {"column": column, "strategy": strategy, "fill_value": fill_value, "add_indicator": add_indicator}


def cleaned(df, *rules, exact_median=True):
    parsed = sl.definition({"entity_type": "event", "null_handlers": rules}).null_handlers
    return sl.handle_nulls(df, parsed, exact_median)


@check(
    "null_fill_string",
    with_views("SELECT event_id, COALESCE(event_type, 'unknown') AS event_type FROM evt_gaps", "evt_gaps"),
)
def null_fill_string(spark, sf_dir):
    df = cleaned(events_gaps(spark, sf_dir), rule("event_type", "fill", "unknown"))
    return df.select("event_id", "event_type")


@check(
    "null_fill_numeric",
    with_views("SELECT o_orderkey, COALESCE(o_totalprice, 0) AS o_totalprice FROM ord_gaps", "ord_gaps"),
)
def null_fill_numeric(spark, sf_dir):
    return cleaned(orders_gaps(spark, sf_dir), rule("o_totalprice", "fill", 0)).select("o_orderkey", "o_totalprice")


@check(
    "null_median_impute",
    with_views(f"SELECT event_id, COALESCE(value, {MEDIAN}) AS value FROM evt_gaps", "evt_gaps"),
)
def null_median_impute(spark, sf_dir):
    return cleaned(events_gaps(spark, sf_dir), rule("value", "median_impute")).select("event_id", "value")


@check(
    "null_median_approx",
    with_views(
        "SELECT COUNT(*) AS imputed, 1 AS distinct_values, TRUE AS within_tolerance FROM evt_gaps WHERE value IS NULL",
        "evt_gaps",
    ),
)
def null_median_approx(spark, sf_dir):
    """One imputed value, and at most 51% of the values lie below it and at least 49% at or below it."""
    gaps = events_gaps(spark, sf_dir)
    imputed = cleaned(gaps, rule("value", "median_impute", add_indicator=True), exact_median=False)
    filled = imputed.where("value_was_null = 1").agg(
        F.count(F.lit(1)).alias("imputed"), F.min("value").alias("least"), F.max("value").alias("most")
    )
    median = filled.select("least").scalar()
    ranks = gaps.agg(
        F.count("value").alias("n"),
        F.count_if(F.col("value") < median).alias("below"),
        F.count_if(F.col("value") <= median).alias("reached"),
    )
    inside = ranks.select((F.col("below") <= 0.51 * F.col("n")) & (F.col("reached") >= 0.49 * F.col("n"))).scalar()
    return filled.select(
        "imputed",
        F.when(F.col("least") == F.col("most"), 1).otherwise(2).alias("distinct_values"),
        inside.alias("within_tolerance"),
    )


# Light lines have no weight yet, dear ones no price.
SHIP_GAPS = """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount < 0.09 THEN l_extendedprice END AS price,
    CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity FROM lineitem"""


@check(
    "null_median_exact_large",
    with_views(
        """SELECT l_orderkey, l_linenumber, COALESCE(price, (SELECT quantile_disc(price, 0.5) FROM gaps)) AS price,
            COALESCE(quantity, (SELECT quantile_disc(quantity, 0.5) FROM gaps)) AS quantity FROM gaps""",
        gaps=SHIP_GAPS,
    ),
)
def null_median_exact_large(spark, sf_dir):
    """Medians of two columns over all order lines, one of them with almost as many values as rows."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_discount") < 0.09, F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("quantity"),
    )
    return cleaned(lines, rule("price", "median_impute"), rule("quantity", "median_impute"))


@check(
    "null_drop",
    with_views("SELECT event_id, user_id, event_type, value FROM evt_gaps WHERE value IS NOT NULL", "evt_gaps"),
)
def null_drop(spark, sf_dir):
    return cleaned(events_gaps(spark, sf_dir), rule("value", "drop")).select(*EVENT_COLUMNS)


@check(
    "null_indicator",
    with_views(
        "SELECT event_id, COALESCE(value, 0) AS value, CAST(value IS NULL AS INTEGER) AS value_was_null FROM evt_gaps",
        "evt_gaps",
    ),
)
def null_indicator(spark, sf_dir):
    df = cleaned(events_gaps(spark, sf_dir), rule("value", "fill", 0.0, add_indicator=True))
    return df.select("event_id", "value", "value_was_null")


@check(
    "null_chain",
    with_views(
        """SELECT event_id, user_id, COALESCE(event_type, 'none') AS event_type,
            COALESCE(value, (SELECT quantile_disc(value, 0.5) FROM evt_holes WHERE user_id IS NOT NULL)) AS value,
            CAST(value IS NULL AS INTEGER) AS value_was_null
        FROM evt_holes WHERE user_id IS NOT NULL""",
        "evt_holes",
    ),
)
def null_chain(spark, sf_dir):
    """The drop comes first, so the median is that of the rows left."""
    df = cleaned(
        events_holes(spark, sf_dir),
        rule("user_id", "drop"),
        rule("value", "median_impute", add_indicator=True),
        rule("event_type", "fill", "none"),
    )
    return df.select(*EVENT_COLUMNS, "value_was_null")


@check(
    "skip_missing_column",
    with_views(
        joined("evt_gaps", "user_id", [Part("n", "COUNT(value)", "evt_gaps", double=False)]), "evt_gaps"
    ),
)
def skip_missing_column(spark, sf_dir):
    """Null rules, encodings and rolling features over absent columns leave no trace."""
    spec = {
        "entity_type": "user",
        "null_handlers": [rule("nowhere", "fill", 0)],
        "aggregations": [{"name": "n", "source_column": "value", "function": "count"}],
        "encodings": [{"name": "share", "source_column": "nowhere", "method": "frequency"}],
        "time_windows": [{"name": "mean", "source_column": "nowhere", "feature_type": "rolling_mean"}],
    }
    return sl.assemble_features(events_gaps(spark, sf_dir), [spec], "user_id", "event_date", EVENTS_RUN_DATE)


def _rates_sql(view: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS null_count, COUNT(*) AS row_count,"
        f" ROUND((COUNT(*) - COUNT({c})) / COUNT(*), 8) AS null_rate FROM {view}"
        for c in columns
    )


HOLES = ("event_id", "ts", "user_id", "event_type", "value", "props", "event_date")


@check("dq_null_rates", with_views(_rates_sql("evt_holes", HOLES), "evt_holes"))
def dq_null_rates(spark, sf_dir):
    rates = sl.null_rates(events_holes(spark, sf_dir))
    return rates.withColumn("null_rate", F.round("null_rate", 8))


@check(
    "dq_null_report",
    with_views(
        """SELECT "column", 'null_rate' AS "check", null_rate <= 0.05 AS passed, CASE WHEN null_rate <= 0.05 THEN ''
            ELSE printf('Column ''%s'' null rate %.2f%% exceeds threshold 5.00%%', "column", null_rate * 100) END AS detail
        FROM rates""",
        "evt_holes",
        rates=_rates_sql("evt_holes", HOLES),
    ),
)
def dq_null_report(spark, sf_dir):
    return sl.null_report(events_holes(spark, sf_dir), 0.05)


@check(
    "dq_null_rates_files",
    """SELECT "column", CAST(nulls AS BIGINT) AS null_count, n AS row_count, nulls / n AS null_rate FROM (
        SELECT COUNT(*) AS n, COUNT(*) - COUNT(doc_id) AS doc_id, COUNT(*) - COUNT(text) AS text,
            COUNT(*) - COUNT(lang) AS lang, COUNT(*) - COUNT(source) AS source, COUNT(*) - COUNT(n_chars) AS n_chars
        FROM documents) UNPIVOT (nulls FOR "column" IN (doc_id, text, lang, source, n_chars))""",
)
def dq_null_rates_files(spark, sf_dir):
    """Null rates of whole files from their footers."""
    return sl.file_null_rates(spark, f"{sf_dir}/documents.parquet")


@check(
    "dq_null_rates_empty",
    """SELECT '*' AS "column", 'null_rate' AS "check", FALSE AS passed,
        'DataFrame is empty; cannot compute null rates.' AS detail
    FROM (SELECT COUNT(*) AS n FROM events WHERE ts >= DATE '2024-03-01' - 7) WHERE n = 0""",
)
def dq_null_rates_empty(spark, sf_dir):
    """The lookback of a run a month after the last event holds no row."""
    return sl.null_report(sl.lookback(events(spark, sf_dir), "ts", "2024-03-01", 7))


@check(
    "dq_schema_report",
    """SELECT * FROM (VALUES
        ('user_id', 'presence', TRUE, ''),
        ('ts', 'presence', TRUE, ''),
        ('plan', 'presence', FALSE, 'Column ''plan'' missing from schema'),
        ('user_id', 'type', TRUE, ''),
        ('value', 'type', TRUE, ''),
        ('ts', 'type', TRUE, ''),
        ('event_type', 'type', FALSE, 'Column ''event_type'': expected double, got StringType'),
        ('event_id', 'type', FALSE, 'Column ''event_id'': expected string, got LongType'),
        ('*', 'row_count', TRUE, (SELECT CAST(COUNT(*) AS VARCHAR) FROM events))
    ) AS t("column", "check", passed, detail)""",
)
def dq_schema_report(spark, sf_dir):
    """The schema part, with the row count of the table as one more line."""
    df = events(spark, sf_dir)
    expected = {
        "user_id": "integer",
        "value": "double",
        "ts": "timestamp",
        "event_type": "double",
        "event_id": "string",
        "absent": "string",
    }
    counted = df.agg(F.count(F.lit(1)).cast("string").alias("detail")).select(
        F.lit("*").alias("column"), F.lit("row_count").alias("check"), F.lit(True).alias("passed"), "detail"
    )
    return sl.schema_report(df, ["user_id", "ts", "plan"], expected).unionByName(counted)


@check(
    "dq_gate",
    """SELECT 'user_id' AS "column", 'presence' AS "check", TRUE AS passed, '' AS detail
    UNION ALL SELECT 'ts', 'presence', TRUE, '' UNION ALL SELECT 'event_type', 'presence', TRUE, ''
    UNION ALL SELECT 'value', 'type', TRUE, ''
    UNION ALL SELECT "column", 'null_rate', nulls / n <= 0.05, '' FROM (
        SELECT COUNT(*) AS n, COUNT(*) - COUNT(event_id) AS event_id, COUNT(*) - COUNT(ts) AS ts,
            COUNT(*) - COUNT(user_id) AS user_id, COUNT(*) - COUNT(event_type) AS event_type,
            COUNT(*) - COUNT(value) AS value, COUNT(*) - COUNT(props) AS props,
            COUNT(*) - COUNT(CAST(ts AS DATE)) AS event_date FROM events
    ) UNPIVOT (nulls FOR "column" IN (event_id, ts, user_id, event_type, value, props, event_date))""",
)
def dq_gate(spark, sf_dir):
    return sl.quality_gate(
        events(spark, sf_dir), "user_id", "ts", 0.05, required=["event_type"], expected_types={"value": "double"}
    )


@check(
    "dq_summary",
    with_views(
        """SELECT 2 + COUNT(*) FILTER (WHERE null_rate <= 0.05) AS passed, 2 + COUNT(*) AS checks,
            concat(2 + COUNT(*) FILTER (WHERE null_rate <= 0.05), '/', 2 + COUNT(*), ' checks passed') AS summary
        FROM rates""",
        "evt_holes",
        rates=_rates_sql("evt_holes", HOLES),
    ),
)
def dq_summary(spark, sf_dir):
    report = sl.quality_report(events_holes(spark, sf_dir), "user_id", "event_date", 0.05)
    return sl.summarize(report).select("passed", "checks", "summary")
