"""Data quality as report tables: one row per check with columns (column, check, passed, detail)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spineloom.functions.columns import ref

REPORT = T.StructType(
    [
        T.StructField("column", T.StringType(), False),
        T.StructField("check", T.StringType(), False),
        T.StructField("passed", T.BooleanType(), False),
        T.StructField("detail", T.StringType(), False),
    ]
)

# Type names a caller may expect, and the column types that satisfy each.
TYPE_NAMES: dict[str, tuple[type[T.DataType], ...]] = {
    "string": (T.StringType,),
    "integer": (T.IntegerType, T.LongType, T.ShortType, T.ByteType),
    "long": (T.LongType,),
    "double": (T.DoubleType, T.FloatType),
    "float": (T.FloatType, T.DoubleType),
    "date": (T.DateType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
    "boolean": (T.BooleanType,),
}

# The wording of report details and of the gate's error.
MISSING = "Column '{}' missing from schema"
WRONG_TYPE = "Column '{}': expected {}, got {}"
TOO_MANY_NULLS = "Column '%s' null rate %.2f%% exceeds threshold %.2f%%"
EMPTY = "DataFrame is empty; cannot compute null rates."
PASSED = "%d/%d checks passed"
GATE_FAILED = "Data quality gate FAILED for pipeline '{}':\n  {}"


class DataQualityError(Exception):
    """At least one quality check failed; the message lists every failure."""


def _has_type(dtype: T.DataType, expected: str) -> bool:
    accepted = TYPE_NAMES.get(expected.lower())
    if accepted:
        return isinstance(dtype, accepted)
    return type(dtype).__name__.startswith(expected)


def schema_report(
    df: DataFrame, required: Sequence[str], expected_types: Mapping[str, str] | None = None
) -> DataFrame:
    """Presence of the required columns, and the type of each expected column that exists. Reads metadata only."""
    types = {f.name: f.dataType for f in df.schema.fields}
    checks = [
        (name, "presence", name in types, "" if name in types else MISSING.format(name))
        for name in required
    ]
    for name, expected in (expected_types or {}).items():
        if name in types:
            ok = _has_type(types[name], expected)
            detail = "" if ok else WRONG_TYPE.format(name, expected, type(types[name]).__name__)
            checks.append((name, "type", ok, detail))
    return df.sparkSession.createDataFrame(checks, REPORT)


def _null_counts(df: DataFrame, columns: Sequence[str] | None, empty: Sequence[str] | None) -> DataFrame:
    """(column, null_count, row_count) from a single aggregate; ``empty`` names the rows an empty table gives.

    Nulls are ``count(*) - count(column)``: two counts that a source with aggregate push-down can answer from file
    footers.
    """
    names = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"), *[F.count(ref(name)).alias(f"c{i}") for i, name in enumerate(names)]
    )

    def rows(labels: Sequence[str]) -> Column:
        return F.array(
            *[
                F.struct(F.lit(label).alias("column"), (F.col("row_count") - F.col(f"c{i}")).alias("null_count"))
                for i, label in enumerate(labels)
            ]
        )

    found = rows(names) if empty is None else F.when(F.col("row_count") == 0, rows(empty)).otherwise(rows(names))
    return counts.select("row_count", F.inline(found)).select("column", "null_count", "row_count")


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count, row_count, null_rate) of every column, or of the named ones.

    The rate of an empty table is NULL.
    """
    return _null_counts(df, columns, None).withColumn("null_rate", F.try_divide("null_count", "row_count"))


def file_null_rates(spark: SparkSession, path: str) -> DataFrame:
    """``null_rates`` of a Parquet table from the statistics in its footers: no data page is read.

    Aggregates are pushed down only into scans of the second generation, which a session of its own switches on; the result
    belongs to it. Columns of arrays, maps and structs have no such statistics and are counted by reading them.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = session.read.parquet(path)
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    plain = [c for c in df.columns if c not in nested]
    found = [null_rates(df, names) for names in (plain, nested) if names]
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def null_report(df: DataFrame, max_null_rate: float = 0.05, columns: Sequence[str] | None = None) -> DataFrame:
    """Null-rate check of every column; an empty table gives a single failed row for column ``*``."""
    limit = F.lit(float(max_null_rate))
    rates = _null_counts(df, columns, empty=["*"]).withColumn("rate", F.try_divide("null_count", "row_count"))
    passed = F.coalesce(F.col("rate") <= limit, F.lit(False))
    message = F.format_string(TOO_MANY_NULLS, F.col("column"), F.col("rate") * 100, limit * 100)
    return rates.select(
        "column",
        F.lit("null_rate").alias("check"),
        passed.alias("passed"),
        F.when(F.col("row_count") == 0, EMPTY)
        .when(passed, "")
        .otherwise(message)
        .alias("detail"),
    )


def quality_report(
    df: DataFrame,
    entity_key: str,
    date_column: str,
    max_null_rate: float = 0.05,
    required: Sequence[str] = (),
    expected_types: Mapping[str, str] | None = None,
) -> DataFrame:
    """All checks of the gate: key, date and required columns present, types as expected, null rates in bounds."""
    names = list(dict.fromkeys([entity_key, date_column, *required]))
    return schema_report(df, names, expected_types).unionByName(null_report(df, max_null_rate))


def failures(report: DataFrame) -> DataFrame:
    return report.where(~F.col("passed"))


def summarize(report: DataFrame) -> DataFrame:
    """One row: checks passed, checks made, the sentence 'k/n checks passed', and the details of the failures.

    A report has a few rows per column of a table, so the list of failures is short.
    """
    return report.agg(
        F.count_if("passed").alias("passed"),
        F.count(F.lit(1)).alias("checks"),
        F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("detail")))).alias("failures"),
    ).withColumn("summary", F.format_string(PASSED, F.col("passed"), F.col("checks")))


def quality_gate(
    df: DataFrame,
    entity_key: str,
    date_column: str,
    max_null_rate: float = 0.05,
    required: Sequence[str] = (),
    expected_types: Mapping[str, str] | None = None,
    pipeline_name: str = "",
) -> DataFrame:
    """Run the checks once; raise ``DataQualityError`` if any failed, else return the report.

    What reaches the driver is the report, a few rows per column of the table.
    """
    report = quality_report(df, entity_key, date_column, max_null_rate, required, expected_types)
    rows = report.collect()
    fail_if_any(rows, pipeline_name)
    return df.sparkSession.createDataFrame(rows, REPORT)


def fail_if_any(rows: Iterable[Row], pipeline_name: str = "") -> None:
    """Raise ``DataQualityError`` naming every failed check of a report."""
    failed = [row["detail"] for row in rows if not row["passed"]]
    if failed:
        raise DataQualityError(GATE_FAILED.format(pipeline_name, "\n  ".join(failed)))


def null_checks(nulls: Mapping[str, int], row_count: int, max_null_rate: float) -> list[Row]:
    """The rows of ``null_report``, from counts that something else has taken."""
    if not row_count:
        return [Row(column="*", check="null_rate", passed=False, detail=EMPTY)]
    out = []
    for name, n in nulls.items():
        rate = n / row_count
        passed = rate <= max_null_rate
        detail = "" if passed else TOO_MANY_NULLS % (name, rate * 100, max_null_rate * 100)
        out.append(Row(column=name, check="null_rate", passed=passed, detail=detail))
    return out
