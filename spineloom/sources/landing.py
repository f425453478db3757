"""Landing a day of raw events: checked while it is written, published only if the checks pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spineloom.functions.columns import as_run_date, ref
from spineloom.operators.quality import REPORT, fail_if_any, null_checks, schema_report
from spineloom.sources.publish import RUN, is_missing, place_of, publish, published, stage
from spineloom.sources.raw import PARTITION, TOO_FEW_ROWS


class Landed(NamedTuple):
    path: str
    rows: int
    report: DataFrame


def land_day(
    df: DataFrame,
    root: str,
    run_date: str | dt.date,
    entity_key: str,
    date_column: str,
    *,
    max_null_rate: float = 0.05,
    min_row_count: int = 1,
    required: Sequence[str] = (),
    expected_types: Mapping[str, str] | None = None,
    pipeline_name: str = "",
) -> Landed:
    """Write one day of raw events as Parquet and publish it, if it has enough rows and passes the quality checks.

    Row and null counts are observed by the write itself, so the input, which may be CSV, is read once in all. What needs
    no rows, presence and type of columns, is checked before. Too few rows raise ``ValueError`` and a failed check
    ``DataQualityError``; the day's run before, if any, stays published. A column ``date`` must hold the day itself (or nothing):
    it becomes the name of the directory.
    """
    spark = df.sparkSession
    day = as_run_date(run_date)
    known = schema_report(df, list(dict.fromkeys([entity_key, date_column, *required])), expected_types).collect()
    fail_if_any(known, pipeline_name)
    names = df.columns
    counts = [F.count(ref(name)).alias(f"c{i}") for i, name in enumerate(names)]
    dated = [PARTITION] if PARTITION in names else []
    elsewhere = [F.count_if(ref(c).cast("date") != F.lit(day)).alias("elsewhere") for c in dated]
    staged = stage(df, root, place_of(**{PARTITION: day.isoformat()}), [*counts, *elsewhere], drop=dated)
    rows = staged.metrics["rows"]
    if staged.metrics.get("elsewhere"):
        raise ValueError(f"{staged.metrics['elsewhere']} rows have another {PARTITION} than {day}, which is kept as a directory")
    if rows < min_row_count:
        raise ValueError(TOO_FEW_ROWS.format(rows, f"{root} of {day}", min_row_count))
    nulls = {name: rows - staged.metrics[f"c{i}"] for i, name in enumerate(names)}
    found = [*known, *null_checks(nulls, rows, max_null_rate)]
    fail_if_any(found, pipeline_name)
    publish(spark, staged)
    return Landed(staged.path, rows, spark.createDataFrame(found, REPORT))


def read_landed(
    spark: SparkSession, root: str, run_date: str | dt.date | None = None, lookback_days: int | None = None
) -> DataFrame:
    """The published days as ``read_raw`` gives them: one day, a lookback range, or all; the ``date`` column stays."""
    root = root.rstrip("/")
    try:
        runs = published(spark, root)
    except AnalysisException as missing:
        if not is_missing(missing):
            raise
        runs = {}
    if run_date is not None:
        last = as_run_date(run_date)
        days = {place_of(**{PARTITION: (last - dt.timedelta(days=k)).isoformat()}) for k in range((lookback_days or 0) + 1)}
        runs = {place: path for place, path in runs.items() if place in days}
    if not runs:
        raise ValueError(f"no day is published below {root} for {run_date}")
    paths = sorted(run.path for run in runs.values())
    merged = spark.read.option("basePath", root).option("mergeSchema", len(paths) > 1).parquet(*paths).schema
    fields = [T.StructField(f.name, f.dataType) for f in merged.fields if f.name not in (PARTITION, RUN)]
    schema = T.StructType([*fields, T.StructField(PARTITION, T.DateType()), T.StructField(RUN, T.StringType())])
    return spark.read.option("basePath", root).schema(schema).parquet(*paths).drop(RUN)
