"""Reading raw events laid out as ``<base>/date=<YYYY-MM-DD>/``, in Parquet or CSV."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spineloom.functions.columns import as_run_date
from spineloom.recipe import INPUT_FORMATS

PARTITION = "date"

# Fixed value: the wording of the row gate's error.
TOO_FEW_ROWS = "Ingested {} rows from {!r}; minimum required is {}."


def read_raw(
    spark: SparkSession,
    path: str,
    input_format: str = "parquet",
    run_date: str | dt.date | None = None,
    lookback_days: int | None = None,
    schema: T.StructType | str | None = None,
    min_row_count: int = 1,
) -> DataFrame:
    """Read one day, a lookback range of days, or (without ``run_date``) the whole table; the date column stays.

    One day is addressed by its own directory, a range by the directories of its days that exist, so neither listing nor
    CSV schema inference touches other days. Pass ``schema`` to spare CSV input the inference
    pass. Raises ``ValueError`` if there are fewer than ``min_row_count`` rows.
    """
    if input_format not in INPUT_FORMATS:
        raise ValueError(f"input_format must be one of {', '.join(INPUT_FORMATS)}; got {input_format!r}")
    base = path.rstrip("/")
    reader = spark.read
    if input_format == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    load = reader.csv if input_format == "csv" else reader.parquet

    if run_date is None:
        df, origin = load(base), base
    elif lookback_days is None:
        origin = f"{base}/{PARTITION}={as_run_date(run_date).isoformat()}"
        reader.option("basePath", base)
        df = load(origin)
    else:
        last = as_run_date(run_date)
        first = last - dt.timedelta(days=lookback_days)
        origin = f"{base} from {first} to {last}"
        # A pattern of all its days matches those that are there.
        days = ",".join((first + dt.timedelta(days=k)).isoformat() for k in range(lookback_days + 1))
        reader.option("basePath", base)
        try:
            df = load(f"{base}/{PARTITION}={{{days}}}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            df = load(base).where(F.lit(False))
    return require_rows(df, min_row_count, origin)


def require_rows(df: DataFrame, min_row_count: int, origin: str = "the input") -> DataFrame:
    """Return ``df`` unchanged, or raise ``ValueError`` if it has fewer than ``min_row_count`` rows."""
    if min_row_count <= 0:
        return df
    found = df.limit(min_row_count).count()
    if found < min_row_count:
        raise ValueError(TOO_FEW_ROWS.format(found, origin, min_row_count))
    return df
