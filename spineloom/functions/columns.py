"""Small column helpers shared by every operator."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column name as SQL text, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """Reference a top-level column by its exact name, dots and backticks included."""
    return F.col(quoted(name))


def as_run_date(run_date: str | dt.date) -> dt.date:
    """Accept an ISO ``YYYY-MM-DD`` string or a date; anything else is a ``ValueError``."""
    if isinstance(run_date, dt.datetime):
        return run_date.date()
    if isinstance(run_date, dt.date):
        return run_date
    if not isinstance(run_date, str):
        raise ValueError(f"run_date must be a date or an ISO date string, got {run_date!r}")
    return dt.date.fromisoformat(run_date)


def calendar(column: Column, dtype: T.DataType) -> Column:
    """A column usable in date arithmetic: text is cast to DATE, NULL if it is none; dates and timestamps stay."""
    return column.try_cast("date") if isinstance(dtype, T.StringType) else column


def numeric(column: Column, dtype: T.DataType) -> Column:
    """Operand of a numeric aggregate: unparsable text becomes NULL instead of failing the job under ANSI mode."""
    return column.try_cast("double") if isinstance(dtype, T.StringType) else column


def instant(column: Column, dtype: T.DataType) -> Column:
    """Days since 1970 of a date, microseconds since 1970 of a timestamp, as BIGINT."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(dtype, T.TimestampNTZType):
        seconds = F.hour(column) * 3600 + F.minute(column) * 60
        inside = seconds.cast("long") * 1_000_000 + (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("long")
        return F.unix_date(F.to_date(column)).cast("long") * 86_400_000_000 + inside
    return F.unix_date(column).cast("long")


def since(date: Column, run_date: dt.date, days: int) -> Column:
    """Lookback predicate: on or after the date ``days`` before ``run_date``; later dates count too.

    The cutoff is a literal, so a filter on a DATE or TIMESTAMP column is pushed into the file scan.
    """
    return date >= F.lit(run_date - dt.timedelta(days=days))


def fill_null(column: Column, dtype: T.DataType, constant) -> Column:
    """Replace NULL (and NaN in floating columns) by a constant cast to the column's own type."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        column = F.nanvl(column, F.lit(None).cast(dtype))
    return F.coalesce(column, F.lit(constant).cast(dtype))


def real_number(column: Column, dtype: T.DataType) -> Column:
    """The column as DOUBLE with NaN turned into NULL."""
    value = column.cast("double")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        value = F.nanvl(value, F.lit(None).cast("double"))
    return value


def text_array(values: Sequence[str]) -> Column:
    """ARRAY<STRING> literal; the optimizer folds the parsing away."""
    return F.from_json(F.lit(json.dumps(values)), "array<string>")


def number_array(values: Sequence[float]) -> Column:
    """ARRAY<DOUBLE> literal."""
    return F.expr(f"array({', '.join(f'{float(v)!r}D' for v in values)})")
