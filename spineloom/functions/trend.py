"""Least-squares trend of a value over days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ols_slope(x: Column, y: Column, inside: Column) -> Column:
    """Slope of ``y`` on ``x`` over the rows where ``inside`` holds, as one expression of plain aggregates.

    Rows with a NULL ``y`` still count in n, sum(x) and sum(x*x) but not in sum(y) and sum(x*y), so this is not
    ``regr_slope`` when ``y`` has gaps. A zero denominator (one row, or one distinct day) gives 0.0; no row at all
    gives NULL.
    """
    n = F.count_if(inside)
    sum_x = F.sum(F.when(inside, x))
    sum_y = F.sum(F.when(inside, y))
    sum_xy = F.sum(F.when(inside, x * y))
    sum_xx = F.sum(F.when(inside, x * x))
    spread = n * sum_xx - sum_x * sum_x
    slope = F.when(spread != 0, (n * sum_xy - sum_x * sum_y) / spread).otherwise(F.lit(0.0))
    return F.when(n > 0, slope)
