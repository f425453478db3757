"""Global medians of several columns by radix selection: counting passes that narrow a bracket around each median.

A pass counts the values of every column in at most ``CELLS`` cells per column, keeping the smallest and the largest value of
each cell, and finds the cell in which the running count reaches the middle. The first pass cuts the whole range of a DOUBLE by
sign and magnitude, its leading digits; each further pass cuts the bracket that is left into even cells, sixteen more bits.
Nothing but counts is moved: no value is sorted, stored or sent to the driver, and a task hands on one row per cell it saw.

The bracket holds the median whatever rounding does to the cells: it reaches from the smallest value at or above the middle
cell to the largest at or below it, and values below the bracket are counted anew in the next pass. The counts do not depend
on how the rows are split into partitions or files, and neither does any answer, approximate ones included.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed bounds: cells of a column in a pass, and how many ranks, as a share of all, an approximate median may be off.
CELLS = 65_536
RANK_ERROR = 0.005

# Natural logarithms of positive DOUBLEs lie between -745 and 710; 22 cells to a unit use 32,000 per sign.
_LEAST_LOG = -745
_CELLS_PER_LOG = 22


class Bracket(NamedTuple):
    """The median lies between two values that occur; ``inside`` values share its cell, of ``total`` in the column."""

    low: float
    high: float
    inside: int
    total: int


def _leading(value: Column) -> Column:
    """Cell by sign and magnitude; larger values never get a smaller cell, and 0 has one of its own."""
    size = F.floor(F.ln(F.abs(value)) * F.lit(_CELLS_PER_LOG)) - F.lit(_LEAST_LOG * _CELLS_PER_LOG - 1)
    size = F.when(F.abs(value) == float("inf"), F.lit(CELLS // 2)).otherwise(size)
    return F.when(value == 0, F.lit(0)).when(value > 0, size).otherwise(-size)


def _within(value: Column, bracket: Bracket) -> Column:
    """Cell of a value in the bracket, -1 below it, NULL above it."""
    share = (value - F.lit(bracket.low)) / F.lit(bracket.high - bracket.low)
    cell = F.least(F.floor(share * F.lit(float(CELLS - 1))), F.lit(CELLS - 1))
    return F.when(value < bracket.low, F.lit(-1)).when(value <= bracket.high, cell)


def _narrowed(df: DataFrame, values: Mapping[int, Column], brackets: Mapping[int, Bracket]) -> dict[int, Bracket]:
    """One pass over the table: a bracket, or a narrower one, for each column that has values."""
    wide = df.select(*[value.alias(f"m{i}") for i, value in values.items()])
    cells = []
    for i in values:
        value = F.col(f"m{i}") + F.lit(0.0)  # -0.0 becomes 0.0
        cells += [F.lit(i), (_within(value, brackets[i]) if i in brackets else _leading(value)).cast("int"), value]
    long = wide.select(F.stack(F.lit(len(values)), *cells).alias("which", "cell", "value"))
    counted = (
        long.where(F.col("cell").isNotNull())
        .groupBy("which", "cell")
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    # A column has CELLS + 1 rows here at most.
    up_to = Window.partitionBy("which").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Backwards, as a frame that ends at the last row would be summed anew for every row.
    from_here = Window.partitionBy("which").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {i: bracket.total for i, bracket in brackets.items()}
    total = F.sum("n").over(Window.partitionBy("which"))
    if totals:
        total = F.create_map(*[F.lit(x) for pair in totals.items() for x in pair])[F.col("which")]
    placed = counted.select(
        "which",
        "n",
        F.sum("n").over(up_to).alias("reached"),
        total.alias("total"),
        F.min("low").over(from_here).alias("low"),
        F.max("high").over(up_to).alias("high"),
    )
    middle = placed.where((F.col("reached") * 2 >= F.col("total")) & ((F.col("reached") - F.col("n")) * 2 < F.col("total")))
    return {row["which"]: Bracket(row["low"], row["high"], row["n"], row["total"]) for row in middle.collect()}


def radix_medians(df: DataFrame, values: Mapping[str, Column], rank_error: float = 0.0) -> dict[str, float | None]:
    """Lower median of each DOUBLE expression; NULLs are ignored, no value at all gives None.

    With ``rank_error`` a column is done as soon as the cell that holds its median has at most that share of the values,
    and the smallest of them is the answer: a value that occurs, off by fewer ranks than that.
    """
    names = list(values)
    open_ = {i: values[name] for i, name in enumerate(names)}
    brackets: dict[int, Bracket] = {}
    done: dict[int, float] = {}
    while open_:
        brackets = _narrowed(df, open_, brackets)
        for i, bracket in brackets.items():
            if bracket.low == bracket.high or bracket.inside <= rank_error * bracket.total:
                done[i] = bracket.low
        open_ = {i: open_[i] for i in brackets if i not in done}
        brackets = {i: brackets[i] for i in open_}
    return {name: done.get(i) for i, name in enumerate(names)}


def approximate_medians(df: DataFrame, values: Mapping[str, Column]) -> dict[str, float | None]:
    """Medians within ``RANK_ERROR`` in rank; as a rule two passes."""
    return radix_medians(df, values, RANK_ERROR)


def exact_medians(df: DataFrame, values: Mapping[str, Column]) -> dict[str, float | None]:
    """The smallest value with at least half of the values at or below it; two to five passes."""
    return radix_medians(df, values)
