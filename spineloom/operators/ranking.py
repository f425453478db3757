"""Places of rows in an order over a whole table, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spineloom.durable import stored

# A group up to this many rows and bytes is sorted by one task; larger tables are cut into range slices of about this size.
# The bounds of a slice are drawn from a few hundred keys that pass through the driver, so beyond SLICES the slices grow
# up to MOST_BYTES first.
ROWS_PER_SLICE = 1_000_000
BYTES_PER_SLICE = 64 << 20
MOST_BYTES = 256 << 20
SLICES = 48

_PLACE = "__place"
_SLICE = "__slice"
_FIRST = "__first"
_ROWS = "__rows"
_OFFSET = "__offset"
# Fixed value: Spark numbers the rows of a partition in the low digits of a row id, and partitions in those above.
_PLACE_BITS = 33


def ranks(
    df: DataFrame,
    group: str,
    order: Sequence[Column],
    rows: int,
    name: str,
    rows_per_slice: int | None = None,
    size: int = 0,
) -> DataFrame:
    """Add ``name``: how many rows of the same group sort before this one.

    ``order`` must order the rows of a group totally, so that equal sort keys cannot pile up in one slice. ``rows`` is
    the measured size of ``df``, and ``size`` the bytes of its texts. A table larger than ``rows_per_slice`` or
    ``BYTES_PER_SLICE`` is range-partitioned and sorted by (group, order) and written once, each row with its place in its slice.
    What is added to a place depends on the slice and the group alone, a handful of numbers: there is no second sort.
    """
    bytes_per_slice = max(BYTES_PER_SLICE, min(MOST_BYTES, size // SLICES))
    slices = max(-(-rows // (rows_per_slice or ROWS_PER_SLICE)), -(-size // bytes_per_slice))
    if slices <= 1:
        place = F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1
        return df.withColumn(name, place.cast("bigint"))

    sliced = df.repartitionByRange(slices, F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    placed = stored(sliced.withColumn(_PLACE, F.monotonically_increasing_id()), "ranks")
    placed = placed.withColumn(_SLICE, F.shiftright(_PLACE, _PLACE_BITS))
    earlier = Window.partitionBy(group).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per slice and group: `slices` + number of groups rows.
    offsets = (
        placed.groupBy(group, _SLICE)
        .agg(F.min(_PLACE).alias(_FIRST), F.count(F.lit(1)).alias(_ROWS))
        .select(group, _SLICE, (F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)) - F.col(_FIRST)).alias(_OFFSET))
    )
    ranked = placed.join(F.broadcast(offsets), [group, _SLICE])
    return ranked.withColumn(name, F.col(_PLACE) + F.col(_OFFSET)).drop(_PLACE, _SLICE, _OFFSET)
