"""Fixed-size NumPy arrays that every partition fills and Spark merges: count sketches and bitmaps."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 16
FAN_IN = 64
SCHEMA = "slot int, cells binary"


def parts(array: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The array in SLOTS compressed slices, so that no row is large and the merge is spread over tasks."""
    for slot, part in enumerate(np.array_split(array, SLOTS)):
        yield slot, zlib.compress(part.tobytes(), 1)


def part_batch(array: np.ndarray) -> pa.RecordBatch:
    slots, cells = zip(*parts(array), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(cells, pa.binary())], ["slot", "cells"])


def merged(df: DataFrame, dtype: np.dtype, combine: Callable, empty: np.ndarray) -> np.ndarray:
    """All partial arrays of ``df`` (slot, cells) combined; the result has the size of ``empty``, whatever the input.

    Partial rows meet in two steps of at most FAN_IN tasks a slot; each task streams them and holds one array a slot.
    """

    def combined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(cells), dtype)
                held[slot] = combine(held[slot], part) if slot in held else part
        slots = sorted(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots, pa.int32()), pa.array([zlib.compress(held[s].tobytes(), 1) for s in slots], pa.binary())], ["slot", "cells"]
        )

    step = df.withColumn("lane", F.spark_partition_id() % FAN_IN).repartition("slot", "lane").select("slot", "cells")
    step = step.mapInArrow(combined, SCHEMA).repartition("slot").mapInArrow(combined, SCHEMA)
    found = {row.slot: np.frombuffer(zlib.decompress(row.cells), dtype) for row in step.collect()}
    return np.concatenate([found.get(slot, part) for slot, part in enumerate(np.array_split(empty, SLOTS))])
