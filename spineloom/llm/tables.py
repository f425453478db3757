"""Intermediate tables in the shared folder: computed once, as Parquet, and read back with a short lineage; they go when the
session's JVM ends."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spineloom.durable import passing_path


class Tables:
    """The intermediate tables of one run, below a folder of its own."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = passing_path(spark, purpose)
        self.count = 0

    def __call__(self, df: DataFrame) -> DataFrame:
        """``df`` as it was written. Unlike a checkpoint, nothing is computed twice."""
        self.count += 1
        path = f"{self.path}/{self.count:03}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)


def widened(schema: T.StructType, added: str) -> T.StructType:
    """The columns of a schema, whatever they are called, and more given as text."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(added).fields])


def through_arrow(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for columns of any name: the batches go to the workers and back by place."""
    names, places = df.columns, [f"c{i}" for i in range(len(schema.fields))]
    moved = T.StructType([T.StructField(place, f.dataType) for place, f in zip(places, schema.fields, strict=True)])

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = (pa.RecordBatch.from_arrays(batch.columns, names) for batch in batches)
        for found in task(named):
            yield pa.RecordBatch.from_arrays(found.columns, places)

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(renamed, moved).toDF(*schema.names)
