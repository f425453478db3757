"""The feature catalogue: one entry per pipeline, kept as a Parquet table partitioned by pipeline name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spineloom.functions.columns import as_run_date
from spineloom.recipe import Aggregation, Definition, Encoding, OwnFeature, TimeWindow, definition

# Fixed value: the layout of a catalogue entry.
ENTRY = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType(), False),
        T.StructField("entity_type", T.StringType()),
        T.StructField("entity_key", T.StringType()),
        T.StructField("run_date", T.StringType()),
        T.StructField("output_path", T.StringType()),
        T.StructField("feature_count", T.IntegerType()),
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType())])
            ),
        ),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)

# How the catalogue calls each kind of feature.
_KIND = {Aggregation: "aggregation", Encoding: "encoding", TimeWindow: "time_window", OwnFeature: "own"}


def registry_entry(
    spark: SparkSession,
    pipeline_name: str,
    entity_type: str,
    entity_key: str,
    run_date: str | dt.date,
    output_path: str,
    feature_columns: Sequence[str],
    specs: Iterable[Mapping | Definition],
    updated_at: dt.datetime | None = None,
) -> DataFrame:
    """One row describing a run. ``features`` lists what was declared, ``feature_count`` counts what was written."""
    declared = [(f.name, _KIND[type(f)]) for spec in specs for f in definition(spec).features]
    row = (
        pipeline_name,
        entity_type,
        entity_key,
        as_run_date(run_date).isoformat(),
        output_path,
        len(feature_columns),
        declared,
        updated_at or dt.datetime.now(tz=dt.UTC),
    )
    return spark.createDataFrame([row], ENTRY)


def upsert(current: DataFrame, new: DataFrame) -> DataFrame:
    """The newest entry of every pipeline in either table; entries of other pipelines are kept."""
    return latest_entries(current.unionByName(new))


def latest_entries(history: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct("*"), F.col("updated_at")).alias("entry")
    return history.groupBy(F.col("pipeline_name").alias("__pipeline")).agg(newest).select("entry.*")


def update_registry(path: str, entry: DataFrame) -> None:
    """Append the entry: it replaces the pipeline's entry before for every reader, and no other.

    The catalogue is the history of its entries and readers take the newest of each pipeline. An entry is one file, there or
    not: no reader sees a gap, no read error can wipe the catalogue, and pipelines that finish at the same time do not touch
    each other's files.
    """
    entry.coalesce(1).write.mode("append").partitionBy("pipeline_name").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The newest entry of each pipeline."""
    return latest_entries(registry_history(spark, path))


def registry_history(spark: SparkSession, path: str) -> DataFrame:
    """All entries that were ever made, one a run."""
    return spark.read.schema(ENTRY).parquet(path).select(*ENTRY.names)
