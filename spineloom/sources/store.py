"""The feature store: Parquet by entity type and date, one run of each published at a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spineloom.functions.columns import as_run_date, ref
from spineloom.recipe import RESERVED
from spineloom.sources.publish import RUN, Buckets, bucketed_table, place_of, publish, published, stage


class Written(NamedTuple):
    path: str
    rows: int


def _refuse_reserved(df: DataFrame) -> None:
    if clashing := [c for c in df.columns if c.lower() in RESERVED]:
        raise ValueError(f"the store keeps these columns in its directories: {', '.join(clashing)}")


def write_features(
    df: DataFrame, root: str, entity_type: str, run_date: str | dt.date, buckets: tuple[str, int] | None = None
) -> Written:
    """Write one run to ``root/entity_type=.../date=.../run=...``, publish it, and return that path and the row count.

    It takes the place of the day's run before, also without rows, so a rerun is idempotent and other days stay. Readers see
    the old run until the new one is complete, and for good if it fails. The count is observed while writing: the plan is
    executed once.

    ``buckets`` (entity key, number) deals the rows to so many files by hash of the key: days with equal buckets are joined by
    ``side_by_side`` without moving a row. Columns must then be of types that SQL can name, not ML vectors.
    """
    _refuse_reserved(df)
    place = place_of(entity_type=entity_type, date=as_run_date(run_date).isoformat())
    staged = stage(df, root, place, buckets=None if buckets is None else Buckets(*buckets))
    publish(df.sparkSession, staged)
    return Written(staged.path, staged.metrics["rows"])


def read_features(
    spark: SparkSession, root: str, entity_type: str | None = None, run_date: str | dt.date | None = None
) -> DataFrame:
    """Read the published runs with ``entity_type`` (STRING) and ``date`` (DATE) after the features.

    An entity type is read from its own directories and has its own columns; over several days the columns of all of
    them. Without an entity type the columns of all types are united.
    """
    root = root.rstrip("/")
    keys = {} if entity_type is None else {"entity_type": entity_type}
    if entity_type is not None and run_date is not None:
        keys["date"] = as_run_date(run_date).isoformat()
    runs = published(spark, root, place_of(**keys))
    if entity_type is None and run_date is not None:
        day = f"date={as_run_date(run_date).isoformat()}"
        runs = {place: path for place, path in runs.items() if place.endswith(day)}
    if not runs:
        raise ValueError(f"nothing is published below {root} for {run_date}")
    reader = spark.read.option("basePath", root)
    paths = sorted(run.path for run in runs.values())
    merged = reader.option("mergeSchema", len(paths) > 1).parquet(*paths).schema
    features = [T.StructField(f.name, f.dataType) for f in merged.fields if f.name not in (*RESERVED, RUN)]
    # Given types keep a directory name as it is: entity type 007 is text.
    added = [T.StructField("entity_type", T.StringType()), T.StructField("date", T.DateType()), T.StructField(RUN, T.StringType())]
    df = spark.read.option("basePath", root).schema(T.StructType([*features, *added])).parquet(*paths)
    return df.select(*[ref(f.name) for f in features], F.col("entity_type"), F.col("date"))



def side_by_side(
    spark: SparkSession, root: str, entity_type: str, entity_key: str, days: Sequence[str | dt.date]
) -> DataFrame:
    """One row per entity of the first day, with the features of every day as ``<feature>_<yyyymmdd>``; NULL where an entity
    has no row that day.

    Days written in equal buckets by the entity key are joined where their files are: no exchange, whatever their size.
    """
    out: DataFrame | None = None
    runs = published(spark, root, place_of(entity_type=entity_type))
    for day in map(as_run_date, days):
        run = runs.get(place_of(entity_type=entity_type, date=day.isoformat()))
        if run is None:
            raise ValueError(f"nothing is published below {root} for {day}")
        bucketed = run.buckets is not None and run.buckets.column == entity_key
        df = bucketed_table(spark, run) if bucketed else spark.read.parquet(run.path)
        named = [ref(c) if c == entity_key else ref(c).alias(f"{c}_{day:%Y%m%d}") for c in df.columns]
        df = df.select(*named)
        # A merge join keeps the buckets where they are, which a broadcast or a hash join of moved rows would not.
        out = df if out is None else out.hint("merge").join(df.hint("merge"), entity_key, "left")
    if out is None:
        raise ValueError("no days are given")
    return out
