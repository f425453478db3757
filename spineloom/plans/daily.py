"""One daily run from raw events to stored features and a catalogue entry."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import replace
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from spineloom.functions.columns import as_run_date
from spineloom.operators.quality import quality_gate
from spineloom.operators.states import checked, day_states, features_from_states, longest_window, merge_states
from spineloom.plans.assemble import assemble_features
from spineloom.recipe import Definition, Settings, definitions
from spineloom.sources.landing import land_day, read_landed
from spineloom.sources.publish import is_missing, place_of, published
from spineloom.sources.raw import read_raw
from spineloom.sources.registry import registry_entry, update_registry
from spineloom.sources.store import write_features


class Run(NamedTuple):
    output_path: str
    rows: int
    feature_count: int


def run_daily(spark: SparkSession, settings: Settings, specs: Iterable[Mapping | Definition], **options) -> Run:
    """Read, check, compute, store, register. A failed check raises before anything is written.

    With ``lookback_days`` the run reads that many days of history; otherwise, like a snapshot source, only the
    partition of the run date. With a ``landing_path`` the raw day is landed first, and history is what was landed before.
    """
    recipes = definitions(specs, settings.entity_key)
    raw = landed_day(spark, settings) if settings.landing_path else checked_raw(spark, settings)
    features = assemble_features(
        raw, recipes, settings.entity_key, settings.date_column, settings.run_date, **options
    )
    return store_and_register(spark, settings, features, recipes)


def run_incremental(
    spark: SparkSession, settings: Settings, specs: Iterable[Mapping | Definition], states_path: str, *, cap_at_run_date: bool = False
) -> Run:
    """A daily run that reads the raw rows of one day only: history comes from the states of the run before.

    The day's states are merged with the latest published before it, published under the run date, and the features are
    taken from them. A rerun starts from the same states and replaces its own. Days must be run in order; rows that arrive
    late count from the run on that reads them.
    """
    recipes = checked(specs, settings.entity_key)
    one_day = replace(settings, lookback_days=None)
    raw = landed_day(spark, one_day) if settings.landing_path else checked_raw(spark, one_day)
    keep_from = as_run_date(settings.run_date) - dt.timedelta(days=longest_window(recipes, settings.entity_key))
    states = day_states(raw, recipes, settings.entity_key, settings.date_column)
    before = latest_states(spark, states_path, settings.pipeline_name, settings.run_date)
    if before is not None:
        if before.schema.names != states.schema.names:
            raise ValueError(f"the states below {states_path} belong to other definitions than pipeline {settings.pipeline_name!r} has")
        states = states.unionByName(before)
    merged = merge_states(states, recipes, settings.entity_key, keep_from)
    kept = write_features(merged, states_path, settings.pipeline_name, settings.run_date)
    features = features_from_states(
        spark.read.parquet(kept.path), recipes, settings.entity_key, settings.run_date, cap_at_run_date=cap_at_run_date
    )
    return store_and_register(spark, settings, features, recipes)


def latest_states(spark: SparkSession, states_path: str, pipeline_name: str, run_date: str | dt.date) -> DataFrame | None:
    """The states that the latest run before ``run_date`` published, or None."""
    try:
        runs = published(spark, states_path, place_of(entity_type=pipeline_name))
    except AnalysisException as missing:
        if is_missing(missing):
            return None
        raise
    limit = place_of(entity_type=pipeline_name, date=as_run_date(run_date).isoformat())
    earlier = [place for place in runs if place < limit]
    return spark.read.parquet(runs[max(earlier)].path) if earlier else None


def store_and_register(spark: SparkSession, settings: Settings, features: DataFrame, recipes: Iterable[Definition]) -> Run:
    written = write_features(features, settings.store_path, settings.entity_type, settings.run_date)
    columns = [name for name in features.columns if name != settings.entity_key]
    entry = registry_entry(
        spark,
        settings.pipeline_name,
        settings.entity_type,
        settings.entity_key,
        settings.run_date,
        written.path,
        columns,
        recipes,
    )
    update_registry(settings.registry_path, entry)
    return Run(written.path, written.rows, len(columns))


def checked_raw(spark: SparkSession, settings: Settings) -> DataFrame:
    """The raw files as they are, after the row gate and the quality gate."""
    raw = read_raw(
        spark,
        settings.raw_path,
        settings.input_format,
        run_date=settings.run_date,
        lookback_days=settings.lookback_days,
        schema=settings.schema,
        min_row_count=settings.min_row_count,
    )
    quality_gate(
        raw,
        settings.entity_key,
        settings.date_column,
        settings.max_null_rate,
        required=settings.required,
        expected_types=settings.expected_types,
        pipeline_name=settings.pipeline_name,
    )
    return raw


def landed_day(spark: SparkSession, settings: Settings) -> DataFrame:
    """The raw day landed as Parquet, with both gates in the pass that writes it, and the landed days of the lookback."""
    raw = read_raw(
        spark, settings.raw_path, settings.input_format, run_date=settings.run_date, schema=settings.schema, min_row_count=0
    )
    land_day(
        raw,
        settings.landing_path,
        settings.run_date,
        settings.entity_key,
        settings.date_column,
        max_null_rate=settings.max_null_rate,
        min_row_count=settings.min_row_count,
        required=settings.required,
        expected_types=settings.expected_types,
        pipeline_name=settings.pipeline_name,
    )
    return read_landed(spark, settings.landing_path, settings.run_date, settings.lookback_days)
