"""Spineloom: declarative entity features on Spark, one row per entity from one aggregation."""

from spineloom.operators.nulls import handle_nulls
from spineloom.operators.quality import (
    DataQualityError,
    failures,
    file_null_rates,
    null_rates,
    null_report,
    quality_gate,
    quality_report,
    schema_report,
    summarize,
)
from spineloom.operators.states import day_states, features_from_states, merge_states
from spineloom.plans.assemble import (
    aggregate_features,
    assemble_features,
    category_map,
    encode_entities,
    encode_rows,
    entity_spine,
    left_join_spine,
    lookback,
    time_features,
)
from spineloom.plans.daily import Run, run_daily, run_incremental
from spineloom.recipe import Aggregation, Definition, Encoding, NullRule, OwnFeature, Settings, TimeWindow, definition, definitions
from spineloom.sources.landing import Landed, land_day, read_landed
from spineloom.sources.publish import remove_replaced
from spineloom.sources.raw import read_raw, require_rows
from spineloom.sources.registry import latest_entries, read_registry, registry_entry, registry_history, update_registry, upsert
from spineloom.sources.store import Written, read_features, side_by_side, write_features

__all__ = [
    "Aggregation",
    "DataQualityError",
    "Definition",
    "Encoding",
    "Landed",
    "NullRule",
    "OwnFeature",
    "Run",
    "Settings",
    "TimeWindow",
    "Written",
    "aggregate_features",
    "assemble_features",
    "category_map",
    "day_states",
    "definition",
    "definitions",
    "encode_entities",
    "encode_rows",
    "entity_spine",
    "failures",
    "features_from_states",
    "file_null_rates",
    "handle_nulls",
    "land_day",
    "latest_entries",
    "left_join_spine",
    "lookback",
    "merge_states",
    "null_rates",
    "null_report",
    "quality_gate",
    "quality_report",
    "read_features",
    "read_landed",
    "read_raw",
    "read_registry",
    "registry_entry",
    "registry_history",
    "remove_replaced",
    "require_rows",
    "run_daily",
    "run_incremental",
    "schema_report",
    "side_by_side",
    "summarize",
    "time_features",
    "update_registry",
    "upsert",
    "write_features",
]
