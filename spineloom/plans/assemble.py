"""Feature tables from recipes: the whole assembly and its single-purpose parts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spineloom.functions.columns import as_run_date, calendar, ref, since
from spineloom.operators.categories import Source, as_category, fit_categories, look_up
from spineloom.operators.features import encoding_column, entity_features, sparse_one_hot
from spineloom.recipe import Aggregation, Definition, Encoding, TimeWindow


def entity_spine(df: DataFrame, entity_key: str) -> DataFrame:
    """The distinct entity keys, a missing key included once."""
    return df.select(ref(entity_key)).distinct()


def left_join_spine(spine: DataFrame, features: DataFrame, entity_key: str) -> DataFrame:
    """Attach a feature table (one row per entity) to the spine; entities without features get NULLs.

    Broadcasting is left to the optimizer, which measures the feature table. Both sides are one row per entity, so no
    key can be hot.
    """
    return spine.join(features, entity_key, "left")


def lookback(df: DataFrame, date_column: str, run_date: str | dt.date, days: int) -> DataFrame:
    """Rows dated on or after ``run_date - days``, later dates included; a pushed-down filter on the scan."""
    date = calendar(ref(date_column), df.schema[date_column].dataType)
    return df.where(since(date, as_run_date(run_date), days))


def assemble_features(
    df: DataFrame,
    definitions: Iterable[Mapping | Definition],
    entity_key: str,
    date_column: str,
    run_date: str | dt.date,
    **options,
) -> DataFrame:
    """All features of all definitions, one row per entity of the raw table. Options as in ``entity_features``."""
    return entity_features(df, definitions, entity_key, date_column, run_date, **options)


def aggregate_features(
    df: DataFrame,
    aggregations: Iterable[Mapping | Aggregation],
    entity_key: str,
    date_column: str,
    run_date: str | dt.date,
    **options,
) -> DataFrame:
    """sum, mean, count, stddev, min and max per entity, over all rows or a lookback window."""
    spec = {"entity_type": "entity", "aggregations": tuple(aggregations)}
    return entity_features(df, [spec], entity_key, date_column, run_date, **options)


def time_features(
    df: DataFrame,
    time_windows: Iterable[Mapping | TimeWindow],
    entity_key: str,
    date_column: str,
    run_date: str | dt.date,
    **options,
) -> DataFrame:
    """Days since the last row, rolling mean and least-squares trend per entity."""
    spec = {"entity_type": "entity", "time_windows": tuple(time_windows)}
    return entity_features(df, [spec], entity_key, date_column, run_date, **options)


def encode_entities(
    df: DataFrame,
    encodings: Iterable[Mapping | Encoding],
    entity_key: str,
    date_column: str | None = None,
    **options,
) -> DataFrame:
    """Frequency, label and one-hot codes of each entity's latest category (by name alone without a date column)."""
    spec = {"entity_type": "entity", "encodings": tuple(encodings)}
    return entity_features(df, [spec], entity_key, date_column, None, **options)


def encode_rows(
    df: DataFrame, encoding: Mapping | Encoding, entity_key: str, *, onehot: str = "array"
) -> DataFrame:
    """One encoding at the grain of the input: a row per event, and one NULL row for events without an entity.

    Several encodings are not combined at this grain: joined by entity they would multiply each other's rows.
    """
    if onehot not in ("array", "vector"):
        raise ValueError(f"onehot must be 'array' or 'vector'; got {onehot!r}")
    spec = encoding if isinstance(encoding, Encoding) else Encoding(**encoding)
    if spec.source_column not in df.columns:
        return entity_spine(df, entity_key)
    category = as_category(ref(spec.source_column), df.schema[spec.source_column].dataType)
    maps = fit_categories(df, [Source(category)])
    entity = ref(entity_key)
    events = df.where(entity.isNotNull()).select(entity, category.alias("__category"))
    coded = look_up(events, "__category", maps, 0, {"share": "__share", "label": "__label"})
    labels = maps.attributes[0].labels
    dense = onehot == "array"
    value = encoding_column(spec, F.col("__label"), F.col("__share"), F.lit(True), labels, dense)
    result = coded.select(entity, value.alias(spec.name))
    absent = df.where(entity.isNull()).select(entity).distinct()
    result = result.unionByName(
        absent.select(entity, F.lit(None).cast(result.schema[spec.name].dataType).alias(spec.name))
    )
    return sparse_one_hot(result, spec.name, labels) if spec.method == "onehot" and not dense else result


def category_map(df: DataFrame, source_column: str) -> DataFrame:
    """The fitted map of one column: category, n, share of all rows and label (the label after the last for NULL)."""
    category = as_category(ref(source_column), df.schema[source_column].dataType)
    return fit_categories(df, [Source(category)]).map_of(0)
