"""Entity features in one aggregation.

All aggregations, time features and latest categories of all definitions are compiled into conditional aggregates of a
single ``groupBy(entity)``: one scan and one shuffle of partially aggregated rows, whatever the number of features. A
hot entity is reduced on the map side like any other.

Spark aggregates by hashing only while every aggregation buffer has a fixed width; a string in one of them turns the
whole aggregation into a sort of all input rows. The latest category is therefore kept as a number, day and place of
the category in its (small) map or in a dictionary that is broadcast. Attributes with more categories than that are reduced to
pairs of entity and category, coded by their dictionaries and reduced again as numbers, all of them together; minima or maxima
of text go into a narrow aggregation of their own, and so do features of the caller's that hashing cannot keep. Both are joined by entity.
"""

from __future__ import annotations

import datetime as dt
import io
import re
from collections.abc import Iterable, Mapping
from contextlib import redirect_stdout

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spineloom.functions.columns import as_run_date, calendar, instant, numeric, ref, since
from spineloom.functions.trend import ols_slope
from spineloom.operators.categories import (
    Attribute,
    CategoryMaps,
    Dictionaries,
    Source,
    as_category,
    fit_categories,
    latest_codes,
    name_hashes,
)
from spineloom.operators.nulls import Cleaned, compile_all
from spineloom.recipe import Aggregation, Definition, Encoding, OwnFeature, TimeWindow, definitions, distinct_keys

_AGGREGATES = {
    "sum": F.sum,
    "mean": F.avg,
    "count": F.count,
    "stddev": F.stddev_samp,
    "min": F.min,
    "max": F.max,
}
_NEED_NUMBERS = ("sum", "mean", "stddev")


class _Rows:
    """The row-level columns one aggregation reads: each distinct one is computed once per input row."""

    def __init__(self, view: Cleaned, date_column: str | None, run_date: dt.date | None, cap: bool, prefix: str):
        self.view = view
        self.date_column = date_column
        self.run_date = run_date
        self.cap = cap
        self.prefix = prefix
        self.inputs: dict[tuple, tuple[str, Column]] = {}

    def _input(self, key: tuple, column: Column) -> Column:
        if key not in self.inputs:
            self.inputs[key] = (f"{self.prefix}{len(self.inputs)}", column)
        return F.col(self.inputs[key][0])

    def _raw_date(self) -> Column:
        return calendar(self.view.columns[self.date_column], self.view.types[self.date_column])

    def instant(self) -> Column:
        dtype = self.view.types[self.date_column]
        return self._input(("instant",), instant(self._raw_date(), dtype))

    def kept(self) -> Column | None:
        return None if self.view.keep is None else self._input(("keep",), self.view.keep)

    def date(self) -> Column:
        return self._input(("date",), self._raw_date())

    def value(self, name: str) -> Column:
        return self._input(("value", name), self.view.columns[name])

    def number(self, name: str) -> Column:
        if not isinstance(self.view.types[name], T.StringType):
            return self.value(name)
        return self._input(("number", name), numeric(self.view.columns[name], self.view.types[name]))

    def real(self, name: str) -> Column:
        return self.number(name).cast("double")

    def category(self, name: str) -> Column:
        if isinstance(self.view.types[name], T.StringType):
            return self.value(name)
        return self._input(("category", name), as_category(self.view.columns[name], self.view.types[name]))

    def hashed_name(self, name: str) -> list[str]:
        """The input columns that hold a category's hashed name."""
        category = as_category(self.view.columns[name], self.view.types[name])
        halves = name_hashes(category)
        for k, half in enumerate(halves):
            self._input(("name", k, name), half)
        return [self.inputs["name", k, name][0] for k in range(len(halves))]

    def inside(self, days: int | None) -> Column | None:
        """Flag of the rows a feature looks at; None when it looks at every row."""
        if days is None:
            return self.kept()
        date = self._raw_date()
        flag = since(date, self.run_date, days)
        if self.cap:
            flag = flag & (F.to_date(date) <= F.lit(self.run_date))
        if self.view.keep is not None:
            flag = flag & self.view.keep
        return self._input(("inside", days), flag)

    def day_number(self, days: int) -> Column:
        start = F.lit(self.run_date - dt.timedelta(days=days))
        return self._input(("day", days), F.datediff(self._raw_date(), start).cast("double"))


def _where(inside: Column | None, value: Column) -> Column:
    return value if inside is None else F.when(inside, value)


def _if_any(inside: Column | None, value: Column) -> Column:
    """NULL when no row of the group is inside: keeps "no rows" apart from a count of zero."""
    return value if inside is None else F.when(F.bool_or(inside), value)


def aggregation_column(feature: Aggregation, rows: _Rows) -> Column:
    if feature.source_column not in rows.view:
        raise ValueError(f"aggregation {feature.name!r} needs the missing column {feature.source_column!r}")
    inside = rows.inside(feature.window_days)
    source = rows.number if feature.function in _NEED_NUMBERS else rows.value
    total = _AGGREGATES[feature.function](_where(inside, source(feature.source_column)))
    return _if_any(inside, total) if feature.function == "count" else total


class FeatureRows:
    """What a feature of the caller's sees: the columns after the null rules, NULL on rows outside its window."""

    def __init__(self, feature: OwnFeature, rows: _Rows):
        self._rows = rows
        self.inside = rows.inside(feature.window_days)

    def value(self, name: str) -> Column:
        if name not in self._rows.view:
            raise ValueError(f"the input has no column {name!r}")
        return _where(self.inside, self._rows.value(name))

    def date(self) -> Column:
        return _where(self.inside, self._rows.date())


def fixed_width(feature: Aggregation, view: Cleaned) -> bool:
    """Whether the aggregate keeps its state in numbers, dates or flags, as hash aggregation requires."""
    dtype = view.types.get(feature.source_column)
    return feature.function not in ("min", "max") or isinstance(
        dtype, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    )


def hashes(grouped: GroupedData, column: Column) -> bool:
    """Whether an aggregate of the caller's keeps its state in fixed width: analysed alone, Spark plans it by hashing."""
    shown = io.StringIO()
    with redirect_stdout(shown):
        grouped.agg(column.alias("own")).explain()
    return re.search(r"\b(Sort|ObjectHash)Aggregate\b", shown.getvalue()) is None


def time_window_column(feature: TimeWindow, rows: _Rows) -> Column:
    if feature.feature_type == "days_diff":
        latest = F.max(_where(rows.kept(), rows.date()))
        return F.datediff(F.lit(rows.run_date), latest)
    inside = rows.inside(feature.lookback)
    if feature.feature_type == "rolling_mean":
        return F.avg(_where(inside, rows.number(feature.source_column)))
    return ols_slope(rows.day_number(feature.lookback), rows.real(feature.source_column), inside)


def _when(rows: _Rows) -> Column | None:
    """What orders the rows of an entity, as BIGINT; None without a date column."""
    return None if rows.date_column is None else instant(rows._raw_date(), rows.view.types[rows.date_column])


def latest_pairs(df: DataFrame, large: Mapping[int, tuple[_Rows, str]], key: Column, entity_key: str) -> DataFrame:
    """(entity, attribute, category, when): when each entity last met each category of each large attribute, in one scan.

    Names are grouping keys here and in no buffer, so this hashes.
    """
    parts: list[Column] = []
    for i, (rows, name) in large.items():
        named = rows.view.columns[name].isNotNull()
        if rows.view.keep is not None:
            named = named & rows.view.keep
        category = as_category(rows.view.columns[name], rows.view.types[name])
        when = _when(rows)
        parts += [F.when(named, F.lit(i)), category, F.lit(None).cast("long") if when is None else when]
    return (
        df.where(key.isNotNull())
        .select(key.alias(entity_key), F.stack(F.lit(len(large)), *parts).alias("attribute", "category", "when"))
        .where(F.col("attribute").isNotNull())
        .groupBy(ref(entity_key), "attribute", "category")
        .agg(F.max("when").alias("when"))
    )


def latest_position(rows: _Rows, name: str, attribute: Attribute) -> Column:
    """The place of the latest category in a small map, by the same rule, from a maximum over plain numbers."""
    place = attribute.known.position(rows.category(name))
    when = None if rows.date_column is None else rows.instant()
    return attribute.place_of(F.max(_where(rows.kept(), attribute.dated(when, place))))


def present(feature: Aggregation | Encoding | TimeWindow, view: Cleaned) -> bool:
    """Encodings and rolling features over an absent column are left out; aggregations fail instead."""
    if isinstance(feature, (Aggregation, OwnFeature)):
        return True
    if isinstance(feature, TimeWindow) and feature.feature_type == "days_diff":
        return True
    return feature.source_column in view


def one_hot(label: Column, labels: int) -> Column:
    """Dense 0/1 array with one slot per label and a last one for rows without a known category; NULL stays NULL."""
    slots = F.sequence(F.lit(0), F.lit(labels))
    return F.when(label.isNotNull(), F.transform(slots, lambda i: (i == label).cast("double")))


def sparse_one_hot(df: DataFrame, name: str, labels: int) -> DataFrame:
    """Replace a label column by the same one-hot code as a sparse ML vector."""
    nominal = {"ml_attr": {"type": "nominal", "num_vals": labels + 1, "name": name}}
    unknown = F.coalesce(ref(name), F.lit(float(labels)))
    coded = df.withColumn("__label", unknown.alias("__label", metadata=nominal))
    encoder = OneHotEncoder(inputCol="__label", outputCol="__vector", dropLast=False)
    vectors = encoder.fit(coded).transform(coded)
    value = F.when(ref(name).isNotNull(), F.col("__vector")).alias(name)
    return vectors.select(*[value if c == name else ref(c) for c in df.columns])


def encoding_column(feature: Encoding, label: Column, share: Column, known: Column, labels: int, dense: bool) -> Column:
    if feature.method == "frequency":
        return F.when(known, share)
    index = F.when(known, F.coalesce(label, F.lit(float(labels))))
    return one_hot(index, labels) if feature.method == "onehot" and dense else index


def _aggregate(
    df: DataFrame,
    members: list[tuple[int, Definition, _Rows]],
    key: Column,
    entity_key: str,
    maps: CategoryMaps | None,
    attribute_of: Mapping[tuple[int, str], int],
    onehot: str,
) -> DataFrame:
    """One aggregation for all definitions that group by the same key expression."""
    entity = ref(entity_key)
    names: list[str] = []
    hashed: dict[str, Column] = {}
    sorted_: dict[str, Column] = {}
    own: dict[str, Column] = {}
    encodings: dict[str, tuple[Encoding, int]] = {}
    helpers: dict[str, Column] = {}
    large: dict[int, tuple[_Rows, str]] = {}
    for view_id, recipe, rows in members:
        for feature in recipe.features:
            if not present(feature, rows.view):
                continue
            names.append(feature.name)
            if isinstance(feature, Aggregation):
                part = hashed if fixed_width(feature, rows.view) else sorted_
                part[feature.name] = aggregation_column(feature, rows)
            elif isinstance(feature, OwnFeature):
                own[feature.name] = feature.column(FeatureRows(feature, rows))
            elif isinstance(feature, TimeWindow):
                hashed[feature.name] = time_window_column(feature, rows)
            else:
                i = attribute_of[view_id, feature.source_column]
                encodings[feature.name] = (feature, i)
                known = maps.attributes[i].known
                if known:
                    place = latest_position(rows, feature.source_column, maps.attributes[i])
                    helpers[f"__share{i}"] = known.value("share", place)
                    helpers[f"__label{i}"] = known.value("label", place)
                else:
                    large[i] = (rows, feature.source_column)
                if rows.view.keep is not None:
                    helpers[f"__seen{i}"] = F.bool_or(rows.kept())

    if not names:
        return df.select(key.alias(entity_key)).distinct()

    # Large attributes: whole dictionaries are looked up row by row as far as they may be broadcast, and their codes sit in
    # the aggregation like any number; those of the rest meet pairs of entity and category.
    dictionaries = Dictionaries(maps, list(large)) if large else None
    coded = {i: large[i] for i in (maps.portable(large) if large else ())}
    paired = {i: large[i] for i in large if i not in coded}
    names_of = {}
    for i, (rows, name) in coded.items():
        names_of[i] = rows.hashed_name(name)
        when = None if rows.date_column is None else rows.instant()
        helpers[f"__dated{i}"] = F.max(_where(rows.kept(), maps.attributes[i].dated(when, F.col(f"__code{i}"))))

    readers = {id(rows): rows for _, _, rows in members}.values()
    inputs = [column.alias(alias) for rows in readers for alias, column in rows.inputs.values()]
    read = df.select(key.alias(entity_key), *inputs)
    grouped = read.groupBy(entity)
    for i, halves in names_of.items():
        read = dictionaries.codes_by_name(read, i, halves, f"__code{i}")
    for name, column in own.items():
        (hashed if hashes(grouped, column) else sorted_)[name] = column

    # A row without an entity has a group of its own, but no features.
    def owned(features: dict[str, Column]) -> list[Column]:
        return [F.when(entity.isNotNull(), column).alias(name) for name, column in features.items()]

    wide_part = owned(hashed) + [column.alias(name) for name, column in helpers.items()]
    narrow_part = owned(sorted_)
    fused = read.groupBy(entity)
    if wide_part and narrow_part:
        wide = fused.agg(*wide_part).join(grouped.agg(*narrow_part), entity_key, "left")
    elif wide_part or narrow_part:
        wide = fused.agg(*wide_part, *narrow_part)
    else:
        wide = df.select(key.alias(entity_key)).distinct()
    for i in coded:
        place = maps.attributes[i].place_of(F.col(f"__dated{i}"))
        wide = dictionaries.values_by_code(wide.withColumn(f"__code{i}", place), i, f"__code{i}", f"__label{i}", f"__share{i}")
    if paired:
        pairs = latest_pairs(df, paired, key, entity_key)
        wide = wide.join(latest_codes(pairs, dictionaries, list(paired), entity), entity_key, "left")

    def finished(name: str) -> Column:
        if name not in encodings:
            return ref(name)
        feature, i = encodings[name]
        known = entity.isNotNull()
        if f"__seen{i}" in helpers:
            known = known & F.col(f"__seen{i}")
        label, share, labels = F.col(f"__label{i}"), F.col(f"__share{i}"), maps.attributes[i].labels
        return encoding_column(feature, label, share, known, labels, onehot == "array").alias(name)

    result = wide.select(entity, *[finished(name) for name in names])
    if onehot == "vector":
        for name, (feature, i) in encodings.items():
            if feature.method == "onehot":
                result = sparse_one_hot(result, name, maps.attributes[i].labels)
    return result


def entity_features(
    df: DataFrame,
    specs: Iterable[Mapping | Definition],
    entity_key: str,
    date_column: str | None,
    run_date: str | dt.date | None,
    *,
    cap_at_run_date: bool = False,
    exact_median: bool = False,
    onehot: str = "array",
) -> DataFrame:
    """One row per distinct entity key of ``df`` with every feature of every definition, in declaration order.

    Fitting (medians, category maps) runs small jobs right away; the returned DataFrame is lazy.

    ``cap_at_run_date`` leaves rows dated after ``run_date`` out of lookback windows (by default they count).
    ``onehot`` is ``"array"`` (ARRAY<DOUBLE>) or ``"vector"`` (sparse ML vector, for attributes with many labels).
    """
    distinct_keys(entity_key, date_column)
    if onehot not in ("array", "vector"):
        raise ValueError(f"onehot must be 'array' or 'vector'; got {onehot!r}")
    recipes = definitions(specs, entity_key)
    columns = df.columns
    for name in filter(None, (entity_key, date_column)):
        if name not in columns:
            raise ValueError(f"column {name!r} is missing from the input")
    day = None if run_date is None else as_run_date(run_date)
    if day is None and any(r.aggregations or r.time_windows or r.own for r in recipes):
        raise ValueError("run_date is required")

    views: dict[tuple, tuple[int, _Rows]] = {}
    members: list[tuple[int, Definition, _Rows]] = []
    chains = list(dict.fromkeys(recipe.null_handlers for recipe in recipes))
    for i, (chain, view) in enumerate(zip(chains, compile_all(df, chains, exact_median), strict=True)):
        views[chain] = (i, _Rows(view, date_column, day, cap_at_run_date, f"__in{i}_"))
    for recipe in recipes:
        view_id, rows = views[recipe.null_handlers]
        members.append((view_id, recipe, rows))

    attribute_of: dict[tuple[int, str], int] = {}
    sources: list[Source] = []
    for view_id, recipe, rows in members:
        for feature in recipe.encodings:
            name = feature.source_column
            if name in rows.view and (view_id, name) not in attribute_of:
                attribute_of[view_id, name] = len(sources)
                category = as_category(rows.view.columns[name], rows.view.types[name])
                sources.append(Source(category, rows.view.keep, _when(rows)))
    maps = fit_categories(df, sources) if sources else None

    def aggregated(part: list[tuple[int, Definition, _Rows]], key: Column) -> DataFrame:
        return _aggregate(df, part, key, entity_key, maps, attribute_of, onehot)

    moving = [m for m in members if entity_key in m[2].view.filled]
    result = aggregated([m for m in members if m not in moving], ref(entity_key))
    if not moving:
        return result
    # A null rule that rewrites the key itself moves rows to another entity: such a definition is grouped by the
    # rewritten key and joined back to the entities of the raw table.
    for member in moving:
        moved = aggregated([member], member[2].view.columns[entity_key])
        result = result.join(moved, entity_key, "left")
    order = [f.name for _, recipe, rows in members for f in recipe.features if present(f, rows.view)]
    return result.select(ref(entity_key), *[ref(name) for name in order])
