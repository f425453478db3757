"""Daily states: what a day's rows add to every feature, kept so that later runs need not read the rows again.

A state table has one row per entity and calendar day: row counts, and for each source column its count, sum, smallest and
largest value, mean and sum of squared deviations. States of different days merge, so the features of any window come from the
states of its days: a daily run reads one day of raw events and the states. Days that no window reaches any more are merged
into one row per entity, which all-time features still need, so the table has at most a row per entity and day of the longest
window, and one more.

The trend over days needs no further sums: all rows of a state share their day, so it weighs the day by its rows.

Null rules that fill a constant or drop rows belong to the states. A median changes from day to day, so definitions that impute
one have no states; neither have encodings and features of the caller's.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spineloom.functions.columns import as_run_date, calendar, numeric, ref
from spineloom.operators.nulls import Cleaned, compile_all
from spineloom.recipe import Aggregation, Definition, TimeWindow, definitions, distinct_keys

DAY = "__day"

# Which sums of a source column each feature needs.
_NEEDS = {
    "sum": ("sum",),
    "mean": ("sum", "reals"),
    "count": ("n",),
    "stddev": ("reals", "mean", "squares"),
    "min": ("min",),
    "max": ("max",),
    "rolling_mean": ("sum", "reals"),
    "rolling_slope": ("real",),
}
_NUMBERS = ("sum", "reals", "mean", "squares", "real")


class _Part(NamedTuple):
    """One column of the state table: a sum over the rows that chain ``chain`` of null rules keeps."""

    kind: str
    chain: int
    column: str = ""

    @property
    def name(self) -> str:
        return f"__{self.kind}_{self.chain}_{self.column}"


def _source(feature: Aggregation | TimeWindow) -> tuple[str, str]:
    """What a feature computes, and of which column."""
    return (feature.function if isinstance(feature, Aggregation) else feature.feature_type), feature.source_column


def _chains(recipes: Sequence[Definition]) -> list[tuple]:
    return list(dict.fromkeys(recipe.null_handlers for recipe in recipes))


def checked(specs: Iterable[Mapping | Definition], entity_key: str, date_column: str | None = None) -> tuple[Definition, ...]:
    """The definitions, if states can hold all of their features."""
    recipes = definitions(specs, entity_key)
    for recipe in recipes:
        if recipe.encodings or recipe.own:
            name = (*recipe.encodings, *recipe.own)[0].name
            raise ValueError(f"feature {name!r} has no daily states: only aggregations and time windows have")
        if any(rule.strategy == "median_impute" for rule in recipe.null_handlers):
            raise ValueError("a median changes from day to day: definitions that impute one have no daily states")
        for rule in recipe.null_handlers:
            if rule.column in (entity_key, date_column):
                raise ValueError(f"a null rule on {rule.column!r}, by which states are grouped, has no daily states")
    return recipes


def _members(recipes: Sequence[Definition]) -> list[tuple[int, Aggregation | TimeWindow]]:
    chains = _chains(recipes)
    return [(chains.index(recipe.null_handlers), feature) for recipe in recipes for feature in recipe.features]


def _parts(recipes: Sequence[Definition]) -> list[_Part]:
    parts = {_Part("rows", chain) for chain, _ in _members(recipes)}
    parts |= {_Part("last", chain) for chain, feature in _members(recipes) if _source(feature)[0] == "days_diff"}
    for chain, feature in _members(recipes):
        function, column = _source(feature)
        parts |= {_Part(kind, chain, column) for kind in _NEEDS.get(function, ())}
    return sorted(parts)


def _measured(part: _Part, view: Cleaned, kept: Column | None, day: Column) -> Column:
    """The part of a group of rows."""

    def of(value: Column) -> Column:
        return value if kept is None else F.when(kept, value)

    if part.kind == "rows":
        return F.count(of(F.lit(1)))
    if part.kind == "last":
        return F.max(of(day))
    value = view.columns[part.column]
    if part.kind in _NUMBERS:
        value = numeric(value, view.types[part.column])
    value = of(value)
    if part.kind in ("n", "reals"):
        return F.count(value)
    if part.kind == "mean":
        return F.avg(value.cast("double"))
    if part.kind == "squares":
        return F.var_pop(value.cast("double")) * F.count(value)
    if part.kind == "real":
        return F.sum(value.cast("double"))
    return {"sum": F.sum, "min": F.min, "max": F.max}[part.kind](value)


def day_states(
    df: DataFrame, specs: Iterable[Mapping | Definition], entity_key: str, date_column: str
) -> DataFrame:
    """The states of these rows: one row per entity and calendar day, rows without a date included."""
    distinct_keys(entity_key, date_column)
    recipes = checked(specs, entity_key, date_column)
    for name in (entity_key, date_column):
        if name not in df.columns:
            raise ValueError(f"column {name!r} is missing from the input")
    views = compile_all(df, _chains(recipes))
    for chain, feature in _members(recipes):
        if isinstance(feature, Aggregation) and feature.source_column not in views[chain]:
            raise ValueError(f"aggregation {feature.name!r} needs the missing column {feature.source_column!r}")
    columns: dict[str, Column] = {}
    for part in _parts(recipes):
        view = views[part.chain]
        if not part.column or part.column in view:  # a rolling feature over an absent column is left out
            day = F.to_date(calendar(view.columns[date_column], view.types[date_column]))
            columns[part.name] = _measured(part, view, view.keep, day)
    day = F.to_date(calendar(ref(date_column), df.schema[date_column].dataType))
    grouped = df.groupBy(ref(entity_key), day.alias(DAY))
    return grouped.agg(*[column.alias(name) for name, column in columns.items()])


def _centred(states: DataFrame, parts: Sequence[_Part], entity: Column) -> DataFrame:
    """With a value near the entity's own of each column whose squares are merged: deviations from it lose no digits when
    they are added."""
    own = Window.partitionBy(entity)
    centres = {}
    for part in parts:
        if part.kind == "squares":
            mean = ref(part._replace(kind="mean").name)
            finite = F.when(F.abs(mean) < float("inf"), mean)
            centres[part._replace(kind="centre").name] = F.coalesce(F.avg(finite).over(own), F.lit(0.0))
    return states.withColumns(centres) if centres else states


class _Merge:
    """Sums over state rows; ``inside`` picks the rows of a window, None all."""

    def __init__(self, inside: Column | None):
        self.inside = inside

    def of(self, value: Column) -> Column:
        return value if self.inside is None else F.when(self.inside, value)

    def total(self, part: _Part) -> Column:
        merge = {"min": F.min, "max": F.max, "last": F.max}.get(part.kind, F.sum)
        return merge(self.of(ref(part.name)))

    def mean(self, part: _Part) -> Column:
        n, mean, centre = (ref(part._replace(kind=kind).name) for kind in ("reals", "mean", "centre"))
        return F.max(centre) + F.sum(self.of((mean - centre) * n)) / F.nullif(F.sum(self.of(n)), F.lit(0))

    def squares(self, part: _Part) -> Column:
        """Squared deviations from the mean of the merged rows: within the states, and of their means."""
        n, mean, centre = (ref(part._replace(kind=kind).name) for kind in ("reals", "mean", "centre"))
        within = F.sum(self.of(ref(part.name)))
        apart = mean - centre
        between = F.sum(self.of(n * apart * apart))
        total = F.sum(self.of(n))
        off = F.sum(self.of(n * apart)) / F.nullif(total, F.lit(0))
        return F.greatest(within + between - total * off * off, F.lit(0.0))


def merge_states(
    states: DataFrame, specs: Iterable[Mapping | Definition], entity_key: str, keep_from: str | dt.date
) -> DataFrame:
    """The states with the days before ``keep_from`` merged into one row per entity, dated by the last of them.

    Windows that begin at ``keep_from`` or later, and all-time features, come out the same.
    """
    recipes = checked(specs, entity_key)
    parts = [part for part in _parts(recipes) if part.name in states.columns]
    entity = ref(entity_key)
    # Undated rows stay apart: they are part of no window, and what has no date has no last day.
    era = F.when(F.col(DAY) >= F.lit(as_run_date(keep_from)), F.struct(F.lit(True).alias("kept"), F.col(DAY).alias("day")))
    era = era.when(F.col(DAY).isNotNull(), F.struct(F.lit(False).alias("kept"), F.lit(None).cast("date").alias("day")))
    merge = _Merge(None)
    merged = [F.max(DAY).alias(DAY)]
    for part in parts:
        column = {"mean": merge.mean, "squares": merge.squares}.get(part.kind, merge.total)(part)
        merged.append(column.cast(states.schema[part.name].dataType).alias(part.name))
    grouped = _centred(states, parts, entity).groupBy(entity, era.alias("__era")).agg(*merged)
    return grouped.select(entity, DAY, *[ref(p.name) for p in parts])


def longest_window(specs: Iterable[Mapping | Definition], entity_key: str) -> int:
    """Days back that the features of these definitions look, all-time ones aside."""
    days = [0]
    for _, feature in _members(checked(specs, entity_key)):
        days.append((feature.lookback if isinstance(feature, TimeWindow) else feature.window_days) or 0)
    return max(days)


def _feature(
    feature: Aggregation | TimeWindow, chain: int, dropping: bool, day: dt.date, cap: bool, schema: T.StructType
) -> Column:
    function, column = _source(feature)
    part = _Part("", chain, column)
    if function == "days_diff":
        return F.datediff(F.lit(day), F.max(ref(_Part("last", chain).name)))
    days = feature.lookback if isinstance(feature, TimeWindow) else feature.window_days
    inside = None
    if days is not None:
        inside = F.col(DAY) >= F.lit(day - dt.timedelta(days=days))
        if cap:
            inside = inside & (F.col(DAY) <= F.lit(day))
    merge = _Merge(inside)
    rows = F.coalesce(merge.total(_Part("rows", chain)), F.lit(0))
    if function == "count":
        found = F.coalesce(merge.total(part._replace(kind="n")), F.lit(0))
        return found if inside is None and not dropping else F.when(rows > 0, found)
    if function in ("min", "max", "sum"):
        return merge.total(part._replace(kind=function)).cast(schema[part._replace(kind=function).name].dataType)
    if function == "rolling_slope":
        return _slope(merge, chain, part, day, days)
    n = F.coalesce(merge.total(part._replace(kind="reals")), F.lit(0))
    if function in ("mean", "rolling_mean"):
        total = merge.total(part._replace(kind="sum"))
        kind = schema[part._replace(kind="sum").name].dataType
        if isinstance(kind, T.DecimalType):  # the type that an average of the column has
            scale = T.DecimalType(min(38, kind.precision - 10 + 4), min(38, kind.scale + 4))
            return (total / F.nullif(n, F.lit(0)).cast("decimal(20,0)")).cast(scale)
        return total.cast("double") / F.nullif(n, F.lit(0))
    spread = F.sqrt(merge.squares(part._replace(kind="squares")) / (n - 1))
    return F.when(n > 1, spread)


def _slope(merge: _Merge, chain: int, part: _Part, day: dt.date, days: int) -> Column:
    """Least squares over rows, each state standing for its rows on one day; as ``ols_slope`` in all else."""
    x = F.datediff(F.col(DAY), F.lit(day - dt.timedelta(days=days))).cast("double")
    rows, y = ref(_Part("rows", chain).name), ref(part._replace(kind="real").name)
    n, sum_x, sum_xx = (F.sum(merge.of(rows * v)) for v in (F.lit(1), x, x * x))
    sum_y, sum_xy = F.sum(merge.of(y)), F.sum(merge.of(x * y))
    spread = n * sum_xx - sum_x * sum_x
    slope = F.when(spread != 0, (n * sum_xy - sum_x * sum_y) / spread).otherwise(F.lit(0.0))
    return F.when(n > 0, slope)


def features_from_states(
    states: DataFrame,
    specs: Iterable[Mapping | Definition],
    entity_key: str,
    run_date: str | dt.date,
    *,
    cap_at_run_date: bool = False,
) -> DataFrame:
    """What ``assemble_features`` gives for the rows behind the states: one row per entity, in declaration order."""
    recipes = checked(specs, entity_key)
    day = as_run_date(run_date)
    entity = ref(entity_key)
    chains = _chains(recipes)
    dropping = [any(rule.strategy == "drop" for rule in chain) for chain in chains]
    columns = []
    for chain, feature in _members(recipes):
        function, column = _source(feature)
        if all(_Part(kind, chain, column).name in states.columns for kind in _NEEDS.get(function, ())):
            value = _feature(feature, chain, dropping[chain], day, cap_at_run_date, states.schema)
            columns.append(F.when(entity.isNotNull(), value).alias(feature.name))
    if not columns:
        return states.select(entity).distinct()
    parts = [part for part in _parts(recipes) if part.name in states.columns]
    return _centred(states, parts, entity).groupBy(entity).agg(*columns)
