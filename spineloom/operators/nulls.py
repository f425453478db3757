"""Null rules compiled to column expressions.

The rules of one definition become a set of derived columns plus one keep-this-row predicate over the raw table. That
lets several definitions with different rules share a single scan and a single aggregation.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Generator, Iterable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spineloom.functions.columns import fill_null, real_number, ref
from spineloom.operators.medians import approximate_medians, exact_medians
from spineloom.recipe import NullRule

logger = logging.getLogger(__name__)


@dataclass
class Cleaned:
    """How to read a raw table once the null rules have been applied."""

    columns: dict[str, Column]
    types: dict[str, T.DataType]
    keep: Column | None = None
    filled: set[str] = field(default_factory=set)

    def __contains__(self, name: str) -> bool:
        return name in self.columns


def _check_fillable(rule: NullRule, dtype: T.DataType) -> None:
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        raise ValueError(f"column {rule.column!r} of type {dtype.simpleString()} cannot be filled with a constant")
    try:
        fits = _fits(rule.fill_value, dtype)
    except (ValueError, TypeError, ArithmeticError):
        fits = False
    if not fits:
        raise ValueError(
            f"fill_value {rule.fill_value!r} does not fit the {dtype.simpleString()} column {rule.column!r}"
        )


_INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _fits(value, dtype: T.DataType) -> bool:
    """Whether the constant can be cast to the type; parsing errors mean no as well."""
    if type(dtype) in _INTEGER_BITS:
        number = int(value)
        return -(2 ** (_INTEGER_BITS[type(dtype)] - 1)) <= number < 2 ** (_INTEGER_BITS[type(dtype)] - 1)
    if isinstance(dtype, T.DecimalType):
        return abs(Decimal(str(value))) < 10 ** (dtype.precision - dtype.scale)
    if isinstance(dtype, T.NumericType):
        float(value)
        return True
    if isinstance(dtype, T.BooleanType):
        return not isinstance(value, str) or value.strip().lower() in _BOOLEANS
    if isinstance(dtype, T.DateType):
        return isinstance(value, dt.date) or bool(dt.datetime.fromisoformat(value))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return isinstance(value, (dt.date, dt.datetime)) or bool(dt.datetime.fromisoformat(value))
    return True


# What Spark reads as a boolean.
_BOOLEANS = frozenset("t true y yes 1 f false n no 0".split())


def _compile(df: DataFrame, rules: Iterable[NullRule]) -> Generator[dict[str, Column], dict[str, float | None], Cleaned]:
    """Fold the rules in order. Yields the expressions whose medians are needed next and is sent those medians."""
    view = Cleaned(
        columns={f.name: ref(f.name) for f in df.schema.fields},
        types={f.name: f.dataType for f in df.schema.fields},
    )
    waiting: dict[str, Column] = {}

    def settle(medians: dict[str, float | None]) -> None:
        for name, median in medians.items():
            if median is None:
                logger.warning("column %r holds no value to take a median of; its nulls stay", name)
            else:
                view.columns[name] = fill_null(view.columns[name], view.types[name], median)
        waiting.clear()

    for rule in rules:
        if rule.column not in view:
            continue
        flag = f"{rule.column}_was_null"
        if rule.column in waiting or (rule.add_indicator and flag in waiting):
            settle((yield dict(waiting)))
        value, dtype = view.columns[rule.column], view.types[rule.column]
        if rule.add_indicator:
            view.columns[flag] = value.isNull().cast("int")
            view.types[flag] = T.IntegerType()
        if rule.strategy == "fill":
            _check_fillable(rule, dtype)
            view.columns[rule.column] = fill_null(value, dtype, rule.fill_value)
            view.filled.add(rule.column)
        elif rule.strategy == "median_impute":
            if not isinstance(dtype, T.NumericType):
                raise ValueError(
                    f"median_impute needs a numeric column; {rule.column!r} is {dtype.simpleString()}"
                )
            operand = real_number(value, dtype)
            waiting[rule.column] = operand if view.keep is None else F.when(view.keep, operand)
            view.filled.add(rule.column)
        else:
            present = value.isNotNull()
            view.keep = present if view.keep is None else view.keep & present
    if waiting:
        settle((yield dict(waiting)))
    return view


def compile_all(df: DataFrame, chains: Sequence[Iterable[NullRule]], exact_median: bool = False) -> list[Cleaned]:
    """Compile several chains of rules over one table, each rule seeing the result of the ones before it in its chain.

    Rules on absent columns are skipped. Medians are fitted here (a job that returns one number per column); all that
    wait at the same step, of whatever chain, share one pass over the table.
    """
    fit = exact_medians if exact_median else approximate_medians
    running = {i: _compile(df, rules) for i, rules in enumerate(chains)}
    views: dict[int, Cleaned] = {}
    answers: dict[int, dict | None] = dict.fromkeys(running)
    while running:
        asked: dict[int, dict[str, Column]] = {}
        for i, chain in list(running.items()):
            try:
                asked[i] = chain.send(answers[i])
            except StopIteration as done:
                views[i] = done.value
                del running[i]
        if asked:
            keys: dict[str, tuple[int, str]] = {}
            for i, values in asked.items():
                for name in values:
                    keys[name if name not in keys else f"{name} of chain {i}"] = (i, name)
            found = fit(df, {key: asked[i][name] for key, (i, name) in keys.items()})
            answers = {i: {} for i in asked}
            for key, (i, name) in keys.items():
                answers[i][name] = found[key]
    return [views[i] for i in range(len(views))]


def compile_nulls(df: DataFrame, rules: Iterable[NullRule], exact_median: bool = False) -> Cleaned:
    """One chain of rules compiled to column expressions."""
    return compile_all(df, [rules], exact_median)[0]


def handle_nulls(df: DataFrame, rules: Iterable[NullRule], exact_median: bool = False) -> DataFrame:
    """Apply null rules to a table: original columns in place, indicator columns appended."""
    view = compile_nulls(df, rules, exact_median)
    kept = df if view.keep is None else df.where(view.keep)
    return kept.select(*[column.alias(name) for name, column in view.columns.items()])
