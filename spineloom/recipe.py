"""Feature recipes: plain dicts (as parsed from YAML or JSON) checked into immutable specs.

A definition has four lists::

    {"entity_type": "customer",
     "null_handlers": [{"column": "amount", "strategy": "median_impute", "add_indicator": True}],
     "aggregations":  [{"name": "spend_30d", "source_column": "amount", "function": "sum", "window_days": 30}],
     "encodings":     [{"name": "plan_share", "source_column": "plan", "method": "frequency"}],
     "time_windows":  [{"name": "trend", "source_column": "amount", "feature_type": "rolling_slope",
                        "window_days": 30}]}

Every mistake surfaces as a ``ValueError`` before any Spark job starts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

# The names a recipe may use.
AGGREGATE_FUNCTIONS = ("sum", "mean", "count", "stddev", "min", "max")
ENCODING_METHODS = ("frequency", "label", "onehot")
TIME_FEATURES = ("days_diff", "rolling_mean", "rolling_slope")
NULL_STRATEGIES = ("fill", "median_impute", "drop")
INPUT_FORMATS = ("csv", "parquet")

# Lookback in days of a rolling feature that names none (0 counts as none).
DEFAULT_LOOKBACK = {"rolling_mean": 7, "rolling_slope": 30}


#: Columns that the feature store adds, and the start of the names of helper columns.
RESERVED = ("date", "entity_type", "run")
HELPERS = "__"


def _one_of(value: str, allowed: tuple[str, ...], what: str) -> None:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}; got {value!r}")


def _named(value, what: str) -> None:
    if not isinstance(value, str) or not value:
        raise ValueError(f"{what} must be a non-empty string; got {value!r}")


def _days(value) -> int | None:
    if value is None:
        return None
    if isinstance(value, bool) or int(value) != float(value):
        raise ValueError(f"window_days must be a whole number of days; got {value!r}")
    return int(value)


@dataclass(frozen=True)
class NullRule:
    column: str
    strategy: str
    fill_value: str | float | int | None = None
    add_indicator: bool = False

    def __post_init__(self):
        _named(self.column, "null handler column")
        _one_of(self.strategy, NULL_STRATEGIES, "null strategy")
        if self.strategy == "fill" and self.fill_value is None:
            raise ValueError(f"null handler for {self.column!r} fills but names no fill_value")


@dataclass(frozen=True)
class Aggregation:
    name: str
    source_column: str
    function: str
    window_days: int | None = None

    def __post_init__(self):
        _named(self.name, "feature name")
        _named(self.source_column, "source_column")
        _one_of(self.function, AGGREGATE_FUNCTIONS, "aggregation function")
        object.__setattr__(self, "window_days", _days(self.window_days))


@dataclass(frozen=True)
class Encoding:
    name: str
    source_column: str
    method: str

    def __post_init__(self):
        _named(self.name, "feature name")
        _named(self.source_column, "source_column")
        _one_of(self.method, ENCODING_METHODS, "encoding method")


@dataclass(frozen=True)
class TimeWindow:
    name: str
    source_column: str
    feature_type: str
    window_days: int | None = None

    def __post_init__(self):
        _named(self.name, "feature name")
        _named(self.source_column, "source_column")
        _one_of(self.feature_type, TIME_FEATURES, "time feature")
        object.__setattr__(self, "window_days", _days(self.window_days))

    @property
    def lookback(self) -> int | None:
        return self.window_days or DEFAULT_LOOKBACK.get(self.feature_type)


@dataclass(frozen=True)
class OwnFeature:
    """A feature of the caller's: ``column`` takes the feature's rows (``FeatureRows``) and returns an aggregate over them,
    which is computed along with all others."""

    name: str
    column: Callable
    window_days: int | None = None

    def __post_init__(self):
        _named(self.name, "feature name")
        if not callable(self.column):
            raise ValueError(f"the column of feature {self.name!r} must be a function of its rows")
        object.__setattr__(self, "window_days", _days(self.window_days))


@dataclass(frozen=True)
class Definition:
    entity_type: str
    aggregations: tuple[Aggregation, ...] = ()
    encodings: tuple[Encoding, ...] = ()
    time_windows: tuple[TimeWindow, ...] = ()
    null_handlers: tuple[NullRule, ...] = ()
    own: tuple[OwnFeature, ...] = ()

    @property
    def features(self) -> tuple[Aggregation | Encoding | TimeWindow | OwnFeature, ...]:
        """All features in declaration order."""
        return (*self.aggregations, *self.encodings, *self.time_windows, *self.own)


@dataclass(frozen=True)
class Settings:
    """What one daily run needs to know besides the recipe; paths may be on any filesystem Spark can reach."""

    pipeline_name: str
    entity_type: str
    entity_key: str
    date_column: str
    run_date: str
    raw_path: str
    store_path: str
    registry_path: str
    input_format: str = "parquet"
    max_null_rate: float = 0.05
    min_row_count: int = 1
    lookback_days: int | None = None
    schema: str | None = None
    required: tuple[str, ...] = ()
    expected_types: Mapping[str, str] | None = None
    #: Where the raw day is landed as checked Parquet; None: the raw files are read as they are.
    landing_path: str | None = None

    def __post_init__(self):
        distinct_keys(self.entity_key, self.date_column)
        _one_of(self.input_format, INPUT_FORMATS, "input_format")


def distinct_keys(entity_key: str, date_column: str | None) -> None:
    if entity_key == date_column:
        raise ValueError("entity_key and date_column must be different columns")


def _specs(kind: type, rows: Iterable[Mapping | object] | None) -> tuple:
    parsed = []
    for row in rows or ():
        if isinstance(row, kind):
            parsed.append(row)
            continue
        known = {key: value for key, value in row.items() if key in kind.__dataclass_fields__}
        try:
            parsed.append(kind(**known))
        except TypeError as missing:
            raise ValueError(f"incomplete {kind.__name__} entry {dict(row)!r}: {missing}") from None
    return tuple(parsed)


def definition(spec: Mapping | Definition) -> Definition:
    """Check one feature definition given as a mapping; unknown keys are ignored."""
    if isinstance(spec, Definition):
        return spec
    if not spec.get("entity_type"):
        raise ValueError("a feature definition needs an entity_type")
    return Definition(
        entity_type=spec["entity_type"],
        aggregations=_specs(Aggregation, spec.get("aggregations")),
        encodings=_specs(Encoding, spec.get("encodings")),
        time_windows=_specs(TimeWindow, spec.get("time_windows")),
        null_handlers=_specs(NullRule, spec.get("null_handlers")),
        own=_specs(OwnFeature, spec.get("own")),
    )


def definitions(specs: Iterable[Mapping | Definition], entity_key: str) -> tuple[Definition, ...]:
    """Check several definitions together: feature names must be unique and differ from the entity key."""
    parsed = tuple(definition(spec) for spec in specs)
    seen = {entity_key.lower()}
    for feature in (f for d in parsed for f in d.features):
        if feature.name.lower() in seen:
            raise ValueError(f"feature name {feature.name!r} is used more than once")
        if feature.name.lower() in RESERVED or feature.name.startswith(HELPERS):
            raise ValueError(f"feature name {feature.name!r} is reserved")
        seen.add(feature.name.lower())
    return parsed
