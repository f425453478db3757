import pytest
from pyspark.sql import functions as F

import spineloom as sl


def agg(**changes):
    return {"name": "n", "source_column": "c", "function": "count", **changes}


def parse(**lists):
    return sl.definition({"entity_type": "customer", **lists})


@pytest.mark.parametrize("function", ["median", "SUM", "", None])
def test_unknown_aggregate_function(function):
    with pytest.raises(ValueError, match="aggregation function"):
        parse(aggregations=[agg(function=function)])


def test_unknown_encoding_time_feature_and_strategy():
    with pytest.raises(ValueError, match="encoding method"):
        parse(encodings=[{"name": "e", "source_column": "c", "method": "target"}])
    with pytest.raises(ValueError, match="time feature"):
        parse(time_windows=[{"name": "t", "source_column": "c", "feature_type": "lag"}])
    with pytest.raises(ValueError, match="null strategy"):
        parse(null_handlers=[{"column": "c", "strategy": "ffill"}])


def test_incomplete_entries():
    with pytest.raises(ValueError, match="source_column"):
        parse(aggregations=[{"name": "n", "function": "count"}])
    with pytest.raises(ValueError, match="entity_type"):
        sl.definition({"aggregations": []})
    with pytest.raises(ValueError, match="fill_value"):
        parse(null_handlers=[{"column": "c", "strategy": "fill"}])


def test_window_days_are_whole_days():
    assert parse(aggregations=[agg(window_days="30")]).aggregations[0].window_days == 30
    for bad in (1.5, "soon", True):
        with pytest.raises(ValueError):
            parse(aggregations=[agg(window_days=bad)])


def test_defaults_and_unknown_keys():
    recipe = parse(aggregations=[agg(comment="ignored")], time_windows=None)
    assert recipe.aggregations[0].window_days is None
    assert recipe.time_windows == ()


def test_default_lookback_of_rolling_features():
    def lookback(kind, days=None):
        return sl.TimeWindow("t", "c", kind, days).lookback

    assert lookback("rolling_mean") == 7
    assert lookback("rolling_slope") == 30
    assert lookback("rolling_mean", 0) == 7
    assert lookback("rolling_mean", 3) == 3


def test_duplicate_feature_names():
    with pytest.raises(ValueError, match="more than once"):
        sl.definitions([{"entity_type": "a", "aggregations": [agg()]}, {"entity_type": "b", "aggregations": [agg()]}], "id")
    with pytest.raises(ValueError, match="more than once"):
        sl.definitions([{"entity_type": "a", "aggregations": [agg(name="ID")]}], "id")


def test_key_and_date_must_differ():
    with pytest.raises(ValueError, match="different columns"):
        sl.Settings("p", "e", "id", "id", "2024-01-01", "raw", "store", "registry")
    with pytest.raises(ValueError, match="input_format"):
        sl.Settings("p", "e", "id", "day", "2024-01-01", "raw", "store", "registry", input_format="json")


def test_own_features_join_the_aggregation(spark):
    rows = [("a", "2024-01-30", 2.0), ("a", "2024-01-31", None), ("a", "2023-01-01", 50.0), ("b", "2023-01-01", 7.0)]
    df = spark.createDataFrame(rows, "k string, d string, x double").withColumn("d", F.col("d").cast("date"))
    spread = {"name": "spread", "column": lambda r: F.max(r.value("x")) - F.min(r.value("x"))}
    spec = {
        "entity_type": "e",
        "null_handlers": [{"column": "x", "strategy": "fill", "fill_value": 6}],
        "aggregations": [{"name": "n", "source_column": "x", "function": "count"}],
        "own": [spread, {**spread, "name": "spread_7d", "window_days": 7}, {"name": "last", "column": lambda r: F.max(r.date())}],
    }
    got = {r["k"]: tuple(r)[1:4] for r in sl.assemble_features(df, [spec], "k", "d", "2024-02-01").collect()}
    assert got == {"a": (3, 48.0, 4.0), "b": (1, 0.0, None)}
    text = sl.assemble_features(df, [spec], "k", "d", "2024-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError, match="function of its rows"):
        sl.definition({"entity_type": "e", "own": [{"name": "x", "column": "amount"}]})
    with pytest.raises(ValueError, match="no column 'y'"):
        sl.assemble_features(df, [{"entity_type": "e", "own": [{"name": "z", "column": lambda r: F.max(r.value("y"))}]}], "k", "d", "2024-02-01")
