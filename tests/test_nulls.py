import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import spineloom as sl
from spineloom.operators import medians, nulls, ranking
from spineloom.operators.medians import approximate_medians, exact_medians

RUN = "2024-02-01"


def rules(*specs):
    return sl.definition({"entity_type": "e", "null_handlers": specs}).null_handlers


def clean(df, *specs, **options):
    return sl.handle_nulls(df, rules(*specs), **options)


def column(df, name, key="customer_id"):
    return {row[key]: row[name] for row in df.collect()}


@pytest.fixture(scope="module")
def gaps(spark):
    """Five hikers; two lack a distance, one a route."""
    rows = [("ann", 12.5, "ridge"), ("bo", None, "lake"), ("cy", 3.0, None), ("di", 21.0, "ridge"), ("ed", None, "lake")]
    rows += [("flo", 8.0, "lake")]
    return spark.createDataFrame(rows, "customer_id string, amount double, plan string")


def test_fill(gaps):
    got = clean(gaps, {"column": "plan", "strategy": "fill", "fill_value": "off road"})
    assert column(got, "plan") == column(gaps, "plan") | {"cy": "off road"}
    assert got.columns == gaps.columns


@pytest.mark.parametrize("exact", [True, False])
def test_median_is_the_lower_middle_value(gaps, exact):
    got = clean(gaps, {"column": "amount", "strategy": "median_impute"}, exact_median=exact)
    assert column(got, "amount") == column(gaps, "amount") | {"bo": 8.0, "ed": 8.0}


def test_drop(gaps):
    assert set(column(clean(gaps, {"column": "amount", "strategy": "drop"}), "amount")) == {"ann", "cy", "di", "flo"}


@pytest.mark.parametrize("strategy", ["fill", "median_impute"])
def test_indicator(gaps, strategy):
    got = clean(gaps, {"column": "amount", "strategy": strategy, "fill_value": 0, "add_indicator": True})
    assert {k for k, flag in column(got, "amount_was_null").items() if flag} == {"bo", "ed"}
    assert dict(got.dtypes)["amount_was_null"] == "int"


def test_missing_column_changes_nothing(gaps):
    got = clean(gaps, {"column": "nowhere", "strategy": "fill", "fill_value": 0, "add_indicator": True})
    assert got.columns == gaps.columns


def test_nan_is_filled_but_not_flagged(spark):
    df = spark.sql("select * from values ('a', double('NaN')), ('b', cast(null as double)), ('c', 1D) as t(customer_id, x)")
    got = clean(df, {"column": "x", "strategy": "fill", "fill_value": 7, "add_indicator": True})
    assert column(got, "x") == {"a": 7.0, "b": 7.0, "c": 1.0}
    assert column(got, "x_was_null") == {"a": 0, "b": 1, "c": 0}


@pytest.mark.parametrize("exact", [True, False])
def test_median_ignores_nan(spark, exact):
    df = spark.sql("select * from values ('a', double('NaN')), ('b', cast(null as double)), ('c', 1D), ('d', 3D), ('e', 2D) as t(customer_id, x)")
    got = clean(df, {"column": "x", "strategy": "median_impute"}, exact_median=exact)
    assert column(got, "x")["b"] == 2.0
    assert column(got, "x")["a"] == 2.0


@pytest.mark.parametrize("exact", [True, False])
def test_median_of_no_values_leaves_the_nulls(spark, exact):
    df = spark.createDataFrame([("a", None)], "customer_id string, x double")
    assert column(clean(df, {"column": "x", "strategy": "median_impute"}, exact_median=exact), "x") == {"a": None}


def test_values_are_cast_to_the_column(spark):
    df = spark.sql("select 'a' as customer_id, cast(null as int) as i, cast(null as string) as s, cast(null as decimal(9,2)) as d, cast(null as date) as t")
    got = clean(
        df,
        {"column": "i", "strategy": "fill", "fill_value": 2.7},
        {"column": "s", "strategy": "fill", "fill_value": 0},
        {"column": "d", "strategy": "fill", "fill_value": 1.5},
        {"column": "t", "strategy": "fill", "fill_value": "2024-01-01"},
    )
    assert got.schema == df.schema or got.dtypes == df.dtypes
    row = got.first()
    assert (row["i"], row["s"], str(row["d"]), row["t"]) == (2, "0", "1.50", dt.date(2024, 1, 1))


def test_impossible_rules(spark):
    df = spark.sql("select 'a' as k, 1D as x, array(1) as xs, date'2024-01-01' as d")
    with pytest.raises(ValueError, match="does not fit"):
        clean(df, {"column": "x", "strategy": "fill", "fill_value": "unknown"})
    with pytest.raises(ValueError, match="cannot be filled"):
        clean(df, {"column": "xs", "strategy": "fill", "fill_value": 0})
    for name in ("k", "d"):
        with pytest.raises(ValueError, match="numeric column"):
            clean(df, {"column": name, "strategy": "median_impute"})


def test_rules_apply_in_order(spark):
    rows = [("a", 1.0, "x"), ("b", 2.0, "x"), ("c", 100.0, None), ("d", 200.0, None), ("e", None, "x")]
    df = spark.createDataFrame(rows, "customer_id string, v double, t string")
    median = {"column": "v", "strategy": "median_impute"}
    drop = {"column": "t", "strategy": "drop"}
    assert column(clean(df, drop, median), "v") == {"a": 1.0, "b": 2.0, "e": 1.0}
    assert column(clean(df, median, drop), "v") == {"a": 1.0, "b": 2.0, "e": 2.0}
    # After imputation there is nothing left to drop, and a second indicator finds no null.
    twice = clean(df, {**median, "add_indicator": True}, {"column": "v", "strategy": "drop", "add_indicator": True})
    assert column(twice, "v")["e"] == 2.0
    assert column(twice, "v_was_null")["e"] == 0


def test_independent_medians_share_one_pass(gaps, monkeypatch):
    passes = []

    def spy(df, values):
        passes.append(list(values))
        return approximate_medians(df, values)

    monkeypatch.setattr(nulls, "approximate_medians", spy)
    df = gaps.withColumns({"b": F.col("amount") * 2, "c": F.col("amount") * 3})
    median = [{"column": name, "strategy": "median_impute"} for name in ("amount", "b", "c")]
    clean(df, median[0], {"column": "plan", "strategy": "drop"}, *median[1:])
    assert passes == [["amount", "b", "c"]]
    passes.clear()
    # A drop on an imputed column needs that median first.
    clean(df, median[0], {"column": "amount", "strategy": "drop"}, median[1])
    assert passes == [["amount"], ["b"]]


def lower_median(values):
    present = sorted(x for x in values if x is not None)
    return present[(len(present) + 1) // 2 - 1] if present else None


def test_medians_are_exact_for_mixed_columns(spark):
    pick = random.Random(5)
    rows = [(pick.choice([None, float(pick.randint(0, 40)), pick.random() * 40]), pick.randint(0, 3)) for _ in range(997)]
    df = spark.createDataFrame(rows, "x double, few int").repartition(5)
    values = {"x": F.col("x"), "few": F.col("few").cast("double"), "none": F.lit(None).cast("double")}
    expected = {"x": lower_median(x for x, _ in rows), "few": float(lower_median(f for _, f in rows)), "none": None}
    assert exact_medians(df, values) == expected


EXTREMES = {
    "neighbours": [1.0 + k * 2.0**-52 for k in range(101)],
    "far apart": [-1.7e308, 1.7e308, 3.0, 1e-300, -1e300],
    "infinite": [float("inf")] * 3 + [float("-inf")] * 3 + [7.0],
    "mostly infinite": [float("-inf")] * 5 + [1.0, 2.0],
    "smallest": [5e-324 * k for k in range(-3, 9)],
    "zeros": [0.0, -0.0, 0.0, -1.0, 1.0],
    "negative": [-(1.1**k) for k in range(64)],
    "one": [42.5],
    "magnitudes in one bracket": [1e15 + 0.125 * k for k in range(50)] + [1.0] * 20,
}


@pytest.mark.parametrize("name", EXTREMES)
def test_medians_of_extreme_doubles(spark, name):
    df = spark.createDataFrame([(x,) for x in EXTREMES[name]], "x double").repartition(3)
    assert exact_medians(df, {"x": F.col("x")})["x"] == lower_median(EXTREMES[name])


def test_approximate_medians_do_not_depend_on_the_layout(spark):
    pick = random.Random(11)
    rows = [(pick.lognormvariate(3, 2), pick.choice([None, 0.5, 1.5]), pick.gauss(0, 1)) for _ in range(4000)]
    columns = {c: F.col(c) for c in "xyz"}
    df = spark.createDataFrame(rows, "x double, y double, z double")
    layouts = [df.coalesce(1), df.repartition(7), df.repartitionByRange(5, "x"), df.repartition(3, "y"), df.sort("z")]
    found = [approximate_medians(layout, columns) for layout in layouts]
    assert all(f == found[0] for f in found)
    for i, c in enumerate("xyz"):
        present = [r[i] for r in rows if r[i] is not None]
        assert found[0][c] in present
        below, reached = (sum(test(x, found[0][c]) for x in present) for test in (float.__lt__, float.__le__))
        assert below <= (0.5 + medians.RANK_ERROR) * len(present)
        assert reached >= (0.5 - medians.RANK_ERROR) * len(present)


def test_median_passes_move_counts_only(spark, monkeypatch):
    """No pass has more rows than cells, and few passes are needed, whatever the number of distinct values."""
    df = spark.range(300_000).select((F.hash("id") / 7.0).alias("x"))
    passes = []
    narrowed = medians._narrowed

    def spy(df, values, brackets):
        found = narrowed(df, values, brackets)
        passes.append(found[0].inside)
        return found

    monkeypatch.setattr(medians, "_narrowed", spy)
    assert exact_medians(df, {"x": F.col("x")})["x"] == df.approxQuantile("x", [0.5], 0.0)[0]
    assert len(passes) <= 4
    assert passes[-1] == 1


def test_ranks_over_slices(spark):
    df = spark.createDataFrame([(g, i, i + 1) for g in "ab" for i in range(57)], "g string, i int, w int")
    for limit in (1000, 10, 1):
        got = ranking.ranks(df, "g", [F.col("i").desc()], 114, "before", rows_per_slice=limit)
        assert got.columns == ["g", "i", "w", "before"] and dict(got.dtypes)["before"] == "bigint"
        assert sorted((r.g, r.i, r.before) for r in got.collect()) == [(g, i, 56 - i) for g in "ab" for i in range(57)]


def test_filled_key_moves_rows_to_that_entity(spark):
    """Rows without a key go to the entity the rule names if it exists; a new one does not join the spine."""
    rows = [("a", dt.date(2024, 1, 31), 1.0), (None, dt.date(2024, 1, 31), 2.0)]
    df = spark.createDataFrame(rows, "customer_id string, event_date date, amount double")

    def total(value):
        spec = {
            "entity_type": "e",
            "null_handlers": [{"column": "customer_id", "strategy": "fill", "fill_value": value}],
            "aggregations": [{"name": "total", "source_column": "amount", "function": "sum"}],
        }
        raw = {"entity_type": "e", "aggregations": [{"name": "n", "source_column": "amount", "function": "count"}]}
        got = sl.assemble_features(df, [spec, raw], "customer_id", "event_date", RUN)
        assert got.columns == ["customer_id", "total", "n"]
        return {row["customer_id"]: (row["total"], row["n"]) for row in got.collect()}

    assert total("a") == {"a": (3.0, 1), None: (None, None)}
    assert total("new") == {"a": (1.0, 1), None: (None, None)}


def test_dropped_entities_stay_without_features(spark):
    rows = [("a", dt.date(2024, 1, 31), 1.0, "x"), ("b", dt.date(2024, 1, 31), None, "y")]
    df = spark.createDataFrame(rows, "customer_id string, event_date date, amount double, plan string")
    spec = {
        "entity_type": "e",
        "null_handlers": [{"column": "amount", "strategy": "drop"}],
        "aggregations": [{"name": "n", "source_column": "plan", "function": "count"}],
        "encodings": [
            {"name": "label", "source_column": "plan", "method": "label"},
            {"name": "share", "source_column": "plan", "method": "frequency"},
        ],
        "time_windows": [{"name": "days", "source_column": "", "feature_type": "days_diff"}],
    }
    spec["time_windows"][0]["source_column"] = "event_date"
    got = sl.assemble_features(df, [spec], "customer_id", "event_date", RUN)
    assert sorted(got.collect()) == [("a", 1, 0.0, 1.0, 1), ("b", None, None, None, None)]


@pytest.mark.parametrize(
    ("dtype", "good", "bad"),
    [
        ("date", "2024-02-29", "unknown"),
        ("timestamp", "2024-02-29 10:00:00", "noon"),
        ("int", "7", "1.5"),
        ("int", 2**31 - 1, 2**31),
        ("bigint", -(2**63), 2**63),
        ("tinyint", 127, 128),
        ("boolean", "yes", "perhaps"),
        ("decimal(4,2)", 99.99, 100),
        ("double", "1e9", "many"),
    ],
)
def test_fills_are_checked_for_every_type(spark, dtype, good, bad):
    df = spark.sql(f"select 1 as id, cast(null as {dtype}) as x")
    fill = {"column": "x", "strategy": "fill"}
    assert clean(df, {**fill, "fill_value": good}).first()["x"] is not None
    with pytest.raises(ValueError, match="does not fit"):
        clean(df, {**fill, "fill_value": bad})


def test_medians_of_several_definitions_take_one_pass(spark, monkeypatch):
    passes = []
    fit = nulls.approximate_medians
    monkeypatch.setattr(nulls, "approximate_medians", lambda df, values: passes.append(list(values)) or fit(df, values))
    df = spark.createDataFrame([(1, 1.0, None), (2, None, 4.0), (3, 5.0, 6.0)], "id int, x double, y double")
    chains = [rules({"column": c, "strategy": "median_impute"}) for c in ("x", "y", "x")]
    first, second, third = nulls.compile_all(df, chains)
    assert passes == [["x", "y", "x of chain 2"]]
    values = df.select(first.columns["x"].alias("a"), second.columns["y"].alias("b"), third.columns["x"].alias("c")).collect()
    assert [tuple(r) for r in values] == [(1.0, 4.0, 1.0), (1.0, 4.0, 1.0), (5.0, 6.0, 5.0)]
