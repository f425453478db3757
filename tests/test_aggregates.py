import datetime as dt

import pytest
from pyspark.sql import functions as F

import spineloom as sl

RUN = "2024-02-01"


def by_key(df, key="customer_id"):
    return {row[key]: row.asDict() for row in df.collect()}


def agg(name, column, function, days=None):
    return {"name": name, "source_column": column, "function": function, "window_days": days}


def features(df, *specs, key="customer_id", date="event_date", run=RUN, **options):
    return sl.aggregate_features(df, specs, key, date, run, **options)


@pytest.fixture(scope="module")
def visits(spark):
    """Two ferries: crossings with their load; one crossing of the first lies a season back."""
    rows = [("north", f"2024-01-{day}", 10.0 * day, f"n{day}") for day in (4, 14, 24, 31)]
    rows += [("north", "2023-07-19", 1000.0, "summer"), ("south", "2023-12-30", 7.5, "last"), ("south", "2024-01-02", 2.5, None)]
    df = spark.createDataFrame(rows, "customer_id string, event_date string, amount double, session_id string")
    return df.withColumn("event_date", F.col("event_date").cast("date"))


def test_count_sum_mean(visits):
    specs = [agg("crossings", "session_id", "count"), agg("load_30d", "amount", "sum", 30), agg("mean", "amount", "mean")]
    got = by_key(features(visits, *specs))
    assert {c: (r["crossings"], r["load_30d"]) for c, r in got.items()} == {"north": (5, 730.0), "south": (1, 2.5)}
    assert got["north"]["mean"] == pytest.approx(1730 / 5) and got["south"]["mean"] == 5.0


def test_only_key_and_features_come_out(visits):
    assert features(visits, agg("n", "session_id", "count")).columns == ["customer_id", "n"]


def test_boundary_day_is_inside_and_later_days_too(spark):
    rows = [("a", "2024-01-01"), ("a", "2024-01-02"), ("a", "2024-02-01"), ("a", "2024-03-01")]
    df = spark.createDataFrame(rows, "customer_id string, day string").withColumn("event_date", F.col("day").cast("date"))
    spec = agg("n", "day", "count", 30)
    assert by_key(features(df, spec))["a"]["n"] == 3
    assert by_key(features(df, spec, cap_at_run_date=True))["a"]["n"] == 2


def test_window_of_zero_days_is_a_window(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 31), 1), ("a", dt.date(2024, 2, 1), 2)], "customer_id string, event_date date, x int")
    assert by_key(features(df, agg("x0", "x", "sum", 0)))["a"]["x0"] == 2


@pytest.mark.parametrize("function", ["sum", "mean", "count", "stddev", "min", "max"])
def test_no_row_in_window_is_null(spark, function):
    df = spark.createDataFrame([("c1", dt.date(2020, 1, 1), 10.0)], "customer_id string, event_date date, amount double")
    assert by_key(features(df, agg("f", "amount", function, 30)))["c1"]["f"] is None


def test_rows_without_value_count_as_zero_not_null(spark):
    rows = [("c1", dt.date(2024, 1, 30), None), ("c1", dt.date(2024, 1, 31), None)]
    df = spark.createDataFrame(rows, "customer_id string, event_date date, amount double")
    got = by_key(features(df, agg("n", "amount", "count", 30), agg("s", "amount", "sum", 30)))["c1"]
    assert got["n"] == 0
    assert got["s"] is None


def test_missing_key_appears_once_with_null_features(spark):
    rows = [(None, dt.date(2024, 1, 30), 1.0), (None, dt.date(2024, 1, 31), 2.0), ("a", dt.date(2024, 1, 31), 3.0)]
    df = spark.createDataFrame(rows, "customer_id string, event_date date, amount double")
    got = features(df, agg("n", "amount", "count"), agg("s", "amount", "sum", 7))
    assert got.count() == 2
    assert by_key(got)[None] == {"customer_id": None, "n": None, "s": None}


def test_row_without_date_counts_only_for_all_time(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", dt.date(2024, 1, 31), 2.0)], "customer_id string, event_date date, amount double")
    got = by_key(features(df, agg("all", "amount", "sum"), agg("week", "amount", "sum", 7)))["a"]
    assert (got["all"], got["week"]) == (3.0, 2.0)


def test_stddev_is_the_sample_one(spark):
    rows = [("a", dt.date(2024, 1, 31), float(x)) for x in (1, 2, 3, 4)] + [("b", dt.date(2024, 1, 31), 5.0)]
    df = spark.createDataFrame(rows, "customer_id string, event_date date, amount double")
    got = by_key(features(df, agg("sd", "amount", "stddev")))
    assert got["a"]["sd"] == pytest.approx((5 / 3) ** 0.5)
    assert got["b"]["sd"] is None


def test_result_types_follow_the_source(spark):
    df = spark.sql(
        "select 'a' as customer_id, date'2024-01-31' as event_date, 1 as i, cast(1.5 as decimal(10,2)) as d, 'x' as t"
    )
    got = features(
        df,
        agg("i_sum", "i", "sum"),
        agg("i_max", "i", "max"),
        agg("d_sum", "d", "sum"),
        agg("t_min", "t", "min"),
        agg("n", "i", "count"),
    )
    assert [t for _, t in got.dtypes] == ["string", "bigint", "int", "decimal(20,2)", "string", "bigint"]


def test_numbers_in_text_and_text_that_is_no_number(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 31), "s1"), ("b", dt.date(2024, 1, 31), "2.5")], "customer_id string, event_date date, t string")
    got = by_key(features(df, agg("mean", "t", "mean"), agg("last", "t", "max")))
    assert got["a"]["mean"] is None
    assert got["b"]["mean"] == 2.5
    assert got["a"]["last"] == "s1"


def test_timestamps_compare_with_midnight(spark):
    df = spark.sql(
        "select 'a' as customer_id, x.* from values (timestamp_ntz'2024-01-24 23:59:59', 1),"
        " (timestamp_ntz'2024-01-25 00:00:00', 2) as x(event_date, v)"
    )
    spec = agg("v", "v", "sum", 7)
    assert by_key(features(df, spec))["a"]["v"] == 2
    assert by_key(features(df.withColumn("event_date", F.col("event_date").cast("timestamp")), spec))["a"]["v"] == 2


def test_dates_as_text(spark):
    df = spark.createDataFrame([("a", "2024-01-24", 1), ("a", "2024-01-25", 2)], "customer_id string, event_date string, v int")
    assert by_key(features(df, agg("v", "v", "sum", 7)))["a"]["v"] == 2


def test_missing_column_is_an_error(visits):
    with pytest.raises(ValueError, match="nowhere"):
        features(visits, agg("x", "nowhere", "sum"))
    with pytest.raises(ValueError, match="missing from the input"):
        features(visits, agg("x", "amount", "sum"), key="nobody")


def test_run_date_is_required_and_checked(visits):
    with pytest.raises(ValueError, match="run_date"):
        features(visits, agg("x", "amount", "sum"), run=None)
    with pytest.raises(ValueError):
        features(visits, agg("x", "amount", "sum"), run="yesterday")


def test_awkward_column_names(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 31), 1.0, "x")], "`id.x` string, `the day` date, `a.b` double, `c``d` string")
    got = sl.assemble_features(
        df,
        [
            {
                "entity_type": "e",
                "null_handlers": [{"column": "a.b", "strategy": "fill", "fill_value": 0, "add_indicator": True}],
                "aggregations": [agg("s.um", "a.b", "sum", 7), agg("gaps", "a.b_was_null", "sum")],
                "encodings": [{"name": "l.abel", "source_column": "c`d", "method": "label"}],
                "time_windows": [{"name": "sl ope", "source_column": "a.b", "feature_type": "rolling_slope"}],
            }
        ],
        "id.x",
        "the day",
        RUN,
    )
    assert got.columns == ["id.x", "s.um", "gaps", "l.abel", "sl ope"]
    assert got.first() == ("a", 1.0, 0, 0.0, 0.0)
