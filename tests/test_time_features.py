import datetime as dt

import pytest

import spineloom as sl

RUN = "2024-02-01"


def table(spark, rows):
    parsed = [(k, d and dt.date.fromisoformat(d), v) for k, d, v in rows]
    return spark.createDataFrame(parsed, "customer_id string, event_date date, amount double")


def times(df, kind, days=None, column="amount", run=RUN):
    spec = {"name": "f", "source_column": column, "feature_type": kind, "window_days": days}
    got = sl.time_features(df, [spec], "customer_id", "event_date", run)
    return {row["customer_id"]: row["f"] for row in got.collect()} if "f" in got.columns else got


@pytest.fixture(scope="module")
def sample(spark):
    """A pump that reported thrice in its last week, and a fan that fell silent at Christmas and came back once."""
    pump = [("pump", f"2024-01-{day}", load) for day, load in (("26", 6.0), ("29", 9.0), ("31", 3.0))]
    fan = [("fan", "2023-12-24", 40.0), ("fan", "2024-01-12", 8.0)]
    return table(spark, pump + fan)


def test_days_since_last(sample):
    assert times(sample, "days_diff", column="event_date") == {"pump": 1, "fan": 20}


def test_days_since_last_ignores_the_source_and_may_be_negative(sample):
    assert times(sample, "days_diff", column="nowhere", run="2024-01-14") == {"pump": -17, "fan": 2}


def test_days_since_last_without_any_date(spark):
    assert times(table(spark, [("a", None, 1.0)]), "days_diff") == {"a": None}


def test_rolling_mean_includes_the_cutoff_day(sample):
    for days in (7, None, 0):  # seven days are what a rolling mean without a window looks back
        assert times(sample, "rolling_mean", days) == {"pump": 6.0, "fan": None}
    assert times(sample, "rolling_mean", 6) == {"pump": 6.0, "fan": None}
    assert times(sample, "rolling_mean", 5) == {"pump": 6.0, "fan": None}
    assert times(sample, "rolling_mean", 3) == {"pump": 6.0, "fan": None}
    assert times(sample, "rolling_mean", 2) == {"pump": 3.0, "fan": None}


def test_slope_of_a_falling_line(spark):
    tank = [("tank", f"2024-01-{day:02}", 100.0 - 2.5 * day) for day in (4, 9, 16, 30)]
    assert times(table(spark, tank), "rolling_slope", 30)["tank"] == pytest.approx(-2.5)


def test_flat_slope_and_degenerate_slopes(spark):
    df = table(
        spark,
        [
            *[("flat", f"2024-01-{day}", -1.25) for day in (11, 12, 19, 27)],
            ("one row", "2024-01-15", 5.0),
            ("one day", "2024-01-15", 5.0),
            ("one day", "2024-01-15", 9.0),
            ("stale", "2020-01-15", 9.0),
            ("no value", "2024-01-15", None),
            ("no value", "2024-01-16", None),
        ],
    )
    got = times(df, "rolling_slope", 30)
    assert got.pop("flat") == pytest.approx(0.0, abs=1e-9)
    assert got == {"one row": 0.0, "one day": 0.0, "stale": None, "no value": None}


def test_slope_counts_rows_without_value(spark):
    """x = 0, 1, 3 and y = 1, -, 7: the row without y still weighs on n, sum(x) and sum(x*x)."""
    df = table(spark, [("a", "2024-01-02", 1.0), ("a", "2024-01-03", None), ("a", "2024-01-05", 7.0)])
    n, sx, sxx, sy, sxy = 3, 4, 10, 8, 21
    assert times(df, "rolling_slope", 30)["a"] == pytest.approx((n * sxy - sx * sy) / (n * sxx - sx * sx))


def test_rolling_feature_over_a_missing_column_is_left_out(sample):
    assert times(sample, "rolling_mean", column="nowhere").columns == ["customer_id"]
    assert times(sample, "rolling_slope", column="nowhere").columns == ["customer_id"]


def test_text_column_in_rolling_features(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 31), "s1"), ("b", dt.date(2024, 1, 31), "4")], "customer_id string, event_date date, amount string")
    assert times(df, "rolling_mean") == {"a": None, "b": 4.0}
    assert times(df, "rolling_slope") == {"a": 0.0, "b": 0.0}
