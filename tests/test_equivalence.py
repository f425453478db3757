"""The fused plan against the one-join-per-feature plan, on the given tables and on awkward random ones."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest

import spineloom as sl
from checks.assembly import ACTIVITY, SPEND
from checks.cleaning import rule
from checks.encoding import encoding
from checks.fixtures import EVENTS_RUN_DATE, events_gaps
from checks.windows import agg, time
from tests.naive import naive_features

RUN = "2024-02-01"


def same(ours, theirs):
    assert ours.columns == theirs.columns
    assert ours.dtypes == theirs.dtypes
    left, right = ([tuple(r) for r in df.collect()] for df in (ours, theirs))
    assert len(left) == len(right)
    order = {repr(row[0]): row for row in right}
    for row in left:
        for name, a, b in zip(ours.columns, row, order[repr(row[0])], strict=True):
            close = isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-7)
            both_nan = isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b)
            assert a == b or close or both_nan, (row[0], name, a, b)


def test_recipes_on_events(spark):
    df = events_gaps(spark, "/root/testdata/sf0.001")
    args = ([ACTIVITY, SPEND], "user_id", "event_date", EVENTS_RUN_DATE)
    same(sl.assemble_features(df, *args, exact_median=True), naive_features(df, *args))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables(spark, seed):
    """A key with a third of all rows, missing keys, dates, values and categories, NaN, stale and future rows."""
    pick = random.Random(seed)

    def maybe(value, chance=0.15):
        return None if pick.random() < chance else value

    rows = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else maybe(f"k{pick.randint(0, 40)}", 0.1)
        day = maybe(dt.date(2024, 2, 1) - dt.timedelta(days=pick.choice([-3, 0, 1, 7, 8, 30, 31, 90, 400])))
        x = pick.choice([None, float("nan"), 1.5, -2.0, 10.0]) if key != "hot" else maybe(float(pick.randint(0, 9)))
        rows.append((key, day, x, maybe(pick.randint(-5, 5)), maybe(pick.choice("abcde"), 0.3)))
    df = spark.createDataFrame(rows, "k string, d date, x double, i int, t string").repartition(5)

    functions = ("sum", "mean", "count", "stddev", "min", "max")
    windows = (None, 0, 30)
    every = [
        agg(f"{f}_{c}_{w}", c, f, w) for f in functions for c in ("x", "i") for w in windows
    ] + [agg(f"{f}_t_{w}", "t", f, w) for f in ("count", "min", "max") for w in windows]
    plain = {
        "entity_type": "e",
        "aggregations": every,
        "encodings": [encoding("t_share", "t", "frequency"), encoding("t_label", "t", "label")],
        "time_windows": [
            time("days", "d", "days_diff"),
            time("mean_i", "i", "rolling_mean"),
            time("slope_i", "i", "rolling_slope", 90),
            time("slope_x", "x", "rolling_slope"),
        ],
    }
    dropping = {
        "entity_type": "e",
        "null_handlers": [
            rule("t", "drop"),
            rule("x", "median_impute", add_indicator=True),
            rule("i", "fill", 3, add_indicator=True),
        ],
        "aggregations": [
            agg("d_n", "x", "count"),
            agg("d_n30", "x", "count", 30),
            agg("d_sum", "x", "sum", 30),
            agg("d_flags", "x_was_null", "sum"),
            agg("d_flags_i", "i_was_null", "mean", 90),
        ],
        "encodings": [encoding("d_share", "t", "frequency")],
        "time_windows": [time("d_days", "d", "days_diff"), time("d_slope", "i", "rolling_slope", 90)],
    }
    same(
        sl.assemble_features(df, [plain, dropping], "k", "d", RUN, exact_median=True),
        _without_missing_label(naive_features(df, [plain, dropping], "k", "d", RUN)),
    )


def _without_missing_label(df):
    """The indexer labels the entity-less row like any unknown category; a row without an entity has no features."""
    from pyspark.sql import functions as F

    return df.withColumn("t_label", F.when(F.col("k").isNotNull(), F.col("t_label")))


def test_rerun_gives_the_same_rows(spark):
    df = events_gaps(spark, "/root/testdata/sf0.001")
    args = (df, [ACTIVITY], "user_id", "event_date", EVENTS_RUN_DATE)
    same(sl.assemble_features(*args), sl.assemble_features(*args))
