"""Daily states against the scan of all rows."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import spineloom as sl
from checks.cleaning import rule
from checks.windows import agg, time
from tests.test_equivalence import same
from tests.test_storage import settings

RUN = dt.date(2024, 2, 1)
FUNCTIONS = ("sum", "mean", "count", "stddev", "min", "max")
PLAIN = {
    "entity_type": "boat",
    "aggregations": [agg(f"{f}_{c}_{w}", c, f, w) for f in FUNCTIONS for c in ("x", "i", "m") for w in (None, 0, 7, 30)]
    + [agg(f"{f}_t_{w}", "t", f, w) for f in ("count", "min", "max", "sum", "mean") for w in (None, 7)],
    "time_windows": [
        time("days", "d", "days_diff"),
        time("week", "x", "rolling_mean"),
        time("trend", "x", "rolling_slope"),
        time("trend_7", "i", "rolling_slope", 7),
        time("nowhere", "absent", "rolling_mean"),
    ],
}
RULED = {
    "entity_type": "boat",
    "null_handlers": [rule("x", "fill", 1.5, add_indicator=True), rule("i", "drop")],
    "aggregations": [
        agg("kept", "i", "count"),
        agg("kept_7", "i", "count", 7),
        agg("filled", "x", "mean", 30),
        agg("gaps", "x_was_null", "sum", 30),
        agg("spread", "x", "stddev"),
    ],
    "time_windows": [time("days_kept", "d", "days_diff"), time("slope_kept", "x", "rolling_slope")],
}


def log(spark, seed=3):
    """A key with a third of all rows; missing keys, days and values; NaN; stale and future rows."""
    pick = random.Random(seed)

    def maybe(value, chance=0.15):
        return None if pick.random() < chance else value

    rows = []
    for k in range(700):
        key = "hot" if k % 3 == 0 else maybe(f"b{pick.randint(0, 30)}", 0.1)
        day = maybe(RUN - dt.timedelta(days=pick.choice([-3, 0, 1, 2, 5, 7, 8, 30, 31, 90, 400])))
        x = pick.choice([None, 1e4 + pick.random(), 1e4 - 2.0]) if key != "b1" else maybe(float("nan"), 0.6)
        text = maybe(pick.choice(["a", "zz", "17", "3.5"]))
        rows.append((key, day, x, maybe(pick.randint(-5, 5)), maybe(Decimal(pick.randint(-999, 999)) / 100), text))
    return spark.createDataFrame(rows, "k string, d date, x double, i int, m decimal(9,2), t string").repartition(5)


def by_era(df):
    """Three batches that arrive one after the other, late rows included."""
    batch = F.pmod(F.hash("d", "x", "i"), F.lit(3))
    return [df.where(batch == b) for b in range(3)]


@pytest.mark.parametrize("cap", [False, True])
def test_features_from_states_equal_the_full_scan(spark, cap):
    df = log(spark)
    specs = [PLAIN, RULED]
    states = sl.day_states(df, specs, "k", "d")
    ours = sl.features_from_states(states, specs, "k", RUN, cap_at_run_date=cap)
    same(ours, sl.assemble_features(df, specs, "k", "d", RUN, cap_at_run_date=cap))


def test_states_of_batches_merge_in_any_order(spark):
    df = log(spark, 4)
    specs = [PLAIN, RULED]
    whole = sl.assemble_features(df, specs, "k", "d", RUN)
    states = None
    for batch in by_era(df):
        more = sl.day_states(batch, specs, "k", "d")
        states = sl.merge_states(more if states is None else states.unionByName(more), specs, "k", RUN - dt.timedelta(days=30))
    same(sl.features_from_states(states, specs, "k", RUN), whole)
    sizes = states.groupBy("k").count().agg(F.max("count")).first()[0]
    # A row for each day from the window's start on, one for all days before, one for undated rows.
    assert sizes <= len({-3, 0, 1, 2, 5, 7, 8, 30}) + 2


def test_timestamps_group_by_their_day(spark):
    df = log(spark).withColumn("d", F.col("d").cast("timestamp") + F.expr("interval 13 hours"))
    states = sl.day_states(df, [PLAIN], "k", "d")
    same(sl.features_from_states(states, [PLAIN], "k", RUN), sl.assemble_features(df, [PLAIN], "k", "d", RUN))


def test_what_has_no_states_is_refused(spark):
    df = log(spark)
    for spec, message in (
        ({"encodings": [{"name": "e", "source_column": "t", "method": "label"}]}, "'e' has no daily states"),
        ({"own": [{"name": "o", "column": lambda r: F.max(r.value("x"))}]}, "'o' has no daily states"),
        ({"null_handlers": [rule("x", "median_impute")]}, "median"),
        ({"null_handlers": [rule("k", "fill", "none")]}, "'k', by which"),
        ({"null_handlers": [rule("d", "drop")]}, "'d', by which"),
        ({"aggregations": [agg("a", "nothing", "sum")]}, "missing column 'nothing'"),
    ):
        with pytest.raises(ValueError, match=message):
            sl.day_states(df, [{"entity_type": "boat", **spec}], "k", "d")


def test_an_empty_table_has_no_states(spark):
    states = sl.day_states(log(spark).where("false"), [PLAIN], "k", "d")
    assert states.count() == 0
    assert sl.features_from_states(states, [PLAIN], "k", RUN).count() == 0


def test_an_incremental_run_reads_its_day_and_the_states(spark, tmp_path):
    recent = "d IN (DATE '2024-01-01', DATE '2024-01-25', DATE '2024-02-01')"
    df = log(spark, 6).where(recent).withColumnsRenamed({"k": "customer_id", "d": "event_date"})
    spec = {**PLAIN, "time_windows": [time("days", "event_date", "days_diff"), time("trend", "x", "rolling_slope")]}
    days = sorted(r[0] for r in df.select("event_date").distinct().collect())
    df.withColumn("date", F.col("event_date")).write.partitionBy("date").parquet(str(tmp_path / "raw"))
    states = str(tmp_path / "states")
    for day in days:
        config = settings(tmp_path, run_date=day.isoformat(), max_null_rate=1.0)
        run = sl.run_incremental(spark, config, [spec], states)
    # Later days are not needed any more, and a rerun gives the same.
    for day in days[:-1]:
        for file in (tmp_path / "raw" / f"date={day}").iterdir():
            file.unlink()
    again = sl.run_incremental(spark, config, [spec], states)
    whole = sl.assemble_features(df, [spec], "customer_id", "event_date", days[-1])
    same(spark.read.parquet(again.output_path), whole)
    assert again.rows == run.rows == whole.count()
    other = {"entity_type": "boat", "aggregations": [agg("n", "i", "count")]}
    df.limit(5).withColumn("date", F.lit(dt.date(2024, 2, 2))).write.partitionBy("date").parquet(str(tmp_path / "raw2"))
    config = settings(tmp_path, run_date="2024-02-02", raw_path=str(tmp_path / "raw2"), max_null_rate=1.0)
    with pytest.raises(ValueError, match="other definitions"):
        sl.run_incremental(spark, config, [other], states)
