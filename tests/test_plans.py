"""The plans must have the shape the operators promise."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import spineloom as sl
from checks.assembly import ACTIVITY, SPEND
from checks.cleaning import rule
from checks.encoding import enc_multi_entity_large, encoding
from checks.fixtures import EVENTS_RUN_DATE, events, events_gaps
from checks.windows import agg, time
from spineloom.operators import categories, ranking

SF = "/root/testdata/sf0.01"


@pytest.fixture
def static_plans(spark):
    """Without adaptive execution and automatic broadcasts the plan text shows every exchange."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(text: str, node: str) -> int:
    return len(re.findall(rf"(?<![A-Za-z]){node}\b", text))


def assemble(df, *specs):
    return sl.assemble_features(df, specs, "user_id", "event_date", EVENTS_RUN_DATE)


NUMBERS = {
    "entity_type": "user",
    "null_handlers": [rule("value", "fill", 0)],
    "aggregations": [agg(f"{f}_{w}", "value", f, w) for f in ("sum", "mean", "count", "stddev", "min", "max") for w in (None, 7, 30)],
    "time_windows": [time("days", "event_date", "days_diff"), time("slope", "value", "rolling_slope")],
}


def test_all_numeric_features_in_one_hash_aggregation(static_plans):
    text = plan(assemble(events_gaps(static_plans, SF), NUMBERS))
    assert count(text, "Exchange hashpartitioning") == 1
    assert count(text, "HashAggregate") == 2  # partial before the shuffle, final after
    assert "Sort" not in text
    assert "Join" not in text
    assert count(text, "FileScan") == 1


def test_definitions_with_different_rules_share_the_aggregation(static_plans):
    dropping = {
        "entity_type": "user",
        "null_handlers": [rule("event_type", "drop")],
        "aggregations": [agg("kept", "value", "count", 7)],
    }
    text = plan(assemble(events_gaps(static_plans, SF), NUMBERS, dropping))
    assert count(text, "Exchange hashpartitioning") == 1
    assert count(text, "FileScan") == 1


def test_encodings_of_few_categories_add_no_join_and_no_sort(static_plans):
    text = plan(assemble(events_gaps(static_plans, SF), ACTIVITY, SPEND))
    assert count(text, "FileScan") == 1
    assert count(text, "Exchange") == 1
    assert count(text, "HashAggregate") == 2
    assert "Join" not in text
    assert "Sort" not in text


def test_encodings_of_many_categories_leave_the_numbers_hashed(static_plans, monkeypatch):
    monkeypatch.setattr(categories, "LITERAL_LABELS", 0)
    text = plan(assemble(events_gaps(static_plans, SF), ACTIVITY, SPEND))
    # Codes from broadcast dictionaries sit in the one aggregation.
    assert count(text, "HashAggregate") == 2
    assert count(text, "Exchange hashpartitioning") == 1
    assert "SortAggregate" not in text and "SortMergeJoin" not in text
    monkeypatch.setattr(categories, "DICTIONARY_ROWS", 0)
    text = plan(assemble(events_gaps(static_plans, SF), ACTIVITY, SPEND))
    # Two for the features, and two that reduce coded pairs to one row per user.
    assert count(text, "HashAggregate") == 4
    assert "SortAggregate" not in text
    assert "Cartesian" not in text
    assert "NestedLoop" not in text


def test_text_extremes_leave_the_numbers_hashed(static_plans):
    text_too = {**NUMBERS, "aggregations": [*NUMBERS["aggregations"], agg("last_type", "event_type", "max", 7)]}
    text = plan(assemble(events_gaps(static_plans, SF), text_too))
    assert count(text, "HashAggregate") == 2
    assert count(text, "SortAggregate") == 2
    assert len(re.findall(r"Exchange hashpartitioning\(user_id", text)) == 2


def test_only_used_columns_are_read(spark):
    df = events(spark, SF)
    spec = {"entity_type": "user", "aggregations": [agg("s", "value", "sum", 7)]}
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(assemble(df, spec))).group(1)
    assert schema == "ts:timestamp_ntz,user_id:bigint,value:double"


def test_lookback_filter_reaches_the_scan(spark):
    text = plan(sl.lookback(events(spark, SF), "ts", EVENTS_RUN_DATE, 7))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-24T00:00)]" in text


def test_row_grain_encoding_shuffles_no_event(static_plans):
    coded = sl.encode_rows(events(static_plans, SF), encoding("share", "event_type", "frequency"), "user_id")
    text = plan(coded)
    assert "Join" not in text
    # The only exchange by user is that of the distinct missing keys.
    assert len(re.findall(r"Exchange hashpartitioning\(user_id", text)) == 1
    assert "PushedFilters: [IsNull(user_id)]" in text


def test_null_rates_in_one_pass(static_plans):
    text = plan(sl.null_report(events_gaps(static_plans, SF)))
    assert count(text, "FileScan") == 1
    assert count(text, "Exchange") == 1
    assert "Window" not in text


def test_null_counts_from_footers_where_the_source_can(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")}
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        text = plan(sl.null_rates(spark.read.parquet(f"{SF}/orders.parquet")))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert re.search(r"PushedAggregation: \[COUNT\(\*\), COUNT\(o_orderkey\)", text)


def test_no_python_workers_and_no_cross_joins(spark):
    for df in (
        assemble(events_gaps(spark, SF), ACTIVITY, SPEND),
        sl.encode_rows(events(spark, SF), encoding("hot", "event_type", "onehot"), "user_id"),
        sl.quality_report(events(spark, SF), "user_id", "ts"),
    ):
        text = plan(df)
        for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in text


@pytest.mark.parametrize("broadcast", [250_000, 0])
def test_large_encodings_grow_the_plan_evenly(static_plans, monkeypatch, broadcast):
    monkeypatch.setattr(categories, "LITERAL_LABELS", 0)
    monkeypatch.setattr(categories, "DICTIONARY_ROWS", broadcast)
    df = events(static_plans, SF)
    texts = []
    for k in (1, 2, 3):
        columns = ("event_type", "props", "value")[:k]
        spec = {"entity_type": "user", "encodings": [encoding(f"e_{c}", c, "label") for c in columns]}
        texts.append(plan(assemble(df, spec)))
    for node in ("Union", "BroadcastHashJoin", "SortMergeJoin", "SortAggregate"):
        one, two, three = (count(t, node) for t in texts)
        assert two - one == three - two, node


@pytest.mark.parametrize(("broadcast", "scans"), [(250_000, 2), (0, 3), (3000, 3)])
def test_large_encodings_take_few_scans_and_no_sort(static_plans, monkeypatch, broadcast, scans):
    """One scan counts the categories and one aggregates by entity; pairs that no broadcast can code take a third."""
    monkeypatch.setattr(categories, "DICTIONARY_ROWS", broadcast)
    texts = []
    for name in ("durable", "stored"):
        keep = getattr(categories, name)
        monkeypatch.setattr(categories, name, lambda df, *a, keep=keep: texts.append(plan(df)) or keep(df, *a))
    texts.append(plan(enc_multi_entity_large(static_plans, SF)))
    assert sum(len(re.findall(r"FileScan parquet[^\n]*lineitem", text)) for text in texts) == scans
    assert all("SortAggregate" not in text for text in texts)
    assert count(texts[-1], "HashAggregate") == 2 * (scans - 1)
    assert count(texts[-1], "Exchange hashpartitioning") <= 4


def test_a_timestamp_column_takes_one_scan_and_no_sort(static_plans):
    df = events_gaps(static_plans, SF)
    text = plan(sl.assemble_features(df, [ACTIVITY, SPEND], "user_id", "ts", EVENTS_RUN_DATE))
    assert count(text, "FileScan") == 1
    assert count(text, "Exchange") == 1
    assert "Sort" not in text
    assert "Join" not in text


def test_days_in_equal_buckets_join_without_an_exchange(static_plans, tmp_path):
    df = events(static_plans, SF)
    root = str(tmp_path / "store")
    features = sl.aggregate_features(df, [agg("n", "value", "count", 7)], "user_id", "event_date", EVENTS_RUN_DATE)
    for day in ("2024-01-29", "2024-01-30", "2024-01-31"):
        sl.write_features(features, root, "user", day, buckets=("user_id", 6))
    both = sl.side_by_side(static_plans, root, "user", "user_id", ["2024-01-31", "2024-01-30", "2024-01-29"])
    text = plan(both)
    assert "Exchange" not in text
    assert count(text, "SortMergeJoin") == 2
    assert "SelectedBucketsCount: 6 out of 6" in text
    assert both.columns == ["user_id", "n_20240131", "n_20240130", "n_20240129"]
    assert sorted(both.collect()) == sorted((r["user_id"], r["n"], r["n"], r["n"]) for r in features.collect())


def test_days_without_buckets_are_joined_as_well(spark, tmp_path):
    root = str(tmp_path / "store")
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, None)], "k string, n int")
    sl.write_features(df, root, "boat", "2024-01-01")
    sl.write_features(df.where("k = 'a'"), root, "boat", "2024-01-02", buckets=("k", 3))
    rows = sl.side_by_side(spark, root, "boat", "k", ["2024-01-01", "2024-01-02"]).collect()
    assert sorted(map(tuple, rows), key=repr) == [("a", 1, 1), ("b", 2, None), (None, None, None)]
    with pytest.raises(ValueError, match="nothing is published"):
        sl.side_by_side(spark, root, "boat", "k", ["2024-01-01", "2024-01-03"])


def test_null_rates_of_files_read_no_page(spark, tmp_path):
    text = plan(sl.file_null_rates(spark, f"{SF}/documents.parquet"))
    assert re.search(r"PushedAggregation: \[COUNT\(\*\), COUNT\(doc_id\), COUNT\(text\)", text)
    # The caller's session still reads as it did.
    assert "PushedAggregation: [COUNT" not in plan(sl.null_rates(spark.read.parquet(f"{SF}/documents.parquet")))
    path = str(tmp_path / "nested")
    spark.sql("SELECT 1 AS a, array(1) AS b UNION ALL SELECT NULL, NULL").write.parquet(path)
    assert {tuple(r) for r in sl.file_null_rates(spark, path).collect()} == {("a", 1, 2, 0.5), ("b", 1, 2, 0.5)}


def test_own_features_of_text_leave_the_numbers_hashed(static_plans):
    own = [
        {"name": "last", "column": lambda r: F.max(r.value("event_type"))},
        {"name": "kinds", "column": lambda r: F.size(F.collect_set(r.value("event_type"))), "window_days": 7},
        {"name": "spread", "column": lambda r: F.max(r.value("value")) - F.min(r.value("value"))},
    ]
    text = plan(assemble(events_gaps(static_plans, SF), {**NUMBERS, "own": own}))
    hashed = re.findall(r"(?<![A-Za-z])HashAggregate\(keys[^\n]*", text)
    assert len(hashed) == 2
    assert all("regr" not in line and "min(" in line and "collect_set" not in line for line in hashed)
    numbers_only = plan(assemble(events_gaps(static_plans, SF), {**NUMBERS, "own": own[2:]}))
    assert "Sort" not in numbers_only and count(numbers_only, "HashAggregate") == 2


def test_states_of_a_day_hash(static_plans):
    text = plan(sl.day_states(events_gaps(static_plans, SF), [NUMBERS], "user_id", "event_date"))
    assert count(text, "HashAggregate") == 2
    assert count(text, "Exchange") == 1
    assert "Sort" not in text


def test_landing_reads_the_input_once(spark, tmp_path):
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    df = events(spark, SF).select("event_id", "user_id", "value", "event_date")
    n = df.count()
    landed = sl.land_day(df.mapInArrow(counted, df.schema), str(tmp_path / "landed"), "2024-01-31", "user_id", "event_date", min_row_count=100)
    assert rows.value == landed.rows == n


def test_ranks_of_a_huge_map_take_one_sort(static_plans, monkeypatch):
    """Over a million names are range-partitioned, sorted and written once; no window sees more than a row per slice."""
    n = 1_200_000
    written = []
    keep = ranking.stored
    monkeypatch.setattr(ranking, "stored", lambda df, purpose: written.append(plan(df)) or keep(df, purpose))
    names = static_plans.range(n).select(F.lit(0).alias("attribute"), F.hex(F.xxhash64("id")).alias("category"), (F.col("id") % 7).alias("n"))
    order = [F.col("n").desc(), F.col("category")]
    ranked = ranking.ranks(names, "attribute", order, n, "label", rows_per_slice=100_000)
    assert count(written[0], "Sort") == 1 and "Window" not in written[0] and count(written[0], "Exchange") == 1
    text = plan(ranked)
    # The one window, and its sort, are over the slices' offsets.
    assert count(text, "Window") == 1 and count(text, "Sort") == 1
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    found = ranked.agg(F.count_distinct("label"), F.min("label"), F.max("label")).first()
    assert tuple(found) == (n, 0, n - 1)
    expected = names.where("n = 6").agg(F.count(F.lit(1)), F.min("category")).first()
    first = ranked.where("label = 0").first()
    assert (first["n"], first["category"]) == (6, expected[1])
    assert ranked.where("n = 6").agg(F.max("label")).first()[0] == expected[0] - 1
