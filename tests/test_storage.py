import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import spineloom as sl

SPEC = {
    "entity_type": "customer",
    "aggregations": [{"name": "n", "source_column": "amount", "function": "count"}],
    "encodings": [{"name": "share", "source_column": "nowhere", "method": "frequency"}],
    "time_windows": [{"name": "days", "source_column": "event_date", "feature_type": "days_diff"}],
}


def events(spark, days=("2024-01-01", "2024-01-02", "2024-01-05")):
    rows = [(f"c{i}", dt.date.fromisoformat(day), float(i)) for day in days for i in range(4)]
    return spark.createDataFrame(rows, "customer_id string, event_date date, amount double")


@pytest.fixture(params=["parquet", "csv"])
def raw(spark, tmp_path, request):
    path = str(tmp_path / "raw")
    daily = events(spark).withColumn("date", F.col("event_date"))
    daily.write.partitionBy("date").option("header", True).format(request.param).save(path)
    return request.param, path


def test_one_day_keeps_its_date(spark, raw):
    kind, path = raw
    df = sl.read_raw(spark, path + "/", kind, run_date="2024-01-02")
    assert df.count() == 4
    assert df.select("date", "event_date").distinct().collect() == [(dt.date(2024, 1, 2), dt.date(2024, 1, 2))]
    assert dict(df.dtypes)["amount"] == "double"


def test_all_days_and_lookback(spark, raw):
    kind, path = raw
    assert sl.read_raw(spark, path, kind).count() == 12
    recent = sl.read_raw(spark, path, kind, run_date="2024-01-05", lookback_days=3)
    assert {str(r["date"]) for r in recent.select("date").distinct().collect()} == {"2024-01-02", "2024-01-05"}
    assert len(recent.inputFiles()) <= len(sl.read_raw(spark, path, kind).inputFiles())


def test_lookback_reads_the_files_of_its_days(spark, tmp_path):
    path = str(tmp_path / "raw")
    events(spark).withColumn("date", F.col("event_date")).write.partitionBy("date").parquet(path)
    df = sl.read_raw(spark, path, run_date="2024-01-05", lookback_days=3)
    assert {f.split("date=")[1][:10] for f in df.inputFiles()} == {"2024-01-02", "2024-01-05"}


def test_absent_day_is_an_error(spark, raw):
    kind, path = raw
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        sl.read_raw(spark, path, kind, run_date="2023-01-01")


def test_explicit_schema(spark, tmp_path):
    path = str(tmp_path / "raw")
    events(spark).write.option("header", True).csv(path)
    df = sl.read_raw(spark, path, "csv", schema="customer_id string, event_date date, amount double")
    assert [t for _, t in df.dtypes] == ["string", "date", "double"]
    assert df.count() == 12


def test_row_gate(spark, raw):
    kind, path = raw
    with pytest.raises(ValueError, match="Ingested 12 rows from .*minimum required is 13"):
        sl.read_raw(spark, path, kind, min_row_count=13)
    with pytest.raises(ValueError, match="Ingested 12 rows .* 20000"):
        sl.read_raw(spark, path, kind, min_row_count=20_000)
    with pytest.raises(ValueError, match="input_format"):
        sl.read_raw(spark, path, "json")
    df = events(spark)
    assert sl.require_rows(df, 12) is df
    with pytest.raises(ValueError, match="Ingested 0 rows"):
        sl.require_rows(df.where("false"), 1)


def test_rerun_replaces_only_its_partition(spark, tmp_path):
    root = str(tmp_path / "store")
    df = events(spark)
    sl.write_features(df, root, "customer", "2024-01-01")
    other = sl.write_features(df.limit(3), root, "supplier", "2024-01-01")
    first = sl.write_features(df, root, "customer", "2024-01-02")
    again = sl.write_features(df.limit(5), root, "customer", "2024-01-02")
    assert (other.rows, first.rows, again.rows) == (3, 12, 5)
    assert again.path.startswith(f"{root}/entity_type=customer/date=2024-01-02/run=") and again.path != first.path
    counts = {(r[0], str(r[1])): r[2] for r in sl.read_features(spark, root).groupBy("entity_type", "date").count().collect()}
    assert counts == {("customer", "2024-01-01"): 12, ("customer", "2024-01-02"): 5, ("supplier", "2024-01-01"): 3}
    assert sl.read_features(spark, root, "customer", "2024-01-02").count() == 5
    assert spark.read.parquet(again.path).count() == 5
    assert spark.read.parquet(again.path).columns == df.columns


def test_names_of_partition_columns_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="directories: Date"):
        sl.write_features(events(spark).withColumn("Date", F.lit("other")), str(tmp_path), "customer", "2024-01-01")
    for name in ("date", "Entity_Type", "__in0"):
        spec = {"entity_type": "e", "aggregations": [{"name": name, "source_column": "amount", "function": "sum"}]}
        with pytest.raises(ValueError, match="reserved"):
            sl.aggregate_features(events(spark), spec["aggregations"], "customer_id", "event_date", "2024-01-05")


def test_each_entity_type_has_its_own_columns(spark, tmp_path):
    root = str(tmp_path / "store")
    sl.write_features(spark.createDataFrame([("a", 1.5)], "customer_id string, spend double"), root, "customer", "2024-01-01")
    for name in ("user", "007", "a/b=c"):
        df = spark.createDataFrame([(7, name)], "user_id int, tag string")
        written = sl.write_features(df, root, name, "2024-01-01")
        assert spark.read.parquet(written.path).count() == 1
        for found in (sl.read_features(spark, root, name), sl.read_features(spark, root, name, "2024-01-01")):
            assert found.columns == ["user_id", "tag", "entity_type", "date"]
            assert [tuple(r) for r in found.collect()] == [(7, name, name, dt.date(2024, 1, 1))]
    everything = sl.read_features(spark, root)
    assert {r["entity_type"] for r in everything.collect()} == {"customer", "user", "007", "a/b=c"}
    assert set(everything.columns) == {"customer_id", "spend", "user_id", "tag", "entity_type", "date"}


def test_added_features_and_empty_reruns(spark, tmp_path):
    root = str(tmp_path / "store")
    df = events(spark).select("customer_id", "amount")
    sl.write_features(df, root, "customer", "2024-01-01")
    sl.write_features(df.withColumn("extra", F.lit(1)), root, "customer", "2024-01-02")
    both = sl.read_features(spark, root, "customer")
    assert both.columns == ["customer_id", "amount", "extra", "entity_type", "date"]
    assert both.where("extra IS NULL").select("date").distinct().collect() == [(dt.date(2024, 1, 1),)]
    assert sl.write_features(df.where("false"), root, "customer", "2024-01-02").rows == 0
    assert sl.read_features(spark, root, "customer", "2024-01-02").count() == 0
    assert sl.read_features(spark, root, "customer").count() == 12


def test_csv_lookback_does_not_look_at_other_days(spark, tmp_path):
    path = str(tmp_path / "raw")
    daily = events(spark).select(F.col("event_date").alias("date"), "customer_id", F.col("amount").cast("string"))
    odd = spark.createDataFrame([(dt.date(2023, 1, 1), "c0", "not a number")], daily.schema)
    daily.union(odd).write.partitionBy("date").option("header", True).csv(path)
    recent = sl.read_raw(spark, path, "csv", run_date="2024-01-05", lookback_days=4)
    assert dict(recent.dtypes)["amount"] == "double" and recent.count() == 12
    assert sl.read_raw(spark, path, "csv", run_date="2022-01-05", lookback_days=2, min_row_count=0).count() == 0
    with pytest.raises(ValueError, match="Ingested 0 rows"):
        sl.read_raw(spark, path, "csv", run_date="2022-01-05", lookback_days=2)


def test_text_dates_that_are_none_count_as_undated(spark):
    rows = [("a", "2024-01-04", 1.0), ("a", "some day", 2.0), ("a", None, 4.0)]
    df = spark.createDataFrame(rows, "customer_id string, event_date string, amount double")
    specs = [{"name": n, "source_column": "amount", "function": "sum", "window_days": d} for n, d in (("all", None), ("week", 7))]
    row = sl.aggregate_features(df, specs, "customer_id", "event_date", "2024-01-05").first()
    assert (row["all"], row["week"]) == (7.0, 1.0)


def entry(spark, name, at, path="somewhere", columns=("n", "days")):
    return sl.registry_entry(
        spark, name, "customer", "customer_id", "2024-01-05", path, columns, [SPEC], dt.datetime(2024, 1, at, tzinfo=dt.UTC)
    )


def test_entry_lists_what_was_declared(spark):
    row = entry(spark, "daily", 1).first()
    assert row["feature_count"] == 2
    assert [tuple(f) for f in row["features"]] == [("n", "aggregation"), ("share", "encoding"), ("days", "time_window")]
    assert row["run_date"] == "2024-01-05"


def test_upsert_keeps_the_newest_entry_per_pipeline(spark):
    current = entry(spark, "a", 1).unionByName(entry(spark, "b", 2))
    merged = sl.upsert(current, entry(spark, "a", 3, "elsewhere"))
    assert merged.columns == current.columns
    assert sorted((r["pipeline_name"], r["output_path"]) for r in merged.collect()) == [("a", "elsewhere"), ("b", "somewhere")]


def test_registry_table(spark, tmp_path):
    path = str(tmp_path / "registry")
    with pytest.raises(AnalysisException):
        sl.read_registry(spark, path)
    sl.update_registry(path, entry(spark, "2024", 1))
    sl.update_registry(path, entry(spark, "a/b=c", 1))
    sl.update_registry(path, entry(spark, "2024", 2, "elsewhere"))
    rows = {r["pipeline_name"]: r["output_path"] for r in sl.read_registry(spark, path).collect()}
    assert rows == {"2024": "elsewhere", "a/b=c": "somewhere"}
    assert sl.read_registry(spark, path).columns == entry(spark, "a", 1).columns


def settings(tmp_path, **changes):
    values = {
        "pipeline_name": "daily",
        "entity_type": "customer",
        "entity_key": "customer_id",
        "date_column": "event_date",
        "run_date": "2024-01-05",
        "raw_path": str(tmp_path / "raw"),
        "store_path": str(tmp_path / "store"),
        "registry_path": str(tmp_path / "registry"),
    }
    return sl.Settings(**{**values, **changes})


def test_daily_run(spark, tmp_path):
    events(spark).withColumn("date", F.col("event_date")).write.partitionBy("date").parquet(str(tmp_path / "raw"))
    run = sl.run_daily(spark, settings(tmp_path), [SPEC])
    assert (run.rows, run.feature_count) == (4, 2)
    assert sorted(spark.read.parquet(run.output_path).collect()) == [(f"c{i}", 1, 0) for i in range(4)]
    again = sl.run_daily(spark, settings(tmp_path, lookback_days=4), [SPEC])
    assert again[1:] == run[1:]
    assert sorted(spark.read.parquet(again.output_path).collect()) == [(f"c{i}", 3, 0) for i in range(4)]
    registered = sl.read_registry(spark, str(tmp_path / "registry")).collect()
    assert [(r["pipeline_name"], r["output_path"], r["feature_count"]) for r in registered] == [("daily", again.output_path, 2)]
    history = sl.registry_history(spark, str(tmp_path / "registry")).collect()
    assert sorted(r["output_path"] for r in history) == sorted([run.output_path, again.output_path])


def test_failed_check_writes_nothing(spark, tmp_path):
    gaps = events(spark).withColumns({"date": F.col("event_date"), "amount": F.lit(None).cast("double")})
    gaps.write.partitionBy("date").parquet(str(tmp_path / "raw"))
    with pytest.raises(sl.DataQualityError, match="'amount' null rate 100.00%"):
        sl.run_daily(spark, settings(tmp_path), [SPEC])
    with pytest.raises(ValueError, match="minimum required"):
        sl.run_daily(spark, settings(tmp_path, min_row_count=5), [SPEC])
    assert not (tmp_path / "store").exists()
    assert not (tmp_path / "registry").exists()


def failing(df):
    """The same rows, but the task that reaches the last of them fails."""
    broken = F.when(F.col("amount") == 3, F.raise_error(F.lit("no power"))).otherwise(F.col("amount"))
    return df.repartition(4, "amount").withColumn("amount", broken.cast("double"))


def test_a_run_that_fails_midway_leaves_the_old_day_readable(spark, tmp_path):
    root = str(tmp_path / "store")
    old = sl.write_features(events(spark), root, "customer", "2024-01-02")
    reader = sl.read_features(spark, root, "customer", "2024-01-02")
    with pytest.raises(Exception, match="no power"):
        sl.write_features(failing(events(spark)), root, "customer", "2024-01-02")
    assert sl.read_features(spark, root, "customer", "2024-01-02").count() == old.rows
    new = sl.write_features(events(spark).limit(2), root, "customer", "2024-01-02")
    # A reader that started before goes on with the files it began with.
    assert reader.count() == old.rows
    assert sl.read_features(spark, root, "customer", "2024-01-02").count() == 2
    assert sl.remove_replaced(spark, root) == []
    removed = sl.remove_replaced(spark, root, dt.timedelta(seconds=-5))
    assert old.path in removed and new.path not in removed and len(removed) == 2
    assert sl.read_features(spark, root, "customer", "2024-01-02").count() == 2


def test_a_day_that_was_never_published_is_no_day(spark, tmp_path):
    root = str(tmp_path / "store")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        sl.read_features(spark, root, "customer")
    sl.write_features(events(spark), root, "customer", "2024-01-02")
    with pytest.raises(Exception, match="no power"):
        sl.write_features(failing(events(spark)), root, "customer", "2024-01-03")
    assert [str(r["date"]) for r in sl.read_features(spark, root).select("date").distinct().collect()] == ["2024-01-02"]
    with pytest.raises(ValueError, match="nothing is published"):
        sl.read_features(spark, root, run_date="2024-01-03")


def test_landing_checks_while_it_writes(spark, tmp_path):
    root = str(tmp_path / "landed")
    landed = sl.land_day(events(spark), root, "2024-01-05", "customer_id", "event_date", min_row_count=12)
    assert landed.rows == 12
    assert {(r["column"], r["check"], r["passed"]) for r in landed.report.collect()} == {
        ("customer_id", "presence", True),
        ("event_date", "presence", True),
        *((c, "null_rate", True) for c in ("customer_id", "event_date", "amount")),
    }
    day = sl.read_landed(spark, root, "2024-01-05")
    assert day.columns == ["customer_id", "event_date", "amount", "date"] and day.count() == 12
    gaps = events(spark).withColumn("amount", F.when(F.col("amount") > 0, F.col("amount")))
    with pytest.raises(sl.DataQualityError, match=r"pipeline 'daily':\n  Column 'amount' null rate 25.00% exceeds threshold 5.00%"):
        sl.land_day(gaps, root, "2024-01-05", "customer_id", "event_date", pipeline_name="daily")
    with pytest.raises(ValueError, match="Ingested 12 rows .* 13"):
        sl.land_day(events(spark), root, "2024-01-05", "customer_id", "event_date", min_row_count=13)
    with pytest.raises(sl.DataQualityError, match="is empty"):
        sl.land_day(events(spark).where("false"), root, "2024-01-05", "customer_id", "event_date", min_row_count=0)
    with pytest.raises(sl.DataQualityError, match="expected date, got StringType"):
        sl.land_day(events(spark).withColumn("event_date", F.lit("x")), root, "2024-01-05", "customer_id", "event_date", expected_types={"event_date": "date"})
    with pytest.raises(ValueError, match="8 rows have another date than 2024-01-05"):
        sl.land_day(events(spark).withColumn("date", F.col("event_date")), root, "2024-01-05", "customer_id", "date")
    own = events(spark).withColumn("date", F.lit("2024-01-05").cast("date"))
    assert sl.land_day(own, str(tmp_path / "own"), "2024-01-05", "customer_id", "date").rows == 12
    assert sl.read_landed(spark, str(tmp_path / "own")).columns == ["customer_id", "event_date", "amount", "date"]
    # The day is still the one that passed, and refused runs are no days.
    assert sl.read_landed(spark, root).count() == 12
    with pytest.raises(ValueError, match="no day is published"):
        sl.read_landed(spark, root, "2024-01-04")


def test_daily_run_over_landed_days(spark, tmp_path):
    daily = events(spark).withColumn("date", F.col("event_date"))
    daily.write.partitionBy("date").option("header", True).csv(str(tmp_path / "raw"))
    options = {"input_format": "csv", "landing_path": str(tmp_path / "landed"), "lookback_days": 4}
    for day in ("2024-01-01", "2024-01-02", "2024-01-05"):
        run = sl.run_daily(spark, settings(tmp_path, run_date=day, **options), [SPEC])
    assert sorted(spark.read.parquet(run.output_path).collect()) == [(f"c{i}", 3, 0) for i in range(4)]
    assert sl.read_landed(spark, str(tmp_path / "landed")).count() == 12
