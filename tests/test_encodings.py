import datetime as dt
import random

import pytest
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

import spineloom as sl
from spineloom.operators import categories, ranking


def enc(name, column, method):
    return {"name": name, "source_column": column, "method": method}


@pytest.fixture(scope="module")
def plans(spark):
    """Eight shops: four sell bread, three fish, one tea."""
    goods = ["fish", "bread", "bread", "tea", "fish", "bread", "fish", "bread"]
    return spark.createDataFrame([(f"shop{i}", g) for i, g in enumerate(goods)], "customer_id string, plan_type string")


def codes(df, *specs, date=None, **options):
    got = sl.encode_entities(df, specs, "customer_id", date, **options)
    return {row["customer_id"]: row[1] if len(row) == 2 else tuple(row)[1:] for row in got.collect()}


def test_frequencies_sum_to_one(plans):
    assert sl.category_map(plans, "plan_type").agg(F.sum("share")).first()[0] == pytest.approx(1.0)
    share = codes(plans, enc("f", "plan_type", "frequency"))
    assert [share[f"shop{i}"] for i in range(5)] == [0.375, 0.5, 0.5, 0.125, 0.375]


def test_labels_by_frequency_then_name(plans):
    got = sl.encode_entities(plans, [enc("label", "plan_type", "label")], "customer_id")
    assert dict(got.dtypes)["label"] == "double"
    assert [r[1] for r in got.orderBy("customer_id").collect()] == [1.0, 0.0, 0.0, 2.0, 1.0, 0.0, 1.0, 0.0]
    # Of two goods sold equally often, the name decides.
    tied = got.sparkSession.createDataFrame([("a", "yarn"), ("b", "wool")], "customer_id string, plan_type string")
    assert codes(tied, enc("label", "plan_type", "label")) == {"a": 1.0, "b": 0.0}


def test_one_hot_has_a_slot_for_the_unknown(plans):
    got = codes(plans, enc("hot", "plan_type", "onehot"))
    assert got["shop0"] == [0.0, 1.0, 0.0, 0.0]
    assert got["shop1"] == [1.0, 0.0, 0.0, 0.0]


def test_one_hot_vector(spark, plans):
    got = sl.encode_entities(plans, [enc("hot", "plan_type", "onehot"), enc("f", "plan_type", "frequency")], "customer_id", onehot="vector")
    assert dict(got.dtypes)["hot"] == "vector"
    assert got.columns == ["customer_id", "hot", "f"]
    rows = {r["customer_id"]: r["hot"] for r in got.collect()}
    assert rows["shop3"].size == 4
    assert list(rows["shop3"].indices) == [2]
    with pytest.raises(ValueError, match="onehot"):
        sl.encode_entities(plans, [enc("hot", "plan_type", "onehot")], "customer_id", onehot="dense")


def test_missing_column_leaves_the_key(spark):
    df = spark.createDataFrame([("c1",)], "customer_id string")
    spec = enc("x", "nowhere", "frequency")
    assert sl.encode_entities(df, [spec], "customer_id").columns == ["customer_id"]
    assert sl.encode_rows(df, spec, "customer_id").columns == ["customer_id"]


def test_latest_named_category_wins(spark):
    rows = [
        ("a", dt.date(2024, 1, 1), "x"),
        ("a", dt.date(2024, 1, 3), "y"),
        ("a", dt.date(2024, 1, 4), None),
        ("b", dt.date(2024, 1, 1), "x"),
        ("b", dt.date(2024, 1, 1), "z"),
        ("c", None, "x"),
        ("d", dt.date(2024, 1, 1), None),
        (None, dt.date(2024, 1, 1), "x"),
    ]
    df = spark.createDataFrame(rows, "customer_id string, event_date date, t string")
    specs = [enc("label", "t", "label"), enc("share", "t", "frequency"), enc("hot", "t", "onehot")]
    got = codes(df, *specs, date="event_date")
    assert got["a"] == (1.0, 1 / 8, [0.0, 1.0, 0.0, 0.0])
    assert got["b"] == (2.0, 1 / 8, [0.0, 0.0, 1.0, 0.0])
    assert got["c"] == (0.0, 4 / 8, [1.0, 0.0, 0.0, 0.0])
    assert got["d"] == (3.0, None, [0.0, 0.0, 0.0, 1.0])
    assert got[None] == (None, None, None)


@pytest.mark.parametrize("dtype", ["int", "date", "boolean", "decimal(9,1)"])
def test_categories_that_are_not_text(spark, dtype):
    value = {"int": "1", "date": "2024-01-01", "boolean": "true", "decimal(9,1)": "1.5"}[dtype]
    df = spark.createDataFrame([("a", value), ("b", None)], "customer_id string, raw string")
    df = df.withColumn("t", F.col("raw").cast(dtype))
    assert codes(df, enc("label", "t", "label")) == {"a": 0.0, "b": 1.0}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one category, a long tail of rare ones, some rows without."""
    pick = random.Random(11)
    rows = []
    for i in range(900):
        t = "hot" if i % 3 == 0 else pick.choice([None, "warm", f"cat{pick.randint(0, 300)}"])
        rows.append((f"k{i % 90}" if i % 50 else None, dt.date(2024, 1, 1) + dt.timedelta(days=pick.randint(0, 20)), t))
    return spark.createDataFrame(rows, "customer_id string, event_date date, t string").repartition(7)


def test_labels_match_the_ml_indexer(skewed):
    model = StringIndexer(inputCol="t", outputCol="l", handleInvalid="keep").fit(skewed)
    labels = model.labels
    found = sl.category_map(skewed, "t").orderBy("label").collect()
    assert [r["category"] for r in found] == [*labels, None]
    assert [r["label"] for r in found] == [float(i) for i in range(len(labels) + 1)]


def test_one_hot_matches_the_ml_encoder(skewed):
    indexed = StringIndexer(inputCol="t", outputCol="l", handleInvalid="keep").fit(skewed).transform(skewed)
    encoded = OneHotEncoder(inputCol="l", outputCol="v", dropLast=False).fit(indexed).transform(indexed)
    expected = sorted(
        (r["customer_id"], int(r["v"].indices[0])) for r in encoded.collect() if r["customer_id"] is not None
    )
    got = sl.encode_rows(skewed, enc("v", "t", "onehot"), "customer_id").collect()
    assert sorted((r[0], r[1].index(1.0)) for r in got if r[0] is not None) == expected
    assert all(sum(r[1]) == 1.0 for r in got if r[0] is not None)
    assert [r[1] for r in got if r[0] is None] == [None]


def test_one_hot_vectors_at_row_grain(skewed):
    spec = enc("v", "t", "onehot")
    dense = sl.encode_rows(skewed, spec, "customer_id").collect()
    sparse = sl.encode_rows(skewed, spec, "customer_id", onehot="vector")
    assert dict(sparse.dtypes)["v"] == "vector"
    assert sorted(repr((r[0], r[1] and r[1].index(1.0))) for r in dense) == sorted(
        repr((r[0], r[1] and int(r[1].indices[0]))) for r in sparse.collect()
    )


@pytest.mark.parametrize(
    ("dictionary_rows", "broadcast_rows", "slice_rows"),
    [(250_000, 100_000, 1_000_000), (0, 100_000, 1_000_000), (0, 5, 1_000_000), (0, 1, 40)],
)
def test_maps_too_large_for_literals_for_broadcast_or_for_one_sort(skewed, monkeypatch, dictionary_rows, broadcast_rows, slice_rows):
    """Every combination of limits gives the result of the small-map plan."""
    specs = [enc("label", "t", "label"), enc("share", "t", "frequency"), enc("hot", "t", "onehot")]

    def results():
        entities = sl.encode_entities(skewed, specs, "customer_id", "event_date").collect()
        rows = [sl.encode_rows(skewed, s, "customer_id").collect() for s in specs]
        return sorted(map(repr, entities)), [sorted(map(repr, r)) for r in rows]

    expected = results()
    monkeypatch.setattr(categories, "LITERAL_LABELS", 0)
    monkeypatch.setattr(categories, "DICTIONARY_ROWS", dictionary_rows)
    monkeypatch.setattr(categories, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(ranking, "ROWS_PER_SLICE", slice_rows)
    assert results() == expected


def test_long_names_are_no_literals():
    attribute = categories.Attribute(labels=10, rows=100, longest=10_000)
    assert not attribute.small
    assert categories.Attribute(labels=10, rows=100, longest=10).small
    assert not categories.Attribute(labels=257, rows=1000, longest=1).small


def test_maps_of_long_names_are_sorted_in_slices_of_bytes(spark, monkeypatch):
    """A few long names are more than one task should read: the map is cut by bytes, with the same labels."""
    rows = [(f"{'x' * 2000}{i % 61}",) for i in range(150)] + [(None,), (None,), ("",)]
    df = spark.createDataFrame(rows, "t string").repartition(3)
    written = []
    keep = ranking.stored
    monkeypatch.setattr(ranking, "stored", lambda df, purpose: written.append(df.rdd.getNumPartitions()) or keep(df, purpose))

    def labels():
        return sorted((r["category"] or "", r["n"], r["label"]) for r in sl.category_map(df, "t").collect())

    expected = labels()
    assert not written and len(expected) == 63
    monkeypatch.setattr(ranking, "BYTES_PER_SLICE", 20_000)
    assert labels() == expected
    assert written == [7]


def test_categories_that_are_no_valid_text(spark):
    df = spark.sql("select * from values ('a', cast(x'ff' as string)), ('b', cast(x'fe' as string)), ('c', 'x\\'\"\\n') as t(customer_id, t)")
    got = codes(df, enc("label", "t", "label"), enc("share", "t", "frequency"))
    assert got == {"a": (2.0, 1 / 3), "b": (1.0, 1 / 3), "c": (0.0, 1 / 3)}
    assert codes(df.where("customer_id = 'c'"), enc("label", "t", "label")) == {"c": 0.0}


def test_one_long_name_leaves_the_next_hot_category_broadcast(spark, monkeypatch):
    """A second category with a third of the rows is found by the broadcast, however long another name is."""
    rows = [("a" * 200_000, i) for i in range(50)] + [("next", i) for i in range(35)] + [(f"rare{i}", i) for i in range(15)]
    df = spark.createDataFrame(rows, "t string, customer_id int")
    monkeypatch.setattr(categories, "LITERAL_LABELS", 0)
    maps = categories.fit_categories(df, [categories.Source(F.col("t"))])
    looked = categories.look_up(df, "t", maps, 0, {"n": "n"}, one_in=20)
    assert {(r["t"][:5], r["n"]) for r in looked.collect()} == {("aaaaa", 50), ("next", 35)} | {(f"rare{i}"[:5], 1) for i in range(15)}
    # The shuffled side of the join holds the rare rows only.
    cold = maps.map_of(0).where((F.col("n") * 20 < 100) & F.col("category").isNotNull())
    assert {r["category"] for r in cold.collect()} == {f"rare{i}" for i in range(15)}


def test_several_encodings_keep_one_row_per_entity(skewed):
    specs = [enc("a", "t", "label"), enc("b", "t", "frequency"), enc("c", "event_date", "label")]
    got = sl.encode_entities(skewed, specs, "customer_id", "event_date")
    assert got.count() == skewed.select("customer_id").distinct().count()


def test_empty_input(spark):
    df = spark.createDataFrame([], "customer_id string, event_date date, t string")
    assert sl.encode_entities(df, [enc("a", "t", "label")], "customer_id", "event_date").count() == 0
    assert sl.encode_rows(df, enc("a", "t", "onehot"), "customer_id").count() == 0


@pytest.mark.parametrize("dictionary_rows", [250_000, 3, 0])
def test_latest_categories_of_awkward_tables(spark, monkeypatch, dictionary_rows):
    """Missing keys, dates and categories, ties, repeated rows, and times that are too far apart for one BIGINT."""
    day = dt.datetime
    rows = [
        ("a", day(2024, 1, 1, 10), "x", 1), ("a", day(2024, 1, 1, 10), "y", 2), ("a", None, "z", 3),
        ("b", None, "x", 1), ("b", None, "w", 1), ("c", day(2024, 1, 2), None, None), ("c", day(2023, 1, 2), "x", 7),
        ("d", day(2024, 1, 5), "q", 4), ("d", day(2024, 1, 5), "q", 4), (None, day(2024, 1, 6), "x", 5), ("e", None, None, None),
    ]
    df = spark.createDataFrame(rows, "customer_id string, ts timestamp, t string, u int")
    specs = [enc("label", "t", "label"), enc("share", "t", "frequency"), enc("other", "u", "label")]
    early = df.unionByName(spark.sql("select 'f' as customer_id, timestamp'0001-01-01' as ts, 'x' as t, 1 as u"))
    for table in (df, early, df.where("false")):
        small = sorted(map(repr, sl.encode_entities(table, specs, "customer_id", "ts").collect()))
        with monkeypatch.context() as patched:
            patched.setattr(categories, "LITERAL_LABELS", 0)
            patched.setattr(categories, "DICTIONARY_ROWS", dictionary_rows)
            assert sorted(map(repr, sl.encode_entities(table, specs, "customer_id", "ts").collect())) == small
