"""The registered queries: against their SQL where there is any, and the pipeline against its parts."""

from __future__ import annotations

from pathlib import Path

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from spineloom.durable import durable
from spineloom.llm import oracle, queries
from tests.llm.test_byte_bpe import B
from tests.llm.test_jaccard_join import brute as groups
from tests.llm.test_quality_rules import brute as measures

SF_DIR = Path("/root/testdata/sf0.001")
TABLES = [p.stem for p in sorted(SF_DIR.glob("*.parquet"))]
pytestmark = pytest.mark.skipif(not TABLES, reason="the given tables are not here")


def test_one_query_an_operator_is_registered():
    names = contract.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(contract.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_agrees_with_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = queries.QUERIES[name](spark, str(SF_DIR))
    columns = sorted(df.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    result = connection.execute(oracle.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert ours == sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)


def test_pipeline_matches_its_parts(spark, tmp_path):
    """Quality, near duplicates and tokens are checked against brute force; the two stages between by what they change."""
    rows = [r for p in ("documents",) for r in spark.read.parquet(f"{SF_DIR}/{p}.parquet").collect()]
    extra = [rows[0], rows[0].__class__(**{**rows[0].asDict(), "doc_id": None}), rows[0].__class__(**{**rows[0].asDict(), "text": None})]
    docs = spark.createDataFrame([*rows, *extra], spark.read.parquet(f"{SF_DIR}/documents.parquet").schema)
    docs = docs.selectExpr("*", "1 AS kept", "'x' AS items", "text AS own", "'u' AS `page url`", "2 AS `a``b`", "named_struct('c d', 1) AS `e.f`")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(SF_DIR)).write.parquet(f"{tmp_path}/{name}")
        found[name], docs = (docs, spark.read.parquet(f"{tmp_path}/{name}")), spark.read.parquet(f"{tmp_path}/{name}")
    before, after = found["quality_rules"]
    assert after.columns == before.columns
    assert not any(measures(r.text)["base_failed"] for r in after.collect())
    before, after = found["jaccard_join"]
    numbered = list(enumerate(r.text for r in before.collect()))
    assert after.count() == len({component for _, _, component in groups(numbered)})
    before, after = found["decontamination"]
    texts = {r.doc_id: r.text for r in before.collect()}
    changed = [r for r in after.collect() if r.text != texts[r.doc_id]]
    assert changed and all(len(r.text) < len(texts[r.doc_id]) and r.n_chars == len(r.text) for r in changed)
    hit = {r.doc_id for r in queries.find_benchmark(before.select("doc_id", "text"), spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).where("size(spans) > 0").collect()}
    assert {r.doc_id for r in changed} == hit
    before, after = found["surrogates"]
    assert before.count() == after.count() and after.columns == before.columns
    before, after = found["byte_bpe"]
    texts = {r.doc_id: r.text for r in before.collect()}
    codec = B.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for r in after.collect():
        assert r.round_trip and r.n_tokens == len(r.ids) and codec.decode(r.ids) == (texts[r.doc_id] or "")


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(SF_DIR))
        assert docs.count() == 0


def test_near_duplicates_do_not_depend_on_how_files_are_packed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "documents")
    for k in range(6):
        rows = [(100 * k + i, f"{'same text for each of the files' if i == k else f'other words {k} {i} ' * 5}") for i in range(8 + 5 * k)]
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
    plain = corpus_pipeline.jaccard_join

    def repacked(*args, **named):
        links = durable(plain(*args, **named))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
        return links

    monkeypatch.setattr(corpus_pipeline, "jaccard_join", repacked)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        left = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, spark.read.parquet(path), "").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert sorted(left) == sorted(100 * k + i for k in range(6) for i in range(8 + 5 * k) if i != k or k == 0)


def test_columns_of_any_name_pass_through_every_operator(spark):
    names = ["page url", "a`b", "e.f", "g;h"]
    docs = spark.createDataFrame([(1, "Mr John Smith the boat", "en", 1, (2,), 3, 4)], "doc_id long, text string, lang string, `page url` int, `a``b` struct<`c d`: int>, `e.f` int, `g;h` int")
    benchmark = spark.createDataFrame([("i", "some other text")], "item_id string, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = B.encode(docs, ranks, public_tokenizers.PATTERN)
    results = [
        queries.find_benchmark(docs, benchmark),
        encoded,
        B.decode(encoded, ranks, public_tokenizers.PATTERN),
        queries.toxicity(docs, labels, F.col("doc_id") > 0),
        queries.identify(docs, F.col("doc_id") > 0),
        queries.extract(docs.withColumnRenamed("text", "html")),
        queries.judged(docs),
        queries.surrogates(docs, "key"),
    ]
    for found in results:
        row = found.first().asDict(recursive=True)
        assert [row[n] for n in names] == [1, {"c d": 2}, 3, 4]
