"""A cleaning pipeline over ``documents``: each stage is one operator of ``spineloom.llm`` and its decisions.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
documents. All but the last return the columns of ``documents`` as they came, clashing or further ones included; the last returns
``doc_id``, ``n_tokens``, ``ids`` and ``round_trip`` alone.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spineloom.durable import passing_path
from spineloom.functions.columns import ref
from spineloom.llm import byte_bpe
from spineloom.llm.decontaminate import find_benchmark, without_spans
from spineloom.llm.jaccard_join import jaccard_join
from spineloom.llm.quality_rules import kept_documents
from spineloom.llm.queries import SURROGATE_KEY
from spineloom.llm.ship import ship
from spineloom.llm.surrogates import surrogates
from spineloom.llm.tables import Tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _carried(docs: DataFrame) -> DataFrame:
    """(own, text): all columns but the text as one, so that no name clashes with an operator's."""
    return docs.select(F.struct(*[ref(c) for c in docs.columns if c != "text"]).alias("own"), "text")


def _restored(found: DataFrame, columns: list[str], text: Column, changed: Column) -> DataFrame:
    """The columns of the documents again, with another text, and its length, where ``changed``."""
    kind = found.schema["own"].dataType
    found = found.withColumns({"__new": text, "__changed": changed})
    text, changed = F.col("__new"), F.col("__changed")
    out = {c: F.col("own").getField(c) for c in columns if c != "text"} | {"text": F.when(changed, text).otherwise(F.col("text"))}
    if "n_chars" in out:
        length = F.char_length(text).cast(kind["n_chars"].dataType)
        out["n_chars"] = F.when(changed, length).otherwise(out["n_chars"])
    return found.select(*[out[c].alias(c) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the quality rules keep."""
    kept = kept_documents(_carried(docs))
    return _restored(kept, docs.columns, F.col("text"), F.lit(False))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the row with the smallest id stays, of rows that share it the first one.

    Documents without words link with nothing and all stay.
    """
    ship(spark)
    # Rows are told apart by their place, as ids may be null or repeated; it is written along with them, because another
    # job may pack the same files into other partitions.
    rows = Tables(spark, "rows")(docs.withColumn("__row", F.monotonically_increasing_id()))
    links = jaccard_join(rows.select("__row", "text"), id_col="__row")
    # A group of any size is a handful of partial rows, one for each task that met it; nothing is joined by group.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    placed = rows.select("__row", "doc_id").join(links.select("__row", "component_id"), "__row")
    first = placed.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.__row").alias("__row"))
    return rows.join(first, "__row", "left_semi").select(*map(ref, docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; a document of which nothing else is left goes."""
    ship(spark)
    found = find_benchmark(_carried(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["last"] - s["first"])
    left = found.where((n_hit < F.col("n_words")) | (n_hit == 0))
    return _restored(left, docs.columns, without_spans("text"), n_hit > 0)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by surrogates."""
    found = surrogates(_carried(docs), SURROGATE_KEY)
    return _restored(found, docs.columns, F.col("text"), F.col("n_entities") > 0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the text, their number, and whether they decode to the text again."""
    ship(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = docs.select("doc_id", "text")
    encoded = byte_bpe.encode(own, ranks, public_tokenizers.PATTERN, check=True, keep_text=False)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("surrogates", pii),
    ("byte_bpe", tokens),
]

#: Surrogates are keyed hashes drawn until distinct, and tokens are merges by rank: no SQL for these two stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = passing_path(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
