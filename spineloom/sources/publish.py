"""Publication of runs: files are staged in a directory of their own and become visible by a commit record.

A run writes below ``<root>/<place>/run=<id>/`` (a place is a chain of partition directories such as ``date=2024-01-31``) and then
appends one small file to ``<root>/_commits/<place>/``. Readers take the latest record of each place and read the directory it
names. Until the record is there, and if the run fails, they see the run before; there is no moment without data, on
filesystems without renames either. Directories that no record names any more are removed by ``remove_replaced``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spineloom.functions.columns import quoted, ref

RUN = "run"
_COMMITS = "_commits"

# Fixed value: the layout of a commit record.
RECORD = T.StructType(
    [
        T.StructField("place", T.StringType(), False),
        T.StructField("run", T.StringType(), False),
        T.StructField("rows", T.LongType(), False),
        T.StructField("committed_at", T.TimestampType(), False),
        T.StructField("bucket_column", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
    ]
)

# Fixed value: the characters that Spark percent-encodes in the names of partition directories.
_ESCAPED = frozenset("\"#%'*/:=?\\\x7f{[]^" + "".join(map(chr, range(1, 32))))


class Buckets(NamedTuple):
    """Files by hash of a column: runs with equal buckets join on it without an exchange."""

    column: str
    number: int


class Staged(NamedTuple):
    """A run whose files are complete, and what was observed while they were written."""

    root: str
    place: str
    run: str
    metrics: dict
    buckets: Buckets | None = None

    @property
    def path(self) -> str:
        return f"{self.root}/{self.place}/{RUN}={self.run}"

    @property
    def table(self) -> str:
        """The name under which a run in buckets is known to the session: only tables tell Spark of buckets."""
        return f"spineloom_{self.run.replace('-', '_')}"


def place_of(**keys: str) -> str:
    """The directories of partition values, in the order given."""
    def escaped(value: str) -> str:
        return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)

    return "/".join(f"{name}={escaped(value)}" for name, value in keys.items())


def stage(
    df: DataFrame,
    root: str,
    place: str,
    metrics: Iterable[Column] = (),
    buckets: Buckets | None = None,
    drop: Iterable[str] = (),
) -> Staged:
    """Write a run without publishing it. Its rows (metric ``rows``) and further aggregates are observed on the way, so the
    input is read once; the columns ``drop`` are observed but not written."""
    started = dt.datetime.now(tz=dt.UTC).strftime("%Y%m%dT%H%M%S")
    run = f"{started}-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).drop(*drop)
    out = Staged(root.rstrip("/"), place, run, {}, buckets)
    if buckets is None:
        observed.write.parquet(out.path)
    else:  # one file for each bucket
        dealt = observed.repartition(buckets.number, ref(buckets.column)).write.format("parquet").option("path", out.path)
        dealt.bucketBy(buckets.number, buckets.column).sortBy(buckets.column).saveAsTable(out.table)
        df.sparkSession.sql(f"DROP TABLE {out.table}")  # the files stay, as their place was given
    return out._replace(metrics=seen.get)


def bucketed_table(spark: SparkSession, staged: Staged) -> DataFrame:
    """A run in buckets as a table of the session that knows them."""
    fields = spark.read.parquet(staged.path).schema.fields
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    key = quoted(staged.buckets.column)
    place = staged.path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {staged.table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key})"
        f" INTO {staged.buckets.number} BUCKETS LOCATION '{place}'"
    )
    return spark.table(staged.table)


def publish(spark: SparkSession, staged: Staged) -> None:
    """Append the commit record: from then on readers of the place read this run."""
    record = spark.range(1).select(
        F.lit(staged.place).alias("place"),
        F.lit(staged.run).alias("run"),
        F.lit(staged.metrics["rows"]).cast("bigint").alias("rows"),
        F.lit(dt.datetime.now(tz=dt.UTC)).cast("timestamp").alias("committed_at"),
        F.lit(staged.buckets and staged.buckets.column).cast("string").alias("bucket_column"),
        F.lit(staged.buckets and staged.buckets.number).cast("int").alias("buckets"),
    )
    record.coalesce(1).write.mode("append").parquet(f"{staged.root}/{_COMMITS}/{staged.place}")


def commits(spark: SparkSession, root: str, below: str = "") -> DataFrame:
    """All records of the places below one; an ``AnalysisException`` (PATH_NOT_FOUND) if there is none."""
    path = f"{root.rstrip('/')}/{_COMMITS}/{below}".rstrip("/")
    return spark.read.schema(RECORD).option("recursiveFileLookup", True).parquet(path)


def published(spark: SparkSession, root: str, below: str = "") -> dict[str, Staged]:
    """Place -> its latest published run, for the places below one: a row for each place reaches the driver."""
    latest = F.max_by(F.struct(*RECORD.names), F.struct("committed_at", "run")).alias("latest")
    found = {}
    for row in commits(spark, root, below).groupBy("place").agg(latest).select("latest.*").collect():
        buckets = Buckets(row["bucket_column"], row["buckets"]) if row["buckets"] else None
        found[row["place"]] = Staged(root.rstrip("/"), row["place"], row["run"], {"rows": row["rows"]}, buckets)
    return found


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def remove_replaced(spark: SparkSession, root: str, keep: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Delete the directories of runs that are no place's latest and were started longer ago than ``keep``: replaced runs
    that readers may still use, and unpublished runs that may still be writing, are spared that long. Returns their paths."""
    current = {run.path for run in published(spark, root).values()}
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    top = hadoop.Path(root.rstrip("/"))
    files = top.getFileSystem(context._jsc.hadoopConfiguration())
    limit = (dt.datetime.now(tz=dt.UTC) - keep).strftime("%Y%m%dT%H%M%S")
    removed = []
    # One directory for each place and run; files are not listed.
    waiting = [(top, root.rstrip("/"))]
    while waiting:
        folder, name = waiting.pop()
        for status in files.listStatus(folder):
            child, own = status.getPath(), status.getPath().getName()
            if not status.isDirectory() or own.startswith("_"):
                continue
            path = f"{name}/{own}"
            if not own.startswith(f"{RUN}="):
                waiting.append((child, path))
            elif path not in current and own.removeprefix(f"{RUN}=") < limit:
                files.delete(child, True)
                removed.append(path)
    return sorted(removed)
