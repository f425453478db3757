"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

Texts are lower-cased (A-Z) and split at white space; a document's set holds its distinct shingles of ``words`` words, or
its whole sequence where it has fewer. Two documents are linked when ``100 * intersection >= percent * union``, exactly
(shingles are compared by 64-bit hashes).

How it stays linear where many documents are alike:

* Documents with the same set are one *class*; everything below is about classes.
* A count sketch of all shingles, of fixed size, orders shingles rare first. Two linked sets share a shingle within
  the first ``n - ceil(percent * n) + 1`` of each, so only those are shuffled.
* Among the classes that share such a shingle, the one with the fewest rarer shingles before it is the centre. It is
  nearest to what the others have in common, so one comparison per class with its centre joins most of a group. Only
  classes that are still in different components are compared further, and of those only pairs that involve a class
  outside the shingle's largest component.
* Each pair is compared once: pairs are made distinct and earlier ones are left out. The suffix filter comes first: hash
  ranges cut both sets into cells, and cells of different size bound the intersection from above. Cell sizes take a
  thirtieth of the sets' bytes, so whole sets are fetched for few pairs.

Defined results: null, empty and blank texts have the empty set and link with nothing; repeated rows are documents of
their own; a null id keeps its row and is nobody's smallest id; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spineloom.functions.columns import ref
from spineloom.llm import gather
from spineloom.llm.components import components
from spineloom.llm.tables import Tables, widened
from spineloom.llm.words import mix, sequence_hash, slices, texts_of, windows, word_hashes

SKETCH_BITS = 20
CENTRE_ROUNDS = 2
#: Shingles in a cell of a signature, on average.
CELL = 4
MOST_BITMAP_BITS = 1 << 28


def _sets(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    out = []
    for end, n in zip(ends, counts, strict=True):
        own = hashes[end - n : end]
        if n >= words:
            out.append(np.unique(windows(own, words)))
        else:
            out.append(np.array([sequence_hash(own)] if n else [], np.uint64))
    return out


def _class_of(shingles: np.ndarray) -> int | None:
    """A 63-bit name of the set; sets of different size never share it by size alone."""
    if not shingles.size:
        return None
    with np.errstate(over="ignore"):
        total = mix(shingles).sum(dtype=np.uint64) ^ (np.uint64(shingles.size) * np.uint64(0x9E3779B97F4A7C15))
    return int(mix(np.array([total]))[0] >> np.uint64(1))


def _signature(shingles: np.ndarray) -> bytes:
    """How many shingles are in each hash range, 255 at most, with about CELL in each; ranges halve as sets grow."""
    bits = max(0, (shingles.size // CELL).bit_length() - 1)
    cells = np.bincount((shingles >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64), minlength=1 << bits)
    return np.minimum(cells, 255).astype(np.uint8).tobytes()


def _most_shared(left: bytes, right: bytes, both: int) -> int:
    """An upper bound of the intersection of two sets of ``both`` elements together, from their signatures."""
    x, y = np.frombuffer(left, np.uint8).astype(np.int64), np.frombuffer(right, np.uint8).astype(np.int64)
    n = min(x.size, y.size)
    # A cell that is full may hold more, so cells are only added up where none is.
    if x.size != y.size and 255 in (x.max(), y.max()):
        return both // 2
    apart = np.abs(x.reshape(n, -1).sum(axis=1) - y.reshape(n, -1).sum(axis=1)).sum()
    return (both - int(apart)) // 2


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def least_overlap(n: int, percent: int) -> int:
    """The fewest shingles that a set of n shares with any set it is linked to."""
    return -(-percent * n // 100)


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes | None]]]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield part.column(0), texts_of(part.column(1))


def _described(docs: DataFrame, words: int) -> DataFrame:
    """Rows (id, n, cls, sig) of documents and, with null n, the slices of each task's sketch."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        kind = None
        for ids, texts in _batches(batches):
            kind = ids.type
            sets = _sets(texts, words)
            if sets:
                sketch += np.bincount(_bucket(np.concatenate(sets)), minlength=sketch.size).astype(np.uint32)
            none = pa.nulls(len(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([s.size for s in sets], pa.int64()),
                    pa.array([_class_of(s) for s in sets], pa.int64()),
                    pa.array([_signature(s) if s.size else None for s in sets], pa.binary()),
                    none.cast(pa.int32()),
                    none.cast(pa.binary()),
                ],
                ["id", "n", "cls", "sig", "slot", "cells"],
            )
        if kind is None:  # no row, nothing to add
            return
        part = gather.part_batch(sketch)
        none = pa.nulls(part.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(part.num_rows, kind), none, none, pa.nulls(part.num_rows, pa.binary()), *part.columns], ["id", "n", "cls", "sig", "slot", "cells"]
        )

    added = "n long, cls long, sig binary, slot int, cells binary"
    return docs.mapInArrow(task, widened(docs.select("id").schema, added))


def _prefixes(docs: DataFrame, sketch, words: int, percent: int, shared=None) -> DataFrame:
    """The rarest shingles of each class; a class comes once from each task at most.

    Without ``shared``, the shingles alone (token); with the bitmap of those that several rows hold, (token, cls, n, pos)
    of what it holds: nearly all other shingles occur once and need not be moved again.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = sketch.value
        seen: set[int] = set()
        for _, texts in _batches(batches):
            out: list[tuple[np.ndarray, int, int]] = []
            for shingles in _sets(texts, words):
                name = _class_of(shingles)
                if name is None or name in seen:
                    continue
                seen.add(name)
                n = shingles.size
                keep = n - least_overlap(n, percent) + 1
                order = np.argsort(frequency[_bucket(shingles)], kind="stable")[:keep]
                out.append((shingles[order], name, n))
            if not out:
                continue
            sizes = [tokens.size for tokens, _, _ in out]
            tokens = np.concatenate([tokens for tokens, _, _ in out])
            if shared is None:
                yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], ["token"])
                continue
            keep = _held(shared.value, tokens.view(np.int64))
            columns = (
                tokens.view(np.int64),
                np.repeat(np.array([name for _, name, _ in out], np.int64), sizes),
                np.repeat(np.array([n for _, _, n in out], np.int32), sizes),
                np.concatenate([np.arange(s, dtype=np.int32) for s in sizes]),
            )
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], ["token", "cls", "n", "pos"])

    return docs.mapInArrow(task, "token long" if shared is None else "token long, cls long, n int, pos int")


def _places(hashes: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    at = hashes & (n_bits - 1)
    return at >> 3, (at & 7).astype(np.uint8)


def _held(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes are in the bitmap; a few others seem to be."""
    byte, bit = _places(hashes, bitmap.size * 8)
    return (bitmap[byte] >> bit) & 1 == 1


def _chosen_sets(docs: DataFrame, bitmap, words: int) -> DataFrame:
    """(id, cls, n, shingles) of the documents whose id the bitmap holds, and perhaps a few more; copies that share an id
    come once from each task at most."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int | None, int | None]] = set()
        for batch in batches:
            chosen = batch.filter(pa.array(_held(bitmap.value, batch.column(2).to_numpy())))
            for ids, texts in _batches([chosen] if chosen.num_rows else []):
                rows = []
                for own, shingles in zip(ids.to_pylist(), _sets(texts, words), strict=True):
                    name = _class_of(shingles)
                    if (own, name) not in seen:
                        seen.add((own, name))
                        rows.append((own, name, shingles))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own for own, _, _ in rows], ids.type),
                        pa.array([name for _, name, _ in rows], pa.int64()),
                        pa.array([s.size for _, _, s in rows], pa.int64()),
                        pa.array([s.tobytes() for _, _, s in rows], pa.binary()),
                    ],
                    ["id", "cls", "n", "shingles"],
                )

    named = docs.select("id", "text", F.xxhash64("id").alias("hash"))
    return named.mapInArrow(task, widened(docs.select("id").schema, "cls long, n long, shingles binary"))


def _bitmap(values: DataFrame) -> np.ndarray:
    """About sixteen bits for each hash in the one long column, and never more than MOST_BITMAP_BITS: beyond that
    the bitmap lets more of the others pass, which costs time and no results. So the driver gets 64 MB at most, as four
    million words, however many values there are."""
    n_bits = 1 << (16 * max(values.count(), 1 << 12)).bit_length()
    n_bits = min(n_bits, MOST_BITMAP_BITS)

    (name,) = values.columns
    at = F.col(name).bitwiseAND(F.lit(n_bits - 1))
    cells = (
        values.where(F.col(name).isNotNull())
        .select(at.alias("at"))
        .groupBy(F.shiftright("at", 6).alias("cell"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
        .toArrow()
    )
    words = np.zeros(n_bits // 64, np.int64)
    words[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return words.view(np.uint8)


def _with_both(pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
    left = values.select(F.col("cls").alias("a"), F.col(value).alias("left"), F.col("n").alias("n_left"))
    right = values.select(F.col("cls").alias("b"), F.col(value).alias("right"), F.col("n").alias("n_right"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.select("a", "b", "left", "right", (F.col("n_left") + F.col("n_right")).alias("both"))


def _kept_pairs(pairs: DataFrame, values: DataFrame, value: str, test) -> DataFrame:
    """The pairs that ``test(left, right, both)`` lets pass."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k) for k in (2, 3)), batch.column(4).to_pylist(), strict=True)
            keep = [test(left.as_buffer(), right.as_buffer(), both) for left, right, both in rows]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return _with_both(pairs, values, value).mapInArrow(task, "a long, b long").distinct()


def _may_link(percent: int):
    # 100 * i >= p * (both - i)  <=>  (100 + p) * i >= p * both
    return lambda left, right, both: (100 + percent) * _most_shared(left, right, both) >= percent * both


def _links(percent: int):
    def test(left, right, both: int) -> bool:
        x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
        shared = both - np.unique(np.concatenate((x, y))).size
        return (100 + percent) * shared >= percent * both

    return test


def _possible(x: str, y: str, percent: int):
    """Length and positional filters on two rows of a shingle's list."""
    n_x, n_y = F.col(f"{x}.n").cast("long"), F.col(f"{y}.n").cast("long")
    rest = F.least(n_x - F.col(f"{x}.pos"), n_y - F.col(f"{y}.pos"))
    return (100 * F.least(n_x, n_y) >= percent * F.greatest(n_x, n_y)) & (
        (100 + percent) * rest >= percent * (n_x + n_y)
    )


def _named(x: str, y: str) -> list:
    return [F.least(f"{x}.cls", f"{y}.cls").alias("a"), F.greatest(f"{x}.cls", f"{y}.cls").alias("b")]


def _open(lists: DataFrame, labels: DataFrame, stored: Tables) -> DataFrame:
    """The lists that classes of several components share, each row with its component."""
    labels = labels.withColumnRenamed("node", "cls")
    placed = stored(lists.join(labels, "cls", "left").withColumn("part", F.coalesce("label", "cls")).drop("label"))
    several = placed.groupBy("token").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
    return stored(placed.join(several.select("token"), "token", "left_semi"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80):
    """One row per document: ``id_col``, ``n_shingles`` (size of its set), ``component_id`` (smallest id reachable by
    links, its own included)."""
    spark = docs.sparkSession
    source = docs.select(ref(id_col).alias("id"), ref(text_col).cast("string").alias("text"))
    stored = Tables(spark, "jaccard")
    described = stored(_described(source, words))
    counts = described.where("slot is not null").select("slot", "cells")
    sketch = gather.merged(counts, np.uint32, np.add, np.zeros(1 << SKETCH_BITS, np.uint32))
    described = described.where("slot is null").select("id", "n", "cls", "sig")
    classes = stored(described.where("cls is not null").groupBy("cls").agg(F.min("id").alias("id")))

    sketch = spark.sparkContext.broadcast(sketch)
    tokens = _prefixes(source, sketch, words, percent)
    repeated = stored(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("token"))
    shared = spark.sparkContext.broadcast(_bitmap(repeated))
    prefixes = stored(_prefixes(source, sketch, words, percent, shared))
    row = F.struct("pos", "n", "cls")
    centre = prefixes.groupBy("token").agg(
        F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.min(row).alias("centre")
    )
    lists = stored(prefixes.join(centre.where("lo < hi").select("token", "centre"), "token").distinct())

    tried: list[DataFrame] = []
    labels = spark.createDataFrame([], "node long, label long")

    def representatives(pairs: DataFrame) -> DataFrame:
        """(cls, id): one document for each class of the pairs."""
        either = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
        return stored(either.join(classes, "cls"))

    def of_these(values: DataFrame, chosen: DataFrame, value: str) -> DataFrame:
        """(cls, n, ``value``) of just these documents, one row for each class, also where copies share an id."""
        same = (values["cls"] == chosen["cls"]) & values["id"].eqNullSafe(chosen["id"])
        own = values.join(chosen, same, "left_semi").groupBy("cls")
        return stored(own.agg(F.any_value("n").alias("n"), F.any_value(value).alias(value)))

    def compare(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The components once the pairs that are similar enough are linked as well."""
        pairs = pairs.where("a != b").distinct()
        for before in tried:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs = stored(pairs)
        tried.append(pairs)
        if not pairs.take(1):
            return labels
        signatures = of_these(described.where("cls is not null"), representatives(pairs), "sig")
        alike = stored(_kept_pairs(pairs, signatures, "sig", _may_link(percent)))
        if not alike.take(1):
            return labels
        chosen = representatives(alike)
        bitmap = spark.sparkContext.broadcast(_bitmap(chosen.select(F.xxhash64("id").alias("hash"))))
        sets = of_these(_chosen_sets(source, bitmap, words), chosen, "shingles")
        links = _kept_pairs(alike, sets, "shingles", _links(percent))
        return stored(components(links.union(labels.toDF("a", "b"))))

    rows = lists.select("token", F.struct("cls", "n", "pos").alias("x"), F.col("centre").alias("y"))
    labels = compare(rows.where(_possible("x", "y", percent)).select(*_named("x", "y")), labels)
    for _ in range(CENTRE_ROUNDS - 1):
        open_ = _open(lists.drop("centre"), labels, stored)
        # Per list and component the nearest row; the nearest of another component is the centre.
        best = open_.groupBy("token", "part").agg(F.min(row).alias("y"))
        first = best.groupBy("token").agg(F.min(F.struct("y", "part")).alias("first"), F.max("part").alias("hi"))
        second = (
            best.join(first.select("token", "first"), "token")
            .where(F.col("part") != F.col("first.part"))
            .groupBy("token")
            .agg(F.min("y").alias("second"))
        )
        ends = first.select("token", "first").join(second, "token")
        rows = open_.join(ends, "token").select(
            F.struct("cls", "n", "pos").alias("x"),
            F.when(F.col("part") == F.col("first.part"), F.col("second")).otherwise(F.col("first.y")).alias("y"),
        )
        labels = compare(rows.where(_possible("x", "y", percent)).select(*_named("x", "y")), labels)
    open_ = _open(lists.drop("centre"), labels, stored)
    most = open_.groupBy("token", "part").agg(F.count(F.lit(1)).alias("m"))
    most = most.groupBy("token").agg(F.max(F.struct("m", "part")).alias("most"))
    minor = open_.join(most, "token").where(F.col("part") != F.col("most.part")).drop("most")
    x, y = minor.alias("x"), open_.alias("y")
    rest = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.part") != F.col("y.part"))
        & _possible("x", "y", percent),
    )
    labels = compare(rest.select(*_named("x", "y")), labels)

    placed = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("part", F.coalesce("label", "cls"))
    smallest = placed.groupBy("part").agg(F.min("id").alias("component_id"))
    named = stored(placed.join(smallest, "part").select("cls", "component_id"))
    full, empty = described.where("cls is not null"), described.where("cls is null")
    out = full.join(named, "cls").select("id", "n", "component_id")
    out = out.union(empty.select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
