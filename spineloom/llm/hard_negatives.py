"""Hard negatives of anchors by BOND: a vertical scan of columnar dimensions with branch and bound.

Each task packs the rows it reads into blocks of ``BLOCK_ROWS`` that hold one array per dimension, with the smallest and the
largest value of each. Anchors are packed the same way, ``ANCHOR_ROWS`` to a block, and every block of anchors meets every
block of rows: the anchors are the stated queries, and what is moved is whole blocks, paired by number, not pairs of rows.

For one anchor and one block the dimensions are read in descending magnitude of the anchor's components. After every few of
them each candidate has a partial score, and the least and the most that the dimensions still unread can add, by their
smallest and largest values, bound its score on both sides. Candidates that cannot be among the results any more leave the
bitmap; once few are left, or all dimensions are read, their scores are exact.

Two scans: the first finds each anchor's ``positives`` best other rows of its label, which gives a window of scores for each;
the second finds, inside each window, the ``negatives`` best rows of other labels. A block sends on its own best rows only,
and the best of all blocks are the result.

Scores are integers, exact in 64 bits: components are ``floor(scale * x)``.

Defined results: rows with a null id, label or vector, or a component that is null, NaN or infinite, take no part, nor do
rows with a component beyond ``LARGEST`` after scaling, whose scores may not fit 64 bits. Missing components at the end of
shorter vectors are 0. Ties go to the smaller id; rows that share an id are different rows, and a repeated anchor is searched
once for each of its rows. An anchor without positives, or a positive with an empty window, gives no rows. An empty table
gives no rows. Only the three named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spineloom.functions.columns import ref
from spineloom.llm.tables import Tables

BLOCK_ROWS = 8192
ANCHOR_ROWS = 256
#: Dimensions that are read between two looks at the bounds.
STEP = 8
#: With so few candidates left the rest of the dimensions is read at once.
FEW = 64
#: Largest magnitude of a scaled component: 2**14 products of two of them fit 64 bits.
LARGEST = 1 << 24

_BLOCK = "n int, ids binary, labels binary, rows binary, cells binary, dims int, low binary, high binary"
_BLOCK_NAMES = [part.split()[0] for part in _BLOCK.split(", ")]


def usable(df: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, label, vector) of the rows that take part; vectors as BIGINT components."""
    vector = ref(vector_col)
    real = F.transform(vector, lambda x: x.cast("double") * float(scale))
    whole = F.forall(real, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float(LARGEST)), F.lit(False)))
    return df.where(ref(id_col).isNotNull() & ref(label_col).isNotNull() & vector.isNotNull() & whole).select(
        ref(id_col).cast("bigint").alias("id"),
        ref(label_col).cast("bigint").alias("label"),
        F.transform(real, lambda x: F.floor(x)).alias("vector"),
    )


class Block:
    """Rows by dimension: ``cells[d]`` is the array of all rows' components in dimension ``d``."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, cells: np.ndarray):
        self.ids, self.labels, self.rows, self.cells = ids, labels, rows, cells
        some = cells.shape[1] > 0
        self.low = cells.min(axis=1) if some else np.zeros(len(cells), np.int64)
        self.high = cells.max(axis=1) if some else np.zeros(len(cells), np.int64)

    def packed(self) -> list:
        arrays = (self.ids, self.labels, self.rows, self.cells.astype(np.int32))
        ends = (len(self.cells), self.low.tobytes(), self.high.tobytes())
        return [len(self.ids), *[np.ascontiguousarray(a).tobytes() for a in arrays], *ends]

    @classmethod
    def unpacked(cls, n: int, ids: bytes, labels: bytes, rows: bytes, cells: bytes, dims: int, low: bytes, high: bytes) -> Block:
        out = cls.__new__(cls)
        out.ids, out.labels, out.rows = (np.frombuffer(b, np.int64) for b in (ids, labels, rows))
        out.cells = np.frombuffer(cells, np.int32).reshape(dims, n)
        out.low, out.high = np.frombuffer(low, np.int64), np.frombuffer(high, np.int64)
        return out

    def vector(self, i: int, dims: int) -> np.ndarray:
        """The components of row ``i``, cut or filled with zeros to ``dims``."""
        out = np.zeros(dims, np.int64)
        part = self.cells[:dims, i]
        out[: len(part)] = part
        return out


def _packing(rows: int):
    """Rows (row, id, label, vector) as packed blocks."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0

        def packed() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            vectors = whole.column(3)
            sizes = np.asarray(pa.compute.list_value_length(vectors)).astype(np.int64)
            cells = np.zeros((int(sizes.max(initial=0)), whole.num_rows), np.int64)
            owner = np.repeat(np.arange(whole.num_rows), sizes)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            cells[place, owner] = np.asarray(vectors.flatten())
            row, ids, labels = (np.asarray(whole.column(i)) for i in range(3))
            block = Block(ids, labels, row, cells)
            return pa.RecordBatch.from_pylist([dict(zip(_BLOCK_NAMES, block.packed(), strict=True))], schema=_ARROW_BLOCK)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, rows - n)
                held.append(part)
                at, n = at + part.num_rows, n + part.num_rows
                if n == rows:
                    yield packed()
                    held, n = [], 0
        if n:
            yield packed()

    return task


_ARROW_BLOCK = pa.schema([(name, pa.int32() if name in ("n", "dims") else pa.binary()) for name in _BLOCK_NAMES])


def scan(anchor: np.ndarray, block: Block, candidates: np.ndarray, cut) -> tuple[np.ndarray, np.ndarray]:
    """The candidates that ``cut`` leaves and their exact scores.

    ``cut(candidates, least, most)`` gets bounds of the candidates' scores and returns a mask of those that may still be
    results.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    order = order[anchor[order] != 0]  # the others add nothing
    small, large = anchor * block.low, anchor * block.high
    most = np.cumsum(np.maximum(small, large)[order][::-1])[::-1]
    least = np.cumsum(np.minimum(small, large)[order][::-1])[::-1]
    score = np.zeros(len(candidates), np.int64)
    for at in range(0, len(order), STEP):
        if len(candidates) <= FEW:
            rest = order[at:]
            score += anchor[rest] @ block.cells[np.ix_(rest, candidates)]
            break
        if at:
            alive = cut(candidates, score + least[at], score + most[at])
            candidates, score = candidates[alive], score[alive]
        for d in order[at : at + STEP]:
            score += anchor[d] * block.cells[d, candidates]
    alive = cut(candidates, score, score)
    return candidates[alive], score[alive]


def _kth_largest(values: np.ndarray, k: int):
    """The k-th largest value, or None if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def best_positives(anchor: np.ndarray, label: int, row: int, block: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the anchor's label, itself left out, that may be among its ``k`` best."""

    def cut(candidates: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        bar = _kth_largest(least, k)
        return np.ones(len(candidates), bool) if bar is None else most >= bar

    return scan(anchor, block, np.flatnonzero((block.labels == label) & (block.rows != row)), cut)


def best_negatives(
    anchor: np.ndarray, label: int, lows: np.ndarray, highs: np.ndarray, block: Block, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of other labels that may be among the ``k`` best within any of the windows ``lows`` up to ``highs``."""

    def cut(candidates: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        alive = np.zeros(len(candidates), bool)
        for low, high in zip(lows, highs, strict=True):
            touching = (most >= low) & (least <= high)
            # Those surely inside are bounded below; k of them bar all that stay under the k-th.
            bar = _kth_largest(least[touching & (least >= low) & (most <= high)], k)
            alive |= touching if bar is None else touching & (most >= bar)
        return alive

    return scan(anchor, block, np.flatnonzero(block.labels != label), cut)


def _met(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of anchors beside every block of rows: both are numbered and paired by their two numbers."""
    n_rows, n_anchors = (df.agg(F.max("number")).first()[0] for df in (rows, anchors))

    def spread(df: DataFrame, other: str, last: int | None) -> DataFrame:
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(last or 0))))

    left = spread(rows.withColumnRenamed("number", "rows_number"), "anchors_number", n_anchors)
    right = spread(anchors.withColumnRenamed("number", "anchors_number"), "rows_number", n_rows)
    right = right.select("rows_number", "anchors_number", F.struct(*[c for c in anchors.columns if c != "number"]).alias("anchors"))
    return left.join(right, ["rows_number", "anchors_number"]).select(F.struct(*_BLOCK_NAMES).alias("rows"), "anchors")


def _blocks(store: Tables, df: DataFrame, rows: int) -> DataFrame:
    """Packed blocks on shared storage, numbered from 0 without gaps: one row stands for ``rows`` rows of the table."""
    packed = store(df.mapInArrow(_packing(rows), _BLOCK).withColumn("__id", F.monotonically_increasing_id()))
    numbers = packed.select("__id").withColumn("number", F.row_number().over(Window.orderBy("__id")) - 1)
    return store(packed.join(numbers, "__id").drop("__id"))


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Block, Block, dict]]:
    for batch in batches:
        for i in range(batch.num_rows):
            rows, anchors = (batch.column(k)[i].as_py() for k in (0, 1))
            windows = anchors.pop("windows", None)
            yield Block.unpacked(**rows), Block.unpacked(**anchors), windows


_FOUND = "anchor bigint, id bigint, other bigint, score bigint"
_FOUND_NAMES = [part.split()[0] for part in _FOUND.split(", ")]


def _sent(found: list[tuple]) -> pa.RecordBatch:
    columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in zip(*found, strict=True)] or [np.empty(0, np.int64)] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _FOUND_NAMES)


def _best(ids: np.ndarray, rows: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: higher scores first, then smaller ids, then rows as they were read."""
    return np.lexsort((rows, ids, -score))[:k]


def _positives(met: DataFrame, k: int) -> DataFrame:
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, anchors, _ in _pairs(batches):
            found = []
            for a in range(len(anchors.ids)):
                vector = anchors.vector(a, len(block.cells))
                places, score = best_positives(vector, anchors.labels[a], anchors.rows[a], block, k)
                top = _best(block.ids[places], block.rows[places], score, k)
                n = len(top)
                found.append((np.full(n, anchors.rows[a]), block.ids[places[top]], block.rows[places[top]], score[top]))
            yield _sent(found)

    best = met.mapInArrow(task, _FOUND)
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "other")
    return best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _negatives(met: DataFrame, k: int, least: int, most: int) -> DataFrame:
    """Candidates of all windows: ``other`` is the score of the positive whose window holds the negative."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, anchors, windows in _pairs(batches):
            scores = {w["row"]: w["scores"] for w in windows or ()}
            found = []
            for a in range(len(anchors.ids)):
                own = sorted({s for s in scores.get(int(anchors.rows[a]), ()) if s * least <= s * most})
                if not own:
                    continue
                positive = np.array(own, np.int64)
                lows, highs = -(-positive * least // 100), positive * most // 100
                vector = anchors.vector(a, len(block.cells))
                places, score = best_negatives(vector, anchors.labels[a], lows, highs, block, k)
                for p, low, high in zip(own, lows, highs, strict=True):
                    inside = np.flatnonzero((score >= low) & (score <= high))
                    top = inside[_best(block.ids[places[inside]], block.rows[places[inside]], score[inside], k)]
                    n = len(top)
                    found.append((np.full(n, anchors.rows[a]), block.ids[places[top]], np.full(n, p), score[top]))
            yield _sent(found)

    return met.mapInArrow(task, _FOUND)


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int] = (80, 100),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (``anchors``: a condition
    over ``id`` and ``label``) and each of its best rows of the same label, the best rows of other labels whose score is between
    ``window`` percent of the positive's."""
    store = Tables(df.sparkSession, "bond")
    # Rows are told apart by their number, which is stored: another job may read the files in other parts.
    table = store(usable(df, id_col, label_col, vector_col, scale).withColumn("row", F.monotonically_increasing_id()))
    table = table.select("row", "id", "label", "vector")
    queries = store(table.where(anchors))
    blocks = _blocks(store, table, BLOCK_ROWS)
    n = queries.count()
    packed = _blocks(store, queries.repartition(max(1, -(-n // ANCHOR_ROWS))), ANCHOR_ROWS)

    found = store(_positives(_met(blocks, packed), positives).withColumnsRenamed({"id": "positive_id", "score": "positive_score"}))
    # Each block of anchors takes along the scores of its anchors' positives.
    scores = found.groupBy("anchor").agg(F.collect_list("positive_score").alias("scores"))
    owner = queries.select("row", "id").join(scores, F.col("row") == F.col("anchor")).select("row", "scores")
    numbered = _members(packed)
    windows = numbered.join(owner, "row").groupBy("number").agg(F.collect_list(F.struct("row", "scores")).alias("windows"))
    searching = packed.join(windows, "number")
    candidates = _negatives(_met(blocks, searching), negatives, *window)
    # Of equal scores the same rows follow: windows are ranked once for each anchor and score.
    order = Window.partitionBy("anchor", "other").orderBy(F.col("score").desc(), "id")
    ranked = candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    ranked = ranked.select("anchor", F.col("other").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = queries.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    whole = found.select("anchor", "positive_id", "positive_score").join(ranked, ["anchor", "positive_score"]).join(names, "anchor")
    return whole.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _members(packed: DataFrame) -> DataFrame:
    """(number, row): which rows each block holds."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = np.frombuffer(rows, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), number), pa.int32()), pa.array(held)], ["number", "row"])

    return packed.select("number", "rows").mapInArrow(task, "number int, row bigint")
