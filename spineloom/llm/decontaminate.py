"""Benchmark decontamination: an FM-index for every shard of training texts, searched for the windows of the benchmark.

Words are lower-cased (A-Z) runs of digits, letters and non-ASCII characters. A window is ``size`` consecutive words of
a benchmark item; a shorter item is one window. Every word of a text inside an occurrence of a window is hit; hit spans
that touch or overlap are one removal span.

A shard is a run of documents with about two megabytes of text, inside one task. Words outside the windows' vocabulary
can be in no match; they become ends of runs, and runs shorter than the shortest window are left out of the index. The
benchmark goes to the tasks in blocks of ``BLOCK`` (window, item) pairs, so no broadcast grows with it: each further block is
one more pass of the texts through the same stage, without a shuffle.

Defined results: null texts and items have no words; items without words have no window; the windows of repeated items and
ids count once; a null item id is left out of the list of items but its windows hit; an empty benchmark or table gives no
hits or no rows; columns of the input are kept but for those the result adds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spineloom.durable import durable
from spineloom.functions.columns import ref
from spineloom.llm.fm_index import FMIndex
from spineloom.llm.tables import through_arrow, widened
from spineloom.llm.words import NOT_ALPHANUMERIC, slices, texts_of, word_hashes

BLOCK = 50_000
ADDED = "n_words bigint, spans array<struct<first:int,last:int,begin:int,end:int>>, items array<string>"


@dataclass(frozen=True)
class Block:
    """Distinct windows as symbols of their own vocabulary (sorted word hashes; symbol 0 is any other word)."""

    vocabulary: np.ndarray
    phrases: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]


def _windows(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Distinct (window, item): word hashes of every window of every item."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts = word_hashes(texts_of(batch.column(1)), NOT_ALPHANUMERIC)
            ends = np.cumsum(counts)
            windows, items = [], []
            for item, end, n in zip(batch.column(0).to_pylist(), ends, counts, strict=True):
                own = hashes[end - n : end].view(np.int64)
                for at in range(max(1, n - size + 1) if n else 0):
                    windows.append(own[at : at + size].tolist())
                    items.append(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.list_(pa.int64())), pa.array(items, pa.string())], ["window", "item"]
            )

    source = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(task, "window array<bigint>, item string").distinct()


def blocks(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> Iterator[Block]:
    """The windows in blocks of about BLOCK pairs; pairs are dealt by hash, so an item or window may be in several."""
    pairs = durable(_windows(benchmark, id_col, text_col, size))
    n_blocks = max(1, -(-pairs.count() // BLOCK))
    for number in range(n_blocks):
        own = pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(n_blocks)) == number)
        items: dict[tuple[int, ...], list[str]] = {}
        for row in own.collect():
            held = items.setdefault(tuple(row.window), [])
            if row.item is not None:
                held.append(row.item)
        if not items:
            continue
        lengths = np.fromiter(map(len, items), np.int64, len(items))
        vocabulary = np.unique(np.fromiter((h for w in items for h in w), np.int64).view(np.uint64))
        phrases = np.zeros((len(items), int(lengths.max())), np.int64)
        for k, window in enumerate(items):
            symbols = np.searchsorted(vocabulary, np.array(window, np.int64).view(np.uint64)) + 1
            phrases[k, phrases.shape[1] - len(window) :] = symbols
        yield Block(vocabulary, phrases, lengths, list(items.values()))


def matches(hashes: np.ndarray, counts: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(word position in the shard, window) of every occurrence."""
    none = np.empty(0, np.int64)
    if not block.lengths.size:
        return none, none
    place = np.searchsorted(block.vocabulary, hashes)
    place[place == block.vocabulary.size] = 0
    symbols = np.where(block.vocabulary[place] == hashes, place + 1, 0)
    # Runs end at other words and at the ends of texts.
    closes = np.zeros(hashes.size + 1, bool)
    closes[np.cumsum(counts)] = True
    edge = np.flatnonzero(closes | np.concatenate((symbols == 0, [True])))
    previous = np.concatenate(([0], edge[:-1]))
    begins = np.where(np.concatenate((symbols, [0]))[previous] == 0, previous + 1, previous)
    begins[0] = 0
    sizes = edge - begins
    keep = sizes >= int(block.lengths.min())
    begins, sizes = begins[keep], sizes[keep]
    if not begins.size:
        return none, none
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    origin = np.repeat(begins - starts, sizes + 1) + np.arange(text.size)
    inside = np.ones(text.size, bool)
    inside[starts + sizes] = False
    text[inside] = symbols[origin[inside]]
    index = FMIndex(text, block.vocabulary.size + 1)
    lo, hi = index.search(block.phrases, block.lengths)
    found = hi - lo
    windows = np.repeat(np.arange(found.size), found)
    rows = np.repeat(lo - (np.cumsum(found) - found), found) + np.arange(int(found.sum()))
    return origin[index.locate(rows)], windows


def _characters(text: bytes, at: np.ndarray) -> np.ndarray:
    """Byte offsets as character offsets."""
    before = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return before[at]


def _search(df: DataFrame, block: Block, text_col: str) -> DataFrame:
    """``df`` with the hits of one block merged into ``n_words``, ``spans`` and ``items``."""
    shared = df.sparkSession.sparkContext.broadcast(block)
    kept = [c for c in df.columns if c not in ("n_words", "spans", "items")]
    schema = widened(df.select(*map(ref, kept)).schema, ADDED)
    names = [*kept, "n_words", "spans", "items"]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for part in slices(batch, text_col):
                at = {name: k for k, name in enumerate(part.schema.names)}
                texts = texts_of(part.column(at[text_col]))
                hashes, counts, begins, ends = word_hashes(texts, NOT_ALPHANUMERIC, spans=True)
                where, window = matches(hashes, counts, block)
                borders = np.concatenate(([0], np.cumsum(counts)))
                spans = part.column(at["spans"]).to_pylist()
                items = part.column(at["items"]).to_pylist()
                depth = np.zeros(hashes.size + 1, np.int64)
                np.add.at(depth, where, 1)
                np.add.at(depth, where + block.lengths[window], -1)
                covered = np.cumsum(depth) > 0
                owner = np.searchsorted(borders, where, "right") - 1
                for doc in np.unique(owner):
                    a, b = borders[doc], borders[doc + 1]
                    hit = covered[a:b].copy()
                    for old in spans[doc]:
                        hit[old["first"] : old["last"]] = True
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0]))))
                    first, last = edges[::2], edges[1::2]
                    begin = _characters(texts[doc], begins[a + first])
                    end = _characters(texts[doc], ends[a + last - 1])
                    spans[doc] = [
                        {"first": f, "last": n, "begin": x, "end": y}
                        for f, n, x, y in zip(*(v.tolist() for v in (first, last, begin, end)), strict=True)
                    ]
                pairs = np.unique(np.stack((owner, window)), axis=1) if where.size else np.empty((2, 0), np.int64)
                found: dict[int, set[str]] = {}
                for doc, number in pairs.T.tolist():
                    found.setdefault(doc, set(items[doc])).update(block.items[number])
                for doc, own in found.items():
                    items[doc] = sorted(own)
                span = pa.struct([(n, pa.int32()) for n in ("first", "last", "begin", "end")])
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(at[c]) for c in kept],
                        pa.array(counts),
                        pa.array(spans, pa.list_(span)),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names,
                )

    return through_arrow(df, task, schema)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = 10,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` and ``items`` (sorted ids of items with a window in the text).

    A span holds its first and last-plus-one word (``first``, ``last``) and the characters from ``begin`` up to ``end``.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "spans", "items", text_col)]
    df = docs.select(
        *map(ref, kept),
        ref(text_col).cast("string").alias(text_col),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<struct<first:int,last:int,begin:int,end:int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    searched = False
    for block in blocks(benchmark, item_id, item_text, size):
        df, searched = _search(df, block, text_col), True
    return df if searched else _search(df, NO_WINDOWS, text_col)


NO_WINDOWS = Block(np.empty(0, np.uint64), np.empty((0, 1), np.int64), np.empty(0, np.int64), [])


def without_spans(text_col: str = "text"):
    """The text with its removal spans cut out."""
    pieces = F.transform(
        F.concat(F.col("spans.end"), F.array(F.char_length(text_col))),
        lambda end, i: F.substring(
            F.col(text_col),
            F.when(i == 0, 1).otherwise(F.get(F.col("spans.end"), i - 1) + 1),
            F.coalesce(F.get(F.col("spans.begin"), i), F.char_length(text_col))
            - F.when(i == 0, 0).otherwise(F.get(F.col("spans.end"), i - 1)),
        ),
    )
    return F.when(F.size("spans") > 0, F.array_join(pieces, "")).otherwise(F.col(text_col))
