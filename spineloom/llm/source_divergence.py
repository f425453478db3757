"""How far apart the sources of each language are in their use of words, by in-mapper stripes.

A task folds the whole documents of its partition into one hash stripe per term: the number of documents that hold it, and
its occurrences by source. A full table is spilled: its stripes leave as rows and it starts empty. Spilled stripes are
sorted by key, and stripes of equal key, neighbours then, are merged as they stream by. What a task sends of a term does not
depend on how often the term occurs, so no term is hot. A language keeps the terms that ``least_docs`` of its documents hold.

The merged stripes emit the divergences themselves. Each (language, lane) gets the totals of the language's sources, which
precede its stripes in sort order, so nothing is broadcast; a lane sums ``|p - q|`` over its terms for all pairs of sources
and holds the best ``top`` terms of each source. Sums of lanes are added.

All arithmetic is exact: ``p = 1 + floor(SCALE * (count + smoothing) / (total + smoothing * terms))`` is taken by long
division in 64 bits, three decimal digits at a time.

Defined results: a null text, language or source is read as ''. A document without terms still makes its source occur. A
language without kept terms has value 0 for every pair and no terms. Ties go to the smaller name in UTF-8 order. Repeated
rows count as often as they occur; a very long text is read in pieces, and counts as one document; an empty table gives no
rows. Only the three named columns are read, whatever others are called.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spineloom.functions.columns import ref
from spineloom.llm.tables import Tables

SCALE = 1_000_000_000
#: A task's table is spilled at so many entries (terms, and sources of terms).
MOST_ENTRIES = 600_000
#: Bytes of a text that are folded at once.
PIECE = 1 << 20
#: Lanes that a language's merged stripes are dealt to.
LANES = 32
#: Cells of a dense block of terms by sources, and of pair sums that a lane holds before it sends them on.
MOST_CELLS = 1 << 20

STRIPE = "lang string, term string, docs bigint, sources array<string>, counts array<bigint>"
_OUT = "lang string, source string, part string, item string, value bigint"
_ARROW_STRIPE = pa.schema(
    [("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]
)
_ARROW_OUT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])

# Lower-cases A-Z, keeps letters and the bytes of other characters, and turns the rest into blanks.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _terms(text: bytes) -> Counter:
    """The terms of a text with their number of occurrences."""
    if len(text) <= PIECE:
        return Counter(text.translate(_WORDS).split())
    found: Counter = Counter()
    plain = text.translate(_WORDS)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        found.update(plain[at:end].split())
        at = end
    return found


def _spilled(table: dict[str, dict[bytes, dict]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The stripes of a table as rows. In a stripe the key -1 has the number of documents, the others are sources."""
    known = pa.array(names, pa.string())
    for lang, stripes in table.items():
        if not stripes:
            continue
        docs, sizes, sources, counts = [], [], [], []
        for stripe in stripes.values():
            docs.append(stripe.pop(-1))
            sizes.append(len(stripe))
            sources.extend(stripe)
            counts.extend(stripe.values())
        offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
        terms = pa.array(list(stripes), pa.binary()).cast(pa.string())
        columns = [
            pa.array([lang], pa.string()).take(pa.array(np.zeros(len(docs), np.int32))),
            terms,
            pa.array(docs, pa.int64()),
            pa.ListArray.from_arrays(offsets, known.take(pa.array(sources, pa.int32()))),
            pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
        ]
        whole = pa.RecordBatch.from_arrays(columns, schema=_ARROW_STRIPE)
        for a in range(0, whole.num_rows, 20_000):
            yield whole.slice(a, 20_000)


def fold(batches: Iterable[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Whole documents (lang, source, text) as stripes; a table is spilled when it holds ``most`` entries."""
    most = most or MOST_ENTRIES
    table: dict[str, dict[bytes, dict]] = {}
    names: list[str] = []
    number: dict[str, int] = {}
    entries = 0
    for batch in batches:
        langs, sources, texts = (batch.column(i) for i in range(3))
        for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts.cast(pa.binary()).to_pylist(), strict=True):
            stripes = table.setdefault(lang, {})
            k = number.get(source)
            if k is None:
                k = number[source] = len(names)
                names.append(source)
            for term, n in _terms(text).items():
                stripe = stripes.get(term)
                if stripe is None:
                    stripes[term] = {-1: 1, k: n}
                    entries += 2
                else:
                    stripe[-1] += 1
                    held = stripe.get(k)
                    if held is None:
                        stripe[k] = n
                        entries += 1
                    else:
                        stripe[k] = held + n
            if entries >= most:
                yield from _spilled(table, names)
                table, names, number, entries = {}, [], {}, 0
    yield from _spilled(table, names)


def _merge_equal(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Neighbouring rows of equal (lang, term) as one: document counts added, stripes merged by source."""
    if batch.num_rows < 2:
        return batch
    lang, term = batch.column(0), batch.column(1)
    same = pc.and_(pc.equal(lang.slice(1), lang.slice(0, len(lang) - 1)), pc.equal(term.slice(1), term.slice(0, len(term) - 1)))
    new = np.concatenate(([True], ~np.asarray(same)))
    if new.all():
        return batch
    firsts = np.flatnonzero(new)
    owner = np.cumsum(new) - 1
    docs = np.add.reduceat(np.asarray(batch.column(2)), firsts)
    sizes = np.diff(np.asarray(batch.column(3).offsets))
    coded = batch.column(3).flatten().dictionary_encode()
    width = max(1, len(coded.dictionary))
    cell = np.repeat(owner, sizes) * width + np.asarray(coded.indices)
    cells, place = np.unique(cell, return_inverse=True)
    counts = np.zeros(len(cells), np.int64)
    np.add.at(counts, place, np.asarray(batch.column(4).flatten()))
    offsets = pa.array(np.searchsorted(cells, np.arange(len(firsts) + 1) * width).astype(np.int32))
    keep = pa.array(firsts)
    columns = [
        lang.take(keep),
        term.take(keep),
        pa.array(docs),
        pa.ListArray.from_arrays(offsets, coded.dictionary.take(pa.array(cells % width))),
        pa.ListArray.from_arrays(offsets, pa.array(counts)),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW_STRIPE)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts, _ARROW_STRIPE).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0]


def merge_sorted(batches: Iterable[pa.RecordBatch], least_docs: int) -> Iterator[pa.RecordBatch]:
    """Stripes sorted by key, merged; those of fewer than ``least_docs`` documents end here."""
    open_: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.RecordBatch.from_arrays(batch.columns, schema=_ARROW_STRIPE)
        merged = _merge_equal(batch if open_ is None else _joined([open_, batch]))
        # The last stripe may go on in the next batch.
        open_ = merged.slice(merged.num_rows - 1)
        done = merged.slice(0, merged.num_rows - 1)
        yield done.filter(pc.greater_equal(done.column(2), least_docs))
    if open_ is not None:
        yield open_.filter(pc.greater_equal(open_.column(2), least_docs))


def share(counts: np.ndarray, total, smoothing: int) -> np.ndarray:
    """``1 + floor(SCALE * (counts + smoothing) / total)``; ``counts + smoothing`` is at most ``total``, which is below 2**53."""
    rest = np.asarray(counts, np.int64) + smoothing
    out = np.zeros(np.broadcast(rest, total).shape, np.int64)
    for _ in range(3):  # SCALE is 1000 ** 3
        step, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + step
    return out + 1


class _Lane:
    """The stripes of one (language, lane): sums for all pairs of sources, and the best terms of each source."""

    def __init__(self, lang: str, sources: list[str], totals: list[int], terms: int, smoothing: int, top: int):
        self.lang, self.sources, self.smoothing, self.top = lang, sources, smoothing, top
        self.place = pa.array(sources, pa.string())
        self.total = np.array(totals, np.int64) + smoothing * terms
        self.whole = int(sum(totals)) + smoothing * terms
        n = len(sources)
        self.held = n * (n - 1) // 2 <= MOST_CELLS
        self.sums = [np.zeros(n - a - 1, np.int64) for a in range(n)] if self.held else []
        self.best: list[list[tuple[int, bytes]]] = [[] for _ in range(n)]

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = max(1, MOST_CELLS // max(1, len(self.sources)))
        for a in range(0, batch.num_rows, rows):
            yield from self._add(batch.slice(a, rows))

    def _add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = len(self.sources)
        row = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(batch.column(3))))
        column = np.asarray(pc.index_in(batch.column(3).flatten(), self.place))
        count = np.zeros((batch.num_rows, n), np.int64)
        count[row, column] = np.asarray(batch.column(4).flatten())
        p = share(count, self.total, self.smoothing)
        q = share(count.sum(axis=1), self.whole, self.smoothing)[:, None]
        for a in range(n - 1):
            apart = np.abs(p[:, a + 1 :] - p[:, a : a + 1]).sum(axis=0)
            if self.held:
                self.sums[a] += apart
            else:
                yield self._pairs(a, apart)
        names = batch.column(1).cast(pa.binary())
        ahead = np.where((count > 0) & (p > q), p - q, 0)
        for k in range(n):
            value = ahead[:, k]
            found = np.flatnonzero(value)
            if len(found) > self.top:  # all that reach the last of the best values, ties included
                least = np.partition(value[found], len(found) - self.top)[len(found) - self.top]
                found = found[value[found] >= least]
            if len(found):
                more = zip((-value[found]).tolist(), names.take(pa.array(found)).to_pylist(), strict=True)
                self.best[k] = sorted([*self.best[k], *more])[: self.top]

    def _pairs(self, a: int, sums: np.ndarray) -> pa.RecordBatch:
        others = self.sources[a + 1 :]
        return _out(self.lang, [self.sources[a]] * len(others), "pair", others, sums)

    def close(self) -> Iterator[pa.RecordBatch]:
        for a in range(len(self.sources) - 1):
            yield self._pairs(a, self.sums[a] if self.held else np.zeros(len(self.sources) - a - 1, np.int64))
        for source, best in zip(self.sources, self.best, strict=True):
            if best:
                yield _out(self.lang, [source] * len(best), "term", [t.decode() for _, t in best], [-v for v, _ in best])


def _out(lang: str, sources: list[str], part: str, items: list[str], values) -> pa.RecordBatch:
    n = len(items)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), pa.array(sources, pa.string()), pa.array([part] * n), pa.array(items, pa.string()), pa.array(values, pa.int64())],
        schema=_ARROW_OUT,
    )


def emit(batches: Iterable[pa.RecordBatch], smoothing: int, top: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lang, lane, is stripe): first a language's sources (total in ``total``, its number of kept terms in
    ``docs``), then the merged stripes of a lane."""
    lane: _Lane | None = None
    at = None
    header: tuple[list[str], list[int], int] = ([], [], 0)

    def opened() -> _Lane:
        return _Lane(at[0], *header, smoothing, top)

    for batch in batches:
        langs, lanes, kinds = (np.asarray(batch.column(i).to_pandas()) for i in range(3))
        if not batch.num_rows:
            continue
        change = (langs[1:] != langs[:-1]) | (lanes[1:] != lanes[:-1]) | (kinds[1:] != kinds[:-1])
        cuts = np.concatenate(([0], np.flatnonzero(change) + 1, [batch.num_rows]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part, key = batch.slice(a, b - a), (langs[a], lanes[a])
            if key != at:
                if at is not None:
                    yield from (lane or opened()).close()
                at, lane, header = key, None, ([], [], 0)
            if not kinds[a]:
                names, totals, terms = (part.column(i).to_pylist() for i in (3, 7, 4))
                header = (header[0] + names, header[1] + totals, terms[0])
            else:
                lane = lane or opened()
                stripes = pa.RecordBatch.from_arrays([part.column(i) for i in (0, 3, 4, 5, 6)], schema=_ARROW_STRIPE)
                yield from lane.add(stripes)
    if at is not None:
        yield from (lane or opened()).close()


def _read(name: str) -> Column:
    return F.coalesce(ref(name).cast("string"), F.lit(""))


def stripes(docs: DataFrame, least_docs: int, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """One merged stripe for each kept term of each language: (lang, term, docs, sources, counts)."""
    read = docs.select(_read(lang).alias("lang"), _read(source).alias("source"), _read(text).alias("text"))
    spilled = read.mapInArrow(fold, STRIPE)
    # The hash sorts by one number; names decide where two keys share it.
    keyed = spilled.withColumn("__key", F.xxhash64("lang", "term")).repartition("__key")
    ordered = keyed.sortWithinPartitions("__key", "lang", "term").drop("__key")
    return ordered.mapInArrow(lambda batches: merge_sorted(batches, least_docs), STRIPE)


def divergences(
    docs: DataFrame,
    least_docs: int = 30,
    smoothing: int = 5,
    top: int = 50,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """(lang, source, part, item, value, rank): of each source the divergence from every other source of its language
    (part ``pair``), and the ``top`` terms it uses more than its language does (part ``term``)."""
    spark = docs.sparkSession
    kept = Tables(spark, "stripes")(stripes(docs, least_docs, lang, source, text))
    occurring = docs.select(_read(lang).alias("lang"), _read(source).alias("source")).distinct()
    counted = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    totals = counted.groupBy("lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("total"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    groups = occurring.join(totals, ["lang", "source"], "left").join(terms, "lang", "left").na.fill(0, ["total", "terms"])

    nothing = F.lit(None)
    header = groups.select(
        "lang",
        F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))).alias("lane"),
        F.lit(False).alias("stripe"),
        F.col("source").alias("name"),
        F.col("terms").alias("docs"),
        nothing.cast("array<string>").alias("sources"),
        nothing.cast("array<bigint>").alias("counts"),
        "total",
    )
    body = kept.select(
        "lang",
        F.pmod(F.xxhash64("term"), F.lit(LANES)).cast("int").alias("lane"),
        F.lit(True).alias("stripe"),
        F.col("term").alias("name"),
        "docs",
        "sources",
        "counts",
        nothing.cast("bigint").alias("total"),
    )
    dealt = header.unionByName(body).repartition("lang", "lane").sortWithinPartitions("lang", "lane", "stripe", "name")
    found = dealt.mapInArrow(lambda batches: emit(batches, smoothing, top), _OUT)

    # Sums of lanes are added; a lane holds each of its terms once.
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    both = F.when(F.col("part") == "term", F.array(F.struct("source", "item"))).otherwise(
        F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    )
    rows = summed.select("lang", "part", "value", F.inline(both))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
