"""Language-model scoring by Brown's class-based n-grams.

Tokens are words between white space (A-Z lower-cased) and one end per text. Every word that occurs ``LEAST_COUNT`` times or
more has a class of its own choice, at any size of the corpus, by exchange clustering in two steps:

* A start for all: the end, each of the ``WORDS`` most frequent words, and ``ENDINGS`` groups of all other words by their last
  three bytes are units that move between ``CLASSES`` classes, one after the other, as long as the likelihood of the training
  text grows.
* ``ROUNDS`` rounds over the corpus: Spark counts, for each of those words, the classes before and after it, and every word
  goes to the class that gains most by the same exchange formula, all of them at once. The round whose class pairs have the
  highest likelihood is kept.

Only rarer and unseen words, whose contexts say little, keep the class of their ending. Where a text is read, the classes of
the ``HELD`` most frequent words are looked up; those of all further words stay in a table. There the text is counted as if
these words had the class of their ending, and the pairs they are part of, kept as a table too, are joined with their classes
to put that right: ``HELD`` decides what is moved, and no result. Then

    P(w | previous) = share * P(class | previous class) * P(w | class) + (1 - share) * P(w)

with P(w | class) = (c + 0.5) / (n + 0.5 (v + 1)) over the class's n tokens and v words, P(w) the same over all training
tokens, and P(class | previous class) drawn towards P(class). Both parts hold the factor c + 0.5, so a text's score is
a sum over words of log10(c + 0.5) and a sum over class pairs. The second needs a table of a fixed size; of the first, the
``CORE`` most frequent words are looked up where the text is read, and the rest is joined with the counts.

All counts cover all training texts. Words are told apart by 64-bit hashes.

Defined results: null, empty and blank texts are one end token; repeated rows count and are scored each; a null id is not
held out; without training texts every token is unknown (base_score 0 for each); an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spineloom.durable import durable, passing_path
from spineloom.llm import gather
from spineloom.llm.tables import Tables, widened
from spineloom.llm.words import mix, slices, texts_of, word_hashes

#: A word of its own class occurs so often.
LEAST_COUNT = 20
#: Words of their own class that are looked up where a text is read.
HELD = 1 << 20
ROUNDS = 2
#: Units of the start.
WORDS = 767
ENDINGS = 256
UNITS = 1 + WORDS + ENDINGS
CLASSES = 64
CORE = 1 << 18
PASSES = 8
SHARE = 0.95
PULL = 5.0
END = np.uint64(0x454E44)
MOST_HELD = 1 << 20


def _tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, endings' buckets, tokens of each text), with the end after every text's words."""
    hashes, counts, endings = word_hashes(texts, endings=True)
    ends = np.cumsum(counts)
    buckets = (mix(endings) % np.uint64(ENDINGS)).astype(np.int32)
    return np.insert(hashes, ends, END), np.insert(buckets, ends, 0), counts + 1


def _starts(words: np.ndarray) -> tuple[np.uint64, np.ndarray]:
    """For sorted hashes, which are evenly spread: a shift to their first bits, and where each of these begins."""
    bits = max(1, int(words.size).bit_length())
    shift = np.uint64(64 - bits)
    return shift, np.searchsorted(words, np.arange(1 << bits, dtype=np.uint64) << shift)


def _places(words: np.ndarray, starts: tuple[np.uint64, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Where each hash is in the sorted ``words``, of which there is one at least, if it is one of them."""
    shift, first = starts
    last = words.size - 1
    place = np.minimum(first[hashes >> shift], last)
    below = np.flatnonzero((words[place] < hashes) & (place < last))
    while below.size:
        place[below] += 1
        at = place[below]
        below = below[(words[at] < hashes[below]) & (at < last)]
    return place


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts the codes, a few sorted runs, and where in it each different code begins."""
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    fresh = np.ones(codes.size, bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    return order, np.flatnonzero(fresh)


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, bucket, c) of every word of ``texts`` (text); summed in each task before anything is moved."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, bucket, n = (np.concatenate(part) for part in zip(*held, strict=True))
            order, at = _runs(h)
            first = order[at]
            return h[first], bucket[first], np.add.reduceat(n[order], at)

        def batch() -> pa.RecordBatch:
            h, bucket, n = summed()
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(bucket), pa.array(n)], ["h", "bucket", "c"]
            )

        for source in batches:
            for part in slices(source, "text"):
                h, bucket, _ = _tokens(texts_of(part.column(0)))
                own, first, n = np.unique(h, return_index=True, return_counts=True)
                held.append((own, bucket[first], n))
                if sum(x[0].size for x in held) > MOST_HELD:
                    held[:] = [summed()]
                    if held[0][0].size > MOST_HELD // 2:
                        yield batch()
        if held:
            yield batch()

    own = texts.select("text").mapInArrow(task, "h long, bucket int, c long")
    return own.groupBy("h", "bucket").agg(F.sum("c").alias("c"))


def _units(hashes: np.ndarray, buckets: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The unit of each token; ``frequent`` holds the sorted hashes of the words that are their own unit."""
    out = 1 + WORDS + buckets.astype(np.int64)
    if frequent.size:
        place = np.minimum(np.searchsorted(frequent, hashes), frequent.size - 1)
        out = np.where(frequent[place] == hashes, 1 + place, out)
    return np.where(hashes == END, 0, out)


def unit_pairs(texts: DataFrame, frequent) -> np.ndarray:
    """How often each unit follows each other one, from [previous, next]; a text's first token follows an end."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(UNITS * UNITS, np.int64)
        for source in batches:
            for part in slices(source, "text"):
                h, bucket, _ = _tokens(texts_of(part.column(0)))
                unit = _units(h, bucket, frequent.value)
                total += np.bincount(np.concatenate(([0], unit[:-1])) * UNITS + unit, minlength=total.size)
        yield gather.part_batch(total)

    part = texts.select("text").mapInArrow(task, gather.SCHEMA)
    return gather.merged(part, np.int64, np.add, np.zeros(UNITS * UNITS, np.int64)).reshape(UNITS, UNITS)


def _x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, n_classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """The class of each unit: every unit in turn goes where the class bigram likelihood is highest, until none moves."""
    pairs = pairs.astype(np.float64)
    n = pairs.shape[0]
    order = np.argsort(-pairs.sum(axis=0), kind="stable")
    labels = np.empty(n, np.int64)
    labels[order] = np.arange(n) % n_classes
    one_hot = np.eye(n_classes)[labels]
    after, before = pairs @ one_hot, pairs.T @ one_hot
    table = one_hot.T @ after
    for _ in range(passes):
        moved = 0
        for unit in order:
            old, own = labels[unit], pairs[unit, unit]
            out, into = after[unit].copy(), before[unit].copy()
            if not out.sum() + into.sum():
                continue
            out[old] -= own
            into[old] -= own
            rest = table.copy()
            rest[old] -= out
            rest[:, old] -= into
            rest[old, old] -= own
            # What the likelihood gains if the unit joins each class: its row, its column, the corner, the margins.
            logs = _x_log_x(rest)
            rows, columns = rest.sum(axis=1), rest.sum(axis=0)
            gain = (_x_log_x(rest + out) - logs).sum(axis=1) + (_x_log_x(rest + into[:, None]) - logs).sum(axis=0)
            corner = np.diagonal(rest)
            gain += (
                _x_log_x(corner + out + into + own) - _x_log_x(corner + out) - _x_log_x(corner + into) + _x_log_x(corner)
            )
            gain -= _x_log_x(rows + out.sum() + own) - _x_log_x(rows)
            gain -= _x_log_x(columns + into.sum() + own) - _x_log_x(columns)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            table = rest
            table[new] += out
            table[:, new] += into
            table[new, new] += own
            if new != old:
                moved += 1
                labels[unit] = new
                after[:, old] -= pairs[:, unit]
                after[:, new] += pairs[:, unit]
                before[:, old] -= pairs[unit]
                before[:, new] += pairs[unit]
        if not moved:
            break
    return labels


@dataclass(frozen=True)
class Assignment:
    """The class of every word: its own for ``words`` (sorted hashes), that of its ending for the others.

    Words of their own class beyond ``HELD`` are in a table (h, class) instead."""

    words: np.ndarray
    of_word: np.ndarray
    of_ending: np.ndarray
    of_end: int

    @cached_property
    def starts(self) -> tuple[np.uint64, np.ndarray]:
        return _starts(self.words)

    def __call__(self, hashes: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(classes of the tokens, which of them have a class of their own, those tokens' places in ``words``)."""
        out = self.of_ending[buckets].astype(np.int64)
        if self.words.size:
            place = _places(self.words, self.starts, hashes)
            own = self.words[place] == hashes
            out = np.where(own, self.of_word[place], out)
        else:
            place, own = np.zeros(0, np.int64), np.zeros(hashes.size, bool)
        return np.where(hashes == END, self.of_end, out), own, place[own] if own.any() else np.zeros(0, np.int64)


def open_pairs(texts: DataFrame, assignment, classes: DataFrame) -> DataFrame:
    """(open, bucket, beside, place, side, n): the pairs of tokens with a word of ``classes`` (h, class), which is ``open``.

    The other token is ``beside``, after it (side 0) or before it (side 1). If that has a class in ``classes``, its hash is
    given, and as its place its bucket; else no hash, and as its place that in the assignment's words, -1 for the end, or
    -2 - bucket.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Assignment = assignment.value
        for source in batches:
            for part in slices(source, "text"):
                h, bucket, _ = _tokens(texts_of(part.column(0)))
                h, bucket = np.insert(h, 0, END), np.insert(bucket, 0, 0)
                _, chosen, held = own(h, bucket)
                out = ~chosen & (h != END)
                place = np.where(out, bucket, -1)
                place[chosen] = held
                first = np.flatnonzero(out[:-1])
                second = np.flatnonzero(out[1:] & ~out[:-1]) + 1
                mine, other = np.concatenate((first, second)), np.concatenate((first + 1, second - 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[mine].view(np.int64)),
                        pa.array(bucket[mine]),
                        pa.array(h[other].view(np.int64), mask=~out[other]),
                        pa.array(place[other].astype(np.int32)),
                        pa.array(np.repeat(np.array([0, 1], np.int32), [first.size, second.size])),
                    ],
                    ["open", "bucket", "beside", "place", "side"],
                )

    rows = texts.select("text").mapInArrow(task, "open long, bucket int, beside long, place int, side int")
    counted = rows.groupBy("open", "bucket", "beside", "place", "side").agg(F.count(F.lit(1)).alias("n"))
    found = with_classes(counted, classes)
    alone = F.when(F.col("beside").isNull(), F.col("place")).otherwise(-2 - F.col("place"))
    by_open = found.where(F.col("first").isNotNull()).select(
        "open",
        "bucket",
        F.when(F.col("second").isNotNull(), F.col("beside")).alias("beside"),
        F.when(F.col("second").isNotNull(), F.col("place")).otherwise(alone).alias("place"),
        "side",
        "n",
    )
    by_other = found.where(F.col("first").isNull() & F.col("second").isNotNull()).select(
        F.col("beside").alias("open"),
        F.col("place").alias("bucket"),
        F.lit(None).cast("long").alias("beside"),
        (-2 - F.col("bucket")).alias("place"),
        (1 - F.col("side")).alias("side"),
        "n",
    )
    return by_open.unionByName(by_other)


def with_classes(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` with the classes ``first`` of ``open`` and ``second`` of ``beside``; null for words not in ``classes``."""
    mine = classes.select(F.col("h").alias("open"), F.col("class").alias("first"))
    other = classes.select(F.col("h").alias("beside"), F.col("class").alias("second"))
    found = pairs.join(mine, "open", "left")
    # Pairs with one open word take no part in the second join, where they would all share the missing key.
    single = found.where(F.col("beside").isNull()).withColumn("second", F.lit(None).cast("int"))
    return single.unionByName(found.where(F.col("beside").isNotNull()).join(other, "beside", "left"))


def changes(pairs: DataFrame, classes: DataFrame, assignment, words: bool = True) -> DataFrame:
    """(h, code, n): what to add to the counts of ``neighbours`` as the words of ``classes`` do not have the class of their
    ending; and with ``words`` how often each of these words, ``h``, meets each class, after it and before it."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Assignment = assignment.value
        table = np.zeros(CLASSES * CLASSES, np.int64)

        def sent(h: np.ndarray | None, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            words = pa.nulls(codes.size, pa.int64()) if h is None else pa.array(h)
            return pa.RecordBatch.from_arrays([words, pa.array(codes), pa.array(n)], ["h", "code", "n"])

        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            h, bucket, place, side, n, first = (
                column[name].to_numpy(zero_copy_only=False) for name in ("open", "bucket", "place", "side", "n", "first")
            )
            both = column["beside"].is_valid().to_numpy(zero_copy_only=False)
            beside = column["beside"].fill_null(0).to_numpy()
            second = column["second"].fill_null(0).to_numpy().astype(np.int64)
            first, was = first.astype(np.int64), own.of_ending[bucket].astype(np.int64)
            # What the other token counts as: the class it has, and the one that ``neighbours`` took it for.
            ending = np.where(both, place, np.where(place < -1, -2 - place, 0))
            taken = np.where(both | (place < -1), own.of_ending[ending].astype(np.int64), own.of_end)
            held = ~both & (place >= 0)
            taken[held] = own.of_word[place[held]]
            other = np.where(both, second, taken)
            for a, b, sign in ((first, other, 1), (was, taken, -1)):
                cell = np.where(side == 0, a * CLASSES + b, b * CLASSES + a)
                np.add.at(table, cell, sign * n)
            if words:
                code = place[held].astype(np.int64) * 2 * CLASSES + (1 - side[held]) * CLASSES
                yield sent(None, np.concatenate((code + first[held], code + was[held])), np.concatenate((n[held], -n[held])))
                yield sent(h, side * CLASSES + other, n)
                yield sent(beside[both], CLASSES + first[both], n[both])
        some = np.flatnonzero(table)
        yield sent(None, -1 - some, table[some])

    found = with_classes(pairs, classes).select("open", "bucket", "beside", "place", "side", "n", "first", "second")
    return found.mapInArrow(task, "h long, code long, n long")


def neighbours(
    texts: DataFrame,
    assignment,
    words: bool = True,
    pairs: DataFrame | None = None,
    classes: DataFrame | None = None,
) -> DataFrame:
    """(h, code, n): how often classes follow each other, as codes below 0, and with ``words`` how often each word of its own
    class meets each class, after it (side 0) and before it (side 1); summed in each task before anything is moved. ``h`` is
    given for the words of ``classes`` (h, class), whose pairs are ``pairs``."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Assignment = assignment.value
        table = np.zeros(CLASSES * CLASSES, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            codes, n = (np.concatenate(part) for part in zip(*held, strict=True))
            order, at = _runs(codes)
            return codes[order[at]], np.add.reduceat(n[order], at)

        def sent(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["code", "n"])

        for source in batches:
            for part in slices(source, "text"):
                h, bucket, _ = _tokens(texts_of(part.column(0)))
                label, chosen, place = own(h, bucket)
                before = np.concatenate(([own.of_end], label[:-1]))
                table += np.bincount(before * CLASSES + label, minlength=table.size)
                if words and place.size:
                    after = np.concatenate((label[1:], [own.of_end]))  # an end follows every word
                    codes = np.concatenate((place * 2 * CLASSES + after[chosen], (place * 2 + 1) * CLASSES + before[chosen]))
                    held.append(np.unique(codes, return_counts=True))
                    if sum(x[0].size for x in held) > 2 * MOST_HELD:
                        held[:] = [summed()]
                        if held[0][0].size > MOST_HELD:
                            yield sent(*held.pop())
        if held:
            yield sent(*summed())
        some = np.flatnonzero(table)
        yield sent(-1 - some, table[some])

    counted = texts.select("text").mapInArrow(task, "code long, n long").withColumn("h", F.lit(None).cast("long"))
    if classes is not None:
        counted = counted.unionByName(changes(pairs, classes, assignment, words))
    return counted.groupBy("h", "code").agg(F.sum("n").alias("n"))


def class_pairs(counted: DataFrame) -> np.ndarray:
    """The table [previous class, next class] of ``neighbours``."""
    rows = counted.where(F.col("h").isNull() & (F.col("code") < 0)).select("code", "n").toArrow()
    table = np.zeros(CLASSES * CLASSES)
    table[-1 - rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    return table.reshape(CLASSES, CLASSES)


def likelihood(table: np.ndarray) -> float:
    """What the class pairs add to the log-likelihood of the text."""
    return float(_x_log_x(table).sum() - _x_log_x(table.sum(axis=0)).sum() - _x_log_x(table.sum(axis=1)).sum())


def best_classes(table: np.ndarray, old: np.ndarray, after: np.ndarray, before: np.ndarray) -> np.ndarray:
    """For words of classes ``old``, with counts [word, class] of what follows and precedes them: the class that gains most."""
    w = np.arange(len(old))
    rest = np.repeat(table[None], len(old), axis=0)
    rest[w, old] -= after
    rest[w, :, old] -= before
    rest = np.maximum(rest, 0)
    logs = _x_log_x(rest)
    rows, columns = rest.sum(axis=2), rest.sum(axis=1)
    gain = (_x_log_x(rest + after[:, None, :]) - logs).sum(axis=2) + (_x_log_x(rest + before[:, :, None]) - logs).sum(axis=1)
    corner = np.diagonal(rest, axis1=1, axis2=2)
    gain += _x_log_x(corner + after + before) - _x_log_x(corner + after) - _x_log_x(corner + before) + _x_log_x(corner)
    gain -= _x_log_x(rows + after.sum(axis=1, keepdims=True)) - _x_log_x(rows)
    gain -= _x_log_x(columns + before.sum(axis=1, keepdims=True)) - _x_log_x(columns)
    new = gain.argmax(axis=1)
    return np.where(gain[w, new] > gain[w, old] + 1e-9, new, old)


def _best(met: DataFrame, table: np.ndarray, shared=None) -> DataFrame:
    """(word, class) for ``met`` (word, met, old): the class that gains most; ``shared`` holds the old ones if not given."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                word = part.column(0).to_numpy()
                sizes = pa.compute.list_value_length(part.column(1)).to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(word)), sizes)
                slots = part.column(1).flatten()
                sides = np.zeros((len(word), 2 * CLASSES))
                sides[owner, slots.field(0).to_numpy()] = slots.field(1).to_numpy()
                old = shared.value.of_word[word] if shared else part.column(2).to_numpy()
                new = best_classes(table, old.astype(np.int64), sides[:, :CLASSES], sides[:, CLASSES:])
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(new)], ["word", "class"])

    return met.mapInArrow(task, "word long, class long")


def moved(
    counted: DataFrame, table: np.ndarray, assignment: Assignment, shared, classes: DataFrame | None = None
) -> tuple[Assignment, DataFrame | None]:
    """Every word of its own class goes where it gains most, given the classes of all others."""
    code = F.col("code")
    # A word has 2 * CLASSES slots at most.
    met = F.collect_list("met").alias("met")
    slots = counted.where(F.col("h").isNull() & (code >= 0)).select(
        F.expr(f"code div {2 * CLASSES}").alias("word"), F.struct((code % (2 * CLASSES)).alias("slot"), "n").alias("met")
    )
    found = _best(slots.groupBy("word").agg(met), table, shared).toArrow()
    of_word = assignment.of_word.copy()
    of_word[found.column("word").to_numpy()] = found.column("class").to_numpy()
    if classes is not None:
        slots = counted.where(F.col("h").isNotNull()).select("h", F.struct(code.alias("slot"), "n").alias("met"))
        far = slots.groupBy("h").agg(met).join(classes, "h").select("h", "met", F.col("class").alias("old"))
        classes = _best(far, table).select(F.col("word").alias("h"), F.col("class").cast("int").alias("class"))
    return Assignment(assignment.words, of_word, assignment.of_ending, assignment.of_end), classes


def improved(
    texts: DataFrame, start: Assignment, rounds: int, classes: DataFrame | None = None
) -> tuple[Assignment, np.ndarray, DataFrame | None]:
    """The best assignment of ``rounds`` rounds, its class pairs, and the classes (h, class) of the words beyond ``HELD``."""
    store = Tables(texts.sparkSession, "class-moves")
    context = texts.sparkSession.sparkContext
    found: list[tuple[float, Assignment, np.ndarray, DataFrame | None]] = []
    assignment, pairs = start, None
    if classes is not None:
        classes = store(classes)
        pairs = store(open_pairs(texts, context.broadcast(start), classes))
    for k in range(rounds + 1):
        shared = context.broadcast(assignment)
        last = k == rounds or not assignment.words.size and classes is None
        counted = store(neighbours(texts, shared, not last, pairs, classes))
        table = class_pairs(counted)
        found.append((likelihood(table), assignment, table, classes))
        if last:
            break
        assignment, classes = moved(counted, table, assignment, shared, classes)
        if classes is not None:
            classes = store(classes)
    return max(found, key=lambda f: f[0])[1:]


@dataclass(frozen=True)
class Model:
    """What a task needs to score texts: its size is bounded whatever the corpus. ``beyond``: some words have their class
    in the table of counts."""

    assignment: Assignment
    log_pair: np.ndarray
    core: np.ndarray
    core_logs: np.ndarray
    log_all: float
    n_tokens: int
    beyond: bool = False

    @cached_property
    def core_starts(self) -> tuple[np.uint64, np.ndarray]:
        return _starts(self.core)


def fit(texts: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model of ``texts`` (text), and the counts (h, bucket, c, class) of all its words; ``class`` is set for the words
    of their own class beyond ``HELD``."""
    spark = texts.sparkSession
    counts = durable(word_counts(texts))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # The counts from which at most CORE and HELD words are left; how many words share a count is a short table.
    shares = counts.groupBy("c").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("c")).limit(max(CORE, HELD)).toArrow()
    totals = np.cumsum(shares.column("words").to_numpy())

    def count_of(most: int) -> int:
        fit_in = int(np.searchsorted(totals, most, "right"))
        return int(shares.column("c")[fit_in - 1].as_py()) if fit_in else 1 << 62

    least = count_of(CORE)
    top = counts.where(F.col("c") >= least).toArrow()
    h, c = top.column("h").to_numpy().view(np.uint64), top.column("c").to_numpy()
    sorted_core = np.argsort(h)
    words = counts.where(F.col("h") != F.lit(int(END)))
    first_words = words.orderBy(F.desc("c"), F.col("h") < 0, "h").limit(WORDS).select("h", "bucket").toArrow()
    frequent = np.sort(first_words.column("h").to_numpy().view(np.uint64))

    shared = spark.sparkContext.broadcast(frequent)
    start = exchange(unit_pairs(texts, shared))
    often = max(LEAST_COUNT, count_of(HELD))
    chosen = pa.concat_tables([words.where(F.col("c") >= often).select("h", "bucket").toArrow(), first_words])
    own, first = np.unique(chosen.column("h").to_numpy().view(np.uint64), return_index=True)
    buckets = chosen.column("bucket").to_numpy()[first]
    of_word = start[_units(own, buckets, frequent)].astype(np.uint8)
    of_ending = start[1 + WORDS :].astype(np.uint8)
    no_unit = ~F.col("h").isin(frequent.view(np.int64).tolist())
    further = words.where((F.col("c") >= LEAST_COUNT) & (F.col("c") < often) & no_unit)
    beyond = often > LEAST_COUNT and not further.isEmpty()
    class_of = F.get(F.lit(of_ending.tolist()), F.col("bucket")).cast("int").alias("class")
    classes = further.select("h", class_of) if beyond else None
    assignment, table, classes = improved(texts, Assignment(own, of_word, of_ending, int(start[0])), rounds, classes)

    # Words of each class: those of their own class, and of each ending all that are left.
    of_bucket = counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("words")).toArrow()
    left = np.zeros(ENDINGS, np.int64)
    left[of_bucket.column("bucket").to_numpy()] = of_bucket.column("words").to_numpy()
    np.add.at(left, buckets, -1)
    left[0] -= min(1, n)  # the end
    types = np.bincount(assignment.of_word, minlength=CLASSES).astype(np.int64)
    if beyond:
        counts = counts.join(classes, "h", "left")
        for row in counts.where("class is not null").groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("words")).collect():
            left[row["bucket"]] -= row["words"]
            types[row["class"]] += row["words"]
    else:
        counts = counts.withColumn("class", F.lit(None).cast("int"))
    types = types + np.bincount(assignment.of_ending, weights=left, minlength=CLASSES)
    types[assignment.of_end] += min(1, n)
    tokens = table.sum(axis=0)
    prior = (tokens + 1) / (tokens.sum() + CLASSES)
    change = (table + PULL * prior) / (table.sum(axis=1, keepdims=True) + PULL)
    everything = n + 0.5 * (v + 1)
    pair = SHARE * change / (tokens + 0.5 * (types + 1)) + (1 - SHARE) / everything
    core_logs = np.log10(c[sorted_core] + 0.5)
    model = Model(assignment, np.log10(pair), h[sorted_core], core_logs, float(np.log10(everything)), int(n), beyond)
    return model, counts


def _scored(docs: DataFrame, model) -> DataFrame:
    """(key, id, n_tokens, n_core, core_sum, pair_sum, rare, times, open, beside, cell): ``rare`` holds the words outside the
    core. ``pair_sum`` leaves out the pairs with words whose class is to be looked up in a table, ``open`` and, where both are,
    ``beside``; ``cell`` holds the classes they have if they are not in it, and CLASSES ** 2 more if ``beside`` comes first."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = model.value
        for source in batches:
            for part in slices(source, "text"):
                h, bucket, counts = _tokens(texts_of(part.column(2)))
                ends = np.cumsum(counts)
                starts = ends - counts
                label, chosen, _ = own.assignment(h, bucket)
                previous = np.concatenate(([own.assignment.of_end], label[:-1]))
                out = ~chosen & (h != END) & own.beyond
                out_before = np.concatenate(([False], out[:-1]))
                pair_sum = np.add.reduceat(np.where(out | out_before, 0.0, own.log_pair[previous, label]), starts)
                # Each pair belongs to the text of its second token: a text ends with the end, which has a class.
                opened = np.flatnonzero(out | out_before)
                reverse = ~out_before[opened]
                before = np.maximum(opened - 1, 0)
                open_ = pa.array(h[np.where(reverse, opened, before)].view(np.int64))
                beside = pa.array(h[opened].view(np.int64), mask=~(out & out_before)[opened])
                cell = np.where(
                    reverse, (CLASSES + label[opened]) * CLASSES + previous[opened], previous[opened] * CLASSES + label[opened]
                ).astype(np.int32)
                edges = np.concatenate(([0], np.searchsorted(opened, ends))).astype(np.int32)
                if own.core.size:
                    place = _places(own.core, own.core_starts, h)
                    known = own.core[place] == h
                    logs = np.where(known, own.core_logs[place], 0.0)
                else:
                    known, logs = np.zeros(h.size, bool), np.zeros(h.size)
                owner = np.repeat(np.arange(counts.size), counts)[~known]
                order = np.lexsort((h[~known], owner))
                owner, others = owner[order], h[~known][order]
                fresh = np.ones(owner.size, bool)
                fresh[1:] = (owner[1:] != owner[:-1]) | (others[1:] != others[:-1])
                at = np.flatnonzero(fresh)
                times = np.diff(np.concatenate((at, [owner.size]))).astype(np.int32)
                cuts = np.concatenate(([0], np.cumsum(np.bincount(owner[at], minlength=counts.size)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:2],
                        pa.array(counts),
                        pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                        pa.array(np.add.reduceat(logs, starts)),
                        pa.array(pair_sum),
                        pa.ListArray.from_arrays(cuts, pa.array(others[at].view(np.int64))),
                        pa.ListArray.from_arrays(cuts, pa.array(times)),
                        *(pa.ListArray.from_arrays(edges, x) for x in (open_, beside, pa.array(cell))),
                    ],
                    ["key", "id", "n_tokens", "n_core", "core_sum", "pair_sum", "rare", "times", "open", "beside", "cell"],
                )

    sums = "n_tokens long, n_core long, core_sum double, pair_sum double, rare array<long>, times array<int>, "
    sums += "open array<long>, beside array<long>, cell array<int>"
    schema = widened(docs.select("key", "id").schema, sums)
    return docs.select("key", "id", "text").mapInArrow(task, schema)


def _open_sums(scored: DataFrame, counts: DataFrame, log_pair: np.ndarray) -> DataFrame:
    """(key, open_sum): the pairs that ``pair_sum`` leaves out."""
    pairs = scored.select("key", F.explode(F.arrays_zip("open", "beside", "cell")).alias("x")).select("key", "x.*")
    found = with_classes(pairs, counts.where(F.col("class").isNotNull()).select("h", "class"))
    cell = F.col("cell") % (CLASSES * CLASSES)
    first = F.coalesce("first", F.floor(cell / CLASSES).cast("int"))
    second = F.coalesce("second", cell % CLASSES)
    place = F.when(F.col("cell") < CLASSES * CLASSES, first * CLASSES + second).otherwise(second * CLASSES + first)
    logs = scored.sparkSession.createDataFrame(list(enumerate(log_pair.ravel().tolist())), "place int, log double")
    found = found.select("key", place.alias("place")).join(F.broadcast(logs), "place")
    return found.groupBy("key").agg(F.sum("log").alias("open_sum"))


def score(
    docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """One row per document: ``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10
    probability of the text) and ``perplexity``. ``training`` is the condition that training documents meet."""
    spark = docs.sparkSession
    path = passing_path(spark, "class-ngrams")
    text = F.col(text_col).cast("string").alias("text")
    model, counts = fit(docs.where(training).select(text), rounds)
    # A row's key is written along with its sums, so that it stays the same when a task is run again.
    keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"), text)
    _scored(keyed, spark.sparkContext.broadcast(model)).write.parquet(f"{path}/scored")
    scored = spark.read.parquet(f"{path}/scored")
    rare = scored.select("key", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("key", "x.rare", "x.times")
    rare = rare.join(counts.select(F.col("h").alias("rare"), "c"), "rare", "left")
    sums = rare.groupBy("key").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_sum"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_rare"),
    )
    found = scored.drop("rare", "times", "open", "beside", "cell").join(sums, "key", "left")
    if model.beyond:
        found = found.join(_open_sums(scored, counts, model.log_pair), "key", "left")
    else:
        found = found.withColumn("open_sum", F.lit(0.0))
    words = F.col("core_sum") + F.coalesce("rare_sum", F.lit(0.0))
    score_ = words + F.col("pair_sum") + F.coalesce("open_sum", F.lit(0.0))
    return found.select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("n_core") + F.coalesce("n_rare", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (words - F.col("n_tokens") * F.lit(model.log_all)).alias("base_score"),
        score_.alias("score"),
        F.pow(F.lit(10.0), -score_ / F.col("n_tokens")).alias("perplexity"),
    )
