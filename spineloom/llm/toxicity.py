"""Toxic passages by maximum-scoring segments.

Words (runs of digits, letters and non-ASCII characters, A-Z lower-cased) get the log-odds of toxic against clean training
documents under an informative Dirichlet prior (the words' overall counts, scaled to the share ``PRIOR`` of all). They are
counted in two ways, and the more significant one holds: by the different texts that hold the word, and by the different
words before it. The first learns the words of a fixed phrase, the second those that a few long texts use in many ways; copies of
a text count once in both. Words whose log-odds are
significant score their log-odds less ``DRIFT``, all others ``-DRIFT``. The linear-time scan of Ruzzo and Tompa then finds
all maximal segments of a text. Segment scores of clean texts follow an extreme-value law with the rate ``lam`` that
solves E[exp(lam * score)] = 1 over clean words and a factor fitted to the clean training documents, so a segment of
score S in a text of n words is expected K n exp(-lam S) times by chance. Segments expected less than ``SIGNIFICANT`` times
are toxic passages; what they exceed chance by is summed and turned into a probability by a logistic curve.

Training uses at most about ``MOST_LABELLED`` labelled rows, chosen by a hash of the id; the model holds at most
``MOST_WORDS`` words, those with the highest significance. Both are parameters and bound what is sent to the tasks.

Defined results: null, empty and wordless texts have no passage and score the base rate; repeated rows are scored alike;
labels that are null are left out, and an id that is labelled twice is toxic if one label says so; without toxic or
clean training rows nothing is significant; an empty table gives an empty result; columns of the input are kept but for
those the result adds.
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
from spineloom.llm.tables import through_arrow, widened
from spineloom.llm.words import NOT_ALPHANUMERIC, slices, texts_of, word_hashes

MOST_LABELLED = 20_000
MOST_WORDS = 50_000
PRIOR = 0.1
LEAST_Z = 4.0
DRIFT = 0.5
SIGNIFICANT = 0.05


@dataclass(frozen=True)
class Model:
    words: np.ndarray
    scores: np.ndarray
    lam: float
    log_k: float
    slope: float = 0.0
    offset: float = 0.0


def maximal_segments(places: np.ndarray, scores: np.ndarray, drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of a text whose words score ``scores`` at ``places``
    and ``-drift`` anywhere else. Linear in the number of places: words between them only lower the sum."""
    candidates: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum with
    total, previous = 0.0, -1
    for place, score in zip(places.tolist(), scores.tolist(), strict=True):
        total -= drift * (place - previous - 1)
        before, total, previous = total, total + score, place
        first = place
        current = (first, place, before, total)
        while True:
            k = len(candidates) - 1
            while k >= 0 and candidates[k][2] >= current[2]:
                k -= 1
            if k < 0 or candidates[k][3] >= current[3]:
                candidates.append(current)
                break
            current = (candidates[k][0], place, candidates[k][2], total)
            del candidates[k:]
    return [(first, last, after - before) for first, last, before, after in candidates]


def _evidence(model: Model, n: int, segments: list[tuple[int, int, float]]) -> tuple[list[tuple[int, int, float, float]], float]:
    """Toxic passages (first, last, score, expected number) and the sum of what they exceed chance by."""
    found, total = [], 0.0
    for first, last, score in segments:
        excess = model.lam * score - model.log_k - np.log(n)
        if excess > -np.log(SIGNIFICANT):
            found.append((first, last, score, float(np.exp(-excess))))
            total += excess
    return found, total


def _segmented(texts: list[bytes | None], model: Model) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """Number of words and maximal segments of each text."""
    hashes, counts = word_hashes(texts, NOT_ALPHANUMERIC)
    ends = np.cumsum(counts)
    if model.words.size and hashes.size:
        place = np.minimum(np.searchsorted(model.words, hashes), model.words.size - 1)
        hit = np.flatnonzero(model.words[place] == hashes)
        value = model.scores[place[hit]]
    else:
        hit, value = np.empty(0, np.int64), np.empty(0)
    cuts = np.searchsorted(hit, np.concatenate((ends - counts, ends[-1:])))
    for k, n in enumerate(counts.tolist()):
        own = slice(cuts[k], cuts[k + 1])
        yield n, maximal_segments(hit[own] - (ends[k] - n), value[own])


def _training(docs: DataFrame, labels: DataFrame, training, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, toxic) of the different texts among at most about MOST_LABELLED labelled training documents: the ids whose hash
    is lowest. Of copies with different labels the toxic one counts."""
    own = labels.where(ref(label_col).isNotNull() & ref(id_col).isNotNull()).where(training)
    own = own.groupBy(ref(id_col).alias("__id")).agg(F.max(ref(label_col).cast("int")).alias("__toxic"))
    share = min(1.0, MOST_LABELLED / max(1, own.count()))
    own = own.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    text = docs.select(ref(id_col).alias("__id"), F.coalesce(ref(text_col).cast("string"), F.lit("")).alias("text"))
    # At most about MOST_LABELLED ids of labels: small, whatever the corpus is. Rows that share an id may still be many,
    # so copies are merged by two hashes before anything is kept.
    found = text.join(F.broadcast(own), "__id")
    names = {"__a": F.xxhash64("text"), "__b": F.xxhash64(F.lit(1), "text")}
    once = found.withColumns(names).groupBy("__a", "__b").agg(F.first("text").alias("text"), F.max("__toxic").alias("toxic"))
    return durable(once.select("text", "toxic"))


def _text_counts(rows: DataFrame) -> DataFrame:
    """(h, toxic, clean): how many toxic and how many clean texts hold the word h."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, counts = word_hashes(texts_of(part.column(0)), NOT_ALPHANUMERIC)
                owner = np.repeat(np.arange(counts.size), counts)
                order = np.lexsort((hashes, owner))
                hashes, owner = hashes[order], owner[order]
                fresh = np.ones(hashes.size, bool)
                fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                toxic = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)[owner[fresh]]
                own, place = np.unique(hashes[fresh], return_inverse=True)
                held = np.bincount(place, weights=toxic, minlength=own.size).astype(np.int64)
                every = np.bincount(place, minlength=own.size)
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(held), pa.array(every - held)], ["h", "toxic", "clean"])

    found = rows.mapInArrow(task, "h long, toxic long, clean long")
    return found.groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _context_counts(rows: DataFrame) -> DataFrame:
    """(h, toxic, clean): before how many different words h stands in toxic and in clean rows."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, counts = word_hashes(texts_of(part.column(0)), NOT_ALPHANUMERIC)
                toxic = np.repeat(part.column(1).to_numpy(zero_copy_only=False), counts).astype(np.int64)
                before = np.concatenate((np.zeros(1, np.uint64), hashes[:-1]))[: hashes.size]
                before[(np.cumsum(counts) - counts)[counts > 0]] = 0
                order = np.lexsort((toxic, before, hashes))
                hashes, before, toxic = hashes[order], before[order], toxic[order]
                fresh = np.ones(hashes.size, bool)
                fresh[1:] = (np.diff(hashes) != 0) | (np.diff(before) != 0) | (np.diff(toxic) != 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[fresh].view(np.int64)), pa.array(before[fresh].view(np.int64)), pa.array(toxic[fresh])],
                    ["h", "before", "toxic"],
                )

    found = rows.mapInArrow(task, "h long, before long, toxic long")
    pairs = found.groupBy("h", "before").agg(F.max("toxic").alias("toxic"), F.max(1 - F.col("toxic")).alias("clean"))
    return pairs.groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _evident(counts: DataFrame) -> DataFrame:
    """(h, odds, z, p) of the words whose log-odds are significant by these counts: z under the prior, p among clean ones."""
    counts = durable(counts)
    toxic, clean = counts.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()
    if not toxic or not clean:
        nothing = [F.lit(0.0).alias(name) for name in ("odds", "z", "p")]
        return counts.where(F.lit(False)).select("h", *nothing)
    prior, all_prior = (F.col("toxic") + F.col("clean")) * PRIOR, (toxic + clean) * PRIOR
    y_i, y_j = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(y_i / (toxic + all_prior - y_i)) - F.log(y_j / (clean + all_prior - y_j))
    z = odds / F.sqrt(1 / y_i + 1 / y_j)
    scored = counts.select("h", odds.alias("odds"), z.alias("z"), (y_j / (clean + all_prior)).alias("p"))
    return scored.where((F.col("z") >= LEAST_Z) & (F.col("odds") > DRIFT))


def fit(docs: DataFrame, labels: DataFrame, training, id_col: str, text_col: str, label_col: str) -> Model:
    spark = docs.sparkSession
    rows = _training(docs, labels, training, id_col, text_col, label_col)
    empty = Model(np.empty(0, np.uint64), np.empty(0), 1.0, 0.0)
    scored = _evident(_text_counts(rows)).union(_evident(_context_counts(rows)))
    best = scored.groupBy("h").agg(F.max_by(F.struct("odds", "z", "p"), "z").alias("best")).select("h", "best.*")
    top = best.orderBy(F.desc("z"), "h").limit(MOST_WORDS).toArrow()
    words, odds, p = top.column("h").to_numpy().view(np.uint64), top.column("odds").to_numpy(), top.column("p").to_numpy()
    order = np.argsort(words)
    words, score, p = words[order], odds[order] - DRIFT, p[order]
    if words.size:
        empty = Model(words, score, _rate(score, p), 0.0)
    model = spark.sparkContext.broadcast(empty)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            for part in slices(batch, "text"):
                n, best, every = [], [], []
                for size, segments in _segmented(texts_of(part.column(0)), own):
                    n.append(size)
                    best.append(max((s for _, _, s in segments), default=0.0))
                    every.append([s for _, _, s in segments])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n, pa.int64()), pa.array(best, pa.float64()), pa.array(every, pa.list_(pa.float64())), part.column(1)],
                    ["n", "best", "every", "toxic"],
                )

    found = rows.mapInArrow(task, "n long, best double, every array<double>, toxic int").toArrow().to_pylist()
    calm = [r for r in found if not r["toxic"] and r["n"]]
    weight = sum(r["n"] * np.exp(-empty.lam * r["best"]) for r in calm)
    log_k = float(np.log(len(calm) / weight)) if calm else 0.0
    fitted = Model(empty.words, empty.scores, empty.lam, log_k)
    x = np.array([_evidence(fitted, r["n"], [(0, 0, s) for s in r["every"]])[1] if r["n"] else 0.0 for r in found])
    y = np.array([float(bool(r["toxic"])) for r in found])
    slope, offset = _logistic(np.log1p(x), y)
    return Model(empty.words, empty.scores, empty.lam, log_k, slope, offset)


def _rate(scores: np.ndarray, p: np.ndarray) -> float:
    """The positive solution of E[exp(lam * score)] = 1 where words score with probability p, and -DRIFT otherwise."""
    rest = max(1e-9, 1 - p.sum())
    excess = lambda lam: float((p * np.exp(lam * scores)).sum() + rest * np.exp(-lam * DRIFT) - 1)
    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a lightly penalized logistic curve, by Newton's steps."""
    w = np.zeros(2)
    if not x.size:
        return 0.0, float(np.log(0.1 / 0.9))
    design = np.stack((x, np.ones(x.size)), axis=1)
    penalty = np.diag([0.01, 0.01])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve(design.T * (p * (1 - p)) @ design + penalty, design.T @ (y - p) - penalty @ w)
        w += np.clip(step, -2, 2)
    return float(w[0]), float(w[1])


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    training,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """``docs`` with ``score`` (probability of being toxic) and ``passages``: (first and last word, score, expected number
    by chance) of each toxic passage. ``training`` is the condition on ``id_col`` that training rows meet."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, training, id_col, text_col, label_col))
    kept = [c for c in docs.columns if c not in ("score", "passages")]
    source = docs.select(*map(ref, kept), ref(text_col).cast("string").alias("__text"))
    passage = "first int, last int, score double, expected double".split(", ")
    types = {"int": pa.int32(), "double": pa.float64()}
    arrow = pa.struct([(p.split()[0], types[p.split()[1]]) for p in passage])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            for part in slices(batch, "__text"):
                scores, passages = [], []
                for n, segments in _segmented(texts_of(part.column(part.num_columns - 1)), own):
                    found, excess = _evidence(own, n, segments) if n else ([], 0.0)
                    scores.append(1 / (1 + np.exp(-(own.slope * np.log1p(excess) + own.offset))))
                    passages.append([dict(zip(("first", "last", "score", "expected"), p, strict=True)) for p in found])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(scores, pa.float64()), pa.array(passages, pa.list_(arrow))],
                    [*kept, "score", "passages"],
                )

    fields = ",".join(p.replace(" ", ":") for p in passage)
    schema = widened(source.drop("__text").schema, f"score double, passages array<struct<{fields}>>")
    return through_arrow(source, task, schema)
