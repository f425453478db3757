"""Language identification with spans of mixed-language text.

A text's words are runs of letters (ASCII letters and all bytes of other characters, lower-cased). Script ranges narrow each word's
candidates to the languages written in its scripts. Under each candidate a word scores the log probability of its byte
trigrams, its borders included; Viterbi's algorithm over the words, with a penalty for every switch, labels spans of one
language. The predicted language is the one with most bytes, and its share is the score.

Training reads texts of at most about ``MOST_EACH`` rows a language, a parameter, chosen by a hash of id and text, and knows
every language that occurs. The model has a fixed size a language. A very long text is labelled piece by piece.

Defined results: null texts and texts without a letter are ``und`` with score 0; a null language trains nothing; without any
training row every text is ``und``; ties go to the first language by name; repeated rows are judged alike; an empty table
gives an empty result; columns of the input are kept but for those the result adds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spineloom.functions.columns import ref
from spineloom.llm import gather
from spineloom.llm.tables import through_arrow, widened
from spineloom.llm.words import slices

MOST_EACH = 4000
#: Texts of more bytes are labelled piece by piece, in memory that does not follow their length in bytes.
LONG = 1 << 22
PIECE = 1 << 19
BUCKETS = 1 << 15
SWITCH = 12.0
#: What a word costs under a language that is not written in its script.
FOREIGN = 60.0
#: The share of a language's letters from which a script is one of its own.
OWN_SCRIPT = 0.02

# Ranges of code points by script.
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F),)),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF),)),
    ("kana", ((0x3040, 0x30FF),)),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF))),
    ("hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))),
)


def _script_table() -> np.ndarray:
    """The script's bit for the first two bytes of a character (lead * 256 + next); 0 for other bytes."""
    table = np.zeros(1 << 16, np.uint32)
    for k, (_, ranges) in enumerate(SCRIPTS):
        for low, high in ranges:
            for code in range(max(low, 0x80), high + 1):
                lead, following = chr(code).encode("utf-8", "surrogatepass")[:2]
                table[lead << 8 | following] |= 1 << k
    for code in [*range(0x41, 0x5B), *range(0x61, 0x7B)]:
        table[code << 8 : (code + 1) << 8] = 1
    return table


_SCRIPT = _script_table()
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_p: np.ndarray  # [language, bucket]
    scripts: np.ndarray  # of each language, as bits


def _words(texts: list[str | None]):
    """(trigram bucket of each letter, starts, ends, script bits of each word, first word of each text)."""
    return _words_of([(t or "").lower().encode("utf-8", "replace") for t in texts])


def _words_of(parts: list[bytes]):
    raw = np.frombuffer(b" ".join(parts) + b"  ", np.uint8)
    letter = _LETTER[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], letter))))
    starts, ends = edge[::2], edge[1::2]
    shown = np.where(letter, raw, 0x20).astype(np.uint32)
    before = np.concatenate(([0x20], shown[:-1])).astype(np.uint32)
    after = np.concatenate((shown[1:], [0x20])).astype(np.uint32)
    gram = (before << 16) | (shown << 8) | after
    bucket = ((gram * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int32)
    pair = raw.astype(np.int32) << 8 | np.concatenate((raw[1:], [0x20]))
    bits = np.bitwise_or.reduceat(np.where(letter, _SCRIPT[pair], 0), starts) if starts.size else np.empty(0, np.uint32)
    sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    first = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
    return bucket, letter, starts, ends, bits.astype(np.uint32), first


def _scores(model: Model, bucket, letter, starts, ends, bits) -> np.ndarray:
    """[word, language] log probabilities, other scripts' languages pushed down."""
    out = np.empty((starts.size, len(model.languages)))
    for k in range(len(model.languages)):
        each = np.where(letter, model.log_p[k][bucket], 0.0)
        total = np.concatenate(([0.0], np.cumsum(each)))
        out[:, k] = total[ends] - total[starts]
    fits = (bits[:, None] & model.scripts[None, :]) != 0
    narrowed = fits.any(axis=1)
    out -= FOREIGN * (narrowed[:, None] & ~fits)
    return out


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The best label of every word, each text (from first[k] to first[k + 1]) by itself; all texts advance together."""
    n, width = scores.shape
    labels = np.zeros(n, np.int64)
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begins, sizes = first[:-1][order], sizes[order]
    if not n:
        return labels
    stay = np.ones((n, width), bool)
    source = np.zeros(n, np.int64)
    value = scores[np.minimum(begins, n - 1)].copy()
    lengths = np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 2), "right")  # texts with that many words
    for t in range(1, int(sizes[0])):
        live = lengths[t]
        rows = begins[:live] + t
        value = value[:live]
        top = value.argmax(axis=1)
        best = value[np.arange(live), top] - penalty
        keep = value >= best[:, None]
        stay[rows], source[rows] = keep, top
        value = np.where(keep, value, best[:, None]) + scores[rows]
        ended = np.flatnonzero(sizes[:live] == t + 1)
        labels[rows[ended]] = value[ended].argmax(axis=1)
    ones = np.flatnonzero(sizes == 1)
    labels[begins[ones]] = scores[begins[ones]].argmax(axis=1)
    for t in range(int(sizes[0]) - 1, 0, -1):
        rows = begins[: lengths[t]] + t
        own = labels[rows]
        labels[rows - 1] = np.where(stay[rows, own], own, source[rows])
    return labels


def _pieces(text: str) -> Iterator[bytes]:
    """The lower-cased text in parts of about PIECE bytes that split no word."""
    data = text.lower().encode("utf-8", "replace")
    at = 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and _LETTER[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def label_long(text: str, model: Model, penalty: float = SWITCH) -> tuple[np.ndarray, np.ndarray]:
    """(label, bytes) of each word of one text, as ``viterbi`` gives them: the row of values is carried from piece to piece, and
    of earlier ones only the back pointers are kept, a few bytes a word."""
    value: np.ndarray | None = None
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    sizes: list[np.ndarray] = []
    for piece in _pieces(text):
        bucket, letter, starts, ends, bits, _ = _words_of([piece])
        if not starts.size:
            continue
        scores = _scores(model, bucket, letter, starts, ends, bits)
        stay, source = np.ones(scores.shape, bool), np.zeros(len(scores), np.int16)
        for t, row in enumerate(scores):
            if value is None:
                value = row
                continue
            top = int(value.argmax())
            best = value[top] - penalty
            keep = value >= best
            stay[t], source[t] = keep, top
            value = np.where(keep, value, best) + row
        kept.append((stay, source))
        sizes.append((ends - starts).astype(np.int32))
    if value is None:
        return np.zeros(0, np.int16), np.zeros(0, np.int32)
    label, out = int(value.argmax()), []
    for stay, source in reversed(kept):
        labels = np.zeros(len(source), np.int16)
        for t in range(len(source) - 1, -1, -1):
            labels[t] = label
            if not stay[t, label]:
                label = int(source[t])
        out.append(labels)
    return np.concatenate(out[::-1]), np.concatenate(sizes)


def fit(docs: DataFrame, training, id_col: str, text_col: str, lang_col: str) -> Model:
    spark = docs.sparkSession
    own = docs.where(F.col(lang_col).isNotNull()).where(training)
    sizes = own.groupBy(lang_col).count().collect()
    languages = sorted(str(row[0]) for row in sizes)
    counts = {str(row[0]): row[1] for row in sizes}
    if not languages:
        return Model([], np.empty((0, BUCKETS)), np.empty(0, np.uint32))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, int(min(1, MOST_EACH / counts[k]) * (1 << 30)))])
    lang = F.col(lang_col).cast("string")
    # By id and text, so that rows that share an id are not all taken or all left.
    chosen = F.pmod(F.xxhash64(ref(id_col), ref(text_col).cast("string")), F.lit(1 << 30)) < share[lang]
    rows = own.where(chosen).select(F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
    place = {k: i for i, k in enumerate(languages)}
    width = BUCKETS + len(SCRIPTS)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(place) * width, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                bucket, letter, starts, _, bits, first = _words(part.column(0).to_pylist())
                own = np.array([place[x] for x in part.column(1).to_pylist()])
                of_word = np.repeat(own, np.diff(first))
                sizes = np.concatenate((starts, [letter.size]))
                of_byte = np.repeat(of_word, np.diff(sizes)) if starts.size else np.empty(0, np.int64)
                inside = np.flatnonzero(letter)
                if not starts.size:
                    continue
                total += np.bincount(of_byte[inside - starts[0]] * width + bucket[inside], minlength=total.size)
                for k in range(len(SCRIPTS)):
                    with_it = of_word[(bits >> np.uint32(k)) & 1 == 1]
                    total += np.bincount(with_it * width + BUCKETS + k, minlength=total.size)
        yield gather.part_batch(total)

    part = rows.mapInArrow(task, gather.SCHEMA)
    found = gather.merged(part, np.int64, np.add, np.zeros(len(languages) * width, np.int64)).reshape(-1, width)
    grams, scripts = found[:, :BUCKETS].astype(float), found[:, BUCKETS:].astype(float)
    log_p = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    mine = scripts >= OWN_SCRIPT * np.maximum(1, scripts.sum(axis=1, keepdims=True))
    return Model(languages, log_p, (mine << np.arange(len(SCRIPTS))).sum(axis=1).astype(np.uint32))


def identify(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the predicted language's share of the letters' bytes) and ``spans``: runs of
    words in one language (lang, first and last-plus-one word). ``training`` is the condition that training rows meet."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, training, id_col, text_col, lang_col))
    added = ("lang_pred", "score", "spans")
    kept = [c for c in docs.columns if c not in added]
    text = F.col(text_col).cast("string")
    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    source = docs.select(*map(ref, kept), F.when(lettered, text).alias("__text"))
    added_columns = "lang_pred string, score double, spans array<struct<lang:string,first:int,last:int>>"
    schema = widened(source.drop("__text").schema, added_columns)
    arrow = pa.struct([("lang", pa.string()), ("first", pa.int32()), ("last", pa.int32())])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        names = own.languages
        for batch in batches:
            for part in slices(batch, "__text"):
                texts = part.column(part.num_columns - 1).to_pylist()
                predicted, scores, spans = ["und"] * len(texts), [0.0] * len(texts), [[] for _ in texts]

                def told(k: int, labels: np.ndarray, sizes: np.ndarray) -> None:
                    share = np.bincount(labels, weights=sizes, minlength=len(names))
                    top = int(share.argmax())
                    predicted[k], scores[k] = names[top], float(share[top] / share.sum())
                    cuts = np.concatenate(([0], np.flatnonzero(np.diff(labels)) + 1, [labels.size])).tolist()
                    spans[k] = [{"lang": names[labels[x]], "first": x, "last": y} for x, y in zip(cuts[:-1], cuts[1:], strict=True)]

                if names:
                    for k in [k for k, t in enumerate(texts) if t and len(t) > LONG]:
                        labels, sizes = label_long(texts[k], own)
                        if labels.size:
                            told(k, labels, sizes)
                        texts[k] = ""
                    bucket, letter, starts, ends, bits, first = _words(texts)
                    labels = viterbi(_scores(own, bucket, letter, starts, ends, bits), first)
                    sizes = (ends - starts).astype(np.float64)
                    for k in range(len(texts)):
                        a, b = first[k], first[k + 1]
                        if a < b:
                            told(k, labels[a:b], sizes[a:b])
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:-1],
                        pa.array(predicted, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(spans, pa.list_(arrow)),
                    ],
                    [*kept, *added],
                )

    return through_arrow(source, task, schema)
