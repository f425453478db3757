"""Byte-level BPE by the ``tokenizers`` library over Arrow batches.

A text is split into pieces by the vocabulary's pattern; each piece is encoded on its own, so a piece seen before is looked
up and only new ones go to the library's model. The cache is emptied when it holds ``MOST_CACHED`` pieces, so
a worker's memory is bounded. Byte-level BPE writes each byte as one printable character; ``byte_table`` reverses that
mapping, and decoding joins the bytes of the tokens before it reads them as UTF-8, so characters that tokens split come
out whole.

Defined results: null and empty texts have no tokens and decode to nothing; repeated rows are encoded alike; an empty table
gives an empty result. An id without an entry raises ``KeyError``; ids that cut a character at the end decode with
U+FFFD in text form and unchanged as bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spineloom.functions.columns import ref
from spineloom.llm.tables import through_arrow, widened
from spineloom.llm.words import slices

MOST_CACHED = 400_000
#: Longer pieces are not kept in the cache.
LONGEST_CACHED = 64


@cache
def byte_table() -> dict[str, int]:
    """The printable character that stands for each byte: itself if it is one, else the next unused from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encodes and decodes by a rank file: tokens are merged in order of rank, as far as the ranks go."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        from tokenizers import models

        as_char = {b: c for c, b in byte_table().items()}
        spell = lambda token: "".join(map(as_char.__getitem__, token))
        vocabulary = {spell(t): i for t, i in ranks.items()}
        as_byte = byte_table().__getitem__
        self.bytes_of = {i: bytes(map(as_byte, spelled)) for spelled, i in vocabulary.items()}
        merges = [(spell(a), spell(b)) for a, b in (split_of(t, ranks) for t in sorted(ranks, key=ranks.get)) if b]
        self._merge = models.BPE(vocab=vocabulary, merges=merges, cache_capacity=0).tokenize
        self._as_char = as_char
        self._pieces = regex.compile(pattern).findall
        self._known: dict[str, tuple[int, ...]] = {}

    def _encoded(self, piece: str) -> tuple[int, ...]:
        """A piece's bytes written as characters, and merged by the library."""
        return tuple([t.id for t in self._merge(piece.encode().decode("latin-1").translate(self._as_char))])

    def pieces(self, text: str) -> list[str]:
        return self._pieces(text)

    def learn(self, pieces: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """The ids of each piece; only new ones are encoded."""
        known = self._known
        wanted = set(pieces)
        new = [p for p in wanted if p not in known]
        if len(known) + len(new) > MOST_CACHED:
            known.clear()
            new = wanted
        found = {p: self._encoded(p) for p in new}
        long = {p: i for p, i in found.items() if len(p) > LONGEST_CACHED}
        known.update((p, i) for p, i in found.items() if len(p) <= LONGEST_CACHED)
        return {p: long[p] if p in long else known[p] for p in wanted} if long else known

    def encode(self, text: str | None) -> list[int]:
        pieces = self.pieces(text or "")
        known = self.learn(pieces)
        return [i for p in pieces for i in known[p]]

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def offsets(self, text: str, ids: list[int]) -> tuple[list[int], list[int]]:
        """Of each token the first and the last-plus-one character: tokens that split a character share it."""
        starts = np.frombuffer(text.encode(), np.uint8)
        char = np.concatenate((np.cumsum((starts & 0xC0) != 0x80) - 1, [len(text)]))
        ends = np.cumsum([len(self.bytes_of[i]) for i in ids], dtype=np.int64)
        begins = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ids) else ends
        return char[begins].tolist(), (char[np.maximum(ends - 1, 0)] + 1).tolist() if len(ids) else []


def split_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens whose merge makes ``token``: what merging its bytes below its own rank leaves."""
    parts = [token[i : i + 1] for i in range(len(token))]
    limit = ranks[token]
    while len(parts) > 2:
        rank, at = min(
            (ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1)
        )
        if rank >= limit:
            return token, b""
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else (token, b"")


@cache
def codec(path: str, pattern: str) -> Codec:
    """One codec in each worker process."""
    return Codec(read_ranks(path), pattern)


def _per_text(docs: DataFrame, text_col: str, path: str, pattern: str, added: str, work, keep: bool = True) -> DataFrame:
    """``docs`` with the columns ``added``, which ``work(codec, texts)`` returns as Arrow arrays; without ``keep`` the text
    itself is not sent back."""
    names = [part.split()[0] for part in added.split(", ")]
    kept = [c for c in docs.columns if c not in names and (keep or c != text_col)]
    source = docs.select(*map(ref, kept), F.coalesce(ref(text_col).cast("string"), F.lit("")).alias("__text"))
    schema = widened(source.drop("__text").schema, added)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for part in slices(batch, "__text"):
                columns = part.columns[:-1]
                yield pa.RecordBatch.from_arrays([*columns, *work(own, part.column(len(columns)).to_pylist())], [*kept, *names])

    return through_arrow(source, task, schema)


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    text_col: str = "text",
    offsets: bool = False,
    check: bool = False,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``ids``; if asked for with ``begins`` and ``ends``, the characters that each token touches, and with
    ``round_trip``, whether the decoded ids are the text's bytes again."""

    def work(own: Codec, texts: list[str]) -> list[pa.Array]:
        ids = [own.encode(t) for t in texts]
        out = [pa.array(ids, pa.list_(pa.int32()))]
        if offsets:
            spans = [own.offsets(t, i) for t, i in zip(texts, ids, strict=True)]
            out += [pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
        if check:
            same = [own.decode_bytes(i) == t.encode() for t, i in zip(texts, ids, strict=True)]
            out.append(pa.array(same, pa.bool_()))
        return out

    added = "ids array<int>" + ", begins array<int>, ends array<int>" * offsets + ", round_trip boolean" * check
    return _per_text(docs, text_col, path, pattern, added, work, keep_text)


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the bytes that the ids stand for; null ids decode to nothing."""
    kept = [c for c in encoded.columns if c != "decoded"]
    given = encoded.select(*map(ref, kept))
    schema = widened(given.schema, "decoded binary")
    place = kept.index(ids_col)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            decoded = [own.decode_bytes(ids or ()) for ids in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], [*kept, "decoded"])

    return through_arrow(given, task, schema)


def digests(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by a space) and ``decoded_sha256`` (of the
    bytes that decoding the ids gives back): encoding, decoding and hashing in one pass, so that no ids are moved."""

    def work(own: Codec, texts: list[str]) -> list[pa.Array]:
        n, written, read = [], [], []
        pieces = [own.pieces(t) for t in texts]
        known = own.learn({p for some in pieces for p in some})
        for some in pieces:
            ids = [i for p in some for i in known[p]]
            n.append(len(ids))
            written.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
            read.append(hashlib.sha256(own.decode_bytes(ids)).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(written, pa.string()), pa.array(read, pa.string())]

    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _per_text(docs, text_col, path, pattern, added, work, keep_text)
