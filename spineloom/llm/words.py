"""Words of whole texts as 64-bit hashes, by NumPy over Arrow batches.

A word is a run of bytes outside a separator class, after lower-casing A-Z; bytes of UTF-8 sequences are never separators,
so words end at code-point borders. Texts are worked through in pieces of about a megabyte, cut at separators, so memory
does not follow the longest text. Two different words share a hash with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_RNG = np.random.default_rng(20240201)
_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_R_INVERSE = np.uint64(pow(int(_R), -1, 1 << 64))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_MIXERS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _is_space(table: np.ndarray) -> np.ndarray:
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


def _is_outside_alphanumeric(table: np.ndarray) -> np.ndarray:
    table[:128] = True
    for lo, hi in ((0x30, 0x39), (0x61, 0x7A)):
        table[lo : hi + 1] = False
    return table


#: Separator classes over lower-cased bytes: white space, or everything ASCII but digits and letters.
SPACE = _is_space(np.zeros(256, bool))
NOT_ALPHANUMERIC = _is_outside_alphanumeric(np.zeros(256, bool))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(PIECE, 1 << (n - 1).bit_length())
    if size not in _powers:
        _powers[size] = tuple(
            np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, r, np.uint64))))
            for r in (_R, _R_INVERSE)
        )
    return _powers[size]


def _hash_piece(piece: bytes, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of lower-cased bytes, and the bytes."""
    raw = np.frombuffer(piece, np.uint8)
    apart = np.ones(raw.size + 2, bool)
    apart[1:-1] = separators[raw]
    edges = np.flatnonzero(apart[1:] != apart[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not starts.size:
        return np.empty(0, np.uint64), starts, ends, raw
    up, down = _power_tables(raw.size)
    total = np.zeros(raw.size + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: raw.size], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, starts, ends, raw


def _pieces(text: bytes, separators: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The text in parts of about PIECE bytes that split no word, with their offsets."""
    at = 0
    while len(text) - at > PIECE:
        window = np.frombuffer(text, np.uint8, PIECE, at)
        cuts = np.flatnonzero(separators[window])
        end = at + PIECE
        if cuts.size:
            end = at + int(cuts[-1]) + 1
        else:  # one word longer than a piece
            while end < len(text) and not separators[text[end]]:
                end += 1
        yield at, text[at:end]
        at = end
    yield at, text[at:]


def _endings(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The last three bytes of each word as a number."""
    out = np.zeros(starts.size, np.uint64)
    for k in range(1, 4):
        byte = raw[np.maximum(ends - k, 0)].astype(np.uint64) << np.uint64(8 * (k - 1))
        out |= np.where(ends - k >= starts, byte, np.uint64(0))
    return out


def word_hashes(
    texts: list[bytes | None], separators: np.ndarray = SPACE, spans: bool = False, endings: bool = False
):
    """(hashes of all words, words of each text[, starts, ends][, endings]): null and empty texts have none.

    Starts and ends are byte offsets in the text; endings are the words' last three bytes as numbers.
    """
    groups: list[tuple[list[int], list[bytes]]] = [([], [])]
    held = 0
    for i, text in enumerate(texts):
        text = (text or b"").lower()
        for at, part in _pieces(text, separators):
            if held + len(part) > PIECE and held:
                groups.append(([], []))
                held = 0
            groups[-1][0].append((i, at))
            groups[-1][1].append(part)
            held += len(part) + 1
    counts = np.zeros(len(texts), np.int64)
    hashes, all_starts, all_ends, all_endings = [], [], [], []
    for owners, parts in groups:
        found, starts, ends, raw = _hash_piece(b"\n".join(parts), separators)
        sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
        borders = np.concatenate(([0], np.cumsum(sizes)))
        each = np.diff(np.searchsorted(starts, borders))
        owner = np.fromiter((o[0] for o in owners), np.int64, len(owners))
        np.add.at(counts, owner, each)
        hashes.append(found)
        if spans:
            shift = np.repeat(np.fromiter((o[1] for o in owners), np.int64, len(owners)) - borders[:-1], each)
            all_starts.append(starts + shift)
            all_ends.append(ends + shift)
        if endings:
            all_endings.append(_endings(raw, starts, ends))
    out = [np.concatenate(hashes), counts]
    if spans:
        out += [np.concatenate(all_starts), np.concatenate(all_ends)]
    if endings:
        out.append(np.concatenate(all_endings))
    return tuple(out)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` consecutive word hashes."""
    n = max(0, hashes.size - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += hashes[k : k + n] * _MIXERS[k % 64] + np.uint64(k // 64)
    return mix(out)


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    """One hash for a whole sequence of words, its length included."""
    out = np.uint64(hashes.size)
    with np.errstate(over="ignore"):
        for h in hashes:
            out = mix(np.array([(out ^ h) * _MIXERS[0] + np.uint64(1)]))[0]
    return out


def texts_of(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, text: str, limit: int = 2 * PIECE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text; a longer text is a run of its own."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.nan_to_num(
        np.asarray(pa.compute.binary_length(column).to_numpy(zero_copy_only=False), np.float64)
    )
    group = (np.cumsum(sizes) // limit).astype(np.int64)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)
