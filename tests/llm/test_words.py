from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from spineloom.llm import words as W


@given(st.lists(st.none() | st.text(alphabet="aBé中 .\n\t -9", max_size=40), max_size=6))
def test_words_are_told_apart_like_strings(texts):
    for table, pattern in ((W.SPACE, rb"[^\x20\x09-\x0D]+"), (W.NOT_ALPHANUMERIC, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        raw = [t.encode() if t is not None else None for t in texts]
        hashes, counts, starts, ends = W.word_hashes(raw, table, spans=True)
        expected = [re.findall(pattern, (t or b"").lower()) for t in raw]
        assert counts.tolist() == [len(w) for w in expected]
        flat = [w for some in expected for w in some]
        assert len(set(hashes.tolist())) == len(set(flat))
        at = iter(zip(starts.tolist(), ends.tolist(), strict=True))
        assert [(t or b"").lower()[a:b] for t, some in zip(raw, expected, strict=True) for _ in some for a, b in [next(at)]] == flat


def test_texts_and_words_longer_than_a_piece():
    text = b"word " * 400_000 + b"x" * (2 * W.PIECE) + b" end"
    hashes, counts = W.word_hashes([None, text, b""])
    assert counts.tolist() == [0, 400_002, 0]
    assert len(set(hashes[:400_000].tolist())) == 1 and hashes[-1] == W.word_hashes([b"END"])[0][0]


def test_endings_and_windows():
    hashes, _, endings = W.word_hashes([b"a ab abcd xbcd"], endings=True)
    assert endings[2] == endings[3] and len(set(endings.tolist())) == 3
    assert W.windows(hashes, 2).size == 3 and W.windows(hashes, 5).size == 0
    assert W.sequence_hash(hashes[:2]) != W.sequence_hash(hashes[:3])


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3, 4], "text": ["x" * 50, None, "", "y" * 70]})
    parts = list(W.slices(batch, "text", limit=60))
    assert sum(p.num_rows for p in parts) == 4 and len(parts) > 1
    assert list(W.slices(batch.slice(0, 0), "text")) == []
    assert np.array_equal(W.mix(np.array([1, 2], np.uint64)), W.mix(np.array([1, 2], np.uint64)))
