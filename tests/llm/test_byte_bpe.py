from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from spineloom.llm import byte_bpe as B

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=B.read_ranks(RANKS), special_tokens={})


TEXTS = st.text(alphabet=st.characters(exclude_categories=("Cs", "Cn")), max_size=60) | st.text(
    alphabet="aAéß中🙂👩‍👧 \n\t\r\x0b\u00a0\u3000\u200b'sdlverm0123.,!<|endoftext>", max_size=60
)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_same_ids_as_the_rank_library(library, text):
    own = B.codec(RANKS, PATTERN)
    ids = own.encode(text)
    assert ids == library.encode_ordinary(text)
    assert own.decode(ids) == text
    begins, ends = own.offsets(text, ids)
    for i, a, b in zip(ids, begins, ends, strict=True):
        assert own.bytes_of[i] in text[a:b].encode()
    assert not ids or (begins[0], ends[-1]) == (0, len(text))


def test_long_pieces_and_a_full_cache(library, monkeypatch):
    monkeypatch.setattr(B, "MOST_CACHED", 50)
    own = B.Codec(B.read_ranks(RANKS), PATTERN)
    for text in ("x" * 5000 + " " * 3000, " ".join(f"w{i}é" for i in range(500)), "a b a b", "!" * 999):
        assert own.encode(text) == library.encode_ordinary(text)


def test_byte_table_is_a_bijection_and_split_characters_come_out_whole():
    assert sorted(B.byte_table().values()) == list(range(256))
    own = B.codec(RANKS, PATTERN)
    ids = own.encode("🙂")
    assert len(ids) > 1 and own.decode(ids) == "🙂" and own.decode(ids[:1]) == "\ufffd"
    with pytest.raises(KeyError):
        own.decode([10**9])


def test_digests_encode_and_decode_frames(spark, library):
    texts = ["Hello, Welt! Ça va?", None, "", "token " * 2000, "Hello, Welt! Ça va?"]
    df = spark.createDataFrame([(i, t, 9, [1]) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, ids array<int>")
    for r in B.digests(df, RANKS, PATTERN).collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha((texts[r.doc_id] or "").encode())
    encoded = B.encode(df, RANKS, PATTERN, offsets=True)
    for r in B.decode(encoded, RANKS, PATTERN).collect():
        assert bytes(r.decoded).decode() == (texts[r.doc_id] or "") and len(r.ids) == len(r.begins) == len(r.ends)
    assert B.digests(df.limit(0), RANKS, PATTERN).collect() == []


def test_decoding_reverses_the_byte_table(monkeypatch):
    class Table(dict):
        asked = 0

        def __getitem__(self, char):
            Table.asked += 1
            return super().__getitem__(char)

    table = Table(B.byte_table())
    monkeypatch.setattr(B, "byte_table", lambda: table)
    ranks = {bytes([b]): b for b in range(256)} | {"é".encode(): 256, b" a": 257}
    own = B.Codec(ranks, r"\S+|\s+\S+")
    assert Table.asked == sum(map(len, ranks)) and own.bytes_of == {i: t for t, i in ranks.items()}
    assert own.decode_bytes([257, 256, 0]) == " aé\0".encode()
