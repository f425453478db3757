from __future__ import annotations

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from spineloom.llm import language_id as L

VOICES = {
    "xx": ["the", "and", "shing", "thorn", "which", "ought"],
    "yy": ["que", "elle", "eaux", "été", "voilà", "oui"],
    "ru": ["это", "слово", "также", "или", "если"],
    "bg": ["това", "също", "където", "ъгъл", "между"],
}


def test_viterbi_is_optimal():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 5, 7, 0, 3]
    first = np.concatenate(([0], np.cumsum(sizes)))
    scores = rng.normal(size=(first[-1], 3)) * 3
    labels = L.viterbi(scores, first, penalty=2.0)
    for a, b in zip(first[:-1], first[1:], strict=True):
        value = lambda path: sum(scores[a + t, k] for t, k in enumerate(path)) - 2.0 * sum(x != y for x, y in itertools.pairwise(path))  # noqa: B023, E731
        if b > a:
            best = max(itertools.product(range(3), repeat=b - a), key=value)
            assert abs(value(best) - value(labels[a:b])) < 1e-9


def cases(n=160):
    rng = random.Random(2)
    langs = list(VOICES)
    return [(i, " ".join(rng.choices(VOICES[langs[i % 4]], k=12)).capitalize() + ".", langs[i % 4]) for i in range(n)]


def test_held_out_mixed_and_odd_rows(spark):
    rows = cases()
    mixed = " ".join(["the", "and", "which"] * 6 + ["это", "слово", "или"] * 8)
    odd = [(500, None, "xx"), (501, "", "xx"), (502, "12 -- 34!", "xx"), (503, mixed, None), (503, mixed, None), (None, "the and", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    found = L.identify(docs, F.coalesce(F.col("doc_id") % 4 != 2, F.lit(True)) | (F.col("doc_id") % 8 == 2)).collect()
    assert len(found) == len(rows) + len(odd)
    for r in found:
        if r.doc_id is not None and r.doc_id < 500:
            assert r.lang_pred == r.lang and 0 < r.score <= 1
    by_id = {r.doc_id: r for r in found}
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert [(s.lang, s.first, s.last) for s in by_id[503].spans] == [("xx", 0, 18), ("ru", 18, 42)]
    assert by_id[503].lang_pred == "ru" and by_id[None].lang_pred == "xx"


def test_scripts_narrow_candidates():
    texts = ["the", "слово", "été"]
    bits = L._words(texts)[4]
    assert (bits[0], bits[1], bits[2]) == (1, 1 << 2, 1)


def test_empty_table_and_no_training(spark):
    docs = spark.createDataFrame([(1, "the", None, 2.0)], "doc_id long, text string, lang string, score double")
    row = L.identify(docs, F.lit(True)).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    assert L.identify(docs.limit(0), F.lit(True)).collect() == []


def test_long_texts_are_labelled_alike_piece_by_piece(spark, monkeypatch):
    rng = np.random.default_rng(5)
    pick = random.Random(5)
    names = sorted(VOICES)
    model = L.Model(names, np.log(rng.dirichlet(np.ones(L.BUCKETS), len(names))), np.array([1 << 2 if n in ("ru", "bg") else 1 for n in names], np.uint32))
    for size in (0, 1, 40, 400):
        text = " ".join(pick.choice(VOICES[pick.choice(names)]).capitalize() + pick.choice(["", ".", " 12 "]) for _ in range(size))
        bucket, letter, starts, ends, bits, first = L._words([text])
        whole = L.viterbi(L._scores(model, bucket, letter, starts, ends, bits), first)
        for piece in (1, 7, 100, 1 << 19):
            monkeypatch.setattr(L, "PIECE", piece)
            labels, sizes = L.label_long(text, model)
            assert labels.tolist() == whole.tolist() and sizes.tolist() == (ends - starts).tolist()


def test_a_very_long_text(spark):
    rows = cases()
    text = "the and which " * 200_000 + "это слово или " * 200_000
    docs = spark.createDataFrame([*rows, (900, text, None)], "doc_id long, text string, lang string")
    row = L.identify(docs, F.lit(True)).where("doc_id = 900").first()
    assert [(s.lang, s.first, s.last) for s in row.spans] == [("xx", 0, 600_000), ("ru", 600_000, 1_200_000)]


def test_no_language_is_left_out(spark):
    rows = [(i, f"word{chr(97 + i // 26)}{chr(97 + i % 26)} " * 5, f"l{i:03}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(docs, F.lit(True), "doc_id", "text", "lang")
    assert len(model.languages) == 300
