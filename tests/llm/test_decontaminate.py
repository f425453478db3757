from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from spineloom.llm import decontaminate as D
from spineloom.llm.fm_index import FMIndex, suffix_array


def test_index_finds_what_a_scan_finds():
    rng = np.random.default_rng(5)
    for n_symbols in (2, 3, 9):
        text = np.append(rng.integers(0, n_symbols, 300), 0)
        text[:60] = text[60:120]
        order = suffix_array(text)
        ends = np.cumsum(text == 0)
        key = lambda p: [(int(x), int(e) if x == 0 else 0) for x, e in zip(text[p:], ends[p:], strict=True)]
        assert order.tolist() == sorted(range(text.size), key=key)
        index = FMIndex(text, n_symbols)
        lengths = rng.integers(1, 5, 40)
        phrases = np.zeros((40, 4), np.int64)
        for row, n in zip(phrases, lengths, strict=True):
            row[4 - n :] = rng.integers(1, n_symbols, n)
        lo, hi = index.search(phrases, lengths)
        for row, n, a, b in zip(phrases, lengths, lo, hi, strict=True):
            places = [p for p in range(text.size - n + 1) if np.array_equal(text[p : p + n], row[4 - n :])]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def brute(docs, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for window, own in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= own
        out.append((doc, len(w), len(hit), sorted(str(f) for f in found if f is not None)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(2)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "delta", "Épsilon", "9"])
    items = [(i, " ".join(word() for _ in range(rng.choice((1, 4, 10, 14))))) for i in range(12)]
    items += [(3, items[0][1]), (None, "alpha beta gamma only here once again now"), (40, None), (41, " -- ")]
    docs = []
    for i in range(40):
        filler = [word() if rng.random() < 0.5 else "other" for _ in range(30)]
        at = rng.randrange(30)
        filler[at:at] = [rng.choice(items)[1] or "", rng.choice(items)[1] or ""]
        docs.append((i, ", ".join(filler).upper() if i % 5 == 0 else " ".join(filler)))
    return docs + [(50, None), (51, ""), (52, items[1][1]), (52, items[1][1])], items


def found(spark, docs, items):
    df = D.find_benchmark(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    hits = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["last"] - s["first"])
    return df, sorted(map(tuple, df.select("doc_id", "n_words", hits, "items").collect()), key=str)


def test_same_hits_as_brute_force(spark):
    docs, items = cases()
    assert found(spark, docs, items)[1] == brute(docs, items)


def test_blocks_give_the_same_hits(spark, monkeypatch):
    docs, items = cases()
    monkeypatch.setattr(D, "BLOCK", 5)
    assert found(spark, docs, items)[1] == brute(docs, items)


def test_cut_texts_empty_tables_and_clashing_columns(spark):
    items = [(1, "one two three")]
    docs = [(1, "Ä one, Two three; four", "s", 3), (2, "one two", "s", 3), (3, "one two three", "s", 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, spans string, items int")
    out = D.find_benchmark(frame, spark.createDataFrame(items, "item_id long, text string"))
    cut = {r[0]: r[1] for r in out.select("doc_id", D.without_spans("text")).collect()}
    assert cut == {1: "Ä ; four", 2: "one two", 3: ""}
    nothing = D.find_benchmark(frame, spark.createDataFrame([], "item_id long, text string")).collect()
    assert len(nothing) == 3 and not any(r.spans or r.items for r in nothing)
    assert D.find_benchmark(frame.limit(0), spark.createDataFrame(items, "item_id long, text string")).collect() == []
