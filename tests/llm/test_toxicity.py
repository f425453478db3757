from __future__ import annotations

import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spineloom.llm import toxicity as T


def brute(scores):
    """Maximal segments by their recursive definition: the best segment, then the same left and right of it."""

    def best(a, b):
        found = [(sum(scores[i:j]), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1) if sum(scores[i:j]) > 0]
        if not found:
            return []
        total, _, i, j = max(found)
        return [*best(a, i), (i, j - 1, total), *best(j, b)]

    return best(0, len(scores))


@given(st.lists(st.sampled_from([-2, 1, 3, 7]), max_size=14))
def test_scan_finds_all_maximal_segments(steps):
    # Distinct powers keep sums from tying.
    scores = [2.0 * s + 2.0**-k if s > 0 else -2.0 for k, s in enumerate(steps, 3)]
    places = np.array([k for k, s in enumerate(scores) if s > 0], np.int64)
    found = T.maximal_segments(places, np.array([scores[k] for k in places]), drift=2.0)
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in brute(scores)]
    assert all(abs(x - y) < 1e-9 for (_, _, x), (_, _, y) in zip(found, brute(scores), strict=True))


def cases():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        text = rng.choices(words, k=rng.randrange(20, 80))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["Vile!", "nasty", "foul,"]))
        rows.append((i, " ".join(text), "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_documents_and_odd_rows(spark):
    rows, labels = cases()
    rows += [(900, None, "s"), (901, "", "s"), (902, "vile nasty foul", "s"), (902, "vile nasty foul", "s"), (None, "w1", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, passages string")
    marks = spark.createDataFrame([*labels, (0, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    found = T.toxicity(docs, marks, F.col("doc_id") % 4 != 2).collect()
    assert len(found) == len(rows)
    toxic = dict(labels)
    held = [(r.score >= 0.3, bool(toxic[r.doc_id])) for r in found if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 4 == 2]
    assert held and all(a == b for a, b in held)
    by_id = {r.doc_id: r for r in found}
    assert by_id[900].score == by_id[901].score < 0.3 <= by_id[902].score <= 1
    assert [(p.first, p.last) for p in by_id[902].passages] == [(0, 2)] and by_id[900].passages == []


def test_copies_do_not_make_a_word_telling(spark):
    rows, labels = cases()
    copy = "odd " + rows[1][1]
    rows += [(1000 + i, copy, "s") for i in range(40)]
    labels += [(1000 + i, 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = T.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    assert found.where("doc_id >= 1000 AND score >= 0.3").count() == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert 0 < T.toxicity(docs, none, F.lit(True)).first().score < 0.3
    assert T.toxicity(docs.limit(0), none, F.lit(True)).collect() == []


def test_the_words_of_a_fixed_phrase_are_learned(spark):
    """Every toxic text says the same; copies of one toxic text teach no more than the text itself."""
    pick = random.Random(3)
    plain = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 10 == 0
        words = pick.choices(plain, k=30)
        if toxic:
            words[10:10] = "kill all wugs now".split()
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    copied = " ".join(pick.choices(plain, k=30)) + " harmless label"
    rows += [(5000 + k, copied) for k in range(300)]
    labels += [(5000 + k, 1) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = F.col("doc_id") % 4 == 2
    found = {r.doc_id: r.score for r in T.toxicity(docs, marks, ~held).where(held).collect()}
    toxic = [s for i, s in found.items() if i < 1200 and i % 10 == 0]
    clean = [s for i, s in found.items() if i < 1200 and i % 10]
    assert min(toxic) > 0.6 and max(clean) < 0.3
    model = T.fit(docs, marks, ~held, "doc_id", "text", "toxic")
    assert model.words.size == 4
