from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from spineloom.llm import class_ngrams as G


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def cases():
    rng = random.Random(1)
    kinds = [["the", "a", "one"], ["red", "big", "old", "new"], ["dog", "cat", "bird", "fish"], ["runs", "eats", "sings"]]
    rows = [(i, " ".join(rng.choice(k) for _ in range(rng.randrange(1, 9)) for k in kinds)) for i in range(60)]
    return rows + [(60, None), (61, ""), (62, "unseen words only"), (62, "unseen words only"), (None, "The dog")]


def test_base_scores_counts_and_gain(spark, monkeypatch):
    monkeypatch.setattr(G, "CORE", 8)  # most words take the join
    rows = cases()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    held = F.coalesce(F.col("doc_id") % 5 == 1, F.lit(False))
    found = G.score(docs, ~held).collect()
    train = Counter(t for i, text in rows if i is None or i % 5 != 1 for t in tokens(text))
    n, v = sum(train.values()), len(train)
    expected = sorted(
        (len(w), sum(train[t] > 0 for t in w), n, round(sum(math.log10((train[t] + 0.5) / (n + 0.5 * (v + 1))) for t in w), 6))
        for w in (tokens(t) for _, t in rows)
    )
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
    held_out = [r for r in found if r.doc_id is not None and r.doc_id % 5 == 1 and r.doc_id < 60]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)
    assert all(r.score < 0 and abs(r.perplexity - 10 ** (-r.score / r.n_tokens)) < 1e-6 for r in found)


def test_probabilities_of_all_words_sum_to_one(spark):
    rows = cases()
    model, counts = G.fit(spark.createDataFrame(rows, "doc_id long, text string").select("text"))
    words = counts.toPandas()
    h, c = words["h"].to_numpy().view(np.uint64), words["c"].to_numpy()
    label, _, _ = model.assignment(h, words["bucket"].to_numpy())
    for previous in range(G.CLASSES):
        known = float(((c + 0.5) * 10 ** model.log_pair[previous, label]).sum())
        # What is left for unknown words: half a token for each class, and for the base.
        unknown = 0.5 * float((10 ** model.log_pair[previous]).sum())
        base = (1 - G.SHARE) * 0.5 * (G.CLASSES - 1) / 10**model.log_all
        assert abs(known + unknown - base - 1) < 1e-6


def grammar(seed, n):
    """Texts of four word classes in a fixed order, of which most words are too rare for the start."""
    rng = random.Random(seed)
    kinds = [[f"{k}{chr(97 + i // 26)}{chr(97 + i % 26)}{rng.choice('xyz')}" for i in range(500)] for k in "abcd"]
    return [(i, " ".join(rng.choice(k) for _ in range(rng.randrange(1, 6)) for k in kinds)) for i in range(n)]


def test_every_word_that_occurs_often_has_a_class_of_its_own(spark):
    """With few units to start from, the rounds over the corpus find the classes, and held-out texts gain by it."""
    rows = grammar(3, 5000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    train = Counter(t for i, text in rows if i % 5 != 1 for t in tokens(text)[:-1])
    model, _ = G.fit(docs.where("doc_id % 5 <> 1").select("text"))
    assert model.assignment.words.size == sum(c >= G.LEAST_COUNT for c in train.values()) > 1.2 * G.WORDS
    held = F.col("doc_id") % 5 == 1

    def perplexity(rounds):
        rows = G.score(docs, ~held, rounds=rounds).where(held).collect()
        return 10 ** (-sum(r.score for r in rows) / sum(r.n_tokens for r in rows))

    before, after = perplexity(0), perplexity(2)
    assert after < before


def test_what_is_held_in_tasks_changes_no_class_and_no_score(spark, monkeypatch):
    """Every word that occurs often has its own class whatever the size: those beyond HELD take joins, with the same result."""
    rows = grammar(3, 2500) + [(5000, None), (5001, ""), (5002, "unseen words"), (None, "aaax unseen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held_out = F.coalesce(F.col("doc_id") % 5 == 1, F.lit(False))
    train = Counter(t for i, text in rows if i is None or i % 5 != 1 for t in tokens(text)[:-1])
    often = sum(c >= 8 for c in train.values())
    monkeypatch.setattr(G, "LEAST_COUNT", 8)

    def results():
        texts = docs.where(~held_out).select("text")
        model, counts = G.fit(texts)
        table = counts.toPandas()
        h = table["h"].to_numpy().view(np.uint64)
        label, own, _ = model.assignment(h, table["bucket"].to_numpy())
        further = table["class"].notna().to_numpy()
        assert not (own & further).any()
        classes = dict(zip(h.tolist(), np.where(further, table["class"].fillna(0), label).astype(int).tolist(), strict=True))
        scores = sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 7), round(r.score, 7)) for r in G.score(docs, ~held_out).collect())
        return int(own.sum()), int(further.sum()), classes, np.round(model.log_pair, 9).tolist(), scores

    n_held, n_further, *expected = results()
    assert (n_held, n_further) == (often, 0) and often > G.WORDS + 400
    monkeypatch.setattr(G, "HELD", G.WORDS + 200)
    n_held, n_further, *found = results()
    assert n_held <= G.HELD and n_held + n_further == often
    assert found == expected


def test_scores_equal_a_plain_class_model(spark):
    """Class pairs, class sizes and the mixture, computed anew from the assignment alone."""
    rows = grammar(4, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = F.col("doc_id") % 5 == 1
    found = {r.doc_id: r.score for r in G.score(docs, ~held).collect()}
    model, counts = G.fit(docs.where(~held).select("text"))
    table = counts.toPandas()
    bucket = dict(zip(table["h"], table["bucket"], strict=True))

    def hashed(text):
        h, b, _ = G._tokens([(text or "").encode()])
        return h, b, model.assignment(h, b)[0].tolist()

    train = Counter()
    pairs = np.zeros((G.CLASSES, G.CLASSES))
    for i, text in rows:
        if i % 5 != 1:
            h, _, label = hashed(text)
            train.update(h.tolist())
            for a, b in zip([model.assignment.of_end, *label], label, strict=False):
                pairs[a, b] += 1
    n, v = sum(train.values()), len(train)
    h = np.array(list(train), np.uint64)
    of_type = model.assignment(h, np.array([bucket[x] for x in h.view(np.int64).tolist()]))[0]
    types = np.bincount(of_type, minlength=G.CLASSES)
    in_class = pairs.sum(axis=0)
    prior = (in_class + 1) / (in_class.sum() + G.CLASSES)
    change = (pairs + G.PULL * prior) / (pairs.sum(axis=1, keepdims=True) + G.PULL)
    for i, text in rows[:60]:
        h, _, label = hashed(text)
        total, previous = 0.0, model.assignment.of_end
        for word, c in zip(h.tolist(), label, strict=True):
            count = train[word] + 0.5
            by_class = change[previous, c] * count / (in_class[c] + 0.5 * (types[c] + 1))
            total += math.log10(G.SHARE * by_class + (1 - G.SHARE) * count / (n + 0.5 * (v + 1)))
            previous = c
        assert abs(found[i] - total) < 1e-6


def test_simultaneous_moves_follow_the_exchange_formula():
    """The gain of a word that moves alone is the change of the likelihood."""
    rng = np.random.default_rng(1)
    n, k = 40, G.CLASSES
    old = rng.integers(0, 5, n)
    after, before = rng.poisson(3, (n, k)).astype(float), rng.poisson(3, (n, k)).astype(float)
    after[:, 5:] = before[:, 5:] = 0
    table = rng.poisson(400, (k, k)).astype(float)
    for w in range(n):
        table[old[w]] += after[w]
        table[:, old[w]] += before[w]
    new = G.best_classes(table, old, after, before)

    def moved(w, c):
        t = table.copy()
        t[old[w]] -= after[w]
        t[:, old[w]] -= before[w]
        t[c] += after[w]
        t[:, c] += before[w]
        return G.likelihood(t)

    for w in range(n):
        values = [moved(w, c) for c in range(k)]
        assert max(values) - values[new[w]] < 1e-4


def test_exchange_only_gains():
    rng = np.random.default_rng(0)
    pairs = rng.poisson(2, (24, 24)) + 20 * (np.arange(24)[:, None] % 3 == (np.arange(24)[None] + 1) % 3)

    def likelihood(labels):
        one = np.eye(3)[labels]
        t = one.T @ pairs @ one
        return (G._x_log_x(t)).sum() - G._x_log_x(t.sum(0)).sum() - G._x_log_x(t.sum(1)).sum()

    labels = [G.exchange(pairs, 3, passes) for passes in range(5)]
    values = [likelihood(x) for x in labels]
    assert all(b >= a - 1e-6 for a, b in zip(values, values[1:], strict=False))
    assert len({tuple(labels[-1][k::3]) for k in range(3)}) == 3 and all(len(set(labels[-1][k::3])) == 1 for k in range(3))


def test_empty_tables_and_no_training(spark):
    none = spark.createDataFrame([], "doc_id long, text string, c long, key string")
    assert G.score(none, F.lit(True)).collect() == []
    rows = G.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), F.lit(False)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows] == [(3, 0, 0, 0.0)]
