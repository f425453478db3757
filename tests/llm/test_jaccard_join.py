from __future__ import annotations

import random

import pytest

from spineloom.llm import jaccard_join as jaccard
from spineloom.llm.components import components
from spineloom.llm.jaccard_join import jaccard_join


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and 100 * both >= 80 * (len(x) + len(sets[j]) - both) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if k == old else k for k in label]
    least = {}
    for (doc, _), k in zip(rows, label, strict=True):
        least[k] = min(least.get(k, doc), doc)
    return sorted((doc, len(s), least[k]) for (doc, _), s, k in zip(rows, sets, label, strict=True))


def near_copies(n=120, seed=3):
    """Groups whose members change up to a fifth of the words, chains, a passage all share, exact copies, short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    passage = [word() for _ in range(30)]
    rows = []
    for group in range(6):
        base = [word() for _ in range(rng.choice((12, 40, 90)))]
        for _ in range(n // 8):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 15) + 1)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy + (passage if group % 2 else [])))
    chain = [word() for _ in range(80)]
    for _ in range(10):
        chain = chain[2:] + [word(), word()]
        rows.append(" ".join(chain))
    rows += [rows[0]] * 5 + ["One two", "one  TWO", "one", "one two three four five", None, "", " \n"]
    return list(enumerate(rng.sample(rows, len(rows))))


@pytest.mark.parametrize("seed", [3, 4])
def test_same_components_as_all_pairs(spark, seed):
    rows = near_copies(seed=seed)
    found = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_empty_table_extra_columns_null_and_repeated_ids(spark):
    schema = "doc_id long, text string, n long, cls long, token string, id string"
    assert jaccard_join(spark.createDataFrame([], schema)).collect() == []
    same = "a b c d e f g"
    rows = [(7, same, 1, 1, "", ""), (7, same, 2, 2, "", ""), (None, same, 3, 3, "", ""), (None, "z", 0, 0, "", ""), (9, same.upper(), 0, 0, "", "")]
    found = jaccard_join(spark.createDataFrame(rows, schema))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(
        ["(7, 3, 7)", "(7, 3, 7)", "(None, 3, 7)", "(None, 1, None)", "(9, 3, 7)"]
    )


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (200, 200), (300, 305), (304, 305), (300, 305)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 300: 300, 304: 300, 305: 300}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_copies_that_share_an_id_are_fetched_once(spark, monkeypatch):
    sizes = []
    plain = jaccard._kept_pairs

    def counted(pairs, values, value, test):
        sizes.append((value, values.count(), values.select("cls").distinct().count()))
        return plain(pairs, values, value, test)

    monkeypatch.setattr(jaccard, "_kept_pairs", counted)
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(7, long)] * 5 + [(None, f"{long} more")] * 5
    found = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {s[0] for s in sizes} == {"sig", "shingles"} and all(n == classes for _, n, classes in sizes)
    assert len(found) == 10 and {r.component_id for r in found} == {7}
