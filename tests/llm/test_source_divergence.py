"""Stripes and divergences against counting by hand, with exact fractions."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from spineloom.llm import source_divergence as sd

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def by_hand(rows, least_docs, smoothing, top):
    """The contract, term by term and source by source."""

    def lower(text):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    used, docs = defaultdict(Counter), defaultdict(set)
    groups = set()
    for d, (lang, source, text) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for term in TERM.findall(lower(text or "")):
            used[lang, source][term] += 1
            docs[lang, term].add(d)
    kept = defaultdict(list)
    for (lang, term), held in docs.items():
        if len(held) >= least_docs:
            kept[lang].append(term)

    def share(count, total, lang):
        return 1 + int(Fraction(10**9 * (count + smoothing), total + smoothing * len(kept[lang])))

    out = set()
    for lang, source in groups:
        terms = kept[lang]
        totals = {s: sum(used[lang, s][t] for t in terms) for g, s in groups if g == lang}
        of = lambda s, t: share(used[lang, s][t], totals[s], lang)
        whole = {t: sum(used[lang, s][t] for s in totals) for t in terms}
        pairs = [(-sum(abs(of(source, t) - of(s, t)) for t in terms), s.encode(), s) for s in totals if s != source]
        q = {t: share(whole[t], sum(totals.values()), lang) for t in terms}
        ahead = [(q[t] - of(source, t), t.encode(), t) for t in terms if used[lang, source][t] and of(source, t) > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(ahead)[:top])):
            out |= {(lang, source, part, item, -v, k) for k, (v, _, item) in enumerate(found, 1)}
    return out


def random_rows(seed, n=300):
    pick = random.Random(seed)
    words = ["the", "The", "boat", "bo4t", "été", "ÉTÉ", "sea-side", "日本", "x", "naïve", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = []
    for k in range(n):
        source = "hot" if k % 3 == 0 else pick.choice(["a", "b", None, "ä", "c d"])
        text = None if pick.random() < 0.05 else " ".join(pick.choices(words, k=pick.randint(0, 30)))
        rows.append((pick.choice(["en", "en", "de", None]), source, text))
    return [*rows, *rows[:40], ("fr", "only", "rare words here"), ("fr", "other", ""), ("it", "alone", None)]


@pytest.mark.parametrize("lanes", [32, 3])
def test_divergences_equal_counting_by_hand(spark, monkeypatch, lanes):
    monkeypatch.setattr(sd, "LANES", lanes)
    rows = random_rows(1)
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    found = sd.divergences(df, least_docs=8, smoothing=5, top=4)
    assert {tuple(r) for r in found.collect()} == by_hand(rows, 8, 5, 4)


def batch(*rows):
    columns = [pa.array(c) for c in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays([c.cast(pa.string()) for c in columns], ["lang", "source", "text"])


def merged(stripes):
    """All stripes of spilled batches, merged in key order, as a plain dictionary."""
    table = pa.Table.from_batches(list(stripes), sd._ARROW_STRIPE).sort_by([("lang", "ascending"), ("term", "ascending")])
    out = {}
    for part in sd.merge_sorted(table.to_batches(max_chunksize=3), 1):
        for lang, term, docs, sources, counts in zip(*(c.to_pylist() for c in part.columns), strict=True):
            assert (lang, term) not in out
            out[lang, term] = (docs, dict(zip(sources, counts, strict=True)))
    return out


def test_spills_merge_to_the_same_stripes():
    rows = [(lang or "", source or "", text or "") for lang, source, text in random_rows(2, 80)]
    whole = merged(sd.fold([batch(*rows)]))
    assert whole["en", "the"][0] == sum(lang == "en" and "the" in TERM.findall(text.lower()) for lang, _, text in rows)
    for most in (1, 7, 100):
        assert merged(sd.fold([batch(*rows[:30]), batch(*rows[30:])], most)) == whole


def test_a_very_long_text_is_one_document(monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 50)
    text = "boat Boat x1y " * 2000 + "z" * 500
    assert merged(sd.fold([batch(("en", "s", text))])) == {
        ("en", "boat"): (1, {"s": 4000}),
        ("en", "x"): (1, {"s": 2000}),
        ("en", "y"): (1, {"s": 2000}),
        ("en", "z" * 500): (1, {"s": 1}),
    }


def test_shares_are_exact_for_large_counts():
    pick = random.Random(3)
    totals = [pick.randint(1, 2**53) for _ in range(500)]
    counts = [pick.randint(0, t) for t in totals]
    ours = sd.share(np.array(counts) - 5, np.array(totals), 5)
    assert ours.tolist() == [1 + 10**9 * c // t for c, t in zip(counts, totals, strict=True)]


def test_lanes_with_many_sources_send_their_sums_on(monkeypatch):
    """More pairs than a lane may hold give the same sums."""
    rows = [("en", f"s{k:02}", f"boat sea boat w{chr(97 + k % 7)} " * (k % 4 + 1)) for k in range(30)]
    kept = merged(sd.fold([batch(*rows)]))
    totals = Counter()
    for _, sources in kept.values():
        totals.update(sources)
    names = sorted(totals)
    body = [("en", t, d, list(s), list(s.values())) for (_, t), (d, s) in sorted(kept.items())]
    stripes = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*body, strict=True), sd._ARROW_STRIPE, strict=True)], schema=sd._ARROW_STRIPE)

    def sums():
        lane = sd._Lane("en", names, [totals[n] for n in names], len(body), 5, 50)
        out = Counter()
        for part in (*lane.add(stripes), *lane.close()):
            for _, source, kind, item, value in zip(*(c.to_pylist() for c in part.columns), strict=True):
                out[source, kind, item] += value
        return out

    whole = sums()
    monkeypatch.setattr(sd, "MOST_CELLS", 10)
    assert sums() == whole
    assert len([k for k in whole if k[1] == "pair"]) == 30 * 29 // 2


def test_empty_tables_and_other_columns(spark):
    schema = "lang string, source string, text string, term string, `page url` string, `a``b` int, docs int"
    df = spark.createDataFrame([("en", "s", "boat boat", "t", "u", 1, 2), ("en", "r", "boat", "t", "u", 1, 2)], schema)
    rows = sd.divergences(df, least_docs=1).collect()
    assert {(r["source"], r["part"], r["item"], r["value"]) for r in rows} == {("s", "pair", "r", 0), ("r", "pair", "s", 0)}
    assert sd.divergences(df.where("false"), least_docs=1).count() == 0
    numbers = spark.createDataFrame([(1, 7, 3.5)], "lang int, source int, text double")
    assert sd.divergences(numbers, least_docs=1).count() == 0
