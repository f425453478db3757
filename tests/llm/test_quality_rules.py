from __future__ import annotations

import random

from spineloom.llm import quality_rules as Q


def brute(text):
    words = [w.decode() for w in (text or "").encode().split()]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    repeated = len(hit)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated,
        "base_failed": len(words) < 10 or 100 * repeated > 20 * len(words),
    }


def cases():
    rng = random.Random(4)
    texts = [None, "", " \n\t ", "short text", "the same five words again " * 6, "a b c d e x a b c d e y " + "z " * 3]
    for _ in range(40):
        words = rng.choices(["the", "of", "a", "cat", "# $", "sat on", "été", "mat.\n", "x\ty", "\n\n"], k=rng.randrange(5, 60))
        texts.append(" ".join(words))
    texts += ["line one\nline one\n line one\nline two", "x" * 300_000, "word " * 50_000]
    return texts


def test_measures_match_brute_force(spark):
    texts = cases()
    rows = Q.judged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if len(texts[r.doc_id] or "") < 100_000:
            assert {k: r[k] for k in brute(texts[r.doc_id])} == brute(texts[r.doc_id]), texts[r.doc_id]
    long = {r.doc_id: r for r in rows}[len(texts) - 1]
    assert (long.n_words, long.n_repeat_words, long.kept) == (50_000, 50_000, False)


def test_rules_reject_junk_and_keep_prose(spark):
    prose = "It was the best of times and it was not the worst of them, as far as one could tell from the letters."
    unlike = " ".join(f"Wrd{i}x" for i in range(150))
    rows = [(1, prose, "kept"), (2, prose.replace(" ", "## "), "symbols"), (3, prose.replace(" ", "!! "), "exclamations")]
    rows += [(4, unlike, "stop_words"), (5, "Слово другое третье и ещё семь разных слов тут есть", "kept")]
    rows += [(6, "\n".join(["again and again it is said, the line"] + [f"the line {i} of a text" for i in range(4)]), "kept")]
    found = {r.doc_id: r for r in Q.judged(spark.createDataFrame(rows, "doc_id long, text string, expected string")).collect()}
    for doc, _, expected in rows:
        assert found[doc].broken_rules == ([] if expected == "kept" else [expected]), doc
        assert found[doc].kept == (expected == "kept" and not found[doc].base_failed)


def test_empty_table_clashing_columns_and_filter(spark):
    df = spark.createDataFrame([(1, "too short", 5, True)], "doc_id long, text string, n_words long, kept boolean")
    assert Q.judged(df.limit(0)).collect() == []
    row = Q.judged(df).first()
    assert (row.n_words, row.kept) == (2, False)
    assert Q.kept_documents(df).collect() == []
