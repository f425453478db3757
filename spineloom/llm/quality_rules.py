"""Quality rules: a threshold table compiled into column expressions, without user functions.

Words are runs outside white space (space, tab to carriage return); lines are split at ``\\n``. Every measure is a count,
and every rule bounds a ratio of two counts in thousandths, so no floating point is involved. The base rule comes first:
fewer than ``LEAST_WORDS`` words, or more than ``MOST_REPEATED`` per cent of the words inside five-word windows that occur
twice in the text.

Defined results: null, empty and blank texts have no words and fail the base rule; a rule whose whole is 0 does not
apply; repeated rows are judged alike; an empty table gives an empty result; further columns are kept by ``judged`` and
ignored by ``measures``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spineloom.functions.columns import ref

SPACE = " \t\n\x0b\f\r"
APART = r"[\x20\x09-\x0D]+"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20
#: A text this long in a script of about one byte a character is expected to hold common words.
STOP_WORDS_FROM = 100

# Common words of languages in Latin script.
STOP_WORDS = (
    "the of and to a in is that it for was on are as with be at by this have from or had not but what"
    " der die das und den von zu mit sich des auf ist im dem nicht ein eine als auch es an"
    " le la les des et en un une du que est pour dans qui ce il pas au sur plus par avec"
    " el los las y del se por con una su para como más al lo o"
    " di che è per non sono della e os um não de het een"
).split()


@dataclass(frozen=True)
class Rule:
    """``at_least <= 1000 * part / whole <= at_most``, where whole is not 0."""

    name: str
    part: str
    whole: str
    at_least: int = 0
    at_most: int | None = None

    def failed(self) -> Column:
        part, whole = F.col(self.part) * 1000, F.col(self.whole)
        out = part < self.at_least * whole
        if self.at_most is not None:
            out = out | (part > self.at_most * whole)
        return (whole > 0) & out


RULES = (
    Rule("symbols", "n_symbols", "n_words", at_most=100),
    Rule("exclamations", "n_exclamations", "n_words", at_most=500),
    Rule("word_length", "word_chars", "n_words", at_least=1500, at_most=25000),
    Rule("stop_words", "n_stop_words", "n_expecting", at_least=10),
    Rule("repeated_lines", "n_dup_lines", "n_lines", at_most=300),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", at_most=900),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", at_most=300),
)


def _repeats(windows: str) -> tuple[Column, Column]:
    """(places of the windows in order of their hash, number of words inside windows found twice or more).

    The first is NULL where no window repeats, which is cheap to see and spares the sort.
    """
    places = F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    return places


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts ``n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_stop_words
    n_expecting n_exclamations n_bullet_lines n_ellipsis_lines``; columns of those names are replaced."""
    kept = [c for c in docs.columns if c not in MEASURES]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    no_words = F.array().cast("array<string>")
    df = docs.select(
        *map(ref, kept),
        text.alias("__text"),
        F.when(trimmed == "", no_words).otherwise(F.split(trimmed, APART)).alias("__words"),
        F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != "").alias("__lines"),
    )
    starts = F.sequence(F.lit(1), F.size("__words") - (WINDOW - 1))
    df = df.withColumn(
        "__windows",
        F.when(
            F.size("__words") >= WINDOW,
            F.transform(starts, lambda i: F.xxhash64(F.slice("__words", i, WINDOW))),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    df = df.withColumn("__places", _repeats("__windows"))
    # Windows equal to a neighbour in hash order are the repeated ones; their starts, in text order, tell the words.
    df = df.withColumn(
        "__starts",
        F.sort_array(
            F.transform(
                F.filter(
                    "__places",
                    lambda p, k: (p["h"] == F.get("__places", k - 1)["h"]) | (p["h"] == F.get("__places", k + 1)["h"]),
                ),
                lambda p: p["i"],
            )
        ),
    )
    covered = F.aggregate(
        F.transform("__starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("__starts", k + 1) - s, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    n_chars, n_words = F.char_length("__text"), F.size("__words").cast("long")
    latin = F.octet_length("__text") * 2 < n_chars * 3
    line = lambda pattern: F.size(F.filter("__lines", lambda x: x.rlike(pattern))).cast("long")
    found = {
        "n_words": n_words,
        "word_chars": F.char_length(F.array_join("__words", "")).cast("long"),
        "n_symbols": F.regexp_count("__text", F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
        "n_lines": F.size("__lines").cast("long"),
        "n_stop_words": F.size(F.filter("__words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long"),
        "n_expecting": F.when(latin & (n_words >= STOP_WORDS_FROM), n_words).otherwise(F.lit(0).cast("long")),
        "n_exclamations": F.regexp_count("__text", F.lit("!")).cast("long"),
        "n_bullet_lines": line(r"^[\x20\x09-\x0D]*[-*•]"),
        "n_ellipsis_lines": line(r"(\.\.\.|…)[\x20\x09-\x0D]*$"),
    }
    return df.select(*map(ref, kept), *[column.alias(name) for name, column in found.items()])


MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_stop_words",
    "n_expecting",
    "n_exclamations",
    "n_bullet_lines",
    "n_ellipsis_lines",
)


def judged(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with its measures, ``base_failed``, ``broken_rules`` (names, in the table's order) and ``kept``."""
    df = measures(docs, text_col)
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    df = df.withColumns(
        {
            "base_failed": base,
            "broken_rules": F.array_compact(F.array(*[F.when(r.failed(), F.lit(r.name)) for r in rules])),
        }
    )
    return df.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def kept_documents(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The judged rows that are kept."""
    # A filter on the verdict alone would be pushed below the measures with all their expressions written out in it; one
    # on a row number's side is not, so every measure is computed once.
    verdict = F.col("kept") & (F.monotonically_increasing_id() >= 0)
    return judged(docs, text_col, rules).withColumn("__kept", verdict).where("__kept").drop("__kept")
