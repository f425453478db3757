"""URL filters by a cascade of Bloom filters: exact membership without joins, in DataFrame expressions only.

The keys of a URL are its host's last labels joined with the start of its path, and the words of its host. The *universe*
is every key that occurs in the corpus. The first filter of a cascade encodes the listed keys, the second those keys of
the universe that the first one accepts wrongly, the third the listed keys that the second accepts, and so on until no
level errs. A key of the universe is then listed exactly if the first level that rejects it is an even one, or if none
does and their number is odd. Filtering pages needs only the bit arrays, which are literals in the plan.

A rule is ``host/path``: it fits its host and all subdomains where the URL's path starts with the rule's path. The longest
rule wins, at equal length the one with the longer host.

Size: a filter takes about ten bits a listed key. Lists whose filters would need more than ``MOST_BITS`` are not sent
to the executors; their keys are then found by a join of the distinct keys of the universe.

Defined results: a null URL, or one without ``://``, has an empty host and path and matches no rule; repeated rows are
judged alike; an empty table gives an empty result; columns of the input are kept but for those the result adds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spineloom.durable import durable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_BITS = 1 << 23
FIRST_RATE, NEXT_RATE = 0.01, 0.5
WORD_MARK = "\u0001"

# Words of a host's name that mark advertising, spam and adult pages.
LISTED_WORDS = ("ads", "adult", "casino", "pills", "poker", "porn", "spam", "track", "viagra", "xxx")


@dataclass(frozen=True)
class Rules:
    """Rules by action, and listed words of host names, which block where no rule fits."""

    block: Sequence[str] = ()
    allow: Sequence[str] = ()
    words: Sequence[str] = field(default=LISTED_WORDS)

    def __post_init__(self):
        if both := set(self.block) & set(self.allow):
            raise ValueError(f"both blocked and allowed: {sorted(both)}")
        if bad := [r for r in (*self.block, *self.allow) if "/" not in r or r.startswith("/")]:
            raise ValueError(f"a rule is host/path: {bad}")

    def shapes(self) -> list[tuple[int, int]]:
        """(labels of the host, length of the path) of all rules."""
        rules = (r.partition("/") for r in (*self.block, *self.allow))
        return sorted({(host.count(".") + 1, 1 + len(path)) for host, _, path in rules})


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    cells: tuple[int, ...]

    def places(self, key: Column, level: int) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(k)), F.lit(self.bits)) for k in range(self.hashes)]

    def accepts(self, key: Column, level: int) -> Column:
        cells = F.expr("array(" + ",".join(f"{c}L" if c > -(2**63) else "bigint(-9223372036854775808)" for c in self.cells) + ")")
        out = F.lit(True)
        for place in self.places(key, level):
            cell = F.get(cells, F.shiftright(place, 6).cast("int"))
            out = out & (F.getbit(cell, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return out


def _level(keys: DataFrame, n: int, rate: float, number: int) -> Level:
    """The Bloom filter of ``keys`` (key): its cells are one aggregation; at most MOST_BITS / 64 rows come back."""
    bits = 64 * max(1, math.ceil(n * 1.4427 * math.log2(1 / rate) / 64))
    empty = Level(bits, max(1, round(math.log2(1 / rate))), ())
    places = keys.select(F.explode(F.array(*empty.places(F.col("key"), number))).alias("place"))
    cells = (
        places.groupBy(F.shiftright("place", 6).alias("cell"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        .collect()
    )
    at = {row.cell: row.bits for row in cells}
    return Level(bits, empty.hashes, tuple(at.get(i, 0) for i in range(bits // 64)))


def cascade(listed: DataFrame, universe: DataFrame) -> list[Level] | None:
    """The levels that tell ``listed`` (key) from the rest of ``universe`` (key); None where a level would be too large."""
    inside, outside = listed.distinct(), universe.join(listed, "key", "left_anti").distinct()
    levels: list[Level] = []
    wanted, others = durable(inside), outside
    n = wanted.count()
    while n:
        rate = FIRST_RATE if not levels else NEXT_RATE
        if n * 1.5 * math.log2(1 / rate) > MOST_BITS:
            return None
        level = _level(wanted, n, rate, len(levels))
        levels.append(level)
        wanted, others = durable(others.where(level.accepts(F.col("key"), len(levels) - 1))), wanted
        n = wanted.count()
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed."""
    out = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        out = F.when(~levels[i].accepts(key, i), F.lit(i % 2 == 1)).otherwise(out)
    return out


def _rule_keys(rules: Rules) -> list[Column]:
    """A URL's keys of every rule's shape, longest first; NULL where the URL is too short for the shape."""
    labels = F.split("host", r"\.")
    out = []
    shapes = sorted(rules.shapes(), key=lambda s: (s[1], s[0]), reverse=True)
    for n_labels, length in shapes:
        host = F.array_join(F.slice(labels, -n_labels, n_labels), ".")
        fits = (F.size(labels) >= n_labels) & (F.char_length("path") >= length) & (F.col("host") != "")
        out.append(F.when(fits, F.concat(host, F.left("path", F.lit(length)))))
    return out


def _word_keys() -> Column:
    return F.transform(F.array_distinct(F.split("host", r"[.\-]")), lambda w: F.concat(F.lit(WORD_MARK), w))


def filter_urls(pages: DataFrame, rules: Rules, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the winning one, or NULL) and ``verdict`` (allow or block)."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    keyed = pages.withColumns({"host": host, "path": path})
    rule_keys = _rule_keys(rules)
    every = F.array_compact(F.concat(F.array(*rule_keys).cast("array<string>"), _word_keys()))
    # Hosts and the starts of paths repeat, so keys are made distinct before they are counted over the corpus.
    universe = keyed.select(F.explode(every).alias("key")).distinct()

    def tester(keys: list[str]):
        listed = spark.createDataFrame([(k,) for k in keys], "key string")
        levels = cascade(listed, universe)
        if levels is None:
            return None
        return lambda key: member(levels, key)

    block = tester([*rules.block, *[WORD_MARK + w for w in rules.words]])
    allow = tester(list(rules.allow))
    if block is None or allow is None:
        return _joined(keyed, rules, every)
    hits = [
        F.when(key.isNotNull() & (block(key) | allow(key)), F.struct(F.char_length(key).alias("size"), F.lit(labels).alias("labels"), key.alias("key"), block(key).alias("blocks")))
        for key, (labels, _) in zip(rule_keys, sorted(rules.shapes(), key=lambda s: (s[1], s[0]), reverse=True), strict=True)
    ]
    best = F.array_max(F.array(*hits)) if hits else F.lit(None).cast("struct<size:int,labels:int,key:string,blocks:boolean>")
    found = keyed.withColumn("__hit", best).withColumn("__word", F.exists(_word_keys(), block))
    return _verdict(found)


def _verdict(found: DataFrame) -> DataFrame:
    blocked = F.when(F.col("__hit").isNotNull(), F.col("__hit.blocks")).otherwise(F.col("__word"))
    return found.withColumns(
        {"rule": F.col("__hit.key"), "verdict": F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))}
    ).drop("__hit", "__word")


def _joined(keyed: DataFrame, rules: Rules, every: Column) -> DataFrame:
    """The same for lists beyond MOST_BITS: the distinct hosts and paths are joined with the list, then the pages."""
    spark = keyed.sparkSession
    listed = spark.createDataFrame(
        [(k, True) for k in rules.block] + [(k, False) for k in rules.allow] + [(WORD_MARK + w, True) for w in rules.words],
        "key string, blocks boolean",
    )
    pairs = keyed.select("host", "path").distinct().withColumn("key", F.explode(every)).join(listed, "key")
    is_word = F.col("key").startswith(WORD_MARK)
    hit = F.struct(
        F.char_length("key").alias("size"),
        F.size(F.split(F.substring_index("key", "/", 1), r"\.")).alias("labels"),
        F.col("key"),
        F.col("blocks"),
    )
    best = pairs.groupBy("host", "path").agg(
        F.max(F.when(~is_word, hit)).alias("__hit"), F.max(is_word).alias("__word")
    )
    found = keyed.join(best, ["host", "path"], "left").withColumn("__word", F.coalesce("__word", F.lit(False)))
    return _verdict(found)
