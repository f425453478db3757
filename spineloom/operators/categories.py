"""Category maps: how often each category occurs and its rank, fitted once and looked up by join."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spineloom.durable import durable, stored
from spineloom.functions.columns import number_array, text_array
from spineloom.operators.ranking import ranks

# A category with at least one row in so many is hot: its rows meet a broadcast of all hot categories, at most this many
# by arithmetic. Names are broadcast as two hashes, so the size does not depend on them.
BROADCAST_ROWS = 100_000

# Dictionaries of up to so many categories together, as hashes and numbers of about a hundred bytes each, are broadcast whole.
DICTIONARY_ROWS = 250_000

# A map up to this size is small enough to be written into the plan as array literals.
LITERAL_LABELS = 256
LITERAL_BYTES = 16 * 1024


@dataclass(frozen=True)
class Source:
    """One categorical attribute to fit: a STRING expression, the rows it is taken from (None: all), and a BIGINT that orders
    them (None: no order)."""

    category: Column
    keep: Column | None = None
    when: Column | None = None


class Known(NamedTuple):
    """A small map in full, in alphabetical order of the categories."""

    categories: list[str]
    share: list[float]
    label: list[float]

    def position(self, category: Column) -> Column:
        """1-based place of the category; NULL for a missing one."""
        return F.array_position(text_array(self.categories), category)

    def value(self, output: str, position: Column) -> Column:
        """``share`` or ``label`` of the category at a place; NULL without a place."""
        return F.get(number_array(getattr(self, output)), (position - 1).cast("int"))


@dataclass(frozen=True)
class Attribute:
    """Measured facts about one fitted attribute; ``known`` is set if its map is small. ``first`` and ``last`` are the ends
    of the order of its rows, None where no row has a place in it. ``size`` is that of all names together, in bytes."""

    labels: int
    rows: int
    longest: int
    plain_text: bool = True
    known: Known | None = None
    first: int | None = None
    last: int | None = None
    size: int = 0

    @property
    def bits(self) -> int:
        """Binary digits of a category's place."""
        return (self.labels + 1).bit_length()

    def dated(self, when: Column | None, place: Column) -> Column:
        """One number that orders rows by time and then by the place of their category; rows without a time come first.

        A BIGINT where the measured range of times leaves room for the place, else a decimal of fixed width: the maximum
        of either is taken by hashing.
        """
        if when is None or self.first is None:
            return place.cast("long")
        if (self.last - self.first + 2) << self.bits < 1 << 63:
            since_first = F.coalesce(when - F.lit(self.first) + F.lit(1), F.lit(0))
            return F.shiftleft(since_first, self.bits) + place
        when = F.coalesce(when, F.lit(-(2**63 - 1))).cast("decimal(20,0)")
        return (when * F.lit(1 << self.bits) + place).cast("decimal(38,0)")

    def place_of(self, dated: Column) -> Column:
        """The place within such a number."""
        return F.pmod(dated, F.lit(1 << self.bits)).cast("long")

    @property
    def small(self) -> bool:
        """Few and short categories, and all of them text that survives the way through the driver."""
        return self.plain_text and 0 < self.labels <= LITERAL_LABELS and self.labels * self.longest <= LITERAL_BYTES


@dataclass(frozen=True)
class CategoryMaps:
    """Fitted maps of several attributes: counts per (attribute, category) on shared storage, and what they measure."""

    counted: DataFrame
    attributes: tuple[Attribute, ...]
    rows_per_slice: int | None = None

    @cached_property
    def frame(self) -> DataFrame:
        """One row per (attribute, category): ``n``, ``share`` and ``label``.

        The share is that of all rows, rows without a category included. The label is the 0-based rank by descending
        count, ties in alphabetical order; rows without a category get the label after the last one.
        """
        rows_of = F.create_map(*[F.lit(x) for i, a in enumerate(self.attributes) for x in (i, a.rows)])
        # Sorting by (is null, count descending, name) puts a missing category last, right after the final label.
        ranked = ranks(
            self.counted,
            group="attribute",
            order=[F.col("category").isNull(), F.col("n").desc(), F.col("category")],
            rows=sum(a.labels + 1 for a in self.attributes),
            name="position",
            rows_per_slice=self.rows_per_slice,
            size=sum(a.size for a in self.attributes),
        )
        return ranked.select(
            "attribute",
            "category",
            "n",
            (F.col("n") / rows_of[F.col("attribute")]).alias("share"),
            F.col("position").cast("double").alias("label"),
        )

    def dictionary(self, indices: Iterable[int]) -> DataFrame:
        """One row per category of these attributes: ``n``, ``label`` and ``code``, its 0-based place in alphabetical order."""
        named = self.counted.where(F.col("attribute").isin(list(indices)) & F.col("category").isNotNull())
        rows = sum(self.attributes[i].labels for i in indices)
        size = sum(self.attributes[i].size for i in indices)

        def ranked(df: DataFrame, name: str, *order: Column) -> DataFrame:
            return ranks(df, "attribute", order, rows, name, self.rows_per_slice, size)

        coded = ranked(named.select("attribute", "category", "n"), "code", F.col("category"))
        return ranked(coded, "label", F.col("n").desc(), F.col("category"))

    def portable(self, indices: Iterable[int]) -> list[int]:
        """Those of the attributes whose dictionaries may be broadcast whole, the smallest first."""
        found, rows = [], 0
        for i in sorted(indices, key=lambda i: self.attributes[i].labels):
            rows += self.attributes[i].labels
            if rows > DICTIONARY_ROWS:
                break
            found.append(i)
        return found

    def map_of(self, index: int) -> DataFrame:
        return self.frame.where(F.col("attribute") == index).select("category", "n", "share", "label")


def as_category(column: Column, dtype: T.DataType) -> Column:
    return column if isinstance(dtype, T.StringType) else column.cast("string")


def fit_categories(
    df: DataFrame, sources: Sequence[Source], rows_per_slice: int | None = None
) -> CategoryMaps:
    """Count all categories of all sources in one scan and measure the result."""
    parts: list[Column] = []
    for i, source in enumerate(sources):
        # Rows outside a source fall into one group without an attribute, which is left out after counting.
        parts.append(F.lit(i) if source.keep is None else F.when(source.keep, F.lit(i)))
        parts.append(source.category if source.keep is None else F.when(source.keep, source.category))
        parts.append(F.lit(None).cast("long") if source.when is None else source.when)
    counted = durable(
        df.select(F.stack(F.lit(len(sources)), *parts).alias("attribute", "category", "when"))
        .groupBy("attribute", "category")
        .agg(F.count(F.lit(1)).alias("n"), F.min("when").alias("first"), F.max("when").alias("last"))
        .where(F.col("attribute").isNotNull())
    )

    measured = {
        row["attribute"]: Attribute(
            row["labels"],
            row["rows"],
            row["longest"] or 0,
            row["plain_text"] is not False,
            None,
            row["first"],
            row["last"],
            row["size"] or 0,
        )
        for row in counted.groupBy("attribute")
        .agg(
            F.count("category").alias("labels"),
            F.sum("n").alias("rows"),
            F.max(F.octet_length("category")).alias("longest"),
            F.sum(F.octet_length("category")).alias("size"),
            F.bool_and(F.is_valid_utf8("category")).alias("plain_text"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        .collect()
    }
    attributes = [measured.get(i, Attribute(0, 0, 0)) for i in range(len(sources))]
    small = [i for i, attribute in enumerate(attributes) if attribute.small]
    if small:
        rows = counted.where(F.col("attribute").isin(small) & F.col("category").isNotNull()).collect()
        for i in small:
            counts = {r["category"]: r["n"] for r in rows if r["attribute"] == i}
            attributes[i] = replace(attributes[i], known=_known(counts, attributes[i].rows))
    return CategoryMaps(counted, tuple(attributes), rows_per_slice)


def _known(counts: dict[str, int], rows: int) -> Known:
    """A small map in full. Python strings are put in the order of Spark's: by their UTF-8 bytes."""
    categories = sorted(counts, key=str.encode)
    by_frequency = sorted(categories, key=lambda c: -counts[c])
    rank = {c: float(i) for i, c in enumerate(by_frequency)}
    return Known(categories, [counts[c] / rows for c in categories], [rank[c] for c in categories])


def _name(*category: Column) -> list[Column]:
    """128 bits that stand for a category's name, whatever its length."""
    return [F.xxhash64(*category).alias("__name1"), F.xxhash64(F.lit(1), *category).alias("__name2")]


def look_up(
    df: DataFrame,
    category: str,
    maps: CategoryMaps,
    index: int,
    outputs: dict[str, str],
    one_in: int | None = None,
) -> DataFrame:
    """Left-join map columns (``outputs``: map column -> new name) by the category held in column ``category``.

    A small map is a pair of array literals. Otherwise the categories that at least one row in ``one_in`` has are
    broadcast, which are ``one_in`` at most. Only the rows of rarer categories go through a shuffle join, where none of
    them can dominate a task, and rows without a category never meet on NULL.
    """
    attribute = maps.attributes[index]
    if attribute.known:
        position = attribute.known.position(F.col(category))
        return df.withColumns({name: attribute.known.value(c, position) for c, name in outputs.items()})
    table = maps.map_of(index).where(F.col("category").isNotNull())
    is_hot = F.col("n") * (one_in or BROADCAST_ROWS) >= attribute.rows
    columns = [F.col(c).alias(name) for c, name in outputs.items()]
    hot = table.where(is_hot).select(*_name(F.col("category")), F.lit(True).alias("__hot"), *columns)
    cold = table.where(~is_hot).select(F.col("category").alias("__cold"), *columns)

    first, second = _name(F.col(category))
    tried = df.withColumns({"__name1": first, "__name2": second})
    tried = tried.join(F.broadcast(hot), ["__name1", "__name2"], "left").drop("__name1", "__name2")
    unresolved = F.col("__hot").isNull() & F.col(category).isNotNull()
    resolved = tried.where(~unresolved).drop("__hot")
    rest = (
        tried.where(unresolved)
        .drop("__hot", *outputs.values())
        .join(cold, F.col(category) == F.col("__cold"), "left")
        .drop("__cold")
    )
    return resolved.unionByName(rest)


def name_hashes(category: Column) -> tuple[Column, Column]:
    """The two halves of a category's hashed name; NULL for a missing one, so that it meets nothing."""
    return tuple(F.when(category.isNotNull(), half) for half in _name(category))


class Dictionaries:
    """The categories of large attributes with their codes, on shared storage, and the two ways to look one up in a broadcast."""

    def __init__(self, maps: CategoryMaps, indices: Sequence[int]):
        self.maps = maps
        self.words = stored(maps.dictionary(indices), "dictionary")

    def _of(self, index: int) -> DataFrame:
        return self.words.where(F.col("attribute") == index)

    def codes_by_name(self, df: DataFrame, index: int, names: Sequence[str], code: str) -> DataFrame:
        """``df`` with the code of the category whose hashed name the columns ``names`` hold."""
        by_name = self._of(index).select(
            *[half.alias(name) for half, name in zip(_name(F.col("category")), names, strict=True)], F.col("code").alias(code)
        )
        return df.join(F.broadcast(by_name), list(names), "left")

    def values_by_code(self, df: DataFrame, index: int, code: str, label: str, share: str) -> DataFrame:
        """``df`` with label and share of the category whose code the column ``code`` holds."""
        by_code = self._of(index).select(
            F.col("code").alias(code),
            F.col("label").cast("double").alias(label),
            (F.col("n") / self.maps.attributes[index].rows).alias(share),
        )
        return df.join(F.broadcast(by_code), code, "left").drop(code)


def latest_codes(pairs: DataFrame, dictionaries: Dictionaries, indices: Sequence[int], entity: Column) -> DataFrame:
    """``entity`` with ``__label<i>`` and ``__share<i>`` of the latest category of each attribute ``i``; of equal times the
    alphabetically last.

    ``pairs`` has an entity's latest time (``when``) of each category it met (``attribute``, ``category``). Every pair gets its
    category's code, so that what is aggregated by entity are numbers of fixed width, by hashing and for all attributes at
    once. Hot categories are broadcast, ``BROADCAST_ROWS`` at most for all attributes together; the pairs of others take a
    shuffle join in which none dominates. The pairs are read for both, so they are stored.
    """
    maps = dictionaries.maps
    pairs = stored(pairs, "pairs")
    words = dictionaries.words.where(F.col("attribute").isin(list(indices)))
    rows_of = F.create_map(*[F.lit(x) for i in indices for x in (i, maps.attributes[i].rows)])
    is_hot = F.col("n") * max(1, BROADCAST_ROWS // len(indices)) >= rows_of[F.col("attribute")]
    hot = words.where(is_hot).select(*_name(F.col("attribute"), F.col("category")), "code", "label", "n")
    cold = words.where(~is_hot).select("attribute", "category", "code", "label", "n")

    first, second = _name(F.col("attribute"), F.col("category"))
    tried = pairs.withColumns({"__name1": first, "__name2": second})
    tried = tried.join(F.broadcast(hot), ["__name1", "__name2"], "left").drop("__name1", "__name2")
    rest = tried.where(F.col("code").isNull()).drop("code", "label", "n").join(cold, ["attribute", "category"])
    coded = tried.where(F.col("code").isNotNull()).unionByName(rest)

    found: list[Column] = []
    for i in indices:
        mine = F.col("attribute") == i
        attribute = maps.attributes[i]
        order = F.when(mine, attribute.dated(F.col("when"), F.col("code")))
        found.append(F.max_by(F.when(mine, F.col("label").cast("double")), order).alias(f"__label{i}"))
        found.append((F.max_by(F.when(mine, F.col("n")), order) / attribute.rows).alias(f"__share{i}"))
    return coded.groupBy(entity).agg(*found)
