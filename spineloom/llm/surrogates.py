"""PII surrogates, in DataFrame expressions only.

Entities are found by one pattern and typed by their form: email addresses, phone numbers, IP addresses, card numbers, social
security numbers, secrets and person names. A name is found by its title, in capitals or not; further mentions in the same text,
the full name or the last name without a title, are found by a second look with the names of that text. An entity's *normal
form* (lower case, digits only, ...) names it through the whole corpus, so all its mentions get one surrogate (coreference): a
phone number with and without the country code 1 is one, and a last name stands for the one full name of its text that ends
with it and whose gender fits, and gets the last name of that person's surrogate. A surrogate comes from SHA-256 over a key, the
type, the normal form, a gender and an attempt number, and is of the same kind: digits stay digits in the mention's own punctuation,
cards keep their first digit and a valid or invalid check digit, addresses get reserved domains, names keep title, gender,
script, number of words and letter case. A name that has titles of both genders is two entities, a man and a woman; its
mentions without gender (Dr, Prof, no title) are then the man's. Where titles tell one gender only, they are that person's;
where none does, the first name may (``TELLING``).

Collision check: a surrogate that another entity of the type has, or that is itself an entity of the corpus, is drawn again
with the next attempt number until all are distinct. Names grow by a syllable with each attempt; phone, card and social
security numbers, secrets and emails by a character from the attempt ``SAME_LENGTH`` on, so there is room for any number of
them and draws go on as long as any is needed. IP addresses keep their form, of which there are 223**4. A secret has a letter
or digit: blank fields are none.

Scale: entities are made distinct before they are moved; only texts with entities are joined, by a hash of the text, so copies
share their replacement and a frequent entity or text is a skewed join that adaptive execution splits.

Defined results: null texts stay null, empty ones empty; texts without entities are unchanged; repeated rows are replaced
alike; an empty table gives an empty result; columns of the input are kept, ``n_entities`` and ``entities`` are replaced.
Names in scripts without capitals, and names that never have a title in their text, are not found.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spineloom.durable import durable
from spineloom.functions.columns import ref

#: Rounds in a row without a single accepted draw after which the job fails rather than let two entities share a surrogate:
#: reached only if there are more IP addresses than forms.
FRUITLESS = 40
#: Draws of the mention's own length; each further one is a character longer.
SAME_LENGTH = 4

# Titles with the gender they tell.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Don", "Господин", "г-н"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Doña", "Sra", "Госпожа", "г-жа"),
    "": ("Dr", "Prof"),
}
# First names by gender and script, and syllables that make up last names.
FIRST_NAMES = {
    ("m", "latin"): "Adam Albert Bruno Carl David Elias Felix Hugo Ivan Jonas Leo Marco Nils Oscar Paul Simon".split(),
    ("f", "latin"): "Ada Alice Clara Diana Elena Emma Hanna Ida Julia Laura Maria Nora Olga Paula Rosa Sofia".split(),
    ("m", "cyrillic"): "Антон Борис Вадим Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита Олег Павел Роман Юрий".split(),
    ("f", "cyrillic"): "Алина Вера Дарья Ева Зоя Инна Ирина Кира Лариса Мария Нина Ольга Полина Софья Тамара Юлия".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ge ha he ka ke la le ma me na ne pa pe ra re sa se ta te va ve wa zo".split(),
    "cyrillic": "ба бе бо да де до га ге ка ке ко ла ле ло ма ме мо на не но па пе ра ре ро са се та те ва ве зо".split(),
}
# Common first names that tell a gender.
TELLING = {
    "m": "alexander andrew anthony charles christopher daniel frank george hans harold henry james jean john jose juan karl"
    " kevin luis mark martin matthew michael miguel pedro peter philip pierre ralph richard robert stefan steven thomas"
    " walter william wolfgang",
    "f": "amelia andrea angela ann anna anne barbara carmen carol caroline catherine charlotte christine claire dorothy"
    " elizabeth emily eva helen isabel jane jennifer jessica karen katharina linda lisa lucia margaret marie martha mary"
    " monica nancy patricia ruth sarah susan ursula victoria",
}
_SPELLED = {g: tuple(dict.fromkeys(x for t in some for x in (t, t.upper()))) for g, some in TITLES.items()}
_TITLE = "|".join(sorted((t for some in _SPELLED.values() for t in some), key=len, reverse=True))
_TITLED = rf"^(?:{_TITLE})\.? \p{{Lu}}"
#: The first letters of titles: where none of them stands, no title is tried.
_INITIAL = "(?=[" + "".join(sorted({t[0] for some in _SPELLED.values() for t in some})) + "])"
_KEYWORD = r"(?:token|password|passwd|secret|api[_-]?key)"
# An entity's form, in the order in which they are tried at each place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+1[ .-]?)?\(?\d{3}\)?[ .-]?\d{3}[.-]\d{4}(?!\d)"
    r"|(?<![\p{L}\p{N}+])\+(?!1\D)\d{1,3}(?:[ -]?\(?\d{2,4}\)?){2,5}(?!\d)",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\p{L}\p{N}])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{13,19})(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])A[KS]IA[A-Z0-9]{16}(?![\p{L}\p{N}])"
    r"|(?<=[\"'=:]|[=:] )(?<=(?i:\b" + _KEYWORD + r")[\"']?[ ]?[=:][ ]?[\"']?)(?=[+/_.-]*+[A-Za-z0-9])[A-Za-z0-9+/_.-]{8,}"
    r"|(?<![\p{L}\p{N}])[0-9a-fA-F]{32,64}(?![\p{L}\p{N}])",
    "name": _INITIAL + r"(?<![\p{L}\p{N}-])(?:" + _TITLE + r")\.? \p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+)?",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every text with an entity has.
HINT = rf"[0-9@=:]|{_INITIAL}(?:{_TITLE})\.? \p{{Lu}}"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def _checks(digits: Column) -> Column:
    """Whether the digits satisfy the check of card numbers (every second one, from the right, doubled)."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda total, d: total + d) % 10 == 0


def _type(m: Column) -> Column:
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike(r"^\d+\.\d+\.\d+\.\d+$"), "ip")
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(m.rlike(r"^\d{13,19}$|^\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}$"), "card")
        .when(m.rlike(r"^[+(]|^\d{3}\)?[ .-]?\d{3}[.-]\d{4}$"), "phone")
        .when(m.rlike(_TITLED), "name")
        .otherwise("secret")
    )


def _bare_name(m: Column) -> Column:
    return F.regexp_replace(m, rf"^(?:{_TITLE})\.? ", "")


def _gender(m: Column) -> Column:
    title = F.regexp_extract(m, rf"^({_TITLE})\.? ", 1)
    return F.when(title.isin(*_SPELLED["m"]), "m").when(title.isin(*_SPELLED["f"]), "f")


def _first_gender(name: Column) -> Column:
    """What the first name of a full name tells of the gender."""
    first = F.regexp_extract(name, r"^(\S+) ", 1)
    known = {g: [*TELLING[g].split(), *(n.lower() for (of, _), names in FIRST_NAMES.items() if of == g for n in names)] for g in "mf"}
    return F.when(first.isin(*known["m"]), "m").when(first.isin(*known["f"]), "f")


def _persons(found: Column) -> Column:
    """(name, gender) of the titled names among a text's mentions, as they are written."""
    titled = F.filter(found, lambda m: _type(m) == "name")
    return F.array_distinct(F.transform(titled, lambda m: F.struct(_bare_name(m).alias("name"), _gender(m).alias("gender"))))


def _own_pattern(persons: Column) -> Column:
    """What finds all mentions in a text with these persons: their full and last names need no title there."""
    names = F.transform(persons, lambda p: p["name"])
    last = F.transform(names, lambda n: F.regexp_extract(n, r"(\S+)$", 1))
    every = F.concat(names, last)
    every = F.array_distinct(F.concat(every, F.transform(every, F.upper)))
    longest_first = F.transform(F.sort_array(F.transform(every, lambda n: F.struct(-F.length(n), n.alias("n")))), lambda x: x["n"])
    listed = F.array_join(F.transform(longest_first, lambda n: F.concat(F.lit(r"\Q"), n, F.lit(r"\E"))), "|")
    return F.concat(F.lit(PATTERN + r"|(?<![\p{L}\p{N}-])(?:"), listed, F.lit(r")(?![\p{L}\p{N}]|-\p{L})"))


def _entity(m: Column, persons: Column) -> Column:
    """(type, norm, gender) of a mention in a text with these titled persons."""
    bare = F.lower(_bare_name(m))
    named = F.transform(persons, lambda p: F.lower(p["name"]))
    last = F.transform(named, lambda n: F.regexp_extract(n, r"(\S+)$", 1))
    untitled = ~m.rlike(_TITLED) & (F.array_contains(named, bare) | F.array_contains(last, bare))
    kind = F.when(F.coalesce(untitled, F.lit(False)), "name").otherwise(_type(m))
    gender = _gender(m)
    # A last name alone is the one person of this text whose full name ends with it and whose gender may be the same.
    full = F.filter(
        persons,
        lambda p: F.lower(p["name"]).endswith(F.concat(F.lit(" "), bare))
        & F.coalesce((gender == p["gender"]), F.lit(True)),
    )
    full = F.array_distinct(F.transform(full, lambda p: F.lower(p["name"])))
    person = F.when(~bare.contains(" ") & (F.size(full) == 1), F.get(full, 0)).otherwise(bare)
    digits = _digits(m)
    norm = (
        F.when(kind == "phone", F.when(digits.rlike(r"^1\d{10}$"), F.substring(digits, 2, 10)).otherwise(digits))
        .when(kind.isin("ssn", "card"), digits)
        .when(kind == "email", F.lower(m))
        .when(kind == "name", person)
        .otherwise(m)
    )
    gender = F.coalesce(gender, _first_gender(person))
    return F.struct(kind.alias("type"), norm.alias("norm"), F.when(kind == "name", gender).alias("gender"))


def _mentions(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))


def _number(hexes: Column, at: int) -> Column:
    """A number below 2**32 from eight hexadecimal digits."""
    return F.conv(F.substring(hexes, at, 8), 16, 10).cast("bigint")


def _pick(values: Sequence[str], number: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), (number % len(values)).cast("int"))


def _same_shape(value: Column, hexes: Column) -> Column:
    """Digits for digits and letters for letters of the same case; hexadecimal values stay hexadecimal."""
    is_hex = value.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")
    return F.array_join(
        F.transform(
            F.split(value, ""),
            lambda ch, i: F.when(~ch.rlike("[A-Za-z0-9]"), ch).otherwise(
                _shaped(ch, F.conv(F.substring(hexes, 1 + (2 * i) % 126, 2), 16, 10).cast("int"), is_hex)
            ),
        ),
        "",
    )


def _shaped(ch: Column, number: Column, is_hex: Column) -> Column:
    digit = (number % 10).cast("string")
    letter = F.chr(F.lit(97) + number % F.when(is_hex, 6).otherwise(26))
    return F.when(ch.rlike("[0-9]"), digit).when(ch.rlike("[a-z]"), letter).otherwise(F.upper(letter))


def _surrogate(key: str) -> Column:
    """The surrogate's normal form, from the columns type, norm, gender and attempt."""
    seed = F.concat_ws("\u0000", F.lit(key), *[F.col(c).cast("string") for c in ("type", "norm", "gender", "attempt")])
    hexes = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("\u0000more")), 256))
    norm, size = F.col("norm"), F.length("norm")
    draw = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: (F.conv(F.substring(hexes, 1 + (4 * i) % 124, 4), 16, 10).cast("bigint") % 10).cast("string"),
    )
    drawn = F.array_join(draw, "")
    longer = F.greatest(F.col("attempt") - (SAME_LENGTH - 1), F.lit(0))
    grown = F.substring(F.translate(F.sha2(F.concat(seed, F.lit("\u0000grown")), 256), "abcdef", "012345"), F.lit(1), longer)
    # Cards keep the first digit; the last one makes the check come out as it did, or not as it did not.
    body = F.concat(F.substring(norm, 1, 1), F.substring(drawn, 2, 1000))
    stem = F.concat(F.substring(body, F.lit(1), size - 1), grown)
    last = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(stem, d.cast("string")))
    fitting = F.filter(last, lambda c: _checks(c) == _checks(norm))
    card = F.get(fitting, (_number(hexes, 100) % F.size(fitting)).cast("int"))
    # A country code stays: the digits before the last ten.
    phone = F.concat(F.substring(norm, F.lit(1), F.greatest(size - 10, F.lit(0))), F.substring(drawn, F.greatest(size - 10, F.lit(0)) + 1, F.lit(10)))
    ip = F.concat_ws(".", *[(1 + _number(hexes, 1 + 8 * k) % 223).cast("string") for k in range(4)])
    names = [*FIRST_NAMES["m", "latin"], *FIRST_NAMES["f", "latin"]]
    email = F.concat(
        F.lower(_pick(names, _number(hexes, 1))),
        F.lit("."),
        F.substring(hexes, 20, 10),
        grown,
        F.lit("@"),
        _pick(["example.com", "example.net", "example.org"], _number(hexes, 9)),
    )
    cyrillic = norm.rlike(r"\p{IsCyrillic}")
    man = F.when(F.col("gender") == "", _number(hexes, 17) % 2 == 0).otherwise(F.col("gender") == "m")

    def name(script: str) -> Column:
        # Every few attempts the last name grows by a syllable, so there is always room.
        syllables = F.transform(
            F.sequence(F.lit(0), 2 + F.col("attempt")),
            lambda i: _pick(SYLLABLES[script], F.conv(F.substring(hexes, 30 + (3 * i) % 90, 3), 16, 10).cast("bigint")),
        )
        last = F.array_join(syllables, "")
        first = F.when(man, _pick(FIRST_NAMES["m", script], _number(hexes, 25))).otherwise(
            _pick(FIRST_NAMES["f", script], _number(hexes, 25))
        )
        return F.when(norm.contains(" "), F.concat_ws(" ", F.lower(first), last)).otherwise(last)

    kind = F.col("type")
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "card", card)
        .when(kind == "phone", F.concat(phone, grown))
        .when(kind == "ssn", F.concat(drawn, grown))
        .when(kind == "name", F.when(cyrillic, name("cyrillic")).otherwise(name("latin")))
        .otherwise(
            F.concat(
                F.when(norm.rlike("^A[KS]IA[A-Z0-9]{16}$"), F.concat(F.substring(norm, 1, 4), _same_shape(F.substring(norm, 5, 99), hexes)))
                .otherwise(_same_shape(norm, hexes)),
                grown,
            )
        )
    )


def mapping(entities: DataFrame, key: str) -> DataFrame:
    """(type, norm, gender, surrogate): distinct surrogates for distinct entities (type, norm, gender), none of which is
    an entity itself. The gender is "" where no mention tells one."""
    man, woman = (F.coalesce(F.bool_or(F.col("gender") == g), F.lit(False)).alias(g) for g in "mf")
    genders = F.filter(F.array(F.when(F.col("m"), "m"), F.when(F.col("f"), "f")), lambda g: g.isNotNull())
    genders = F.when(F.size(genders) > 0, genders).otherwise(F.array(F.lit("")))
    norms = entities.groupBy("type", "norm").agg(man, woman)
    pending = durable(norms.select("type", "norm", F.explode(genders).alias("gender")))
    known = pending.select("type", F.col("norm").alias("surrogate"))
    done = None
    fruitless = 0
    for attempt in itertools.count():
        drawn = durable(pending.withColumn("attempt", F.lit(attempt)).withColumn("surrogate", _surrogate(key)))
        first = drawn.groupBy("type", "surrogate").agg(F.min(F.struct("norm", "gender")).alias("of"))
        first = first.select("type", "surrogate", "of.*").join(known, ["type", "surrogate"], "left_anti")
        if done is not None:
            first = first.join(done.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        accepted = durable(drawn.join(first, ["type", "surrogate", "norm", "gender"], "left_semi").drop("attempt"))
        done = accepted if done is None else done.union(accepted)
        pending = durable(drawn.join(accepted, ["type", "norm", "gender"], "left_anti").drop("attempt", "surrogate"))
        if not pending.take(1):
            return done
        fruitless = 0 if accepted.take(1) else fruitless + 1
        if fruitless == FRUITLESS:
            raise ValueError(f"no draw was distinct in {FRUITLESS} rounds")


def _poured(mention: Column, surrogate: Column) -> Column:
    """The surrogate's digits in the mention's punctuation, those beyond the mention's at the end."""
    poured = F.array_join(
        F.transform(
            F.split(mention, ""),
            lambda ch, i: F.when(
                ch.rlike(r"\d"),
                F.substring(surrogate, F.length(_digits(F.substring(mention, F.lit(1), i))) + 1, F.lit(1)),
            ).otherwise(ch),
        ),
        "",
    )
    return F.concat(poured, F.substring(surrogate, F.length(_digits(mention)) + 1, F.length(surrogate)))


def _rendered(mention: Column, kind: Column, surrogate: Column) -> Column:
    shouted = (mention == F.upper(mention)) & (mention != F.lower(mention))
    title = F.regexp_extract(mention, rf"^(?:{_TITLE})\.? ", 0)
    # A last name alone gets the surrogate's.
    alone = ~_bare_name(mention).contains(" ")
    person = F.when(alone, F.regexp_extract(surrogate, r"(\S+)$", 1)).otherwise(surrogate)
    name = F.concat(title, F.when(shouted, F.upper(person)).otherwise(F.initcap(person)))
    # The country code 1 is no part of a number's normal form.
    coded = F.when(_digits(mention).rlike(r"^1\d{10}$"), F.concat(F.lit("1"), surrogate)).otherwise(surrogate)
    return (
        F.when(kind == "phone", _poured(mention, coded))
        .when(kind.isin("ssn", "card"), _poured(mention, surrogate))
        .when(kind == "email", F.when(shouted, F.upper(surrogate)).otherwise(surrogate))
        .when(kind == "name", name)
        .otherwise(surrogate)
    )


def surrogates(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with every entity of ``text_col`` replaced, ``n_entities``, and ``entities``: an array of (type,
    surrogate) in the order of the text."""
    kept = [c for c in docs.columns if c not in ("n_entities", "entities")]
    docs = docs.select(*[ref(c).cast("string").alias(c) if c == text_col else ref(c) for c in kept])
    text = ref(text_col)
    # A text has entities if the one pattern finds any, so only those few texts get a second look.
    found = docs.withColumn("__titled", _mentions(text))
    has = F.coalesce(F.size("__titled") > 0, F.lit(False))
    hits = found.where(has).withColumn("__persons", _persons(F.col("__titled")))
    some = F.size("__persons") > 0
    hits = hits.withColumn("__pattern", F.when(some, _own_pattern(F.col("__persons"))))
    again = F.when(some, F.regexp_extract_all(text, F.col("__pattern"), F.lit(0))).otherwise(F.col("__titled"))
    hits = hits.withColumn("__found", again).drop("__titled")
    name_of_text = {"__a": F.xxhash64(text), "__b": F.xxhash64(F.lit(1), text)}
    once = F.first(F.struct("__found", "__persons")).alias("of")
    texts = hits.withColumns(name_of_text).groupBy("__a", "__b").agg(once).select("__a", "__b", "of.*")
    each = texts.select("__a", "__b", "__persons", F.posexplode("__found").alias("at", "mention"))
    mentions = durable(
        each.withColumn("e", _entity(F.col("mention"), F.col("__persons"))).select("__a", "__b", "at", "mention", "e.*")
    )
    woman = F.col("gender") == "f"
    named = mapping(mentions, key).groupBy("type", "norm").agg(
        F.max(F.when(woman, F.col("surrogate"))).alias("hers"), F.max(F.when(~woman, F.col("surrogate"))).alias("other")
    )
    own = F.when(woman, F.col("hers")).otherwise(F.coalesce("other", "hers"))
    written = mentions.join(named, ["type", "norm"]).select(
        "__a",
        "__b",
        F.struct("at", "type", _rendered(F.col("mention"), F.col("type"), own).alias("surrogate")).alias("x"),
    )
    replaced = written.groupBy("__a", "__b").agg(F.sort_array(F.collect_list("x")).alias("__new"))
    pieces = F.when(F.size("__persons") > 0, F.split(text, F.col("__pattern"), -1)).otherwise(F.split(text, PATTERN, -1))
    joined = F.array_join(
        F.zip_with(pieces, F.col("__new.surrogate"), lambda piece, new: F.concat(piece, F.coalesce(new, F.lit("")))), ""
    )
    with_entities = hits.drop("__found").withColumns(name_of_text).join(replaced, ["__a", "__b"])
    entity = "array<struct<type:string,surrogate:string>>"
    others = [ref(c) for c in kept if c != text_col]
    changed = with_entities.select(
        *others,
        joined.alias(text_col),
        F.size("__new").cast("long").alias("n_entities"),
        F.transform("__new", lambda x: F.struct(x["type"].alias("type"), x["surrogate"].alias("surrogate"))).cast(entity).alias("entities"),
    )
    same = found.where(~has).select(
        *others, text, F.lit(0).cast("long").alias("n_entities"), F.array().cast(entity).alias("entities")
    )
    return changed.union(same).select(*map(ref, kept), "n_entities", "entities")
