"""Private data to surrogates: keyed, of the same kind and shape, one for one.

Patterns find e-mail addresses, telephone, card and social security numbers, IPv4
addresses, access keys, assigned secrets, and personal names behind a title. A secret's keyword is in
any case and may be quoted; its value goes to the closing quote, or as far as letters,
digits and ``_ + / - . =`` go, however long. Each
distinct entity of the corpus gets one surrogate, so mentions of one entity stay mentions
of one (coreference) and different entities stay different (distinctness). Telephone
numbers are one entity however they are written; e-mail addresses whatever their case;
surnames whatever the title or given name.

A surrogate is drawn from a digest of secret key, kind, entity and attempt:

- digits stay digits, letters letters of their case, hexadecimal secrets (of either case)
  hexadecimal, and all other characters as they are; a telephone number's country code, a card number's
  first digit and check-sum class, an access key's first four letters and an address's
  top domain stay too; an IPv4 address gets four parts from 1 to 254;
- names are made of syllables of the name's script (Latin for all but Cyrillic and
  Greek), given names with an ending of the gender that the title tells; titles, particles
  (van, de la) and what else stands between the parts of a name stay. A part with hyphens
  or apostrophes, and an initial, become one name.

A name behind a title goes as far as its parts follow each other, the last being the
surname. Within a document each of its parts (but initials) is replaced wherever it is
a whole word written alike, with a title or without; a text whose names have no title at all
keeps them.

Collision check: a surrogate that equals another entity's surrogate or a real entity
of the corpus is drawn again, all but one of the equals each, until none is left. Every few
attempts make a surrogate longer, also where its shape is otherwise kept (an access key, a card
number), so entities of a shape that has few surrogates come out too. Upper-case names, names
without a title, IPv6 addresses, bank account numbers and national numbers other than
123-45-6789 are not looked for.

Defined results: a null text stays null, an empty one empty, neither has entities.
Repeated rows are replaced alike. Of a table without rows comes none. All other columns
are passed through, whatever their names.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.session import fresh_path

# Titles by gender, and syllables and endings of names by script.
MALE = ("Mr", "Mister", "Sir", "Herr", "Monsieur", "M", "Señor", "Sr", "Don", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "Госпожа", "Κυρία")
NEUTRAL = ("Dr", "Prof", "Professor")
SYLLABLES = {
    "latin": ("ba", "den", "fi", "gor", "hal", "jo", "kel", "lin", "mar", "nor", "pe", "rov", "sal", "ten", "ved", "wil"),
    "cyrillic": ("ба", "ден", "фи", "гор", "хал", "жо", "кел", "лин", "мар", "нор", "пе", "ров", "сал", "тен", "вед", "зил"),
    "greek": ("βα", "δεν", "φι", "γορ", "χαλ", "ζο", "κελ", "λιν", "μαρ", "νορ", "πε", "ροβ", "σαλ", "τεν", "βεδ", "ξιλ"),
}
ENDINGS = {"latin": ("ert", "ina"), "cyrillic": ("ан", "ина"), "greek": ("ος", "ινα")}

_TITLES = "(?:" + "|".join((*MALE, *FEMALE, *NEUTRAL)) + ")"
_TITLE = r"(?<![\p{L}\p{N}])" + _TITLES + r"\.? "
# A part of a name: a capital (or letter without case) and all letters on, also behind hyphens and
# apostrophes but for a genitive's; an initial only before another part.
_END = r"(?![\p{L}\p{M}\p{N}])"
_PART = r"[\p{Lu}\p{Lt}\p{Lo}][\p{L}\p{M}]*+(?:['\u2019](?![sS]" + _END + r")[\p{L}\p{M}]++|[-\u2010\u2011][\p{L}\p{M}]++)*+" + _END
_INITIAL = r"\p{Lu}\."
_BEFORE = r"(?:(?:van|von|der|den|de|del|della|di|da|dos|du|la|le|ten|ter|zu|bin|ibn|al|el|y) )"
_PERSON = rf"(?:{_INITIAL} ?)*+{_BEFORE}{{0,3}}{_PART}(?: (?!{_TITLES}\.? )(?:{_INITIAL} ?)*+{_BEFORE}{{0,3}}{_PART})*+"
_PIECE = rf"(?<![\p{{L}}\p{{M}}'\u2019\u2010\u2011-])(?:{_INITIAL}|{_PART})"
# Behind a keyword in any case, its closing quote, an assignment and an opening quote; the first
# two tests are the last one's ends, to leave most places soon. A value without a letter or
# digit has nothing to replace.
_ASSIGNED = (
    r"(?<=[ =:\"'])(?<=[=:] {0,2}[\"']?)"
    r"(?<=(?i:password|passwd|secret|token|api_key|apikey)[\"']? {0,2}[=:] {0,2}[\"']?)(?=[^\s\p{L}\p{N}]*[\p{L}\p{N}])"
)
# Kinds with their patterns; where two match at one place the earlier kind holds.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "access_key": r"(?<![A-Z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Z0-9])",
    "secret": _ASSIGNED + r"(?:(?<=\")[^\s\"]{8,}+(?=\")|(?<=')[^\s']{8,}+(?=')|[A-Za-z0-9_+/-][A-Za-z0-9_+/.=-]{6,}[A-Za-z0-9_+/=-])",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<!\d)\d{4}(?:\d{12}|(?:[ -]\d{4}){3})(?!\d)",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "person": _TITLE + _PERSON,
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# No pattern matches without one of these; names found go with a title.
HINT = r"[@\d]|[=:]|AKIA|ASIA|" + _TITLE + r"[\p{Lu}\p{Lt}\p{Lo}]"


def _kind(entity: Column) -> Column:
    """The kind of a whole match; a secret is known by what stands before it, hence last."""
    out = F.lit("secret")
    for kind, pattern in reversed(PATTERNS.items()):
        if kind != "secret":
            out = F.when(entity.rlike(rf"\A(?:{pattern})\z"), kind).otherwise(out)
    return out


def _canonical(kind: Column, entity: Column) -> Column:
    """What all ways to write an entity have in common."""
    return (
        F.when(kind == "email", F.lower(entity))
        .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(entity, r"\D", ""))
        .otherwise(entity)
    )


def _names(person: Column) -> Column:
    """A person's names without the title."""
    return F.regexp_replace(person, r"\A\P{L}*\p{L}+\.? ", "")


def _pieces(names: Column) -> Column:
    return F.regexp_extract_all(names, F.lit(_PIECE), F.lit(0))


def _person_parts(e: Column) -> Column:
    """``kind, real`` of a person's names: the last is the surname, those before are given names."""
    title = F.regexp_extract(e, r"\A(\p{L}+)", 1)
    given = F.when(title.isin(*MALE), "given_male").when(title.isin(*FEMALE), "given_female").otherwise("given")
    names = _pieces(_names(e))
    return F.transform(names, lambda n, i: F.struct(F.when(i == F.size(names) - 1, "surname").otherwise(given).alias("kind"), n.alias("real")))


def _known(text: Column) -> Column:
    """``kind, real`` of the names behind titles in a text, surnames first."""
    people = F.regexp_extract_all(text, F.lit(PATTERNS["person"]), F.lit(0))
    parts = F.array_distinct(F.flatten(F.transform(people, _person_parts)))
    # Of kinds that one name has the first holds: the surname, then the given name as it is first met.
    return F.concat(F.filter(parts, lambda p: p["kind"] == "surname"), F.filter(parts, lambda p: p["kind"] != "surname"))


def _any(known: Column) -> Column:
    """All patterns and mentions, as whole words, of known names but initials."""
    names = F.filter(F.transform(known, lambda p: p["real"]), lambda n: ~n.rlike(r"\A\p{Lu}\.?\z"))
    return F.concat(
        F.lit(ANY + r"|(?<![\p{L}\p{M}\p{N}])(?:"),
        F.array_join(F.concat(F.array_sort(F.array_distinct(names), lambda a, b: F.length(b) - F.length(a)), F.array(F.lit("(?!)"))), "|"), F.lit(")" + _END),
    )


def _parts(entities: Column, known: Column) -> Column:
    """``kind, real`` of what needs a surrogate; a person has a surname and perhaps given names."""
    def parts(e: Column) -> Column:
        kind = _kind(e)
        mention = F.filter(known, lambda p: p["real"] == e)
        alone = F.array(F.struct(kind.alias("kind"), _canonical(kind, e).alias("real")))
        return F.when(F.size(mention) > 0, F.slice(mention, 1, 1)).when(kind == "person", _person_parts(e)).otherwise(alone)

    return F.transform(entities, parts)


def _byte(digest: Column, i: Column) -> Column:
    return F.conv(F.substring(digest, F.pmod(i, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _shaped(real: Column, digest: Column, keep: Column) -> Column:
    """Characters behind the first ``keep``, drawn anew within their class."""
    hexadecimal = real.rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z")

    def drawn(c: Column, i: Column) -> Column:
        def pick(letters: str) -> Column:
            return F.substring(F.lit(letters), F.pmod(_byte(digest, i), F.lit(len(letters))) + 1, F.lit(1))

        lower = F.when(hexadecimal, pick("abcdef")).otherwise(pick("abcdefghijklmnopqrstuvwxyz"))
        upper = F.when(hexadecimal, pick("ABCDEF")).otherwise(pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        return (
            F.when(i < keep, c).when(c.rlike("[0-9]"), pick("0123456789"))
            .when(c.rlike(r"\p{Lu}"), upper).when(c.rlike(r"\p{L}"), lower).otherwise(c)
        )

    return F.array_join(F.transform(F.split(real, ""), drawn), "")


def _check_sum(digits: Column) -> Column:
    """The card numbers' sum, every second digit from the last but one doubled, modulo 10."""
    n = F.length(digits)
    doubled = F.transform(F.split(digits, ""), lambda d, i: F.when(
        F.pmod(n - i, F.lit(2)) == 0, F.floor(d.cast("int") * 2 / 10) + F.pmod(d.cast("int") * 2, F.lit(10))
    ).otherwise(d.cast("int")).cast("int"))
    return F.pmod(F.aggregate(doubled, F.lit(0), lambda a, d: a + d), F.lit(10))


def _name(real: Column, digest: Column, kind: Column, attempt: Column) -> Column:
    script = F.when(real.rlike(r"\p{IsCyrillic}"), "cyrillic").when(real.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")

    def in_script(name: str) -> Column:
        found = F.array(*map(F.lit, SYLLABLES[name]))
        male, female = map(F.lit, ENDINGS[name])
        # Every few attempts make a name longer, so there is always room for one more.
        several = F.transform(
            F.sequence(F.lit(0), F.lit(2) + F.floor(attempt / 3).cast("int")),
            lambda i: F.element_at(found, F.pmod(_byte(digest, i), F.lit(16)) + 1),
        )
        ending = F.when(kind == "given_male", male).when(kind == "given_female", female).otherwise(F.lit(""))
        return F.concat(F.array_join(several, ""), ending)

    return F.initcap(F.when(script == "cyrillic", in_script("cyrillic")).when(script == "greek", in_script("greek")).otherwise(in_script("latin")))


def _longer(shaped: Column, real: Column, digest: Column, attempt: Column, kind: Column) -> Column:
    """With more characters behind it every few attempts, so that a shape of few surrogates has always room for one more."""
    letters = (
        F.when(kind.isin("phone", "ssn", "card"), F.lit("0123456789"))
        .when(real.rlike(r"\A[0-9A-F]+\z"), F.lit("0123456789ABCDEF")).when(real.rlike(r"\A[0-9a-f]+\z"), F.lit("0123456789abcdef"))
        .otherwise(F.lit("0123456789abcdefghijklmnopqrstuvwxyz"))
    )
    more = F.transform(
        F.filter(F.sequence(F.lit(0), F.floor(attempt / 3).cast("int")), lambda i: i > 0),
        lambda i: F.substring(letters, F.pmod(_byte(digest, F.lit(64) - i), F.length(letters)) + 1, F.lit(1)),
    )
    return F.concat(shaped, F.array_join(more, ""))


def _surrogate(kind: Column, real: Column, attempt: Column, key: str) -> Column:
    seed = F.concat_ws("\u0000", F.lit(key), kind, real, attempt.cast("string"))
    digest = F.sha2(seed, 512)
    shaped = _shaped(real, digest, F.when(kind == "access_key", 4).when(kind == "phone", F.greatest(F.length(real) - 10, F.lit(0))).when(kind == "card", 1).otherwise(0))
    body = F.substring(shaped, F.lit(1), F.length(shaped) - 1)
    last = F.pmod(_check_sum(real) - _check_sum(F.concat(body, F.lit("0"))), F.lit(10))
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.pmod(_byte(digest, i), F.lit(254)) + 1).cast("string")), ".")
    before_top = F.regexp_extract(real, r"\A(.*)\.[^.]*\z", 1)
    domain = F.concat(
        _longer(_shaped(before_top, digest, F.lit(0)), F.lit("."), digest, attempt, kind), F.lit("."), F.substring_index(real, ".", -1)
    )
    return (
        F.when(kind == "email", domain).when(kind == "ip", octets)
        .when((kind == "card") & (attempt < 3), F.concat(body, last.cast("string")))
        .when(kind.isin("given", "given_male", "given_female", "surname"), _name(real, digest, kind, attempt))
        .otherwise(_longer(shaped, real, digest, attempt, kind))
    )


def _group(kind: Column) -> Column:
    """Kinds within which surrogates must differ; given names of any gender are one."""
    return F.when(kind.startswith("given"), F.lit("given")).otherwise(kind)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``kind, real, surrogate`` for distinct ``kind, real``; surrogates differ and are no real entity."""
    spark, path = entities.sparkSession, fresh_path(entities.sparkSession, "surrogates")
    real = entities.select(_group(F.col("kind")).alias("group"), F.col("real").alias("surrogate")).distinct()
    open_ = entities
    for attempt in count():
        tried = open_.select(
            "kind", "real", _surrogate(F.col("kind"), F.col("real"), F.lit(attempt), key).alias("surrogate")
        ).withColumn("group", _group(F.col("kind")))
        first = tried.groupBy("group", "surrogate").agg(F.min(F.struct("real", "kind")).alias("winner"))
        free = first.join(real, ["group", "surrogate"], "left_anti")
        if attempt:
            taken = spark.read.parquet(f"{path}/done").select(_group(F.col("kind")).alias("group"), "surrogate")
            free = free.join(taken, ["group", "surrogate"], "left_anti")
        # One table holds all rounds.
        free.select("winner.kind", "winner.real", "surrogate").write.parquet(f"{path}/done/attempt={attempt}")
        won = spark.read.parquet(f"{path}/done/attempt={attempt}")
        open_.join(won, ["kind", "real"], "left_anti").write.parquet(f"{path}/open/{attempt}")
        open_ = spark.read.parquet(f"{path}/open/{attempt}")
        if open_.isEmpty():
            return spark.read.parquet(f"{path}/done").select("kind", "real", "surrogate")


def _written(entity: Column, parts: Column) -> Column:
    """The surrogate in the shape in which the entity is written; ``parts`` holds ``kind, surrogate``."""
    kind, new = parts[0]["kind"], parts[0]["surrogate"]
    digits = F.array_join(F.transform(F.split(entity, ""), lambda c, i: F.when(
        c.rlike(r"\d"), F.substring(new, F.length(F.regexp_replace(F.substring(entity, F.lit(1), i), r"\D", "")) + 1, F.lit(1))
    ).otherwise(c)), "")
    # A longer surrogate has its other digits behind.
    digits = F.concat(digits, F.substring(new, F.length(F.regexp_replace(entity, r"\D", "")) + 1, F.length(new)))
    names = F.when(entity.rlike(rf"\A(?:{PATTERNS['person']})\z"), _names(entity)).otherwise(entity)
    title = F.substring(entity, F.lit(1), F.length(entity) - F.length(names))
    # What stands between the parts of a name stays.
    between = F.split(names, _PIECE, -1)
    person = F.concat(title, F.array_join(F.zip_with(F.slice(between, F.lit(1), F.size(parts)), F.transform(parts, lambda p: p["surrogate"]), lambda a, b: F.concat(a, b)), ""), F.element_at(between, -1))
    return (
        F.when(kind.isin("phone", "card", "ssn"), digits)
        .when(kind.startswith("given") | (kind == "surname"), person)
        .otherwise(new)
    )


def replace(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``row, text, entities``: each row of ``docs`` as a struct, its text with surrogates,
    and the ``kind`` and ``surrogate`` of its entities in order."""
    spark = docs.sparkSession
    text = F.col(text_col)
    none = F.array().cast("array<struct<kind:string,real:string>>")
    titled = F.when(text.rlike(_TITLE), _known(text)).otherwise(none)

    def extracted(frame: DataFrame) -> DataFrame:
        """``found`` beside the columns ``text, known``."""
        def of(pattern: Column) -> Column:
            return F.regexp_extract_all("text", pattern, F.lit(0))

        found = F.when(F.size("known") > 0, of(_any(F.col("known")))).when(F.col("text").rlike(HINT), of(F.lit(ANY)))
        return frame.withColumn("found", F.coalesce(found, F.array().cast("array<string>")))

    rows = extracted(docs.select(F.struct("*").alias("row"), text.alias("text"), titled.alias("known")))
    path = fresh_path(spark, "entities")
    # Entities depend on the text alone: one list for all rows of one text.
    (
        rows.select("text", "known", "found").filter(F.size("found") > 0)
        .select(F.md5("text").alias("name"), F.transform(F.arrays_zip("found", _parts(F.col("found"), F.col("known")).alias("parts")), lambda x: F.struct(x["found"].alias("entity"), x["parts"].alias("parts"))).alias("found"))
        .select("name", F.posexplode("found").alias("pos", "one"))
        .select("name", "pos", "one.entity", F.posexplode("one.parts").alias("at", "part"))
        .select("name", "pos", "entity", "at", "part.kind", "part.real").distinct().write.parquet(path)
    )
    parts = spark.read.parquet(path)
    surrogates = assign(parts.select("kind", "real").distinct(), key)
    # Stored, so that the rows of one text, however many, can be parted when they meet their list.
    path = fresh_path(spark, "lists")
    (
        parts.join(surrogates, ["kind", "real"])
        .groupBy("name", "pos", "entity").agg(F.sort_array(F.collect_list(F.struct("at", "kind", "surrogate"))).alias("parts"))
        .select("name", "pos", _written(F.col("entity"), F.col("parts")).alias("surrogate"), F.regexp_replace(F.col("parts")[0]["kind"], "^(given.*|surname)$", "person").alias("kind"))
        .groupBy("name").agg(F.sort_array(F.collect_list(F.struct("pos", "kind", "surrogate"))).alias("new"))
        .write.parquet(path)
    )
    lists = spark.read.parquet(path)
    plain = rows.filter(F.size("found") == 0).select(
        "row", "text", F.array().cast("array<struct<kind:string,surrogate:string>>").alias("entities")
    )
    between = F.when(F.size("known") > 0, F.split("text", _any(F.col("known")), F.lit(-1))).otherwise(F.split("text", ANY, -1))
    after = F.transform("new", lambda x: x["surrogate"])
    joined = F.concat(F.array_join(F.zip_with(F.slice(between, F.lit(1), F.size("new")), after, lambda a, b: F.concat(a, b)), ""), F.element_at(between, -1))
    changed = (
        rows.filter(F.size("found") > 0).withColumn("name", F.md5("text")).join(lists, "name")
        .select("row", joined.alias("text"), F.transform("new", lambda x: F.struct(x["kind"], x["surrogate"])).alias("entities"))
    )
    return plain.unionByName(changed)


def anonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in place of private data."""
    new = replace(docs, key, text_col)
    return new.select(*(
        F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns
    ))
