"""Surrogates for personal data: keyed, of the same kind, and as distinct as the originals.

DataFrame functions only. The entities found in all texts are brought to one form each (case and
punctuation aside), so that all mentions of one get the same surrogate. A surrogate is drawn from
SHA-2 of the key, the kind and the entity: digits become digits, letters letters of the same script
and case, everything else stays; names are built from syllables of their script with an ending of
their gender. Then the surrogates are checked against each other and against all entities of the
corpus: where two meet, all but one draw again, until none do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm.common import saved, unused

# Forms of address, by the gender they tell, and frequent given names.
ADDRESS = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Sir", "Herr", "Frau", "Monsieur", "Madame",
           "Mme", "Mlle", "Señor", "Señora", "Sr", "Sra", "Don", "Doña", "г-н", "г-жа", "господин", "госпожа")
GIVEN_F = ("Anna", "Maria", "Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan",
           "Jessica", "Sarah", "Karen", "Laura", "Julia", "Emma", "Olivia", "Sophie", "Claire", "Camille",
           "Ingrid", "Ursula", "Sabine", "Carmen", "Lucía", "Isabel", "Анна", "Мария", "Елена", "Ольга", "Наталья")
GIVEN_M = ("James", "John", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas",
           "Charles", "Daniel", "Matthew", "Peter", "Paul", "Hans", "Klaus", "Jürgen", "Stefan", "Pierre",
           "Jean", "Luc", "Carlos", "José", "Juan", "Miguel", "Иван", "Пётр", "Алексей", "Дмитрий", "Сергей")
# Syllables and endings that surrogate names are built from.
SYLLABLES = {"latin": "ba da fe ga ko la me ni po ra si to ve lu mi ro".split(),
             "cyrillic": "ба да ве га ко ла ме ни по ра си то зу лу ми ро".split()}
ENDINGS = {("latin", "f"): "na", ("latin", "m"): "nto", ("latin", ""): "rel",
           ("cyrillic", "f"): "на", ("cyrillic", "m"): "тон", ("cyrillic", ""): "рел"}

_NO_LETTER = r"(?<![\p{L}\p{N}])"
_NAME = r"\p{Lu}[\p{L}'’-]++"
_AFTER_ADDRESS = r"(?<=(?<!\p{L})(?:" + "|".join(ADDRESS) + r")\.? )"
_AFTER_TWO = r"(?<=(?<!\p{L})(?:" + "|".join(ADDRESS) + r")\.? \p{Lu}[\p{L}'’-]{0,30} )"
_GIVEN = r"(?<!\p{L})(?:" + "|".join(GIVEN_F + GIVEN_M) + r")(?= \p{Lu})"
_AFTER_GIVEN = r"(?<=(?<!\p{L})(?:" + "|".join(GIVEN_F + GIVEN_M) + r") )"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

#: Kind and pattern; where two begin at one place, the earlier wins.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.)+\p{L}{2,}",
    "secret": _NO_LETTER + r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}"
              r"|[0-9a-fA-F]*+(?<=[0-9a-fA-F]{32}))(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{N}.])" + _OCTET + r"(?:\." + _OCTET + r"){3}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}"
             r"|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)",
    "card": r"(?<![\p{N}])\d(?:[ -]?\d){12,18}(?!\d)",
    "name": r"(?=\p{Lu})(?:" + _AFTER_ADDRESS + _NAME + "|" + _AFTER_TWO + _NAME + "|" + _GIVEN + "|"
            + _AFTER_GIVEN + _NAME + ")",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Draws that keep the exact length; later ones may add to it, so that the checks always end.
EVEN_DRAWS = 6


def kind_of(found: Column) -> Column:
    """The kind of a mention, from its own form."""
    kind = F.when(found.contains("@"), "email").when(found.rlike(r"^[\d.]+$") & found.rlike(r"^\d+(\.\d+){3}$"), "ip")
    kind = kind.when(found.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
    kind = kind.when(found.rlike(r"^[+(]") | found.rlike(r"^\d{3}[.-]\d{3}[.-]\d{4}$"), "phone")
    kind = kind.when(found.rlike(r"^(?:AKIA|gh[pousr]_|sk-)") | found.rlike(r"^[0-9a-fA-F]{32,}$"), "secret")
    kind = kind.when(found.rlike(r"^\d(?:[ -]?\d){12,18}$"), "card")
    first = F.lower(F.lit("|" + "|".join(GIVEN_F) + "|")), F.lower(F.lit("|" + "|".join(GIVEN_M) + "|"))
    own = F.concat(F.lit("|"), F.lower(found), F.lit("|"))
    return kind.when(F.contains(first[0], own), "given_f").when(F.contains(first[1], own), "given_m").otherwise("surname")


def entity_of(kind: Column, found: Column) -> Column:
    """The one form of all mentions: digits of numbers, lower case of words; tokens as they are."""
    return F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(found, r"\D", "")).when(
        kind == "secret", found).otherwise(F.lower(found))


def _stream(key: str, kind: Column, entity: Column, draw: Column) -> Column:
    """Two hex digits for each character of the entity and some more."""
    parts = F.transform(F.sequence(F.lit(0), (F.length(entity) / 48).cast("int") + 1), lambda i: F.sha2(
        F.concat_ws("\x1f", F.lit(key), kind, draw.cast("string"), i.cast("string"), entity).cast("binary"), 512))
    return F.array_join(parts, "")


def _number(stream: Column, at: Column) -> Column:
    return F.conv(F.substr(stream, at * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _from(letters: str, n: Column) -> Column:
    return F.substr(F.lit(letters), n % len(letters) + 1, F.lit(1))


_LATIN, _CYRILLIC, _GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшщэюя", "αβγδεζηθικλμνξοπρστυφχψω"


def _like(c: Column, n: Column) -> Column:
    """A character of the same class: digit, or letter of the script and case."""
    small = F.when(c.rlike(r"^\p{IsCyrillic}$"), _from(_CYRILLIC, n)).when(
        c.rlike(r"^\p{IsGreek}$"), _from(_GREEK, n)).otherwise(_from(_LATIN, n))
    return F.when(c.rlike(r"^\d$"), (n % 10).cast("string")).when(
        c.rlike(r"^\p{Lu}$"), F.upper(small)).when(c.rlike(r"^\p{L}$"), small).otherwise(c)


def _characters(text: Column) -> Column:
    return F.split(text, "(?!^)(?!$)")


def _shape(entity: Column, stream: Column) -> Column:
    return F.array_join(F.transform(_characters(entity), lambda c, i: _like(c, _number(stream, i))), "")


def _drawn_digits(entity: Column, stream: Column, kept: Column) -> Column:
    """Digits with the first ``kept`` as they are."""
    return F.array_join(F.transform(_characters(entity), lambda c, i: F.when(i < kept, c).otherwise(
        (_number(stream, i) % 10).cast("string"))), "")


def luhn_sum(digits: Column) -> Column:
    n = F.length(digits)
    double = lambda d: F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
    return F.aggregate(
        F.transform(_characters(digits), lambda c, i: F.when(
            (n - i) % 2 == 0, double(c.cast("int"))).otherwise(c.cast("int"))),
        F.lit(0), lambda a, x: a + x)


def _card(entity: Column, stream: Column) -> Column:
    """The first digit stays; the check digit is right where it was right before."""
    body = F.substr(_drawn_digits(entity, stream, F.lit(1)), F.lit(1), F.length(entity) - 1)
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    wrong = (check + 1 + _number(stream, F.length(entity)) % 9) % 10
    return F.concat(body, F.when(luhn_sum(entity) % 10 == 0, check).otherwise(wrong).cast("string"))


def _ip(entity: Column, stream: Column, draw: Column) -> Column:
    """Octets of the same number of digits, any octets in later draws."""
    octet = lambda o, i: F.when(draw >= EVEN_DRAWS, _number(stream, i)).when(F.length(o) == 3, 100 + _number(stream, i) % 156).when(
        F.length(o) == 2, 10 + _number(stream, i) % 90).otherwise(_number(stream, i) % 10).cast("string")
    return F.array_join(F.transform(F.split(entity, r"\."), octet), ".")


def _secret(entity: Column, stream: Column) -> Column:
    """Hex stays hex in its case; known prefixes stay."""
    prefix = F.regexp_extract(entity, r"^(AKIA|gh[pousr]_|sk-)", 1)
    hexed = F.array_join(F.transform(_characters(entity), lambda c, i: F.when(
        c.rlike("^[A-F]$"), F.upper(_from("abcdef", _number(stream, i)))).when(
        c.rlike("^[a-f]$"), _from("abcdef", _number(stream, i))).otherwise((_number(stream, i) % 10).cast("string"))), "")
    rest = F.substr(entity, F.length(prefix) + 1)
    return F.when(prefix != "", F.concat(prefix, _shape(rest, stream))).otherwise(hexed)


def _email(entity: Column, stream: Column) -> Column:
    """Shape of the local part and the host; the top-level domain stays."""
    top = F.regexp_extract(entity, r"(\.[^.@]+)$", 1)
    return F.concat(_shape(F.substr(entity, F.lit(1), F.length(entity) - F.length(top)), stream), top)


def _name(kind: Column, entity: Column, stream: Column, draw: Column) -> Column:
    """Syllables of the script, more of them in later draws, and an ending for the gender."""
    script = F.when(entity.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    gender = F.when((kind == "given_f") | ((script == "cyrillic") & entity.rlike("[ая]$")), "f").when(
        (kind == "given_m") | (script == "cyrillic"), "m").otherwise("")

    def build(name: str) -> Column:
        syllables = F.array(*[F.lit(s) for s in SYLLABLES[name]])
        stem = F.array_join(F.transform(F.sequence(F.lit(0), 2 + draw), lambda i: F.element_at(
            syllables, _number(stream, i) % len(SYLLABLES[name]) + 1)), "")
        ending = reduce(lambda e, g: e.when(gender == g, ENDINGS[name, g]), ("f", "m"), F.when(
            gender == "", ENDINGS[name, ""]))
        return F.concat(stem, ending)

    return F.when(script == "cyrillic", build("cyrillic")).otherwise(build("latin"))


def _drawn(key: str, entities: DataFrame) -> DataFrame:
    """``kind, entity, draw`` with the ``surrogate`` of this draw."""
    kind, entity, draw = F.col("kind"), F.col("entity"), F.col("draw")
    stream = F.col("stream")
    number = F.when(kind == "phone", _drawn_digits(entity, stream, F.lit(1))).otherwise(
        _drawn_digits(entity, stream, F.lit(0)))
    own = F.when(kind == "email", _email(entity, stream)).when(kind == "ip", _ip(entity, stream, draw)).when(
        kind == "card", _card(entity, stream)).when(kind == "secret", _secret(entity, stream)).when(
        kind.isin("phone", "ssn"), number).otherwise(_name(kind, entity, stream, draw))
    more = F.when((draw >= EVEN_DRAWS) & ~kind.isin("given_f", "given_m", "surname", "ip"), F.substr(
        F.regexp_replace(stream, r"\D", "7"), F.lit(1), draw - EVEN_DRAWS + 1)).otherwise("")
    grown = F.when(kind == "email", F.concat(more, own)).otherwise(F.concat(own, more))
    return entities.withColumn("stream", _stream(key, kind, entity, draw)).select(
        "kind", "entity", "draw", grown.alias("surrogate"))


def _clash_free(spark: SparkSession, entities: DataFrame, key: str) -> DataFrame:
    """``kind, entity, surrogate``: all surrogates of a kind differ, and none is an entity."""
    entities = saved(spark, entities, "pii-entities")
    done = spark.createDataFrame([], "kind string, entity string, draw int, surrogate string")
    open_ = entities.withColumn("draw", F.lit(0))
    while True:
        drawn = saved(spark, _drawn(key, open_), "pii-drawn")
        real = entities.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
        taken = done.select("kind", "surrogate", F.lit(True).alias("taken"))
        # The first of those that drew the same keeps it: one minimum a surrogate, no group gathered.
        first = drawn.groupBy("kind", "surrogate").agg(F.min("entity").alias("first"))
        judged = saved(
            spark,
            drawn.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left").join(
                taken, ["kind", "surrogate"], "left").withColumn(
                "keeps", (F.col("entity") == F.col("first")) & F.col("real").isNull() & F.col("taken").isNull()),
            "pii-judged",
        )
        kept = judged.where("keeps").select("kind", "entity", "draw", "surrogate")
        done = saved(spark, done.union(kept), "pii-done")
        if judged.where("not keeps").isEmpty():
            return done.select("kind", "entity", "surrogate")
        open_ = judged.where("not keeps").select("kind", "entity", (F.col("draw") + 1).alias("draw"))


def _formatted(kind: Column, found: Column, surrogate: Column) -> Column:
    """The surrogate in the form of this mention: its punctuation, or its case."""
    digits = F.array_join(F.transform(_characters(found), lambda c, i: F.when(c.rlike(r"^\d$"), F.substr(
        surrogate, F.length(F.regexp_replace(F.substr(found, F.lit(1), i + 1), r"\D", "")), F.lit(1))).otherwise(c)), "")
    longer = F.substr(surrogate, F.length(F.regexp_replace(found, r"\D", "")) + 1)
    upper = (found == F.upper(found)) & (F.length(found) > 1) & found.rlike(r"\p{L}")
    names = F.when(upper, F.upper(surrogate)).otherwise(
        F.concat(F.upper(F.substr(surrogate, F.lit(1), F.lit(1))), F.substr(surrogate, F.lit(2))))
    mails = F.when(upper, F.upper(surrogate)).otherwise(surrogate)
    return F.when(kind.isin("phone", "card", "ssn"), F.concat(digits, longer)).when(
        kind.isin("given_f", "given_m", "surname"), names).when(kind == "email", mails).otherwise(surrogate)


def replace_entities(spark: SparkSession, docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text`` and ``n_entities`` added; all other columns pass.

    Null and empty texts stay as they are. Rows without any entity pass by all joins. Repeated rows
    give repeated results; an empty table gives an empty one. The same key gives the same
    surrogates for the same corpus.
    """
    columns = [c for c in docs.columns if c != "n_entities"]
    with_any = F.coalesce(F.col("text"), F.lit("")).rlike(ANY)
    row = F.xxhash64(F.col("doc_id").cast("long"), "text")
    named, of, own_puts = unused(docs, "_row", "_of", "_puts")
    hit = saved(spark, docs.where(with_any).select(*[F.col(f"`{c}`") for c in columns], row.alias(named)), "pii-rows")
    places = hit.dropDuplicates([named]).select(
        F.col(named).alias("_row"), F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("_at", "_found"))
    kinds = places.withColumn("kind", kind_of(F.col("_found")))
    mentions = saved(spark, kinds.withColumn("entity", entity_of(F.col("kind"), F.col("_found"))), "pii-mentions")
    surrogates = saved(
        spark, _clash_free(spark, mentions.select("kind", "entity").distinct(), key), "pii-surrogates")
    put = mentions.join(surrogates, ["kind", "entity"]).select(
        "_row", "_at", _formatted(F.col("kind"), F.col("_found"), F.col("surrogate")).alias("_put"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("_at", "_put"))), lambda x: x["_put"])
    puts = put.groupBy("_row").agg(in_order).toDF(of, own_puts)
    between = F.split("text", ANY, -1)
    text = F.array_join(F.flatten(F.zip_with(
        between, F.concat(own_puts, F.array(F.lit(""))), lambda gap, new: F.array(gap, new))), "")
    changed = hit.join(puts, F.col(named) == F.col(of)).withColumn("text", text).withColumn(
        "n_entities", F.size(own_puts).cast("long"))
    plain = docs.where(~with_any).withColumn("n_entities", F.lit(0).cast("long"))
    return plain.select(*[F.col(f"`{c}`") for c in columns], "n_entities").unionByName(
        changed.select(*[F.col(f"`{c}`") for c in columns], "n_entities"))
