"""Replacement of personal data and secrets by surrogates, in DataFrame functions only.

Entities are found by one pattern. Mentions that differ only in case or punctuation are one entity, and an entity
has one surrogate wherever it occurs. A surrogate is made from a keyed hash of the entity and has its type and
format: letters stand for letters of the same script and case, digits for digits, addresses stay addresses, card
numbers keep a valid check digit, and names keep gender and script. Surrogates are checked against each other and
against all entities of the data; those that collide are made again from the next hash.

Surnames and given names are entities of their own, so a person is the same one with and without the given name. A
person whom a text names with a title is also found in that text without it, by the full name or the surname.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

# What entities look like (Java patterns), in the order in which they are tried.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]{1,64}@(?:[\p{L}\p{N}](?:[\p{L}\p{N}\-]{0,62})\.){1,8}[\p{L}]{2,24}(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "access_key": r"(?<![\p{L}\p{N}])A[KS]IA[A-Z0-9]{16}(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])(?i:password|passwd|pwd|token|secret|api[_\-]?key)\s{0,4}[=:]\s{0,4}[\"']?[A-Za-z0-9+/_\-]{8,128}(?![A-Za-z0-9+/_\-])",
    "ipv4": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)",
    "card": r"(?<![\p{L}\p{N}.\-])\d{4}[ \-]?\d{4}[ \-]?\d{4}[ \-]?\d{1,7}(?![\p{L}\p{N}]|[.\-]\d)",
    "ssn": r"(?<![\p{L}\p{N}.\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|[.\-]\d)",
    "phone": r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{1,4}(?:[ .\-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?![\p{L}\p{N}]|[.\-]\d)",
    "name": r"(?<![\p{L}\p{N}])(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Господин|Госпожа|Κύριος|Κυρία)\.?[  ]\p{Lu}[\p{L}'\-]{1,30}(?:[  ]\p{Lu}[\p{L}'\-]{1,30}){0,2}",
}
#: Every match of a pattern holds one of these.
HINT = r"[0-9@]|A[KS]IA|(?i:password|passwd|pwd|token|secret|api[_\-]?key)|(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Господин|Госпожа|Κύριος|Κυρία)\.?[  ]"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# The titles that stand before names, and those of women.
TITLE = r"^(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Господин|Госпожа|Κύριος|Κυρία)\.?[  ]"
FEMALE = r"^(?:Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа|Κυρία)\b"
# The letters that stand for letters of each script and case.
ALPHABETS = {
    r"[0-9]": "0123456789",
    r"[a-z]": "abcdefghijklmnopqrstuvwxyz",
    r"[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    r"[\p{IsLatin}&&\p{Ll}]": "áàâäãåçéèêëíìîïñóòôöõúùûü",
    r"[\p{IsLatin}&&\p{Lu}]": "ÁÀÂÄÃÅÇÉÈÊËÍÌÎÏÑÓÒÔÖÕÚÙÛÜ",
    r"[\p{IsCyrillic}&&\p{Ll}]": "абвгдежзийклмнопрстуфхцчшщыэюя",
    r"[\p{IsCyrillic}&&\p{Lu}]": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ",
    r"[\p{IsGreek}&&\p{Ll}]": "αβγδεζηθικλμνξοπρστυφχψω",
    r"[\p{IsGreek}&&\p{Lu}]": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    r"\p{IsHan}": "天地人山水火木金土日月星雨雪風花草鳥魚石田川海空",
    r"\p{IsHiragana}": "あいうえおかきくけこさしすせそたちつてと",
    r"\p{IsKatakana}": "アイウエオカキクケコサシスセソタチツテト",
    r"\p{IsHangul}": "가나다라마바사아자차카타파하거너더러머버",
    r"\p{IsArabic}": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת",
    r"\p{IsDevanagari}": "कखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह",
    r"\p{IsThai}": "กขคงจฉชซญดตถทธนบปผพฟมยรลวสหอ",
    # Letters of any other script, and its digits.
    r"\p{L}": "abcdefghijklmnopqrstuvwxyz",
    r"\p{N}": "0123456789",
}
# Given names by script and gender.
GIVEN = {
    ("latin", "female"): "Alma Berta Clara Dora Edith Flora Greta Hanna Irma Julia Karla Laura Marta Nora Olga Paula Rita Sara Thea Vera".split(),
    ("latin", "male"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo Max Nils Oskar Paul Rolf Simon Tom Viktor".split(),
    ("cyrillic", "female"): "Анна Вера Дарья Елена Ирина Лидия Мария Нина Ольга Софья".split(),
    ("cyrillic", "male"): "Антон Борис Виктор Денис Егор Иван Лев Максим Олег Павел".split(),
    ("greek", "female"): "Άννα Δήμητρα Ελένη Ζωή Ηλέκτρα Ιωάννα Κάλλια Μαρία Νίκη Σοφία".split(),
    ("greek", "male"): "Άρης Γιώργος Δημήτρης Ηλίας Κώστας Λέων Μάρκος Νίκος Πέτρος Στέφανος".split(),
}
#: Surrogates of an entity that are tried in its own form, and then with a growing suffix. Given names become single
#: names of the lists at first, and then double ones.
ATTEMPTS, LONGER, SINGLE = 40, 16, 8


def _kind(mention: Column) -> Column:
    tries = [(F.when(mention.rlike(f"^(?:{p})$"), F.lit(k))) for k, p in PATTERNS.items()]
    return F.coalesce(*tries)


def _luhn(digits: Column) -> Column:
    """The sum of the Luhn test over a text of digits; a multiple of 10 if it is valid."""
    doubled = lambda d: F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _norm(kind: Column, mention: Column) -> Column:
    """What mentions of one entity have in common."""
    return (
        F.when(kind.isin("card", "ssn", "phone"), F.regexp_replace(mention, r"[^0-9]", ""))
        .when(kind == "iban", F.regexp_replace(mention, " ", "")).when(kind == "email", F.lower(mention))
        .when(kind == "secret", F.regexp_extract(mention, r"[=:]\s*[\"']?(.*)$", 1))
        .when(kind == "name", F.regexp_replace(mention, r"[  ]+", " ")).otherwise(mention)
    )


def _byte(digest: Column, i: Column) -> Column:
    """The i-th number from 0 to 65535 of a hex digest, which is read in a circle."""
    return F.conv(F.substring(digest, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int") + F.floor(i / 32).cast("int") * 7


def _shape(value: Column, digest: Column) -> Column:
    """Each letter and digit replaced by one of its alphabet; everything else stays."""

    def one(c: Column, i: Column) -> Column:
        n = _byte(digest, i)
        pick = lambda letters: F.substring(F.lit(letters), n % len(letters) + 1, F.lit(1))
        return reduce(lambda out, item: out.when(c.rlike(f"^{item[0]}$"), pick(item[1])), list(ALPHABETS.items())[1:], F.when(c.rlike("^[0-9]$"), pick("0123456789"))).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _hexlike(value: Column, digest: Column) -> Column:
    """As ``_shape`` for a value of hex digits, which stays one."""
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.substring(F.lit("0123456789abcdef"), _byte(digest, i) % 16 + 1, F.lit(1))), "")


def _given(norm: Column, shaped: Column, digest: Column, attempt: int) -> Column:
    """A name of the same gender and script, where there is a list of such; ``norm`` is gender:name."""
    name = F.substring_index(norm, ":", -1)
    own = F.substring(shaped, F.length(norm) - F.length(name) + 1, F.length(name))
    scripts = {"latin": r"^\p{IsLatin}", "cyrillic": r"^\p{IsCyrillic}", "greek": r"^\p{IsGreek}"}

    def pick(names: list[str]) -> Column:
        one = lambda at: F.element_at(F.array(*map(F.lit, names)), _byte(digest, F.lit(at)) % len(names) + 1)
        return one(30) if attempt < SINGLE else F.concat(one(30), F.lit("-"), one(29))

    return F.coalesce(*[F.when(name.rlike(scripts[script]) & F.startswith(norm, F.lit(gender)), pick(names)) for (script, gender), names in GIVEN.items()], own)


def _surrogate(kind: Column, norm: Column, digest: Column, attempt: int = 0) -> Column:
    shaped = _shape(norm, digest)
    body = F.concat(F.substring(norm, 1, 1), F.expr("substring(_shaped, 2, length(_norm) - 2)"))
    card = F.concat(body, F.pmod(10 - _luhn(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string"))
    octet = lambda i: (_byte(digest, F.lit(i)) % 254 + 1).cast("string")
    local = F.substring_index("_shaped", "@", 1)
    domain = F.concat(F.expr("substring_index(substring_index(_shaped, '@', -1), '.', size(split(substring_index(_norm, '@', -1), '[.]')) - 1)"), F.lit("."), F.substring_index(norm, ".", -1))
    keep = F.when(kind == "access_key", 4).when(kind == "iban", 2).otherwise(0)
    return (
        F.when(kind == "card", card).when(kind == "ipv4", F.concat_ws(".", *[octet(i) for i in range(4)]))
        .when(kind == "email", F.concat(local, F.lit("@"), domain)).when(kind == "given", _given(norm, F.col("_shaped"), digest, attempt))
        .when((kind == "secret") & norm.rlike("^[0-9a-f]+$"), _hexlike(norm, digest))
        .when(kind == "phone", F.concat(F.substring(norm, 1, 1), F.expr("substring(_shaped, 2)")))
        .otherwise(F.concat(F.expr("substring(_norm, 1, _keep)"), F.expr("substring(_shaped, _keep + 1)")))
    ), keep, shaped


def _lengthened(kind: Column, surrogate: Column, more: Column) -> Column:
    """A surrogate with a part of a hex digest behind it, or behind the local part of an address."""
    digits, letters = F.translate(more, "abcdef", "012345"), F.translate(more, "0123456789abcdef", "abcdefghijklmnop")
    email = F.concat(F.substring_index(surrogate, "@", 1), digits, F.lit("@"), F.substring_index(surrogate, "@", -1))
    return F.when(kind == "email", email).when(kind.isin("name", "given"), F.concat(surrogate, letters)).otherwise(F.concat(surrogate, digits))


def assign(entities: DataFrame, secret: str) -> DataFrame:
    """(kind, norm, surrogate) for distinct entities (kind, norm), all surrogates different and none an entity.

    Candidates come from SHA-512 of key, type, entity and number of the attempt. Of entities with one candidate the
    smallest gets it, unless it is taken or is an entity itself; the others try again. After ``ATTEMPTS`` rounds
    candidates are lengthened, 8 characters more in each round, so that a crowded type runs out of none.
    """
    pending = common.store(entities.select("kind", "norm"), "pii-entities")
    taken = pending.select(F.when(F.col("kind") == "given", F.substring_index("norm", ":", -1)).otherwise(F.col("norm")).alias("surrogate"))
    done: list[DataFrame] = []
    for attempt in range(ATTEMPTS + LONGER):
        digest = F.sha2(F.concat_ws("\x1f", F.lit(secret), "kind", "norm", F.lit(str(attempt))).cast("binary"), 512)
        rows = pending.withColumn("_digest", digest).withColumn("_norm", F.col("norm"))
        _, keep, shaped = _surrogate(F.col("kind"), F.col("norm"), F.col("_digest"))
        rows = rows.withColumn("_keep", keep).withColumn("_shaped", shaped)
        rows = rows.withColumn("surrogate", _surrogate(F.col("kind"), F.col("norm"), F.col("_digest"), attempt)[0])
        if attempt >= ATTEMPTS:
            rows = rows.withColumn("surrogate", _lengthened(F.col("kind"), F.col("surrogate"), F.substring("_digest", 1, 8 * (attempt - ATTEMPTS + 1))))
        rows = rows.select("kind", "norm", "surrogate")
        free = rows.join(taken.distinct(), "surrogate", "left_anti")
        first = Window.partitionBy("surrogate").orderBy("kind", "norm")
        won = common.store(free.withColumn("_n", F.row_number().over(first)).filter("_n = 1").select("kind", "norm", "surrogate"), "pii-won")
        done.append(won)
        pending = common.store(pending.join(won, ["kind", "norm"], "left_anti"), "pii-pending")
        if pending.isEmpty():
            return reduce(DataFrame.unionByName, done)
        taken = taken.unionByName(won.select("surrogate"))
    raise ValueError("surrogates with 128 more characters of a digest are not free: the digests do not differ")


def _formatted(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the format of one mention: its separators, its case and its label."""
    plain = F.regexp_replace(mention, r"[^0-9A-Z]", "")
    spaced = F.aggregate(
        F.split(mention, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("n")),
        lambda a, c: F.when(c.rlike("^[0-9A-Z]$"), F.struct(F.concat(a["out"], F.substring(surrogate, a["n"] + 1, F.lit(1))).alias("out"), (a["n"] + 1).alias("n")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["n"].alias("n"))),
        lambda a: a["out"],
    )
    cased = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c != F.lower(c), F.upper(F.substring(surrogate, i + 1, F.lit(1)))).otherwise(F.substring(surrogate, i + 1, F.lit(1)))), "")
    label = F.regexp_extract(mention, r"^[^=:]*[=:]\s*[\"']?", 0)
    return (
        F.when(kind.isin("card", "ssn", "phone", "iban") & (F.length(plain) == F.length(surrogate)), spaced)
        .when((kind == "email") & (mention != F.lower(mention)) & (F.length(mention) == F.length(surrogate)), cased)
        .when(kind == "secret", F.concat(label, surrogate)).otherwise(surrogate)
    )


def _persons(found: Column) -> Column:
    """array<struct(full, surname, gender)> of the mentions with a title."""
    named = F.filter(found, lambda m: m.rlike(f"^{PATTERNS['name']}$"))
    name = lambda m: F.regexp_replace(F.regexp_replace(m, TITLE, ""), r"[  ]+", " ")
    return F.transform(named, lambda m: F.struct(name(m).alias("full"), F.substring_index(name(m), " ", -1).alias("surname"), F.when(m.rlike(FEMALE), "female").otherwise("male").alias("gender")))


def _pattern(persons: Column) -> Column:
    """The pattern of entities and, for texts with persons, of their names without a title, longest first."""
    names = F.array_distinct(F.concat(F.transform(persons, lambda p: p["full"]), F.transform(persons, lambda p: p["surname"])))
    longest = F.transform(F.array_sort(F.transform(names, lambda n: F.struct((-F.length(n)).alias("o"), n.alias("n")))), lambda x: F.concat(F.lit("\\Q"), x["n"], F.lit("\\E")))
    bare = F.concat(F.lit(f"{ANY}|(?<![\\p{{L}}\\p{{N}}])(?:"), F.array_join(longest, "|"), F.lit(")(?![\\p{L}\\p{N}])"))
    return F.when(F.size(persons) > 0, bare).otherwise(F.lit(ANY))


def _parts(kind: Column, mention: Column, persons: Column) -> Column:
    """array<struct(kind, norm)>: the entities of a mention; of a name the given names, and then the surname."""
    name = F.regexp_replace(mention, TITLE, "")
    words = F.split(name, r"[  ]+")
    full = F.array_join(words, " ")
    known = F.get(F.filter(persons, lambda p: p["full"] == full), F.lit(0))["gender"]
    gender = F.when(mention.rlike(TITLE), F.when(mention.rlike(FEMALE), "female").otherwise("male")).otherwise(F.coalesce(known, F.lit("male")))
    given = F.transform(F.slice(words, F.lit(1), F.size(words) - 1), lambda w: F.struct(F.lit("given").alias("kind"), F.concat(gender, F.lit(":"), w).alias("norm")))
    surname = F.struct(F.lit("name").alias("kind"), F.element_at(words, -1).alias("norm"))
    return F.when(kind == "name", F.concat(given, F.array(surname))).otherwise(F.array(F.struct(kind.alias("kind"), _norm(kind, mention).alias("norm"))))


def replace_entities(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """``docs`` with every entity in ``text`` replaced, and with ``pii_kinds``, the types replaced in order.

    All other columns and rows stay, whatever their names; a column ``pii_kinds`` is replaced. Texts are searched
    whole. Null and empty texts, and texts without entities, stay as they are, with an empty list; an empty table
    gives an empty result. Rows that repeat are replaced alike. Texts that may hold an entity are told by a cheap
    hint; only their mentions are shuffled. Mentions of one entity that are very many meet a join side with one row,
    which is broadcast after it was counted, or else left to skew-join splitting.
    """
    plain = docs.drop("pii_kinds")
    names = [F.col(f"`{c}`") for c in plain.columns]
    none = F.array().cast("array<string>")
    may = F.coalesce(F.col(f"`{text}`").rlike(HINT), F.lit(False))
    marked = plain.filter(may).select(F.struct(*names).alias("row"), F.col(f"`{text}`").alias("text"))
    marked = marked.select("row", "text", F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("found"))
    held = marked.filter(F.size("found") > 0).select("row", "text", "found", _persons(F.col("found")).alias("persons"))
    held = held.select("row", "text", "found", "persons", _pattern(F.col("persons")).alias("pattern"))
    again = F.when(F.size("persons") > 0, F.regexp_extract_all("text", F.col("pattern"), F.lit(0))).otherwise(F.col("found"))
    found = common.store(held.select("row", "persons", "pattern", again.alias("found"), F.monotonically_increasing_id().alias("uid")), "pii-found")
    mentions = found.select("uid", "persons", F.posexplode("found").alias("pos", "mention"))
    mentions = mentions.withColumn("type", F.coalesce(_kind(F.col("mention")), F.lit("name")))
    mentions = mentions.select("uid", "pos", "mention", "type", F.posexplode(_parts(F.col("type"), F.col("mention"), F.col("persons"))).alias("i", "part"))
    mentions = common.store(mentions.select("uid", "pos", "mention", "type", "i", "part.kind", "part.norm"), "pii-mentions")
    chosen = common.store(assign(mentions.select("kind", "norm").distinct(), secret), "pii-surrogates")
    if chosen.count() <= common.BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    met = mentions.join(chosen, ["kind", "norm"]).repartition("uid")
    whole = met.groupBy("uid", "pos").agg(F.first("type").alias("type"), F.first("mention").alias("mention"), F.array_sort(F.collect_list(F.struct("i", "surrogate"))).alias("s"))
    named = F.concat(F.regexp_extract("mention", TITLE, 0), F.array_join(F.transform("s", lambda x: x["surrogate"]), " "))
    new = F.when(F.col("type") == "name", named).otherwise(_formatted(F.col("type"), F.col("mention"), F.get("s", F.lit(0))["surrogate"]))
    made = whole.select("uid", "pos", "type", new.alias("new")).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("pos", "new", "type"))).alias("made"))
    rebuilt = found.join(made, "uid").withColumn("kept", F.split(F.col(f"row.`{text}`"), F.col("pattern"), -1))
    joined = F.array_join(F.flatten(F.zip_with("kept", "made", lambda a, b: F.array(a, F.coalesce(b["new"], F.lit(""))))), "")
    out = rebuilt.select(*[joined.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in plain.columns], F.col("made.type").alias("pii_kinds"))
    still = plain.filter(~may).select(*names, none.alias("pii_kinds"))
    empty = marked.filter(F.size("found") == 0).select(*[F.col(f"row.`{c}`").alias(c) for c in plain.columns], none.alias("pii_kinds"))
    return still.unionByName(empty).unionByName(out)
