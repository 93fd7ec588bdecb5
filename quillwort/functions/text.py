"""Text normalisation and description policies, as built-in column functions."""

from __future__ import annotations

import html
import html.entities
import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"(?U)\s+"


@lru_cache(1)
def _folding() -> tuple[str, str, dict[str, str]]:
    """From the Unicode tables: characters that fold to one character, then those that vanish; and those that expand."""
    one, gone, longer = [], [], {}
    for i in range(0xA0, 0x20000):
        c = chr(i)
        if 0xD800 <= i < 0xE000:
            continue
        base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if base == c:
            continue
        if not base:
            gone.append(c)
        elif len(base) == 1:
            one.append((c, base))
        elif not "가" <= c <= "힣":  # Korean syllables fall apart into letters that no later step keeps
            longer[c] = base
    return "".join(c for c, _ in one) + "".join(gone), "".join(b for _, b in one), longer


def _looked_up(entries: dict[str, str]) -> Column:
    """A map of constants, which is built once."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


@lru_cache(1)
def _expanding() -> str:
    """A pattern of one character that expands to several, as ranges."""
    points, ranges = sorted(map(ord, _folding()[2])), []
    for x in points:
        if ranges and ranges[-1][1] == x - 1:
            ranges[-1][1] = x
        else:
            ranges.append([x, x])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


def fold_accents(text: Column) -> Column:
    """Compatibility forms without combining marks. Texts without characters that expand to several skip that step."""
    source, target, longer = _folding()
    known = _looked_up(longer)
    expanded = F.array_join(F.transform(F.split(text, ""), lambda c: F.when(c.rlike(_expanding()), F.element_at(known, c)).otherwise(c)), "")
    wide = (F.octet_length(text) > F.length(text)) & text.rlike(_expanding())
    return F.translate(F.when(wide, expanded).otherwise(text), source, target)


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.transform(F.array(value), f)[0]


def squeeze(text: Column) -> Column:
    """White space of any kind as single blanks, none at the ends; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))


def _kept(text: Column, keep: str) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), f"[^{keep}]+", " "), " +", " "))


def normalize(text: Column) -> Column:
    """Lower-case letters a-z, digits and single blanks, without accents; null is empty."""
    return _kept(fold_accents(F.coalesce(text, F.lit(""))), "a-z0-9 ")


def normalize_tech(text: Column) -> Column:
    """As ``normalize``, with # and + kept, which names of languages have."""
    return _kept(fold_accents(F.coalesce(text, F.lit(""))), "a-z0-9#+ ")


def normalize_level(text: Column) -> Column:
    """As ``normalize``, with points kept, and with the language PL/I as one word."""
    return _kept(F.regexp_replace(fold_accents(F.coalesce(text, F.lit(""))), r"(?i)\bpl\s*/\s*i\b", "pli"), "a-z0-9. ")


#: References: by number, in either base, or by name; the end mark may be missing where pages of old left it out.
_LEGACY = "|".join(sorted((re.escape(n) for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True))
_REFERENCE = rf"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{{1,31}};|(?:{_LEGACY}))"
# What numbers from 128 to 159 stand for, as pages written on another system's character set have them.
_WINDOWS = {i: html.unescape(f"&#{i};") for i in range(0x80, 0xA0)}


def decode_references(text: Column) -> Column:
    """Text with every character reference of HTML decoded, as browsers do."""
    named = _looked_up({n: v for n, v in html.entities.html5.items()})
    windows = _looked_up({str(i): v for i, v in _WINDOWS.items()})

    def decoded(ref: Column) -> Column:
        body = F.regexp_replace(F.substring(ref, F.lit(2), F.length(ref)), ";$", "")
        digits = F.regexp_replace(body, "^#[xX]?", "")
        wide = F.length(F.regexp_replace(digits, "^0+", "")) > 8
        number = F.when(wide, F.lit(0x110000)).otherwise(F.when(body.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("long"))
        bad = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
        none = number.between(1, 8) | number.between(0x0E, 0x1F) | number.between(0xFDD0, 0xFDEF) | (number == 0x0B) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        character = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        by_number = F.when(bad, "\ufffd").when(number.between(0x80, 0x9F), F.element_at(windows, number.cast("string"))).when(none, "").otherwise(character)
        name = F.substring(ref, F.lit(2), F.length(ref))
        # A name that is unknown as a whole may begin with one that needs no end mark.
        old = F.regexp_extract(name, f"^(?:{_LEGACY})", 0)
        begun = F.when(old != "", F.concat(F.element_at(named, old), F.substring(name, F.length(old) + 1, F.length(name)))).otherwise(ref)
        return F.when(body.startswith("#"), by_number).otherwise(F.coalesce(F.try_element_at(named, name), begun))

    found = F.transform(F.regexp_extract_all(text, F.lit(f"({_REFERENCE})"), F.lit(1)), decoded)
    kept = F.split(text, _REFERENCE, -1)
    joined = F.array_join(F.flatten(F.zip_with(kept, found, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def strip_html(raw: Column) -> Column:
    """Text without tags, with character references decoded, in single blanks."""
    return squeeze(decode_references(F.regexp_replace(F.coalesce(raw, F.lit("")), "<[^>]+>", " ")))


def remove_links(text: Column) -> Column:
    """Text with web and mail addresses blanked out."""
    return F.regexp_replace(text, r"(?iu)(?:https?://|www\.)\S+|\S+@\S+\.\S+", " ")


def split_glued_labels(text: Column, labels: list[str]) -> Column:
    """A line end before each label that is glued to the end of a word."""
    any_of = "|".join(re.escape(x) for x in sorted(labels, key=len, reverse=True))
    return F.regexp_replace(text, rf"(?U)(?<=[^\W_])(?=(?:{any_of})\s*:)", "\n")


def searchable(title: Column, description: Column) -> Column:
    return normalize(F.concat_ws(" ", title, description))


def padded(normalized: Column) -> Column:
    """Normalised text between blanks, in which a phrase is found as a whole by ``holds_phrase``."""
    return F.concat(F.lit(" "), normalized, F.lit(" "))


def holds_phrase(padded_text: Column, phrase: str) -> Column:
    """Whether the words of a normalised phrase follow each other in the text; an empty phrase is never held."""
    return F.contains(padded_text, F.lit(f" {phrase} ")) if phrase else F.lit(False)


def canonical_company(name: Column, aliases: dict[str, str] | None = None) -> Column:
    """The usual spelling of a company; empty for names of at most one letter, one label for undisclosed ones."""
    # Spellings of the same company.
    known = aliases if aliases is not None else {
        "venha ser sanguelaranja": "FCamara", "randstad 1": "Randstad", "randstad matriz": "Randstad",
        "nava tech for business": "Nava Technology for Business", "minsait brasil": "Minsait", "minsait an indra company": "Minsait",
    }
    def usual(key: Column) -> Column:
        out = F.when(F.length(key) <= 1, F.lit("")).when(key.rlike(r"\bconfidencial\d*\b"), F.lit("Confidencial"))
        return reduce(lambda w, item: w.when(key == item[0], F.lit(item[1])), known.items(), out).otherwise(name)

    return bound(normalize(name), usual)


def is_slug(name: Column) -> Column:
    """Whether a company name is the slug of an address rather than a name."""
    return F.coalesce(F.contains(name, F.lit("-")) & ~F.contains(name, F.lit(" ")) & (F.lower(name) == name), F.lit(False))


def http_code(message: Column) -> Column:
    """The first HTTP error code in a message, or null."""
    got = F.regexp_extract(message, r"\b([45]\d\d)\b", 1)
    return F.when(got != "", got.cast("int"))


def consolidated(saved: Column, incoming: Column, detail: bool = False) -> Column:
    """struct(text, preserved): whether the saved description stays when a new one arrives.

    It stays if there is no new one; if the new one comes from a detail page and is not longer; or if the saved
    one is whole, of at least 500 characters, and the new one is shorter than that or cut off.
    """
    old, new = F.coalesce(saved, F.lit("")), F.coalesce(incoming, F.lit(""))
    cut = lambda c: F.endswith(c, F.lit("..."))
    keep = (new == "") | ((F.length(old) >= 500) & ~cut(old) & ((F.length(new) < 500) | cut(new)))
    if detail:
        keep = keep | (F.length(old) >= F.length(new))
    keep = (old != "") & keep
    return F.struct(F.when(keep, old).otherwise(new).alias("text"), keep.alias("preserved"))
