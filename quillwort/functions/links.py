"""What a link tells about the posting behind it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Second-level labels under which country domains are registered.
SECOND_LEVEL = ["com", "net", "org", "gov", "edu", "adv", "eng", "esp", "ind"]
_UUID = r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"


def _parts(url: Column) -> tuple[Column, Column]:
    """Authority and path of an http(s) link; empty otherwise."""
    whole = r"^https?://([^/?#]*)([^?#]*)"
    return F.regexp_extract(url, whole, 1), F.regexp_extract(url, whole, 2)


def registrable_domain(authority: Column) -> Column:
    """The last two labels of a host, or three under a country's second level; empty for single labels."""
    host = F.element_at(F.split(F.lower(authority), "@"), -1)
    labels = F.filter(F.split(F.split(host, ":")[0], r"\."), lambda x: x != "")
    n = F.size(labels)
    deep = (n >= 3) & (F.length(F.element_at(labels, -1)) == 2) & F.coalesce(F.try_element_at(labels, F.lit(-2)).isin(SECOND_LEVEL), F.lit(False))
    return F.when(n < 2, F.lit("")).when(deep, F.array_join(F.slice(labels, -3, 3), ".")).otherwise(F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), "."))


def link_identity(url: Column) -> Column:
    """The posting's id that a link carries, with the registrable domain; empty if there is none to rely on.

    In this order: a UUID anywhere in the path, which needs no domain; a path segment of 16 or more letters and
    digits with a digit; a segment of 4 to 6 digits; the longest run of 7 or more digits, the first of equals; a
    segment that begins with 5 or more digits and a hyphen.
    """
    link = F.coalesce(url, F.lit(""))
    authority, raw_path = _parts(link)
    path = F.coalesce(F.try_url_decode(F.replace(raw_path, F.lit("+"), F.lit("%2B"))), raw_path)
    uuid = F.lower(F.regexp_extract(path, _UUID, 0))
    domain = registrable_domain(authority)
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    first = lambda pattern: F.get(F.filter(segments, lambda s: s.rlike(pattern)), F.lit(0))
    token, short = first(r"^(?=[^\d]*\d)[A-Za-z0-9_=+%]{16,}$"), first(r"^\d{4,6}$")
    runs = F.regexp_extract_all(path, F.lit(r"(\d{7,})"), F.lit(1))
    longest = F.aggregate(runs, F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    leading = F.regexp_extract(first(r"^\d{5,}-"), r"^(\d{5,})-", 1)
    found = F.coalesce(token, short, F.when(longest != "", longest), F.when(leading != "", leading))
    return F.when(uuid != "", F.concat(F.lit("uuid:"), uuid)).otherwise(F.coalesce(F.when(domain != "", F.concat(domain, F.lit(":"), found)), F.lit("")))
