"""Incremental upsert of postings and their skills into a snapshot, and its maintenance.

A batch never changes rows that it does not name. Every function gives the next snapshot as a DataFrame; writing it
is the sink's business.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.links import link_identity
from ..functions.places import normalize_location
from ..functions.text import canonical_company, consolidated, is_slug
from ..functions.workplace import UNKNOWN, infer_declared, infer_workplace
from .classify import PlaceRules, hub_and_region


def first_wins(batch: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The first row of each key of the rows whose key columns and title are filled."""
    for c in [*keys, "title"]:
        batch = batch.filter(F.trim(F.coalesce(F.col(c), F.lit(""))) != "")
    order = Window.partitionBy(*keys).orderBy(ordinal)
    return batch.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def last_wins(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The latest row of each key, as a run history keeps it."""
    window = Window.partitionBy(*keys).orderBy(order.desc())
    return rows.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def match_ids(batch: DataFrame, snapshot: DataFrame, ordinal: str) -> DataFrame:
    """``batch`` with ``match_id``: the snapshot row by source and id, else by link, else by the link's identity.

    Of snapshot rows with one link that with the smallest id counts. Rows without any match have null. Only rows that
    have a link are joined by it, so the many without one do not meet in one task.
    """
    names = batch.columns
    by_url = snapshot.filter("url is not null and trim(url) <> ''").groupBy(F.trim("url").alias("_url")).agg(F.min("id").alias("_by_url"))
    by_link = snapshot.withColumn("_link", link_identity(F.col("url"))).filter("_link <> ''").groupBy("_link").agg(F.min("id").alias("_by_link"))
    by_key = snapshot.select("source", "external_id", F.col("id").alias("_by_key"))
    rows = batch.join(by_key, ["source", "external_id"], "left").withColumn("_url", F.trim(F.coalesce("url", F.lit(""))))
    linked = rows.filter("_by_key is null and _url <> ''").withColumn("_link", link_identity(F.col("_url")))
    named = linked.join(by_url, "_url", "left")
    told, rest = named.filter("_by_url is not null or _link = ''"), named.filter("_by_url is null and _link <> ''").join(by_link, "_link", "left")
    done = rows.filter("_by_key is not null or _url = ''").select(*names, F.col("_by_key").alias("match_id"))
    return done.unionByName(told.select(*names, F.col("_by_url").alias("match_id"))).unionByName(rest.select(*names, F.col("_by_link").alias("match_id")))


def next_ids(rows: DataFrame, start: int, order: list[str], width: int = 1 << 16) -> DataFrame:
    """``rows`` with ``id`` counting on from ``start``: ranks within hash buckets, shifted by the sizes before them."""
    bucketed = rows.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(width)))
    offsets = bucketed.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    offsets = offsets.withColumn("_o", F.sum("_c").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).select("_b", F.coalesce("_o", F.lit(0)).alias("_o"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy(*order))
    return bucketed.join(offsets, "_b").withColumn("id", F.lit(start) + F.col("_o") + rank).drop("_b", "_o")


def _merged(old: str, new: str) -> dict[str, Column]:
    """The fields of a row from its saved and its incoming form."""
    o, n = (lambda c: F.col(f"{old}.{c}")), (lambda c: F.nullif(F.trim(F.col(f"{new}.{c}")), F.lit("")))
    company = F.nullif(canonical_company(n("company")), F.lit(""))
    weak = (company.isNull() & n("company").isNotNull() & o("company").isNotNull()) | (is_slug(company) & F.coalesce(F.contains(o("company"), F.lit(" ")), F.lit(False)))
    text = consolidated(o("description"), n("description"))
    declared = F.coalesce(F.col(f"{new}.workplace_declared"), F.lit(False))
    was = F.coalesce(o("workplace_declared"), F.lit(False))
    return {
        "title": F.trim(F.col(f"{new}.title")), "company": F.when(weak, o("company")).otherwise(company), "location": n("location"), "url": n("url"),
        "description": F.nullif(text["text"], F.lit("")), "description_kept": text["preserved"],
        "closed": F.coalesce(o("closed"), F.lit(False)) | F.coalesce(F.col(f"{new}.closed"), F.lit(False)),
        "workplace_declared": declared | was, "workplace": F.when(~declared & was, o("workplace")).otherwise(n("workplace")),
        "published": F.col(f"{new}.published"),
    }


def _areas(rows: DataFrame, known: list[str] | None, fallback: str, classify: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """``rows`` (..., title, description, area, old_area) with the area that stays.

    An area of the vocabulary ``known`` other than the fallback is taken as it comes. Otherwise a good old one stays
    if there is no description; and what is left is told from title and description by ``classify``, which adds
    ``area`` to (id, title, description).
    """
    given, old = F.coalesce(F.col("area"), F.lit("")), F.col("old_area")
    good = lambda c: (c.isin(known) if known is not None else c != "") & (c != fallback)
    bare = F.trim(F.coalesce("description", F.lit(""))) == ""
    stays = F.when(good(given), given).when(F.coalesce(good(old), F.lit(False)) & bare, old)
    if classify is None:
        return rows.withColumn("area", F.coalesce(stays, F.nullif(given, F.lit("")), old)).drop("old_area")
    told = classify(rows.filter(stays.isNull()).select("id", "title", "description")).select("id", F.col("area").alias("_told"))
    return rows.join(told, "id", "left").withColumn("area", F.coalesce(stays, "_told")).drop("old_area", "_told")


def merge(
    snapshot: DataFrame, batch: DataFrame, ordinal: str = "ord", floor: Column | None = None, areas: list[str] | None = None,
    fallback: str = "Outros/TI Geral", classify: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The next snapshot: (id, source, external_id, title, company, location, url, description, closed, workplace,
    workplace_declared, published, area, description_kept).

    The batch's first row of a key wins; it must have been resolved before, so that no two of its rows are one
    posting. Rows dated before ``floor`` are not taken, and leave the snapshot. Empty fields are null. A whole
    description does not give way to a snippet, a company name not to a single letter or a slug, a known area not
    to an unknown one or to ``fallback`` without a description; where there is one, ``classify`` tells the area. A
    posting once closed stays closed and a declared workplace declared. Merging the same batch again changes
    nothing. The snapshot is scanned once and joined on ids.
    """
    rows = first_wins(batch, ["source", "external_id"], ordinal)
    if floor is not None:
        rows = rows.filter(F.col("published").isNull() | (F.col("published") >= floor))
        snapshot = snapshot.filter(F.col("published").isNull() | (F.col("published") >= floor))
    met = match_ids(rows, snapshot, ordinal)
    one = Window.partitionBy("match_id").orderBy(F.desc(ordinal))
    updates = met.filter("match_id is not null").withColumn("_n", F.row_number().over(one)).filter("_n = 1").drop("_n")
    top = snapshot.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    fresh = next_ids(met.filter("match_id is null"), top, ["source", "external_id"])
    old = snapshot.drop("description_kept").alias("o")
    changed = old.join(updates.alias("n"), F.col("o.id") == F.col("n.match_id"), "left")
    hit = F.col("n.match_id").isNotNull()
    fields = _merged("o", "n")
    kept = changed.filter(~hit).select("o.id", "o.source", "o.external_id", *[F.lit(False).alias(c) if c == "description_kept" else F.col(f"o.{c}") for c in fields], "o.area")
    updated = changed.filter(hit).select("o.id", "o.source", "o.external_id", *[v.alias(c) for c, v in fields.items()], "n.area", F.col("o.area").alias("old_area"))
    empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in snapshot.schema])
    made = fresh.select(F.struct("*").alias("n"), empty.alias("o"))
    added = made.select("n.id", "n.source", "n.external_id", *[v.alias(c) for c, v in fields.items()], "n.area", F.lit(None).cast("string").alias("old_area"))
    touched = _areas(updated.unionByName(added), areas, fallback, classify)
    return kept.unionByName(touched.withColumn("area", F.nullif("area", F.lit(""))))


def sync_links(links: DataFrame, touched: DataFrame, wanted: DataFrame) -> DataFrame:
    """The next (id, skill_id) links: those of ``touched`` ids are replaced by ``wanted`` ones, all others stay.

    An id for which nothing known is wanted keeps what it has.
    """
    known = wanted.select("id", "skill_id").distinct()
    replaced = touched.join(known, "id", "left_semi").select("id").distinct()
    return links.join(replaced, "id", "left_anti").unionByName(known.join(replaced, "id", "left_semi"))


def add_links(links: DataFrame, found: DataFrame) -> DataFrame:
    """Links with those found in details added; none is ever removed."""
    return links.unionByName(found.select("id", "skill_id")).distinct()


def seed_vocabulary(known: DataFrame, names: DataFrame) -> DataFrame:
    """The vocabulary (skill_id, skill, grp) with missing names added and groups brought up to date."""
    both = known.alias("k").join(names.alias("n"), F.col("k.skill") == F.col("n.skill"), "full")
    rows = both.select(F.col("k.skill_id").alias("skill_id"), F.coalesce("n.skill", "k.skill").alias("skill"), F.coalesce("n.grp", "k.grp").alias("grp"))
    top = known.agg(F.coalesce(F.max("skill_id"), F.lit(0))).first()[0]
    added = next_ids(rows.filter("skill_id is null").drop("skill_id"), top, ["skill"]).withColumnRenamed("id", "skill_id")
    return rows.filter("skill_id is not null").unionByName(added.select("skill_id", "skill", "grp"))


def wanted_links(rows: DataFrame, vocabulary: DataFrame, given: str = "skills", found: str | None = None) -> DataFrame:
    """Distinct (id, skill_id) of the names in the arrays ``given`` and ``found``, whatever their case.

    Of names that differ only in case the last id counts, and names that the vocabulary does not have are left out.
    """
    none = F.array().cast("array<string>")
    names = F.array_union(F.coalesce(F.col(given), none), F.coalesce(F.col(found), none) if found else none)
    each = rows.select("id", F.explode(names).alias("name")).select("id", F.lower(F.trim("name")).alias("name"))
    ids = vocabulary.groupBy(F.lower("skill").alias("name")).agg(F.max("skill_id").alias("skill_id"))
    return each.join(ids, "name").select("id", "skill_id").distinct()


def pending(rows: DataFrame, today: Column, days: int | None = None, short: int = 500) -> DataFrame:
    """Rows whose description is missing, short or cut off, within a window of days if one is given."""
    out = rows.filter(~F.coalesce(F.col("closed"), F.lit(False)) & incomplete(F.col("description"), short))
    return out if days is None else out.filter(F.col("published").isNull() | (F.col("published") >= F.date_sub(today, days)))


def incomplete(description: Column, short: int = 500, cut: bool = True) -> Column:
    """Whether a description is missing, shorter than ``short``, or, with ``cut``, broken off."""
    text = F.coalesce(description, F.lit(""))
    return (F.length(F.trim(text)) < short) | (F.endswith(text, F.lit("...")) if cut else F.lit(False))


#: Days back to which attempts are repeated.
WINDOW_DAYS = 30
# For each portal the least length of a description, and whether one that breaks off is asked for again.
LEAST = {"linkedin": (30, False), "vagas": (500, True), "trampos": (100, False), "geekhunter": (300, False), "infojobs": (160, True)}


def _lacks(source: str, today: Column, days: int) -> Column:
    """Whether a row of a portal lacks what its detail page has."""
    if source == "gupy":
        return F.col("url").rlike(r"(?i)://.*\.gupy\.io/")
    least, cut = LEAST[source]
    text = F.coalesce("description", F.lit(""))
    lacks = (F.length(text) < least) | (F.endswith(text, F.lit("...")) if cut else F.lit(False))
    if source == "trampos":
        return lacks & (F.col("published").isNull() | (F.col("published") >= F.date_sub(today, days)))
    if source == "geekhunter":
        return lacks | F.coalesce(F.contains("company", F.lit("-")), F.lit(False)) | F.col("published").isNull()
    return lacks


def queue(rows: DataFrame, source: str, today: Column, days: int = WINDOW_DAYS, forced: bool = False, limit: int | None = None) -> DataFrame:
    """The rows of a portal whose details are to be fetched, in the order of ids, at most ``limit`` of them.

    ``forced`` takes rows up again that had been resolved: all of a portal, or those without a longer description
    than its least one.
    """
    own = rows.filter(F.col("source") == source)
    if not forced:
        own = own.filter(~F.coalesce(F.col("closed"), F.lit(False)) & F.coalesce(_lacks(source, today, days), F.lit(False)))
    elif source == "infojobs":
        own = own.filter(incomplete(F.col("description"), LEAST[source][0] + 1))
    return own if limit is None else own.orderBy("id").limit(limit)


def record_attempts(rows: DataFrame, attempts: DataFrame) -> DataFrame:
    """Rows with the state of their last attempt; an availability, once known, is only replaced by another."""
    last = last_wins(attempts, ["id"], F.col("attempted_at")).select("id", F.col("status").alias("_s"), F.col("reason").alias("_r"), F.col("attempted_at").alias("_t"), F.col("available").alias("_a"))
    met = rows.join(last, "id", "left")
    return met.select(*[c for c in rows.columns if c not in {"status", "reason", "attempted_at", "available"}], F.coalesce("_s", "status").alias("status"),
                      F.when(F.col("_s").isNotNull(), F.col("_r")).otherwise(F.col("reason")).alias("reason"), F.coalesce("_t", "attempted_at").alias("attempted_at"), F.coalesce("_a", "available").alias("available"))


def broken_links(links: DataFrame, rows: DataFrame, items: DataFrame) -> DataFrame:
    """Links of which an end is missing; there must be none."""
    lost = links.join(rows.select("id"), "id", "left_anti").withColumn("missing", F.lit("row"))
    return lost.unionByName(links.join(items.select("skill_id"), "skill_id", "left_anti").select("id", "skill_id").withColumn("missing", F.lit("skill")))


def reclassify_areas(rows: DataFrame, known: list[str], classify: Callable[[DataFrame], DataFrame], override: Callable[[DataFrame], DataFrame] | None = None, everything: bool = False) -> DataFrame:
    """``rows`` with areas told anew, and ``changed``.

    Rows without a description keep their area. Those of an area outside ``known`` are classified, or all if
    ``everything``; of the others only what ``override`` finds is taken, which may leave an area null.
    """
    text = F.trim(F.coalesce("description", F.lit(""))) != ""
    again = F.lit(everything) | ~F.coalesce(F.col("area").isin(known), F.lit(False))
    told = classify(rows.filter(text & again).select("id", "title", "description")).select("id", F.col("area").alias("_told"))
    if override is not None and not everything:
        told = told.unionByName(override(rows.filter(text & ~again).select("id", "title", "description")).select("id", F.col("area").alias("_told")))
    met = rows.join(told, "id", "left")
    changed = F.col("_told").isNotNull() & ~F.col("_told").eqNullSafe(F.coalesce("area", F.lit("")))
    return met.withColumn("changed", changed).withColumn("area", F.coalesce("_told", "area")).drop("_told")


def reclassify_workplaces(rows: DataFrame, places: PlaceRules, curated: DataFrame | None = None, source: str = "linkedin") -> DataFrame:
    """``rows`` with the workplaces of a declaring source told anew, hub and region with them, and ``changed``.

    What ``curated`` (external_id, workplace) says stands and counts as declared.
    """
    if curated is not None:
        rows = rows.join(curated.select("external_id", F.col("workplace").alias("_curated")), "external_id", "left")
    else:
        rows = rows.withColumn("_curated", F.lit(None).cast("string"))
    own, declared = F.col("source") == source, F.coalesce(F.col("workplace_declared"), F.lit(False))
    told = F.coalesce("_curated", infer_declared(F.col("workplace"), declared, F.col("location"), F.col("title"), F.col("description")))
    met = rows.withColumn("_told", F.when(own, told)).withColumn("_declared", declared | (own & F.col("_curated").isNotNull()))
    met = met.withColumn("changed", own & ((F.col("_told") != F.coalesce("workplace", F.lit(""))) | (F.col("_declared") != declared)))
    place = hub_and_region(F.col("location"), F.col("_told"), places)
    new = {"workplace": F.col("_told"), "workplace_declared": F.col("_declared"), "hub": place["hub"], "region": place["region"]}
    return met.withColumns({c: F.when(F.col("changed"), v).otherwise(F.col(c)) for c, v in new.items()}).drop("_told", "_declared", "_curated")


def after_import(rows: DataFrame, places: PlaceRules, declaring: str = "linkedin") -> DataFrame:
    """The pass over the whole table after an import: companies, locations, workplaces, hubs and regions.

    Workplaces of the declaring source are told anew; those of others only where they are unknown. Hub and region
    follow a workplace of the declaring source that changed, and are filled where they are unknown.
    """
    company = F.when(F.coalesce("company", F.lit("")) != "", canonical_company(F.col("company"))).otherwise(F.col("company"))
    location = F.when(F.coalesce("location", F.lit("")) != "", normalize_location(F.col("location"))).otherwise(F.col("location"))
    rows = rows.withColumns({"company": company, "location": location})
    own, unknown = F.col("source") == declaring, F.coalesce("workplace", F.lit("")).isin("", UNKNOWN)
    told = infer_declared(F.col("workplace"), F.col("workplace_declared"), F.col("location"), F.col("title"), F.col("description"))
    other = infer_workplace(F.col("workplace"), F.col("location"), F.col("title"), F.col("description"))
    met = rows.withColumn("_told", F.when(own, told).when(unknown, other).otherwise(F.col("workplace")))
    moved = own & ~F.col("_told").eqNullSafe(F.col("workplace"))
    place = hub_and_region(F.col("location"), F.col("_told"), places)
    fill = moved | F.coalesce("region", F.lit("")).isin("", UNKNOWN)
    return met.withColumns({"workplace": F.col("_told"), "hub": F.when(fill, place["hub"]).otherwise(F.col("hub")), "region": F.when(fill, place["region"]).otherwise(F.col("region"))}).drop("_told")
