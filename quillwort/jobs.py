"""Whole jobs over tables: the import of a batch, with its areas, workplaces, places and skills.

A job gives the next state of its tables, which a sink publishes; only what it reads several times is written, to the
folder that all machines share.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import dates
from .operators import classify as K
from .operators import merge as M
from .operators import skills as S
from .sources.files import stored
from .sources.portals import with_overrides

#: Columns of the saved postings.
POSTING = (
    "id long, source string, external_id string, title string, company string, location string, url string, description string, closed boolean,"
    " workplace string, workplace_declared boolean, published date, area string, description_kept boolean, hub string, region string"
)


@dataclass
class Rules:
    """What an import goes by."""

    areas: K.AreaRules
    skills: S.SkillRules
    places: K.PlaceRules


def _true(flag: Column) -> Column:
    return F.lower(F.trim(F.coalesce(flag, F.lit("")))).isin("1", "true")


def prepared(batch: DataFrame, rules: Rules, today: Column, curated: DataFrame | None = None) -> DataFrame:
    """Rows of a collected file (texts, and ``ord``) that are technical, with dates and flags, skills as an array."""
    kept = batch.filter(K.is_tech(F.col("title"), F.col("description"), rules.areas))
    rows = kept.select(
        "ord", "source", "external_id", "title", "company", "location", "url", "description", _true(F.col("enrich_encerrada")).alias("closed"), F.col("workplace_type").alias("workplace"),
        _true(F.col("workplace_declared")).alias("workplace_declared"), dates.published_date(F.col("published_date"), today).alias("published"), "area",
        F.filter(F.transform(F.split(F.coalesce("skills", F.lit("")), ","), lambda s: F.trim(s)), lambda s: s != "").alias("given"),
    )
    return rows if curated is None else with_overrides(rows, curated)


def import_batch(
    saved: DataFrame, links: DataFrame, vocabulary: DataFrame, batch: DataFrame, rules: Rules, today: Column, floor: Column | None = None, curated: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The next postings (``POSTING``) and the next (id, skill_id) links, after a batch of collected rows.

    Rows that are not technical, lack a key or title, or are older than ``floor`` are left out, and the first row of a
    key wins. Fields are merged, areas told where they are unknown, and then all postings get canonical companies and
    places, workplaces, hubs and regions. The links of a posting become the skills that its row names and, where a
    longer saved description stayed, those that this one names; a row that names none that are known changes none.
    """
    rows = stored(prepared(batch, rules, today, curated), "import-rows")
    told = lambda x: K.classify(x, "id", "title", "description", rules.areas).select("id", "area")
    merged = M.merge(saved.drop("hub", "region"), rows, floor=floor, areas=[*rules.areas.areas, rules.areas.fallback], fallback=rules.areas.fallback, classify=told)
    merged = stored(merged, "import-merged")
    placed = merged.join(saved.select("id", "hub", "region"), "id", "left")
    after = M.after_import(placed, rules.places)

    # Which posting a row became: the saved one it matches, or the new one with its key.
    first = M.first_wins(rows, ["source", "external_id"], "ord")
    if floor is not None:
        first = first.filter(F.col("published").isNull() | (F.col("published") >= floor))
    met = M.match_ids(first, saved, "ord")
    new = met.filter("match_id is null").join(merged.select("source", "external_id", "id"), ["source", "external_id"])
    became = met.filter("match_id is not null").select(F.col("match_id").alias("id"), "given").unionByName(new.select("id", "given"))
    stayed = merged.filter("description_kept").join(became.select("id").distinct(), "id", "left_semi")
    found = S.skill_mentions(stayed.select("id", "title", "description"), "id", "title", "description", rules.skills)
    found = found.groupBy("id").agg(F.collect_list("skill").alias("found"))
    wanted = M.wanted_links(became.join(found, "id", "left"), vocabulary, "given", "found")
    return after, M.sync_links(links, became.select("id").distinct(), wanted)


def reextract(rows: DataFrame, links: DataFrame, vocabulary: DataFrame, rules: S.SkillRules) -> tuple[DataFrame, DataFrame]:
    """The links (id, skill_id) that all postings would have by the rules of now, and what that changes.

    The changes are rows (id, skill_id, change) with ``added`` or ``removed``; a dry run looks at these alone.
    """
    names = S.skill_mentions(rows.select("id", "title", "description"), "id", "title", "description", rules).groupBy("id").agg(F.collect_list("skill").alias("skills"))
    now = M.wanted_links(names, vocabulary)
    both = links.select("id", "skill_id").withColumn("o", F.lit(1)).join(now.withColumn("w", F.lit(1)), ["id", "skill_id"], "full").filter("o is null or w is null")
    return now, both.select("id", "skill_id", F.when(F.col("o").isNull(), "added").otherwise("removed").alias("change"))


def evaluate_source(own: DataFrame, others: DataFrame) -> DataFrame:
    """One row about a source: (rows, unique, overlap, marginal_pct, complete_pct) against the postings of the others.

    Postings are the same by normalised title, company and place; complete ones have a company, a place, a date and a
    description.
    """
    key = [F.lower(F.trim(F.coalesce(c, F.lit("")))).alias(c) for c in ("title", "company", "location")]
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")) != "" for c in ("company", "location", "published", "description")]
    whole = filled[0] & filled[1] & filled[2] & filled[3]
    counted = own.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(whole, 1)).alias("whole"))
    mine, rest = own.select(*key).distinct(), others.select(*key).distinct()
    found = mine.join(rest.withColumn("known", F.lit(True)), ["title", "company", "location"], "left")
    sums = found.agg(F.count(F.lit(1)).alias("unique"), F.count("known").alias("overlap"))
    base = rest.agg(F.count(F.lit(1)).alias("base"))
    pct = lambda a, b: F.round(100.0 * a / F.greatest(b, F.lit(1)), 1)
    return counted.crossJoin(sums).crossJoin(base).select(  # one row each
        "rows", "unique", "overlap", pct(F.col("unique") - F.col("overlap"), F.col("base")).alias("marginal_pct"), pct(F.col("whole"), F.col("rows")).alias("complete_pct")
    )
