"""Entity resolution of postings: exact keys first, then texts within equal titles.

``ord`` is a struct that orders postings as they were collected. It grows by one field on each rung instead of being
renumbered, so no rung needs a sort over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import loose_date
from ..functions.links import link_identity
from ..functions.places import company_identity, place_identity
from ..functions.text import normalize


def _longest_first(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """One row for each key: the longest description, the first of equals, in the place of the key's first row.

    The search term of the row follows the chain of descriptions that were the longest so far: that of the first of
    them that has any. Rows with an empty key stay, after all others.
    """
    rows = df.withColumn("_key", key).withColumn("_len", F.length(F.coalesce("description", F.lit(""))))
    keyed, loose = rows.filter("_key <> ''"), rows.filter("_key is null or _key = ''")
    before = Window.partitionBy("_key").orderBy("_ord").rowsBetween(Window.unboundedPreceding, -1)
    records = keyed.withColumn("_max", F.max("_len").over(before)).filter("_max is null or _len > _max").drop("_max")
    names = [c for c in df.columns if c not in {"search_term", "_ord"}]
    term = F.min_by("search_term", F.when(F.coalesce("search_term", F.lit("")) != "", F.col("_ord")))
    won = records.groupBy("_key").agg(F.max_by(F.struct(*names), "_len").alias("_w"), term.alias("search_term"), F.min("_ord").alias("_ord"))
    won = won.select("_w.*", F.coalesce("search_term", F.lit("")).alias("search_term"), F.struct(F.lit(0).alias("loose"), F.col("_ord").alias("ord")).alias("_ord"))
    rest = loose.drop("_key", "_len").withColumn("_ord", F.struct(F.lit(1).alias("loose"), F.col("_ord").alias("ord")))
    return won.select(*df.columns).unionByName(rest.select(*df.columns))


def by_keys(jobs: DataFrame, ordinal: str = "ord") -> DataFrame:
    """The three exact rungs: source and id, then link, then the identity in the link."""
    rows = jobs.withColumn("_ord", F.struct(F.col(ordinal).alias("ord")))
    for key in (F.concat_ws(":", "source", "external_id"), F.trim(F.coalesce("url", F.lit(""))), link_identity(F.col("url"))):
        rows = _longest_first(rows, key, [ordinal])
    return rows


def _greedy(rows: pd.DataFrame) -> list[int]:
    """Places of the surviving rows of one title group, which comes in order."""
    kept: list[int] = []
    terms: dict[int, str] = {}
    sets = [frozenset(x) for x in rows["_company"]]
    source, city, state, day, size, term = (rows[c].tolist() for c in ("source", "_city", "_state", "_day", "_len", "search_term"))

    def same(a: int, b: int) -> bool:
        if source[a] == source[b] or not sets[a] or not sets[b] or not (sets[a] <= sets[b] or sets[b] <= sets[a]):
            return False
        if city[a] is None or city[a] != city[b] or (state[a] and state[b] and state[a] != state[b]):
            return False
        return day[a] is not None and day[b] is not None and abs((day[a] - day[b]).days) <= 7

    for i in range(len(rows)):
        for at, r in enumerate(kept):
            if same(i, r):
                if size[i] > size[r]:
                    kept[at] = i
                    terms[i] = terms.get(r, term[r]) or term[i]
                break
        else:
            kept.append(i)
    for i, t in terms.items():
        rows.loc[rows.index[i], "search_term"] = t
    return kept


def resolve(jobs: DataFrame, ordinal: str = "ord") -> DataFrame:
    """Postings without duplicates; all columns, the description and search term as the chain of winners has them.

    Postings without a city, and those of a title and city that only one source has, pass by. In the other groups
    postings are compared with the survivors so far in order: another source, a company whose words hold the other's,
    the same city in no other state, dates at most seven days apart; the longer description then stands for both.
    That order matters, so a group is one task; groups are as large as one title is common in a city.
    """
    keyed = by_keys(jobs, ordinal)
    place = place_identity(F.col("location"))
    rows = keyed.withColumns({
        "_title": normalize(F.col("title")), "_company": company_identity(F.col("company")), "_city": place["city"], "_state": place["state"],
        "_day": loose_date(F.col("published_date")), "_len": F.length(F.coalesce("description", F.lit(""))),
    })
    # One shuffle by title and city serves the window, the rows that pass by and the groups. Rows without a city stay.
    block = Window.partitionBy("_title", "_city")
    placed = rows.filter("_city is not null")
    placed = placed.withColumns({"_several": F.min("source").over(block) != F.max("source").over(block), "_place": F.row_number().over(block.orderBy("_ord"))}).drop("_ord")
    alone, groups = placed.filter(~F.col("_several")), placed.filter("_several").drop("_several")
    loose = rows.filter("_city is null").select(*jobs.columns)

    def survivors(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_place", kind="stable").reset_index(drop=True)
        return group.iloc[_greedy(group)].drop(columns=["_place"])

    kept = groups.groupBy("_title", "_city").applyInPandas(survivors, groups.drop("_place").schema)
    return loose.unionByName(alone.select(*jobs.columns)).unionByName(kept.select(*jobs.columns))


def marginal(base: DataFrame, extra: DataFrame, ordinal: str = "ord") -> DataFrame:
    """(base, both, added): how many postings a source adds to those known already, after resolution."""
    both = base.withColumn(ordinal, F.struct(F.lit(0).alias("s"), F.col(ordinal).alias("o"))).unionByName(extra.withColumn(ordinal, F.struct(F.lit(1).alias("s"), F.col(ordinal).alias("o"))))
    n = lambda df, name: resolve(df, ordinal).agg(F.count(F.lit(1)).alias(name))
    return n(base, "base").crossJoin(n(both, "both")).withColumn("added", F.col("both") - F.col("base"))  # one row each
