"""Connected components of an edge list, and the links among candidates that share keys.

Components come from alternating large-star and small-star rounds. All of it is joins, windows and aggregates on
node ids; neither links nor components reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common


def _stars(pairs: DataFrame) -> DataFrame:
    """Links (u, v): v and u itself are hung on the smallest node next to u."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v), the component being its smallest node.

    Self-links and repeated or reversed links are allowed, links with a null end are left out. Every round is
    written to the shared folder, which cuts the lineage.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u is not null and v is not null and u <> v").distinct()
    now = common.store(now, "components")
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    before = now.agg(F.count(F.lit(1)), mark).first()
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).withColumn("m", F.least("m", "u")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _stars(large)  # u > v in every row
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        following = common.store(small, "components")
        after = following.agg(F.count(F.lit(1)), mark).first()
        common.discard(now)
        now = following
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def meeting(entries: DataFrame, name: str) -> DataFrame:
    """(key, id, pivot, crowd) of the ``entries`` (key, id) whose key several ids have.

    The pivot is the smallest of them, and a crowd is made up of three ids or more.
    """
    whole = Window.partitionBy("key")
    met = entries.select("key", "id", F.min("id").over(whole).alias("pivot"), F.max("id").over(whole).alias("last")).filter("pivot <> last")
    crowd = F.min(F.when(F.col("id") != F.col("pivot"), F.col("id"))).over(whole) != F.col("last")
    return common.store(met.select("key", "id", "pivot", crowd.alias("crowd")).distinct(), f"{name}-members")


def linked(
    members: DataFrame, check: Callable[[DataFrame, str], DataFrame], name: str, fits: Callable[[Column, Column], Column], tighten: Callable[[DataFrame], DataFrame], gradual: bool = False,
    loads: DataFrame | None = None, parts: int = 1, once: bool = False,
) -> DataFrame:
    """Pairs (a, b) that connect whatever is linked among ``members``, without pairing all ids of a key.

    ``check`` keeps the linked ones of candidate pairs (a, b). First every id is compared with the pivots of its
    keys; if ``gradual``, with the smallest of them before the others, of which those that are connected by then are
    left out. When the links found are joined to components, what lies outside the component of a key's pivot is
    compared with the ids of all other components there, but for the pivot, with which all have been. So only a crowd
    takes part in that. Pairs within a component are never needed, so the links left out are those between ids that are
    connected already; the first links are given as the stars they form. Before the last step, ``tighten`` gives a
    ``load`` to the rows (key, id, component, main) that are left, and pairs are made only if ``fits`` their loads. Where
    ``loads`` (id, load) are known before, pairs with a pivot are compared only if they fit as well. With ``once``, two
    ids that share many keys are paired for few of them: not for a key if one of the two keys before it, in the order of
    either id's keys, is shared as well. The keys of the last step are dealt out to ``parts`` that follow each other, as
    each part needs room on disk.
    """
    star = members.filter("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    if loads is not None:
        side = lambda x: loads.select(F.col("id").alias(x), F.col("load").alias(f"l{x}"))
        star = star.join(side("a"), "a").join(side("b"), "b").filter(fits(F.col("la"), F.col("lb"))).select("a", "b")
    star = common.store(star, f"{name}-pairs")

    def joined(links: DataFrame) -> DataFrame:
        found = components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("node", "id")
        return common.store(found, f"{name}-joined")

    if gradual:
        links = check(star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), f"{name}-nearest")
        found = joined(links)
        of = lambda x: found.select(F.col("id").alias(x), F.col("component").alias(f"c{x}"))
        apart = star.join(of("a"), "a", "left").join(of("b"), "b", "left").filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
        links = links.unionByName(check(apart, f"{name}-star"))
        common.discard(found)
    else:
        links = check(star, f"{name}-star")
    found = joined(links)
    common.discard(links)

    whole, before = Window.partitionBy("key"), Window.partitionBy("id").orderBy("key")
    main = F.min(F.when(F.col("id") == F.col("pivot"), F.col("component"))).over(whole)
    tights, rests = [], []
    for part in range(parts):
        own = members.filter("crowd")
        own = own.filter(F.pmod("key", F.lit(parts)) == part) if parts > 1 else own
        placed = own.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        beside = F.when(F.col("id") != F.col("pivot"), F.col("component"))
        placed = placed.select("key", "id", "pivot", "component", main.alias("main"), F.min(beside).over(whole).alias("low"), F.max(beside).over(whole).alias("high"))
        placed = placed.filter("id <> pivot and low <> high").drop("pivot", "low", "high")
        if once:
            placed = placed.withColumns({f"before{k}": F.lag("key", k).over(before) for k in (1, 2)})
        tight = common.store(tighten(placed), f"{name}-tight")
        sides = lambda x: [F.col("id").alias(x), F.col("component").alias(f"c{x}"), F.col("load").alias(f"l{x}"), *[F.col(f"before{k}").alias(f"{x}{k}") for k in (1, 2) if once]]
        apart = tight.filter("component <> main").select("key", *sides("b"))
        others = tight.select("key", *sides("a"), (F.col("component") == F.col("main")).alias("in_main"))
        # The first key that two ids share has no shared one before it, so every pair is made for some key.
        again = reduce(or_, (F.coalesce(F.col(f"a{i}") == F.col(f"b{j}"), F.lit(False)) for i in (1, 2) for j in (1, 2))) if once else F.lit(False)
        rest = apart.join(others, (apart["key"] == others["key"]) & (F.col("ca") != F.col("cb")) & (F.col("in_main") | (F.col("a") < F.col("b"))) & ~again & fits(F.col("la"), F.col("lb")))
        rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if part < parts - 1:
            rest = common.store(rest, f"{name}-apart")
            common.discard(tight)
        else:
            tights.append(tight)
        rests.append(rest)
    rest = reduce(DataFrame.unionByName, rests)
    # Pairs with a pivot have been checked.
    rest = (rest.distinct() if parts > 1 else rest).join(star, ["a", "b"], "left_anti")
    stars = found.filter("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))
    more = check(rest, f"{name}-rest")
    common.discard(star, *tights, *rests[:-1])
    return stars.unionByName(more)
