"""Rankings, cross-tabs, presence matrices and daily series.

Group counts are aggregated on the map side; a window never ranges over more than the aggregated groups. Ties are
broken by name, so that a ranking does not depend on the order of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import percent

UNKNOWN = "Não informado"


def named(c: Column, label: str = UNKNOWN) -> Column:
    """A label for null and empty names."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(label)).otherwise(c)


def ranking(df: DataFrame, by: Column, name: str = "name", top: int | None = None, fold_case: bool = False) -> DataFrame:
    """(position, name, n, pct) of the groups of ``by``; shares are of all rows, also where only ``top`` are kept."""
    counts = df.groupBy(by.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    ties = F.lower(F.col(name)) if fold_case else F.col(name)
    if top is not None:  # only so many rows are numbered, and only their sum is taken of all
        total = counts.agg(F.sum("n").alias("_total"))
        counts = counts.orderBy(F.desc("n"), ties).limit(top).crossJoin(F.broadcast(total))  # one row
    else:
        counts = counts.withColumn("_total", F.sum("n").over(Window.partitionBy()))
    order = Window.orderBy(F.desc("n"), ties)
    return counts.select(F.row_number().over(order).cast("long").alias("position"), name, "n", percent(F.col("n"), F.col("_total")).alias("pct"))


def vocabulary_ranking(df: DataFrame, by: Column, order: list[str], name: str = "name") -> DataFrame:
    """Counts in the order of a vocabulary; names outside of it come last by name, names without rows are left out."""
    counts = df.groupBy(by.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    place = F.coalesce(*[F.when(F.col(name) == v, i) for i, v in enumerate(order)], F.lit(len(order)))
    window = Window.orderBy(place, name)
    return counts.select(F.row_number().over(window).cast("long").alias("position"), name, "n", percent(F.col("n"), F.sum("n").over(Window.partitionBy())).alias("pct"))


def top_per_group(df: DataFrame, group: str, item: str, top: int) -> DataFrame:
    """(group, position, item, n): the ``top`` most frequent items of each group."""
    counts = df.groupBy(group, item).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(group).orderBy(F.desc("n"), item)
    return counts.withColumn("position", F.row_number().over(order).cast("long")).filter(F.col("position") <= top)


def first_per_group(df: DataFrame, group: str, order: list[Column], top: int) -> DataFrame:
    """The first ``top`` rows of each group in the given order, with their position."""
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("position", F.row_number().over(window).cast("long")).filter(F.col("position") <= top)


def cross_tab(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """Counts of the pairs, one column for each of ``values``; 0 where a pair is missing."""
    out = df.groupBy(rows).agg(*[F.count(F.when(F.col(columns) == v, 1)).alias(v) for v in values])
    return out


def item_ranking_with_zero(items: DataFrame, links: DataFrame, id_col: str, name: str, total_rows: DataFrame, row_id: str) -> DataFrame:
    """All items with the number of rows that mention them, also none, and two shares.

    pct_all is of all rows, pct_linked of the rows that mention any item.
    """
    counts = links.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    bases = total_rows.agg(F.count(F.lit(1)).alias("rows")).crossJoin(links.agg(F.countDistinct(row_id).alias("linked")))
    full = items.join(counts, id_col, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ranked = full.groupBy(name).agg(F.sum("n").alias("n")).crossJoin(F.broadcast(bases))  # bases: one row
    order = Window.orderBy(F.desc("n"), name)
    return ranked.select(
        F.row_number().over(order).cast("long").alias("position"), name, "n",
        percent(F.col("n"), F.col("rows")).alias("pct_all"), percent(F.col("n"), F.col("linked")).alias("pct_linked"),
    )


def area_items(rows: DataFrame, links: DataFrame, items: DataFrame, row_id: str, area: str, id_col: str, name: str) -> DataFrame:
    """(area, item, n, total, linked, pct): one pass over all areas instead of one query for each.

    total counts the rows of an area, linked those with any item; the share is of the linked ones.
    """
    totals = rows.groupBy(area).agg(F.count(F.lit(1)).alias("total"))
    # Links are distinct, so a row meets each of its items once.
    met = rows.select(row_id, area).join(links, row_id).join(items.select(id_col, name), id_col)
    linked = met.select(row_id, area).distinct().groupBy(area).agg(F.count(F.lit(1)).alias("linked"))
    counts = met.select(row_id, area, name).distinct().groupBy(area, name).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(totals, area).join(linked, area).withColumn("pct", percent(F.col("n"), F.col("linked")))


def presence(counts: DataFrame, totals: DataFrame, area: str, item: str, top: int | None = None) -> DataFrame:
    """(item, mean_pct, areas, n): the mean over all areas of an item's share of each area, absent areas as 0.

    ``top`` keeps the items with most rows; they are ordered by their mean share.
    """
    n_areas = totals.agg(F.count(F.lit(1)).alias("n_areas"))
    shares = counts.join(totals, area).groupBy(item).agg(
        F.sum(100.0 * F.col("n") / F.col("total")).alias("sum_pct"), F.count(F.lit(1)).alias("areas"), F.sum("n").alias("n"),
    )
    out = shares.crossJoin(F.broadcast(n_areas)).select(item, F.round(F.col("sum_pct") / F.col("n_areas"), 6).alias("mean_pct"), "areas", "n")
    if top is not None:
        out = out.orderBy(F.desc("n"), F.lower(item)).limit(top)
    return out


def area_item_matrix(counts: DataFrame, totals: DataFrame, area: str, item: str, top_areas: int, top_items: int) -> DataFrame:
    """(area, item, n, pct) for the largest areas and the most frequent items, zero where they do not meet."""
    best_areas = totals.orderBy(F.desc("total"), F.lower(area)).limit(top_areas)
    best_items = counts.groupBy(item).agg(F.sum("n").alias("_all")).orderBy(F.desc("_all"), F.lower(item)).limit(top_items).select(item)
    grid = best_areas.crossJoin(F.broadcast(best_items))  # top_areas times top_items rows
    full = grid.join(counts.select(area, item, "n"), [area, item], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return full.select(area, item, "n", percent(F.col("n"), F.col("total")).alias("pct"))


def daily_activity(rows: DataFrame, items: DataFrame, day: str, item: str, days: int, reference: Column) -> DataFrame:
    """(day, n, items) for the ``days`` days up to the last one that is not after ``reference``; zero where none."""
    last = rows.filter(F.col(day) <= reference).agg(F.max(day).alias("_last"))
    spine = last.filter("_last is not null").select(F.explode(F.sequence(F.date_sub("_last", days - 1), F.col("_last"))).alias(day))
    counts = rows.groupBy(day).agg(F.count(F.lit(1)).alias("n"))
    kinds = items.groupBy(day).agg(F.countDistinct(item).alias("items"))
    return spine.join(counts, day, "left").join(kinds, day, "left").select(day, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("items", F.lit(0)).alias("items"))


def micro_f1(true: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """tp, fp, fn and f1 of two label sets, each row once."""
    a, b = true.select(*keys).distinct().withColumn("_t", F.lit(1)), found.select(*keys).distinct().withColumn("_f", F.lit(1))
    both = a.join(b, keys, "full")
    count = lambda c: F.count(F.when(c, 1))
    out = both.agg(
        count(F.col("_t").isNotNull() & F.col("_f").isNotNull()).alias("tp"), count(F.col("_t").isNull()).alias("fp"), count(F.col("_f").isNull()).alias("fn")
    )
    return out.withColumn("f1", F.when(F.col("tp") + F.col("fp") + F.col("fn") == 0, 0.0).otherwise(F.round(2.0 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn")), 6)))


def _begins(word: str):
    return lambda t: F.startswith(t, F.lit(word))


def explorer_search(df: DataFrame, query: str, tokens: Column, equal: dict[str, object] | None = None) -> DataFrame:
    """Rows in which every word of ``query`` begins some token, and the given columns have the given values."""
    out = df
    for word in query.lower().split():
        out = out.filter(F.size(F.filter(tokens, _begins(word))) > 0)
    for name, value in (equal or {}).items():
        out = out.filter(F.col(name) == value)
    return out
