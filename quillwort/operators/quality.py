"""Quality rules over a batch and its history. Alerts are rows (rule, severity, source, value, limit)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.workplace import ORDER, UNKNOWN

# Thresholds of the rules, and sources whose volume says nothing.
VOLATILE = ["abler", "recrutei"]
DROP_RATIO, FALLBACK_SHARE, FALLBACK_MIN, COMPANY_SHARE, COMPANY_MIN, MAX_AGE_HOURS = 0.10, 0.55, 50, 0.20, 20, 24.0
ALERT = ["rule", "severity", "source", "value", "limit"]


def _alert(df: DataFrame, rule: str, severity: str, value: Column, limit: Column, source: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), (F.lit("") if source is None else source).alias("source"),
        value.cast("double").alias("value"), limit.cast("double").alias("limit"),
    )


def assess(jobs: DataFrame, stats: DataFrame, full: bool, today: Column, fallback: str = "Outros/TI Geral") -> DataFrame:
    """The alerts of one batch: one pass over the postings, one over its groups by source, one over the statistics.

    ``jobs`` has source, company, url, workplace, published (text) and area; ``stats`` source, raw and errors.
    """
    date = F.to_date(F.try_to_timestamp(F.substring("published", 1, 10), F.lit("yyyy-MM-dd")))
    bad_url = (F.coalesce("url", F.lit("")) != "") & ~F.lower("url").rlike("^https?://")
    total = jobs.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(~F.coalesce("workplace", F.lit(UNKNOWN)).isin(ORDER), 1)).alias("workplaces"),
        F.count(F.when(bad_url, 1)).alias("urls"), F.count(F.when(date > today, 1)).alias("future"), F.count(F.when(F.col("area") == fallback, 1)).alias("fallback"),
    )
    zero, share = F.lit(0), F.col("fallback") / F.greatest(F.col("n"), F.lit(1))
    parts = [
        _alert(total.filter("workplaces > 0"), "invalid_workplace", "high", F.col("workplaces"), zero),
        _alert(total.filter("urls > 0"), "invalid_url", "warning", F.col("urls"), zero),
        _alert(total.filter("future > 0"), "future_date", "warning", F.col("future"), zero),
        _alert(total.filter((F.col("n") >= FALLBACK_MIN) & (share > FALLBACK_SHARE)), "degenerated_classification", "warning", F.round(share, 3), F.lit(FALLBACK_SHARE)),
    ]
    missing = jobs.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.trim(F.coalesce("company", F.lit(""))) == "", 1)).alias("none"))
    gap = F.col("none") / F.col("n")
    parts.append(_alert(missing.filter((F.col("n") >= COMPANY_MIN) & (gap > COMPANY_SHARE)), "missing_company", "warning", F.round(gap, 3), F.lit(COMPANY_SHARE), F.col("source")))
    failed = stats.filter(F.size("errors") > 0)
    parts.append(_alert(failed, "source_errors", "warning", F.size("errors"), zero, F.col("source")))
    parts.append(_alert(failed.agg(F.count(F.lit(1)).alias("n")).filter("n > 0"), "partial_collection", "warning", F.col("n"), zero))
    if full:
        parts.append(_alert(total.filter("n = 0"), "collection_empty", "high", zero, zero))
        quiet = stats.filter((F.col("raw") == 0) & (F.size("errors") == 0) & ~F.col("source").isin(VOLATILE))
        parts.append(_alert(quiet, "source_empty", "high", zero, zero, F.col("source")))
    return reduce(DataFrame.unionByName, parts)


def sharp_drops(current: DataFrame, history: DataFrame, before: Column, volatile: list[str] | None = None) -> DataFrame:
    """Sources far below their last comparable run: the newest before ``before`` with the same profile and no errors.

    Both tables have source, profile, raw and errors; the history also ts. The latest run is an aggregate, not a
    join of all earlier runs.
    """
    fine = (F.size("errors") == 0) & ~F.col("source").isin(VOLATILE if volatile is None else volatile)
    last = history.filter(fine & (F.col("ts") < before)).groupBy("source", "profile").agg(F.max_by("raw", "ts").alias("reference"))
    met = current.filter(fine).alias("c").join(last.alias("l"), (F.col("c.source") == F.col("l.source")) & F.col("c.profile").eqNullSafe(F.col("l.profile")))
    low = met.filter((F.col("reference") > 0) & (F.col("raw") < F.col("reference") * DROP_RATIO))
    return _alert(low.select("c.source", "raw", "reference"), "sharp_drop", "high", F.col("raw"), F.col("reference") * DROP_RATIO, F.col("source"))


def affected_sources(stats: DataFrame, alerts: DataFrame) -> DataFrame:
    """Sources with errors or with an anomaly of volume."""
    odd = alerts.filter("severity = 'high' and source <> '' and rule in ('source_empty', 'sharp_drop')")
    return stats.filter(F.size("errors") > 0).select("source").union(odd.select("source")).distinct()


def verdict(alerts: DataFrame) -> DataFrame:
    """(high, blocking): whether there are grave alerts, and such that must stop publishing at once."""
    odd = (F.col("source") != "") & F.col("rule").isin("source_empty", "sharp_drop")
    grave = F.col("severity") == "high"
    return alerts.agg(F.coalesce(F.bool_or(grave), F.lit(False)).alias("high"), F.coalesce(F.bool_or(grave & ~odd), F.lit(False)).alias("blocking"))


def freshness(history: DataFrame, now: Column, max_hours: float = MAX_AGE_HOURS) -> DataFrame:
    """(status, age_hours) by the last full run: current, stale or no_history."""
    last = history.filter("full").agg(F.max("ts").alias("ts"))
    age = F.round((F.unix_timestamp(now) - F.unix_timestamp("ts")) / 3600.0, 2)
    return last.select(F.when(F.col("ts").isNull(), "no_history").when(age <= max_hours, "current").otherwise("stale").alias("status"), age.alias("age_hours"))


def enrichment_summary(outcomes: DataFrame) -> DataFrame:
    """Counters per source, and the reasons with their counts as a map."""
    count = lambda s: F.count(F.when(F.col("outcome") == s, 1)).alias(s)
    sums = outcomes.groupBy("source").agg(F.count(F.lit(1)).alias("selected"), *[count(s) for s in ("enriched", "closed", "removed", "pending")])
    reasons = outcomes.filter("reason is not null").groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))
    maps = reasons.groupBy("source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("reasons"))
    return sums.join(maps, "source", "left")


def history_window(history: DataFrame, n: int) -> DataFrame:
    """The latest ``n`` runs."""
    return history.orderBy(F.desc("ts")).limit(n)



