"""Phrases of rules found in normalised texts, by hash joins on word n-grams instead of regular expressions.

On normalised text a phrase is held as a whole exactly if its words are an n-gram of the text. Texts are turned to
n-grams of the lengths of phrases, where the first word is one of some phrase, and those are joined with the rule
table, which is broadcast after it is counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RULES = 200_000
#: Up to so many different first words, places where no rule begins are left out before n-grams are made.
MAX_FIRST = 5_000


def rule_table(spark: SparkSession, rows: list[tuple[str, str, int, float, str, bool]]) -> DataFrame:
    """(owner, gram, rank, weight, phrase, title_only) from rules, empty phrases left out."""
    kept = [r for r in rows if r[1]]
    return spark.createDataFrame(kept, "owner string, gram string, rank int, weight double, phrase string, title_only boolean")


def grams(words: Column, lengths: dict[int, list[str]] | int) -> Column:
    """array<struct(start, stop, gram)> of the runs of words, with word positions.

    ``lengths`` is the longest run, or gives for each length the words that a run of it can begin with. ``words`` must
    be a column of the child and no expression: it is read at every position.
    """
    last = F.size(words) - 1

    def runs(n: int, first: list[str] | None) -> Column:
        at = F.when(last >= n - 1, F.sequence(F.lit(0), last - (n - 1))).otherwise(F.array().cast("array<int>"))
        if first is not None:
            at = F.filter(at, lambda i: F.get(words, i).isin(first))
        return F.transform(at, lambda i: F.struct(i.alias("start"), (i + n).alias("stop"), F.array_join(F.slice(words, i + 1, n), " ").alias("gram")))

    each = {n: None for n in range(1, lengths + 1)} if isinstance(lengths, int) else lengths
    return F.concat(*[runs(n, first) for n, first in each.items()])


def _beginnings(rules: DataFrame) -> dict[int, list[str]] | int:
    """What ``grams`` needs to make only runs that some rule can equal."""
    words = F.split("gram", " ")
    found = rules.select(F.size(words).alias("n"), words[0].alias("first")).distinct().limit(MAX_FIRST + 1).collect()  # bounded
    if len(found) > MAX_FIRST:
        return rules.agg(F.max(F.size(words))).first()[0]
    lengths: dict[int, list[str]] = {}
    for r in found:
        lengths.setdefault(r["n"], []).append(r["first"])
    return dict(sorted(lengths.items())) or 1


def _tagged(part: str):
    return lambda g: F.struct(F.lit(part).alias("part"), g["start"].alias("start"), g["stop"].alias("stop"), g["gram"].alias("gram"))


def hits(df: DataFrame, key: list[str], parts: dict[str, Column], rules: DataFrame) -> DataFrame:
    """(key..., part, start, stop, owner, rank, weight, phrase, title_only) for every place where a rule is held."""
    small = F.broadcast(rules) if rules.count() <= MAX_RULES else rules
    lengths = _beginnings(rules)
    rows = df.select(*key, *[F.array_remove(F.split(text, " "), "").alias(f"_{p}") for p, text in parts.items()])
    tagged = [F.transform(grams(F.col(f"_{p}"), lengths), _tagged(p)) for p in parts]
    return rows.select(*key, F.explode(F.concat(*tagged)).alias("g")).select(*key, "g.*").join(small, "gram").drop("gram")


def phrase_match(df: DataFrame, key: list[str], text: Column, rules: DataFrame) -> DataFrame:
    """Distinct (key..., owner) of which the text holds some phrase."""
    return hits(df, key, {"text": text}, rules).select(*key, "owner").distinct()


def required_signal_filter(df: DataFrame, key: list[str], term: str, text: Column, signals: DataFrame) -> DataFrame:
    """Rows whose term needs no signal, or whose text holds one of the term's; ``signals`` has (owner: term, gram)."""
    found = phrase_match(df.select(*key, term, text.alias("_t")), [*key, term], F.col("_t"), signals).filter(F.col("owner") == F.col(term))
    needs = signals.select(F.col("owner").alias(term)).distinct()
    needs = F.broadcast(needs) if needs.count() <= MAX_RULES else needs
    return df.join(needs, term, "left_anti").unionByName(df.join(needs, term, "left_semi").join(found.select(*key).distinct(), key, "left_semi"))
