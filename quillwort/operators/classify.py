"""Areas of postings by weighted phrases, the gate for technical postings, levels, and hubs."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.workplace import REMOTE, UNKNOWN
from ..functions.text import bound, holds_phrase, normalize, normalize_level, padded
from . import phrases

SCORE = "struct<area:string,score:double,matches:array<string>,title_score:double,title_strong:boolean>"


@dataclass
class AreaRules:
    """What ``classify`` goes by; read from a rule file with ``from_dict``."""

    areas: dict[str, list[tuple[str, float]]]  # phrases with their weights, in the order of the file
    strong: float = 4.0
    title_boost: float = 3.0
    min_score: float = 3.0
    fallback: str = "Outros/TI Geral"
    gate_title: list[str] = field(default_factory=list)
    gate_body: list[str] = field(default_factory=list)
    exclude: list[str] = field(default_factory=list)
    exclude_pairs: list[tuple[list[str], list[str]]] = field(default_factory=list)
    overrides: list[tuple[str, list[str], list[str]]] = field(default_factory=list)
    # Areas with rules of their own.
    generic: tuple[str, ...] = ("Engenharia de Software", "Suporte Técnico")
    developer: tuple[str, ...] = ("Engenharia de Software",)
    support: str = "Suporte Técnico"
    support_areas: tuple[str, ...] = ("Suporte Técnico", "Service Desk / Help Desk")
    network: str = "Infraestrutura / Redes"
    stacks: tuple[str, ...] = ("Backend", "Frontend", "Fullstack", "Mobile", "Data", "Inteligência Artificial", "DevOps", "QA")
    generic_titles: tuple[str, ...] = ("analista de sistemas", "analise de sistemas", "analista de desenvolvimento", "analista desenvolvedor")
    support_titles: tuple[str, ...] = ("sustentacao de sistemas", "sustentacao de aplicacoes")

    @classmethod
    def from_dict(cls, rules: dict) -> AreaRules:
        """From the parsed rule file: settings, weights, tech_gate, areas and contexts."""
        weights = {k: float(v) for k, v in (rules.get("weights") or {}).items()}
        settings, gate = rules.get("settings") or {}, rules.get("tech_gate") or {}
        gate = {"titulo": gate, "descricao": gate} if isinstance(gate, list) else gate
        areas = {
            area: [(kw, weights.get(tier, 1.0)) for tier, words in (tiers or {}).items() for kw in words or []]
            for area, tiers in (rules.get("areas") or {}).items()
        }
        pairs = [(p["titulo"], p["descricao"]) for p in rules.get("excluir_contextos") or gate.get("excluir_contextos") or []]
        return cls(
            areas, weights.get("peso_alto", 4.0), float(settings.get("title_boost", 3.0)), float(settings.get("min_score", 1.0)),
            settings.get("fallback_area", "Outros/TI Geral"), gate.get("titulo") or [], gate.get("descricao") or [],
            gate.get("excluir") or [], pairs, [(r["area"], r["titulo"], r["descricao"]) for r in rules.get("classificar_contextos") or []],
        )

    def strong_phrases(self) -> list[str]:
        return [kw for words in self.areas.values() for kw, w in words if w >= self.strong]

    def table(self, spark: SparkSession) -> DataFrame:
        """The scoring rules: within an area longer phrases first; the support titles come last, for titles only."""
        rows = []
        for area, words in self.areas.items():
            plain = [(_norm(kw), w, kw) for kw, w in words]
            plain.sort(key=lambda x: -len(x[0]))
            rows += [(area, gram, i, w, kw, False) for i, (gram, w, kw) in enumerate(plain)]
            if area == self.support:
                last = sorted(self.support_titles, key=len, reverse=True)
                rows += [(area, _norm(kw), len(plain) + i, self.strong, kw, True) for i, kw in enumerate(last)]
        return phrases.rule_table(spark, rows)


def _norm(phrase: str) -> str:
    """``normalize`` for a phrase of a rule, on the driver."""
    import unicodedata

    text = "".join(c for c in unicodedata.normalize("NFKD", phrase) if not unicodedata.combining(c)).lower()
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in text).split())


def any_phrase(text: Column, words: list[str]) -> Column:
    """Whether padded text holds any of the phrases; the text is made once for all of them."""
    return bound(text, lambda t: reduce(lambda a, b: a | b, [holds_phrase(t, _norm(w)) for w in words], F.lit(False)))


def is_excluded(title: Column, description: Column, rules: AreaRules) -> Column:
    """Whether the title alone, or title and description together, put a posting out of scope."""
    t, b = padded(normalize(title)), padded(normalize(description))
    pairs = [any_phrase(t, heads) & any_phrase(b, bodies) for heads, bodies in rules.exclude_pairs]
    return reduce(lambda x, y: x | y, pairs, any_phrase(t, rules.exclude))


def is_tech(title: Column, description: Column, rules: AreaRules) -> Column:
    """The gate: broad signs count in the title, strict ones in the description, strong phrases in either."""
    t, b = padded(normalize(title)), padded(normalize(description))
    strong = rules.strong_phrases()
    sign = any_phrase(t, [*rules.gate_title, *rules.support_titles, *strong]) | any_phrase(b, [*rules.gate_body, *strong])
    return ~is_excluded(title, description, rules) & sign


def _fold(cands: Column, boost: float, strong: float) -> Column:
    """The score of one area from its hits in order: a rule scores once, at its first place that lies in no used one."""
    start = F.struct(
        F.array().cast("array<int>").alias("done"), F.array().cast("array<struct<part:string,start:int,stop:int>>").alias("used"),
        F.lit(0.0).alias("total"), F.lit(0.0).alias("title"), F.lit(False).alias("strong"), F.array().cast("array<string>").alias("matches"),
    )

    def step(a: Column, c: Column) -> Column:
        in_title = c["part"] == "0title"
        taken = F.exists(a["used"], lambda u: (u["part"] == c["part"]) & (u["start"] <= c["start"]) & (c["stop"] <= u["stop"]))
        skip = F.array_contains(a["done"], c["rank"]) | taken | (c["title_only"] & ~in_title)
        points = c["weight"] * F.when(in_title, boost).otherwise(1.0)
        return F.when(skip, a).otherwise(F.struct(
            F.array_append(a["done"], c["rank"]).alias("done"),
            F.array_append(a["used"], F.struct(c["part"].alias("part"), c["start"].alias("start"), c["stop"].alias("stop"))).alias("used"),
            (a["total"] + points).alias("total"), (a["title"] + F.when(in_title, points).otherwise(0.0)).alias("title"),
            (a["strong"] | (in_title & (c["weight"] >= strong))).alias("strong"),
            F.array_append(a["matches"], F.concat(c["phrase"], F.when(in_title, "(t)").otherwise(""))).alias("matches"),
        ))

    return F.aggregate(cands, start, step)


def area_scores(df: DataFrame, key: str, title: str, description: str, rules: AreaRules) -> DataFrame:
    """(key, area, score, title_score, title_strong, matches) of every area with points, for every posting."""
    parts = {"0title": normalize(F.col(title)), "1body": normalize(F.col(description))}
    found = phrases.hits(df, [key], parts, rules.table(df.sparkSession))
    # Within a rule, places in the title come before those in the body, each from left to right.
    cands = found.groupBy(key, "owner").agg(F.array_sort(F.collect_list(F.struct("rank", "part", "start", "stop", "weight", "phrase", "title_only"))).alias("c"))
    got = cands.select(key, F.col("owner").alias("area"), _fold(F.col("c"), rules.title_boost, rules.strong).alias("s")).filter("s.total > 0")
    return got.select(key, "area", F.round("s.total", 2).alias("score"), F.round("s.title", 2).alias("title_score"), F.col("s.strong").alias("title_strong"), F.col("s.matches").alias("matches"))


def classify(df: DataFrame, key: str, title: str, description: str, rules: AreaRules) -> DataFrame:
    """``df`` with area, area_score and area_matches.

    Areas are ranked by score, then by the length of their evidence, then by name. An override by description goes
    first. If titles give areas more than the minimum, only these compete, and of them one with a strong phrase in
    the title goes before the generic ones. Support for infrastructure, and support disguised by a generic title,
    are told apart at the end. Without enough points the fallback area is left.
    """
    scores = area_scores(df, key, title, description, rules)
    length = F.aggregate("matches", F.lit(0), lambda a, m: a + F.length(m))
    order = F.struct((-F.col("score")).alias("o1"), (-length).alias("o2"), F.col("area").alias("o3"))
    made = F.struct("area", "score", "matches", "title_score", "title_strong")
    ranked = scores.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), made.alias("s")))), lambda x: x["s"]).alias("_r"))
    head, body = normalize(F.col(title)), normalize(F.col(description))
    t, b, r = padded(head), padded(body), F.coalesce(F.col("_r"), F.array().cast(f"array<{SCORE}>"))
    first = lambda a, keep: F.get(F.filter(a, keep), F.lit(0))
    plain = lambda area, score, matches: F.struct(F.lit(area).alias("area"), score.alias("score"), matches.alias("matches"), F.lit(0.0).alias("title_score"), F.lit(False).alias("title_strong"))

    titled = F.filter(r, lambda x: x["title_score"] > rules.min_score)
    pool = F.when(F.size(titled) > 0, titled).otherwise(r)
    special = first(pool, lambda x: x["title_strong"] & ~x["area"].isin(*rules.generic))
    best = F.when(F.size(pool) > 1, F.coalesce(special, F.get(pool, F.lit(0)))).otherwise(F.get(pool, F.lit(0)))

    in_title = lambda m: F.endswith(m, F.lit("(t)"))
    developer = first(r, lambda x: x["area"].isin(*rules.developer))
    heads = F.transform(F.filter(developer["matches"], in_title), lambda m: F.regexp_replace(m, r"\(t\)$", ""))
    by_title = (F.size(heads) > 0) & (F.size(F.array_except(heads, F.array(*map(F.lit, rules.generic_titles)))) == 0)
    by_support = head.contains("analista de sustentacao") | reduce(lambda x, y: x | y, [head.contains(s) for s in rules.support_titles])
    guard = F.exists(r, lambda x: x["area"].isin(*rules.stacks) & (F.size(F.filter(x["matches"], lambda m: ~in_title(m))) >= 2))
    helpers = F.filter(r, lambda x: x["area"].isin(*rules.support_areas))
    signs = F.array_sort(F.array_distinct(F.flatten(F.transform(helpers, lambda x: F.filter(x["matches"], lambda m: ~in_title(m))))))
    disguised = developer.isNotNull() & (by_title | by_support) & ~(by_title & guard) & (by_support | (F.size(signs) >= 3))
    helped = F.round(F.aggregate(helpers, F.lit(0.0), lambda a, x: a + x["score"]), 2)

    network = F.coalesce(first(r, lambda x: x["area"] == rules.network), plain(rules.network, F.lit(4.0), F.array(F.lit("infraestrutura"))))
    nothing = plain(rules.fallback, F.lit(0.0), F.array().cast("array<string>"))
    decided = (
        F.when(best.isNull() | (best["score"] < rules.min_score), nothing)
        .when((best["area"] == rules.support) & head.contains("infraestrutura"), network)
        .when(best["area"].isin(*rules.developer) & F.coalesce(disguised, F.lit(False)), plain(rules.support, helped, signs)).otherwise(best)
    )
    for area, heads_, evidence in reversed(rules.overrides):
        held = any_phrase(t, heads_) & reduce(lambda x, y: x & y, [holds_phrase(b, _norm(w)) for w in evidence], F.lit(bool(evidence)))
        decided = F.when(held, plain(area, F.lit(rules.strong * len(evidence)), F.array(*map(F.lit, evidence)))).otherwise(decided)
    out = df.join(ranked, key, "left").withColumn("_d", decided)
    return out.drop("_r", "area", "area_score", "area_matches").select(
        "*", F.col("_d.area").alias("area"), F.col("_d.score").alias("area_score"), F.array_join(F.slice("_d.matches", 1, 12), ", ").alias("area_matches")
    ).drop("_d")


@dataclass
class LevelRules:
    """Patterns of levels, by label and kind; ``from_dict`` reads the rule file."""

    include: dict[str, list[str]]
    above: list[str] = field(default_factory=list)
    exclude: list[str] = field(default_factory=list)
    body_above: list[str] = field(default_factory=list)
    inferred: list[str] = field(default_factory=list)
    junior: str = "Júnior"

    @classmethod
    def from_dict(cls, rules: dict) -> LevelRules:
        return cls(rules.get("include") or {}, rules.get("acima_explicito") or [], rules.get("exclude") or [], rules.get("descricao_acima") or [], rules.get("inferir_junior") or [])


def _any(text: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.rlike(p) for p in patterns], F.lit(False))


def explicit_level(text: Column, rules: LevelRules) -> Column:
    """The first label of which a pattern is in the normalised title, or null."""
    return F.coalesce(*[F.when(_any(text, p), F.lit(label)) for label, p in rules.include.items()], F.lit(None).cast("string"))


def senior_signal(title: Column, rules: LevelRules) -> Column:
    return _any(normalize_level(title), [*rules.above, *rules.exclude])


def level(title: Column, rules: LevelRules, strict: bool = False) -> Column:
    """The entry level that a title tells, or null: an explicit one, else one inferred unless a higher one is named."""
    text = normalize_level(title)
    out = F.coalesce(explicit_level(text, rules), F.when(~_any(text, rules.above) & _any(text, rules.inferred), F.lit(rules.junior)))
    return F.when(~senior_signal(title, rules), out) if strict else out


def blocks_entry(title: Column, description: Column, rules: LevelRules) -> Column:
    """Whether a higher level is named: in the title without an entry level, or in the description."""
    text = normalize_level(title)
    return (_any(text, rules.above) & explicit_level(text, rules).isNull()) | _any(normalize_level(description), rules.body_above)


def entry_level(df: DataFrame, rules: LevelRules, strict: bool = False) -> DataFrame:
    """Postings of an entry level, ``seniority`` set: by title, else by the source's label, else inferred."""
    title, own = F.col("title"), F.coalesce(F.col("seniority"), F.lit(""))
    blocked = blocks_entry(title, F.col("description"), rules)
    if strict:
        blocked = blocked | senior_signal(title, rules)
    own = F.when(own != "", F.coalesce(level(own, rules, strict), own))
    got = F.coalesce(explicit_level(normalize_level(title), rules), own, level(title, rules, strict))
    return df.filter(~blocked).withColumn("seniority", got).filter("seniority is not null")


@dataclass
class PlaceRules:
    """Aliases of hubs with their region, and regions of states."""

    aliases: list[tuple[str, str, str]]
    states: dict[str, str]

    @classmethod
    def from_dict(cls, rules: dict) -> PlaceRules:
        """Aliases in the order they are tried: longest escaped form first (a blank counts double), as listed on ties."""
        rows = [
            (_norm(a), hub.get("nome", ""), region)
            for region, hubs in (rules.get("regioes") or {}).items() for hub in hubs for a in [*(hub.get("aliases") or []), hub.get("nome", "")]
        ]
        rows = [r for r in rows if r[0]]
        rows.sort(key=lambda r: -(len(r[0]) + r[0].count(" ")))
        return cls(rows, rules.get("ufs_para_regioes") or {})


def hub_and_region(location: Column, workplace: Column, rules: PlaceRules) -> Column:
    """struct(hub, region): by the first alias held, else the first state code, else remote, national or unknown."""
    pair = lambda hub, region: F.struct(F.lit(hub).alias("hub"), F.lit(region).alias("region"))

    def found(text: Column) -> Column:
        tests = [(holds_phrase(text, a), pair(hub, region)) for a, hub, region in rules.aliases]
        tests += [(holds_phrase(text, s.lower()), pair(f"Estado/{s}", region)) for s, region in rules.states.items()]
        tests += [(F.lower(F.trim(F.coalesce(workplace, F.lit("")))) == REMOTE.lower(), pair("Remoto", "Remoto Nacional")), (text.rlike("brasil|brazil"), pair("Nacional", "Nacional"))]
        return F.coalesce(*[F.when(c, v) for c, v in tests], pair(UNKNOWN, UNKNOWN))

    return bound(padded(normalize(location)), found)
