"""Queries of the text operators: documents stand for postings, their first line for the title."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, links, numbers, places, text, workplace
from ..operators import classify as K
from ..operators import merge as M
from ..operators import phrases, quality, resolve, skills
from ..sources import portals
from ..streaming import ingest
from .reports import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def documents(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.col("text").alias("description"), F.split("text", "\n")[0].alias("title"), "lang", "source")


N = "trim(regexp_replace(regexp_replace(lower(strip_accents({c})), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"
D = "d AS (SELECT doc_id, text AS description, split_part(text, chr(10), 1) AS title, lang, source FROM documents), n AS (SELECT *, ' ' || " + N.format(c="description") + " || ' ' AS b, ' ' || " + N.format(c="title") + " || ' ' AS t FROM d)"

#: A small vocabulary of words that the corpus holds. Real rule files are a parameter of the operators.
AREAS = {
    "Data": [("that", 4.0), ("nt", 1.0), ("inen", 1.0)], "Backend": [("there", 4.0), ("des", 4.0), ("ment", 1.0)],
    "Mobile": [("der", 4.0), ("ung", 1.0)], "QA": [("los", 4.0), ("una", 1.0), ("sa", 1.0)],
}
RULES = K.AreaRules(AREAS, fallback="Outros", gate_title=["the", "le"], gate_body=["der"], exclude=["las"], exclude_pairs=[(["of"], ["worthless"])])
LEVELS = K.LevelRules({"Estágio": [r"\bis\b"], "Júnior": [r"\bund\b", r"\bare\b"]}, above=[r"\bof\b"], inferred=[r"\band\b"])
SKILLS = skills.SkillRules.from_dict({"common": {"Of": ["of the", "de la"], "In": ["in", "en"], "Und": ["und die"]}, "rare": {"Blend": ["blend"], "Worth": ["worthless", "stupid"]}})


@query(f"SELECT doc_id, {N.format(c='text')} AS norm FROM documents")
def normalize_text(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normalize(F.col("text")).alias("norm"))


@query(
    "SELECT page_id, trim(regexp_replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\\s+', ' ', 'g')) AS body FROM pages"
)
def strip_html(spark, d):
    return table(spark, d, "pages").select("page_id", text.strip_html(F.col("html")).alias("body"))


_HOST = "lower(regexp_extract(url, '^https?://([^/?#]*)', 1))"


@query(f"SELECT page_id, CASE WHEN len(p) < 2 THEN '' ELSE p[-2] || '.' || p[-1] END AS domain FROM (SELECT page_id, string_split({_HOST}, '.') AS p FROM pages)")
def registrable_domain(spark, d):
    host = F.regexp_extract("url", r"^https?://([^/?#]*)", 1)
    return table(spark, d, "pages").select("page_id", links.registrable_domain(host).alias("domain"))


_LINKS = [
    ("'https://www.site.com.br/vagas/' || (1000000 + page_id)", "'site.com.br:' || (1000000 + page_id)"),
    ("'https://x.example.com/job/' || (4000 + page_id % 900) || '/apply?u=1'", "'example.com:' || (4000 + page_id % 900)"),
    ("'https://jobs.example.org/a/' || md5(page_id::VARCHAR) || '/b'", "'example.org:' || md5(page_id::VARCHAR)"),
    ("'http://EXAMPLE.net/p/' || (70000 + page_id) || '-dev-junior'", "'example.net:' || (70000 + page_id)"),
    ("'ftp://example.net/7777777'", "''"),
    ("'https://example.net/0A1B2C3D-0000-4000-8000-00000000000' || (page_id % 10) || '/x'", "'uuid:0a1b2c3d-0000-4000-8000-00000000000' || (page_id % 10)"),
]


@query("SELECT page_id, CASE " + " ".join(f"WHEN page_id % 6 = {i} THEN {v}" for i, (_, v) in enumerate(_LINKS)) + " END AS identity FROM pages")
def link_identity(spark, d):
    """Ids carried by links of six forms."""
    p = F.col("page_id")
    forms = [
        F.concat(F.lit("https://www.site.com.br/vagas/"), p + 1000000), F.concat(F.lit("https://x.example.com/job/"), p % 900 + 4000, F.lit("/apply?u=1")),
        F.concat(F.lit("https://jobs.example.org/a/"), F.md5(p.cast("string").cast("binary")), F.lit("/b")), F.concat(F.lit("http://EXAMPLE.net/p/"), p + 70000, F.lit("-dev-junior")),
        F.lit("ftp://example.net/7777777"), F.concat(F.lit("https://example.net/0A1B2C3D-0000-4000-8000-00000000000"), p % 10, F.lit("/x")),
    ]
    url = reduce(lambda w, x: w.when(p % 6 == x[0], x[1]), list(enumerate(forms))[1:], F.when(p % 6 == 0, forms[0]))
    return table(spark, d, "pages").select("page_id", links.link_identity(url).alias("identity"))


def _cases(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """``df`` with one of the values for each row, by its key."""
    return df.withColumn("raw", F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int")))


def _expected(key: str, tbl: str, out: str, values: list[str]) -> str:
    quoted = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"SELECT {key}, ([{quoted}])[1 + CAST({key} % {len(values)} AS INT)] AS {out} FROM {tbl}"


_PLACES = {
    "São Paulo - SP": "São Paulo, SP", "Curitiba/Paraná": "Curitiba, PR", " Recife ,  pernambuco ": "Recife, PE", "Brasil": "Brasil", "rj": "RJ",
    "100% Remoto": "Remoto", "Campinas e região": "Campinas e Região", "Lisboa, Brasil": "Lisboa, Brasil", "Belo Horizonte, MG, Brazil": "Belo Horizonte, MG",
    "Santos a empresa aceita candidaturas de Santos e cidades próximas.": "Santos e Região", "": "",
}


@query(_expected("c_custkey", "customer", "place", list(_PLACES.values())))
def normalize_location(spark, d):
    return _cases(table(spark, d, "customer"), "c_custkey", list(_PLACES)).select("c_custkey", places.normalize_location(F.col("raw")).alias("place"))


_LABELS = {"On-site": "Presencial", "HÍBRIDO": "Híbrido", "Home Office (100%)": "Remoto", "remote": "Remoto", "Trabalho presencial": "Presencial", "?": "Não informado", "modelo hibrido": "Híbrido"}


@query(_expected("c_custkey", "customer", "workplace", list(_LABELS.values())))
def normalize_workplace(spark, d):
    return _cases(table(spark, d, "customer"), "c_custkey", list(_LABELS)).select("c_custkey", workplace.normalize_workplace(F.col("raw")).alias("workplace"))


_TEXTS = {
    "Vaga remota para desenvolver": "Remoto", "Modelo de trabalho presencial e remoto": "Híbrido", "Atuação 100% presencial em Recife": "Presencial",
    "Suporte remoto a clientes; regime presencial": "Presencial", "Nada dito": "Presencial", "Dias presenciais: terça": "Híbrido", "Home office ou in loco": "Presencial",
}


@query(_expected("c_custkey", "customer", "workplace", list(_TEXTS.values())))
def workplace_infer(spark, d):
    got = workplace.infer_workplace(F.lit(""), F.lit("Recife, PE"), F.lit("Analista"), F.col("raw"))
    return _cases(table(spark, d, "customer"), "c_custkey", list(_TEXTS)).select("c_custkey", got.alias("workplace"))


_DECLARED = {
    "Work model: Hybrid": "Híbrido", "Plataforma de nuvem híbrida": "Não informado", "Equipe híbrida e unida, ótimo clima": "Híbrido", "Modalidade: presencial": "Presencial", "Fully remote": "Remoto",
    "Kit home office": "Não informado", "Vai atuar presencialmente 3x": "Não informado", "Vai atuar presencialmente sempre": "Presencial", "A vaga é presencial": "Presencial", "3 dias presenciais e 2 dias home office": "Híbrido",
}


@query(_expected("c_custkey", "customer", "workplace", list(_DECLARED.values())))
def workplace_declared_source(spark, d):
    got = workplace.infer_declared(F.lit(""), F.lit(False), F.lit("Recife, PE"), F.lit("Analista"), F.col("raw"))
    return _cases(table(spark, d, "customer"), "c_custkey", list(_DECLARED)).select("c_custkey", got.alias("workplace"))


_DATES = {
    "2026-06-26T10:00:00Z": "2026-06-26", "09/07/2026": "2026-07-09", "Ontem": "2026-07-14", "anteontem": "2026-07-13", "Hoje": "2026-07-15", "Há 3 dias": "2026-07-12",
    "Publicada há mais de 2 meses": "2026-05-16", "há 20 horas": "2026-07-15", "31/02/2026": None, "2026-13-01": None, "sem data": None,
}


@query(_expected("c_custkey", "customer", "published", list(_DATES.values())))
def parse_published_date(spark, d):
    got = dates.published_date(F.col("raw"), F.lit("2026-07-15").cast("date"))
    return _cases(table(spark, d, "customer"), "c_custkey", list(_DATES)).select("c_custkey", got.cast("string").alias("published"))


_COMPANIES = {"A": "", "Empresa Confidencial2": "Confidencial", "Randstad (Matriz)": "Randstad", "Acme Ltda": "Acme Ltda", "minsait brasil": "Minsait"}


@query(_expected("c_custkey", "customer", "company", list(_COMPANIES.values())))
def canonical_company(spark, d):
    return _cases(table(spark, d, "customer"), "c_custkey", list(_COMPANIES)).select("c_custkey", text.canonical_company(F.col("raw")).alias("company"))


@query("SELECT p_partkey, replace(printf('%.1f', p_size / 4.0), '.', ',') || '%' AS shown, rpad(repeat('#', CAST(round_even(p_size / 100.0 * 20, 0) AS INT)), 20, '.') AS bar FROM part")
def number_formats(spark, d):
    return table(spark, d, "part").select("p_partkey", numbers.percent_text(F.col("p_size") / 4.0).alias("shown"), numbers.bar(F.col("p_size").cast("double")).alias("bar"))


@query("SELECT doc_id, CASE WHEN old <> '' AND (new = '' OR (length(old) >= 500 AND NOT ends_with(old, '...') AND (length(new) < 500 OR ends_with(new, '...')))) THEN old ELSE new END AS kept FROM (SELECT doc_id, text AS old, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN left(text, 400) ELSE left(text, 600) || '...' END AS new FROM documents)")
def description_policy(spark, d):
    docs = table(spark, d, "documents")
    new = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.substring("text", 1, 400)).otherwise(F.concat(F.substring("text", 1, 600), F.lit("...")))
    return docs.select("doc_id", text.consolidated(F.col("text"), new)["text"].alias("kept"))


_PHRASES = [("of the", "english"), ("that", "english"), ("de la", "romance"), ("und die", "german"), ("in", "several")]


@query(f"WITH {D} SELECT DISTINCT doc_id, owner FROM n, (VALUES " + ", ".join(f"(' {g} ', '{o}')" for g, o in _PHRASES) + ") v(gram, owner) WHERE contains(b, gram)")
def phrase_match(spark, d):
    rules = phrases.rule_table(spark, [(o, g, i, 1.0, g, False) for i, (g, o) in enumerate(_PHRASES)])
    return phrases.phrase_match(documents(spark, d), ["doc_id"], text.normalize(F.col("description")), rules)


@query(f"WITH {D} SELECT doc_id, lang FROM n WHERE lang NOT IN ('en', 'de') OR (lang = 'en' AND contains(b, ' of the ')) OR (lang = 'de' AND contains(b, ' und die '))")
def required_signal_filter(spark, d):
    signals = phrases.rule_table(spark, [("en", "of the", 0, 1.0, "of the", False), ("de", "und die", 1, 1.0, "und die", False)])
    docs = documents(spark, d)
    return phrases.required_signal_filter(docs, ["doc_id"], "lang", text.normalize(F.col("description")), signals).select("doc_id", "lang")


_KW = ", ".join(f"('{a}', ' {k} ', {w})" for a, ws in AREAS.items() for k, w in ws)
_SCORE = (
    f"WITH {D}, k AS (SELECT * FROM (VALUES {_KW}) v(area, kw, w)), h AS (SELECT doc_id, area, kw, CASE WHEN contains(t, kw) THEN 3.0 * w WHEN contains(b, kw) THEN w END AS s, "
    "CASE WHEN contains(t, kw) THEN 3.0 * w ELSE 0 END AS ts, contains(t, kw) AND w >= 4 AS strong, length(trim(kw)) + CASE WHEN contains(t, kw) THEN 3 ELSE 0 END AS len FROM n, k), "
    "a AS (SELECT doc_id, area, round(sum(s), 2)::DOUBLE AS score, round(sum(ts), 2)::DOUBLE AS title_score, bool_or(strong) AS title_strong, sum(len) AS len FROM h WHERE s IS NOT NULL GROUP BY ALL) "
)


@query(_SCORE + "SELECT doc_id, area, score, title_score, title_strong FROM a")
def area_score(spark, d):
    return K.area_scores(documents(spark, d), "doc_id", "title", "description", RULES).select("doc_id", "area", "score", "title_score", "title_strong")


@query(
    _SCORE + ", x AS (SELECT *, title_score > 3 AS titled, max(CASE WHEN title_score > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS any_titled FROM a), "
    "p AS (SELECT * FROM x WHERE titled OR any_titled = 0), y AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY title_strong DESC, score DESC, len DESC, area) AS r FROM p), "
    "z AS (SELECT doc_id, area, score FROM y WHERE r = 1 AND score >= 3) SELECT doc_id, coalesce(area, 'Outros') AS area, coalesce(score, 0.0) AS area_score FROM documents LEFT JOIN z USING (doc_id)"
)
def area_decision(spark, d):
    return K.classify(documents(spark, d), "doc_id", "title", "description", RULES).select("doc_id", "area", "area_score")


_GATE = (
    f"WITH {D}, g AS (SELECT doc_id, contains(t, ' las ') OR (contains(t, ' of ') AND contains(b, ' worthless ')) AS excluded, "
    "contains(t, ' the ') OR contains(t, ' le ') OR contains(b, ' der ') OR " + " OR ".join(f"contains({c}, ' {k} ')" for c in "tb" for ws in AREAS.values() for k, w in ws if w >= 4)
    + " OR contains(t, ' sustentacao de sistemas ') AS sign FROM n) "
)


@query(_GATE + "SELECT doc_id FROM g WHERE sign AND NOT excluded")
def tech_gate(spark, d):
    docs = documents(spark, d)
    return docs.filter(K.is_tech(F.col("title"), F.col("description"), RULES)).select("doc_id")


@query(_GATE + "SELECT doc_id FROM g WHERE NOT excluded")
def exclusion_filter(spark, d):
    docs = documents(spark, d)
    return docs.filter(~K.is_excluded(F.col("title"), F.col("description"), RULES)).select("doc_id")


@query("SELECT doc_id, lang FROM documents WHERE NOT (lang = 'de' AND source <> 'src0')")
def intermediary_antijoin(spark, d):
    """Postings that a selected native source has itself are not taken from others."""
    native = spark.createDataFrame([("de", "src0")], "company_key string, native string")
    docs = table(spark, d, "documents").withColumn("company", F.col("lang"))
    return portals.drop_intermediaries(docs, native, ["src0"]).select("doc_id", "lang")


_LEVEL = f"WITH {D}, e AS (SELECT doc_id, CASE WHEN contains(t, ' is ') THEN 'Estágio' WHEN contains(t, ' und ') OR contains(t, ' are ') THEN 'Júnior' END AS explicit, contains(t, ' of ') AS above, contains(t, ' and ') AS inferred FROM n) "


@query(_LEVEL + "SELECT doc_id, coalesce(explicit, CASE WHEN inferred AND NOT above THEN 'Júnior' END) AS level FROM e")
def seniority_label(spark, d):
    return documents(spark, d).select("doc_id", K.level(F.col("title"), LEVELS).alias("level"))


@query(_LEVEL + "SELECT doc_id, coalesce(explicit, CASE WHEN inferred THEN 'Júnior' END) AS seniority FROM e WHERE (explicit IS NOT NULL OR inferred) AND NOT (above AND explicit IS NULL)")
def entry_filter(spark, d):
    return K.entry_level(documents(spark, d).withColumn("seniority", F.lit("")), LEVELS).select("doc_id", "seniority")


@query("SELECT n_nationkey, CASE WHEN n_name LIKE '%A%' AND n_nationkey < 12 THEN n_name ELSE 'Estado/SP' END AS hub, CASE WHEN n_name LIKE '%A%' AND n_nationkey < 12 THEN 'Norte' ELSE 'Sudeste' END AS region FROM nation")
def geo_classify(spark, d):
    nations = table(spark, d, "nation")
    hubs = [r["n_name"] for r in nations.filter("n_name like '%A%' and n_nationkey < 12").collect()]  # at most 12 rows
    rules = K.PlaceRules.from_dict({"regioes": {"Norte": [{"nome": h, "aliases": []} for h in hubs]}, "ufs_para_regioes": {"SP": "Sudeste"}})
    got = nations.select("n_nationkey", K.hub_and_region(F.concat("n_name", F.lit(" - SP")), F.lit(""), rules).alias("g"))
    return got.select("n_nationkey", "g.hub", "g.region")




@query()
def skill_extract_whole(spark, d):
    """Skills of every document, those with mail addresses included."""
    docs = table(spark, d, "documents").select("doc_id", F.col("text").alias("description"), F.lit("").alias("title"))
    return skills.skill_mentions(docs, "doc_id", "title", "description", SKILLS)


def _jobs(spark: SparkSession, d: str) -> DataFrame:
    """Postings with repeated ids: every third document takes the id of another one."""
    docs = table(spark, d, "documents")
    return docs.select(
        F.col("doc_id").alias("ord"), F.col("lang").alias("source"), F.floor(F.col("doc_id") / 3).cast("string").alias("external_id"), F.split("text", "\n")[0].alias("title"),
        F.concat(F.lit("Company "), F.col("source")).alias("company"), F.lit("").alias("url"), F.col("text").alias("description"), F.lit("Recife, PE").alias("location"),
        F.lit("2026-06-01").alias("published_date"), F.when(F.col("doc_id") % 2 == 0, F.lit("")).otherwise(F.col("source")).alias("search_term"),
    )


@query(
    "WITH j AS (SELECT doc_id AS o, lang AS source, CAST(doc_id // 3 AS VARCHAR) AS external_id, text FROM documents) "
    "SELECT source, external_id, max(length(text)) AS longest, min(o) AS first_place, arg_min(o, (-length(text), o)) AS winner FROM j GROUP BY ALL"
)
def dedupe_exact_ladder(spark, d):
    got = resolve.by_keys(_jobs(spark, d))
    return got.select("source", "external_id", F.length("description").alias("longest"), F.col("_ord.ord.ord.ord.ord").alias("first_place"), F.col("ord").alias("winner"))


@query()
def dedupe_fuzzy(spark, d):
    """The whole ladder, text rung included; order-dependent, so it has no SQL form."""
    return resolve.resolve(_jobs(spark, d)).select("source", "external_id", "ord")


@query()
def marginal_contribution(spark, d):
    jobs = _jobs(spark, d)
    return resolve.marginal(jobs.filter("source <> 'fr'"), jobs.filter("source = 'fr'"))


def _snapshot(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").filter("o_orderkey % 3 <> 0 or o_orderkey % 5 = 0")
    return rows.select(
        F.col("o_orderkey").alias("id"), F.lit("portal").alias("source"), F.col("o_orderkey").cast("string").alias("external_id"), F.col("o_orderpriority").alias("title"), F.lit("Acme Corp").alias("company"),
        F.lit("Recife, PE").alias("location"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("description"), F.lit(False).alias("closed"), F.lit("Remoto").alias("workplace"),
        (F.col("o_orderkey") % 2 == 0).alias("workplace_declared"), F.to_date("o_orderdate").alias("published"), F.lit("Data").alias("area"), F.lit(False).alias("description_kept"),
    )


def _batch(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").filter("o_orderkey % 5 <> 0")
    return rows.select(
        F.col("o_orderkey").alias("ord"), F.lit("portal").alias("source"), F.col("o_orderkey").cast("string").alias("external_id"), F.concat(F.lit(" New "), "o_orderpriority").alias("title"), F.lit("A").alias("company"),
        F.lit("").alias("location"), F.lit("").alias("url"), F.col("o_orderpriority").alias("description"), (F.col("o_orderkey") % 7 == 0).alias("closed"), F.lit("Presencial").alias("workplace"),
        F.lit(False).alias("workplace_declared"), F.to_date("o_orderdate").alias("published"), F.lit("").alias("area"),
    )


@query(
    "WITH o AS (SELECT o_orderkey k, o_orderpriority p FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 5 = 0), n AS (SELECT o_orderkey k, o_orderpriority p FROM orders WHERE o_orderkey % 5 <> 0) "
    "SELECT coalesce(o.k, n.k)::VARCHAR AS external_id, CASE WHEN n.k IS NULL THEN o.p ELSE 'New ' || n.p END AS title, CASE WHEN o.k IS NULL THEN NULL ELSE 'Acme Corp' END AS company, n.p AS description, "
    "coalesce(n.k % 7 = 0, false) AS closed, CASE WHEN n.k IS NULL OR (o.k IS NOT NULL AND o.k % 2 = 0) THEN 'Remoto' ELSE 'Presencial' END AS workplace, CASE WHEN o.k IS NULL THEN NULL ELSE 'Data' END AS area FROM o FULL JOIN n ON o.k = n.k"
)
def upsert_merge(spark, d):
    return M.merge(_snapshot(spark, d), _batch(spark, d)).select("external_id", "title", "company", "description", "closed", "workplace", "area")


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_type").alias("source"), (F.col("user_id") % 3).cast("string").alias("profile"), F.col("value").alias("raw"), F.when(F.col("event_id") % 11 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("errors"), "ts", "event_id")


@query(
    "WITH h AS (SELECT event_type source, (user_id % 3)::VARCHAR profile, value raw, event_id % 11 = 0 AS bad, ts FROM events), "
    "l AS (SELECT source, profile, arg_max(raw, ts) AS reference FROM h WHERE NOT bad AND ts < TIMESTAMP '2024-01-20' GROUP BY ALL), "
    "c AS (SELECT source, profile, min(raw) AS raw FROM h WHERE NOT bad AND ts >= TIMESTAMP '2024-01-20' GROUP BY ALL) "
    "SELECT 'sharp_drop' AS rule, 'high' AS severity, source, raw AS value, reference * 0.1 AS \"limit\" FROM c JOIN l USING (source, profile) WHERE reference > 0 AND raw < reference * 0.1"
)
def sharp_drop_asof(spark, d):
    runs = _runs(spark, d)
    now = F.lit("2024-01-20").cast("timestamp_ntz")
    current = runs.filter((F.col("ts") >= now) & (F.size("errors") == 0)).groupBy("source", "profile").agg(F.min("raw").alias("raw"), F.array().cast("array<string>").alias("errors"))
    return quality.sharp_drops(current, runs, now)


@query(
    "WITH j AS (SELECT source, lang, n_chars FROM documents), t AS (SELECT count(*) n, count(*) FILTER (lang = 'de') w, count(*) FILTER (lang = 'es') u, count(*) FILTER (lang = 'en') f FROM j), "
    "s AS (SELECT source, count(*) n, count(*) FILTER (n_chars < 500) m FROM j GROUP BY source) "
    "SELECT 'invalid_workplace' AS rule, 'high' AS severity, '' AS source, w::DOUBLE AS value, 0.0::DOUBLE AS \"limit\" FROM t WHERE w > 0 UNION ALL SELECT 'invalid_url', 'warning', '', u, 0 FROM t WHERE u > 0 "
    "UNION ALL SELECT 'degenerated_classification', 'warning', '', round(f / n, 3), 0.55 FROM t WHERE n >= 50 AND f / n > 0.55 UNION ALL SELECT 'missing_company', 'warning', source, round(m / n, 3), 0.2 FROM s WHERE n >= 20 AND m / n > 0.2"
)
def quality_alerts(spark, d):
    docs = table(spark, d, "documents")
    jobs = docs.select(
        "source", F.when(F.col("n_chars") < 500, "").otherwise("Acme").alias("company"), F.when(F.col("lang") == "es", "example.com").otherwise("https://example.com").alias("url"),
        F.when(F.col("lang") == "de", "??").otherwise("Remoto").alias("workplace"), F.lit("2026-01-01").alias("published"), F.when(F.col("lang") == "en", "Outros/TI Geral").otherwise("Data").alias("area"),
    )
    none = spark.createDataFrame([], "source string, raw long, errors array<string>")
    return quality.assess(jobs, none, True, F.lit("2026-07-01").cast("date"))


@query("SELECT CASE WHEN max(ts) IS NULL THEN 'no_history' WHEN round(date_diff('second', max(ts), TIMESTAMP '2024-01-31') / 3600.0, 2) <= 24 THEN 'current' ELSE 'stale' END AS status, round(date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-01-31') / 3600.0, 2) AS age_hours FROM events WHERE event_type = 'signup'")
def freshness(spark, d):
    runs = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "signup").alias("full"))
    return quality.freshness(runs, F.lit("2024-01-31").cast("timestamp"))


@query("SELECT CAST(ts AS DATE)::VARCHAR AS day, count(*) AS n FROM events GROUP BY 1")
def stream_daily_counts(spark, d):
    """Rows per day by a stream over the event file, run to its end; batches add up in versions of a table."""
    import uuid

    at = f"{spark.conf.get('spark.checkpoint.dir', '') or spark.conf.get('spark.sql.warehouse.dir')}/quillwort/daily-{uuid.uuid4().hex}"
    versions = ingest.Snapshots(spark, f"{at}/versions")
    stream = ingest.arrivals(spark, f"{d}/events*", table(spark, d, "events").schema)
    ingest.merge_stream(stream, versions, lambda saved, batch: ingest.add_days(saved, batch, "ts"), f"{at}/progress").awaitTermination()
    return versions.read().select(F.col("day").cast("string").alias("day"), "n")


@query("SELECT page_id, url FROM (SELECT page_id, url, row_number() OVER (PARTITION BY regexp_replace(url, '[?#].*$', '') ORDER BY page_id) r FROM pages) WHERE r = 1")
def first_of_link(spark, d):
    """The first posting of each link without query and fragment."""
    pages = table(spark, d, "pages").withColumn("source", F.regexp_replace("url", r"[?#].*$", "")).withColumn("title", F.lit("x"))
    return M.first_wins(pages, ["source"], "page_id").select("page_id", "url")
