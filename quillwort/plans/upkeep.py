"""Queries of imports and upkeep: area policy, queues, reclassification, vocabulary, mentions in SQL, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, udfs
from ..operators import classify as K
from ..operators import merge as M
from ..operators import skills
from ..streaming import ingest
from .postings import _SCORE, RULES, SKILLS, documents
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


def shared(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all machines share; one below the warehouse where none is named."""
    at = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get("spark.sql.warehouse.dir")
    return f"{at.rstrip('/')}/quillwort/{name}-{uuid.uuid4().hex}"


_BY_TITLE = K.AreaRules({"Data": [("urgent", 4.0)], "QA": [("low", 4.0)]}, fallback="Outros")


@query(
    "WITH n AS (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN 'new ' ELSE 'old ' END || o_orderkey AS x, ['QA', 'Outros', '', 'Unknown', 'Data'][1 + CAST(o_orderkey % 5 AS INT)] AS given, "
    "['Data', 'Outros', NULL][1 + CAST(o_orderkey % 3 AS INT)] AS old, CASE WHEN o_orderkey % 7 < 3 THEN NULL ELSE o_orderpriority END AS text, "
    "CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 'Data' WHEN o_orderpriority LIKE '%LOW%' THEN 'QA' ELSE 'Outros' END AS told FROM orders) "
    "SELECT x AS external_id, CASE WHEN given IN ('Data', 'QA') THEN given WHEN o_orderkey % 4 <> 0 AND old = 'Data' AND text IS NULL THEN old ELSE told END AS area, text AS description FROM n "
    "UNION ALL SELECT 'old ' || o_orderkey, old, NULL FROM n WHERE o_orderkey % 4 = 0"
)
def upsert_area_policy(spark, d):
    """Areas that a batch brings, that stay, and that are told anew; every fourth posting of the batch is a new one."""
    k = F.col("o_orderkey")
    pick = lambda by, values: F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (k % by + 1).cast("int"))
    common = [F.lit("portal").alias("source"), F.col("o_orderpriority").alias("title"), F.lit("Acme").alias("company"), F.lit("Recife, PE").alias("location"), F.lit(False).alias("closed"),
              F.lit("Remoto").alias("workplace"), F.lit(False).alias("workplace_declared"), F.to_date("o_orderdate").alias("published")]
    orders, none = table(spark, d, "orders"), F.lit(None).cast("string")
    old = orders.select(k.alias("id"), F.concat(F.lit("old "), k).alias("external_id"), none.alias("url"), none.alias("description"), pick(3, ["Data", "Outros", None]).alias("area"), F.lit(False).alias("description_kept"), *common)
    name = F.concat(F.when(k % 4 == 0, "new ").otherwise("old "), k)
    new = orders.select(k.alias("ord"), name.alias("external_id"), F.lit("").alias("url"), F.when(k % 7 < 3, "").otherwise(F.col("o_orderpriority")).alias("description"), pick(5, ["QA", "Outros", "", "Unknown", "Data"]).alias("area"), *common)
    told = lambda rows: K.classify(rows, "id", "title", "description", _BY_TITLE).select("id", "area")
    return M.merge(old, new, areas=["Data", "QA", "Outros"], fallback="Outros", classify=told).select("external_id", "area", "description")


_LINKED = "CASE WHEN o_orderkey % 2 = 0 THEN 'https://www.site.com.br/vagas/' || (1000000 + o_orderkey) ELSE '' END"


@query(
    f"SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey WHEN {_LINKED} <> '' THEN o_orderkey END AS match_id FROM orders"
)
def match_ladder(spark, d):
    """Which saved posting a row is: by source and id, by its link as it stands, or by the id in the link."""
    k = F.col("o_orderkey")
    link = F.concat(F.lit("https://www.site.com.br/vagas/"), k + 1000000)
    saved = table(spark, d, "orders").select(k.alias("id"), F.lit("a").alias("source"), k.cast("string").alias("external_id"), link.alias("url"))
    same = F.when(k % 3 == 0, k.cast("string")).otherwise(F.concat(F.lit("x"), k))
    batch = table(spark, d, "orders").select(k.alias("ord"), F.lit("a").alias("source"), same.alias("external_id"), F.when(k % 4 == 0, link).when(k % 2 == 0, F.concat(link, F.lit("?ref=mail"))).otherwise("").alias("url"))
    return M.match_ids(batch, saved, "ord").select("ord", "match_id")


_PORTALS = ["linkedin", "vagas", "trampos", "gupy", "geekhunter", "infojobs"]
_QUEUED = (
    f"WITH q AS (SELECT doc_id AS id, [{', '.join(repr(p) for p in _PORTALS)}][1 + CAST(doc_id % 6 AS INT)] AS source, doc_id % 10 = 3 AS closed, coalesce(text, '') AS t, "
    "DATE '2026-01-01' + CAST(doc_id % 60 AS INT) AS day, doc_id % 4 = 0 AS own, doc_id % 9 = 0 AS slug FROM documents) "
)


@query(
    _QUEUED + "SELECT source, id FROM q WHERE NOT closed AND CASE source WHEN 'linkedin' THEN length(t) < 30 WHEN 'vagas' THEN length(t) < 500 OR ends_with(t, '...') "
    "WHEN 'trampos' THEN length(t) < 100 AND day >= DATE '2026-02-20' - 30 WHEN 'gupy' THEN own WHEN 'geekhunter' THEN length(t) < 300 OR slug ELSE length(t) < 160 OR ends_with(t, '...') END"
)
def pending_queues(spark, d):
    """What each portal's details are to be fetched for."""
    k = F.col("doc_id")
    rows = table(spark, d, "documents").select(
        k.alias("id"), F.element_at(F.array(*map(F.lit, _PORTALS)), (k % 6 + 1).cast("int")).alias("source"), (k % 10 == 3).alias("closed"), F.col("text").alias("description"),
        F.date_add(F.lit("2026-01-01").cast("date"), (k % 60).cast("int")).alias("published"), F.when(k % 9 == 0, "code-group").otherwise("Code Group").alias("company"),
        F.when(k % 4 == 0, "https://acme.gupy.io/job/1").otherwise("https://acme.example.com/job/1").alias("url"),
    )
    today = F.lit("2026-02-20").cast("date")
    queues = [M.queue(rows, p, today) for p in _PORTALS]
    out = queues[0]
    for q in queues[1:]:
        out = out.unionByName(q)
    return out.select("source", "id")


@query(
    _SCORE + ", x AS (SELECT *, title_score > 3 AS titled, max(CASE WHEN title_score > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS any_titled FROM a), "
    "p AS (SELECT * FROM x WHERE titled OR any_titled = 0), y AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY title_strong DESC, score DESC, len DESC, area) AS r FROM p), "
    "z AS (SELECT doc_id, area FROM y WHERE r = 1 AND score >= 3), o AS (SELECT doc_id, CASE WHEN lang = 'en' THEN 'Data' ELSE 'Antiga' END AS old, coalesce(area, 'Outros') AS told, trim(coalesce(text, '')) <> '' AS has FROM documents LEFT JOIN z USING (doc_id)) "
    "SELECT doc_id, CASE WHEN has AND old <> 'Data' THEN told ELSE old END AS area, has AND old <> 'Data' AND told <> old AS changed FROM o"
)
def reclassify_areas(spark, d):
    """Areas outside the vocabulary told anew."""
    rows = documents(spark, d).select(F.col("doc_id").alias("id"), "title", "description", F.when(F.col("lang") == "en", "Data").otherwise("Antiga").alias("area"))
    told = lambda x: K.classify(x, "id", "title", "description", RULES).select("id", "area")
    return M.reclassify_areas(rows, list(RULES.areas), told).select(F.col("id").alias("doc_id"), "area", "changed")


@query(
    "WITH v AS (SELECT p_brand AS skill, min(p_partkey) AS skill_id FROM part GROUP BY p_brand), w AS (SELECT p_partkey AS id, p_brand FROM part) "
    "SELECT id, skill_id FROM w JOIN v ON v.skill = w.p_brand UNION SELECT id, skill_id FROM w JOIN v ON v.skill = 'Brand#' || (11 + CAST(id % 5 AS INT))"
)
def skill_links_any_case(spark, d):
    """Links by the names that rows bring and those found in their texts, whatever the case of either."""
    parts = table(spark, d, "part")
    vocabulary = parts.groupBy(F.col("p_brand").alias("skill")).agg(F.min("p_partkey").alias("skill_id"))
    rows = parts.select(F.col("p_partkey").alias("id"), F.array(F.upper("p_brand"), F.lit("unknown name")).alias("given"), F.array(F.concat(F.lit(" brand#"), (F.col("p_partkey") % 5 + 11).cast("string"))).alias("found"))
    return M.wanted_links(rows, vocabulary, "given", "found")


_ALIASES = [(s, a) for s, a, _, _ in SKILLS.aliases]
_PLAIN = "' ' || trim(regexp_replace(regexp_replace(lower(strip_accents(coalesce({c}, ''))), '[^a-z0-9#+ ]+', ' ', 'g'), ' +', ' ', 'g')) || ' '"


@query(f"WITH c AS (SELECT doc_id, {_PLAIN.format(c='split_part(text, chr(10), 1)')} AS b FROM documents) SELECT DISTINCT doc_id, skill FROM c, (VALUES " + ", ".join(f"('{s}', ' {a} ')" for s, a in _ALIASES) + ") v(skill, a) WHERE contains(b, a)")
def udtf_mentions(spark, d):
    """Skills named by titles, by the table function in SQL."""
    udfs.register_mentions(spark, SKILLS, "quillwort_mentions")
    name = f"titles_{uuid.uuid4().hex}"
    documents(spark, d).select("doc_id", "title").createOrReplaceTempView(name)
    return spark.sql(f"select distinct doc_id, skill from {name}, lateral quillwort_mentions(title)")


_LINKLESS = r"regexp_replace(text, '(?i)(https?://|www\.)\S+|\S+@\S+\.\S+', ' ', 'g')"


@query(f"WITH c AS (SELECT doc_id, {_PLAIN.format(c=_LINKLESS)} AS b FROM documents) SELECT DISTINCT doc_id, skill FROM c, (VALUES " + ", ".join(f"('{s}', ' {a} ')" for s, a in _ALIASES) + ") v(skill, a) WHERE contains(b, a)")
def skill_mentions_whole(spark, d):
    """Skills of every document, links and mail addresses left out of the text."""
    docs = table(spark, d, "documents").select("doc_id", F.col("text").alias("description"), F.lit("").alias("title"))
    return skills.skill_mentions(docs, "doc_id", "title", "description", SKILLS)


# References of the pages, in the SQL; the ampersand comes last, as what it leaves is not read again.
_DECODED = "regexp_replace(html, '<[^>]+>', ' ', 'g')"
for _name, _sign in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "©"), ("middot", "·"), ("nbsp", " "), ("mdash", "—"), ("ndash", "–"), ("#39", "''"), ("amp", "&")):
    _DECODED = f"replace({_DECODED}, '&{_name};', '{_sign}')"


@query(f"SELECT page_id, trim(regexp_replace({_DECODED}, '[\\s ]+', ' ', 'g')) AS body FROM pages")
def html_to_text(spark, d):
    """Pages as plain text, with every character reference decoded."""
    return table(spark, d, "pages").select("page_id", text.strip_html(F.col("html")).alias("body"))


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL")
def stream_ingest_merge(spark, d):
    """The first event of each user and type, by a stream whose batches are merged into versions of a table."""
    def first_of_all(saved: DataFrame | None, batch: DataFrame) -> DataFrame:
        rows = batch.select("user_id", "event_type", "event_id")
        return (rows if saved is None else saved.unionByName(rows)).groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))

    versions = ingest.Snapshots(spark, shared(spark, "events"))
    stream = ingest.arrivals(spark, f"{d}/events*", table(spark, d, "events").schema)
    ingest.merge_stream(stream, versions, first_of_all, shared(spark, "events-progress")).awaitTermination()
    return versions.read()
