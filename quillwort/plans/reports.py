"""Reports over the star tables: orders stand for postings, parts for skills, line items for their mentions."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import analytics as A
from ..operators.merge import incomplete

REFERENCE = "1997-06-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def postings(spark: SparkSession, d: str) -> DataFrame:
    """id, area, workplace, day, company id, price."""
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("area"), F.col("o_orderstatus").alias("workplace"),
        F.to_date("o_orderdate").alias("day"), F.col("o_custkey").alias("company_id"), F.col("o_totalprice").alias("price"),
    )


def mentions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("skill_id")).distinct()


def skills(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("skill_id"), F.col("p_brand").alias("skill"), F.col("p_type").alias("grp"))


def regions(spark: SparkSession, d: str) -> DataFrame:
    """Postings with nation and region of their company; the dimensions are a few rows, sized by Spark itself."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("company_id"), "c_nationkey", F.col("c_name").alias("company"), F.col("c_mktsegment").alias("segment"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("hub"), "n_regionkey")
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return postings(spark, d).join(c, "company_id", "left").join(n, "c_nationkey", "left").join(r, "n_regionkey", "left").drop("c_nationkey", "n_regionkey")


def area_skill_counts(spark: SparkSession, d: str) -> DataFrame:
    """(area, skill, n): postings of an area that mention a skill."""
    met = postings(spark, d).select("id", "area").join(mentions(spark, d), "id").join(skills(spark, d), "skill_id")
    return met.select("id", "area", "skill").distinct().groupBy("area", "skill").agg(F.count(F.lit(1)).alias("n"))


def area_totals(spark: SparkSession, d: str) -> DataFrame:
    return postings(spark, d).groupBy("area").agg(F.count(F.lit(1)).alias("total"))


# Views of the SQL forms.
P = "p AS (SELECT o_orderkey id, o_orderpriority area, o_orderstatus workplace, CAST(o_orderdate AS DATE) AS day, o_custkey company_id, o_totalprice price FROM orders)"
M = "m AS (SELECT DISTINCT l_orderkey id, l_partkey skill_id FROM lineitem)"
S = "s AS (SELECT p_partkey skill_id, p_brand skill, p_type grp FROM part)"
R = "r AS (SELECT p.*, c_name company, c_mktsegment segment, n_name hub, r_name region FROM p LEFT JOIN customer ON company_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"
C = "c AS (SELECT area, skill, count(DISTINCT id) n FROM p JOIN m USING (id) JOIN s USING (skill_id) GROUP BY ALL)"
T = "t AS (SELECT area, count(*) total FROM p GROUP BY area)"
PCT = "CASE WHEN {b} = 0 THEN 0.0 ELSE round_even(100.0 * {a} / {b}, 1) END"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, days: tuple[str, ...] = ()):
    """Registers a query under its function's name, with the SQL that gives the same rows.

    The columns in ``days`` are dates; both sides show them as ISO text.
    """

    def put(f):
        @wraps(f)
        def shown(spark, d):
            return f(spark, d).withColumns({c: F.col(c).cast("string") for c in days}) if days else f(spark, d)

        QUERIES[f.__name__] = shown
        if sql:
            ORACLES[f.__name__] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in days)}) FROM ({sql})" if days else sql
        return f

    return put


def _rank_sql(source: str, column: str, name: str, where: str = "", top: str = "") -> str:
    return (
        f"WITH {source}, g AS (SELECT {column} AS {name}, count(*) n FROM {'r' if 'LEFT JOIN' in source else 'p'} {where} GROUP BY ALL) "
        f"SELECT * FROM (SELECT row_number() OVER (ORDER BY n DESC, {name}) AS position, {name}, n, {PCT.format(a='n', b='sum(n) OVER ()')} AS pct FROM g) {top}"
    )


@query(_rank_sql(P, "area", "area"))
def area_ranking(spark, d):
    return A.ranking(postings(spark, d), F.col("area"), "area")


@query(_rank_sql(f"{P}, {R}", "coalesce(nullif(region, ''), 'Não informado')", "region"))
def region_ranking(spark, d):
    return A.ranking(regions(spark, d), A.named(F.col("region")), "region")


@query(_rank_sql(f"{P}, {R}", "hub", "hub", "WHERE hub IS NOT NULL AND hub NOT IN ('', 'Não informado')", "WHERE position <= 15"))
def hub_top15(spark, d):
    known = regions(spark, d).filter("hub is not null and hub not in ('', 'Não informado')")
    return A.ranking(known, F.col("hub"), "hub", top=15)


@query(
    f"WITH {P}, g AS (SELECT workplace, count(*) n, CASE workplace WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END k FROM p GROUP BY workplace) "
    f"SELECT row_number() OVER (ORDER BY k, workplace) AS position, workplace, n, {PCT.format(a='n', b='sum(n) OVER ()')} AS pct FROM g"
)
def workplace_ranking(spark, d):
    return A.vocabulary_ranking(postings(spark, d), F.col("workplace"), ["O", "F"], "workplace")


@query(f"WITH {P}, {M}, {S}, {C} SELECT * FROM (SELECT area, skill, n, row_number() OVER (PARTITION BY area ORDER BY n DESC, skill) AS position FROM c) WHERE position <= 10")
def skills_by_area_topn(spark, d):
    met = postings(spark, d).select("id", "area").join(mentions(spark, d), "id").join(skills(spark, d), "skill_id")
    return A.top_per_group(met.select("id", "area", "skill").distinct(), "area", "skill", 10)


@query(f"WITH {P}, {M} SELECT area, count(DISTINCT id) n FROM p JOIN m USING (id) GROUP BY area")
def jobs_with_skills_by_area(spark, d):
    return postings(spark, d).join(mentions(spark, d), "id", "left_semi").groupBy("area").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {P}, {M}, {S}, {C} SELECT skill, sum(n)::BIGINT n FROM c GROUP BY skill ORDER BY n DESC, skill LIMIT 20")
def overall_skills_top20(spark, d):
    return area_skill_counts(spark, d).groupBy("skill").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "skill").limit(20)


@query(f"WITH {P}, {R} SELECT * FROM (SELECT company, count(*) n FROM r WHERE company IS NOT NULL GROUP BY company) ORDER BY n DESC, company LIMIT 15")
def company_top15(spark, d):
    return regions(spark, d).filter("company is not null").groupBy("company").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "company").limit(15)


@query(f"WITH {P}, {R} SELECT segment, hub, count(*) n FROM r GROUP BY ALL")
def raw_group_counts(spark, d):
    """Empty and null names stay groups of their own."""
    return regions(spark, d).groupBy("segment", "hub").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {P} SELECT area, count(*) FILTER (workplace = 'O') AS \"O\", count(*) FILTER (workplace = 'F') AS \"F\", count(*) FILTER (workplace = 'P') AS \"P\" FROM p GROUP BY area")
def area_workplace_crosstab(spark, d):
    return A.cross_tab(postings(spark, d), "area", "workplace", ["O", "F", "P"])


@query(f"WITH {P} SELECT * FROM (SELECT area, id, day, row_number() OVER (PARTITION BY area ORDER BY id) AS position FROM p) WHERE position <= 5", days=("day",))
def sample_per_area(spark, d):
    return A.first_per_group(postings(spark, d).select("area", "id", "day"), "area", [F.col("id")], 5)


@query(f"WITH {P}, {R} SELECT count(*) AS n, count(DISTINCT company) AS companies, min(day) AS first_day, max(day) AS last_day FROM r", days=("first_day", "last_day",))
def base_kpis(spark, d):
    return regions(spark, d).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("company").alias("companies"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query(
    f"WITH {P}, {R} SELECT area, workplace, region, count(*) n, CAST(grouping(area) * 4 + grouping(workplace) * 2 + grouping(region) AS BIGINT) AS level "
    "FROM r GROUP BY GROUPING SETS ((area), (workplace), (region))"
)
def group_counts_one_pass(spark, d):
    """Several group counts in one pass over the rows."""
    sets = [[F.col("area")], [F.col("workplace")], [F.col("region")]]
    grouped = regions(spark, d).groupingSets(sets, F.col("area"), F.col("workplace"), F.col("region"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.grouping_id("area", "workplace", "region").alias("level"))


@query(
    f"WITH {P}, {M}, {S}, k AS (SELECT skill_id, count(*) n FROM m GROUP BY skill_id), "
    "g AS (SELECT skill, sum(coalesce(n, 0))::BIGINT n FROM s LEFT JOIN k USING (skill_id) GROUP BY skill), "
    "b AS (SELECT (SELECT count(*) FROM p) AS total, (SELECT count(DISTINCT id) FROM m) AS linked) "
    f"SELECT row_number() OVER (ORDER BY n DESC, skill) AS position, skill, n, {PCT.format(a='n', b='total')} AS pct_all, {PCT.format(a='n', b='linked')} AS pct_linked FROM g, b"
)
def technology_ranking_with_zero(spark, d):
    return A.item_ranking_with_zero(skills(spark, d), mentions(spark, d), "skill_id", "skill", postings(spark, d), "id")


@query(
    f"WITH {P}, {M}, {S}, {C}, {T}, l AS (SELECT area, count(DISTINCT id) linked FROM p JOIN m USING (id) GROUP BY area) "
    f"SELECT area, skill, n, total, linked, {PCT.format(a='n', b='linked')} AS pct FROM c JOIN t USING (area) JOIN l USING (area)"
)
def skills_by_area_payload(spark, d):
    return A.area_items(postings(spark, d), mentions(spark, d), skills(spark, d), "id", "area", "skill_id", "skill")


_PRESENCE = f"WITH {P}, {M}, {S}, {C}, {T}, q AS (SELECT skill, round(sum(100.0 * n / total) / (SELECT count(*) FROM t), 6) AS mean_pct, count(*) AS areas, sum(n)::BIGINT n FROM c JOIN t USING (area) GROUP BY skill) "


@query(_PRESENCE + "SELECT * FROM q")
def skill_presence_mean(spark, d):
    return A.presence(area_skill_counts(spark, d), area_totals(spark, d), "area", "skill")


@query(_PRESENCE + "SELECT * FROM q ORDER BY n DESC, lower(skill) LIMIT 20")
def presence_top20(spark, d):
    return A.presence(area_skill_counts(spark, d), area_totals(spark, d), "area", "skill", top=20)


@query(_PRESENCE + "SELECT skill, mean_pct, areas FROM q ORDER BY mean_pct DESC, areas DESC, skill LIMIT 1")
def best_presence(spark, d):
    """The most present skill, without a sort of all of them."""
    q = A.presence(area_skill_counts(spark, d), area_totals(spark, d), "area", "skill")
    best = q.agg(F.min_by(F.struct("skill", "mean_pct", "areas"), F.struct(-F.col("mean_pct"), -F.col("areas"), F.col("skill"))).alias("b"))
    return best.select("b.*")


@query(
    f"WITH {P}, {M}, {S}, {C}, {T}, a AS (SELECT * FROM t ORDER BY total DESC, lower(area) LIMIT 4), "
    "k AS (SELECT skill FROM c GROUP BY skill ORDER BY sum(n) DESC, lower(skill) LIMIT 10) "
    f"SELECT a.area, k.skill, coalesce(n, 0) AS n, {PCT.format(a='coalesce(n, 0)', b='total')} AS pct FROM a CROSS JOIN k LEFT JOIN c ON c.area = a.area AND c.skill = k.skill"
)
def area_skill_matrix(spark, d):
    return A.area_item_matrix(area_skill_counts(spark, d), area_totals(spark, d), "area", "skill", 4, 10)


@query(
    f"WITH {P}, {M}, {S}, l AS (SELECT max(day) AS last FROM p WHERE day <= DATE '{REFERENCE}'), "
    "g AS (SELECT CAST(unnest(generate_series(last - INTERVAL 29 DAY, last, INTERVAL 1 DAY)) AS DATE) AS day FROM l), "
    "n AS (SELECT day, count(*) n FROM p GROUP BY day), k AS (SELECT day, count(DISTINCT skill) items FROM p JOIN m USING (id) JOIN s USING (skill_id) GROUP BY day) "
    "SELECT day, coalesce(n, 0) AS n, coalesce(items, 0) AS items FROM g LEFT JOIN n USING (day) LEFT JOIN k USING (day)", days=("day",))
def daily_activity_30d(spark, d):
    rows = postings(spark, d)
    items = rows.select("id", "day").join(mentions(spark, d), "id").join(skills(spark, d), "skill_id")
    return A.daily_activity(rows, items, "day", "skill", 30, F.lit(REFERENCE).cast("date"))


@query(f"WITH {P} SELECT id, area, day FROM p WHERE day BETWEEN DATE '{REFERENCE}' - 29 AND DATE '{REFERENCE}'", days=("day",))
def recent_window(spark, d):
    today = F.lit(REFERENCE).cast("date")
    return postings(spark, d).filter(F.col("day").between(F.date_sub(today, 29), today)).select("id", "area", "day")


@query("SELECT CAST(ts - INTERVAL 3 HOUR AS DATE) AS day, count(*) n FROM events GROUP BY 1", days=("day",))
def new_rows_by_day(spark, d):
    """Rows per day of a fixed offset of three hours behind UTC."""
    return table(spark, d, "events").groupBy(dates.local_day(F.col("ts")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {P} SELECT id, day, row_number() OVER (ORDER BY day DESC NULLS LAST, id DESC) AS position FROM p ORDER BY day DESC NULLS LAST, id DESC LIMIT 100", days=("day",))
def listing_order(spark, d):
    """The first page of the listing: newest first, undated last."""
    page = postings(spark, d).select("id", "day").orderBy(F.desc_nulls_last("day"), F.desc("id")).limit(100)
    return page.withColumn("position", F.row_number().over(Window.orderBy(F.desc_nulls_last("day"), F.desc("id"))).cast("long"))


@query(f"WITH {P}, {M}, {S}, k AS (SELECT id, string_agg(skill, '; ' ORDER BY lower(skill), skill) AS skills FROM (SELECT DISTINCT id, skill FROM m JOIN s USING (skill_id)) GROUP BY id) SELECT p.id, area, day, coalesce(skills, '') AS skills FROM p LEFT JOIN k USING (id)", days=("day",))
def dataset_export(spark, d):
    """One row per posting with its skills in case-insensitive order."""
    names = mentions(spark, d).join(skills(spark, d), "skill_id").select("id", "skill").distinct()
    lists = names.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(F.lower("skill").alias("k"), "skill"))).alias("l"))
    lists = lists.select("id", F.array_join("l.skill", "; ").alias("skills"))
    return postings(spark, d).join(lists, "id", "left").select("id", "area", "day", F.coalesce("skills", F.lit("")).alias("skills"))


@query(f"WITH {P}, {R}, {M}, {S}, k AS (SELECT id, string_agg(skill, ', ' ORDER BY skill) AS skills FROM (SELECT DISTINCT id, skill FROM m JOIN s USING (skill_id)) GROUP BY id) SELECT r.id AS db_id, coalesce(company, 'Confidencial') AS company, coalesce(hub, 'Não informado') AS hub, area, coalesce(skills, '') AS skills FROM r LEFT JOIN k USING (id)")
def seed_export(spark, d):
    """One row per posting with labels for what is missing and skills in code point order."""
    names = mentions(spark, d).join(skills(spark, d), "skill_id").select("id", "skill")
    lists = names.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("skill")), ", ").alias("skills"))
    out = regions(spark, d).join(lists, "id", "left")
    return out.select(F.col("id").alias("db_id"), F.coalesce("company", F.lit("Confidencial")).alias("company"), F.coalesce("hub", F.lit("Não informado")).alias("hub"), "area", F.coalesce("skills", F.lit("")).alias("skills"))


@query(
    "WITH t AS (SELECT doc_id FROM labels WHERE quality = 1), f AS (SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE n_chars >= 500), "
    "b AS (SELECT t.doc_id AS x, f.doc_id AS y FROM t FULL JOIN f ON t.doc_id = f.doc_id) "
    "SELECT count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS tp, count(*) FILTER (x IS NULL) AS fp, count(*) FILTER (y IS NULL) AS fn, "
    "round(2.0 * count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) / (2 * count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) + count(*) FILTER (x IS NULL) + count(*) FILTER (y IS NULL)), 6) AS f1 FROM b"
)
def micro_f1(spark, d):
    labels = table(spark, d, "labels")
    found = table(spark, d, "documents").filter("n_chars >= 500").join(labels, "doc_id", "left_semi")
    return A.micro_f1(labels.filter("quality = 1"), found, ["doc_id"])


@query("SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#11' AND len(list_filter(string_split(lower(p_name), ' '), lambda x: starts_with(x, 'r'))) > 0")
def explorer_search(spark, d):
    parts = table(spark, d, "part")
    return A.explorer_search(parts, "r", F.split(F.lower("p_name"), " "), {"p_brand": "Brand#11"}).select("p_partkey", "p_name")


@query("SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def latest_runs(spark, d):
    return table(spark, d, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(5).select("event_id", "event_type")


@query(f"WITH {P}, {M}, old AS (SELECT * FROM m WHERE skill_id % 7 <> 0 OR skill_id % 5 = 0), new AS (SELECT * FROM m WHERE skill_id % 5 <> 0) SELECT id, skill_id, 'added' AS change FROM (SELECT * FROM new EXCEPT SELECT * FROM old) UNION ALL SELECT id, skill_id, 'removed' FROM (SELECT * FROM old EXCEPT SELECT * FROM new)")
def bridge_diff(spark, d):
    """Links added and removed between two states, in one full join."""
    links = mentions(spark, d)
    old, new = links.filter("skill_id % 7 <> 0 or skill_id % 5 = 0").withColumn("o", F.lit(1)), links.filter("skill_id % 5 <> 0").withColumn("w", F.lit(1))
    both = old.join(new, ["id", "skill_id"], "full").filter("o is null or w is null")
    return both.select("id", "skill_id", F.when(F.col("o").isNull(), "added").otherwise("removed").alias("change"))


@query(f"WITH {P}, {M}, {S} SELECT id, skill_id FROM m WHERE id IN (SELECT id FROM p WHERE area <> '1-URGENT') AND skill_id IN (SELECT skill_id FROM s WHERE grp <> 'STANDARD')")
def orphan_cleanup(spark, d):
    """Links of which both ends survive."""
    rows, items = postings(spark, d).filter("area <> '1-URGENT'"), skills(spark, d).filter("grp <> 'STANDARD'")
    return mentions(spark, d).join(rows, "id", "left_semi").join(items, "skill_id", "left_semi")


@query(
    "SELECT source, count(*) AS n, sum(CASE WHEN text IS NULL OR trim(text) = '' THEN 1 WHEN length(text) < 500 THEN 1 WHEN text LIKE '%...' THEN 1 ELSE 0 END)::BIGINT AS pending FROM documents GROUP BY source"
)
def pending_queue(spark, d):
    """Rows per source whose description is missing, short or cut off."""
    short = incomplete(F.col("text"))
    return table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(short, 1)).alias("pending"))
