"""Postings from the landed answers of job portals: JSON listings, HTML cards, sitemaps and structured data.

The network is not this engine's business. What a crawler has landed is read here, one row per answer, and becomes
rows of one schema; sources are united in a fixed order, which entity resolution relies on.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import FLOOR, epoch_day
from ..functions.workplace import normalize_workplace
from ..functions.text import normalize, squeeze, strip_html

#: Order in which sources are united.
REGISTRY: dict[str, Callable[..., DataFrame]] = {}
FIELDS = ["source", "external_id", "title", "company", "url", "description", "location", "workplace", "workplace_declared", "published", "search_term", "seniority"]
LD = "struct<`@type`:string,title:string,description:string,datePosted:string,url:string,identifier:struct<value:string>,hiringOrganization:struct<name:string>,jobLocationType:string,jobLocation:struct<address:struct<addressLocality:string,addressRegion:string>>>"


def source(name: str):
    def put(f):
        REGISTRY[name] = f
        return f

    return put


def _row(df: DataFrame, name: str, **fields: Column) -> DataFrame:
    """One posting per row, cleaned as every source's rows are."""
    text = lambda c: fields.get(c, F.lit("")).cast("string")
    clean = {
        "external_id": F.trim(text("external_id")), "title": squeeze(text("title")), "company": squeeze(text("company")), "url": F.trim(text("url")),
        "description": strip_html(text("description")), "location": squeeze(text("location")), "workplace": normalize_workplace(text("workplace")),
        "workplace_declared": F.coalesce(fields.get("workplace_declared", F.lit(False)), F.lit(False)), "published": text("published"),
        "search_term": text("search_term"), "seniority": text("seniority"),
    }
    out = df.select(F.lit(name).alias("source"), *[c.alias(k) for k, c in clean.items()])
    return out.filter((F.col("external_id") != "") & (F.col("title") != ""))


def since_floor(published: Column) -> Column:
    """Undated postings, and those of the floor or later, by the ISO form of their date."""
    day = F.to_date(F.try_to_timestamp(F.substring(published, 1, 10), F.lit("yyyy-MM-dd")))
    return day.isNull() | (day >= F.lit(FLOOR).cast("date"))


def _listing(spark: SparkSession, path: str, item: str, key: str = "data") -> DataFrame:
    answers = spark.read.schema(f"term string, {key} array<{item}>").json(path)
    return answers.select("term", F.explode(key).alias("j")).select("term", "j.*")


@source("gupy")
def gupy(spark: SparkSession, path: str) -> DataFrame:
    """JSON pages; a generic page's company is the subdomain; inactive links and old postings go."""
    jobs = _listing(spark, path, "struct<id:string,name:string,careerPageName:string,jobUrl:string,description:string,city:string,state:string,workplaceType:string,publishedDate:string>")
    jobs = jobs.filter(~F.coalesce(F.contains("jobUrl", F.lit("&inactive")), F.lit(False)) & since_floor(F.col("publishedDate")))
    host = F.split(F.parse_url("jobUrl", F.lit("HOST")), r"\.")[0]
    generic = normalize(F.col("careerPageName")).isin("", "vagas", "carreiras", "trabalhe conosco", "oportunidades")
    return _row(jobs, "gupy", external_id=F.col("id"), title=F.col("name"), company=F.when(generic, F.replace(host, F.lit("-"), F.lit(" "))).otherwise(F.col("careerPageName")),
                url=F.col("jobUrl"), description=F.col("description"), location=F.concat_ws(", ", F.nullif("city", F.lit("")), F.nullif("state", F.lit(""))),
                workplace=F.col("workplaceType"), workplace_declared=F.col("workplaceType").isNotNull(), published=F.col("publishedDate"), search_term=F.col("term"))


def cards(spark: SparkSession, path: str, tag: str, marker: str) -> DataFrame:
    """(term, card): the HTML cards of landed pages {term, html}, cut where the opening tag of each card stands."""
    pages = spark.read.schema("term string, html string").json(path)
    opening = rf"<{tag}\b[^>]*{marker}"
    pieces = F.filter(F.split("html", f"(?={opening})"), lambda x: x.rlike(f"^{opening}"))
    return pages.select("term", F.explode(pieces).alias("card"))


def within(card: Column, css_class: str) -> Column:
    """The text inside the first element that has the class, up to its end tag."""
    return strip_html(F.regexp_extract(card, rf'(?s)<(\w+)[^>]*class="[^"]*\b{css_class}\b[^"]*"[^>]*>(.*?)</\1>', 2))


def attribute(card: Column, name: str) -> Column:
    return F.regexp_extract(card, rf'{name}="([^"]*)"', 1)


@source("linkedin")
def linkedin(spark: SparkSession, path: str) -> DataFrame:
    """HTML cards; the id stands in the card's URN, the link loses its query."""
    found = cards(spark, path, "div", r'data-entity-urn="')
    c = F.col("card")
    return _row(found, "linkedin", external_id=F.regexp_extract(attribute(c, "data-entity-urn"), r"(\d+)$", 1), title=within(c, "base-search-card__title"), company=within(c, "base-search-card__subtitle"),
                url=F.split(attribute(c, "href"), r"\?")[0], location=within(c, "job-search-card__location"), published=attribute(c, "datetime"), search_term=F.col("term"))


@source("vagas")
def vagas(spark: SparkSession, path: str) -> DataFrame:
    """HTML cards; a workplace is only told where the location says home office."""
    found = cards(spark, path, "li", r'class="[^"]*\bvaga\b')
    c = F.col("card")
    place = within(c, "vaga-local")
    return _row(found, "vagas", external_id=F.regexp_extract(attribute(c, "href"), r"/v(\d+)", 1), title=attribute(c, "title"), company=within(c, "emprVaga"), url=attribute(c, "href"), description=within(c, "detalhes"),
                location=place, workplace=F.when(normalize(place).contains("home office"), "home office"), published=within(c, "data-publicacao"), search_term=F.col("term"))


@source("trampos")
def trampos(spark: SparkSession, path: str) -> DataFrame:
    """A full JSON listing without terms; native types tell the level, and facts make up the description."""
    jobs = _listing(spark, path, "struct<id:string,name:string,company:struct<name:string>,category:string,type:string,city:string,state:string,home_office:boolean,salary:string,published_at:string>", "opportunities")
    level = F.when(F.col("type").isin("internship", "estagio"), "Estágio").when(F.col("type") == "trainee", "Trainee").otherwise("")
    facts = F.concat_ws(". ", F.nullif("category", F.lit("")), F.nullif("type", F.lit("")), F.nullif("salary", F.lit("")))
    return _row(jobs, "trampos", external_id=F.col("id"), title=F.col("name"), company=F.col("company.name"), url=F.concat(F.lit("https://trampos.co/oportunidades/"), F.col("id")), description=facts,
                location=F.concat_ws(", ", F.nullif("city", F.lit("")), F.nullif("state", F.lit(""))), workplace=F.when(F.col("home_office"), "remoto"), workplace_declared=F.col("home_office"), published=F.col("published_at"), seniority=level)


@source("solides")
def solides(spark: SparkSession, path: str) -> DataFrame:
    """JSON with native filters; only the label for juniors is trusted as a level."""
    jobs = _listing(spark, path, "struct<id:string,title:string,companyName:string,description:string,city:struct<name:string>,state:struct<code:string>,jobType:string,seniority:string,createdAt:string,redirectLink:string>")
    jobs = jobs.filter(since_floor(F.col("createdAt")))
    return _row(jobs, "solides", external_id=F.col("id"), title=F.col("title"), company=F.col("companyName"), url=F.col("redirectLink"), description=F.col("description"),
                location=F.concat_ws(", ", F.col("city.name"), F.col("state.code")), workplace=F.col("jobType"), workplace_declared=F.col("jobType").isNotNull(), published=F.col("createdAt"), seniority=F.when(normalize(F.col("seniority")) == "junior", "Júnior"))


@source("geekhunter")
def geekhunter(spark: SparkSession, path: str) -> DataFrame:
    """HTML cards whose paragraphs are told apart by what they hold: level, age, workplace, place, or long text."""
    found = cards(spark, path, "article", r'class="').withColumn("ps", F.transform(F.regexp_extract_all("card", F.lit(r"(?s)<p[^>]*>(.*?)</p>"), F.lit(1)), strip_html))
    c = F.col("card")
    first = lambda keep: F.get(F.filter("ps", keep), F.lit(0))
    age = first(lambda p: F.lower(p).rlike("h[aá] .*(hora|dia|m[eê]s)"))
    kind = first(lambda p: normalize(p).isin("remoto", "hibrido", "presencial"))
    return _row(found, "geekhunter", external_id=F.regexp_extract(attribute(c, "href"), r"([^/]+)$", 1), title=strip_html(F.regexp_extract(c, r"(?s)<h2[^>]*>(.*?)</h2>", 1)), company=F.regexp_extract(attribute(c, "href"), r"^(?:https?://[^/]+)?/([^/]+)/", 1),
                url=attribute(c, "href"), description=first(lambda p: F.length(p) > 80), location=first(lambda p: p.rlike(r"^.{2,60}, [A-Z]{2}$")), workplace=kind, workplace_declared=kind.isNotNull(), published=age,
                search_term=F.col("term"), seniority=first(lambda p: normalize(p).isin("junior", "estagio", "trainee")))


@source("infojobs")
def infojobs(spark: SparkSession, path: str) -> DataFrame:
    """HTML cards; the distance is cut from the place and dates lose their slashes."""
    found = cards(spark, path, "div", r'class="[^"]*\bcard\b[^"]*"[^>]*data-id="')
    c = F.col("card")
    place = F.regexp_replace(within(c, "location"), r"(?i)[,\s]*\d+\s*km de voc[eê].*$", "")
    jobs = _row(found, "infojobs", external_id=attribute(c, "data-id"), title=strip_html(F.regexp_extract(c, r"(?s)<h2[^>]*>(.*?)</h2>", 1)), company=within(c, "company"), url=attribute(c, "href"), description=within(c, "description"),
                location=place, workplace=within(c, "workplace"), published=F.replace(attribute(c, "data-date"), F.lit("/"), F.lit("-")), search_term=F.col("term"))
    return jobs.filter(since_floor(F.col("published")))


def sitemap(spark: SparkSession, path: str, since: Column, slug: str) -> DataFrame:
    """(loc, lastmod) of a sitemap's entries that are recent enough and whose link fits."""
    whole = spark.read.option("wholetext", True).text(path)
    entries = whole.select(F.explode(F.regexp_extract_all("value", F.lit(r"(?s)<url>(.*?)</url>"), F.lit(1))).alias("u"))
    rows = entries.select(F.trim(F.regexp_extract("u", r"(?s)<loc>(.*?)</loc>", 1)).alias("loc"), F.to_timestamp(F.try_to_timestamp(F.substring(F.regexp_extract("u", r"<lastmod>\s*([^<\s]+)", 1), 1, 10), F.lit("yyyy-MM-dd"))).alias("lastmod"))
    return rows.filter((F.col("lastmod") >= since) & F.col("loc").rlike(slug))


def payload_field(html: Column, name: str) -> Column:
    """A field key:"value" of an embedded script, its escapes undone."""
    raw = F.regexp_extract(html, rf'\b{name}:"((?:[^"\\]|\\.)*)"', 1)
    return F.coalesce(F.get_json_object(F.concat(F.lit('{"v":"'), F.replace(raw, F.lit("\\u002F"), F.lit("/")), F.lit('"}')), "$.v"), raw)


@source("abler")
def abler(spark: SparkSession, path: str) -> DataFrame:
    """Detail pages {url, html} whose script holds the fields."""
    pages = spark.read.schema("url string, html string").json(path)
    f = lambda n: payload_field(F.col("html"), n)
    return _row(pages, "abler", external_id=F.regexp_extract("url", r"-(\d+)/?$", 1), title=f("title"), company=f("company_name"), url=F.col("url"), description=f("description"), location=F.concat_ws(", ", F.nullif(f("city"), F.lit("")), F.nullif(f("state"), F.lit(""))), workplace=f("workplace"), published=f("published_at"))


def job_posting(html: Column) -> Column:
    """The first JobPosting of a page's structured data, also in a graph; null if there is none."""
    scripts = F.regexp_extract_all(html, F.lit(r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))
    single = F.transform(scripts, lambda s: F.from_json(s, LD))
    graphs = F.flatten(F.transform(scripts, lambda s: F.coalesce(F.from_json(s, f"struct<`@graph`:array<{LD}>>")["@graph"], F.array().cast(f"array<{LD}>"))))
    return F.get(F.filter(F.concat(single, graphs), lambda x: x["@type"] == "JobPosting"), F.lit(0))


def _from_ld(pages: DataFrame, name: str, external_id: Column) -> DataFrame:
    rows = pages.withColumn("p", job_posting(F.col("html"))).filter("p is not null")
    p = lambda c: F.col(f"p.{c}")
    return _row(rows, name, external_id=external_id, title=p("title"), company=p("hiringOrganization.name"), url=F.col("url"), description=p("description"),
                location=F.concat_ws(", ", p("jobLocation.address.addressLocality"), p("jobLocation.address.addressRegion")),
                workplace=F.when(p("jobLocationType") == "TELECOMMUTE", "remoto").otherwise(within(F.col("html"), "workplace")), published=p("datePosted"))


@source("recrutei")
def recrutei(spark: SparkSession, path: str) -> DataFrame:
    """Detail pages with structured data; the id is a UUID or the number before the slug."""
    pages = spark.read.schema("url string, html string").json(path)
    ident = F.coalesce(F.nullif(F.lower(F.regexp_extract("url", r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", 0)), F.lit("")), F.regexp_extract("url", r"/(\d+)(?:-[^/]*)?/?$", 1))
    return _from_ld(pages, "recrutei", ident)


@source("jobbol")
def jobbol(spark: SparkSession, path: str) -> DataFrame:
    """A JSON listing joined with landed details {id, url, html} beside it; details of another posting do not count."""
    jobs = _listing(spark, f"{path}/listing", "struct<id:string,title:string,company:string,url:string,location:string,created:long>", "jobs")
    details = spark.read.schema("id string, url string, html string").json(f"{path}/details").dropDuplicates(["id"])
    details = details.select("id", F.col("url").alias("final_url"), job_posting(F.col("html")).alias("p"))
    met = jobs.join(details, "id", "left")
    same = F.coalesce(F.contains("final_url", F.col("id")) | (normalize(F.col("p.title")) == normalize(F.col("title"))), F.lit(False))
    return _row(met, "jobbol", external_id=F.col("id"), title=F.col("title"), company=F.col("company"), url=F.col("url"), description=F.when(same, F.col("p.description")), location=F.col("location"), published=epoch_day(F.col("created")).cast("string"), search_term=F.col("term"))


def collect(spark: SparkSession, paths: dict[str, str], names: list[str] | None = None) -> DataFrame:
    """All landed sources in the registry's order, with ``ord``, a number that follows source, then landing order."""
    parts = []
    for i, name in enumerate(REGISTRY):
        if name in paths and (names is None or name in names):
            parts.append(REGISTRY[name](spark, paths[name]).withColumn("ord", F.lit(i).cast("long") * (1 << 56) + F.monotonically_increasing_id()))
    return reduce(DataFrame.unionByName, parts)


def drop_intermediaries(jobs: DataFrame, intermediaries: DataFrame, selected: list[str]) -> DataFrame:
    """Postings without those that another source only passes on from an advertiser with a selected native source.

    ``intermediaries`` has (company_key: normalised name, native: source); it is broadcast after it is counted.
    """
    native = intermediaries.filter(F.col("native").isin(selected))
    native = F.broadcast(native) if native.count() <= 50_000 else native
    rows = jobs.withColumn("_c", normalize(F.col("company")))
    return rows.join(native, (F.col("_c") == F.col("company_key")) & (F.col("source") != F.col("native")), "left_anti").drop("_c")


def with_overrides(jobs: DataFrame, overrides: DataFrame) -> DataFrame:
    """Workplaces as curated for (source, external_id), which count as declared."""
    met = jobs.join(overrides.select("source", "external_id", F.col("workplace").alias("_w")), ["source", "external_id"], "left")
    return met.withColumn("workplace", F.coalesce("_w", "workplace")).withColumn("workplace_declared", F.col("_w").isNotNull() | F.col("workplace_declared")).drop("_w")


def without_terms(terms: DataFrame, excluded: DataFrame) -> DataFrame:
    """(source, term) without the terms that a source is not asked for."""
    return terms.join(excluded, ["source", "term"], "left_anti")
