"""Operators on small tables made here."""

import datetime

import pytest
from pyspark.sql import functions as F

from quillwort.functions import dates, links, places, text
from quillwort.operators import classify, merge, quality, resolve, skills
from quillwort.sources import files, portals
from quillwort.streaming import ingest


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "want"), [("Ação & Prática — nº 1", "acao pratica no 1"), (None, ""), ("  ", ""), ("C++/C#", "c c"), ("ﬁm ½", "fim 1 2")])
def test_normalize(spark, raw, want):
    assert one(spark, text.normalize(F.col("a")), a=raw) == want


def test_normalize_variants(spark):
    assert one(spark, text.normalize_tech(F.col("a")), a="C++, C# e Node.js") == "c++ c# e node js"
    assert one(spark, text.normalize_level(F.col("a")), a="Programador PL / I N1.5") == "programador pli n1.5"
    assert one(spark, text.strip_html(F.col("a")), a="<p>a&nbsp;&amp;lt; b</p><br>c") == "a &lt; b c"
    assert one(spark, text.remove_links(F.col("a")), a="veja www.x.com e a@b.co").split() == ["veja", "e"]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://a.b.com.br/vaga/12345", "b.com.br:12345"), ("https://x.com/v/1234567-89012345678", "x.com:89012345678"), (None, ""), ("mailto:a@b.c", ""),
        ("https://localhost/1234567", ""), ("https://x.com/AbCdEfGhIjKlMnOp1/2", "x.com:AbCdEfGhIjKlMnOp1"),
    ],
)
def test_link_identity(spark, url, want):
    assert one(spark, links.link_identity(F.col("a")), a=url) == want


def test_places(spark):
    got = one(spark, places.place_identity(F.col("a")), a="São Paulo, SP")
    assert (got["city"], got["state"]) == ("sao paulo", "sp")
    assert one(spark, places.place_identity(F.col("a")), a="Remoto") is None
    assert one(spark, places.same_company(places.company_identity(F.col("a")), places.company_identity(F.col("b"))), a="Acme Tech Ltda", b="Acme") is True
    assert one(spark, places.same_company(places.company_identity(F.col("a")), places.company_identity(F.col("b"))), a="Grupo", b="Acme") is False


def test_dates(spark):
    assert one(spark, dates.loose_date(F.col("a")), a="3-7-2026") == datetime.date(2026, 7, 3)
    assert one(spark, dates.loose_date(F.col("a")), a="2026-02-30") is None
    assert one(spark, dates.file_day(F.col("a"), F.lit("2026-01-02 01:00:00").cast("timestamp")), a="/x/vagas_20260304_101112.csv") == datetime.date(2026, 3, 4)
    assert one(spark, dates.file_day(F.col("a"), F.lit("2026-01-02 01:00:00").cast("timestamp")), a="/x/vagas.csv") == datetime.date(2026, 1, 1)


RULES = classify.AreaRules(
    {"Suporte Técnico": [("suporte", 1.0), ("suporte tecnico", 4.0)], "Engenharia de Software": [("desenvolvedor", 1.0), ("analista de sistemas", 4.0)], "Data": [("sql", 4.0), ("dados", 1.0)], "Infraestrutura / Redes": [("redes", 4.0)], "Service Desk / Help Desk": [("chamados", 1.0), ("atendimento", 1.0), ("help desk", 1.0)]},
    gate_title=["ti"], exclude=["contabil"],
)


@pytest.mark.parametrize(
    ("title", "body", "area"),
    [
        ("Suporte técnico", "", "Suporte Técnico"), ("Vendedor", "", "Outros/TI Geral"), ("Desenvolvedor", "sql e dados", "Data"), ("Suporte técnico de infraestrutura", "", "Infraestrutura / Redes"),
        ("Analista de Sistemas", "chamados, atendimento e help desk", "Suporte Técnico"), ("Analista de Sistemas", "chamados", "Engenharia de Software"), ("", None, "Outros/TI Geral"),
    ],
)
def test_classify(spark, title, body, area):
    df = spark.createDataFrame([(1, title, body)], "id long, title string, description string")
    assert classify.classify(df, "id", "title", "description", RULES).first()["area"] == area


def test_area_score_counts_a_stretch_once(spark):
    df = spark.createDataFrame([(1, "suporte tecnico", "suporte suporte")], "id long, title string, description string")
    row = classify.area_scores(df, "id", "title", "description", RULES).filter("area = 'Suporte Técnico'").first()
    assert (row["score"], row["title_score"], row["matches"]) == (13.0, 12.0, ["suporte tecnico(t)", "suporte"])


def test_gate(spark):
    df = spark.createDataFrame([("Auxiliar de TI", ""), ("Analista Contábil de TI", "sql"), ("Vendedor", "conhecer sql"), ("Vendedor", None)], "t string, d string")
    assert [r["x"] for r in df.select(classify.is_tech(F.col("t"), F.col("d"), RULES).alias("x")).collect()] == [True, False, True, False]


def test_levels(spark):
    rules = classify.LevelRules({"Estágio": [r"\bestagio\b"], "Júnior": [r"\bjunior\b", r"\bjr\b"]}, above=[r"\bpleno\b"], inferred=[r"\bn1\b(?!\.\d)"])
    df = spark.createDataFrame([("Dev Jr/Pleno", "", ""), ("Dev Pleno", "", "junior"), ("Suporte N1", "", ""), ("Suporte N1.5", "", ""), ("Dev", "", "Estagio")], "title string, description string, seniority string")
    got = {(r["title"], r["seniority"]) for r in classify.entry_level(df, rules).collect()}
    assert got == {("Dev Jr/Pleno", "Júnior"), ("Suporte N1", "Júnior"), ("Dev", "Estágio")}
    assert {r["title"] for r in classify.entry_level(df, rules, strict=True).collect()} == {"Suporte N1", "Dev"}


def test_skills_sections_guards_and_case(spark):
    rules = skills.SkillRules.from_dict(
        {"l": {"Go": ["golang", "~Go"], "Node": ["node"], "C#": ["c#"], "SQL": {"aliases": ["sql"], "padroes": [r"t sql \d+"]}}}, discard=["beneficios"], content=["requisitos"], guards={"Node": {"node": {"nao_seguido_por": ["red"]}}},
    )
    rows = [(1, "", "Requisitos: C# e Go\nBenefícios: curso de SQL\nRequisitos: node"), (2, "", "vamos go com node red"), (3, None, None), (4, "SQL", "")]
    df = spark.createDataFrame(rows, "id long, title string, description string")
    got = {r["id"]: r["skills"] for r in skills.extract_skills(df, "id", "title", "description", rules).collect()}
    assert got == {1: ["C#", "Go", "Node"], 2: [], 3: [], 4: ["SQL"]}


JOB = "ord long, source string, external_id string, title string, company string, url string, description string, location string, published_date string, search_term string"


def test_resolution(spark):
    rows = [
        (1, "a", "1", "Dev", "Acme", "", "short", "Recife, PE", "2026-06-01", "x"), (2, "a", "1", "Dev", "Acme", "", "longer text", "Recife, PE", "2026-06-01", ""),
        (3, "b", "9", "Dev", "Acme Ltda", "", "the longest text", "Recife", "2026-06-05", "y"), (4, "b", "8", "Dev", "Acme", "", "", "Recife, PE", "2026-07-30", "z"),
        (5, "c", "7", "QA", "Foo", "https://x.com/v/1234567", "d", "", "", ""), (6, "d", "6", "Tester", "Bar", "https://x.com/w/1234567", "dd", "", "", "t"),
    ]
    df = spark.createDataFrame(rows, JOB)
    want = {(3, "x"), (4, "z"), (6, "t")}
    assert {(r["ord"], r["search_term"]) for r in resolve.resolve(df).collect()} == want
    assert {(r["ord"], r["search_term"]) for r in resolve.resolve(df.repartition(3, "title")).collect()} == want
    assert resolve.resolve(df.limit(0)).count() == 0


def test_merge_twice_is_merge_once(spark):
    from quillwort.plans import postings

    d = "/root/testdata/sf0.001"
    old, batch = postings._snapshot(spark, d), postings._batch(spark, d)
    once = merge.merge(old, batch)
    twice = merge.merge(once, batch)
    drop = ["description_kept"]
    assert once.drop(*drop).exceptAll(twice.drop(*drop)).isEmpty() and twice.drop(*drop).exceptAll(once.drop(*drop)).isEmpty()
    assert once.select("id").distinct().count() == once.count()


def test_links(spark):
    links_ = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "id long, skill_id long")
    wanted = spark.createDataFrame([(1, 2), (9, 9)], "id long, skill_id long")
    touched = spark.createDataFrame([(1,), (2,)], "id long")
    assert {tuple(r) for r in merge.sync_links(links_, touched, wanted).collect()} == {(1, 2), (2, 1), (3, 2)}
    rows, items = spark.createDataFrame([(1,), (2,)], "id long"), spark.createDataFrame([(1,)], "skill_id long")
    assert {tuple(r) for r in merge.broken_links(links_, rows, items).collect()} == {(3, 2, "row"), (3, 2, "skill")}


def test_quality(spark):
    jobs = spark.createDataFrame([], "source string, company string, url string, workplace string, published string, area string")
    stats = spark.createDataFrame([("gupy", 0, []), ("abler", 0, []), ("x", 3, ["boom"])], "source string, raw long, errors array<string>")
    alerts = quality.assess(jobs, stats, True, F.lit("2026-01-01").cast("date"))
    assert {(r["rule"], r["source"]) for r in alerts.collect()} == {("collection_empty", ""), ("source_empty", "gupy"), ("source_errors", "x"), ("partial_collection", "")}
    assert tuple(quality.verdict(alerts).first()) == (True, True)
    assert {r["source"] for r in quality.affected_sources(stats, alerts).collect()} == {"gupy", "x"}


def test_files(spark, tmp_path):
    (tmp_path / "vagas_20260101_000000.csv").write_text('﻿source,external_id,title,description\na,1,Dev,"line\nnext ""x"""\n', encoding="utf-8")
    row = files.read_csv(spark, files.latest(spark, str(tmp_path))).first()
    assert (row["source"], row["description"], row["url"]) == ("a", 'line\nnext "x"', None)
    with pytest.raises(ValueError):
        files.read_checkpoint(spark, str(tmp_path))
    with pytest.raises(ValueError):
        files.check_parent({"parent": "a"}, "b")


def test_portals(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"term":"dev","html":"<div class=\\"base-card\\" data-entity-urn=\\"urn:li:jobPosting:42\\"><a href=\\"https://l.com/jobs/view/42?x=1\\"></a><h3 class=\\"base-search-card__title\\"> Dev Jr </h3><h4 class=\\"base-search-card__subtitle\\">Acme</h4></div>"}')
    row = portals.linkedin(spark, str(tmp_path / "l.json")).first()
    assert (row["external_id"], row["title"], row["company"], row["url"]) == ("42", "Dev Jr", "Acme", "https://l.com/jobs/view/42")
    (tmp_path / "g.json").write_text('{"term":"dev","data":[{"id":"7","name":"QA","careerPageName":"Vagas","jobUrl":"https://acme-inc.gupy.io/7","publishedDate":"2026-02-01"},{"id":"8","name":"X","jobUrl":"u","publishedDate":"2025-12-31"}]}')
    got = portals.collect(spark, {"gupy": str(tmp_path / "g.json"), "linkedin": str(tmp_path / "l.json")}).orderBy("ord").collect()
    assert [(r["source"], r["external_id"], r["company"]) for r in got] == [("gupy", "7", "acme inc"), ("linkedin", "42", "Acme")]
    (tmp_path / "s.xml").write_text("<urlset><url><loc>https://a/dev-1</loc><lastmod>2026-03-01</lastmod></url><url><loc>https://a/dev-2</loc><lastmod>2025-03-01</lastmod></url></urlset>")
    assert [r["loc"] for r in portals.sitemap(spark, str(tmp_path / "s.xml"), F.lit("2026-01-01").cast("timestamp"), "dev").collect()] == ["https://a/dev-1"]


def test_stream_merges_each_file_once(spark, tmp_path):
    landed = str(tmp_path / "in")
    schema = "k long, v string"
    table = ingest.Snapshots(spark, str(tmp_path / "table"))

    def merged(old, batch):
        new = batch.dropDuplicates(["k"])
        return new if old is None else old.join(new, "k", "left_anti").unionByName(new)

    for rows in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
        ingest.merge_stream(ingest.arrivals(spark, landed, schema), table, merged, str(tmp_path / "ck")).awaitTermination()
    assert {tuple(r) for r in table.read().collect()} == {(1, "a"), (2, "c"), (3, "d")}
