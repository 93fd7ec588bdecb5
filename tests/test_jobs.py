"""The import as one operation, upkeep of areas and workplaces, and texts that tell workplaces."""

import datetime

import pytest
from pyspark.sql import functions as F

from quillwort import jobs
from quillwort.functions import places, text, workplace
from quillwort.operators import classify as K
from quillwort.operators import merge as M
from quillwort.operators import skills as S
from quillwort.sources import files

AREAS = K.AreaRules({"Data": [("dados", 4.0)], "QA": [("testes", 4.0)]}, gate_title=["analista"])
RULES = jobs.Rules(AREAS, S.SkillRules.from_dict({"tools": {"Spark": ["spark"], "SQL": ["sql"]}}), K.PlaceRules.from_dict({"regioes": {"Nordeste": [{"nome": "Recife", "aliases": []}]}, "ufs_para_regioes": {"SP": "Sudeste"}}))
CSV = "ord long, source string, external_id string, title string, company string, location string, url string, description string, enrich_encerrada string, workplace_type string, workplace_declared string, published_date string, area string, skills string"


def test_import_merges_tells_and_links(spark):
    long = "Texto inteiro sobre spark. " * 30
    day = datetime.date(2026, 6, 1)
    saved = spark.createDataFrame([
        (1, "a", "x1", "Analista de dados", "Code Group", "Recife, PE", "https://www.site.com.br/vagas/1234567", long, True, "Remoto", True, day, "Data", False, "Recife", "Nordeste"),
        (2, "a", "x2", "Analista", "B", "Santos, SP", None, None, False, "Presencial", False, day, "QA", False, "Estado/SP", "Sudeste"),
        (3, "a", "x3", "Analista", "B", "Santos, SP", None, None, False, "Presencial", False, day, "QA", False, "Estado/SP", "Sudeste"),
    ], jobs.POSTING)
    vocabulary = spark.createDataFrame([(1, "Spark", "tools"), (2, "SQL", "tools")], "skill_id long, skill string, grp string")
    links = spark.createDataFrame([(1, 2), (2, 1), (3, 1)], "id long, skill_id long")
    batch = spark.createDataFrame([
        (1, "a", "other", "Analista de dados", "code-group", "Recife - pe", "https://www.site.com.br/vagas/1234567?x=1", "curto", "", "Presencial", "", "2026-06-02", "Outros/TI Geral", "sql"),
        (2, "a", "x2", "Analista", "C Ltda", "Santos/São Paulo", "", "", "1", "", "", "2026-06-02", "Outros/TI Geral", "nothing known"),
        (3, "b", "n1", "Analista de testes", "New", "Recife, PE", "", "Modelo de trabalho remoto", "", "", "", "2026-06-02", "", "SPARK, sql"),
        (4, "b", "n2", "Cozinheiro", "New", "Recife, PE", "", "", "", "", "", "2026-06-02", "", ""),
        (5, "b", "n1", "Analista again", "New", "Recife, PE", "", "", "", "", "", "2026-06-02", "", ""),
    ], CSV)
    after, linked = jobs.import_batch(saved, links, vocabulary, batch, RULES, F.lit("2026-06-03").cast("date"))
    got = {(r["source"], r["external_id"]): r for r in after.collect()}
    assert set(got) == {("a", "x1"), ("a", "x2"), ("a", "x3"), ("b", "n1")}
    one, two, new = got["a", "x1"], got["a", "x2"], got["b", "n1"]
    assert (one["id"], one["company"], one["location"], one["area"], one["workplace"], one["closed"]) == (1, "Code Group", "Recife, PE", "Data", "Remoto", True) and one["description"] == long
    assert (two["company"], two["location"], two["area"], two["closed"]) == ("C Ltda", "Santos, SP", "QA", True)
    assert (new["id"], new["title"], new["area"], new["workplace"], new["hub"], new["region"]) == (4, "Analista de testes", "QA", "Remoto", "Recife", "Nordeste")
    assert {tuple(r) for r in linked.collect()} == {(1, 1), (1, 2), (2, 1), (3, 1), (4, 1), (4, 2)}


def test_reextraction_tells_what_changes(spark):
    rows = spark.createDataFrame([(1, "a", "spark and sql"), (2, "b", None)], "id long, title string, description string")
    vocabulary = spark.createDataFrame([(1, "Spark"), (2, "SQL")], "skill_id long, skill string")
    now, changes = jobs.reextract(rows, spark.createDataFrame([(1, 1), (2, 2)], "id long, skill_id long"), vocabulary, RULES.skills)
    assert {tuple(r) for r in now.collect()} == {(1, 1), (1, 2)}
    assert {tuple(r) for r in changes.collect()} == {(1, 2, "added"), (2, 2, "removed")}


def test_source_against_others(spark):
    schema = "title string, company string, location string, published string, description string"
    own = spark.createDataFrame([("A", "x", "r", "d", "t"), ("a ", "X", "r", None, "t"), ("B", "x", "r", "d", "t")], schema)
    others = spark.createDataFrame([("b", "x", "r", None, None), ("c", "x", "r", None, None)], schema)
    assert tuple(jobs.evaluate_source(own, others).first()) == (3, 2, 1, 50.0, 66.7)


def test_workplaces_are_told_anew(spark):
    rows = spark.createDataFrame([
        (1, "linkedin", "a", "Dev", "Recife, PE", "Presencial", False, "Nada sobre isso", "Recife", "Nordeste"), (2, "linkedin", "b", "Dev", "Recife, PE", "Presencial", True, "Vaga remota", "Recife", "Nordeste"),
        (3, "linkedin", "c", "Dev", "Recife, PE", "Presencial", False, "", "Recife", "Nordeste"), (4, "other", "d", "Dev", "", "Presencial", False, "Vaga remota", "x", "y"),
    ], "id long, source string, external_id string, title string, location string, workplace string, workplace_declared boolean, description string, hub string, region string")
    curated = spark.createDataFrame([("c", "Remoto")], "external_id string, workplace string")
    got = {r["id"]: (r["workplace"], r["workplace_declared"], r["changed"]) for r in M.reclassify_workplaces(rows, RULES.places, curated).collect()}
    assert got == {1: ("Não informado", False, True), 2: ("Presencial", True, False), 3: ("Remoto", True, True), 4: ("Presencial", False, False)}


@pytest.mark.parametrize("body, want", [
    ("Oferecemos auxílio home office.", "Não informado"), ("O regime é de 3 dias presenciais e 2 dias de home office", "Híbrido"), ("Regime remoto", "Remoto"), ("Contrato de trabalho CLT presencial", "Presencial"),
    ("Cuidar da nuvem híbrida", "Não informado"), ("Prestar suporte presencial e remoto", "Não informado"), ("Vai trabalhar presencialmente 2x", "Não informado"), ("Vai trabalhar presencialmente", "Presencial"),
    ("", "Não informado"), (None, "Não informado"),
])
def test_texts_must_be_explicit_where_a_source_declares(spark, body, want):
    row = spark.createDataFrame([(body,)], "b string").select(workplace.infer_declared(F.lit(""), F.lit(False), F.lit("Recife, PE"), F.lit("Dev"), F.col("b")).alias("w"))
    assert row.first()["w"] == want


def test_references_expansions_and_places(spark):
    row = spark.createDataFrame([("<p>caf&#233; &#x27;a&rarr;b&#39; &amp;lt; &copy2020 &bogus;</p>", "eﬃcient ㎏", "Olinda - Pernambuco / Brasil")], "h string, t string, p string")
    got = row.select(text.strip_html(F.col("h")), text.normalize(F.col("t")), places.normalize_location(F.col("p"))).first()
    assert tuple(got) == ("café 'a→b' &lt; ©2020 &bogus;", "efficient kg", "Olinda, PE")


def test_log_counts_take_the_last_number(spark, tmp_path):
    (tmp_path / "a.log").write_text("n=5\nn=9\nother\nn=3\n")
    assert files.log_counts(spark, str(tmp_path), r"n=(\d+)").first()["n"] == 3
