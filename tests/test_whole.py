"""Queries over whole tables, where the SQL of a query leaves rows out."""

from quillwort.plans import postings, registry


def test_documents_with_mail_addresses_have_skills(spark, tmp_path):
    rows = [(1, "write to ana@mail.com in the office of the town"), (2, "und die @ stupid"), (3, "of.the@mail.com only"), (4, "plain words of the town"), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["doc_id"], r["skill"]) for r in registry.QUERIES["skill_extract_whole"](spark, str(tmp_path)).collect()}
    assert got == {(1, "In"), (1, "Of"), (2, "Und"), (2, "Worth"), (4, "Of")}


def test_titles_are_whole_first_lines(spark, tmp_path):
    rows = [(1, "a first line of more than twenty characters\nbody", "en", "src0")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    assert postings._jobs(spark, str(tmp_path)).first()["title"] == rows[0][1].split("\n")[0]
