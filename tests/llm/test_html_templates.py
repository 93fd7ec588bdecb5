"""What recurs on the pages of a host goes if it is boilerplate, and stays if it is content."""

from pyspark.sql import functions as F

from quillwort.llm import htmltext, queries

SHARED = "<ul><li>first point of a list that several articles share in full</li><li>second point of the same list</li></ul>"


def page(i, host, inside, outside="", holder="article"):
    open_, close = (f"<{holder}>", f"</{holder}>") if holder else ("", "")
    return f"https://{host}/{i}", f"<body>{outside}{open_}<p>text number {i} of its own</p>{inside}{close}</body>"


def extracted(spark, rows):
    pages = spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, salt string, hashes string")
    got = htmltext.extract(pages)
    assert got.columns == ["page_id", "url", "html", "salt", "hashes", "text"]
    return {r["page_id"]: r["text"] for r in got.collect()}


def test_content_that_few_pages_share_stays_and_widgets_go(spark):
    rows = [page(i, "a.org", SHARED if i < 6 else "") for i in range(60)]
    rows += [page(i, "b.org", "<div><span>share this</span></div>") for i in range(6)]
    rows += [page(i, "c.org", "<p>a real paragraph of ten words that six pages share</p>" if i < 6 else "", holder="") for i in range(60)]
    rows += [page(i, "d.org", "", "<div>All rights are reserved by the owner of this site and others</div>", holder="") for i in range(40)]
    rows += [page(i, "e.org", "", "<div><a href='/x'>one</a> <a href='/y'>two more of the links that stand here</a></div>", holder="") for i in range(6)]
    got = extracted(spark, rows)
    assert got[0].endswith("second point of the same list") and got[10] == "text number 10 of its own"
    assert got[60] == "text number 0 of its own"
    assert got[66].endswith("six pages share")
    assert got[126] == "text number 0 of its own" and got[166] == "text number 0 of its own"


def test_query_is_whole_for_nulls_repeats_and_long_pages(spark, tmp_path):
    long = "<article>" + "<p>many words of a long page</p>" * 20_000 + "</article>"
    rows = [(1, "https://a.org/1", None), (2, None, "<p>a</p>"), (2, None, "<p>a</p>"), (3, "https://a.org/3", ""), (4, "https://a.org/4", long)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op5_html_text(spark, str(tmp_path))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert got.filter(F.length("text") != F.col("n_chars")).count() == 0
    told = sorted((r["page_id"], r["text"][:30], r["n_chars"]) for r in got.collect())
    assert told == [(1, "", 0), (2, "a", 1), (2, "a", 1), (3, "", 0), (4, "many words of a long page\nmany", 20_000 * 26 - 1)]
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "none" / "pages.parquet"))
    assert queries.op5_html_text(spark, str(tmp_path / "none")).count() == 0
