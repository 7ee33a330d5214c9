"""Page queries against their SQL on odd pages: references cut before their semicolon, short articles, bodies without an end."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from loomspark.functions import details, dom

from .test_oracle import rows

LONG = "A notice of the board, with some words in it. " * 3
PAGES = [
    f"<title>Cut and &amp</title><body><article><h1>Cut and &amp</h1><p>Cut and &amp; so on. {LONG}</article></body>",
    "<title>Short</title><body><div class='ad'>Buy this here and now, while it is to be had.</div><article><h1>Short</h1>Short.</article></body>",
    "<title>Open end</title><body><div class='ad'>Buy this here and now, while it is to be had, all of it, in every shop of the whole town.</div><article><h1>Open end</h1><p>Nothing more to say of it than that.</article>",
    "<title>Both</title><body><div class='ad'>Buy this here and now, while it is to be had, all of it, in every shop of the whole town.</div><article><h1>Both</h1><p>Nothing more to say of it than that.</article></body>",
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    found = [(i, f"https://x.example.com/{i}", html) for i, html in enumerate(PAGES)]
    spark.createDataFrame(found, "page_id bigint, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return folder


def same_as_sql(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{folder}/pages.parquet/*.parquet')")
    ours = rows(entry.queries()[name](spark, folder).toPandas())
    assert ours == rows(con.execute(entry.oracle_sql()[name]).df()) and len(ours) == len(PAGES)


def test_densest_text_on_odd_pages(spark, odd):
    same_as_sql(spark, odd, "densest_text")


def test_whole_references_and_closed_bodies():
    text = "a&amp b &amp;lt; &lt &quot; &#x27; &#x2 &copy &nosuch; &ampD; & <script>x&&y &amp</script>"
    assert dom.parse(text, cut_references=False).raw_text() == "a&amp b &lt; &lt \" ' &#x2 &copy &nosuch; &ampD; & x&&y &amp"
    assert dom.parse("a&amp b").raw_text() == "a& b" and dom.parse("<body>x</body>").first("body").closed and not dom.parse("<body>x").first("body").closed
    assert details.dense_text(PAGES[3]).endswith("town.") and details.dense_text(PAGES[2], cut_pages=False, boxes=False) == ""


def test_page_details_on_odd_pages(spark, odd):
    same_as_sql(spark, odd, "page_details")
    assert details.parse_detail(PAGES[1])["body_selector"] == "heuristic-container" and details.parse_detail(PAGES[1], least=0)["content"] == "ShortShort."


def test_title_identity_on_odd_pages(spark, odd):
    same_as_sql(spark, odd, "title_identity")
