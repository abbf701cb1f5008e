import html
import re

import pytest

from lakesearch.llm.extraction import decoded, extracted, main_text, page_texts, train
from lakesearch.llm.pages import blocks_of, labelled_pages


@pytest.fixture(scope="module")
def field():
    return train()


def test_blocks_of_tag_soup():
    page = "<head><title>no</title></head><body><p>a &amp; <b>b</b>old<p>two<br>three<script>var x='</p>';</script><!-- <p>no --><ul><li>i<li>j</ul>5 < 6 <div class='x'>last"
    assert [b.text for b in blocks_of(page)] == ["a & bold", "two", "three", "i", "j", "5 < 6", "last"]
    assert blocks_of(None) == blocks_of("") == blocks_of("<p></p>") == []
    assert blocks_of("<p>x")[0].tags == ("p",) and blocks_of("<div id=mainText>x")[0].names == {"main", "text"}
    assert [b.text for b in blocks_of("a<!-- never closed <p>b")] == ["a"]


def test_held_out_pages(field):
    pages = labelled_pages(100, seed=7)
    right = [decoded(p, field.weights, field.moves.tolist()) == [b.main for b in p] for p in pages]
    assert sum(right) >= 95


def test_an_unknown_layout(field):
    page = """<body><div id="masthead"><a href="/">Site</a></div><div class="menu"><a href="/a">One</a> <a href="/b">Two</a></div>
      <div class="post-content"><h1>A heading</h1><p>First paragraph, with <a href="/l">a link</a> inside.</p>
      <p>Second&nbsp;paragraph &mdash; longer than the first one, and with   spaces.</p></div>
      <div class="sidebar"><h3>Popular</h3><p>Something that is not the article at all, but long enough.</p></div>
      <section class="comments"><p>Great article, I enjoyed reading this very much!</p></section><footer>&copy; 2024</footer>"""
    expected = "A heading First paragraph, with a link inside. Second paragraph — longer than the first one, and with spaces."
    assert main_text(page, field.weights, field.moves.tolist()) == expected


def test_edge_rows(spark, field):
    long = "<article>" + "<p>A sentence of the article, as usual.</p>" * 5000 + "</article>"
    rows = [(1, None), (2, ""), (3, "<nav><a href='/'>Home</a></nav>"), (None, "<article><p>Some text here.</p></article>"), (5, long), (5, long)]
    found = extracted(spark.createDataFrame([(*r, "old") for r in rows], "page_id long, html string, TEXT string"), field)
    assert found.columns == ["page_id", "html", "text"]
    got = {r["page_id"]: r["text"] for r in found.collect()}
    assert got[1] == got[2] == got[3] == "" and got[None] == "Some text here." and len(got[5]) == 5000 * 36 + 4999
    assert extracted(spark.createDataFrame([], "page_id long, html string"), field).count() == 0


def test_the_given_pages(spark):
    folder = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in page_texts(spark, folder).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        article = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br|div|ul|li)\b[^>]*>", " ", article))
        text = " ".join(html.unescape(re.sub(r"<[^>]+>", "", article)).split())
        assert (r["text"], r["n_chars"]) == (text, len(text))
