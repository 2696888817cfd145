"""Main text of pages against the text that a page is known to hold."""

import html
import re
import time

import pytest

from funnelloom.llm import html_text as H
from funnelloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
PROSE = [f"Line {i} of the prose speaks of rivers, hills and the towns between them." for i in range(60)]


@pytest.fixture(scope="module")
def trees():
    return H.fit(PROSE)


def marked(page: str) -> str:
    """Text of the elements that the layout marks as content, by another parser."""
    kept = re.sub(r"<[^>]*>", "\n", "".join(re.findall("\x02(.*?)(?=</p>|<br>|</h1>|</h2>|</li>)", page, re.S)))
    return re.sub(r"\s+", "", html.unescape(kept))


def test_laid_out_pages(trees):
    # Some laid-out boilerplate bears no sign at all, so that not every page can be right.
    pages = H.training_pages(PROSE, 120, seed=9)
    found = H.extract([p.replace("\x02", "") for p in pages], trees)
    same = sum(marked(p) == re.sub(r"\s+", "", f) for p, f in zip(pages, found))
    assert same >= 0.9 * len(pages)


def test_blocks_and_references(trees):
    page = (
        "<html><head><title>T</title><script>var x = '<p>no</p>';</script></head><body><nav><a href=/>Home</a></nav>"
        "<article><h1>Rivers &amp; hills</h1><p>Line one of the\n  prose speaks of <b>rivers</b>, hills and towns.</p>"
        "<p>Line two of the prose&#33; It speaks of the towns between them.</p></article><footer>About us</footer></body></html>"
    )
    assert H.extract([page], trees) == [
        "Rivers & hills\nLine one of the prose speaks of rivers, hills and towns.\nLine two of the prose! It speaks of the towns between them."
    ]


def test_odd_pages(trees):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert H.extract([None, "", "<!-- open", "<script>x"], trees) == [""] * 4
    assert len(H.extract([deep, "x" * 2_000_000, "<p>" * 10_000], trees)) == 3
    assert H.extract([], trees) == []


def test_query_and_clashing_columns(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    found = QUERIES["op6_html_text"](spark, FOLDER).collect()
    assert len(found) == pages.count() and all(r.n_chars == len(r.text) for r in found)
    assert sum(r.n_chars > 0 for r in found) > 0.95 * len(found)
    rows = [(None, None, None, "x"), (1, "u", "", "x"), (1, "u", "", "x")]
    odd = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert [tuple(r) for r in H.extracted(odd, 60).collect()] == [(None, None, "", 0), (1, "u", "", 0), (1, "u", "", 0)]
    assert H.extracted(odd.limit(0), 60).collect() == []


@pytest.mark.parametrize(
    "page", ["<a " * 350_000, '<a "' * 250_000, "<a \"x' '" * 120_000, "<a<a" * 250_000, "<div>" * 60_000 + "</p>" * 60_000, "<b>" * 60_000 + "<p>" * 60_000, "<!" * 500_000]
)
def test_broken_pages_take_time_in_proportion(page):
    began = time.process_time()
    H.parse(page)
    assert time.process_time() - began < 4


def test_marks_of_broken_tags():
    tags = lambda page: [n.tag for n in H.parse(page)[1:]]
    assert tags('<p class="a>b">x</p><b') == ["p"]
    assert tags("<p title='>'><a href=\"<i>\">y") == ["p", "a"]
    assert tags('<a "><p>') == ["p"]
    assert tags("<p><!-- <b> --><i><!x><?y>") == ["p", "i"]
    assert tags("<P/><br><br/>") == ["p", "br", "br"]


def test_pages_give_the_text_of_their_article(spark):
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    same = seen = 0
    for r in QUERIES["op6_html_text"](spark, FOLDER).collect():
        whole = re.findall(r"<article\b[^>]*>(.*?)</article>", rows[r.page_id], re.S)
        if len(whole) == 1:
            seen += 1
            plain = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"(?s)<(script|style|aside|nav|form|footer)\b.*?</\1>", "", whole[0])))
            same += re.sub(r"\s", "", plain) == re.sub(r"\s", "", r.text)
    assert seen >= 100 and same >= 0.97 * seen, (same, seen)
