import html
import re

import numpy as np
import pytest

from lynxrisk.llm import html_text
from lynxrisk.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
LONG = "many words of running text without any markup in between " * 3


def test_given_pages_against_a_plain_version(spark):
    """On the given pages the article's element is known, so its blocks can be cut out by patterns."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = QUERIES["op11_html_text"](spark, FOLDER).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1|b)>|<br>", article)]
        want = "\n".join(b for b in blocks if b)
        assert r.text == want and r.n_chars == len(want)


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("plain text\n of no  element", "plain text of no element"),
        ("<p>a &amp b &lt;i&gt; &copy;&nbsp;c<br>d</p>", "a & b <i> © c d"),
        ("<script>var a='<p>no</p>';</script><style>p{}</style><title>t</title><p>yes</p>", "yes"),
        ("<p>cut <b>off</b> her<a href='x", "cut off her"),
        ("<p>before</p><!-- never ends <p>no</p>", "before"),
        ("<![unknown[ x ]]><p>y</p><?pi z?>", "y"),
        ("<article><p>in<p>side</article><footer><p>out</p></footer>", "in\nside"),
        (f"<main><p>{LONG}</p><p>short</p></main><div><p>other {LONG}</p></div>", f"{LONG.strip()}\nshort"),
        ("<article><header><h1>Title</h1><p>by me</p></header><p>one <span class='ad'>buy</span> two <button>ok</button>three</p></article>", "Title\none two three"),
        (f"<article><p>{LONG}</p><section id='comments'><p>{LONG}</p></section><aside>x</aside><form><p>y</p></form></article>", LONG.strip()),
        ("<div class='cookie-notice'><p>We use cookies</p></div><div class='with-sidebar'><p>text</p></div>", "text"),
        ("<div hidden><p>no</p></div><div style='display: none'>no</div><p>yes</p>", "yes"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "one\ntwo\na\nb\nc"),
    ],
)
def test_cases(page, want):
    assert html_text.main_text(page) == want


def test_ratios_choose_the_region_without_named_elements():
    """Neither a link list nor a short top line says what it is; the tag ratios tell."""
    links = "".join(f"<li><a href=/{i}><b>link</b></a></li>" for i in range(30))
    page = f"<div><div><b>Name</b><i>x</i></div><div><ul>{links}</ul></div><div><h2>Head</h2><p>{LONG}</p><p>mid</p><p>{LONG}</p></div><div><ul>{links}</ul></div></div>"
    assert html_text.main_text(page) == f"Head\n{LONG.strip()}\nmid\n{LONG.strip()}"


def test_smoothing_and_threshold_against_loops():
    rng = np.random.default_rng(3)
    ratios = rng.random(40) * 50
    for i, s in enumerate(html_text.smooth(ratios)):
        weights = [(np.exp(-((j - i) ** 2) / (2 * html_text.SIGMA**2)), ratios[j]) for j in range(40) if abs(j - i) <= 5]
        assert abs(s - sum(w * v for w, v in weights) / sum(w for w, _ in weights)) < 1e-9
    assert 2 < html_text.threshold(np.array([1.0, 2, 1, 50, 60, 2])) < 50
    assert html_text.threshold(np.array([7.0, 7.0])) == 7


@pytest.mark.parametrize("page", ["<" * 100_000, "<!--" * 50_000, "<a " * 200_000, "</a" * 200_000, "<div>" * 50_000 + "x" + "</section>" * 50_000, "&" * 200_000, "<![x" * 50_000])
def test_broken_pages_end_in_time(page):
    html_text.main_text(page)


def test_edges(spark):
    long_page = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    rows = [(1, None, "a", "x"), (None, "", "a", "x"), (2, long_page, None, "x"), (3, "<p>q</p>", "a", "x"), (3, "<p>q</p>", "a", "x")]
    pages = spark.createDataFrame(rows, "page_id long, html string, Text string, `a.b` string")
    got = html_text.extract(pages)
    assert got.columns == ["page_id", "html", "a.b", "text", "n_chars"]
    texts = sorted((str(r.page_id), r.text.count("\n"), r.n_chars) for r in got.collect())
    assert texts == [("1", 0, 0), ("2", 19_999, 20_000 * len(LONG.strip()) + 19_999), ("3", 0, 1), ("3", 0, 1), ("None", 0, 0)]
    assert html_text.extract(pages.limit(0)).count() == 0
