import time
import tracemalloc

import duckdb

from llm_helpers import SF_SMALL
from releasemill.llm import htmltext, queries

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="with-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/a">a</a></li></ul></nav>
<!-- <p>no</p> --><div class="ad">buy</div><div id="cookie-notice">ok</div>
<main><article class="post-12"><h1>T &amp; x</h1><p><b>First  para<br><p>Second <i>it</i>alic &lt;ok&gt;.</p>
<ul><li>one<li>two</ul><section class="comments"><p>nice</p></section></article></main>
<aside>s</aside><form><label>e</label></form><footer>&copy; f</footer></body></html>"""


def test_article_without_chrome():
    assert htmltext.extract(PAGE, None) == "T & x\nFirst para\nSecond italic <ok>.\none\ntwo"


def test_paths_are_generalised():
    assert dict(htmltext.votes(PAGE))["html>body.with-sidebar>main>article.post-"] == 1000


def test_fragments_and_broken_markup():
    assert htmltext.extract(None, None) == htmltext.extract("", "x") == ""
    assert htmltext.extract("plain & 1 < 2 <3", None) == "plain & 1 < 2 <3"
    assert htmltext.extract("<p>a<p>b<table><tr><td>x<td>y<tr><td>z</table>", None) == "a\nb\nx y\nz"
    assert htmltext.extract('<p title="a>b">c</p></div><p class="q>d', None).startswith("c")
    assert htmltext.extract("<nav>only</nav>", None) == ""
    assert htmltext.extract("<script>never ends", None) == ""
    assert htmltext.extract("<div>" * 3000 + "deep" + "</div>" * 3000, None) == "deep"


def test_visible_text_is_not_taken_for_chrome():
    attributes = [
        'style="overflow:hidden"', 'aria-hidden="false"', "data-hidden", 'title="a hidden place"',
        'data-class="ad"', 'class="overflow-hidden"', 'class="top-story"', 'class="side-by-side"',
        'class="commentary"', 'class="social-issues"', 'class="elementor-widget"',
    ]
    for own in attributes:
        page = f"<body><div><p>{'usual text ' * 20}</p><div {own}><p>seen</p></div></div></body>"
        assert htmltext.extract(page, None).endswith("\nseen"), own
    for own in ("hidden", "HIDDEN=''", 'role=navigation', 'class="x ad"', 'id="site-footer"', 'class="comments"'):
        page = f"<body><div><p>{'usual text ' * 20}</p><div {own}><p>unseen</p></div></div></body>"
        assert "unseen" not in htmltext.extract(page, None), own
    page = f"<body><div class='widget'><p>{'usual text ' * 20}</p></div><div class='widget'>more</div></body>"
    assert htmltext.extract(page, None) == ("usual text " * 20).strip()


def test_consensus_overrules_a_page(spark):
    """A page whose own best container is another one follows its host, if it has its article there."""
    usual = "<body><div class='story'><p>{0}</p></div><div class='more'><p>short</p></div></body>"
    odd = "<body><div class='story'><p>{1}</p></div><div class='more'><p>{0}</p></div></body>"
    rows = [(k, f"http://h.example.org/{k}", usual.format("long text " * 30)) for k in range(20, 32)]
    rows += [(9, "http://h.example.org/9", odd.format("aside " * 40, "kept words " * 12))]
    rows += [(8, "http://h.example.org/8", odd.format("an article " * 40, "teaser only"))]
    rows += [(10, None, "<p>x"), (11, "no", None), (11, "no", None)]
    pages = spark.createDataFrame(
        [(*r, "p", "h") for r in rows], "page_id long, url string, html string, path string, host string"
    )
    found = {r.page_id: r for r in htmltext.extracted(pages).collect()}
    paths = htmltext.consensus(pages.selectExpr("url host", "html").where("page_id >= 20"), "host", "html")
    assert {r.path for r in paths.collect()} == {"html>body>div.story"}
    assert found[9].text == ("kept words " * 12).strip()
    assert ("an article " * 40).strip() in found[8].text
    assert found[10].text == "x" and found[11].text == "" and found[11].n_chars == 0
    assert htmltext.extracted(pages).count() == 17
    assert htmltext.extracted(pages.limit(0)).count() == 0


def test_formulas_are_text():
    page = "<p>Formula <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds"
    assert htmltext.extract(page, None) == "Formula x=2 holds"


def test_depth_and_stray_marks_cost_linear_memory_and_time():
    depth = 50_000
    pages = [
        "<div class='block'>" * depth + "deep" + "</div>" * depth,
        "<article>" * depth + "deep",
        "<div>" * depth + "deep" + "</foo>" * depth,
        "<b>" * depth + "deep" + "</i>" * depth,
        "deep" + "<a " * depth,
    ]
    start = time.monotonic()
    for page in pages:
        assert htmltext.extract(page, "html>body>div.story").startswith("deep")
        assert len(list(htmltext.votes(page))) <= htmltext.VOTES
    assert time.monotonic() - start < 60
    tracemalloc.start()
    htmltext.extract("<div class='block'>" * 20_000 + "deep", None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 << 20


def test_templates_of_a_host_and_pages_without_one(spark):
    news = "<body><article class='news'><p>" + "long text " * 30 + "</p></article></body>"
    other = "<body><article class='news'><p>teaser</p></article><article class='review'><p>{0}</p></article></body>"
    review = "its own words " * 30
    rows = [(k, f"http://h.example.org/{k}", news) for k in range(6)]
    rows += [(k, f"http://h.example.org/{k}", other.format(review)) for k in range(6, 9)]
    rows += [(k, None, news) for k in range(10, 15)] + [(15, None, other.format(review))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in htmltext.extracted(pages).collect()}
    assert all(review.strip() in found[k] for k in (6, 7, 8, 15))
    assert all(found[k] == ("long text " * 30).strip() for k in (0, 5, 10))


def test_query_returns_the_articles(spark):
    found = queries.QUERIES["op2_html_text"](spark, SF_SMALL).collect()
    pages = dict(duckdb.execute(f"SELECT page_id, html FROM '{SF_SMALL}/pages.parquet'").fetchall())
    assert sorted(r.page_id for r in found) == sorted(pages)
    for row in found:
        inner = pages[row.page_id].split("<article>", 1)[1].split("</article>")[0]
        assert row.text == htmltext.extract(f"<article>{inner}</article>", None)
        assert row.n_chars == len(row.text)
        assert "<" not in row.text.replace("<", "", inner.count("&lt;"))
