"""HTML extraction: templates written by hand, and the whole page table."""
import html
import re
import time

import duckdb
from tidepool.llm import common, html_text, registry

SF = "/root/testdata/sf0.01"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head>
<body class="home"><div id="cookie-notice">We use cookies on this long line of text to track every visitor.</div>
<header><h2>Site name</h2><nav><a href="/">Home</a></nav></header>
<aside class="sidebar"><p>Recent posts with quite a long sentence inside of the side bar.</p></aside>
<article><header><h1>Title &amp; more</h1></header><p>First  paragraph <b>bold</b>,<br>next\nline.</p>
<div class="ad">Buy now! A long sentence of an advert that nobody wants to read.</div>
<p>Short.</p><ul><li>Point one</li><li>Point&nbsp;two</li></ul><form><p>Subscribe here</p></form>
<section class="comments"><p>A reader says something rather long here, as readers do.</p></section></article>
<footer><p>&copy; Footer</p></footer></body></html>"""


def test_template():
    assert html_text.main_text(PAGE)[0] == (
        "Title & more\n\nFirst paragraph bold, next line.\n\nShort.\n\nPoint one\n\nPoint two")


def test_odd_pages():
    assert html_text.main_text(None) == ("", 0, 0)
    assert html_text.main_text("") == ("", 0, 0)
    assert html_text.main_text("plain text &lt;here&gt;")[0] == "plain text <here>"
    assert html_text.main_text("<article><p>open<p>more")[0] == "open\n\nmore"
    assert html_text.main_text("<script>only code") == ("", 0, 0)
    assert html_text.main_text("<p>a < b and c > d</p>")[0] == "a < b and c > d"
    assert html_text.main_text("<nav><p>menu</nav><p>text")[0] == "text"
    assert html_text.main_text("<main><P CLASS='x'>Upper</P></main>")[0] == "Upper"
    assert html_text.main_text("<p>" + "long " * 100000)[0] == ("long " * 100000).strip()


def test_marks_and_quotes():
    text = lambda page: html_text.main_text(page)[0]
    assert text("<div class='content with-sidebar'><article><p>Own text</p></article></div>") == "Own text"
    assert text("<div class='banner-page sidebar'><article><p>Own text</p></article></div><p>other</p>") == "Own text"
    assert text("<p title=it's>Hello</p>") == "Hello"
    assert text("<p title='a > b' class=x>Hello</p>") == "Hello"
    assert text("<p>Let <math><mi>x</mi></math> be.</p>") == "Let x be."
    assert text("<article><p class='notice-period'>Three months.</p><p class='site-notice'>No.</p><p class='notice-box'>No.</p></article>") == "Three months."
    assert text("<article><p>Own</p><div class='page-main-left-sidebar-box'>no</div></article>") == "Own"
    long = "sentence of the text " * 20
    ad = "<div class='ad'>Buy this</div>"
    assert text(f"<p>{long}</p>{ad}<h2>A heading</h2>{ad}<p>{long}</p>").split("\n\n")[1] == "A heading"


def test_containers_inside_dropped_elements():
    """Comments written as articles neither count nor unsettle the page's own one."""
    page = ("<section class='comments'><article><p>a reader</p></article></section>"
            "<article><p>Own text</p></article><div class='related'><article>more</article></div>")
    assert html_text.main_text(page)[0] == "Own text"
    assert "a reader" not in html_text.main_text("<p>Own</p><div class='comments'><article>a reader</article></div>")[0]


def test_long_odd_pages_take_linear_time():
    n = 20000
    for page in ("<p>" * n + "</b>" * n, "<nav>" + "<i>" * n + "</b>" * n, "<b>" * n + "</p>" * n, "<a " * n,
                 "<p>x" * n + "</p>" * n, "<p a='" * n, "<!-- " * n, "<div class='ad'><p>" * n + "</div>" * n):
        at = time.perf_counter()
        html_text.main_text(page)
        assert time.perf_counter() - at < 2


def test_density_without_container():
    """Without an article, sparse lines beside the dense ones go."""
    menu = "".join(f"<div>m{i}</div>" for i in range(4))
    body = "".join(f"<p>{'sentence of the text ' * 12}{i}</p>" for i in range(4))
    text = html_text.main_text(f"<body><div>{menu}</div><aside>x</aside><div>{body}</div></body>")[0]
    assert text.count("sentence of the text") == 48 and "m1" not in text


def test_blocks_surge_and_dive():
    lines = [("", False), ("ab", False), ("", False), ("c", False)] + [("", False)] * 4 + [("d", False)]
    assert html_text.blocks(lines) == [(1, 4), (8, 9)]


def test_whole_table(spark):
    got = {r.page_id: (r.text, r.n_chars) for r in registry.QUERIES["op1_html_text"](spark, SF).collect()}
    rows = duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    for i, page in rows:
        own = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
        own = re.sub(r"<br\s*/?>", " ", own)
        parts = [html.unescape(re.sub(r"<[^>]+>", "", x)) for x in re.split(r"</?(?:p|h1|div|ul|li)\b[^>]*>", own)]
        want = "\n\n".join(x for x in (re.sub(r"\s+", " ", p).strip() for p in parts) if x)
        assert got[i] == (want, len(want))


def test_table_cases(spark):
    common.prepare(spark)
    rows = [(1, "u", PAGE, "x", 5), (1, "u", PAGE, "x", 5), (None, None, None, None, None), (2, None, "", "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = html_text.extract(pages).collect()
    assert len(got) == 4 and sum(r.n_chars == 0 for r in got) == 2
    assert html_text.extract(pages.limit(0)).count() == 0
