"""Main text of pages: given pages against plain regular expressions, and pages of other templates by hand."""

import html
import re

import pytest
from pyspark.sql import functions as F

from starforge.llm import extraction as X
from starforge.llm.queries import QUERIES

PAGES = "page_id long, url string, html string"


def text_of(page, wrapper=None):
    return X.main_text(page, wrapper)


def given_article(page):
    """The article of the given pages, which have one template."""
    article = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    lines = [" ".join(html.unescape(re.sub(r"</?b>", "", part.replace("<br>", " "))).split()) for part in re.split(r"</?(?:p|h1)>", article)]
    return "\n".join(x for x in lines if x)


def test_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op12_extraction"](spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        page = rows[r["page_id"]]
        assert r["url"] == page["url"] and r["text"] == given_article(page["html"]) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("page, expected", [
    ("<p>One  two<br>three</p><p>A &amp;lt; B&nbsp;&eacute;", "One two three\nA &lt; B é"),
    ("<p>a<b>b</b>c <i>d</i></p>tail", "abc d\ntail"),
    ("<ul><li>one<li>two <ul><li>in</ul><li>three</ul>", "one\ntwo\nin\nthree"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<title>t</title><script>var a='</p>x';</script><style>p{}</style><p>x</p><!-- <p>no</p> --><script>if (a<b) {", "x"),
    ("<p>before</p><!-- open <p>gone", "before"),
    ("<a href='x>y' title=\"<p>\">link</a> and <b>text</b>", "link and text"),
    ("1 < 2 and 3<4 & 5", "1 < 2 and 3<4 & 5"),
    ("<nav>m</nav><header><h1>Site</h1></header><main><h1>T</h1><article><header><h2>H</h2><p>by x</p></header><p>body</p><footer>f</footer>"
     "<section class='comments'><article class='comment'><p>c</p></article></section></article><aside>s</aside></main><footer>x</footer>", "T\nH\nbody"),
    ("<div class='sidebar-left'>s</div><div class=post-content><p>a <span class='ad'>buy</span> b</p><form>f <p>g</p></form></div><div>other</div>", "a b"),
    ("<div id='cookieNotice'>We use cookies</div><div role=navigation>m</div><p>x</p>", "x"),
    ("<article><p>a</p></article><article><p>b</p></article>", "a\nb"),
    ("<pre>x\n  y</pre><h1>T</h1>", "x y\nT"),
    ("<noscript>n</noscript><select><option>o</select><button>b</button><textarea><p>t</textarea>x", "x"),
    ("", ""), (None, ""), ("   ", ""), ("<p></p>", ""),
])
def test_markup(page, expected):
    assert text_of(page) == expected


def test_deep_and_long_pages():
    assert text_of("<div>" * 5000 + "x" + "</div>" * 5000 + "<p>y") == "x\ny"
    assert text_of("<p>" + "wort " * 300_000) == ("wort " * 300_000).strip()
    assert text_of("".join(f"<p>{i}</p><div class='c{i}'>x</div>" for i in range(3000))).count("\n") == 5999
    assert text_of("<p " * 20_000) == ""


def site(k, body):
    """A host's template without telling classes or tags: fixed lines, a list of links, the page's own text."""
    links = "".join(f"<a href='/{i}'>Topic {(k * 7 + i) % 50}</a> " for i in range(k % 3 + 2))
    promo = "<div><b>Subscribe today</b></div>" if k % 4 else ""
    return f"<div>My Site of News</div><div>{links}</div>{promo}<div><h1>Title {k}</h1>{body}</div><div>All rights reserved</div>"


def test_wrappers_drop_what_pages_share(spark):
    bodies = ["".join(f"<p>Paragraph {k} {i} of its own.</p>" for i in range(k % 5 + 1)) + ("<ul><li>a<li>b</ul>" if k % 3 == 0 else "") for k in range(40)]
    rows = [(k, f"http://News.example.org/{k}", site(k, b)) for k, b in enumerate(bodies)]
    rows += [(100 + k, "http://news.example.org/copy", rows[3][2]) for k in range(60)]  # copies are one page
    rows += [(200 + k, f"http://copies.example.org/{k}", "<div>Same</div><p>text on all pages</p>") for k in range(30)]
    rows += [(300, "http://single.example.org/", "<div>Only page</div><p>here</p>"), (301, None, None), (302, "no url", ""), (None, "http://[x", "<p>odd</p>")]
    pages = spark.createDataFrame(rows, PAGES)
    for c in ("host", "wrapper", "pages", "text", "n_chars", "parts", "deal"):
        pages = pages.withColumn(c, F.lit("clash"))
    got = {r["page_id"]: r["text"] for r in X.extract(pages.repartition(9), fan_in=2).collect()}
    assert len(got) == len(rows)
    for k, b in enumerate(bodies):
        own = [f"Title {k}"] + re.findall(r"Paragraph \d+ \d+ of its own\.", b) + (["a", "b"] if k % 3 == 0 else [])
        assert got[k] == "\n".join(own)
    assert all(got[100 + k] == got[3] for k in range(60))
    assert all(got[200 + k] == "Same\ntext on all pages" for k in range(30))  # copies alone don't make a template
    assert (got[300], got[301], got[302], got[None]) == ("Only page\nhere", "", "", "odd")


def test_wrapper_is_one_per_host_and_bounded(spark):
    rows = [(k, f"http://h{k % 3}.org/", "".join(f"<{t}>x{k}</{t}>" for t in ("h2", "p", "ul", "p", "pre", "ol", "p")[k % 4:] * (k % 6 + 1))
             + "".join(f"<div class='a{chr(97 + (k + i) % 26)}{'bcdefgh'[i % 7] * (i % 40)}'>y</div>" for i in range(k))) for k in range(90)]
    found = X.infer_wrappers(spark.createDataFrame(rows, PAGES).withColumn("host", X.host_of(F.col("url"))).repartition(7), fan_in=3).collect()
    assert sorted((r["host"], r["pages"]) for r in found) == [(f"h{i}.org", 30) for i in range(3)]
    assert all(len(r["wrapper"]) < 60_000 for r in found)


def test_alignment_of_levels():
    def w(page):
        return X.page_wrapper(X.parse(page)[0], 1)

    a = X.merge(w("<h1>T</h1><p>x</p><p>y</p><hr><footer>f</footer>"), w("<h1>U</h1><ul><li>1<li>2</ul><p>z</p><footer>f</footer>"))
    assert [(x[0], x[1], x[2]) for x in a] == [("h1", False, False), ("ul", True, False), ("p", False, True), ("footer", False, False)]
    assert a[0][3][0][2] is None and a[3][3][0][2] is not None  # a slot, and a text that stays
    assert a[1][3][0][:3] == ["li", False, True]
    pairs = w("<dl>" + "".join(f"<dt>k{i}</dt><dd>v{i}</dd>" for i in range(4)) + "</dl>")
    assert [x[0] for x in pairs[0][3]] == ["(dt dd"]


def test_empty_pages(spark):
    none = spark.createDataFrame([], PAGES)
    assert X.extract(none).count() == 0
    assert [tuple(r) for r in X.extract(spark.createDataFrame([(5,)], "page_id long")).collect()] == [(5, None, "", 0)]


def test_hosts(spark):
    urls = ["http://A.b/x", "https://u:p@A.b:8080?q", "HTTP://a#f", "ftp://x y", "//a/b", "", None]
    got = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES).orderBy("page_id").select(X.host_of(F.col("url")).alias("h")).collect()
    assert [r["h"] for r in got] == ["a.b", "a.b:8080", "a", "x", "", "", ""]
