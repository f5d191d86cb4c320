"""URL reputation and HTML extraction."""

import html
import math
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerostrata.llm.common import table
from aerostrata.llm.html_tree import Model, Page, extract, train
from aerostrata.llm.url_reputation import filter_urls

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [h + p for _, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x?q#f", "https://example.org", "https://a.example.org/en/12", "x://b.com/fr/1",
        "http://notexample.org/es/", "http://com/de/", "http://É.com/de/a://b", "http://h.com?x=/de/", "http://u@h.com:80/fr/\n/z", "http://h.net/a#b?c"]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(0, None, "x", "y")], "page_id long, url string, host string, low string")
    none = spark.createDataFrame([], "page_id long, bad int")
    rows = filter_urls(pages, none).collect()
    assert len(rows) == len(URLS) + 1
    what = {h + p: v for v, h, p in RULES}
    for r in rows:
        assert (r.host, r.path, r.rule) == plain(URLS[r.page_id])
        assert r.verdict == what.get(r.rule, "allow")
    assert filter_urls(pages.limit(0), none).count() == 0


def test_reputation(spark):
    hosts = ["bad.farm.net"] * 40 + ["new.farm.net"] + ["ok.site.net"] * 40 + ["once.site.net"] + ["x.farm.net"] * 20
    pages = spark.createDataFrame([(i, f"http://{h}/p") for i, h in enumerate(hosts)], "page_id long, url string")
    marks = [(i, int("farm" in h)) for i, h in enumerate(hosts) if h not in ("new.farm.net", "once.site.net")] + [(81, 1), (81, 0), (5, 1), (None, 1)]
    got = {r.host: (r.verdict, r.low) for r in filter_urls(pages, spark.createDataFrame(marks, "page_id long, bad int")).collect()}
    assert got["bad.farm.net"][0] == got["x.farm.net"][0] == "block"
    assert got["ok.site.net"][0] == got["once.site.net"][0] == "allow"
    assert got["new.farm.net"][1] > got["once.site.net"][1]
    assert got["bad.farm.net"][1] > got["new.farm.net"][1]


def brute(model, page):
    """Log odds by summing over all labellings; only for tiny pages."""
    n = len(page.tag)
    local = model.local(page)
    mass = np.zeros((n, 2))
    for bits in range(1 << n):
        y = [bits >> i & 1 for i in range(n)]
        logp = sum(e for e, b in zip(local, y, strict=True) if b)
        for i in range(1, n):
            p = model.given[page.kind(page.parent[i]), y[page.parent[i]]]
            logp += math.log(p if y[i] else 1 - p)
        for i in range(n):
            mass[i, y[i]] += math.exp(logp)
    return np.log(mass[:, 1] / mass[:, 0])


def test_messages_give_exact_marginals():
    model = Model({("tag p", 1): 9.0, ("tag p", 0): 4.0, ("tag div", 0): 30.0, ("tag div", 1): 20.0, ("pair part 1", 0): 9.0, ("links 0", 1): 3.0})
    page = Page("<body><div><p>one <a>two</a></p><p>three</p><div class=ad>x</div></div><ul><li>y<li>z</ul>")
    assert len(page.tag) <= 12
    assert np.allclose(model.marginals(page), brute(model, page), atol=1e-6)


@pytest.fixture(scope="module")
def model(spark, sf):
    return train(table(spark, sf, "pages"), table(spark, sf, "documents"))


def test_given_pages(spark, sf, model):
    rows = extract(table(spark, sf, "pages"), model).join(table(spark, sf, "pages"), ["page_id", "url"]).collect()
    for r in rows:
        inside = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub("<[^>]*>", " ", inside)).split()), r.page_id
        assert r.n_chars == len(r.text)


PAGE = """<!DOCTYPE html><html class="comments-open"><head><title>t</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><div id="cookie-notice"><p>We use cookies here</p></div><main><div class="post"><h1>Title &amp; more</h1>
<p>First <i>para</i> with <a href=x>link</a>ed   text &lt;here&gt;.<p>Second <b>bold</b><br>para.</p><ul><li>one<li>two</ul><blockquote>Quote</blockquote>
<!-- <p>no</p> --><pre>a   b
c</pre><div class="ad-slot"><p>Buy</p></div><table><tr><td>x<td>y</table><p>5 &#60; 6 & 7</p></div></main><aside><p>side</p></aside>
<section id="comments"><div class="comment"><p>I liked this article very much indeed</p></div></section>
<form><label>Mail</label></form><script>var a="<p>no</p>";</script><noscript>off</noscript><footer><p>(c)</p></footer></body></html>"""


def test_other_layouts(model):
    assert model.text(PAGE) == "Title & more First para with linked text <here>. Second bold para. one two Quote a b c x y 5 < 6 & 7"


def test_odd_pages(spark, model):
    rows = [(1, None, "u"), (2, "", "u"), (3, "plain words only", "u"), (4, "<p>open", "u"), (5, "<!-- never closed <p>x", "u"), (6, "</div></p>a < b", "u"),
            (7, "<script>x", "u"), (8, "<p>" * 3000 + "deep", "u"), (9, "<div>" * 3000 + "deep text", "u"), (None, "<p>x</p>", None), (4, "<p>open", "u")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, html string, url string, text string")
    out = extract(df, model)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, ""), (2, ""), (3, "plain words only"), (4, "open"), (4, "open"), (5, ""), (6, "a < b"), (7, ""), (8, "deep"), (9, "deep text"), (None, "x")], key=str)


def test_model_without_labels(spark):
    none = train(spark.createDataFrame([], "page_id long, url string, html string"), spark.createDataFrame([], "doc_id long, text string"))
    assert none.text("<body><nav>m</nav><article><p>text</p></article></body>") == "text"


def test_given_pages_without_known_names(spark, sf):
    bare = train(table(spark, sf, "pages"), table(spark, sf, "documents"), known=set())
    for r in extract(table(spark, sf, "pages").select("page_id", "html", F.col("html").alias("source")), bare).collect():
        inside = re.search("<article>(.*?)</article>", r.source, re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub("<[^>]*>", " ", inside)).split()), r.page_id


def test_labels_outweigh_known_names():
    counts = {("like 1", 1): 4000.0, ("like 1", 0): 4000.0, ("word notice", 1): 3000.0, ("word notice", 0): 3.0}
    model = Model(counts)
    assert model.weight["word notice"] > 2 and model.weight["word advert"] < -8
    page = "<body><article><p>one</p><div class=notice><p>two</p></div><div class=advert><p>three</p></div></article></body>"
    assert model.text(page) == "one two"


@pytest.mark.parametrize("part", ["<a ", '<p title="', "<p title='\"", "<div>", "</div>", "<b class=x>", "<b class=ad><div></b>", "<i>x</i>y", "<!-- ", "&#9"])
def test_long_broken_pages_take_linear_time(part):
    model, took = Model({}), []
    for size in (100_000, 800_000):
        start = time.perf_counter()
        model.text(part * (size // len(part)))
        took.append(time.perf_counter() - start)
    assert took[1] < 5 + 24 * took[0]


def test_broken_tags():
    model = Model({})
    assert model.text('<p title="a>b">one<p title=">two') == "one two"
    assert model.text("<p>one <b two") == "one <b two"
    assert model.text("<p>&#" + "9" * 6000 + ";x &#" + "0" * 6000 + "65;") == "�x A"
