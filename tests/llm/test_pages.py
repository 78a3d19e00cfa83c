"""HTML extraction and URL filter."""

import itertools
import re

import pytest

from sparquill.llm import html_main, urls

NOISE = '<script>var t="</p>, a, b, c";</script><style>p{}</style><nav><ul><li><a href="/x">Home, start</a></li><li><a href="/y">News</a></li></ul></nav>'


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain, no tags", "plain, no tags"), ("<p>x", "x"), ("a < b &lt; c", "a < b < c"), ("<nav>menu</nav>", ""), ("cut <a href='", "cut"),
    (f"<html><head><title>T</title></head><body>{NOISE}<div class='ad'>Buy, buy, buy, now</div><article><h1>Head &amp; line</h1><p>One,\n  two <b>thr</b>ee.<p>Four&nbsp;five<br>six</article><footer>&copy; x</footer>", "Head & line One, two three. Four five six"),
    (f"<body>{NOISE}<div id='cookie-notice'><p>We use cookies, yes, here, and there.</p></div><div class='post'><p>Alpha, beta, gamma.</p><p>Delta, epsilon.</p></div><div class='comments'><p>First, nice, very nice, so nice.</p></div>", "Alpha, beta, gamma. Delta, epsilon."),
    ("<body><div><section><p>Part one, of some length.</p></section><section><p>Part two, of some length.</p></section></div><aside><p>side, side, side</p></aside><form><p>your, name, please</p></form>", "Part one, of some length. Part two, of some length."),
    ("<body><div><p>Text, and more of it, in the page.</p><ul><li>a point, made</li><li>another</li></ul></div><div><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul></div>", "Text, and more of it, in the page. a point, made another"),
    ("<article><p>Body, text.</p><article class='comment'><p>Reader, says, so, much, more.</p></article></article>", "Body, text."),
    ("<p>1<!-- <p>hidden --><?php x ?><![CDATA[y]]>2</p><!-- open", "12"), ("<div>" * 4000 + "deep", "deep"), ("</p></div>" * 3000 + "x", "x"),
    ("<p title='a > b' data-x=\"<p>\">quoted</p>", "quoted"), ("<table><tr><td>c1<td>c2<tr><td>c3</table>", "c1 c2 c3"), ("<p>&#233;&eacute;&#x1F600;&bogus; &am", "éé😀&bogus; &am"),
])
def test_main_text(html, text):
    assert html_main.main_text(html) == text


def test_extract(spark):
    rows = [(1, "u", "<p>A, b"), (1, "u", "<p>A, b"), (None, None, None), (2, "v", ""), (3, "w", "<p>" + "word, " * 50_000)]
    table = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in html_main.extract(table).collect())
    long = ("word, " * 50_000).strip()
    assert got == [(0, "", "", 0), (1, "u", "A, b", 4), (1, "u", "A, b", 4), (2, "v", "", 0), (3, "w", long, len(long))]
    assert html_main.extract(table.limit(0)).collect() == []


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match("[^?#]*", rest[len(host) :]).group()


def rule_of(host, path):
    fit = [(len(r), r, v) for r, v in urls.RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fit)[1:] if fit else (None, None)


def test_rules_and_model(spark):
    hosts = ("example.com", "WWW.Example.com", "a.www.example.com", "notexample.com", "com", "x.com", "b.net", "example.org", "ÉX.com", "")
    tails = ("", "/", "/en/5", "/en", "/es/x?q=/fr/#y", "/fr/", "?a=/en/", "#/en/", "/EN/")
    rows = [(k, f"{scheme}{h}{t}") for k, (scheme, h, t) in enumerate(itertools.product(("http://", "x://y://", "//", ""), hosts, tails))] + [(None, None), (9999, ""), (9999, ""), (9998, "http://" + "a" * 100_000)]
    table = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, host string, path string")
    got = {r.page_id: r for r in urls.judge(table).collect()}
    assert urls.judge(table).count() == len(rows)
    for i, url in rows:
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if (r.score or 0) > 0.5 else "allow")) and (r.score is None) == (rule is not None or host == "")
    assert urls.judge(table.limit(0)).collect() == []


def test_held_out_accuracy(spark):
    """Trained on two thirds of the labelled table, the model is right on most of the rest."""
    table = urls.labelled_table(spark)
    fold = table.selectExpr("*", "pmod(xxhash64(url), 3) as fold").cache()
    right = total = 0
    for k in range(3):
        held = fold.where(f"fold = {k}")
        scored = urls.judge(held.selectExpr("url as page_id", "url"), fold.where(f"fold <> {k}"), rules=())
        said = {r.page_id: r.verdict for r in scored.collect()}
        for r in held.collect():
            right += said[r.url] == ("block" if r.label else "allow")
            total += 1
    assert right >= 0.85 * total
