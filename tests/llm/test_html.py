import pytest

from tabml.llm import html_layout
from tabml.llm.html_layout import render

CASES = [
    ("plain &amp; &lt;text&gt;  with\n spaces", "plain & <text> with spaces"),
    ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
    ("a<br>b<br/>c", "a\nb\nc"),
    ("<b>bo</b>ld <i> spaced </i>out", "bold spaced out"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=3><li>c<li value=7>d<li>e</ol>", "3. c\n7. d\n8. e"),
    ("<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td>x<td>22</table>", "Name       N\nlong name  1\nx          22"),
    ("<table><caption>Cap</caption><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>", "Cap\nwide  z\na  b  c"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"),
    ("<dl><dt>term<dd>def<dt>t2<dd>d2</dl>", "term\n  def\nt2\n  d2"),
    ("<pre>  keep\n    this</pre>after", "  keep\n    this\n\nafter"),
    ("<script>var x = '</p>';</script>seen<style>p{color:red}</style><!-- no --><template>no</template>", "seen"),
    ("<title>t</title><p hidden>no<p style='display: none'>no<p style='visibility:hidden'>no<p>yes", "yes"),
    ("<style>.ad, #x {display:none} p.y{visibility:hidden}</style><div class='b ad'>no</div><i id=x>no</i><p class=y>no</p><div class=y>yes</div>", "yes"),
    ("<details><summary>s</summary>no<p>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
    ("a < b <3 <> </ x> c", "a < b <3 <> c"),
    ("<a href='x>y\">'>quoted</a>", "quoted"),
    ("text <b unclosed", "text"),
    ("<!doctype html><!-->x<?php y ?>z<!-- open", "xz"),
    ("</p>x</br>y", "x\ny"),
    ("<select><option>no</select><textarea>no</textarea><input value=no>yes", "yes"),
    ("<h1>H</h1>\n<p>p</p>\n<hr><blockquote>q</blockquote>", "H\n\np\n\n  q"),
    ("", ""), ("   \n ", ""), ("<html><body></body></html>", ""),
]


@pytest.mark.parametrize("html,text", CASES)
def test_render(html, text):
    assert render(html) == text


def test_deep_and_long_pages():
    assert render("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert render("<b>" * 20_000 + "x") == "x"
    assert len(render("<p>" + "word " * 200_000)) == 999_999
    assert render("<table><tr><td>" * 300 + "x").strip() == "x"
    render('<a "' * 20_000)
    render("<a b='" * 20_000)
    render("<" * 100_000)
    render("<!--" * 50_000)


def test_no_word_of_an_article_is_lost(spark, sf_tiny):
    """On generated pages the visible text is what stands outside head, scripts and comments."""
    import re
    from html import unescape

    rows = html_layout.extract_text(spark.read.parquet(f"{sf_tiny}/pages.parquet"), carry=["html"]).collect()
    assert rows
    for r in rows:
        body = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<script>.*?</script>", " ", r.html)
        inline = re.sub(r"</?(?:b|i|a|span|em|strong)\b[^>]*>", "", body)
        want = unescape(re.sub(r"<[^>]*>", " ", inline)).split()
        assert [w for w in r.text.split() if w != "-"] == [w for w in want if w != "-"]


def test_odd_rows(spark):
    rows = [(1, None, "u"), (None, "<p>x", "u"), (2, "", None), (3, "<p>x", "u"), (3, "<p>x", "u")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, html string, url string, text string")
    got = sorted(((r.page_id, r.text, r.url) for r in html_layout.extract_text(df, carry=["url"]).collect()), key=str)
    assert got == sorted([(1, None, "u"), (None, "x", "u"), (2, "", None), (3, "x", "u"), (3, "x", "u")], key=str)
    assert html_layout.extract_text(df.where("false")).count() == 0


HEADS = [
    ("<html><head><title>T</title><p>text<p>more", "text\n\nmore"),
    ("<head><meta charset=utf-8><link rel=x><style>b{}</style><script>s</script><noscript><img src=x>no</noscript> \n text <b>bold</b>", "text bold"),
    ("<!doctype html><html lang=en><head>\n<title>T</title>\n<div>one</div></head><body><p>two</body></html>", "one\n\ntwo"),
    ("<head><title>T</title></br>x", "x"), ("<head><title>T</title>< 5", "< 5"), ("<head><html><head><title>T</title>x", "x"),
    ("<head><template><p>no</template><title>T</title></head><body>yes", "yes"),
]


@pytest.mark.parametrize("html,text", HEADS)
def test_heads_without_an_end(html, text):
    assert render(html) == text


SHOWN = [
    ("<style>@media print { nav {display:none} } @media (max-width: 600px) {.w{display:none}}</style><nav>nav</nav><i class=w>wide</i>", "nav\nwide"),
    ("<style>@media screen and (min-width:600px){.n{display:none}} @media not print{#p{display:none}} @media (width <= 40em){b{display:none}}</style><i class=n>no</i><u id=p>no</u><b>yes</b>", "yes"),
    ("<style>@import 'x;{'; @font-face{font-family:x} @supports (display:grid){@media all{.g{display:none}}} .a{display:none} .a{display:block}</style><i class=g>no</i><b class=a>yes</b>", "yes"),
    ("<style>.a{display:none!important} .a{display:block} #i{display:block} i{display:none} .t{display:none} .t.on{display:block}</style><b class=a>no</b><i id=i>one</i><b class=t>no</b> <b class='on t'>two</b>", "one two"),
    ("<style media=print>p{display:none}</style><noscript><style>p{display:none}</style></noscript><p style='backface-visibility:hidden'>yes<p style='display:none;display:block'>too", "yes\n\ntoo"),
    ("<style>p{content:'}';display:none} /* b{display:none} */</style><p>no</p><b>yes</b>", "yes"),
    ("a<svg width=9><title>no</title><defs><text>no</text></defs><path d=x /> no <g><text x=1>one <tspan>two</tspan></text><text>three</text></g></svg>b", "a one two three b"),
    ("<svg><path d=x/><script/><div>after</div>", "after"),
    ("so <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>no</annotation></semantics></math> holds", "so x=2 holds"),
    ("<map name=m><p>in map</p><area></map>", "in map"),
]
FIELDS = [
    ("a<textarea>\nt &lt; <b>\n  u</textarea>", "a t < <b>\n  u"),
    ("<select><option>no<option selected>yes<option>no</select>!", "yes !"),
    ("<select><optgroup label=x><option disabled>no<option>first<option>no</optgroup></select>", "first"),
    ("<select multiple><option>a<option>b</select>", "a\nb"),
    ("<input value=v><input type=hidden value=no><input type=checkbox value=no><input type=submit value=Go>", "v Go"),
    ("<select hidden><option>no</select><textarea style='display:none'>no</textarea>x", "x"),
]


@pytest.mark.parametrize("html,text", SHOWN)
def test_what_a_browser_shows(html, text):
    assert render(html) == text


@pytest.mark.parametrize("html,text", FIELDS)
def test_fields(html, text, spark):
    assert render(html, forms=True) == text


def test_fields_of_a_table(spark):
    df = spark.createDataFrame([(1, "x<textarea>y</textarea>")], "page_id long, html string")
    assert [r.text for r in html_layout.extract_text(df).collect()] == ["x y"]


def test_odd_style_sheets():
    for css in ("{" * 50_000, "}" * 50_000, "/*" * 50_000, "a{" * 50_000, "@media x{" * 20_000, "'" * 50_000, "a{display:none" * 10_000, "(" * 20_000 + "{"):
        render(f"<style>{css}</style>x")
    assert render("<svg>" * 20_000 + "<text>x") == "x"
