import pytest

from martspark.llm import html_text as H

CASES = [
    (None, ""), ("", ""), ("plain &amp; &lt;b&gt;", "plain & <b>"),
    ("<p>one<p>two  \n lines<br>three", "one\n\ntwo lines\nthree"),
    ("<div>a</div><div>b</div><p>c</p>d", "a\nb\n\nc\n\nd"),
    ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>z", "- a\n- b\n  3. x\n  4. y\n- c\n\nz"),
    ("<head><title>t</title><style>p{}</style></head><script>var t='</p>'</script><p>seen</p><!-- ad --><p hidden>no</p><p style='display: none'>no</p>", "seen"),
    ("<table><tr><th>Name<th>N<tr><td>apple<td>3<tr><td>fig<td>12</table>", "Name   N\napple  3\nfig    12"),
    ("<table><caption>C</caption><tr><td colspan=2>wide<td>r<tr><td>a<td>b<td><p>c</p><p>d</p></table>after", "C\nwide     r\na     b  c\n\n         d\n\nafter"),
    ("<pre>a  b\n  c</pre>x", "a  b\n  c\n\nx"),
    ("<dl><dt>t<dd>d1<dd>d2</dl>", "t\n  d1\n  d2"),
    ("<select><option>a<option>b</select>", "ab"), ("<b>x</b> <i>y</i>", "x y"), ("a <unclosed", "a"), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<p>a</div>b</p>", "ab"), ("<textarea><b>raw</b></textarea>", "<b>raw</b>"), ("<P CLASS=\"a>b\">q</P>", "q"),
    ("<table><tr><td>out<table><tr><td>in<td>2</table><td>end</table>", "out    end\n\nin  2"),
]


DRAWN = [
    ("<p>a <svg><title>t</title><desc>no</desc><defs><text>no</text></defs><path d='x'/><text>one</text><text>two</text></svg> b", "a one two b"),
    ("<svg><defs/><text>seen</text></svg>", "seen"), ("<svg><a href=x/><text>seen</text></a></svg>", "seen"),
    ("<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>no</annotation></semantics></math> is", "x=2 is"),
    ("<object data=a.swf><param name=b><p>fallback</p></object>", "fallback"), ("<desc>html</desc>", "html"),
]


@pytest.mark.parametrize(("html", "text"), DRAWN)
def test_drawn_text(html, text):
    assert H.visible_text(html) == text


@pytest.mark.parametrize(("html", "text"), CASES)
def test_layout(html, text):
    assert H.visible_text(html) == text


def test_deep_and_long():
    assert H.visible_text("<div>" * 50_000 + "x") == "x"
    assert H.visible_text("<table><tr><td>" * 200 + "x").strip() == "x"
    assert H.visible_text("<p>word " * 100_000).count("word") == 100_000
    assert H.visible_text("<" * 20_000).count("<") == 20_000


def test_extract(spark):
    rows = [(1, "<p>a"), (1, "<p>a"), (None, "b"), (2, None)]
    got = H.extract(spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'x' text")).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars, r.n_lines) for r in got) == [(0, "b", 1, 1), (1, "a", 1, 1), (1, "a", 1, 1), (2, "", 0, 0)]
    assert H.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_every_visible_word_of_the_pages_is_kept(spark):
    """Against the words between tags, once scripts and the head are cut away."""
    import re
    from html import unescape
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in H.extract(pages).collect()}
    for r in pages.collect():
        body = re.sub(r"(?s)<head>.*?</head>|<script>.*?</script>|<!--.*?-->", " ", r.html)
        words = unescape(re.sub(r"</?[a-zA-Z!][^>]*>", " ", body)).split()
        assert "".join(words) == "".join(re.sub(r"(?m)^ *- ", "", got[r.page_id]).split()) or sorted("".join(words).replace("-", "")) == sorted("".join(got[r.page_id].split()).replace("-", ""))


def test_numbers_that_are_none_and_wide_cells():
    render = H.visible_text
    for bad in ("\u00b2", "9" * 5000, "", "x", "-", "1e3"):
        assert render(f"<table><tr><td colspan='{bad}'>a<td>b</table>") == "a  b"
        assert render(f"<ol start='{bad}'><li>a</ol>").endswith("a")
    assert render("<ol start=-3><li>a<li>b</ol>") == "-3. a\n-2. b"
    assert render("<table><tr><td colspan=1000>a<td>b</table>").split() == ["a", "b"]
    wide = "<table><tr><td>" + "x" * 12_000 + "<td>y" + "<tr><td>a<td>b" * 1000 + "</table>"
    assert len(render(wide)) < 2 * len(wide) and "a  b" in render(wide)


def test_rowspan():
    render = H.visible_text
    assert render("<table><tr><td rowspan=2>A<td>b<tr><td>c</table>") == "A  b\n   c"
    assert render("<table><tr><td>x<td rowspan=3 colspan=2>s<td>y<tr><td>1<td>2<tr><td>3<td>4<tr><td>5<td>6</table>") == "x  s  y\n1     2\n3     4\n5  6"
    assert render("<table><tbody><tr><td rowspan=0>A<td>b<tr><td>c</tbody><tbody><tr><td>d<td>e</tbody></table>") == "A  b\n   c\nd  e"
    assert render("<table><tr><td rowspan=2>A<td>b<tr><td><table><tr><td>in<td>2</table></table>") == "A  b\n   in  2"
    for bad in ("\u00b2", "-2", "", "9" * 5000):
        assert render(f"<table><tr><td rowspan='{bad}'>A<td>b<tr><td>c</table>") == "A  b\nc"


def test_spans_do_not_blow_up():
    for cell in ("<td rowspan=60000>" + "x" * 100, "<td rowspan=60000 colspan=1000>x"):
        html = "<table><tr>" + cell * 400 + "<tr><td>y" * 3000
        text = H.visible_text(html)
        assert text.count("y") == 3000 and len(text) < 40 * len(html)
