import pytest

from relayframe.llm import html


@pytest.mark.parametrize(("page", "text"), [
    ("<p>a<b>b<p>c</b> d", "ab\n\nc d"),
    ("<ul><li>one<li>two<ul><li>in<li>in2</ul><li>three</ul>after", "- one\n- two\n  - in\n  - in2\n- three\n\nafter"),
    ("<ol start=9><li>a<p>b<li>c</ol>", "9. a\n\n   b\n\n10. c"),
    ("<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<tr><td>Fig<td>1000<tr><td colspan=2>total</table>x",
     "Name       Qty\nApple pie  3\nFig        1000\ntotal\n\nx"),
    ("<table><tr><td>a<br>b<td>c</tr></table>", "a  c\nb"),
    ("<table><tr><td>a</p>b</tr></table>c</table>d", "ab\n\ncd"),
    ("a<br>b<script>var x='<p>'</script><div hidden>no</div><div style='DISPLAY: none'>no<p>no</div>yes &amp; ok&nbsp;!", "a\nbyes & ok !"),
    ("<head><title>T</title><style>p{}</style><meta x></head><body>body<!-- no -- > <p> -->", "body"),
    ("<title>T</title><p>x", "x"), ("<pre>x  y\n  z</pre>q", "x  y\n  z\n\nq"), ("<h1>T</h1><div>y</div><div>z</div>", "T\n\ny\nz"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"), ("</p>x</div></b>y < z <3 a<b", "xy < z <3 a<b"),
    ('<a href="x>y">l</a> <a href=\'q>z', "l z"), ("<select><option>a<option>b</select>", "a\nb"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"), ("  a \n b\t<i> c</i>  ", "a b c"), ("", ""), ("<p><p></p>", ""),
    ("<textarea>raw <b></textarea>", "raw <b>"), ("<div hidden>x", ""), ("<p>a</p hidden>b", "a\n\nb")])
def test_layout(page, text):
    assert html.render(page) == text


@pytest.mark.parametrize("attrs", [
    'style="overflow: hidden"', 'style="overflow-x:hidden"', 'style="backface-visibility: hidden"', 'title="the hidden city"',
    'alt="Hidden"', 'data-state="hidden"', 'class="lg:block hidden"', 'data-hidden', 'title="display: none"', "class='hidden'",
    'style="display: none; display: block"', 'style="background: url(x;display:none)"', 'style="/* display: none */ color: red"',
    'type=hidden', 'title=">hidden<"', 'style="color:red" style="display:none"', 'style="--display: none"'])
def test_values_that_only_mention_hiding_show(attrs):
    assert html.render(f"<div {attrs}>seen</div>") == "seen"
    assert html.render(f"<html><body {attrs}>seen") == "seen"


@pytest.mark.parametrize("attrs", [
    "hidden", "HIDDEN=''", 'hidden="until-found"', "class=a hidden", "hidden/", "style=display:none", 'style="color:red;DISPLAY : None"',
    'style="display:none !important; display:block"', "style='visibility: collapse'", 'style="visibility:hidden;"', 'title="a>b" hidden',
    'style="display&#58;none"', 'style="font: \'a;b\'; display: none"'])
def test_hidden_elements_stay_hidden(attrs):
    assert html.render(f"<div {attrs}>no</div>") == ""
    assert html.render(f"<html lang=en style='color:red'><body {attrs}>no") == ""


@pytest.mark.parametrize(("page", "text"), [
    ("a <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> b", "a x=2 b"),
    ("<svg><title>t</title><defs/><style/><rect/><text>one</text><text x=1>two</text><defs><text>no</text></defs></svg>z", "one\ntwo\nz"),
    ("<svg><foreignObject><desc>d</desc><p>in</p></foreignObject></svg>", "d\n\nin"), ("<dialog class=opened>no</dialog>x", "x"),
    ("<dialog open>yes</dialog>", "yes"), ("<ol data-x='start=5'><li>a</ol>", "1. a"), ("<text>a</text><text>b</text>", "ab")])
def test_drawings_formulas_and_named_attributes(page, text):
    assert html.render(page) == text


def test_long_and_deep_pages():
    assert html.render("<div>" * 20_000 + "deep" + "</x>" * 20_000) == "deep"
    assert html.render("<p>w" * 20_000).count("w") == 20_000
    assert html.render("<" * 20_000).count("<") == 20_000


def test_all_visible_words_stay(spark):
    """Against the standard library's parser, on the words of whole pages."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.skip, self.out = 0, []

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("script", "style", "title")

        def handle_endtag(self, tag):
            self.skip -= tag in ("script", "style", "title")

        def handle_data(self, data):
            if not self.skip:
                self.out.append(data)

    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        plain = Plain()
        plain.feed(row["html"])
        plain.close()
        shown = [x for x in html.render(row["html"]).split() if x != "-"]
        assert "".join(shown) == "".join(x for x in " ".join(plain.out).split() if x != "-")


def test_pages(spark):
    rows = spark.createDataFrame([(1, None, "v"), (2, "", "v"), (3, "<p>x", "v"), (3, "<p>x", "v"), (None, "y", "v")],
                                 "page_id long, html string, visible string")
    found = html.visible_text(rows).select("page_id", "visible").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "y")]))
    assert html.visible_text(rows.limit(0)).count() == 0
