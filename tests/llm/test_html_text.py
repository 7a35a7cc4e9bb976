from html.parser import HTMLParser

import pytest

from stormledger.llm import html_text as H


class Words(HTMLParser):
    """All words of a page outside head, scripts and styles; block tags part words."""

    INLINE = {"a", "b", "i", "em", "strong", "span", "u", "small", "code"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip, self.body = [], 0, False

    def handle_starttag(self, tag, attrs):
        self.body = self.body or tag not in ("html", "head", "meta", "title", "script", "style", "link", "base")
        self.skip = tag in ("script", "style", "title")
        if tag not in self.INLINE:
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.skip = False
        if tag not in self.INLINE:
            self.out.append(" ")

    def handle_data(self, data):
        if self.body and not self.skip:
            self.out.append(data)


CASES = {
    "<p>one<p>two <b>x</b>y": "one\n\ntwo xy",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<ul><li>a<li>b<ul><li>c</ul></ul>d": "* a\n* b\n  * c\n\nd",
    "<ol start=2><li>a<li hidden>no<li value=9>b<li>c</ol>": "2. a\n9. b\n10. c",
    "<table><tr><th>Name<th>N<tr><td>Apple pie<td>3</table>": "Name       N\nApple pie  3",
    "<table><td>a<td>b<tr><td colspan=2>wide cell<td>c": "a  b\nwide cell  c",
    "<table><tr><td>x<td><table><tr><td>1<td>2<tr><td>3<td>4</table></table>": "x  1  2\n   3  4",
    "<pre>a\n  b  c\n\nd</pre>e": "a\n  b  c\n\nd\n\ne",
    "<title>t</title><div hidden>h</div><div style='display : none'>h</div><p aria-hidden=true>h<p>seen": "seen",
    "<style>.x, #y {display:none} i{visibility:hidden}</style><p class='a x'>h</p><p id=y>h<p>se<i>h</i>en": "seen",
    "<script>var a = '</p><p>no';</script><!-- <p>no --><noscript>no</noscript>yes": "yes",
    "<details><summary>s</summary>no</details><details open><summary>t</summary>u</details><dialog>no</dialog>": "s\nt\nu",
    "&lt;b&gt; &amp;amp; a&nbsp;b &copy": "<b> &amp; a b ©",
    "<select><option>A<option selected>B</select>": "A\nB",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "<head><meta charset=x><p>body begins": "body begins",
    "<p>cut <a href=\"x": "cut", "< b <3 a": "< b <3 a", "": "", "<input type=hidden value=no><input value=yes>": "yes",
    "<tr><td>no table<td>here": "no table\nhere", "a</p></div></foo>b": "ab", "<p>a</br>b": "a\nb",
}


@pytest.mark.parametrize("page", CASES)
def test_layout(page):
    assert H.render(page) == CASES[page]


def test_same_words_as_a_plain_parser(spark):
    pages = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    for page in pages:
        plain = Words()
        plain.feed(page)
        plain.close()
        got = [w for w in H.render(page).split() if w != "*"]
        assert got == [w for w in "".join(plain.out).split() if w != "*"] or not page.rstrip().endswith("</html>")


def test_same_words_on_cut_off_pages(spark):
    pages = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    cut = [page for page in pages if not page.rstrip().endswith("</html>")]
    assert len(cut) > 20
    for page in cut:
        plain = Words()
        plain.feed(page)
        plain.close()
        assert [w for w in H.render(page).split() if w != "*"] == [w for w in "".join(plain.out).split() if w != "*"]


def test_deep_and_long_pages():
    deep = "<div><ul><li>" * 2_000 + "<div><span>" * 20_000 + "core"
    assert H.render(deep).endswith("core")
    assert H.render("<b>" * 100_000 + "x" + "</i>" * 1000) == "x"
    assert len(H.render("<p>word " * 100_000).split()) == 100_000
    assert H.render("<a " + "x" * 1_000_000) == "" and H.render("<" * 100_000).count("<") == 100_000


ROWSPANS = {
    "<table><tr><th>Region<th>Town<th>N<tr><td rowspan=2>North<td>Aba<td>1<tr><td>Bo<td>22<tr><td>South<td>Cy<td>3</table>":
        "Region  Town  N\nNorth   Aba   1\n        Bo    22\nSouth   Cy    3",
    "<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>": "a  b  c\nd     e\nf     g",
    "<table><tr><td rowspan=2 colspan=2>wide<td>x<tr><td>y<tr><td>p<td>q<td>z</table>": "wide  x\n      y\np  q  z",
    "<table><tbody><tr><td rowspan=9>a<td>b</tbody><tbody><tr><td>c<td>d</table>": "a  b\nc  d",
    "<table><tr><td rowspan=-1>a<td rowspan=x>b<tr><td>c<td>d</table>": "a  b\nc  d",
    "<table><tr><td rowspan=3>a<td rowspan=2>b<td>c<tr><td>d<tr><td>e<td>f</table>": "a  b  c\n      d\n   e  f",
}


@pytest.mark.parametrize("page", ROWSPANS)
def test_cells_below_a_rowspan_keep_their_column(page):
    assert H.render(page) == ROWSPANS[page]


def test_nulls_repeats_empty_table_other_columns(spark):
    pages = spark.createDataFrame([(1, None, "k"), (1, "<p>a", "k"), (None, "", "k"), (1, "<p>a", "k")], "page_id long, html string, text string")
    got = H.visible_text(pages)
    assert got.columns == ["page_id", "text"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [(1, None), (1, "a"), (None, ""), (1, "a")]))
    assert H.visible_text(pages.filter("page_id > 9")).count() == 0
