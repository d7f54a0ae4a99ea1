from collections import Counter
from html.parser import HTMLParser

import pytest

from strophe.llm.html import extract, op5_html_text, visible_text

PAGES = [
    ("", ""),
    ("plain", "plain"),
    ("<p>One<p>Two <b>bold</b> text<br>next</p>tail", "One\n\nTwo bold text\nnext\n\ntail"),
    ("<div>a</div><div>b<div>c</div></div>d", "a\nb\nc\nd"),
    ("<h1>Head  line</h1><p>  spread \n over\tlines </p>", "Head line\n\nspread over lines"),
    ("<ul><li>a<li>b<ul><li>c</li><li>d</ul><li>e</ul>", "- a\n- b\n  - c\n  - d\n- e"),
    ("<ol start=3><li>x<li><p>y</p></ol>z", "3. x\n4. y\n\nz"),
    ("<table><tr><th>N<th>Value<tr><td>long cell<td>1<tr><td colspan=2>both</table>", "N          Value\nlong cell  1\nboth"),
    ("<table><caption>Cap</caption><tbody><tr><td>a</td><td><table><tr><td>in</table></td></tr></tbody></table>after", "Cap\na  in\n\nafter"),
    ("<pre>  keep\n    this</pre>", "  keep\n    this"),
    ("<head><title>T</title><style>.x{display:none}#y , nav{ visibility : hidden }</style></head>"
     "<p class='k x'>no</p><p id=y>no</p><nav>no</nav><p class=k>yes", "yes"),
    ("a<span hidden>no</span><span style='display: none'>no</span><input type=hidden value=no>b", "ab"),
    ("<script>if (a < b) document.write('</p>')</script>seen<!-- not > seen --><![CDATA[no]]>", "seen"),
    ("<noscript>no</noscript><template>no</template><textarea> kept &amp; </textarea>", " kept &"),
    ("&lt;b&gt; &amp; &copy; &#233; &nosuch;", "<b> & © é &nosuch;"),
    ("<a title=don't href=\"x>y\">link</a> 1 < 2 and <3", "link 1 < 2 and <3"),
    ("<img alt='a picture'> x <img alt=''><hr>y", "a picture x\n\ny"),
    ("<dl><dt>term<dd>meaning<dt>other<dd>more</dl>", "term\n  meaning\nother\n  more"),
    ("<select><option>one<option>two</select>", "one\ntwo"),
    ("</p></div><b>open", "open"),
    ("<p>unclosed <i>tags <p>go on", "unclosed tags\n\ngo on"),
    ("x<br><br>y", "x\n\ny"),
    ("<div><div>" * 400 + "deep" + "</div></div>" * 400, "deep"),
    ("<", "<"), ("<a", ""), ("<!-- open", ""), ("<script>open", ""),
]


@pytest.mark.parametrize("html,text", PAGES)
def test_layout(html, text):
    assert visible_text(html) == text


def test_table_of_pages(spark):
    rows = [(i, h, "t", 7) for i, (h, _) in enumerate(PAGES)] + [(0, None, None, None), (None, "<title> A  b </title><p>x", "t", 1), (0, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, _row int")
    got = extract(pages)
    assert got.columns == ["page_id", "html", "_row", "title", "text"]
    kept = got.collect()
    assert sorted(str((r.page_id, r.html, r._row)) for r in kept) == sorted(str((r[0], r[1], r[3])) for r in rows)
    assert all((r.text is None) == (r.html is None) for r in kept)
    assert [(r.title, r.text) for r in kept if r.page_id is None] == [("A b", "x")]
    assert extract(pages.limit(0)).count() == 0


def test_long_page():
    html = "<table>" + "".join(f"<tr><td>{i}<td>{'v' * (i % 9)}" for i in range(20_000)) + "</table>" + "<p>word " * 20_000
    lines = visible_text(html).split("\n")
    assert lines[0] == "0" and lines[8] == "8      vvvvvvvv" and sum(line == "word" for line in lines) == 20_000


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = op5_html_text(spark, folder).collect()
    assert len(rows) == len(html) and all(r.text == visible_text(html[r.page_id]) and r.n_chars == len(r.text) for r in rows)
    assert not any("<p>" in r.text or "track(" in r.text for r in rows)


class Words(HTMLParser):
    """Another reader: events only, for pages whose elements all end or need no end."""

    def __init__(self):
        super().__init__()
        self.words, self.off = [""], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("head", "script", "style")
        self.words.append("" if tag in ("a", "b") else " - " if tag == "li" else " ")

    def handle_endtag(self, tag):
        self.off -= tag in ("head", "script", "style")
        self.words.append("" if tag in ("a", "b") else " ")

    def handle_data(self, data):
        if not self.off:
            self.words.append(data)


def test_same_words_as_another_reader(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.page_id: r.text for r in op5_html_text(spark, folder).select("page_id", "text").collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(got) == len(pages) == 250
    for page in pages:
        plain = Words()
        plain.feed(page.html)
        plain.close()
        assert Counter(got[page.page_id].split()) == Counter("".join(plain.words).split()), page.page_id


CARD = "<div class='a x' id=i><p class='b y'>seen</p></div>"


@pytest.mark.parametrize("css,shown", [
    (".a .y{display:none}", False), (".a > .y{display:none}", False), ("div.x{display:none}", False), ("body .b.y{display:none}", False),
    ("p.x{display:none}", True), (".y .a{display:none}", True), ("body>.y{display:none}", True), (".a.y{display:none}", True),
    ("#i p[class]{display:none}", False), ("p[class='y']{display:none}", True), ("*{display:none}", False), ("div[id=i]{display:none}", False),
    (".x{display:none}.x{display:block}", True), (".x{display:block}.x{display:none}", False),
    ("#i{display:block}.x{display:none}", True), ("#i{display:block}.x{display:none!important}", False),
    (".x:hover{display:none}", True), (".x:hover,.y{display:none}", False), (":is(.q,.y,.r){display:none}", True), (".q + .y{display:none}", True),
    (".x{--foo-display:none;content-visibility:hidden}", True), (".X{display:none}", True), (".x{DISPLAY : None}", False),
    (".x{visibility:hidden}", False), (".x{visibility:hidden}.y{visibility:visible}", True), (".x{display:none}.y{display:block}", False),
    ("<!-- -->.q{color:red}", True), (".x{display:none;display:block}", True), (".x{display:none;display:}", False),
])
def test_cascade(css, shown):
    assert visible_text(f"<!DOCTYPE html><style>{css}</style><body>{CARD}") == ("seen" if shown else "")


@pytest.mark.parametrize("html,text", [
    ("<head><title>T</title><p>Hello", "Hello"), ("<head>\n<meta charset=x>Hello", "Hello"), ("<head><noscript><p>no</p></noscript><p>x</p></head>y", "x\n\ny"),
    ("<style>.x{display:none}</style><p class=x style='display:block'>seen", "seen"),
    ("<style>.x{display:none!important}</style><p class=x style='display:block'>no", ""),
    ("<!-- <style>p{display:none}</style> --><script>'<style>p{display:none}</style>'</script><p>seen", "seen"),
    ("<div style='visibility:hidden'>no <b style='visibility:visible'>seen</b> no<ul><li>no</ul></div>", "seen"),
    ("<style>.X{display:none}</style><p class=x>no", ""), ("<p hidden>no<p hidden style='display:block'>seen", "seen"),
    ("<details>no<summary>head</summary>no<p>no<summary>no</summary></details>x", "head\nx"),
    ("<details open><summary>head</summary>more</details>", "head\nmore"), ("a<dialog>no</dialog><dialog open>b</dialog>", "a\nb"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
    ("<table><tr><td>a<td rowspan=0>b<tr><td>c<td>d<tbody><tr><td>e<td>f</table>", "a  b\nc     d\ne  f"),
    ("<table><tr><td colspan=2>long words<td>z<tr><td>a<td>b<td>c</table>", "long words  z\na  b        c"),
    ("<table><td>a<td>b<tr><td>c<td>d</table>", "a  b\nc  d"),
    ("<table><tr><td>x<ul><li>one<li>two</ul><td>y<tr><td><pre>a  b\nc</pre><td>z</table>", "x      y\n- one\n- two\na  b   z\nc"),
    ("<ol><li>a<li value=7>b<li>c<li value=x>d</ol>", "1. a\n7. b\n8. c\n9. d"), ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"),
    ("<table>" * 300 + "<td>x", "x"),
])
def test_seen_and_laid_out(html, text):
    assert visible_text(html) == text


def test_deep_tables_and_many_rules():
    html = "<style>" + "".join(f".a{i} .b{i}{{display:none}}" for i in range(5_000)) + "</style>"
    html += "<table><tr><td>n " * 60 + "<p class=b7>seen</p>" + "<div class=a7><p class=b7>no</div>" * 500 + "</table>" * 60
    assert visible_text(html).split() == ["n"] * 60 + ["seen"]


@pytest.mark.parametrize("style,shown", [
    ("<style>@media print{.x{display:none}}</style>", True),
    ("<style>@media (max-width:600px){.x,p{display:none}}</style>", True),
    ("<style>@media screen and (max-width:600px){.y{color:red}.x{display:none}} .y{display:none}</style>", True),
    ("<style>@media print{@media all{.x{display:none}}}</style>", True),
    ("<style media=print>.x{display:none}</style>", True),
    ("<style media='screen and (min-width: 1px)'>.x{display:none}</style>", True),
    ("<style>.x{color:red; @media print{display:none}}</style>", True),
    ("<style>.y{.x{display:none}}</style>", True),
    ("<style>.y:after{content:'}.x{display:none}'}</style>", True),
    ("<style>@media screen{.x{display:none}}</style>", False),
    ("<style>@media print, only screen {.y{color:red} .x{color:red;visibility:hidden}}</style>", False),
    ("<style>@media not print{.x{display:none}}</style>", False),
    ("<style>@media print{.y{color:red}} .x{display:none}</style>", False),
    ("<style>@import url(a.css); .x{display:none;color:red}</style>", False),
    ("<style media=all>@media print{.y{display:none}}.x{display:none", False),
    ("<style>" + "a{" * 20_000 + "}" * 20_000 + ".x{display:none}</style>", False),
])
def test_rules_for_some_media_hide_nothing(style, shown):
    html = f"<body><p class=x>seen</p>{style}"
    assert visible_text(html) == ("seen" if shown else "")
