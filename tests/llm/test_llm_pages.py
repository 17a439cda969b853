"""Main text of pages."""

import time

import pytest

from tallyloom.llm import html

CASES = [
    (None, []),
    ("", []),
    ("plain &lt;b&gt; &amp;eacute; &eacute;", ["plain <b> &eacute; é"]),
    ("<p>a\n  b<br>c<p>d&nbsp;</p>", ["a b c", "d"]),
    ("<ul><li>x<li>y</ul>z", ["x", "y", "z"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ("<nav>n</nav><article><h1>T</h1><p>t</p><div class='user-comments'>c</div></article><footer>f</footer>", ["T", "t"]),
    ("<div>lead</div><main><p>body</p><aside>s</aside></main>", ["body"]),
    ("<script>var a='</p>';</script><style>p{}</style><!-- <p>x</p> --><p>kept", ["kept"]),
    ("<p title='a>b'>c</p></div></p>d", ["c", "d"]),
    ("<form><p>f</p></form><p hidden>h</p><div role=navigation>r</div><p>ok</p>", ["ok"]),
    ("<p>un<b>closed <i>tags", ["unclosed tags"]),
    ("a < b and c > d <", ["a < b and c > d <"]),
    ("<p>x <a href='open>y</p> z", ["x <a href='open>y", "z"]),
    ("<p>a <b title=\"q>r' s\">b</b> <i c='>\">'>d", ["a b d"]),
    ("<a<b<c d", ["<a<b<c d"]),
]


@pytest.mark.parametrize("page, blocks", CASES)
def test_blocks(page, blocks):
    found = html.parse(page)[0]
    if any(article for _, _, article in found):
        found = [each for each in found if each[2]]
    assert [text for text, _, _ in found] == blocks


@pytest.mark.parametrize("piece", ['<a "', "<a '\"", "<a ", "<a", "</x><p ", "<div>", "<p><i>x</b>", "<!-- ", "<script>", '<a "<b \''])
def test_broken_pages_take_linear_time(piece):
    start = time.perf_counter()
    html.parse(piece * (200_000 // len(piece)))
    assert time.perf_counter() - start < 5


def test_templates_go_and_articles_stay(spark):
    rows = []
    for i in range(30):
        shared = "<article><p>shared passage</p></article>" if i % 2 else f"<div><p>own {i}</p></div>"
        rows.append((i, f"http://one.example/{i}", f"<div id='top'>Welcome <b>here</b></div>{shared}<div>Imprint</div>", "x"))
    rows += [(100, "http://two.example/", "<div id='top'>Welcome <b>here</b></div>", "x"), (101, None, None, None), (0, "nohost", "<p>a</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html.extract(pages).collect()
    assert len(found) == len(rows)
    texts = {(r.page_id, r.url): r.text for r in found}
    for i in range(30):
        assert texts[i, f"http://one.example/{i}"] == ("shared passage" if i % 2 else f"own {i}")
    assert texts[100, "http://two.example/"] == "Welcome here"
    assert texts[101, None] == "" and texts[0, "nohost"] == "a"
    assert html.extract(pages.limit(0)).count() == 0


def test_counts_decide_inside_articles_too(spark):
    share = "<ul><li>Share this</li><li>Print</li></ul>"
    page = "<div class='layout has-sidebar'><article><h1>T{0}</h1><p>body {0}</p>{1}<p>Subscribe now</p>bare line</article></div>"
    rows = [(i, "http://a.example/x", page.format(i, share)) for i in range(20)]
    rows += [(100 + i, "http://a.example/copy", f"<nav>{i}</nav>" + page.format("copied", "<p>passage</p>")) for i in range(60)]
    rows += [(200, "http://small.example/", page.format(1, share))]
    rows += [(300 + i, "http://b.example/", f"<article>Sign up</article><article>own {i}</article>") for i in range(9)]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {r.page_id: r.text for r in found}
    assert all(texts[i] == f"T{i}\nbody {i}" for i in range(20))
    assert all(texts[100 + i] == "Tcopied\nbody copied\npassage" for i in range(60))
    assert texts[200] == "T1\nbody 1\nShare this\nPrint\nSubscribe now\nbare line"
    assert all(texts[300 + i] == f"own {i}" for i in range(9))


@pytest.mark.parametrize("name, other", [("user-comments", True), ("sidebar", True), ("ad-3", True), ("has-sidebar", False),
                                         ("no-comments", False), ("header-image", False), ("post share_text", False)])
def test_names_count_where_they_name_the_element(name, other):
    assert html._names_other(name) == other
