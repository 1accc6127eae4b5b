"""Main texts of pages."""

import pytest

from assayer.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
<div id=top>Site name</div><script>var t="</p>";</script>
<div class="x"><p>{0} one<p>{0} two &amp; <b>bold<br>text</b> 3 < 4</div>
<div>Imprint, all rights reserved</div></body>"""
DECLARED = """<body><nav><ul><li><a href="a>b">menu</a><article class=post><header><h1>Head</h1></header>
<p><b>First.<br><p>Second   line</p><div class="ad">buy</div><form>mail</form><!-- <p>no</p> -->
<ul><li>x<li>y</ul><section id="comments"><p>reader</p></section></article><footer>&copy; end</footer>"""


def texts(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame = frame.selectExpr("*", "1 AS reference", "2 AS node")
    found = html_text.main_text(frame)
    assert found.columns == [*frame.columns, "text"]
    return {r.page_id: r.text for r in found.collect()}


def test_template_and_slots(spark):
    rows = [(i, f"http://u@h.example:80/{i}", PAGE.format(f"page {i}")) for i in range(8)]
    found = texts(spark, rows)
    assert found[3] == "page 3 one\n\npage 3 two & bold text 3 < 4"


ARTICLE = """<body><div class="top">Site name</div><article><h1>Title {0}</h1><p>Text {0} one</p><p>Text {0} two</p>
<p>Read on with a subscription.</p><div class="x9">Support us today</div></article><div>Imprint</div></body>"""


def test_constant_nodes_inside_declared_text(spark):
    rows = [(i, f"http://a.example/{i}", ARTICLE.format(i)) for i in range(8)]
    # Copies of one page say nothing about what is template.
    rows += [(20 + i, "http://copies.example/", ARTICLE.format(5)) for i in range(8)]
    rows += [(40 + i, f"http://few.example/{i}", ARTICLE.format(i)) for i in range(2)]
    found = texts(spark, rows)
    assert found[3] == "Title 3\n\nText 3 one\n\nText 3 two"
    whole = "Title 5\n\nText 5 one\n\nText 5 two\n\nRead on with a subscription.\n\nSupport us today"
    assert found[20] == whole and found[41] == whole.replace("5", "1")


def test_varying_text_outside_declared_text(spark):
    page = "<body><div><p>{0} long main text of the page, {0} and more</p></div><article>teaser {0}</article></body>"
    found = texts(spark, [(i, "http://a.example/", page.format(f"page {i}")) for i in range(8)])
    assert found[3] == "page 3 long main text of the page, page 3 and more\n\nteaser page 3"


def test_declared_text(spark):
    rows = [(1, "http://a.example/", DECLARED), (2, None, None), (3, "", ""), (4, "x", "plain <b>text"), (5, "x", "<p")]
    found = texts(spark, rows)
    assert found[1] == "Head\n\nFirst.\n\nSecond line\n\nx\n\ny"
    assert found[2] == found[3] == found[5] == "" and found[4] == "plain text"


def test_no_pages_and_deep_pages(spark):
    assert texts(spark, []) == {}
    deep = "<div>" * 5000 + "low" + "<p>x" * 3000
    found = texts(spark, [(1, "http://a/", deep), (2, "http://a/", deep)])
    assert found[1].startswith("low") and found[1].count("x") == 3000


def test_simple_tree_matching():
    one = ["a", ["b"], ["c", ["d"]], ["e"]]
    two = ["a", ["c", ["d"], ["f"]], ["b"], ["e"]]
    pairs = html_text.align(one, two)
    assert len(pairs) == 4 and ((1, 0), (0, 0)) in pairs and ((2,), (2,)) in pairs
    assert html_text.skeleton(html_text.parse('<ul><li>a<li>b</ul><p>x'))[0] == ['#', ['ul', ['*li']], ['p']]


BODY = "<p>Words of the text that matter here.</p>" * 3


@pytest.mark.parametrize(
    "page, has, lacks",
    [
        (f'<div class="layout with-sidebar"><div class="sidebar">Side links</div>{BODY}</div>', "matter", "Side links"),
        (f'<div id="page" class="no-menu">{BODY}</div>', "matter", "nothing"),
        (f'<div class="widget">{BODY}</div><p>rest</p>', "matter", "nothing"),
        (f'<form id="all"><div>{BODY}</div><input name="q"></form>', "matter", "nothing"),
        (f'<article><div class="entry-header"><h1>Head line</h1></div>{BODY}</article>', "Head line", "nothing"),
        ('<article><p>A <span class="side">small</span> word stays.</p></article>', "A small word stays.", "nothing"),
        ('<article><p>Text <span class="ad">Buy it</span> goes on.</p></article>', "goes on.", "Buy it"),
        (
            f'<article>{BODY}</article><div id="comments"><article class="comment-body"><p>Nice one</p></article></div>',
            "matter", "Nice one",
        ),
        (f'<main>{BODY}<div class="post-comments"><p>Nice one</p></div></main>', "matter", "Nice one"),
        (
            "<div>" * 300 + f'{BODY}<nav><ul><li>Menu item</li></ul></nav><div class="footer">Foot note</div>' + "</div>" * 300,
            "matter", "Menu item",
        ),
    ],
)
def test_names_do_not_lose_text(page, has, lacks):
    found = html_text.extract(page, None, None)
    assert has in found and lacks not in found and "Foot note" not in found
