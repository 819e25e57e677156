import pytest

from spendlake.llm import html_text as h

LONG = "The cat of the house was in the garden and it was for the dog that he had been there in the end of it all."


@pytest.mark.parametrize(
    "html,expected",
    [
        ("", ""),
        ("just words", "just words"),
        ("<p>a &amp; b&nbsp;c<p>d", "a & b c\n\nd"),
        ("<article><h1>T</h1><p>x<br>y</p><p>z\n\t z</article>", "T\n\nx y\n\nz z"),
        ("<nav><a href=x>Home</a></nav><article><p>One.</p></article><footer>&copy; us</footer>", "One."),
        ("<article><p>a</p><aside>b</aside><form>c</form><p>d</p></article>", "a\n\nd"),
        ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>x</p></article>", "Title\n\nx"),
        ("<script>if (a</b>) '</p>'</script><style>p{}</style><article>x</article>", "x"),
        ("<article>x<!-- <p>no</p> -->y</article>", "xy"),
        ("<article><p>x</p></article><div class='comments'><article class='comment'><p>y</p></article></div>", "x"),
        ("<article><p>x</p><div id='cookieNotice'>c</div><p class='ad'>buy<p>y</article>", "x\n\ny"),
        ("<article><p>a < b and c > d</p></article>", "a < b and c > d"),
        ("<article><p>cut <b", "cut"),
        ("<article><a title='>'>t</a> u</article>", "t u"),
        ("<script>never closed", ""),
        ("<!-- never closed <p>x", ""),
        (f"<div><p>{LONG}</p><p>Short.</p></div><div class=sidebar>{LONG}</div>", f"{LONG}\n\nShort."),
        (f"<div><a href=1>Home</a> <a href=2>News and more of the same for all of you</a></div><p>{LONG}</p>", LONG),
        (f"<p>{LONG}</p><p>Buy cheap shoes online now best prices guaranteed quick delivery free returns worldwide click</p>", LONG),
        ("<main><ul><li>a<li>b</ul></main>", "a\n\nb"),
        ("<body hidden><p>x</p></body>", "x"),
        ("<article><div hidden>x</div><p style='display: none'>y</p><p aria-hidden=true>w</p>z</article>", "z"),
    ],
)
def test_pages(html, expected):
    assert h.main_text(html) == expected


def test_nearest_decided_neighbour_decides():
    good, bad, short = h.Block(LONG * 3, 0, False, False), h.Block("x", 0, True, False), h.Block("Hm.", 0, False, False)
    assert h.classify([bad, short, good, short, short, short, bad]) == [False, True, True, True, True, False, False]
    assert h.classify([short, short]) == [True, True]
    assert h.classify([]) == []


def test_table(spark):
    rows = [(1, "u", "<article>ünï</article>", 1), (1, "u", "<article>ünï</article>", 2), (2, None, None, 3), (None, "x", "", 4), (3, "l", "<article>" + "<p>w w</p>" * 30_000, 5), (4, "d", "<div>" * 20_000 + "x", 6), (5, "q", "<a \"" * 3000, 7)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = h.extract_text(table).collect()
    assert len(out) == len(rows)
    assert all(r.n_chars == len(r.text) for r in out)
    assert [r.text for r in out if r.page_id == 1] == ["ünï", "ünï"]
    assert next(r for r in out if r.page_id == 3).text == "\n\n".join(["w w"] * 30_000)
    assert h.extract_text(table.limit(0)).count() == 0


ADVERT = "Buy cheap shoes online now best prices guaranteed quick delivery free returns worldwide click"


@pytest.mark.parametrize(
    "html,expected",
    [
        ("<div class='content has-sidebar'><article><p>x</p></article></div>", "x"),
        ("<div id=no-sidebar><article><p>x</p></article></div>", "x"),
        ("<div class=sidebar><article><p>x</p></article></div>", "x"),
        (f"<div class=widget><p>{LONG}</p></div><p>Short.</p>", f"{LONG}\n\nShort."),
        (
            "<article><h2 id='related-work'>R</h2><h2 id=related>S</h2><p class='notice-board'>n</p>"
            "<div class='social-science'>s</div></article>",
            "R\n\nS\n\nn\n\ns",
        ),
        ("<article class='post has-comments'><p>x</p></article>", "x"),
        ("<article>x</article><ol class='comment-list'><li class='comment even'><article id='div-comment-5'>y</article></ol>", "x"),
        ("<article>x</article><div class=related><article>y</article></div>", "x"),
        ("<div class=ad>more words than the article</div><article>x</article>", "x"),
        ("<main><p>x</p><div class=comments><article>y</article></div></main>", "x"),
        ("<article><p>some words</p><span class='ad-box'>buy</span></article>", "some words"),
        (f"<article><p>{LONG}</p><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></article>", LONG),
        (f"<article><h1><a href=x>Title</a></h1><p>{LONG}</p><pre>{ADVERT}</pre></article>", f"Title\n\n{LONG}\n\n{ADVERT}"),
        (f"<article><p>{ADVERT}</p></article>", ADVERT),
        ("<article><ul><li><a href=1>One</a></ul></article>", "One"),
    ],
)
def test_names_are_evidence_and_links_count_inside_articles(html, expected):
    assert h.main_text(html) == expected


def test_deeply_nested_names():
    assert h.main_text("<article>x</article>" + "<div class=ad>" * 20_000 + "y") == "x"
