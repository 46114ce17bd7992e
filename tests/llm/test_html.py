"""Main-text extraction on pages written out by hand."""

from __future__ import annotations

import time

import pytest

from telefold.llm import html
from telefold.llm.shipping import ship

PAGE = (
    '<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body>'
    '<nav><ul><li><a href="/a">a</a></li></ul></nav><!-- x --><div class="ad">Buy this now, it is very long text indeed.</div>'
    "<article><h1>Title &lt;1&gt;</h1><p><b>One\n two&nbsp;three<br>four.<p>Five &#8364; &eacute;</p><aside>no</aside><div id='comments-7'><p>Great post!</p></div></article>"
    "<footer>&copy; me</footer></body></html>"
)
TEXT = "Title <1>\n\nOne two three four.\n\nFive € é"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (PAGE, TEXT), ("", ""), (None, ""), ("plain", "plain"), ("<p>a", "a"), ("a < b <3", "a < b <3"), ("<!-- x", ""), ("<script>1", ""),
        ("<p>a<b>b</p><li>c", "ab\n\nc"), ('<p title="a>b">q</p>', "q"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
        ("<article><header><h1>T</h1></header><p>x<aside>no</aside>y</article>", "T\n\nx\n\ny"), ("<header>H</header><p>x</p>", "x"),
        ('<p data-x="1 < 2">First</p>', "First"), ("<p>x<img alt='a<b>c' src=q>y", "xy"), ('<p a = "<i>" b>z', "z"), ('<p title="x>left open</p><p class="a">b', "left open\n\nb"),
        ('<a href="x"title="y">no space</a>', "no space"), ("<p class='it\"s'>mixed", "mixed"), ("<p a=b>1 <2 and 3> 2", "1 <2 and 3> 2"), ("<p \"odd>q", "q"),
        ("<form>f</form><main><p>m &AMP; n</p></main>", "m & n"), ("<div>" * 3000 + "deep", "deep"), ("</div></p>x", "x"),
    ],
)
def test_pages(page, text):
    assert html.extract(page, None) == text
    assert html.extract(page, "no/such/path") == text


LONG = "word " * 40 + "end."


@pytest.mark.parametrize(
    "inner",
    [
        "<section><h2>A</h2><p>{0}</p></section><section class='b'><p>{0}</p></section><p>last</p>",
        "<div>{0}</div><div>{0}</div><div>{0}</div>",
        "<div class='body'><div>{0}</div><div>{0}</div></div>",
        "<table><tr><td>{0}</td><td>{0}</td></tr></table><p>last</p>",
        "<figure><figcaption>{0}</figcaption></figure><details><summary>s</summary>{0}{0}</details>",
    ],
)
@pytest.mark.parametrize("outer", ["<article>{}</article>", "<main>{}</main>", '<div id="wrap"><div class="post">{}</div></div>', "{}"])
def test_whole_articles(inner, outer):
    """Blocks beside the parts of an article belong to it, on the page and by the host's vote."""
    page = "<html><body><nav>menu</nav>" + outer.format("<h1>Title</h1><p>Intro.</p>" + inner.format(LONG)) + "<footer>f</footer></body></html>"
    text = html.extract(page, None)
    assert text.startswith("Title\n\nIntro.\n\n") and text.count(LONG) == inner.count("{0}") and ("last" in inner) == text.endswith("last")
    assert html.extract(page, html.best_path(html.parse(page))[0]) == text and "menu" not in text
    if outer == "<article>{}</article>":
        beside = page.replace("<footer>", "<div class='list'><p>other things</p></div><footer>")
        assert html.extract(beside, None) == text


@pytest.mark.parametrize(
    "wrapper",
    ['div class="content has-sidebar"', 'div id="page" class="with-sidebar"', 'div class="post no-comments"', 'div class="social-science"', 'div class="banner"', 'div id="search"', 'section class="main-sidebar"',
     'div class="post comments-open"', 'div class="post category-sponsored tag-cookies"', 'div class="cookie-recipes"', 'div class="site-header"', 'div class="address-book adapter"'],
)
@pytest.mark.parametrize("article", ["article", "div"])
def test_wrappers_with_marks_in_their_names(wrapper, article):
    inner = f"<{article}><h1>Title</h1><p>{LONG}</p></{article}><div class='ad'>Buy.</div><div class='sidebar-left'>more</div><ul class='top-nav'><li>x</li></ul>"
    page = f"<body><{wrapper}>{inner}</{wrapper.split()[0]}><div id='comment-list-2'><article>Great!</article></div></body>"
    if article == "div":
        page = page.replace("<article>Great!</article>", "Great!")
    assert html.extract(page, None) == f"Title\n\n{LONG}"


def test_marks_that_count():
    page = "<body><div class='post'><p>Short story.</p></div>{}</body>"
    for name in ("comments", "comment-list", "comments-7", "post-comments", "replies", "user-comment", "responses", "reader-comments-2"):
        assert html.extract(page.format(f"<div id='{name}'><p>{LONG}</p></div>"), None) == "Short story."
    for name in ("ad", "ad-box", "site-footer", "sidebar_2", "wide nav", "related-posts", "cookie-notice", "sponsored-content", "cookie-law", "adbox", "site-header", "google_ads AdSlot-3"):
        assert html.extract(page.format(f"<div class='{name}'><p>no</p></div>").replace("div class='post'", "article").replace("</p></div>", "</p></article>", 1), None) == "Short story."
    assert html.extract("<body><article><p>a</p></article><div id='comments'><article>" + LONG + "</article></div></body>", None) == "a"


def test_broken_pages_take_linear_time():
    begin = time.time()
    for part in ("<a ", '<a "', "<!-", "<a b='", "</", "<p"):
        html.extract(part * 100_000, None)
    assert time.time() - begin < 20


def test_the_host_decides(spark):
    """On most pages of the host the story is in div.story; one page has a longer list beside it."""
    ship(spark)
    story = '<body><div class="story p-1"><p>{}</p></div><div class="list"><p>{}</p></div></body>'
    rows = [(i, f"https://A.example/{i}", story.format(f"story {i} " + "word " * 30, "short")) for i in range(5)]
    rows.append((5, "http://a.example/5?x", story.format("tiny story", "list entry " * 40)))
    rows += [(6, None, story.format("tiny", "other " * 9)), (7, "https://b.example/", None), (8, "nonsense", ""), (0, "https://a.example/0", rows[0][2]), (9, "https://c.example", PAGE)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, path int").repartition(3)
    got = html.main_text(pages)
    assert got.columns == ["page_id", "url", "html", "text", "path"]
    texts = sorted((r.page_id, r.text) for r in got.collect())
    want = [(i, " ".join(f"story {i} {'word ' * 30}".split())) for i in (0, 0, 1, 2, 3, 4)]
    assert texts == sorted([*want, (5, "tiny story"), (6, ("other " * 9).strip()), (7, ""), (8, ""), (9, TEXT)])


def test_empty_table(spark):
    ship(spark)
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
