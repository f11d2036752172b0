import html
import random
import re

import pytest
from helpers import SF_DIR
from pyspark.sql import functions as F

from tickwell.llm import pages
from tickwell.llm.queries import QUERIES


def test_query_gives_the_articles(spark):
    source = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = QUERIES["op1_html_extraction"](spark, SF_DIR).collect()
    assert len(rows) == len(source)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", source[r.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert (r.url, r.text) == (source[r.page_id].url, "\n\n".join(b for b in blocks if b))
        assert r.n_chars == len(r.text)


def texts(page, kinds=(pages.ARTICLE, pages.UNKNOWN)):
    return [t for k, t in pages.lines(page) if k in kinds]


@pytest.mark.parametrize("page, want", [
    ("", []),
    ("<p>a  &amp;\n b</p><p>c&nbsp;d", ["a & b", "c d"]),
    ("<p>one<br>two<b>three</b>", ["one twothree"]),
    ("<p><b>open<br><p>next</p>", ["open", "next"]),
    ("<div class=ad>x</div><p>y</p>", ["y"]),
    ("<div class='site-header'>x</div><main><header><h1>t</h1></header><p>y</p></main><footer>z</footer>", ["t", "y"]),
    ("<script>if (a < b) '</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes", ["yes"]),
    ("<article><p>a</p><section id=comments><p>b</p></section><aside>c</aside><form>d</form><p>e</p></article>", ["a", "e"]),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", ["a", "b", "c", "d"]),
    ("<p>a < b and 1<2</p>", ["a < b and 1<2"]),
    ("<p hidden>a</p><p style='display: none'>b</p><p title='> c'>d</p>", ["d"]),
    ("<p>&lt;b&gt; &#233; &amp</p><p unfinished", ["<b> é &"]),
    ("<p>a</p><!-- never closed <p>b</p>", ["a"]),
    ("<nav><ul><li>x</nav><p>y</p></div></article>", ["y"]),
    ("<head><title>t</title></head><body><p>b</body>", ["b"]),
    ("<div role=navigation>x</div><div role=main>y</div>", ["y"]),
    ("plain text", ["plain text"]),
])
def test_lines(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("bits", [1 << 30, 4])
def test_common_is_a_longest_subsequence(bits):
    draw = random.Random(2)
    for _ in range(1500):
        a, b = ([draw.randrange(5) for _ in range(draw.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = pages.common(a, b, bits)
        rest = iter(b)
        assert len(found) == table[-1][-1] and all(a[k] in rest for k in found)


def test_shared_lines_of_the_nearest_page_go(spark):
    def page(*lines):
        return "<body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body>"

    rows = [(1, "http://h/a/1", page("menu", "first", "quote", "end")), (2, "http://h/a/2", page("menu", "second", "end")),
            (3, "http://h/b/1", page("menu", "quote", "third")), (4, "http://other/a/1", page("menu", "fourth"))]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "first\n\nquote", 2: "second", 3: "quote\n\nthird", 4: "menu\n\nfourth"}


def test_neighbours_over_many_slices(spark):
    """The nearest by path, with one host over all slices."""
    draw = random.Random(3)
    rows = [(k, draw.choice(["h", "h", "h", "g", "solo" + str(k)]), "/" + "/".join(draw.choice("abc") for _ in range(draw.randrange(4))))
            for k in range(300)]
    keys = spark.createDataFrame(rows, "row long, host string, path string")
    order = sorted(rows, key=lambda r: (r[1], r[2], r[0]))

    def agree(a, b):
        return next((k for k, (x, y) in enumerate(zip(a[2], b[2])) if x != y), min(len(a[2]), len(b[2])))

    want = {}
    for k, r in enumerate(order):
        before = order[k - 1] if k and order[k - 1][1] == r[1] else None
        after = order[k + 1] if k + 1 < len(order) and order[k + 1][1] == r[1] else None
        best = before if before and (not after or agree(r, before) >= agree(r, after)) else after
        want[r[0]] = best and best[0]
    assert {r.row: r.other for r in pages.neighbours(keys).collect()} == want


def test_awkward_pages(spark):
    rows = [(None, None, None), (1, "http://h/x", ""), (1, "http://h/x", "<article>a</article>"), (1, "http://h/x", "<article>a</article>"),
            (2, "not a url", "<p>b"), (3, None, "<article>" + "<p>long</p>" * 5000 + "</article>"), (4, "", "\x00 <p>c</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {n: F.lit("extra") for n in ("row", "text", "lines", "kinds", "marks", "host", "path", "other", "slice")})
    got = sorted(((r.page_id, r.url, r.text[:20], r.n_chars) for r in pages.main_text(df).collect()), key=str)
    assert got == sorted([(None, None, "", 0), (1, "http://h/x", "", 0), (1, "http://h/x", "a", 1), (1, "http://h/x", "a", 1),
                          (2, "not a url", "b", 1), (3, None, "long\n\nlong\n\nlong\n\nlo"[:20], 29998), (4, "", "\x00\n\nc", 4)], key=str)
    assert pages.main_text(df.limit(0)).count() == 0


def test_copies_without_article_are_not_compared_with_each_other(spark):
    """One text under many URLs and ids keeps its lines, and loses what it shares with another page."""
    def page(*lines):
        return "<body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body>"

    rows = [(k, f"http://h/a/{k}", page("menu", "copied one", "copied two")) for k in range(1, 30)]
    rows += [(100, "http://h/b/1", page("menu", "third")), (101, "http://h/c/1", page("menu", "fourth", "<p class=ad>ad</p>")),
             (102, "http://only/1", page("menu", "alone")), (103, "http://only/2", page("menu", "alone"))]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: "copied one\n\ncopied two" for k in range(1, 30)} | {
        100: "third", 101: "fourth", 102: "menu\n\nalone", 103: "menu\n\nalone"}


@pytest.mark.parametrize("page, want", [
    ("<body class='home no-sidebar'><p>a</p></body>", ["a"]),
    ("<article class='post related-work'><p>a</p><div class=related>b</div></article>", ["a"]),
    ("<main id='search-results'><p>a</p></main>", ["a"]),
    ("<div class='page has-sidebar with_menu'><p>a</p><div class=sidebar>b</div></div>", ["a"]),
    ("<div class='no-js sidebar'><p>a</p></div><p>b</p>", ["b"]),
])
def test_names_of_the_whole_and_of_layout_are_not_judged(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("page, want", [
    ("<div class='layout sidebar-left'><article><p>a</p></article></div>", ["a"]),
    ("<div class='page right-sidebar'><main><p>a</p></main><div class=sidebar><p>b</p></div></div>", ["a"]),
    ("<div id='search-page'><main><p>a</p></main></div>", ["a"]),
    ("<article><p>a story</p></article><article class='comment'><p>a reader's longer words on it</p></article>", ["a story"]),
    ("<article><p>a</p></article><article class='ad'><p>b</p></article><article class='related teaser'><p>c</p></article>", ["a"]),
    ("<main><article><p>a</p></article><section id=comments><article><p>b</p></article></section></main>", ["a"]),
    ("<div class='layout sidebar-left'><article><p>a</p></article><div class=comments><article class=comment><p>b b</p></article></div></div>", ["a"]),
    ("<article><section class='hero-banner'><p>lead</p></section><p class='notice-board'>a</p><div class='ad-box'>b</div></article>", ["lead", "a"]),
    ("<article class='comment'><p>only this</p></article>", ["only this"]),
    ("<nav><article><p>x</p></article></nav><p>y</p>", ["y"]),
    ("<div class='ad'><p>x</p></div>", []),
])
def test_words_on_layouts_and_on_articles(page, want):
    assert texts(page) == want


def test_pages_with_an_article_go_through_the_differencing(spark):
    """Its result is checked by the markup: a quote comes back, a menu of one page goes."""
    def page(menu, *texts):
        return f"<body><nav>home</nav><nav>{menu}</nav><article>" + "".join(f"<p>{t}</p>" for t in texts) + "</article><footer>end</footer></body>"

    rows = [(1, "http://h/a/1", page("one", "first", "quote")), (2, "http://h/a/2", page("two", "quote", "second")),
            (3, "http://alone/1", page("three", "third"))]
    got = {r.page_id: tuple(r)[2:] for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: ("first\n\nquote", 12, 3, 1, 1), 2: ("quote\n\nsecond", 13, 3, 1, 1), 3: ("third", 5, 0, 0, 3)}


@pytest.mark.parametrize("kinds, shared, want", [
    ([2, 0, 0, 2], {0, 1}, ([], 1, 1)),
    ([2, 1, 1, 1], {0, 2}, ([1], 0, 0)),
    ([1, 0, 2], set(), ([], 0, 2)),
    ([], set(), ([], 0, 0)),
])
def test_check_of_the_differencing(kinds, shared, want):
    assert pages.checked(kinds, shared) == want
