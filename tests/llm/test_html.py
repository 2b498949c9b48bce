"""Main text of pages: markup rules, pairing and alignment against plain versions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kitchenlight.llm import html as H
from kitchenlight.llm.ordering import with_neighbours
from tests.conftest import SMALL

SCHEMA = "page_id long, url string, html string, text string, shared int"


def text_of(page):
    lines = H.page_lines(page)
    return [lines[i][1] for i in H.candidates(lines)[0]]


@pytest.mark.parametrize(
    "page,want",
    [
        ("", []),
        ("just text &amp; more\n\n text", ["just text & more text"]),
        ("<p>a<p>b <b>c</b>d<br>e", ["a", "b cd e"]),
        ("<script>if (a<b) x('</p>')</script><style>p{}</style>k<!-- c --><![CDATA[z]]>l", ["kl"]),
        ("<title>t</title><nav>n</nav><article><h1>T</h1><p class='ad'>x</p><p>y&nbsp;&eacute;</p><footer>f</footer></article><div>z</div>", ["T", "y é"]),
        ("<header>h</header><main><header><h1>T</h1></header><p>a</p><aside>s</aside></main><footer>f", ["T", "a"]),
        ("<div class='site-header'>h</div><div class='post-comments'><p>c</p></div><div class='with-sidebar'>m</div>", ["m"]),
        ("<article><p>a</p><section id=comments><article>c</article></section><div class='cookie-notice'>k</div></article>", ["a"]),
        ("<div role=navigation>n</div><div hidden>h</div><div style='display: none'>d</div><form>f<input></form>x", ["x"]),
        ("<p title='a>b'>q</p><a href=\"x>y\">r</a>", ["q", "r"]),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>", ["a", "b", "1 2", "3"]),
        ("<p>unclosed <b", ["unclosed <b"]),
        ("1 < 2 and 3 > 2 &am &amp", ["1 < 2 and 3 > 2 &am &"]),
    ],
)
def test_markup(page, want):
    assert text_of(page) == want


def test_url_key():
    assert H.url_key("https://WWW.A.org/x/y.html?q=1#t") == ("a.org", "x/y")
    assert H.url_key("http://a.org/x/y/") == ("a.org", "x/y")
    assert H.url_key("http://a.org/x/index.php") == ("a.org", "x")
    assert H.url_key(None) == ("", "")


def test_common_lines_is_longest():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        got = H.common_lines(a, b)
        assert len(got) == table[-1][-1] and got == sorted(set(got))
        rest = iter(b)
        assert all(a[i] in rest for i in got)


def test_neighbours_cross_ranges(spark):
    ids = [None, *random.Random(2).sample(range(10_000), 500)]
    df = spark.createDataFrame([(i, str(i)) for i in ids], "k long, v string")
    order = sorted(ids, key=lambda i: (i is not None, i or 0))
    for ring in (False, True):
        got = {r.k: (r.before and r.before.v, r.after and r.after.v) for r in with_neighbours(df, ["k"], ["v"], ring).collect()}
        for n, k in enumerate(order):
            before = str(order[n - 1]) if n or ring else None
            after = str(order[(n + 1) % len(order)]) if n + 1 < len(order) or ring else None
            assert got[k] == (before, after)
    assert with_neighbours(df.filter("k < 0"), ["k"], ["v"]).count() == 0


def site(n):
    menu = "<div>Home</div><div>News</div><div>Contact us</div>"
    return f"<html><body>{menu}<div>Story {n} begins.</div><div>It goes on {n}.</div><div>All rights reserved</div></body></html>"


def test_lines_shared_with_the_nearest_page_go(spark):
    rows = [(i, f"http://a.org/news/{i:03d}.html", site(i), "clash", 1) for i in range(40)]
    rows += [(50, "http://b.org/x", site(50), None, None), (51, None, "<p>no url", None, None), (52, "http://b.org/y", None, None, None), (53, "http://c.org/", "", None, None)]
    rows += [rows[3], rows[3], (60, "http://d.org/a", site(60), None, None), (61, "http://d.org/b", site(60), None, None)]
    rows += [(70 + i, f"http://e.org/{i}", f"<div>Shared</div><article><p>Shared</p><p>own {i}</p></article>", None, None) for i in range(4)]
    found = H.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(r.page_id for r in found) == Counter(r[0] for r in rows)
    text = {r.page_id: r.text for r in found}
    assert all(r.n_chars == len(r.text) for r in found)
    assert all(text[i] == f"Story {i} begins.\nIt goes on {i}." for i in range(40))
    assert text[50].startswith("Home\n")  # its only neighbour is empty
    assert (text[51], text[52], text[53]) == ("no url", "", "")
    assert text[60] == text[61] and text[60].count("\n") == 5  # a host of copies only: they tell nothing
    assert [text[70 + i] for i in range(4)] == [f"Shared\nown {i}" for i in range(4)]  # the article is never cut
    assert H.main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_copies_lose_what_the_nearest_other_page_shares(spark):
    """Runs of copies, side by side, under one path and apart, between, before and after pages of their own."""
    rows = [(i, f"http://a.org/n/{i:03d}", site(1 if i in (0, 1, 2, 10, 11, 12, 13, 14, 20, 39) else 100 + i), None, None) for i in range(40)]
    rows += [(50 + i, f"http://b.org/x?page={i}", site(2), None, None) for i in range(300)]  # one path
    rows += [(400, "http://b.org/y", site(3), None, None)]
    rows += [(500 + i, f"http://c.org/{i}", "", None, None) for i in range(3)] + [(503, "http://c.org/z", site(4), None, None)]
    found = H.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(r.page_id for r in found) == Counter(r[0] for r in rows)
    number = {i: 1 if i in (0, 1, 2, 10, 11, 12, 13, 14, 20, 39) else 100 + i for i in range(40)}
    number |= {50 + i: 2 for i in range(300)} | {400: 3}
    text = {r.page_id: r.text for r in found}
    assert all(text[i] == f"Story {n} begins.\nIt goes on {n}." for i, n in number.items())
    assert [text[500 + i] for i in range(3)] == [""] * 3 and text[503].startswith("Home\n")


def test_sample_pages_equal_a_plain_extraction(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?p>|</?h1>|<br>", article)]
        want[r.page_id] = "\n".join(filter(None, blocks))
    found = H.main_text(pages)
    assert {r.page_id: r.text for r in found.collect()} == want
    assert found.filter(F.col("n_chars") != F.char_length("text")).count() == 0
