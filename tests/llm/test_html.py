"""Main text of pages against a tree held as a whole in plain Python, and pages that are badly formed."""

from __future__ import annotations

import collections
import math
import random
import time

import pytest

from millrace.llm import html

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so") for b in ("da", "fe", "gi", "ho", "ju", "pa", "ti")]


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n)) + "."


def texts(spark, pages, **options):
    rows = [(i, url, page) for i, (url, page) in enumerate(pages)]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), **options)
    return [r.text for r in found.orderBy("page_id").collect()]


def whole_tree(pages):
    """Elements and contents that go, by paths and sets of pages; every page differs from the others."""
    looks, contents, own = (collections.defaultdict(lambda: collections.defaultdict(set)) for _ in range(3))
    marks = {}
    for number, page in enumerate(pages):
        found, nodes = html.blocks(page)
        first = {}
        for n in nodes:
            first.setdefault(n.key, n)
        for key, n in first.items():
            looks[key][tuple(n.children)].add(number)
            marks[key] = n.marked
        for text, _, n in found:
            own[n.key][text].add(number)
            while n.above is not None and n.above.above is not None and n.above.marked == n.marked:
                n = n.above
                contents[n.key][text].add(number)
    low = set()
    for key, kinds in looks.items():
        m = sum(map(len, kinds.values()))
        if m < html.MIN_PAGES:
            continue
        bonus = html.MARKED * marks[key]
        score = -sum(len(v) / m * math.log(len(v) / m, m) for v in kinds.values())
        spread = [math.log(len(v), m) for v in [*contents[key].values(), *own[key].values()]]
        if spread:
            content = 1 - sum(spread) / len(spread)
            share = html.GAMMA ** len(kinds)
            score = max((1 - share) * score + share * content, content / 2)
        if score + bonus < html.THRESHOLD:
            low.add(key)
        low |= {html._hash(key, text) for text, v in own[key].items() if len(v) > 1 and 1 - math.log(len(v), m) + bonus < html.THRESHOLD}
    return low


def site_page(i: int) -> str:
    draw = random.Random(i)
    body = "".join(f"<p>{prose(1000 * i + k, 12)}</p>" for k in range(draw.randint(1, 5)))
    wrap = ("<div class=story>{}</div>", "<article>{}</article>", "<main>{}</main>")[i % 3]
    return (
        f"<html><body><div class=top><p>Our site</p><p>{draw.choice(['red', 'blue'])} edition</p></div>"
        + wrap.format(f"<h1>{prose(i, 4)}</h1>{body}<p>Read all our stories here.</p>" + ("<p>Rare words</p>" if i % 20 == 0 else ""))
        + "<div>Made with care</div></body></html>")


def test_same_as_a_whole_tree(spark):
    # More pages than the map of contents has room for, so that counts are plain.
    pages = [site_page(i) for i in range(700)]
    low = frozenset(whole_tree(pages))
    want = [html.main_text(p, low) for p in pages]
    assert texts(spark, [(f"http://one.example/{i}", p) for i, p in enumerate(pages)]) == want
    for i, text in enumerate(want):
        lines = text.split("\n")
        assert lines[0] == prose(i, 4) and "Read all our stories here." not in lines and "Our site" not in lines
        assert "Made with care" not in lines and ("Rare words" in lines) == (i % 20 == 0)
    assert any(html.main_text(p) != t for p, t in zip(pages, want))


def test_repeated_block_in_the_article_goes(spark):
    pages = [f"<article><h1>{prose(i, 3)}</h1><p>{prose(i + 500, 20)}</p><p>Sign the letter today.</p></article>" for i in range(60)]
    assert texts(spark, [(f"http://h.example/{i}", p) for i, p in enumerate(pages)]) == [f"{prose(i, 3)}\n{prose(i + 500, 20)}" for i in range(60)]


@pytest.mark.parametrize("other", [0, 5, 40])
def test_copies_do_not_remove_each_other(spark, other):
    copy = f"<body><div class=story><p>{prose(1, 20)}</p><p>{prose(2, 25)}</p></div></body>"
    pages = [copy] * 200 + [f"<body><div class=story><p>{prose(i + 10, 20)}</p></div></body>" for i in range(other)]
    want = [f"{prose(1, 20)}\n{prose(2, 25)}"] * 200 + [prose(i + 10, 20) for i in range(other)]
    assert texts(spark, [("http://h.example/a", p) for p in pages]) == want


def test_few_pages_and_other_hosts_are_not_judged(spark):
    page = "<body><p>{}</p><p>Same words</p></body>"
    pages = [(f"http://h{i % 8}.example/", page.format(prose(i, 9))) for i in range(8 * (html.MIN_PAGES - 1))]
    pages += [(None, page.format(prose(i, 9))) for i in range(30)] + [("no host", page.format("x")), ("http://h1.example", None), ("http://h1.example", "")]
    got = texts(spark, pages)
    assert got[:-3] == [f"{prose(i, 9)}\nSame words" for i in [*range(len(pages) - 33), *range(30)]] and got[-3:] == ["x\nSame words", "", ""]


def test_columns_of_the_caller(spark):
    rows = spark.createDataFrame([("http://a.b/", "<p>x</p>", 1, 2, 3, 4)], "url string, html string, node int, low int, _host int, text int")
    assert html.extract(rows).collect()[0].asDict() == {"url": "http://a.b/", "node": 1, "low": 2, "_host": 3, "text": "x"}


@pytest.mark.parametrize("page, text", [
    ("<div class='layout has-sidebar'><article>body</article><div class=sidebar>x</div></div>", "body"),
    ("<div class=no-comments><main>body</main></div>", "body"),
    ("<form id=page><article>body</article></form>", "body"),
    ("<article>body of the page</article><div class=related><article>a much longer story that is elsewhere</article></div>", "body of the page"),
    ("<main><h1>Head</h1><article>the story of this page</article><article>teaser</article></main>", "Head\nthe story of this page"),
    ("<article>the first part</article><article>the other part</article>", "the first part\nthe other part"),
    ("<aside><article>long but at the side of the page</article></aside><p>body</p>", "body"),
    ("<article><p>body</p><div class=comments><p>reader</p></div></article>", "body"),
    ("<p>a < b and c > d</p><p>1 <2</p>", "a < b and c > d\n1 <2"),
    ("<p title=\"a > b\">x</p><p title='a < b'>y</p><p title=it's>z</p>", "x\ny\nz"),
    ("<p title=\"open>x</p><b class=\"y\">z</b>", "x\nz"),
    ("a<script>if (x < 1) '</p>'</SCRIPT >b<svg/>c<!-- d -->e<!doctype html>f</>g", "abcefg"),
    ("<p>x<script>never closed <p>y", "x"),
    ("</p></div>x</section>", "x"),
])
def test_pages(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("piece", ["a < b ", "<a b ", "<div>", "<div>x", "<div></section>", "<a =\"<a =' >\" ", "<p x=\"<b '", "<!-", "<script>"])
def test_time_follows_the_length(piece):
    start = time.perf_counter()
    page = piece * 100_000
    html.main_text(page, frozenset([1]))
    html._tree_rows(page)
    assert time.perf_counter() - start < 30
