"""HTML extraction on hostile markup, on frames that are forms, and on tables with odd rows."""

import functools
import time

import pytest
from llm_conftest import SF

from riskline.llm import wrapper

PAGES = "page_id long, url string, html string, host string, text string, n_chars int"


def both_ways(page):
    """The text with and without a template that the page itself gave."""
    template = wrapper.settled(wrapper.merge(wrapper.skeleton(wrapper.parse(page)), wrapper.skeleton(wrapper.parse(page))))
    wrapper.content(page, template)
    return wrapper.content(page)


@pytest.mark.parametrize("tag", ["div", "b", "ul><li", "table><tr><td", "article", "font"])
def test_deep_nesting_keeps_all_text_in_order(tag):
    n = 10_000
    page = "<body><p>first</p>" + "".join(f"<{tag}>t{k} " for k in range(n)) + "middle " + f"</{tag.split('>')[0]}>" * n + "<p>last</p>"
    text = both_ways(page if tag != "article" else page.replace("<p>first</p>", "").replace("<p>last</p>", ""))
    words = text.split()
    assert [w for w in words if w.startswith("t")] == [f"t{k}" for k in range(n)] and "middle" in words


UNITS = ["<a ", '<a href="', "<a '\">", '<a ">', '<a "', "<!", "</", "<", "<a b='\"'\"", "<p class=", "&#", "<script", "<!--", "<td>", "<p", "< p>", '<a b="c" d=\'e']


@pytest.mark.parametrize("unit", UNITS)
@pytest.mark.parametrize("end", ["", ">"])
def test_a_megabyte_of_broken_tags_takes_seconds(unit, end):
    began = time.process_time()
    text = both_ways("<p>Kept</p>" + unit * (1_000_000 // len(unit)) + end)
    assert text.startswith("Kept") and time.process_time() - began < 20


def test_tags_end_outside_quotes():
    assert wrapper.content('<p title="a > b">One</p><p title=\'x">\'>Two < 3</p><p title="open>Three</p><p a="1" b=2>Four</p>') == "One\n\nTwo < 3\n\nThree\n\nFour"


def test_all_articles_of_a_text_stay():
    page = "<body><main><article>One, the longest of them</article><article>Two</article><section><article>Teaser</article></section></main><aside><article>Ad</article></aside></body>"
    assert wrapper.content(page) == "One, the longest of them\n\nTwo"


def test_a_form_round_the_page_is_its_frame():
    page = '<body><form id="aspnetForm"><div><p>Text of the page, all of it</p><p>More</p></div><form>Name <input></form></form></body>'
    assert "Text of the page, all of it" in wrapper.content(page)
    assert wrapper.content("<body><p>Text of the page</p><form>Your name <input></form></body>") == "Text of the page"


def brute_matching(a, b):
    """The best score of pairing children in order, by trying all."""
    x, y = a[4], b[4]

    @functools.cache
    def best(i, j):
        if i == len(x) or j == len(y):
            return 0
        got = max(best(i + 1, j), best(i, j + 1))
        w = pair(x[i], y[j])
        return max(got, w + best(i + 1, j + 1)) if w else got

    return best(0, 0)


def pair(c, d):
    if c[0] != d[0]:
        return 0
    return (wrapper.SAME if set(c[2]) & set(d[2]) else 1) + brute_matching(c, d)


def test_tree_matching_equals_brute_force():
    import random

    rng = random.Random(5)

    def tree(depth):
        kids = "".join(tree(depth - 1) for _ in range(rng.randint(0, 4))) if depth else ""
        tag = rng.choice(["div", "p", "b"]) if depth != 3 else "div"
        return f"<{tag}>{rng.choice(['x', 'y', ''])}{kids}</{tag}>"

    for _ in range(60):
        a, b = (wrapper.skeleton(wrapper.parse(tree(3))) for _ in range(2))
        assert wrapper._score(a, b) == brute_matching(a, b)
        pairs = wrapper.align(a, b)
        assert pairs == sorted(pairs) and sum(wrapper._weight(a[4][i], b[4][j]) for i, j in pairs) == brute_matching(a, b)


def test_odd_rows(spark):
    body = "<html><body><nav>Menu</nav><p>Text {}</p></body></html>"
    rows = [(1, "http://h/a", body.format(1)), (1, "http://h/a", body.format(1)), (2, "http://h/b", None), (3, "http://h/c", ""), (4, None, body.format(4)), (None, "x", body.format(5)),
            (6, "http://h/d", body.format("w " * 50000)), (7, "http://h/e", "<div>" * 5000 + "deep")]
    pages = spark.createDataFrame([(*r, "other", "clash", 5) for r in rows], PAGES)
    got = wrapper.main_text(pages).collect()
    assert sorted(str(r.page_id) for r in got) == sorted(str(r[0]) for r in rows) and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == "Text 1" and texts[2] == texts[3] == "" and texts[4] == "Text 4" and texts[None] == "Text 5" and texts[7] == "deep"
    assert texts[6].count("w") == 50000 and all(r.n_chars == len(r.text) for r in got)
    assert wrapper.main_text(spark.createDataFrame([], PAGES)).collect() == []


def test_given_pages_are_unchanged_by_the_lenient_parser(spark):
    """No page of the table nests deeper than the bound or has an open quote, so nothing is flattened."""
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        def depth(node, d=0):
            return max([d, *[depth(x, d + 1) for x in node.items if isinstance(x, wrapper.Node)]])
        assert depth(wrapper.parse(r.html)) < wrapper.DEPTH
