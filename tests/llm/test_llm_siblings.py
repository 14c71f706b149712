"""Long lists of siblings are aligned as short ones are."""

import random

import pytest

from riskline.llm import wrapper


def children(html):
    return wrapper.skeleton(wrapper.parse(f"<div>{html}</div>"))[4][0]


def both(monkeypatch, a, b, cells=2_000_000):
    """(score, pairs, merged) by the table in plain Python, and by rows of numbers."""
    got = []
    for pairs in (10**12, 0):
        monkeypatch.setattr(wrapper, "PAIRS", pairs)
        monkeypatch.setattr(wrapper, "CELLS", cells)
        got.append((wrapper._score(a, b), wrapper.align(a, b), wrapper.merge(a, b)))
    return got


@pytest.mark.parametrize("cells", [5, 60, 2_000_000])
def test_any_length_gives_the_pairs_of_the_table(monkeypatch, cells):
    rng = random.Random(cells)

    def node(depth, tags, texts):
        below = [node(depth - 1, tags, texts) for _ in range(rng.randint(0, 3))] if depth else []
        return [rng.choice(tags), 1, dict.fromkeys(rng.sample(texts, rng.choice([0, 0, 1, 1, 2, 3])), 1), 0, below]

    for _ in range(150):
        tags, texts, depth = rng.choice([["p"], ["p", "b"], ["p", "b", "div.x"]]), list("abcdefghijkl")[: rng.choice([3, 6, 12])], rng.choice([0, 0, 1, 2])
        a, b = (["r", 1, {}, 0, [node(depth, t, texts) for _ in range(rng.randint(0, rng.choice([14, 40])))]] for t in (tags, [*tags, "i"]))
        if rng.random() < 0.5:  # a near copy, in order or not
            b[4] = [c for c in a[4] if rng.random() < 0.8] + b[4][:2]
            if rng.random() < 0.5:
                rng.shuffle(b[4])
        table, rows = both(monkeypatch, a, b, cells)
        assert table == rows


# None of these has a text that is alone in its list, so cutting at such texts leaves them all to be paired in order.
LISTS = {
    "one more in front": ("<p>a</p><p>b</p><p>c</p>" * 80, "<p>z</p><p>z</p>" + "<p>a</p><p>b</p><p>c</p>" * 80),
    "elements without texts": ("<hr><br><br>" * 80, "<br>" + "<hr><br><br>" * 80),
    "rows of a table": ("<tr><td>a<td>b</tr><tr><td>c<td>b</tr>" * 120, "<tr><td>d<td>d</tr>" * 2 + "<tr><td>a<td>b</tr><tr><td>c<td>b</tr>" * 120),
}


@pytest.mark.parametrize("name", LISTS)
def test_no_switch_by_length(monkeypatch, name):
    a, b = map(children, LISTS[name])
    assert len(a[4]) * len(b[4]) > wrapper.PAIRS
    default = wrapper._score(a, b), wrapper.align(a, b), wrapper.merge(a, b)
    monkeypatch.setattr(wrapper, "PAIRS", 10**12)
    assert default == (wrapper._score(a, b), wrapper.align(a, b), wrapper.merge(a, b))


def test_lists_in_lists_to_the_last_level(monkeypatch):
    """Each level by rows of numbers: their calls fit in one another."""
    a, b = (wrapper.skeleton(wrapper.parse("".join(f"<i>{k % n}</i><i>x</i><div>{n}" for k in range(wrapper.DEPTH - 2)))) for n in (5, 7))
    table, rows = both(monkeypatch, a, b)
    assert table == rows


def test_constant_notes_of_a_long_page_go(spark):
    """Pages of 300 varying lines in which a note comes again and again, at places that differ."""
    rng = random.Random(3)

    def page(n):
        lines = [f"<div>{n} {k} {rng.random()}</div>" for k in range(300)]
        for at in sorted(rng.sample(range(300), 6), reverse=True):
            lines.insert(at, "<div>Read this note</div>")
        return f"<html><body>{''.join(lines)}</body></html>"

    pages = [page(n) for n in range(6)]
    got = wrapper.main_text(spark.createDataFrame([(n, "http://h/a", p) for n, p in enumerate(pages)], "page_id long, url string, html string")).collect()
    assert len(got) == 6
    for r in got:
        assert [t for t in r.text.split("\n\n") if t != "Read this note"] == [t[5:-6] for t in pages[r.page_id][12:-14].replace("</div><div>", "</div>\n<div>").split("\n") if "note" not in t]
        assert r.text.count("Read this note") == 0
