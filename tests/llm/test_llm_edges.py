"""Nulls, blanks, long texts, ties, repeated rows, clashing columns, empty tables."""

import pytest
from llm_conftest import ROWS, SCHEMA, edge_docs

from riskline.llm import components, exact_dedup, hpyp, language, licenses, mixing, ngram_join, packing, pii, quality, queries, wrapper

OPERATORS = {
    "scores": hpyp.scores,
    "linked": ngram_join.linked_documents,
    "quality": quality.verdicts,
    "private": pii.private_spans,
    "dedup": exact_dedup.exact_duplicates,
    "mixture": mixing.mixture,
    "language": lambda d: language.identify(d, language.fit(language.training_rows(d))),
    "licenses": lambda d: licenses.scan(licenses.document_files(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(spark, name):
    got = OPERATORS[name](edge_docs(spark)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).collect() == []


def test_pack_edges(spark):
    got = packing.pack(edge_docs(spark), queries.tokenizer_path()).toPandas()
    assert got[got.start == 0].shape[0] == len(ROWS)
    assert (got[got.doc_id.isin([3, 4, 5])].doc_tokens == 1).all()
    assert packing.pack(spark.createDataFrame([], SCHEMA), queries.tokenizer_path()).collect() == []


def test_dedup_over_partition_borders(spark):
    rows = [(k, "same  text" if k % 2 else "same text", "en", "a") for k in range(1000)] + [(2000 + k, f"other {k}", "en", "a") for k in range(50)]
    got = exact_dedup.exact_duplicates(edge_docs(spark, rows)).toPandas()
    hot = got[got.doc_id < 1000]
    assert (hot.keep_id == 0).all() and (hot.group_size == 1000).all() and hot.kept.sum() == 1
    kept = exact_dedup.drop_exact_duplicates(edge_docs(spark, rows))
    assert kept.columns == edge_docs(spark, rows).columns and kept.count() == 51


def test_row_stages_keep_columns(spark):
    docs = edge_docs(spark)
    for out in (ngram_join.drop_near_duplicates(docs), mixing.mixed(docs), language.keep_identified(docs, language.fit(docs)), quality.keep_good(docs)):
        assert out.columns == docs.columns
        out.collect()
    near = [r.doc_id for r in ngram_join.drop_near_duplicates(docs).collect()]
    assert sorted(near, key=str) == sorted([1, 3, 4, 5, 6, 7, 8, 10], key=str)


def test_mixture_meets_targets(spark):
    rows = [(k, "w " * (1 + k % 40), "en", "abc"[k % 3 if k % 7 else 0]) for k in range(900)]
    got = mixing.mixture(edge_docs(spark, rows)).toPandas()
    again = mixing.mixture(edge_docs(spark, rows).repartition(5)).toPandas()
    assert got.sort_values("doc_id").values.tolist() == again.sort_values("doc_id").values.tolist()
    for _, g in got.groupby("target"):
        assert abs(g.taken.sum() - g.target.iloc[0]) < 0.03 * g.target.iloc[0]
    assert (got.taken <= 3 * got["size"]).all()


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 102), (200, 100), (300, 301)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in (100, 101, 102, 200)} | {300: 300, 301: 300}


def test_licence_inheritance(spark):
    rows = [("r/LICENSE", "Released under the MIT License.", True), ("r/a/b/f.py", "x = 1", False), ("r/a/COPYING", "Licensed under the Apache License, Version 2.0.", True),
            ("r/c/g.py", "# SPDX-License-Identifier: GPL-3.0-or-later\ncode", False), ("q/h.py", None, False), (None, "text", None)]
    got = {r.path: (r.license, r.inherited_from) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string, is_license_file boolean")).collect()}
    assert got["r/a/b/f.py"] == ("Apache-2.0", "r/a") and got["r/c/g.py"] == ("GPL-3.0", None)
    assert got["q/h.py"] == (None, None) and got[None] == (None, None) and got["r/LICENSE"] == ("MIT", None)


def test_probabilities_sum_to_one(spark):
    import numpy as np
    import pyarrow as pa

    customers, tables, v = np.array([6, 4]), np.array([3, 2]), 3
    kept = [(tables, 5, 4)]
    # three words: root customers 2, 2, 1 at 2, 1, 1 tables
    p0 = [[(c - hpyp.ROOT_DISCOUNT * t + (hpyp.ROOT_STRENGTH + hpyp.ROOT_DISCOUNT * 4) / (v + 1)) / (hpyp.ROOT_STRENGTH + 5)] for c, t in ((2, 2), (2, 1), (1, 1))]
    model = pa.table({"word": [b"a", b"b", b"c"], "ctx": [[0, 1], [0, 1], [0]], "n": [[3, 2], [2, 2], [1]], "p0": p0,
                      "kept": [[3 - hpyp.DISCOUNT, 2 - hpyp.DISCOUNT], [2 - hpyp.DISCOUNT, 2 - hpyp.DISCOUNT], [1 - hpyp.DISCOUNT]]})
    ask = hpyp.Words([b"a", b"b", b"c", b"?"], np.arange(4), np.full(4, 2), np.tile([0, 1], 4), np.zeros(8))
    got = hpyp._price(customers, kept, v)(pa.table({"block": [0], "data": [ask.pack("<u4")]}), model)
    p = 10 ** hpyp.Words.unpack(got.column("priced")[0].as_py(), "<f4").figure.reshape(4, 2)
    assert np.allclose(p.sum(axis=0), 1, atol=1e-4)


@pytest.mark.parametrize("around", ['div class="layout has-sidebar"', 'div id="page-with-menu"', 'div class="sidebar-page with-sidebar"', 'div class="sticky-header-page"', 'div class="header"', "form"])
def test_article_is_found_before_anything_goes(around):
    page = f'<body><{around}><article><h1 class="header">Head</h1><div class="legal-analysis"><p class="share-price">Up 3%</p></div><div class="related-posts">More</div><p class="ad">Buy</p></article></{around.split()[0]}></body>'
    assert wrapper.content(page) == "Head\n\nUp 3%"


def test_roles_by_name_go():
    page = '<body><div class="sidebar"><article>Teaser of another page</article></div><div role="navigation">Home</div><div id="cookie-banner">We</div><ul class="nav navbar-nav"><li>A</li></ul><article>Text</article></body>'
    assert wrapper.content(page) == "Text"
    assert wrapper.content(page.replace("<article>Text</article>", "<main>Own</main>")) == "Own"
    assert wrapper.content('<body><div class="post-content">Own</div><div class="site-header">Site</div><div class="comment-list">Nice</div></body>') == "Own"


def induced(pages):
    template = None
    for page in pages:
        one = wrapper.skeleton(wrapper.parse(page))
        template = one if template is None else wrapper.merge(template, one)
    return [wrapper.content(page, wrapper.settled(template)) for page in pages]


@pytest.mark.parametrize("tags", [("article", "div"), ("main", "section"), ("div", "p"), ("div", "div")])
def test_constant_sibling_is_template(tags):
    a, b = tags
    pages = [f"<body><{a}>{''.join(f'<{b}>Own {k} {j}</{b}>' for j in range(1 + k % 4))}<{b}>Read our other news</{b}>{f'<{b}>Last {k}</{b}>' if k % 3 else ''}</{a}></body>" for k in range(30)]
    for some in (pages, pages[:2], pages[::-1]):
        assert all("Own" in t and "other news" not in t for t in induced(some))
    assert [t.count("Own") for t in induced(pages)] == [1 + k % 4 for k in range(30)]


def test_first_page_differs():
    pages = [f"<body><p>{'Other' if k == 0 else 'Site'}</p><h1>Own {k}</h1></body>" for k in range(30)]
    assert induced(pages)[1:] == [f"Own {k}" for k in range(1, 30)]


def test_template_of_one_layout():
    pages = [f"<body><article><h1>Own {k}</h1>{'<div class=offer>Special offer</div>' if k % 3 == 0 else ''}</article></body>" for k in range(30)]
    assert induced(pages) == [f"Own {k}" for k in range(30)]


def test_near_copies_keep_their_long_end():
    pages = [f"<body><article>{''.join(f'<p>Own {k} {j}</p>' for j in range(3))}</article></body>" for k in range(20)]
    copies = [f"<body><article><p>Copy {k}</p>{''.join(f'<p>Same {j}</p>' for j in range(9))}</article></body>" for k in range(3)]
    assert all(t.count("Same") == 9 for t in induced(pages + copies)[20:])


def test_long_lists_align():
    pages = [f"<body><ul>{''.join(f'<li>Item {k} {j}</li>' for j in range(300 + k))}<li>Imprint</li></ul></body>" for k in range(3)]
    assert [(t.count("Item"), t.count("Imprint")) for t in induced(pages)] == [(300, 0), (301, 0), (302, 0)]


@pytest.mark.parametrize("stage", ["near", "mix", "licences"])
def test_rows_are_found_again_when_splits_change(spark, tmp_path, monkeypatch, stage):
    """The files are dealt to tasks anew between the scans, as after a lost executor."""
    body = [" ".join(f"w{k}x{j}" for j in range(30)) for k in range(20)]
    rows = [(k, body[k % 20] if k < 40 else " ".join(f"o{k}y{j}" for j in range(1 + 3 * (k % 9))), "en", "abc"[k % 3]) for k in range(120)]
    if stage == "licences":
        rows = [(k, "Released under the MIT License" if k % 3 == 0 else "text", "en", "a") for k in range(120)]
    edge_docs(spark, rows).repartition(8, "doc_id").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    deal = lambda n, cost: [spark.conf.set("spark.sql.files.minPartitionNum", n), spark.conf.set("spark.sql.files.openCostInBytes", cost)]
    module, name = {"near": (ngram_join, "jaccard_classes"), "mix": (mixing, "_copies"), "licences": (licenses, "own_licenses")}[stage]
    real = getattr(module, name)
    old = {k: spark.conf.get(k) if k != "spark.sql.files.minPartitionNum" else spark.conf.get(k, None) for k in ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")}

    def between(*args, **kw):
        from riskline.llm.common import staged

        out = staged(real(*args, **kw), "seen")
        deal("1", "1")
        return out

    monkeypatch.setattr(module, name, between)
    try:
        deal("8", "128m")
        if stage == "near":
            got = {r.doc_id for r in ngram_join.drop_near_duplicates(docs).collect()}
            assert got >= set(range(20)) | {k for k in range(40, 120) if k % 9 > 1} and not got & set(range(20, 40))
        elif stage == "mix":
            want = {r.doc_id: r.taken // r["size"] for r in mixing.mixture(docs).collect() if r["size"]}
            deal("8", "128m")
            got = [r.doc_id for r in mixing.mixed(docs).collect()]
            assert {k: got.count(k) for k in want} == want
        else:
            files = docs.selectExpr("doc_id", "concat('d', doc_id, '/f') AS path", "text", "false AS is_license_file")
            assert {r.doc_id for r in licenses.scan(files).collect() if r.own_license} == {k for k in range(120) if k % 3 == 0}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_anchors_are_the_most_frequent_words_of_all_training_documents(spark, monkeypatch):
    """Also where no task names them: every word but one is led by others in each partition."""
    from collections import Counter

    texts = [f"w{i % 7} " * 3 + " ".join(f"x{i}-{k}" for k in range(20)) + " Every every" for i in range(60)]
    n = Counter(w for t in texts for w in t.lower().split())
    best = sorted(w.encode() for w, _ in sorted(n.items(), key=lambda x: (-x[1], x[0]))[:4])
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(6)
    assert hpyp.frequent_words(df, 4) == (best, sum(map(len, texts)))
    monkeypatch.setattr(hpyp, "LOCAL_TOP", 5)
    assert hpyp.frequent_words(df, 4)[0] == best
    few = hpyp.frequent_words(spark.createDataFrame([("b a b",)], "text string"), 4)
    assert few == ([b"a", b"b"], 5) and hpyp.frequent_words(df.limit(0), 4) == ([], 0)


def test_anchors_come_from_every_training_document(spark, monkeypatch):
    seen = []
    whole = hpyp.frequent_words
    monkeypatch.setattr(hpyp, "frequent_words", lambda texts, k: seen.append(texts.count()) or whole(texts, k))
    docs = spark.createDataFrame([(i, f"a b w{i}") for i in range(100)], "doc_id long, text string")
    assert hpyp.scores(docs).count() == 100
    assert seen == [docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 1").count()]


def test_points_are_parted_from_letters_alone():
    import random
    import time

    def parted(text):
        def letter(c):
            return "a" <= c <= "z" or ("\u00c0" <= c <= "\u00ff" and c not in "\u00d7\u00f7")

        # only A-Z is lower-cased, as bytes.lower does
        low = text.encode().lower().decode()
        return "".join(f" {c}" if c in ".," and k and letter(low[k - 1]) else c for k, c in enumerate(low)).encode().split()

    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choices("azQ., \n1-\u00d7\u00e9\u00f7\u00a9\u4e2d\u00c3", k=rng.randint(0, 9)))
        assert packing._words(text) == parted(text), text
    plain = "words of plain prose without many points " * 50_000
    begin, _ = time.process_time(), packing._OTHER_POINTS.search(plain.encode())
    whole = time.process_time() - begin
    begin, _ = time.process_time(), plain.encode().split()
    assert whole < 3 * (time.process_time() - begin)  # it took over four times as long as the split
