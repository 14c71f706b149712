"""SQL forms, and results that SQL can't express against brute force, on a small table."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from oracle import compare, duck

import corpus_pipeline
from llm_conftest import SF, docs_of
from riskline.llm import hpyp, language, ngram_join, packing, pii, queries, wrapper


@pytest.fixture(scope="module")
def docs(spark):
    return docs_of(spark).toPandas()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    ok, why = compare(queries.queries()[name](spark, SF).toPandas(), duck(SF).sql(queries.oracle_sql()[name]).df())
    assert ok, why


def test_language_model(spark, docs):
    got = queries.op1_hpyp_lm(spark, SF).toPandas()
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs.doc_id}
    words = {i: hpyp.tokens(t or "") for i, t in zip(docs.doc_id, docs.text)}
    c = collections.Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for r in got.itertuples():
        ws = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(ws), n)
        assert r.n_known == sum(c[w] > 0 for w in ws)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel_tol=1e-9)
        assert r.score < 0
    out = got[got.held_out]
    assert out.score.sum() > out.base_score.sum()


def links_of(texts, percent, words=4):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and x and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_join(spark, docs):
    got = queries.op3_ngram_jaccard_join(spark, SF).toPandas()
    want = links_of(dict(zip(docs.doc_id, docs.text)), 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want


def test_jaccard_join_of_chained_edits(spark):
    base = [f"w{k}" for k in range(60)]
    texts = {k: " ".join(base[: 60 - k] + [f"x{j}" for j in range(k)]) for k in range(30)}
    texts |= {100 + k: " ".join([f"v{k}"] + base[:40] + [f"u{k}"]) for k in range(20)}
    got = ngram_join.linked_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).toPandas()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == links_of(texts, 85)


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    got = queries.op6_cutting_stock_packing(spark, SF).toPandas().sort_values(["sequence_id", "offset"])
    check_packing(got)
    tok = Tokenizer.from_file(queries.tokenizer_path())
    for i, t in zip(docs.doc_id, docs.text):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        mine = got[got.doc_id == i].sort_values("start")
        assert list(mine.start) == [0, *np.cumsum(mine.length)[:-1]] and mine.length.sum() == len(ids) == mine.doc_tokens.iloc[0]
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(mine.start, mine.length)] == list(mine.ids_crc32)
    sequences = got.sequence_id.nunique()
    assert got.length.sum() / (4096 * sequences) > 0.9


def check_packing(got):
    ends = got.groupby("sequence_id").length.cumsum()
    assert (got.offset == ends - got.length).all() and ends.max() <= 4096


def test_plan_holds_every_piece_once():
    demand = {c: 1 + 7000 // (c * c) for c in range(1, 64)}
    patterns = packing.plan(demand, 64)
    total = collections.Counter()
    for items, k in patterns:
        assert sum(c * a for c, a in items.items()) <= 64
        total.update({c: a * k for c, a in items.items()})
    assert total == demand
    least = math.ceil(sum(c * n for c, n in demand.items()) / 64)
    assert sum(k for _, k in patterns) <= 1.03 * least + 2


def test_language(spark, docs):
    got = queries.op9_language_mixture(spark, SF).toPandas().merge(docs, on="doc_id")
    out = got[got.held_out & (got.lang_pred != "und")]
    assert (out.lang == out.lang_pred).mean() > 0.95
    assert got.score.between(0, 1).all()
    assert ((got.lang_pred == "und") == ~got.text.fillna("").map(lambda t: bool(re.search(r"[^\W\d_]", t)))).all()


def test_mixture_proportions():
    rng = np.random.default_rng(0)
    p = np.stack([np.array([0.7, 0.2, 0.05, 0.05]), np.array([0.05, 0.05, 0.2, 0.7])], axis=1)
    n = rng.multinomial(4000, 0.75 * p[:, 0] + 0.25 * p[:, 1]).astype(float)
    assert language.mixture(np.log(p), n)[0] == pytest.approx(0.75, abs=0.05)
    n = rng.multinomial(4000, p[:, 1]).astype(float)
    assert language.mixture(np.log(p), n).tolist() == [0.0, 1.0]


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 12 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


TRICKY = [
    "a@b.com_foo@bar.com x@y.z..1 +1 (22) 33-44 55 66 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 4111 1111 1111 1111",
    "+1+1 222 333 4444 é ñ 😀 a.b@c.de 4111-1111-1111-1111-1 ", None, "", "a" * 20000 + "@", "1." * 2000 + "1 " + "9" * 20000,
    "api token = \"9f8a7b6c5d4e3f2a1b0c9d8e7f6a5b4c3d2e1f00\" and 4845168114407329",
]


def test_private_spans(spark, docs):
    texts = dict(zip(docs.doc_id, docs.text)) | {10**6 + k: t for k, t in enumerate(TRICKY)}
    got = pii.private_spans(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).toPandas()
    for r in got.itertuples():
        want = base_spans(texts[r.doc_id] or "")
        said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest(), r.doc_id
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        assert set(said.split(",")) <= set(r.spans.split(",")) or not said
    assert "secret:13:53" in got[got.doc_id == 10**6 + 6].spans.iloc[0]


def test_main_text(spark):
    page = ("<html><head><title>t</title></head><body><nav class='menu'><a>Home</a></nav><div class='cookie-notice'>We use cookies</div>"
            "<div class=brand>Site name</div><article><h1>T {0}</h1><p>Body &amp; soul\n {0}<br>more</p><p><b>Open {0}<p>Next</p><aside>ad</aside></article>"
            "<section id='comments'><p>Nice {0}</p></section><form>x</form><script>var a='<p>';</script><footer>f</footer></body></html>")
    bare = "<body><div class=brand>Site name</div><div>Text {0}</div></body>"
    rows = [(k, "http://h.example/p", page.format(k)) for k in range(20)] + [(100 + k, "http://g.example/p", bare.format(k)) for k in range(20)]
    rows += [(200, None, None), (201, "x", ""), (202, "http://one.example", "just text &lt; here")]
    got = {r.page_id: r.text for r in wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == f"T {k}\n\nBody & soul {k} more\n\nOpen {k}\n\nNext" for k in range(20))
    assert all(got[100 + k] == f"Text {k}" for k in range(20))  # the constant brand is template
    assert (got[200], got[201], got[202]) == ("", "", "just text < here")


def test_pages_whole(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = queries.op2_wrapper_induction(spark, SF).toPandas()
    assert len(got) == pages.count() and (got.n_chars == got.text.map(len)).all()
    assert not got.text.str.contains("&copy;|track\\(").any()


def test_pipeline(spark, docs):
    got = corpus_pipeline.run(spark, SF).toPandas().sort_values(["sequence_id", "offset"])
    check_packing(got)
    keep = docs[docs.text.fillna("").map(lambda t: bool(re.search(r"[^\W\d_]", t)))].copy()
    keep["norm"] = keep.text.str.replace(r"[\x20\x09-\x0D]+", " ", regex=True)
    keep = keep.sort_values("doc_id").drop_duplicates("norm")
    root = links_of(dict(zip(keep.doc_id, keep.text)), 80, words=5)
    alive = {i for i, (_, r) in root.items() if i == r}
    assert set(got.doc_id) <= alive
    copies = got[got.start == 0].groupby("doc_id").size()
    assert copies.max() <= 3
    size = keep.set_index("doc_id").text.map(lambda t: len(t.split()))
    taken, had = (copies * size).sum(), size[list(alive)].sum()
    assert abs(taken - had) < 0.1 * had
