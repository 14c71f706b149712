"""URL templates, filter interaction and spelling variants: brute force and edge cases."""

import collections
import itertools
import re
import zlib

import pytest
from llm_conftest import SCHEMA, docs_of, edge_docs

from riskline.llm import interaction, spelling, urls

LABELS = "doc_id long, quality int, toxic int"
PAGES = "page_id long, url string, host string, path string, shape string, n long, good boolean"


# spelling variants


def near_by_brute_force(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_by_brute_force(rows):
    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: c for w, c in n.items() if c >= 2 and len(w) >= 7}
    near = {w: [v for v in n if near_by_brute_force(w, v)] for w in n}
    form = {w: min(near[w], key=lambda v: (-n[v], v), default=None) for w in n}
    form = {w: f if f and n[f] >= 10 * n[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def variants(docs, **how):
    got = spelling.variants(docs, **how).collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def words_of(*counted):
    return " ".join(w for w, n in counted for _ in range(n))


# One frequent beginning, one frequent ending, chains of forms, ties, letters beyond ASCII.
HARD = [
    words_of(("Straßenbahn", 300), ("straßenbahm", 30), ("straßenbahmm", 3), ("Ütraßenbahn", 2), ("straßenbahns", 30)),
    words_of(*[("prefixx" + a + b, 2 + (a == b)) for a in "abcdefg" for b in "uvwxyz"]),
    words_of(*[(a + b + "endings", 2) for a in "abcdefg" for b in "uvwxyz"], ("aendings", 40), ("endings", 400)),
    words_of(("aaaaaaa", 5), ("aaaaaaaa", 50), ("aaaaaaaaa", 500), ("aaaaaaaaaa", 4), ("aabaaaa", 2)),
    words_of(("running", 20), ("runninh", 2), ("runnind", 2), ("cunning", 20), ("runing", 9), ("ru÷nning", 2)),
]


@pytest.mark.parametrize("list_words", [spelling.LIST_WORDS, 3])
def test_variants_equal_brute_force(spark, list_words):
    rows = [(k, t) for k, t in enumerate(HARD)] + [(None, HARD[0]), (None, None), (7, ""), (8, " \n\t"), (9, "日本語 " + HARD[4]), (9, "日本語 " + HARD[4])]
    docs = edge_docs(spark, [(i, t, "en", "a") for i, t in rows])
    want = variants_by_brute_force(rows)
    assert variants(docs, list_words=list_words) == want
    assert any(v[0] and v[0] != v[1] for v in want.values())


def test_variants_of_a_table(spark):
    docs = docs_of(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert variants(docs) == variants_by_brute_force(rows)


def test_variants_of_very_long_words(spark):
    long = "ab" * 5000
    rows = [(1, words_of((long, 2), (long + "c", 30), ("x" + long, 3), (long[:5000] + "z" + long[5001:], 2)))]
    assert variants(edge_docs(spark, [(i, t, "en", "a") for i, t in rows])) == variants_by_brute_force(rows)


def test_variants_of_nothing(spark):
    assert variants(spark.createDataFrame([], SCHEMA)) == {}
    assert variants(edge_docs(spark, [(1, "short words", "en", "a"), (2, "uniqueword", "en", "a")])) == {}


# filter interaction


def audit_by_brute_force(rows, labels):
    texts = collections.defaultdict(set)
    for i, t, _ in rows:
        if i is not None:
            texts[t or ""].add(i)
    masks = []
    for i, t, part in rows:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), bool(re.search("[#$%&*|]", t)),
                 i is not None and i > min(texts[t]))
        own = [x for x in labels if x[0] == i and i is not None]
        masks.append((part or "", {f for f, x in zip("ABCDE", fails) if x}, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    removed, out = collections.Counter(), {}
    orders = ["".join(o) for o in itertools.permutations("ABCDE")]
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        for o in orders:
            for k, f in enumerate(o):
                gone = [m for m in own if f in m[1] and not m[1] & set(o[:k])]
                removed[part, f] += len(gone)
                out[part, o, k + 1] = [sum(not m[1] & set(o[: k + 1]) for m in own), len(gone), sum(f in m[1] and bool(m[1] & set(o[:k])) for m in own),
                                       sum(m[1] == {f} for m in own), sum(m[2] for m in gone), sum(m[3] for m in gone)]
    return {key: (*v, removed[key[0], key[1][key[2] - 1]]) for key, v in out.items()}


def audited(frame):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in frame.collect()}


GOOD = " ".join(f"word{k}" for k in range(60))
#: Copies whose smallest id comes late, over parts; null and repeated ids; every own failure.
AUDITED = [
    (50, GOOD, "a"), (40, GOOD, "b"), (30, GOOD, None), (30, GOOD, ""), (30, GOOD, None), (None, GOOD, "a"), (60, GOOD, "b"), (50, GOOD, "a"),
    (1, GOOD + " #", "a"), (2, GOOD.upper(), "a"), (3, "few words", "b"), (9, "few words", "c"), (4, "the same " * 40, "b"), (5, None, "a"), (6, "", "b"), (0, "", "c"),
    (7, GOOD + " é|" + "\u2003" * 5, "a"), (8, "A$ " * 70, "c"), (11, GOOD + " x", "c"), (12, "word " * 30000, "c"),
]
MARKED = [(50, 1, 0), (40, 0, 1), (30, 1, 1), (30, 0, None), (9, 1, 0), (None, 1, 1), (3, None, None), (8, 0, 1), (77, 1, 1)]


def as_table(spark, rows, folder, files):
    size = -(-len(rows) // files)
    for k in range(files):
        part = [(i, t, "en", s, 0, "x", 7, 3) for i, t, s in rows[k * size : (k + 1) * size]]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("files", [1, 4, 20])
def test_audit_equals_brute_force(spark, tmp_path, files):
    folder = f"file://{tmp_path}/docs"
    as_table(spark, AUDITED, folder, files)
    got = audited(interaction.audit(spark, folder, spark.createDataFrame(MARKED, LABELS), batches=files))
    assert got == audit_by_brute_force(AUDITED, MARKED)


def test_smaller_ids_retract_earlier_counts(spark, tmp_path):
    """Ids fall from file to file, so every batch retracts what the one before had counted."""
    rows = [(k, GOOD, "ab"[k % 2]) for k in range(12, 0, -1)]
    folder = f"file://{tmp_path}/docs"
    as_table(spark, rows, folder, 12)
    state = f"file://{tmp_path}/state"
    counters = interaction.count_failures(spark, folder, spark.createDataFrame(MARKED, LABELS), folder=state, batches=12)
    assert {(r.part, r.mask): r.n for r in counters.where("n <> 0").collect()} == {("a", 16): 6, ("b", 16): 5, ("b", 0): 1}
    written = spark.read.parquet(f"{state}/counters")
    assert written.where("n < 0").count() == 11 and written.where("batch >= 0").select("batch").distinct().count() == 12


def test_audit_goes_on_in_its_folder(spark, tmp_path):
    folder, state = f"file://{tmp_path}/docs", f"file://{tmp_path}/state"
    labels = spark.createDataFrame(MARKED, LABELS)
    as_table(spark, AUDITED[:8], folder, 2)
    interaction.count_failures(spark, folder, labels, folder=state)
    as_table(spark, AUDITED[8:], folder, 2)
    for _ in range(2):  # the second call finds no new file
        counters = interaction.count_failures(spark, folder, labels, folder=state)
        assert audited(interaction.orders(counters)) == audit_by_brute_force(AUDITED, MARKED)


def test_audit_of_nothing(spark):
    assert interaction.audit_rows(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)).collect() == []


def test_audit_of_rows(spark):
    docs = spark.createDataFrame([(i, t, "en", s, 0, "x", 7, 3) for i, t, s in AUDITED], SCHEMA)
    assert audited(interaction.audit_rows(docs, spark.createDataFrame(MARKED, LABELS))) == audit_by_brute_force(AUDITED, MARKED)


# url templates


def judged(spark, rows, labelled=(), **how):
    pages = spark.createDataFrame([(k, u, "h", "p", "s", 1, True) for k, u in rows], PAGES)
    got = urls.judge(pages, spark.createDataFrame(list(labelled), "url string, good boolean") if labelled else None, **how).collect()
    assert sorted(str(r.page_id) for r in got) == sorted(str(k) for k, _ in rows)
    return {r.page_id: r for r in got}


def test_hosts_paths_and_rules(spark):
    rows = {
        1: ("HTTP://A.Example.NET/en/5?q#f", "a.example.net", "/en/5", "example.net/en/", "allow"),
        2: ("http://example.net/de/", "example.net", "/de/", "net/", "block"),
        3: ("http://net", "net", "", None, "allow"),
        4: ("x://xnet/", "xnet", "/", None, "allow"),
        5: ("http://b.example.com/de/1#x", "b.example.com", "/de/1", "example.com/de/", "block"),
        6: ("http://ÄB.org/fr/a://b/c", "Äb.org", "/fr/a://b/c", "org/fr/", "allow"),
        7: ("http://b.org?x=/fr/", "b.org", "", None, "allow"),
        8: ("b.org/fr/", "", "", None, "allow"),
        9: (None, "", "", None, "allow"),
        None: ("", "", "", None, "allow"),
    }
    got = judged(spark, [(k, v[0]) for k, v in rows.items()])
    assert {k: (r.host, r.path, r.rule, r.verdict) for k, r in got.items()} == {k: v[1:] for k, v in rows.items()}


def test_variable_segments_are_wildcards(spark):
    rows = [(k, f"http://h.x/user/name{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyzabcd'[k // 100]}/photo-{k}.jpg") for k in range(500)]
    rows += [(1000 + k, f"http://h.x/about/team{k % 2}") for k in range(200)] + [(2000, "http://h.x/"), (2001, "http://h.x"), (2002, "http://one.x/a/b/c")]
    got = judged(spark, rows)
    assert {got[k].template for k in range(500)} == {"/{about|user}/*/photo-#.jpg"}
    assert {got[1000 + k].template for k in range(200)} == {"/{about|user}/team#"}
    assert (got[2000].template, got[2001].template, got[2002].template) == ("/*", "", "/*/*/*")


def test_like_branches_merge_and_foul_ones_are_rejected(spark):
    parts = ("news", "sport", "culture", "casino", "pills")
    rows = [(10000 * i + k, f"http://h.x/{p}/{k}") for i, p in enumerate(parts) for k in range(200)]
    labelled = [(f"http://h.x/{p}/{k}", (k % 10 != 0) if i < 3 else k % 10 == 0) for i, p in enumerate(parts) for k in range(60)]
    got = judged(spark, rows, labelled)
    assert {r.template for k, r in got.items() if k < 30000} == {"/{culture|news|sport}/#"} and {r.verdict for k, r in got.items() if k < 30000} == {"allow"}
    assert {r.template for k, r in got.items() if k >= 30000} == {"/{casino|pills}/#"} and {r.verdict for k, r in got.items() if k >= 30000} == {"block"}


def test_deep_long_and_empty(spark):
    deep = "http://h.x" + "/a" * 3000
    rows = [(k, deep + f"/{k}") for k in range(5)] + [(7, "http://h.x/" + "b" * 100000), (8, "http://h.x//")]
    got = judged(spark, rows, [(deep, None)])
    assert {got[k].template for k in range(5)} == {"/a" * urls.LEVELS + "/**"} and got[7].template == "/*" and got[8].template == "/*/*"
    assert judged(spark, []) == {}
