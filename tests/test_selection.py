"""Order statistics by histogram selection, the split that compares keys, running totals on skew."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskline.operators import selection as sel
from riskline.operators.ordered import _B, _cut_points, _with_bucket, row_numbers, running_totals
from riskline.operators.split import stratified_folds, stratified_split

PROBS = [0, 0.1, 0.25, 0.5, 0.77, 1]


def hard(n=4000):
    """A value of a third of the rows, both signs, 18 decades, NaN, extremes, a null group."""
    rng = np.random.default_rng(0)
    x = np.exp(rng.normal(size=n) * 9) * rng.choice([-1, 1], n)
    x[::3], x[1::50] = 3.0, np.nan
    x[[11, 13, 16, 17]] = 1.7e308, -1.7e308, 5e-324, 0.0
    return pd.DataFrame({"g": rng.choice(["a", "b", None], n, p=[0.6, 0.3, 0.1]), "x": x, "k": np.arange(n)[::-1]})


def own(pdf, g):
    return pdf[pdf.g == g if g is not None else pdf.g.isna()].dropna(subset=["x"])


def interpolated(values, p):
    v, h = np.sort(values), (len(values) - 1) * p
    return v[math.floor(h)] + (h - math.floor(h)) * (v[math.ceil(h)] - v[math.floor(h)])


def test_quantiles_by_group(spark):
    pdf = hard()
    got = sel.quantiles(spark.createDataFrame(pdf), "x", PROBS, ["g"])
    assert set(got) == {("a",), ("b",), (None,)}
    for (g,), v in got.items():
        assert v == [interpolated(own(pdf, g).x.values, p) for p in PROBS]


def test_quantiles_without_group_and_of_columns(spark):
    pdf = hard().dropna()
    df = spark.createDataFrame(pdf)
    assert sel.quantiles(df, "x", PROBS)[()] == [interpolated(pdf.x.values, p) for p in PROBS]
    got = sel.column_quantiles(df, ["x", "k"], [0.5])
    assert got == {"x": [interpolated(pdf.x.values, 0.5)], "k": [interpolated(pdf.k.values, 0.5)]}


@pytest.mark.parametrize("ddl, values", [
    ("x long", [2**62, -(2**62), 2**62 + 1, 5, 2**62 - 3, 5]), ("x boolean", [True, False, True]), ("x int", [7]),
    ("x date", ["2024-02-01", "1960-01-01", "2024-01-31"]), ("x timestamp", ["2024-02-01 00:00:00.000001", "2024-02-01 00:00:00", "1960-01-01 00:00:00"]),
])
def test_ranks_of_every_type(spark, ddl, values):
    df = spark.createDataFrame([(v,) for v in values], ddl.replace("date", "string").replace("timestamp", "string")).selectExpr(f"cast(x as {ddl.split()[1]}) as x")
    ranks = {str(i): (lambda n, _, i=i: i) for i in range(len(values))}
    found = {int(f.rank): f for f in sel.select_ranks(df, "x", ranks)}
    back = sel._comparable(df, "x")[1]
    got = [spark.range(1).select(back(F.lit(found[i].value)).alias("v")).first()["v"] for i in range(len(values))]
    assert got == [r.x for r in df.orderBy("x").collect()]


def test_nothing_to_select(spark):
    empty = spark.createDataFrame([], "x double, g string")
    assert sel.quantiles(empty, "x", [0.5]) == {} and sel.quantiles(empty, "x", [0.5], ["g"]) == {}
    assert sel.quantiles(spark.createDataFrame([(None,), (float("nan"),)], "x double"), "x", [0.5]) == {}
    with pytest.raises(TypeError):
        sel.quantiles(spark.createDataFrame([("a",)], "x string"), "x", [0.5])


def test_too_many_groups_are_refused(spark, monkeypatch):
    monkeypatch.setattr(sel, "MAX_RANKS", 10)
    with pytest.raises(ValueError):
        sel.quantiles(spark.range(100).selectExpr("id as g", "double(id) as x"), "x", [0.5], ["g"])


def test_cut_keys_and_marks_with_ties(spark):
    pdf = hard()
    df = spark.createDataFrame(pdf)
    ranks = {"most": lambda n, _: n * 6 // 10, "tenth": lambda n, _: 10, "none": lambda n, _: -1}
    cuts = sel.cut_keys(df, "x", "k", ranks, ["g"])
    for g in ("a", "b", None):
        d = own(pdf, g).sort_values(["x", "k"]).reset_index()
        for name, i in (("most", len(d) * 6 // 10), ("tenth", 10)):
            value, tie = cuts[(g,), name]
            assert value == d.x[i] and (tie == d.k[i] if (d.x == value).sum() > 1 else tie is None)
    assert any(t is not None for _, t in cuts.values())
    marked = sel.mark_up_to(df, "x", "k", cuts, list(ranks), ["g"])
    counts = {r.g: (r.most, r.tenth, r.none) for r in marked.groupBy("g").agg(*[F.count_if(n).alias(n) for n in ranks]).collect()}
    assert counts == {g: (len(own(pdf, g)) * 6 // 10 + 1, 11, 0) for g in ("a", "b", None)}


def test_split_has_exact_sizes_on_skewed_and_null_labels(spark):
    rows = [(k, 0 if k % 3 else (1 if k % 2 else None), float(k)) for k in range(997)] + [(2000, 5, 1.0)]
    df = spark.createDataFrame(rows, "event_id long, Class int, x double").repartition(7)
    got = stratified_split(df).groupBy("Class", "split").count().collect()
    for label in (0, 1, None, 5):
        n = sum(r[1] == label for r in rows)
        test = math.floor(n * 0.2 + 0.5)
        val = math.floor((n - test) * 0.2 + 0.5)
        assert {r.split: r["count"] for r in got if r.Class == label} == {k: v for k, v in (("test", test), ("val", val), ("train", n - test - val)) if v}
    assert sorted(map(tuple, stratified_split(df).select("event_id", "split").collect())) == sorted(map(tuple, stratified_split(df.repartition(3)).select("event_id", "split").collect()))


def test_split_never_shuffles_rows(spark):
    df = spark.range(5000).selectExpr("id as event_id", "int(id % 10 = 0) as Class", "repeat('x', 50) as wide")
    assert "Exchange hash" not in stratified_split(df)._jdf.queryExecution().executedPlan().toString()


def test_folds_keep_wide_rows(spark):
    df = spark.range(103).selectExpr("id as event_id", "int(id % 4 = 0) as Class", "double(id) as x")
    got = stratified_folds(df, 5)
    assert got.count() == 103 and got.where("x <> event_id").count() == 0
    sizes = [r["count"] for r in got.groupBy("Class", "fold").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) < 20


def test_buckets_are_even_on_skew(spark):
    """Features on different scales, one with half its rows on a value: no bucket of a group over
    three times its even share, but for the one value."""
    rng = np.random.default_rng(1)
    rows = [("tiny", float(v)) for v in rng.random(4000) * 1e-6] + [("huge", float(v)) for v in np.exp(rng.normal(size=4000) * 3) * 1e6] + [("few", 1.0)] * 10
    df = spark.createDataFrame(rows, "g string, x double")
    cuts = _cut_points(df, "x", ["g"], 16)
    assert set(cuts) == {("tiny",), ("huge",)}
    sizes = {(r.g, r[_B]): r["count"] for r in _with_bucket(df, "x", cuts, ["g"], False).groupBy("g", _B).count().collect()}
    for g in ("tiny", "huge"):
        own_sizes = [n for (k, _), n in sizes.items() if k == g]
        assert len(own_sizes) >= 6 and max(own_sizes) <= 3 * 4000 / len(own_sizes)


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_by_group(spark, descending):
    pdf = hard(600).dropna()
    df = spark.createDataFrame(pdf)
    got = {(r.g, r.x): (r.n, r.cum_n, r.tot_n) for r in running_totals(df, "x", {"n": F.lit(1)}, ["g"], descending, n_buckets=7).collect()}
    for g, d in pdf.groupby("g"):
        n = d.groupby("x").size().sort_index(ascending=not descending)
        assert {(g, x): (c, cum, len(d)) for x, c, cum in zip(n.index, n, n.cumsum())} == {k: v for k, v in got.items() if k[0] == g}


def test_text_order_is_refused(spark):
    with pytest.raises(TypeError):
        row_numbers(spark.createDataFrame([("a",)], "x string"), "x")
