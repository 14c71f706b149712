"""Hand-computed unit cases (FIXTURES.md inline rows) and brute-force checks of the
distributed ordered / neighbour operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskline.functions import features as fx
from riskline.functions.stats import kolmogorov_sf
from riskline.operators import drift as dr
from riskline.operators import metrics as mt
from riskline.operators import scale as sc
from riskline.operators import validate as val
from riskline.operators.neighbors import knn
from riskline.operators.ordered import exact_quantiles, row_numbers, running_totals


def _col(spark, values, name="x", dtype="double"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")


def test_amount_bins(spark):
    df = _col(spark, [0.0, 5.0, 10.0, 10.1, 50.0, 200.0, 1000.0, 1001.0], "Amount")
    rows = df.select(fx.amount_category("Amount", "five_bin").alias("a"), fx.amount_category("Amount", "notebook").alias("b")).collect()
    assert [r.a for r in rows] == [-1, 0, 0, 1, 1, 2, 3, 4]
    assert [r.b for r in rows] == [0, 0, 0, 1, 1, 2, 3, 3]


def test_standard_scaling_population_std(spark):
    df = _col(spark, [1.0, 2.0, 3.0, 10.0])
    out = [r.x for r in sc.fit_standard(df, ["x"]).transform(df).collect()]
    assert out == pytest.approx([-0.848528, -0.565685, -0.282843, 1.697056], abs=1e-6)


def test_robust_scaling_exact_quartiles(spark):
    df = _col(spark, [1.0, 2.0, 3.0, 10.0])
    m = sc.fit_robust(df, ["x"])
    assert m.params["x"] == pytest.approx((2.5, 3.0))
    out = [r.x for r in m.transform(df).collect()]
    assert out == pytest.approx([-0.5, -0.166667, 0.166667, 2.5], abs=1e-6)


def test_minmax_constant_column_is_zero(spark):
    df = _col(spark, [7.0, 7.0, 7.0, 7.0])
    assert [r.x for r in sc.fit_minmax(df, ["x"]).transform(df).collect()] == [0.0] * 4


def test_class_balance(spark):
    df = _col(spark, [0, 0, 0, 0, 1, 1], "Class", "int")
    r = val.imbalance_summary(df).first()
    assert r.imbalance_ratio == 2.0 and r.minority_class == 1 and r.majority_class == 0


def test_quality_min_rows_fails_first(spark):
    df = spark.createDataFrame([(1.0, 10.0, 0), (2.0, None, 1), (3.0, 30.0, 0), (4.0, 40.0, 1), (5.0, 50.0, 0)],
                               "Time double, Amount double, Class int")
    r = val.dataset_quality(df, ["Time", "Amount", "Class"]).first()
    assert not r.is_valid and r.message == "Trop peu de lignes: 5 < 1000" and r.missing_percentage == 0.0


def test_quality_missing_percentage(spark):
    df = spark.createDataFrame([(1.0, None, 0), (2.0, 2.0, 1)], "Time double, Amount double, Class int")
    r = val.dataset_quality(df, ["Time", "Amount", "Class"], min_rows=1).first()
    assert not r.is_valid and r.missing_percentage == pytest.approx(100 / 6)
    assert r.message.startswith("Trop de valeurs manquantes: 16.67% > 5.0%")


def test_confusion_rates(spark):
    conf = spark.createDataFrame([(111, 10, 37, 85285, 85443)], "tp long, fp long, fn long, tn long, n long")
    r = mt.rates(conf).first()
    assert (round(r.precision, 3), round(r.recall, 3), round(r.f1, 3)) == (0.917, 0.750, 0.825)


def test_alert_limits(spark):
    mon = spark.createDataFrame(
        [(1, 0.70, 0.01, 0.3), (2, 0.79, 0.015, 0.4), (3, 0.80, 0.021, 0.51)],
        "period int, detection_rate double, false_positive_rate double, data_drift_score double")
    got = {(r.period, r.metric): r.type for r in dr.alerts(mon).collect()}
    assert got == {
        (1, "detection_rate"): "ATTENTION", (2, "detection_rate"): "ATTENTION",
        (2, "false_positive_rate"): "ATTENTION", (3, "false_positive_rate"): "CRITIQUE",
        (2, "data_drift_score"): "ATTENTION", (3, "data_drift_score"): "CRITIQUE",
    }


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.lognormal(2, 1, 3001), 2)
    g = rng.integers(0, 3, len(vals))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, vals)], "g int, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.995, 1.0]
    out = {r.g: r for r in exact_quantiles(df, "x", probs, group=["g"], names=[f"p{i}" for i in range(len(probs))], n_buckets=7).collect()}
    for k in range(3):
        exp = np.quantile(vals[g == k], probs)
        assert [out[k][f"p{i}"] for i in range(len(probs))] == pytest.approx(list(exp), abs=1e-9)


def test_row_numbers_match_sort(spark):
    rng = np.random.default_rng(2)
    keys = rng.permutation(5000)
    df = spark.createDataFrame([(int(k), int(k % 2)) for k in keys], "k long, c int")
    got = {r.k: r.rn for r in row_numbers(df, ["k"], group=["c"], n_buckets=9).collect()}
    for c in (0, 1):
        ks = sorted(k for k in keys if k % 2 == c)
        assert all(got[k] == i + 1 for i, k in enumerate(ks))


def test_running_totals_descending(spark):
    df = spark.createDataFrame([(s, y) for s, y in [(0.1, 0), (0.9, 1), (0.5, 1), (0.5, 0), (0.9, 0)]], "s double, y int")
    rt = {r.s: (r.cum_p, r.tot_p) for r in running_totals(df, "s", {"p": F.col("y")}, descending=True, n_buckets=3).collect()}
    assert rt == {0.9: (1, 2), 0.5: (2, 2), 0.1: (2, 2)}


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    pts = np.round(rng.normal(size=(300, 4)) * np.array([50, 1, 1, 1]), 3)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(pts)], "id long, vec array<double>")
    got = {(r.qid, r.rank): r.pid for r in knn(df, df, 5).collect()}
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    for i in range(len(pts)):
        order = sorted((d[i, j], j) for j in range(len(pts)) if j != i)[:5]
        assert [got[(i, r + 1)] for r in range(5)] == [j for _, j in order]


def test_ks_statistic_matches_numpy(spark):
    rng = np.random.default_rng(4)
    a, b = np.round(rng.normal(0, 1, 400), 2), np.round(rng.normal(0.3, 1, 600), 2)
    base = spark.createDataFrame([(float(x),) for x in a], "v double")
    cur = spark.createDataFrame([(float(x),) for x in b], "v double")
    r = dr.ks_two_sample(base, cur, ["v"]).first()
    grid = np.union1d(a, b)
    exp = np.max(np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a) - np.searchsorted(np.sort(b), grid, "right") / len(b)))
    assert r.ks_stat == pytest.approx(exp, abs=1e-12)


def test_kolmogorov_sf_known_values(spark):
    df = _col(spark, [0.5, 1.0, 1.36, 2.0], "lam")
    got = [r.q for r in df.select(kolmogorov_sf(F.col("lam")).alias("q")).collect()]
    assert got == pytest.approx([0.963945, 0.269999, 0.049486, 0.000671], abs=1e-5)


def test_day_zscore_single_row_day_is_zero(spark):
    from riskline.operators.featurize import add_daily_zscore

    df = spark.createDataFrame([(0, 5.0), (1, 1.0), (1, 3.0)], "Day int, Amount double")
    z = {(r.Day, r.Amount): r.Amount_Daily_Zscore for r in add_daily_zscore(df).collect()}
    assert z[(0, 5.0)] == 0.0
    assert z[(1, 1.0)] == pytest.approx(-1 / math.sqrt(2), rel=1e-6)


def test_knn_with_hot_duplicate_group(spark):
    rng = np.random.default_rng(5)
    pts = np.round(rng.normal(size=(120, 3)) * np.array([20, 1, 1]), 2)
    pts[:60] = pts[0]  # half of the rows share one vector
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(pts)], "id long, vec array<double>")
    got = {(r.qid, r.rank): r.pid for r in knn(df, df, 5).collect()}
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    for i in range(len(pts)):
        order = sorted((d[i, j], j) for j in range(len(pts)) if j != i)[:5]
        assert [got[(i, r + 1)] for r in range(5)] == [j for _, j in order]


def test_knn_answers_only_the_asked_points(spark):
    """A few queries, one an outlier far from all others, against brute force; and fewer than k points."""
    rows = [(i, [float((i * 37) % 101) + (i % 7) * 0.1, float((i * 53) % 89)]) for i in range(300)]
    rows += [(300, [1e6, 5.0]), (301, [50.0, 44.0]), (302, [50.0, 44.0])]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>")
    asked = [0, 17, 300, 301]
    got = {(r.qid, r.rank): r.pid for r in knn(df.where(F.col("id").isin(asked)).select("id"), df, 5).collect()}
    for q in asked:
        v = dict(rows)[q]
        best = sorted((math.dist(v, w), i) for i, w in rows if i != q)[:5]
        assert [got[(q, k + 1)] for k in range(5)] == [i for _, i in best]
    assert len(got) == 5 * len(asked)
    assert knn(df.limit(3), df.limit(3), 5).count() == 6


def test_check_report_survives_bad_input(spark):
    from riskline.operators import validate as val

    base = [(float(i), 10.0, 0.0 if i % 2 else 1.0) for i in range(20)]
    kw = {"required_columns": ["Time", "Amount", "Class"], "min_rows": 10}

    def report(rows, schema):
        return val.pipeline_check_report(spark.createDataFrame(rows, schema), **kw).first()

    full = "Time double, Amount double, Class double"
    assert report(base, full)["status"] == "success"
    r = report([(t, c) for t, _, c in base], "Time double, Class double")
    assert r["status"] == "failed" and "Amount" in r["message"] and not r["amount_range_valid"]
    r = report([*base, (1.0, 1.0, 0.5), (2.0, 1.0, 0.25)], full)
    assert r["status"] == "failed" and not r["class_values_valid"]
    assert r["class_distribution"] == '{"0":10,"1":10,"other":2}'
    r = report([(str(t), "x", "y") for t, _, _ in base], "Time string, Amount string, Class string")
    assert r["status"] == "failed" and not r["class_values_valid"]
    assert report([], full)["status"] == "failed"
    assert report([(t, a) for t, a, _ in base], "Time double, Amount double")["status"] == "failed"
