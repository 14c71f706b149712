"""Streams that are killed and restarted, late rows, skipped requests, fold tables, generators, forest samples."""

import datetime
import math
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import Observation
from pyspark.sql import functions as F

from riskline.operators import anomaly as an
from riskline.operators import copula as cp
from riskline.operators import drift as dr
from riskline.operators import generators as gn
from riskline.operators import models as md
from riskline.operators import neighbors as nb
from riskline.operators.neighbors import knn
from riskline.operators.scoring import FAULTS, sound_requests
from riskline.operators.split import balanced_weights
from riskline.streaming import monitor as mo
from riskline.streaming import streams as st

T0 = datetime.datetime(2024, 1, 1)

# the monitor

FEATURES = ["Amount"]


def scored_rows(n=900, seed=0):
    rng = np.random.default_rng(seed)
    return [(k, 1 + k % 3, int(rng.random() < 0.3), int(rng.random() < 0.3), float(np.round(rng.normal() + (k % 3), 2))) for k in range(n)]


SCORED = "event_id long, period int, y_true int, y_pred int, Amount double"


def write_file(spark, rows, folder, schema=SCORED):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def monitored(spark, source, baseline, folder):
    stream = spark.readStream.schema(SCORED).option("maxFilesPerTrigger", 1).parquet(source)
    status, alerts = mo.run_monitor(stream, baseline, folder, FEATURES)
    return sorted(map(tuple, status.collect())), sorted(map(str, alerts.collect()))


@pytest.fixture()
def monitor_case(spark, tmp_path):
    rows = scored_rows()
    source, baseline = f"file://{tmp_path}/in", spark.createDataFrame([(float(x),) for x in np.round(np.random.default_rng(9).normal(size=200), 2)], "Amount double")
    for k in range(4):
        write_file(spark, rows[k::4], source)
    frame = spark.createDataFrame(rows, SCORED).unionByName(baseline.withColumn("period", F.lit(0)), allowMissingColumns=True)
    table = dr.monitoring_table(frame, FEATURES).join(frame.groupBy("period").agg(F.count("*").alias("n")), "period")
    want = sorted(map(tuple, table.select(*mo._names(mo._STATUS)).collect()))
    return source, baseline, want, f"file://{tmp_path}/sink"


def rounded(rows):
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows]


def test_monitor_equals_the_batch_result(spark, monitor_case):
    source, baseline, want, folder = monitor_case
    status, alerts = monitored(spark, source, baseline, folder)
    assert [r[0] for r in status] == [1, 2, 3]
    columns = mo._read(spark, folder, "status").drop("batch").columns
    assert columns == mo._names(mo._STATUS)
    assert rounded(status) == rounded(want) and alerts


def test_monitor_killed_and_started_again(spark, monitor_case, tmp_path):
    """A batch that ran but wasn't committed runs again and leaves the same tables; a run of a folder
    without new files changes nothing; new files go on from the state."""
    source, baseline, want, folder = monitor_case
    once = monitored(spark, source, baseline, folder)
    tables = {n: sorted(map(str, mo._read(spark, folder, n).collect())) for n in mo._TABLES}
    commits = sorted((tmp_path / "sink" / "offsets" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    assert len(commits) == 4
    commits[-1].unlink()  # as if the driver was killed after the sink had written, before the commit
    (tmp_path / "sink" / "offsets" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert monitored(spark, source, baseline, folder) == once
    assert monitored(spark, source, baseline, folder) == once
    assert {n: sorted(map(str, mo._read(spark, folder, n).collect())) for n in mo._TABLES} == tables
    write_file(spark, [(5000 + k, 4, 1, 1, 0.5) for k in range(10)], source)
    status, _ = monitored(spark, source, baseline.limit(1), folder)  # the baseline of the first run holds
    assert rounded(status[:3]) == rounded(want) and status[3][:2] == (4, 10)


def test_monitor_of_no_files(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    baseline = spark.createDataFrame([(1.0,)], "Amount double")
    assert monitored(spark, f"file://{tmp_path}/in", baseline, f"file://{tmp_path}/sink") == ([], [])


# late rows


def test_late_rows_are_counted(spark, tmp_path):
    """Files in random order of time: what the windows hold and what is counted as late are all rows."""
    rng = np.random.default_rng(4)
    hours = rng.permutation(np.repeat(np.arange(12), 50))
    source = f"file://{tmp_path}/in"
    for k in range(6):
        rows = [(int(i), T0 + datetime.timedelta(hours=int(h), minutes=int(i % 60)), 1.0, "ok") for i, h in enumerate(hours[k * 100 : (k + 1) * 100], k * 100)]
        write_file(spark, rows, source, "event_id long, ts timestamp, value double, event_type string")
    stream = spark.readStream.schema("event_id long, ts timestamp, value double, event_type string").option("maxFilesPerTrigger", 1).parquet(source)
    result, late = st.run_counted(stream, lambda e: st.ingestion_windows(e, watermark="1 hour"), "late", ["window_start"], "volume", f"file://{tmp_path}/run")
    kept, missed = result.agg(F.sum("volume")).first()[0], late.agg(F.sum("late_rows")).first()[0]
    assert kept + missed == 600 and missed > 100
    assert late.where("input_rows <> kept_rows + late_rows").count() == 0
    assert [r.late_rows for r in late.where("batch_id < 2").orderBy("batch_id").collect()] == [0, 0]


def test_rows_in_time_order_are_never_late(spark, tmp_path):
    source = f"file://{tmp_path}/in"
    for k in range(3):
        write_file(spark, [(k * 10 + i, T0 + datetime.timedelta(hours=k, minutes=i), 1.0, "error") for i in range(10)], source, "event_id long, ts timestamp, value double, event_type string")
    stream = spark.readStream.schema("event_id long, ts timestamp, value double, event_type string").option("maxFilesPerTrigger", 1).parquet(source)
    _, late = st.run_counted(stream, lambda e: st.ingestion_windows(e), "intime", ["window_start"], "volume")
    assert late.agg(F.sum("late_rows"), F.sum("input_rows")).first()[:] == (0, 30)


# requests


def test_faulty_requests_are_skipped_and_counted(spark):
    nan, whole = float("nan"), [float(i) for i in range(30)]
    rows = [("ok", whole), ("short", whole[:29]), ("long", whole + [1.0]), ("empty", []), ("none", None), ("nulls", [None] * 30), ("one_null", whole[:29] + [None]), ("nans", [nan] * 30),
            ("one_nan", [nan] + whole[1:]), ("both", [None, nan] + whole[2:])]
    seen = Observation("r")
    out = sound_requests(spark.newSession().createDataFrame(rows, "transaction_id string, features array<double>"), seen)
    assert [r.transaction_id for r in out.collect()] == ["ok"]
    assert seen.get == {"requests": 10, "scored": 1, "missing": 1, "wrong_length": 3, "null_element": 3, "nan_element": 2}
    assert set(FAULTS) < set(seen.get)


# models


def training_rows(spark, n=240):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(n):
        y = int(k % 6 == 0)
        rows.append((k, float(rng.normal() + 2 * y), float(rng.normal() - y), float(rng.normal()), y))
    return spark.createDataFrame(rows, "event_id long, a double, b double, c double, Class int")


def test_fold_table_against_scikit_rules(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.tuning import ParamGridBuilder

    df = training_rows(spark)
    lr = LogisticRegression(labelCol="Class", weightCol="weight", maxIter=50)
    broken = LogisticRegression(labelCol="no_such_column", maxIter=5)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.001, 10.0]).build()
    table = md.cross_validate(df, ["a", "b", "c"], {"lr": (lr, grid), "broken": (broken, [{}])}, k=4)
    rows = table.collect()
    assert len(rows) == 3 * 4 and {r.status for r in rows if r.model == "lr"} == {"success"}
    assert all(r.status == "failed" and r.error and r.f1 is None for r in rows if r.model == "broken")
    for r in rows:
        if r.model == "lr":
            assert r.precision + r.recall == 0 or math.isclose(r.f1, 2 * r.precision * r.recall / (r.precision + r.recall))
            assert 0.5 < r.roc_auc <= 1
    summary = {(r.model, r.point): r for r in md.cv_summary(table).collect()}
    for p in (0, 1):
        for c in md.SCORES:
            own = [r[c] for r in rows if r.model == "lr" and r.point == p]
            assert math.isclose(summary["lr", p][f"mean_{c}"], np.mean(own)) and math.isclose(summary["lr", p][f"std_{c}"], np.std(own), abs_tol=1e-12)
    assert summary["lr", 0].is_best == (summary["lr", 0].mean_f1 >= summary["lr", 1].mean_f1) and summary["lr", 0].is_best != summary["lr", 1].is_best
    assert not summary["broken", 0].is_best and summary["broken", 0].failed_folds == 4
    ranked = md.model_comparison(md.cv_summary(table), spark.createDataFrame([("lr", 0.9, 0.8, 0.7, 0.6)], "model string, roc_auc double, f1 double, recall double, precision double")).collect()
    assert [(r.model, r.rank, r.test_f1) for r in ranked] == [("lr", 1, 0.8)] and "regParam" in ranked[0].params


def test_grids_are_the_references_points(spark):
    est = md.estimators(100)
    grids = md.param_grids(est, 100)
    assert {k: len(g) for k, g in grids.items()} == {"logistic_regression": 8, "random_forest": 27, "gradient_boosting": 54, "neural_network": 12}
    layers = {tuple(v) for g in grids["neural_network"] for p, v in g.items() if p.name == "layers"}
    assert layers == {(37, 50, 2), (37, 100, 2), (37, 100, 50, 2), (37, 150, 100, 50, 2)}
    assert est["logistic_regression"].getMaxIter() == 1000 and est["random_forest"].getNumTrees() == 100 and est["gradient_boosting"].getMaxIter() == 100


def test_enabled_models_and_status(spark):
    df = training_rows(spark)
    fitted = md.train_all(df, ["a", "b", "c"], enabled={"random_forest": False, "gradient_boosting": False, "neural_network": False})
    assert list(fitted) == ["logistic_regression"] and isinstance(fitted["logistic_regression"][0], PipelineModel)
    one_class = md.train_all(df.withColumn("Class", F.lit(None).cast("int")), ["a", "b", "c"], names=["logistic_regression"])
    assert {r.model: r.status for r in md.training_status(one_class, spark).collect()} == {"logistic_regression": "failed"}


# generators


def generator_rows(spark, n=600):
    rng = np.random.default_rng(6)
    rows = []
    for k in range(n):
        y = int(k % 20 == 0)
        a = float(np.exp(rng.normal() * 0.5 + y))
        b = 3 * a + float(rng.normal() * 0.3)
        rows.append((k, a, b, float(rng.integers(0, 5)), y))
    return spark.createDataFrame(rows, "event_id long, a double, b double, c double, Class int")


G = ["a", "b", "c"]


def test_copula_keeps_marginals_and_rank_correlation(spark):
    """Values stay in range, quantiles are close, and Spearman correlations are within 0.1."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(1500):
        x = rng.normal()
        rows.append((k, float(np.exp(x)), float(-x + 0.5 * rng.normal()), float(rng.exponential()), 1))
    df = spark.createDataFrame(rows, "event_id long, a double, b double, c double, Class int")
    syn = cp.gaussian_copula(df, G, num_samples=3000).toPandas()
    real = df.toPandas()
    assert len(syn) == 3000 and (syn.Class == 1).all()
    for c in G:
        assert real[c].min() <= syn[c].min() and syn[c].max() <= real[c].max()
        for q in (0.1, 0.5, 0.9):
            assert abs((real[c] <= syn[c].quantile(q)).mean() - q) < 0.04
    assert (np.abs(real[G].corr("spearman") - syn[G].corr("spearman")).values < 0.1).all()
    assert cp.gaussian_copula(df.limit(9), G) is None


def test_generators_are_enabled_dispatched_and_reported(spark):
    df = generator_rows(spark)
    config = {"smote": {"enabled": True, "params": {"ratio": 0.2}}, "borderline_smote": {"enabled": False}, "svm_smote": {}, "simple_oversampling": {"enabled": True, "params": {"wrong": 1}},
              "gaussian_copula": {"enabled": True, "params": {"num_samples": 100}}, "unheard_of": {"enabled": True}}
    got = gn.generate_all(df, G, config=config)
    assert {g.method: g.status for g in got} == {"smote": "success", "simple_oversampling": "failed", "gaussian_copula": "success", "unheard_of": "failed"}
    rows = {r.method: r for r in gn.evaluate(df, got, G, trees=10).collect()}
    assert rows["smote"].synthetic_rows == int(0.2 * 570) - 30 and rows["gaussian_copula"].synthetic_rows == 100
    assert sorted(r.rank for r in rows.values()) == [1, 2, 3, 4] and rows["unheard_of"].quality is None and "unknown" in rows["unheard_of"].error
    assert gn.best_method(gn.evaluate(df, got, G, trees=10)) in ("smote", "gaussian_copula")
    with pytest.raises(ValueError):
        gn.best_method(gn.evaluate(df, [], G))


@pytest.mark.parametrize("method, minority", [("smote", 114), ("borderline_smote", 114), ("simple_oversampling", 114), ("gaussian_copula", 2000), ("unheard_of", 30)])
def test_balanced_dataset(spark, method, minority):
    df = generator_rows(spark)
    rows, got = gn.create_balanced_dataset(df, G, method, 0.2)
    counts = {r.Class: r["count"] for r in rows.groupBy("Class").count().collect()}
    if got.status == "none":  # no row in danger
        minority = 30
    assert counts == {0: 570, 1: minority} and rows.columns == [*G, "Class"]


# neighbours and forest samples


@pytest.mark.parametrize("chunk, block", [(8192, 8192), (40, 16)])
def test_knn_over_chunks_and_blocks(spark, chunk, block):
    """A grid full of ties, a third of the points on one vector, against brute force."""
    rng = np.random.default_rng(7)
    x = rng.integers(0, 12, (500, 3)).astype(float)
    x[::3] = 4.0
    ids = [int(i) for i in rng.permutation(2000)[:500]]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in zip(ids, x)] + [(5000, [1.0, None, 2.0]), (5001, [float("nan")] * 3)], "id long, vec array<double>").repartition(4)
    got = {}
    for r in knn(df, df, 4, chunk=chunk, block=block).collect():
        got.setdefault(r.qid, []).append((r.rank, r.pid, r.dist))
    assert set(got) == set(ids)
    for i, row in zip(ids, x):
        d = np.sqrt(((row[0] - x[:, 0]) ** 2 + (row[1] - x[:, 1]) ** 2) + (row[2] - x[:, 2]) ** 2)
        best = sorted((float(d[j]), ids[j]) for j in range(500) if ids[j] != i)[:4]
        assert sorted(got[i]) == [(k + 1, j, dist) for k, (dist, j) in enumerate(best)]


@pytest.mark.parametrize("n", [40, 3000])
def test_forest_samples_are_the_smallest_draws(spark, n):
    from riskline.functions.rng import lcg_uniform_np

    df = spark.range(n).withColumnRenamed("id", "k")
    got = {}
    for r in an.tree_samples(df, "k", n, n_trees=5, sample_size=64).collect():
        got.setdefault(r.tree, set()).add(r.k)
    keys = np.arange(n)
    for tree in range(5):
        u = lcg_uniform_np(keys, tree + 1000, 42)
        assert got[tree] == set(keys[np.argsort(u, kind="stable")[: min(64, n)]].tolist())




def test_class_weights_leave_rows_in_their_tasks(spark):
    """Rows dealt by label put a common label's rows into one task (nine in ten here)."""
    df = spark.range(0, 4000, 1, 8).selectExpr("id AS event_id", "CAST(id % 10 = 0 AS INT) AS Class", "CAST(id AS DOUBLE) AS a")
    out = balanced_weights(df)
    assert "Exchange hashpartitioning(Class" not in out._jdf.queryExecution().toString()
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 500
    assert {(r["Class"], round(r["weight"], 9)) for r in out.select("Class", "weight").distinct().collect()} == {(0, round(1 / 1.8, 9)), (1, 5.0)}


def test_class_weights_of_null_and_many_labels(spark, monkeypatch):
    df = spark.createDataFrame([(i, None if i < 2 else i % 4) for i in range(12)], "event_id long, Class int")
    few = sorted(map(tuple, balanced_weights(df).collect()))
    monkeypatch.setattr("riskline.operators.split.MAX_LABELS", 2)
    assert sorted(map(tuple, balanced_weights(df).collect())) == few and len(few) == 10


def test_dealt_queries_come_in_bounded_batches(monkeypatch):
    """A query that visits many chunks was repeated for all of them, for a whole batch, at once."""
    monkeypatch.setattr(nb, "SENT", 100)
    rng = np.random.default_rng(1)
    cells = nb._Cells(rng.normal(size=(4, 3)), [[1.0, 2.0]] * 4, [[5, 5, 5]] * 4)
    vecs = rng.normal(size=(200, 3))
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array(vecs.tolist()), pa.array([math.inf] * 200)], names=["id", "vec", "r"])
    got = list(nb._dealt_queries(cells, False)(iter([batch])))
    assert max(b.num_rows for b in got) <= 100 + 60 and sum(b.num_rows for b in got) == 200 * 55
    assert len(set(zip(*[x for b in [pa.Table.from_batches(got)] for x in (b["key"].to_pylist(), b["qid"].to_pylist())]))) == 200 * 55


@pytest.mark.parametrize("shift, odd", [(0.0, None), (1e9, None), (0.0, math.inf)])
def test_nearest_of_a_chunk_equals_all_distances(shift, odd):
    """Also far from zero, where products lose digits, with ties, repeated ids and infinite coordinates."""
    rng = np.random.default_rng(2)
    p = np.round(rng.normal(size=(300, 4)), 1) + shift
    if odd is not None:
        p[7, 2] = odd
    pid = rng.permutation(300)
    pid[5] = pid[6]
    q, qid, reach = p[:80], pid[:80], np.where(rng.random(80) < 0.5, 0.7, math.inf)
    d = nb._distances(q, p)
    for bounded in (False, True):
        want = []
        for i in range(80):
            near = sorted((d[i, j], pid[j]) for j in range(300) if pid[j] != qid[i] and np.isfinite(d[i, j]) and (not bounded or d[i, j] <= reach[i]))
            want += [(qid[i], j, x) for x, j in near[:6]]
        left = pa.table([pa.array(qid), pa.array(q.tolist()), pa.array(reach)], names=["qid", "qvec", "r"])
        got = nb._nearest(6, bounded)(left, pa.table([pa.array(pid), pa.array(p.tolist())], names=["pid", "pvec"]))
        assert sorted(zip(*[got.column(c).to_pylist() for c in ("qid", "pid", "dist")])) == sorted(want)
