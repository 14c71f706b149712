"""Every query with an oracle must match DuckDB on the same parquet tables.

Runs at sf0.001 by default (RISKLINE_ORACLE_SF overrides); the checker runs sf0.01.
"""

import os

import pytest

from oracle import compare, duck

from riskline.plans.catalog import load
from riskline.plans.sql import INGESTION, TX, with_ctes

SF = os.environ.get("RISKLINE_TEST_SF", "/root/testdata/sf0.001")
REG = load()
WITH_SQL = sorted(q for q, v in REG.items() if v.sql)
ROWS_ONLY = sorted(q for q, v in REG.items() if not v.sql)
SCORES = ("roc_auc", "f1", "recall", "precision")
BASE = ["Time", *[f"V{i}" for i in range(1, 29)], "Amount"]


def rows(con, sql):
    return con.sql(sql).fetchall()[0][0]


def n_transactions(con):
    return rows(con, with_ctes(TX) + "SELECT count(*) FROM transactions")


def trained(got, con):
    assert list(got.sort_values("model").model) == ["gradient_boosting", "logistic_regression", "neural_network", "random_forest"]
    assert (got.status == "success").all() and got.is_best.sum() == 1 and got.loc[got.is_best, "f1"].iloc[0] == got.f1.max()
    assert got[list(SCORES)].notna().all().all() and ((got[list(SCORES)] >= 0) & (got[list(SCORES)] <= 1)).all().all()
    tested = got[["tp", "fp", "fn", "tn"]].sum(axis=1)
    assert tested.nunique() == 1 and abs(tested.iloc[0] - 0.3 * n_transactions(con)) <= 1


def searched(got, con):
    assert len(got) == 8 and got.params.nunique() == 8 and got.is_best.sum() == 1 and (got.failed_folds == 0).all()
    assert got.loc[got.is_best, "mean_f1"].iloc[0] == got.mean_f1.max()
    for c in SCORES:
        assert got[f"mean_{c}"].between(0, 1).all() and got[f"std_{c}"].between(0, 0.5).all()


def compared(got, con):
    got = got.sort_values("rank")
    assert list(got["rank"]) == [1, 2, 3, 4] and got.mean_f1.is_monotonic_decreasing and got.model.nunique() == 4


def important(got, con):
    assert len(got) == 10 and got.importance.is_monotonic_decreasing and 0 < got.importance.sum() <= 1 + 1e-9


def scored(got, con):
    want = rows(con, with_ctes(TX) + "SELECT count(*) FROM transactions WHERE event_id % 50 > 4")
    assert len(got) == want and got.transaction_id.is_unique and got.probability.between(0, 1).all()
    assert (got.is_fraud == (got.probability > 0.5)).all() and (got.confidence >= 0.5).all()


def synthetic(got, con):
    real = con.sql(with_ctes(TX) + "SELECT * FROM transactions WHERE Class = 1").df()
    if len(real) < 10:
        assert (got.Class == 1).sum() in (0, len(real))
        return
    new = got[got.Class == 1]
    assert len(new) == 2000 and (got.Class == 0).sum() == n_transactions(con) - len(real)
    for c in BASE:
        assert real[c].min() - 1e-9 <= new[c].min() and new[c].max() <= real[c].max() + 1e-9


def ranked(got, con):
    assert list(got.sort_values("method").method) == ["borderline_smote", "gaussian_copula", "simple_oversampling", "smote"] and sorted(got["rank"]) == [1, 2, 3, 4]
    best = got[got.quality.notna()].sort_values("rank")
    assert best.quality.is_monotonic_decreasing and best.quality.between(0, 1).all() and (got.status != "failed").all()


def forest(got, con):
    assert len(got) == rows(con, with_ctes(INGESTION) + "SELECT count(*) FROM ingestion") and got.anomaly_score.between(0, 1).all()
    assert abs(got.detected_anomaly.mean() - 0.1) < 0.02 and got[got.detected_anomaly].anomaly_score.min() >= got[~got.detected_anomaly].anomaly_score.max()


def evaluated(got, con):
    r = got.iloc[0]
    assert r.true_positives + r.false_positives == r.detected_total and abs(r.precision - r.true_positives / max(r.detected_total, 1)) < 1e-9


def stored(got, con):
    assert got.n.sum() == n_transactions(con) and set(got.y_pred) <= {0, 1} and (got.model == "logistic_regression").all()


def margin(got, con):
    if len(got):
        n_min, n_maj = con.sql(with_ctes(TX) + "SELECT count(CASE WHEN Class = 1 THEN 1 END), count(CASE WHEN Class = 0 THEN 1 END) FROM transactions").fetchall()[0]
        assert len(got) == int(0.1 * n_maj) - n_min and (got.Class == 1).all() and (got.base_id != got.nn_id).all()


#: Queries without an exact SQL form and what must hold of their rows.
PROPERTIES = {
    "m1_m4_train_and_compare": trained, "m7_m8_cross_validation": searched, "m8_cross_validated_models": compared, "t2_feature_importances": important, "s3_s4_artifact_roundtrip": stored,
    "m21_batch_scoring": scored, "x2_stream_scoring": scored, "b5_gaussian_copula": synthetic, "b6_b9_generators_ranked": ranked, "d9_isolation_forest": forest, "d11_forest_evaluation": evaluated,
    "b3_svm_smote": margin,
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("qid", WITH_SQL)
def test_query_matches_oracle(spark, con, qid):
    q = REG[qid]
    got = q.fn(spark, SF).toPandas()
    exp = con.sql(q.sql).df()
    ok, why = compare(got, exp)
    assert ok, why


def test_every_query_is_checked():
    assert set(ROWS_ONLY) == set(PROPERTIES)


@pytest.mark.parametrize("qid", ROWS_ONLY)
def test_rows_have_their_properties(spark, con, qid):
    PROPERTIES[qid](REG[qid].fn(spark, SF).toPandas(), con)


def test_entry_point(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
