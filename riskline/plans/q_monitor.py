"""Queries: metrics on predictions, drift, monitoring, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskline.functions.stats import kolmogorov_sf_sql
from riskline.operators import drift as dr
from riskline.operators import metrics as mt
from riskline.plans.registry import query
from riskline.plans.sql import FEAT, SCORED, TX, with_ctes
from riskline.sources import fixtures as fx


def R(c, n=6):
    return F.round(c, n).alias(c if isinstance(c, str) else None)


MON = """mon_in AS (
  SELECT event_id, Class AS y_true, ((event_id * 48271) % 1000) / 1000.0 * 0.5 + Class * 0.5 AS score,
    CAST(((event_id * 48271) % 1000) / 1000.0 * 0.5 + Class * 0.5 >= 0.7 AS INTEGER) AS y_pred,
    Amount, Hour, PCA_Magnitude, Is_Night, PCA_Extreme_Count, "Time"
  FROM feat)"""


def _preds_sql(t: float = 0.7) -> str:
    return f"""preds AS (
  SELECT 'lcg_blend' AS model, event_id, y_true, score, CAST(score >= {t} AS INTEGER) AS y_pred FROM mon_in
  UNION ALL SELECT 'amount_scaled', event_id, y_true, least(Amount / 300.0, 1.0), CAST(least(Amount / 300.0, 1.0) >= {t} AS INTEGER) FROM mon_in
  UNION ALL SELECT 'extreme_night', event_id, y_true, CAST(PCA_Extreme_Count > 0 AS DOUBLE) * 0.5 + Is_Night * 0.5,
    CAST(CAST(PCA_Extreme_Count > 0 AS DOUBLE) * 0.5 + Is_Night * 0.5 >= {t} AS INTEGER) FROM mon_in)"""


CONF_SQL = """count(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 END) AS tp, count(CASE WHEN y_true <> 1 AND y_pred = 1 THEN 1 END) AS fp,
  count(CASE WHEN y_true = 1 AND y_pred <> 1 THEN 1 END) AS fn, count(CASE WHEN y_true <> 1 AND y_pred <> 1 THEN 1 END) AS tn, count(*) AS n"""

RATES_SQL = """coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS recall,
  coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0.0) AS f1, coalesce(CAST(fp AS DOUBLE) / nullif(fp + tn, 0), 0.0) AS fp_rate"""

AUC_SQL = """sc AS (SELECT model, score, count(CASE WHEN y_true = 1 THEN 1 END) AS pos, count(CASE WHEN y_true <> 1 THEN 1 END) AS neg FROM preds GROUP BY 1, 2),
sc2 AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score) AS cum_neg, sum(pos) OVER (PARTITION BY model) AS tp_, sum(neg) OVER (PARTITION BY model) AS tn_ FROM sc),
auc AS (SELECT model, sum(pos * (cum_neg - neg + neg * 0.5)) / (max(tp_) * CAST(max(tn_) AS DOUBLE)) AS roc_auc FROM sc2 GROUP BY model)"""


@query("m10_confusion_matrix", with_ctes(TX, SCORED) + f"SELECT {CONF_SQL} FROM scored")
def m10_confusion_matrix(spark, sf):
    """Confusion counts of the deterministic scorer."""
    return mt.confusion(fx.scored(spark, sf))


@query(
    "m11_classification_rates",
    with_ctes(TX, SCORED, f"c AS (SELECT {CONF_SQL} FROM scored)")
    + "SELECT tp, fp, fn, tn, n, " + ", ".join(f"round({x}, 6) AS {x.split(' AS ')[1]}" for x in RATES_SQL.replace("\n  ", " ").split(", coalesce")
                                                 if False) + "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(fp_rate, 6) AS fp_rate FROM (SELECT *, "
    + RATES_SQL + " FROM c)",
)
def m11_classification_rates(spark, sf):
    """Precision, recall, F1, FP rate (zero denominators -> 0)."""
    r = mt.classification_metrics(fx.scored(spark, sf))
    return r.select("tp", "fp", "fn", "tn", "n", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "fp_rate")])


@query(
    "m12_roc_auc",
    with_ctes(TX, FEAT, MON, _preds_sql(), AUC_SQL) + "SELECT model, round(roc_auc, 6) AS roc_auc FROM auc",
)
def m12_roc_auc(spark, sf):
    """ROC-AUC per scorer by rank-sum with tie mid-ranks."""
    a = mt.roc_auc(fx.model_predictions(spark, sf), group=["model"])
    return a.select("model", F.round("roc_auc", 6).alias("roc_auc"))


_CURVE_SQL = """sc AS (SELECT model, score, count(CASE WHEN y_true = 1 THEN 1 END) AS pos, count(CASE WHEN y_true <> 1 THEN 1 END) AS neg FROM preds GROUP BY 1, 2),
sc2 AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS cum_pos, sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS cum_neg,
  sum(pos) OVER (PARTITION BY model) AS tot_pos, sum(neg) OVER (PARTITION BY model) AS tot_neg FROM sc)"""


@query(
    "m13_roc_curve",
    with_ctes(TX, FEAT, MON, _preds_sql(), _CURVE_SQL)
    + """SELECT model, score AS threshold, round(coalesce(CAST(cum_neg AS DOUBLE) / nullif(tot_neg, 0), 0.0), 6) AS fpr,
  round(coalesce(CAST(cum_pos AS DOUBLE) / nullif(tot_pos, 0), 0.0), 6) AS tpr FROM sc2""",
)
def m13_roc_curve(spark, sf):
    """ROC points per distinct threshold and scorer."""
    c = mt.roc_curve(fx.model_predictions(spark, sf), group=["model"])
    return c.select("model", "threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query(
    "m14_pr_curve",
    with_ctes(TX, FEAT, MON, _preds_sql(), _CURVE_SQL)
    + """SELECT model, score AS threshold, round(CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg), 6) AS precision,
  round(coalesce(CAST(cum_pos AS DOUBLE) / nullif(tot_pos, 0), 0.0), 6) AS recall, round(CAST(tot_pos AS DOUBLE) / (tot_pos + tot_neg), 6) AS base_rate FROM sc2""",
)
def m14_pr_curve(spark, sf):
    """Precision-recall points and base rate per scorer."""
    c = mt.pr_curve(fx.model_predictions(spark, sf), group=["model"])
    return c.select("model", "threshold", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "base_rate")])


@query(
    "m15_business_cost",
    with_ctes(TX, SCORED, f"c AS (SELECT {CONF_SQL} FROM scored)")
    + """SELECT tp, fp, fn, tn, n, fn * 100.0 + fp * 10.0 AS total_cost, fn * 100.0 AS cost_missed_frauds, fp * 10.0 AS cost_false_alerts,
  tp * 100.0 AS prevented_fraud_value, tp * 100.0 - (fn * 100.0 + fp * 10.0) AS net_benefit,
  round((tp * 100.0 - (tp + fp) * 10.0) / greatest((tp + fp) * 10.0, 1.0), 6) AS roi, round((fn * 100.0 + fp * 10.0) / n, 6) AS cost_per_transaction FROM c""",
)
def m15_business_cost(spark, sf):
    """Business cost, net benefit and ROI of the scorer."""
    b = mt.business_cost(mt.confusion(fx.scored(spark, sf)))
    return b.withColumn("roi", F.round("roi", 6)).withColumn("cost_per_transaction", F.round("cost_per_transaction", 6))


_REPORT_SQL = f"""m AS (SELECT model, {CONF_SQL} FROM preds GROUP BY model),
rep AS (SELECT m.model, {RATES_SQL.replace('tp', 'm.tp').replace('fp', 'm.fp').replace('fn', 'm.fn').replace('tn', 'm.tn').replace('m.fp_rate', 'fp_rate')}, auc.roc_auc, m.tp, m.fp, m.fn, m.tn FROM m JOIN auc ON m.model = auc.model)"""


@query(
    "m16_model_comparison",
    with_ctes(TX, FEAT, MON, _preds_sql(), AUC_SQL, _REPORT_SQL)
    + "SELECT model, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(roc_auc, 6) AS roc_auc, tp, fp, fn, tn FROM rep",
)
def m16_model_comparison(spark, sf):
    """Precision, recall, F1, ROC-AUC per scorer."""
    r = mt.model_report(fx.model_predictions(spark, sf))
    return r.select("model", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "roc_auc")], "tp", "fp", "fn", "tn")


@query(
    "m17_best_model_by_f1",
    with_ctes(TX, FEAT, MON, _preds_sql(), AUC_SQL, _REPORT_SQL)
    + "SELECT model AS best_model, round(f1, 6) AS best_f1 FROM (SELECT *, row_number() OVER (ORDER BY f1 DESC, model) AS r FROM rep) WHERE r = 1",
)
def m17_best_model_by_f1(spark, sf):
    """Arg-max scorer by F1 (ties by name)."""
    b = mt.best_by(mt.model_report(fx.model_predictions(spark, sf)), "f1")
    return b.select("best_model", F.round("best_f1", 6).alias("best_f1"))


@query(
    "m18_weighted_selection",
    with_ctes(TX, FEAT, MON, _preds_sql(), AUC_SQL, _REPORT_SQL)
    + """SELECT model, round(ws, 6) AS weighted_score, row_number() OVER (ORDER BY ws DESC, model) AS rank
FROM (SELECT *, 0.0 + recall * 0.35 + f1 * 0.3 + roc_auc * 0.25 + precision * 0.1 AS ws FROM rep)""",
)
def m18_weighted_selection(spark, sf):
    """Weighted selection score and rank."""
    w = mt.weighted_selection(mt.model_report(fx.model_predictions(spark, sf)))
    return w.select("model", F.round("weighted_score", 6).alias("weighted_score"), "rank")


@query(
    "m19_tuning_change",
    with_ctes(TX, FEAT, MON, _preds_sql(0.7), AUC_SQL, _REPORT_SQL).replace("preds AS (", "preds AS (", 1)
    + ", "
    + _preds_sql(0.6).replace("preds AS (", "preds2 AS (")
    + ", "
    + _REPORT_SQL.replace("m AS (", "m2 AS (").replace("FROM preds GROUP", "FROM preds2 GROUP").replace("rep AS (", "rep2 AS (").replace("m.", "m2.").replace("FROM m JOIN", "FROM m2 JOIN")
    + """ SELECT b.model, """
    + ", ".join(f"round((a.{m} - b.{m}) / nullif(b.{m}, 0) * 100.0, 6) AS {m}_change_pct" for m in ("precision", "recall", "f1", "roc_auc"))
    + " FROM rep b JOIN rep2 a ON a.model = b.model",
)
def m19_tuning_change(spark, sf):
    """% change of each metric when the threshold moves from .7 to .6."""
    before = mt.model_report(fx.model_predictions(spark, sf, 0.7))
    after = mt.model_report(fx.model_predictions(spark, sf, 0.6))
    t = mt.tuning_change(before, after)
    return t.select("model", *[F.round(c, 6).alias(c) for c in t.columns if c != "model"])


@query(
    "a18_prediction_counts",
    with_ctes(TX, SCORED)
    + "SELECT CASE WHEN y_pred = 1 THEN 'fraud' ELSE 'normal' END AS prediction_type, CASE WHEN event_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS model_version, count(*) AS n FROM scored GROUP BY 1, 2",
)
def a18_prediction_counts(spark, sf):
    """Prediction counts by type and model version (two versions split by key parity)."""
    s = fx.scored(spark, sf).withColumn("model_version", F.when(F.pmod("event_id", F.lit(2)) == 0, "v1").otherwise("v2"))
    return mt.prediction_counts(s)


# ---- drift ----------------------------------------------------------------------------

_KS_FEATS = ["Amount", "Hour", "PCA_Magnitude"]
_BASE_SQL = """r AS (SELECT *, row_number() OVER (ORDER BY event_id) AS rn, count(*) OVER () AS n FROM mon_in),
p AS (SELECT *, CASE WHEN rn <= CAST(floor(n * 0.25) AS BIGINT) THEN 0 ELSE CAST(floor((rn - floor(n * 0.25) - 1) / 1000) AS INTEGER) + 1 END AS period FROM r),
long AS (""" + " UNION ALL ".join(f"SELECT period, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM p" for c in _KS_FEATS) + ")"

_KS_GLOBAL_SQL = """g AS (SELECT feature, value, count(CASE WHEN period = 0 THEN 1 END) AS b, count(CASE WHEN period > 0 THEN 1 END) AS c FROM long GROUP BY 1, 2),
g2 AS (SELECT *, sum(b) OVER (PARTITION BY feature ORDER BY value) AS cb, sum(c) OVER (PARTITION BY feature ORDER BY value) AS cc,
  sum(b) OVER (PARTITION BY feature) AS n_base, sum(c) OVER (PARTITION BY feature) AS n_current FROM g),
ks AS (SELECT feature, max(abs(cb / n_base - cc / n_current)) AS ks_stat, max(n_base) AS n_base, max(n_current) AS n_current FROM g2 GROUP BY feature),
ksp AS (SELECT *, """ + kolmogorov_sf_sql("sqrt(CAST(n_base AS DOUBLE) * n_current / (n_base + n_current)) * ks_stat") + " AS p_value FROM ks)"


@query(
    "d1_ks_baseline_vs_current",
    with_ctes(TX, FEAT, MON, _BASE_SQL, _KS_GLOBAL_SQL)
    + "SELECT feature, round(ks_stat, 6) AS ks_stat, n_base, n_current, round(p_value, 6) AS p_value FROM ksp",
)
def d1_ks_baseline_vs_current(spark, sf):
    """Two-sample KS statistic and asymptotic p-value, first quarter vs the rest."""
    ks = dr.ks_since_baseline(fx.monitoring_input(spark, sf), _KS_FEATS)
    return ks.select("feature", F.round("ks_stat", 6).alias("ks_stat"), "n_base", "n_current", F.round("p_value", 6).alias("p_value"))


@query(
    "d3_drift_score",
    with_ctes(TX, FEAT, MON, _BASE_SQL, _KS_GLOBAL_SQL)
    + "SELECT round(coalesce(avg(CASE WHEN p_value < 1.0 THEN 1.0 - p_value ELSE 0.0 END), 0.0), 6) AS data_drift_score FROM ksp",
)
def d3_drift_score(spark, sf):
    """D3: drift score, mean of (1 - p) over Amount, Hour, PCA_Magnitude."""
    d = dr.drift_score(dr.ks_since_baseline(fx.monitoring_input(spark, sf), _KS_FEATS))
    return d.select(F.round("data_drift_score", 6).alias("data_drift_score"))


PERIOD_KS_SQL = """base AS (SELECT feature, value, count(*) AS b FROM long WHERE period = 0 GROUP BY 1, 2),
bc AS (SELECT feature, value, sum(b) OVER (PARTITION BY feature ORDER BY value) AS cum_b, sum(b) OVER (PARTITION BY feature) AS n_base FROM base),
nb AS (SELECT feature, max(n_base) AS n_base FROM bc GROUP BY feature),
pc AS (SELECT period, feature, value, count(*) AS c FROM long WHERE period > 0 GROUP BY 1, 2, 3),
pc2 AS (SELECT *, sum(c) OVER (PARTITION BY period, feature ORDER BY value) AS cum_c, sum(c) OVER (PARTITION BY period, feature) AS n_current FROM pc),
j1 AS (SELECT pc2.*, coalesce(a.cum_b, 0) AS cb FROM pc2 ASOF LEFT JOIN bc a ON pc2.feature = a.feature AND pc2.value >= a.value),
j2 AS (SELECT j1.*, coalesce(a.cum_b, 0) AS cb_before FROM j1 ASOF LEFT JOIN bc a ON j1.feature = a.feature AND j1.value > a.value),
pks AS (SELECT j2.period, j2.feature, max(greatest(abs(cb / nb.n_base - cum_c / n_current), abs(cb_before / nb.n_base - (cum_c - c) / n_current))) AS ks_stat,
  max(nb.n_base) AS n_base, max(n_current) AS n_current FROM j2 JOIN nb ON j2.feature = nb.feature GROUP BY 1, 2),
pksp AS (SELECT *, """ + kolmogorov_sf_sql("sqrt(CAST(n_base AS DOUBLE) * n_current / (n_base + n_current)) * ks_stat") + """ AS p_value FROM pks),
dscore AS (SELECT period, coalesce(avg(CASE WHEN p_value < 1.0 THEN 1.0 - p_value ELSE 0.0 END), 0.0) AS data_drift_score FROM pksp GROUP BY period),
pm AS (SELECT period, """ + CONF_SQL + """ FROM p WHERE period > 0 GROUP BY period),
mon AS (SELECT pm.period, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS detection_rate, coalesce(CAST(fp AS DOUBLE) / nullif(fp + tn, 0), 0.0) AS false_positive_rate,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision, coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0.0) AS f1_score,
  coalesce(d.data_drift_score, 0.0) AS data_drift_score FROM pm LEFT JOIN dscore d ON pm.period = d.period)"""

_MON_CTES = with_ctes(TX, FEAT, MON, _BASE_SQL, PERIOD_KS_SQL)


def _monitoring(spark, sf):
    return dr.monitoring_table(dr.assign_periods(fx.monitoring_input(spark, sf)))


@query(
    "d4_period_ks",
    _MON_CTES + "SELECT period, feature, round(ks_stat, 6) AS ks_stat, n_base, n_current, round(p_value, 6) AS p_value FROM pksp",
)
def d4_period_ks(spark, sf):
    """KS of every 1000-row period against the first-quarter baseline."""
    k = dr.ks_per_period(dr.assign_periods(fx.monitoring_input(spark, sf)), _KS_FEATS)
    return k.select("period", "feature", F.round("ks_stat", 6).alias("ks_stat"), "n_base", "n_current", F.round("p_value", 6).alias("p_value"))


@query(
    "d4_monitoring_periods",
    _MON_CTES + "SELECT period, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("detection_rate", "false_positive_rate", "precision", "f1_score", "data_drift_score")) + " FROM mon",
)
def d4_monitoring_periods(spark, sf):
    """Per-period detection, FP rate, precision, F1 and drift score."""
    m = _monitoring(spark, sf)
    return m.select("period", *[F.round(c, 6).alias(c) for c in m.columns if c != "period"])


ALERTS_SQL = """al AS (
  SELECT period, 1 AS k, CASE WHEN detection_rate < 0.7 THEN 'CRITIQUE' WHEN detection_rate < 0.8 THEN 'ATTENTION' END AS type, 'detection_rate' AS metric, detection_rate AS value,
    CASE WHEN detection_rate < 0.7 THEN 'Taux de détection critique: ' ELSE 'Taux de détection faible: ' END || printf('%.1f', detection_rate * 100.0) || '%' AS message, CAST(NULL AS VARCHAR) AS action FROM mon
  UNION ALL SELECT period, 2, CASE WHEN false_positive_rate > 0.02 THEN 'CRITIQUE' WHEN false_positive_rate > 0.01 THEN 'ATTENTION' END, 'false_positive_rate', false_positive_rate,
    'Taux de faux positifs élevé: ' || printf('%.2f', false_positive_rate * 100.0) || '%', NULL FROM mon
  UNION ALL SELECT period, 3, CASE WHEN data_drift_score > 0.5 THEN 'CRITIQUE' WHEN data_drift_score > 0.3 THEN 'ATTENTION' END, 'data_drift_score', data_drift_score,
    CASE WHEN data_drift_score > 0.5 THEN 'Dérive critique détectée: ' ELSE 'Dérive détectée: ' END || printf('%.3f', data_drift_score),
    CASE WHEN data_drift_score > 0.5 THEN 'Réentraînement du modèle requis' ELSE 'Surveillance renforcée' END FROM mon)"""


@query(
    "d5_alerts",
    _MON_CTES + ", " + ALERTS_SQL + " SELECT period, type, metric, round(value, 6) AS value, message, action FROM al WHERE type IS NOT NULL",
)
def d5_alerts(spark, sf):
    """Alerts per period (critical/attention on detection, FP rate, drift)."""
    a = dr.alerts(_monitoring(spark, sf))
    return a.select("period", "type", "metric", F.round("value", 6).alias("value"), "message", "action")


@query(
    "d6_overall_status",
    _MON_CTES
    + """SELECT period, round(detection_rate, 6) AS detection_rate, round(data_drift_score, 6) AS data_drift_score,
  CASE WHEN detection_rate < 0.7 OR data_drift_score > 0.5 THEN 'CRITIQUE' WHEN detection_rate < 0.8 OR data_drift_score > 0.3 THEN 'ATTENTION' ELSE 'NOMINAL' END AS status
FROM mon WHERE period = (SELECT max(period) FROM mon)""",
)
def d6_overall_status(spark, sf):
    """Overall status from the latest period."""
    s = dr.overall_status(_monitoring(spark, sf))
    return s.select("period", F.round("detection_rate", 6).alias("detection_rate"), F.round("data_drift_score", 6).alias("data_drift_score"), "status")


@query(
    "d7_recommendations",
    _MON_CTES
    + """SELECT period, CASE WHEN f1_score < 0.7 THEN 'URGENT: Réentraînement complet requis' WHEN f1_score < 0.75 THEN 'ATTENTION: Réentraînement planifié'
  WHEN data_drift_score > 0.5 THEN 'Surveillance renforcée' ELSE 'Monitoring standard' END AS recommendation FROM mon""",
)
def d7_recommendations(spark, sf):
    """Retraining recommendation per period."""
    m = _monitoring(spark, sf)
    return m.select("period", dr.recommendation(F.col("f1_score"), F.col("data_drift_score")).alias("recommendation"))


@query(
    "d8_retraining_summary",
    _MON_CTES + "SELECT count(CASE WHEN f1_score < 0.75 THEN 1 END) AS retrain_periods, min(CASE WHEN f1_score < 0.75 THEN period END) AS first_retrain_period, count(*) AS periods FROM mon",
)
def d8_retraining_summary(spark, sf):
    """Periods flagged for retraining, their count and the first one."""
    return dr.retraining_summary(_monitoring(spark, sf))


@query(
    "j4_truth_prediction_join",
    with_ctes(TX, SCORED)
    + """, truth AS (SELECT event_id, Class FROM transactions), pred AS (SELECT event_id, y_pred FROM scored)
SELECT count(CASE WHEN t.Class = 1 AND p.y_pred = 1 THEN 1 END) AS tp, count(CASE WHEN t.Class <> 1 AND p.y_pred = 1 THEN 1 END) AS fp,
  count(CASE WHEN t.Class = 1 AND p.y_pred <> 1 THEN 1 END) AS fn, count(CASE WHEN t.Class <> 1 AND p.y_pred <> 1 THEN 1 END) AS tn, count(*) AS n
FROM truth t JOIN pred p ON t.event_id = p.event_id""",
)
def j4_truth_prediction_join(spark, sf):
    """Ground truth joined to predictions on the transaction id (not by position),
    then the confusion counts.  Both sides are large: a shuffle (sort-merge) join."""
    truth = fx.transactions(spark, sf).select("event_id", F.col("Class").alias("y_true"))
    pred = fx.scored(spark, sf).select("event_id", "y_pred")
    return mt.confusion(truth.join(pred, "event_id"))


@query(
    "t6_last_alerts",
    _MON_CTES + ", " + ALERTS_SQL
    + " SELECT period, type, metric, round(value, 6) AS value FROM al WHERE type IS NOT NULL ORDER BY period DESC, k DESC LIMIT 5",
)
def t6_last_alerts(spark, sf):
    """The five most recent alerts (latest period first, then drift / FP / detection)."""
    a = dr.alerts(_monitoring(spark, sf))
    k = F.when(F.col("metric") == "detection_rate", 1).when(F.col("metric") == "false_positive_rate", 2).otherwise(3)
    return a.orderBy(F.col("period").desc(), k.desc()).limit(5).select("period", "type", "metric", F.round("value", 6).alias("value"))
