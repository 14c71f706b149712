"""Drift tests and production monitoring.

* Two-sample KS (D1) = max |F_base - F_cur| over the pooled distinct values, from
  bucketed running totals (no global sort in one task).
* p-value (D2) from the asymptotic Kolmogorov distribution with
  n_e = n1*n2/(n1+n2): Q(sqrt(n_e) * D).  Always asymptotic (the reference switches
  to an exact small-sample law below 10,000 rows; small samples differ slightly).
* Per-period KS against a fixed baseline (D4): each period (bounded, 1000 rows) is
  compared at its own jump points only; the baseline CDF at those points comes from
  one running-total pass over baseline + all period values, joined on the value.
  Between two period points the period CDF is flat, so the supremum is reached at
  a period point or just before it - no baseline x period pairing is needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline.functions.stats import kolmogorov_sf
from riskline.operators.explore import to_long
from riskline.operators.metrics import confusion, rates
from riskline.operators.ordered import row_numbers, running_totals
from riskline.operators.selection import select_ranks

# fixed values: drift features, period size, alert limits and texts
DRIFT_FEATURES = ["Amount", "Hour", "PCA_Magnitude"]
PERIOD_ROWS = 1000
DETECTION_CRITICAL, DETECTION_WARNING = 0.7, 0.8
FP_CRITICAL, FP_WARNING = 0.02, 0.01
DRIFT_CRITICAL, DRIFT_WARNING = 0.5, 0.3
RETRAIN_URGENT_F1, RETRAIN_F1 = 0.70, 0.75
CRITICAL, WARNING, NOMINAL = "CRITIQUE", "ATTENTION", "NOMINAL"
MSG_DETECTION_CRITICAL = "Taux de détection critique: {}"
MSG_DETECTION_LOW = "Taux de détection faible: {}"
MSG_FP_HIGH = "Taux de faux positifs élevé: {}"
MSG_DRIFT_CRITICAL = "Dérive critique détectée: {}"
MSG_DRIFT = "Dérive détectée: {}"
ACTION_RETRAIN = "Réentraînement du modèle requis"
ACTION_WATCH = "Surveillance renforcée"
REC_URGENT = "URGENT: Réentraînement complet requis"
REC_PLANNED = "ATTENTION: Réentraînement planifié"
REC_WATCH = "Surveillance renforcée"
REC_STANDARD = "Monitoring standard"


def ks_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    en = n1.cast("double") * n2 / (n1 + n2)
    return kolmogorov_sf(F.sqrt(en) * d)


def drift_component(p: Column) -> Column:
    """1 - p, with p = 1 counted as no drift (0)."""
    return F.when(p < F.lit(1.0), F.lit(1.0) - p).otherwise(F.lit(0.0))


def ks_two_sample(base: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """KS statistic and asymptotic p-value per feature."""
    return _ks(to_long(base, features, []).withColumn("_cur", F.lit(0)).unionByName(to_long(current, features, []).withColumn("_cur", F.lit(1))))


def ks_since_baseline(df: DataFrame, features: list[str], key: str = "event_id", baseline_fraction: float = 0.25) -> DataFrame:
    """D1/D2 of the first ``baseline_fraction`` of the rows in ``key`` order against the rest.

    The baseline's last key is one order statistic, found by histogram selection on the key
    alone; rows are then told apart by comparison.  ``key`` is unique."""
    ends = select_ranks(df.select(key), key, {"last": lambda n, _: math.floor(n * baseline_fraction) - 1})
    flag = (F.col(key) > F.lit(ends[0].value)).cast("int") if ends else F.lit(1)
    return _ks(to_long(df.where(F.col(key).isNotNull()).withColumn("_cur", flag), features, ["_cur"]))


def _ks(long: DataFrame) -> DataFrame:
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    rt = running_totals(long, "value", {"b": (F.col("_cur") == 0).cast("long"), "c": (F.col("_cur") == 1).cast("long")}, group=["feature"])
    gap = F.abs(F.col("cum_b") / F.col("tot_b") - F.col("cum_c") / F.col("tot_c"))
    ks = rt.groupBy("feature").agg(F.max(gap).alias("ks_stat"), F.max("tot_b").alias("n_base"), F.max("tot_c").alias("n_current"))
    return ks.withColumn("p_value", ks_pvalue(F.col("ks_stat"), F.col("n_base"), F.col("n_current")))


def drift_score(ks: DataFrame, group: list[str] = ()) -> DataFrame:
    """D3: mean of (1 - p) over features (0 when p = 1); 0 when no feature."""
    return ks.groupBy(*group).agg(F.coalesce(F.avg(drift_component(F.col("p_value"))), F.lit(0.0)).alias("data_drift_score"))


def assign_periods(df: DataFrame, key: str = "event_id", period_rows: int = PERIOD_ROWS, baseline_fraction: float = 0.25) -> DataFrame:
    """D4 input: rows in key order; the first quarter is the baseline (period 0), the
    rest is cut into consecutive ``period_rows`` periods numbered from 1."""
    ranked = row_numbers(df, [key], out="_rl_rn", total="_rl_n")
    nb = F.floor(F.col("_rl_n") * F.lit(baseline_fraction))  # int(n * fraction), from the ranking's own totals
    period = F.when(F.col("_rl_rn") <= nb, F.lit(0)).otherwise(
        F.floor((F.col("_rl_rn") - nb - F.lit(1)) / F.lit(period_rows)).cast("int") + F.lit(1))
    # The period table feeds several passes (metrics, baseline CDF, period CDFs);
    # a reliable checkpoint in the shared checkpoint folder cuts the lineage once
    # instead of re-running scan + join + ranking per pass, and survives lost executors.
    return ranked.withColumn("period", period.cast("int")).drop("_rl_rn", "_rl_n").checkpoint(eager=True)


def ks_per_period(periods: DataFrame, features: list[str]) -> DataFrame:
    """KS statistic and p-value of every period (>= 1) against period 0."""
    counts = value_counts(periods, features)
    base = counts.where(F.col("period") == 0).select("feature", "value", F.col("c").alias("b"))
    return ks_of_counts(base, counts.where(F.col("period") > 0))


def value_counts(periods: DataFrame, features: list[str]) -> DataFrame:
    """(period, feature, value, c): what the KS of a period needs of its rows."""
    long = to_long(periods, features, ["period"]).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return long.groupBy("period", "feature", "value").agg(F.count(F.lit(1)).alias("c"))


def ks_of_counts(base: DataFrame, counts: DataFrame) -> DataFrame:
    """KS of every period in ``counts`` (period, feature, value, c) against ``base`` (feature, value, b)."""
    # baseline CDF at every pooled distinct value (bucketed running totals)
    none = F.lit(0).cast("long")
    pooled = base.select("feature", "value", "b").unionByName(counts.select("feature", "value", none.alias("b")).distinct())
    look = running_totals(pooled, "value", {"b": F.col("b")}, group=["feature"]).select(
        "feature", "value", (F.col("cum_b") / F.col("tot_b")).alias("fb"),
        ((F.col("cum_b") - F.col("b")) / F.col("tot_b")).alias("fb_before"), F.col("tot_b").alias("n_base"))
    # period CDF: one window partition per (period, feature), at most a period's rows
    w = Window.partitionBy("period", "feature").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    pc = counts.select("*", F.sum("c").over(w).alias("cum_c"), F.sum("c").over(Window.partitionBy("period", "feature")).alias("n_current"))
    j = pc.join(look, on=["feature", "value"])
    fp = F.col("cum_c") / F.col("n_current")
    fp_before = (F.col("cum_c") - F.col("c")) / F.col("n_current")
    gap = F.greatest(F.abs(F.col("fb") - fp), F.abs(F.col("fb_before") - fp_before))
    ks = j.groupBy("period", "feature").agg(F.max(gap).alias("ks_stat"), F.max("n_base").alias("n_base"), F.max("n_current").alias("n_current"))
    return ks.withColumn("p_value", ks_pvalue(F.col("ks_stat"), F.col("n_base"), F.col("n_current")))


def monitoring_table(periods: DataFrame, features: list[str] = DRIFT_FEATURES, y_true="y_true", y_pred="y_pred") -> DataFrame:
    """Per period detection rate, FP rate, precision, F1 and drift score."""
    return monitoring_of(confusion(periods.where(F.col("period") > 0), y_true, y_pred, ["period"]), ks_per_period(periods, features))


def monitoring_of(confusions: DataFrame, ks: DataFrame) -> DataFrame:
    """D4 from the periods' confusion counts and KS rows."""
    m, d = rates(confusions), drift_score(ks, ["period"])
    return m.join(d, on="period", how="left").select(
        "period", F.col("recall").alias("detection_rate"), F.col("fp_rate").alias("false_positive_rate"),
        "precision", F.col("f1").alias("f1_score"), F.coalesce("data_drift_score", F.lit(0.0)).alias("data_drift_score"))


def _pct(c: Column, decimals: int) -> Column:
    return F.concat(F.format_string(f"%.{decimals}f", c * F.lit(100.0)), F.lit("%"))


def alerts(mon: DataFrame) -> DataFrame:
    """Up to three alerts per period, critical before warning; strict limits."""
    det, fp, dr = F.col("detection_rate"), F.col("false_positive_rate"), F.col("data_drift_score")

    def alert(kind, metric, value, msg, action=None):
        return F.struct(F.lit(kind).alias("type"), F.lit(metric).alias("metric"), value.alias("value"), msg.alias("message"),
                        (F.lit(action) if action else F.lit(None).cast("string")).alias("action"))

    fmt = lambda tmpl, v: F.format_string(tmpl.replace("{}", "%s"), v)
    a_det = F.when(det < DETECTION_CRITICAL, alert(CRITICAL, "detection_rate", det, fmt(MSG_DETECTION_CRITICAL, _pct(det, 1)))).when(
        det < DETECTION_WARNING, alert(WARNING, "detection_rate", det, fmt(MSG_DETECTION_LOW, _pct(det, 1))))
    a_fp = F.when(fp > FP_CRITICAL, alert(CRITICAL, "false_positive_rate", fp, fmt(MSG_FP_HIGH, _pct(fp, 2)))).when(
        fp > FP_WARNING, alert(WARNING, "false_positive_rate", fp, fmt(MSG_FP_HIGH, _pct(fp, 2))))
    a_dr = F.when(dr > DRIFT_CRITICAL, alert(CRITICAL, "data_drift_score", dr, fmt(MSG_DRIFT_CRITICAL, F.format_string("%.3f", dr)), ACTION_RETRAIN)).when(
        dr > DRIFT_WARNING, alert(WARNING, "data_drift_score", dr, fmt(MSG_DRIFT, F.format_string("%.3f", dr)), ACTION_WATCH))
    return mon.select("period", F.explode(F.array_compact(F.array(a_det, a_fp, a_dr))).alias("a")).select("period", "a.*")


def overall_status(mon: DataFrame) -> DataFrame:
    """Status of the latest period (detection and drift only)."""
    last = mon.agg(F.max_by(F.struct("period", "detection_rate", "data_drift_score"), F.col("period")).alias("l")).select("l.*")
    det, dr = F.col("detection_rate"), F.col("data_drift_score")
    status = F.when((det < DETECTION_CRITICAL) | (dr > DRIFT_CRITICAL), F.lit(CRITICAL)).when(
        (det < DETECTION_WARNING) | (dr > DRIFT_WARNING), F.lit(WARNING)).otherwise(F.lit(NOMINAL))
    return last.select("period", "detection_rate", "data_drift_score", status.alias("status"))


def recommendation(f1: Column, drift: Column) -> Column:
    """Retraining recommendation."""
    return (F.when(f1 < RETRAIN_URGENT_F1, F.lit(REC_URGENT)).when(f1 < RETRAIN_F1, F.lit(REC_PLANNED))
            .when(drift > DRIFT_CRITICAL, F.lit(REC_WATCH)).otherwise(F.lit(REC_STANDARD)))


def retraining_summary(mon: DataFrame) -> DataFrame:
    """Periods needing retraining (F1 < .75), their count and the first one."""
    flagged = F.col("f1_score") < F.lit(RETRAIN_F1)
    return mon.agg(F.count(F.when(flagged, F.lit(1))).alias("retrain_periods"),
                   F.min(F.when(flagged, F.col("period"))).alias("first_retrain_period"),
                   F.count(F.lit(1)).alias("periods"))
