"""Classification metrics on predictions.

All metrics are conditional sums in one aggregate pass (optionally per group, e.g.
per model or per monitoring period).  ROC-AUC and the ROC / PR curves come from
running totals over distinct scores (bucketed, see ``ordered``), never from a
global sort in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline.operators.ordered import running_totals

# fixed values: business cost model and weighted selection
FRAUD_COST = 100.0
INVESTIGATION_COST = 10.0
SELECTION_WEIGHTS = {"recall": 0.35, "f1": 0.30, "roc_auc": 0.25, "precision": 0.10}


def _z(c: Column) -> Column:
    """0 when a ratio is undefined (zero denominator), as scikit-learn's zero_division."""
    return F.coalesce(c, F.lit(0.0))


def confusion(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", group: list[str] = ()) -> DataFrame:
    """Tp, fp, fn, tn (and n) per group in one pass."""
    t, p = F.col(y_true) == 1, F.col(y_pred) == 1
    cnt = lambda cond: F.count(F.when(cond, F.lit(1)))
    return df.groupBy(*group).agg(
        cnt(t & p).alias("tp"), cnt(~t & p).alias("fp"), cnt(t & ~p).alias("fn"), cnt(~t & ~p).alias("tn"),
        F.count(F.lit(1)).alias("n"),
    )


def rates(conf: DataFrame) -> DataFrame:
    """Precision, recall (detection rate), F1 and FP rate from a confusion table."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision = _z(F.try_divide(tp, tp + fp))
    recall = _z(F.try_divide(tp, tp + fn))
    f1 = _z(F.try_divide(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn))
    fpr = _z(F.try_divide(fp, fp + tn))
    return conf.select("*", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), fpr.alias("fp_rate"))


def classification_metrics(df: DataFrame, y_true="y_true", y_pred="y_pred", group: list[str] = ()) -> DataFrame:
    return rates(confusion(df, y_true, y_pred, list(group)))


def score_counts(df: DataFrame, score: str = "score", y_true: str = "y_true", group: list[str] = (), descending: bool = False) -> DataFrame:
    """Positives / negatives per distinct score with running totals."""
    return running_totals(
        df, score,
        {"pos": (F.col(y_true) == 1).cast("long"), "neg": (F.col(y_true) != 1).cast("long")},
        group=list(group), descending=descending,
    )


def roc_auc(df: DataFrame, score: str = "score", y_true: str = "y_true", group: list[str] = ()) -> DataFrame:
    """ROC-AUC by the rank-sum (Mann-Whitney) form with mid-ranks for ties:
    sum over scores of pos * (neg below + neg at / 2), over P * N."""
    sc = score_counts(df, score, y_true, group)
    below = F.col("cum_neg") - F.col("neg")
    return sc.groupBy(*group).agg(
        F.try_divide(F.sum(F.col("pos") * (below + F.col("neg") * F.lit(0.5))),
                     F.max(F.col("tot_pos")).cast("double") * F.max(F.col("tot_neg"))).alias("roc_auc")
    )


def roc_curve(df: DataFrame, score: str = "score", y_true: str = "y_true", group: list[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, predicting positive at >= threshold."""
    sc = score_counts(df, score, y_true, group, descending=True)
    return sc.select(*group, F.col(score).alias("threshold"),
                     _z(F.try_divide(F.col("cum_neg").cast("double"), F.col("tot_neg"))).alias("fpr"),
                     _z(F.try_divide(F.col("cum_pos").cast("double"), F.col("tot_pos"))).alias("tpr"))


def pr_curve(df: DataFrame, score: str = "score", y_true: str = "y_true", group: list[str] = ()) -> DataFrame:
    """(threshold, precision, recall) per distinct score and the positive base rate."""
    sc = score_counts(df, score, y_true, group, descending=True)
    return sc.select(*group, F.col(score).alias("threshold"),
                     (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                     _z(F.try_divide(F.col("cum_pos").cast("double"), F.col("tot_pos"))).alias("recall"),
                     (F.col("tot_pos") / (F.col("tot_pos") + F.col("tot_neg"))).alias("base_rate"))


def business_cost(conf: DataFrame, fraud_cost: float = FRAUD_COST, investigation_cost: float = INVESTIGATION_COST) -> DataFrame:
    """Missed-fraud and investigation costs, net benefit, ROI, cost per transaction."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    missed = fn * F.lit(fraud_cost)
    alerts = fp * F.lit(investigation_cost)
    total = missed + alerts
    prevented = tp * F.lit(fraud_cost)
    inv_total = (tp + fp) * F.lit(investigation_cost)
    return conf.select(
        "*",
        total.alias("total_cost"), missed.alias("cost_missed_frauds"), alerts.alias("cost_false_alerts"),
        prevented.alias("prevented_fraud_value"), (prevented - total).alias("net_benefit"),
        ((prevented - inv_total) / F.greatest(inv_total, F.lit(1.0))).alias("roi"),
        (total / F.col("n")).alias("cost_per_transaction"),
    )


def model_report(preds: DataFrame, model: str = "model", y_true="y_true", y_pred="y_pred", score="score") -> DataFrame:
    """Precision, recall, F1, ROC-AUC per model (one row per model)."""
    m = classification_metrics(preds, y_true, y_pred, [model])
    auc = roc_auc(preds, score, y_true, [model])
    return m.join(auc, on=model).select(model, "precision", "recall", "f1", "roc_auc", "tp", "fp", "fn", "tn")


def weighted_selection(report: DataFrame, model: str = "model", weights: dict[str, float] = SELECTION_WEIGHTS) -> DataFrame:
    """Weighted score and rank (1 = best; ties by model name).  The window
    runs over the per-model table (one row per model)."""
    score = sum((F.col(k) * F.lit(w) for k, w in weights.items()), F.lit(0.0))
    ranked = report.withColumn("weighted_score", score)
    return ranked.withColumn("rank", F.row_number().over(Window.orderBy(F.col("weighted_score").desc(), F.col(model))))


def best_by(report: DataFrame, metric: str, model: str = "model") -> DataFrame:
    """Arg-max model by a metric (first strict max; ties -> first model name).
    Runs over the per-model table (one row per model)."""
    w = Window.orderBy(F.col(metric).desc(), F.col(model))
    return report.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).select(
        F.col(model).alias("best_model"), F.col(metric).alias(f"best_{metric}"))


def tuning_change(before: DataFrame, after: DataFrame, model: str = "model", metrics=("precision", "recall", "f1", "roc_auc")) -> DataFrame:
    """Relative change (%) of each metric between two runs of every model."""
    b = before.select(model, *[F.col(m).alias(f"{m}_before") for m in metrics])
    a = after.select(model, *[F.col(m).alias(f"{m}_after") for m in metrics])
    j = b.join(a, on=model)
    return j.select(model, *[
        (F.try_divide(F.col(f"{m}_after") - F.col(f"{m}_before"), F.col(f"{m}_before")) * F.lit(100.0)).alias(f"{m}_change_pct")
        for m in metrics
    ])


def prediction_counts(preds: DataFrame, y_pred: str = "y_pred", version: str = "model_version") -> DataFrame:
    """Prediction counter by type (fraud / normal) and model version."""
    kind = F.when(F.col(y_pred) == 1, F.lit("fraud")).otherwise(F.lit("normal"))
    return preds.groupBy(kind.alias("prediction_type"), F.col(version).alias("model_version")).agg(F.count(F.lit(1)).alias("n"))
