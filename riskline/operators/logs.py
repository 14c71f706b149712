"""Ingestion anomaly rules, detector evaluation and security-log analysis
(D10-D14, F9, D16)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.functions.rng import lcg_uniform

# fixed values: documented ingestion anomaly bands
VOLUME_HIGH = 500
VOLUME_LOW = 20
RESPONSE_HIGH_MS = 150.0
ERROR_RATE_HIGH = 0.10


def rule_anomalies(ing: DataFrame, volume_high=VOLUME_HIGH, volume_low=VOLUME_LOW, response_high=RESPONSE_HIGH_MS,
                   error_high=ERROR_RATE_HIGH) -> DataFrame:
    """Flag windows outside the documented bands (thresholds are parameters)."""
    flag = ((F.col("volume") > volume_high) | (F.col("volume") < volume_low) | (F.col("response_time_ms") > response_high)
            | (F.col("error_rate") > error_high))
    return ing.withColumn("detected_anomaly", flag)


def detector_evaluation(flagged: DataFrame, truth: Column, detected: str = "detected_anomaly") -> DataFrame:
    """True / false positives, detections and precision with max(n, 1)."""
    d = F.col(detected)
    agg = flagged.agg(F.count(F.when(truth & d, F.lit(1))).alias("true_positives"),
                      F.count(F.when(~truth & d, F.lit(1))).alias("false_positives"),
                      F.count(F.when(d, F.lit(1))).alias("detected_total"))
    return agg.withColumn("precision", F.col("true_positives") / F.greatest(F.col("detected_total"), F.lit(1)))


def top_counts(df: DataFrame, key: str, k: int, where: Column | None = None) -> DataFrame:
    """Top-k keys by count (ties by key), computed over the grouped table."""
    src = df.where(where) if where is not None else df
    counts = src.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    # ``orderBy + limit`` plans a TakeOrderedAndProject: per-partition top-k then merge
    return counts.orderBy(F.col("n").desc(), F.col(key)).limit(k)


def incidents_by_hour(logs: DataFrame) -> DataFrame:
    """Malicious events per hour of day."""
    return logs.where(F.col("is_malicious")).groupBy(F.hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("incidents"))


def blocklist(logs: DataFrame, min_incidents: int) -> DataFrame:
    """IPs with at least ``min_incidents`` malicious events."""
    return (logs.where(F.col("is_malicious")).groupBy("source_ip").agg(F.count(F.lit(1)).alias("incidents"))
            .where(F.col("incidents") >= min_incidents))


def apply_blocklist(logs: DataFrame, blocked: DataFrame) -> DataFrame:
    """Drop events from blocked IPs (left anti join; AQE picks broadcast when small)."""
    return logs.join(blocked.select("source_ip"), on="source_ip", how="left_anti")


def time_slot(hour: Column, hours: int = 4) -> Column:
    """Coarse time slot (4-hour slots by default)."""
    return F.floor(hour / F.lit(hours)).cast("int")


def laplace_noise(key: Column, scale: float, seed: int) -> Column:
    """Laplace(0, scale) noise by inverse CDF of a seeded uniform of the row key.

    Whoever knows ``seed`` and the key can subtract the noise: keep the seed secret."""
    u = lcg_uniform(key, 7, seed) - F.lit(0.5)
    return F.lit(-scale) * F.signum(u) * F.log(F.lit(1.0) - F.lit(2.0) * F.abs(u))
