"""Queries: ingestion anomalies, logs, privacy, run report."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from riskline.functions.rng import lcg_uniform_sql
from riskline.operators import logs as lg
from riskline.operators import report as rp
from riskline.operators import validate as val
from riskline.plans.registry import query
from riskline.plans.sql import FEAT, INGESTION, LOGS, TX, with_ctes
from riskline.session import ensure_checkpoint_dir
from riskline.sources import fixtures as fx


@query("x0_ingestion_windows", with_ctes(INGESTION) + "SELECT window_start, volume, round(response_time_ms, 6) AS response_time_ms, round(error_rate, 6) AS error_rate FROM ingestion")
def x0_ingestion_windows(spark, sf):
    """Ingestion view: 10-minute windows of volume, mean response, error rate (batch)."""
    i = fx.ingestion(spark, sf)
    return i.select("window_start", "volume", F.round("response_time_ms", 6).alias("response_time_ms"), F.round("error_rate", 6).alias("error_rate"))


def _rules_sql(vh, vl, rh, eh):
    return f"(volume > {vh} OR volume < {vl} OR response_time_ms > {rh} OR error_rate > {eh})"


@query(
    "d10_rule_anomalies_default",
    with_ctes(INGESTION) + f"SELECT {_rules_sql(500, 20, 150.0, 0.1)} AS detected_anomaly, count(*) AS n FROM ingestion GROUP BY 1",
)
def d10_rule_anomalies_default(spark, sf):
    """Documented bands (volume > 500 or < 20, response > 150, errors > 10 %)."""
    return lg.rule_anomalies(fx.ingestion(spark, sf)).groupBy("detected_anomaly").agg(F.count(F.lit(1)).alias("n"))


@query(
    "d10_rule_anomalies_scaled",
    with_ctes(INGESTION) + f"SELECT window_start, volume, round(response_time_ms, 6) AS response_time_ms, round(error_rate, 6) AS error_rate FROM ingestion WHERE {_rules_sql(6, 1, 150.0, 0.5)}",
)
def d10_rule_anomalies_scaled(spark, sf):
    """D10 with bands scaled to the fixture's volumes (> 6 or < 1 per window, errors > 50 %)."""
    f = lg.rule_anomalies(fx.ingestion(spark, sf), volume_high=6, volume_low=1, error_high=0.5).where("detected_anomaly")
    return f.select("window_start", "volume", F.round("response_time_ms", 6).alias("response_time_ms"), F.round("error_rate", 6).alias("error_rate"))


@query(
    "d11_detector_evaluation",
    with_ctes(INGESTION, f"f AS (SELECT *, {_rules_sql(6, 1, 150.0, 0.5)} AS d, error_rate >= 0.5 AS truth FROM ingestion)")
    + """SELECT count(CASE WHEN truth AND d THEN 1 END) AS true_positives, count(CASE WHEN NOT truth AND d THEN 1 END) AS false_positives,
  count(CASE WHEN d THEN 1 END) AS detected_total, count(CASE WHEN truth AND d THEN 1 END) / greatest(count(CASE WHEN d THEN 1 END), 1) AS precision FROM f""",
)
def d11_detector_evaluation(spark, sf):
    """Rule detector against windows whose error rate is at least 50 %."""
    f = lg.rule_anomalies(fx.ingestion(spark, sf), volume_high=6, volume_low=1, error_high=0.5)
    return lg.detector_evaluation(f, F.col("error_rate") >= 0.5)


@query(
    "d12_top_malicious_ips",
    with_ctes(LOGS) + "SELECT source_ip, count(*) AS n FROM logs WHERE is_malicious GROUP BY source_ip ORDER BY n DESC, source_ip LIMIT 3",
)
def d12_top_malicious_ips(spark, sf):
    """Top-3 IPs by malicious events."""
    return lg.top_counts(fx.logs(spark, sf), "source_ip", 3, F.col("is_malicious"))


@query(
    "d12_top_incident_types",
    with_ctes(LOGS) + "SELECT message, count(*) AS n FROM logs WHERE level <> 'INFO' OR is_malicious GROUP BY message ORDER BY n DESC, message LIMIT 3",
)
def d12_top_incident_types(spark, sf):
    """Top-3 incident messages."""
    return lg.top_counts(fx.logs(spark, sf), "message", 3, (F.col("level") != "INFO") | F.col("is_malicious"))


@query(
    "d12_top_event_types",
    with_ctes(LOGS) + "SELECT message, count(*) AS n FROM logs GROUP BY message ORDER BY n DESC, message LIMIT 5",
)
def d12_top_event_types(spark, sf):
    """T4: top-5 event messages over all logs."""
    return lg.top_counts(fx.logs(spark, sf), "message", 5)


@query("d13_incidents_by_hour", with_ctes(LOGS) + 'SELECT CAST(hour("timestamp") AS INTEGER) AS hour, count(*) AS incidents FROM logs WHERE is_malicious GROUP BY 1')
def d13_incidents_by_hour(spark, sf):
    """Malicious events per hour of day."""
    return lg.incidents_by_hour(fx.logs(spark, sf))


@query(
    "d14_blocklist",
    with_ctes(LOGS) + "SELECT source_ip, count(*) AS incidents FROM logs WHERE is_malicious GROUP BY source_ip HAVING count(*) >= 20",
)
def d14_blocklist(spark, sf):
    """Recurrent IPs (>= 20 malicious events)."""
    return lg.blocklist(fx.logs(spark, sf), 20)


@query(
    "d14_after_blocklist",
    with_ctes(LOGS, "b AS (SELECT source_ip FROM logs WHERE is_malicious GROUP BY source_ip HAVING count(*) >= 20)")
    + "SELECT level, count(*) AS n FROM logs WHERE source_ip NOT IN (SELECT source_ip FROM b) GROUP BY level",
)
def d14_after_blocklist(spark, sf):
    """Events left after the blocklist anti-join, per level."""
    logs = fx.logs(spark, sf)
    return lg.apply_blocklist(logs, lg.blocklist(logs, 20)).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query(
    "d16_time_slots",
    with_ctes(TX, FEAT) + "SELECT CAST(floor(Hour / 4) AS INTEGER) AS slot, Class, count(*) AS n FROM feat GROUP BY 1, 2",
)
def d16_time_slots(spark, sf):
    """4-hour time slots per class (coarsened time)."""
    from riskline.operators.featurize import enrich

    e = enrich(fx.transactions(spark, sf))
    return e.groupBy(lg.time_slot(F.col("Hour")).alias("slot"), "Class").agg(F.count(F.lit(1)).alias("n"))


@query(
    "d16_laplace_amount",
    with_ctes(TX, f"u AS (SELECT event_id, Amount, {lcg_uniform_sql('event_id', '7')} - 0.5 AS u FROM transactions)")
    + "SELECT event_id, round(Amount + (-5.0) * sign(u) * ln(1.0 - 2.0 * abs(u)), 6) AS noisy_amount FROM u",
)
def d16_laplace_amount(spark, sf):
    """Laplace noise (scale 5) on Amount from a seeded per-row uniform."""
    t = fx.transactions(spark, sf)
    return t.select("event_id", F.round(F.col("Amount") + lg.laplace_noise(F.col("event_id"), 5.0, seed=42), 6).alias("noisy_amount"))


def _report(spark, sf):
    base = fx.transactions(spark, sf).select(*fx.BASE_COLUMNS)
    check = val.pipeline_check_report(base).select("status", "rows_count", "fraud_percentage")
    bal = val.imbalance_summary(base).select("imbalance_ratio", "minority_class")
    biz = val.business_ranges(base, time_range=(0.0, 2592000.0)).select(
        F.when(F.col("time_range_valid") & F.col("amount_range_valid") & F.col("class_values_valid"), "success").otherwise("failed").alias("status"))
    return rp.pipeline_report([rp.step_rows("check_data", check), rp.step_rows("class_balance", bal), rp.step_rows("business_30d", biz)])


@query(
    "s5_pipeline_report",
    with_ctes(
        TX,
        """s AS (SELECT count(*) AS n, min("Time") AS tmin, max("Time") AS tmax, min(Amount) AS amin, max(Amount) AS amax, count(CASE WHEN Class = 1 THEN 1 END) AS n1,
  count(CASE WHEN Class = 0 THEN 1 END) AS n0, bool_and(coalesce(Class IN (0, 1), false)) AS cv FROM transactions)""",
        "k AS (SELECT *, greatest(n0, n1) AS nmax, least(CASE WHEN n0 > 0 THEN n0 ELSE n1 END, CASE WHEN n1 > 0 THEN n1 ELSE n0 END) AS nmin FROM s)",
    )
    + """SELECT 'run1' AS run, 'check_data' AS step, 'status' AS key, CASE WHEN n >= 1000 AND tmin >= 0 AND tmax <= 200000.0 AND amin >= 0 AND amax <= 30000.0 AND cv THEN 'success' ELSE 'failed' END AS value FROM k
UNION ALL SELECT 'run1', 'check_data', 'rows_count', CAST(n AS VARCHAR) FROM k
UNION ALL SELECT 'run1', 'check_data', 'fraud_percentage', printf('%.6f', n1 * 100.0::DOUBLE / n) FROM k
UNION ALL SELECT 'run1', 'class_balance', 'imbalance_ratio', printf('%.6f', nmax::DOUBLE / nmin) FROM k
UNION ALL SELECT 'run1', 'class_balance', 'minority_class', CASE WHEN n1 = 0 THEN '0' WHEN n0 = 0 THEN '1' WHEN n1 < n0 THEN '1' ELSE '0' END FROM k
UNION ALL SELECT 'run1', 'business_30d', 'status', CASE WHEN tmin >= 0 AND tmax <= 2592000.0 AND amin >= 0 AND amax <= 30000.0 AND cv THEN 'success' ELSE 'failed' END FROM k""",
)
def s5_pipeline_report(spark, sf):
    """Run report rows (step, key, value) from the check, balance and range steps, written to the
    sink as a run, twice, and read back."""
    root = os.path.join(ensure_checkpoint_dir(spark), "reports", uuid.uuid4().hex)
    report = _report(spark, sf)
    for _ in range(2):
        rp.write_report(report, root, "run1")
    return rp.read_reports(spark, root, ["run1", "never_written"]).drop("position")


_MISS_ALL = " + ".join(f"CAST({c} IS NULL OR isnan({c}) AS BIGINT)" for c in ['"Time"', *[f"V{i}" for i in range(1, 29)], "Amount"]) + " + CAST(Class IS NULL AS BIGINT)"


@query(
    "d15_global_status",
    with_ctes(
        TX,
        f"""s AS (SELECT count(*) AS n, sum({_MISS_ALL}) AS miss, min("Time") AS tmin, max("Time") AS tmax, min(Amount) AS amin, max(Amount) AS amax,
  bool_and(coalesce(Class IN (0, 1), false)) AS cv FROM transactions)""",
        """st AS (SELECT 'check_data' AS step, CASE WHEN n >= 1000 AND miss * 100.0 / (n * 31) <= 5.0 AND tmin >= 0 AND tmax <= 200000.0
    AND amin >= 0 AND amax <= 30000.0 AND cv THEN 'success' ELSE 'failed' END AS status FROM s
  UNION ALL SELECT 'class_balance', NULL FROM s
  UNION ALL SELECT 'business_30d', CASE WHEN tmin >= 0 AND tmax <= 2592000.0 AND amin >= 0 AND amax <= 30000.0 AND cv THEN 'success' ELSE 'failed' END FROM s)""",
    )
    + "SELECT CASE WHEN bool_or(status = 'failed') THEN 'failed' ELSE 'success' END AS global_status, count(DISTINCT step) AS steps FROM st",
)
def d15_global_status(spark, sf):
    """Failed if any step failed (the 200,000 s Time bound fails on 30 days)."""
    return rp.global_status(_report(spark, sf))
