"""Queries: streaming runs compared with their batch result."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from riskline.operators import drift as dr
from riskline.operators import metrics as mt
from riskline.plans.registry import query
from riskline.plans.q_monitor import ALERTS_SQL, PERIOD_KS_SQL
from riskline.plans.sql import INGESTION, LOGS, with_ctes
from riskline.session import ensure_checkpoint_dir
from riskline.sources.tables import read_table
from riskline.streaming import monitor as mo
from riskline.streaming import streams as st


@query(
    "x1_stream_ingestion_windows",
    with_ctes(INGESTION) + "SELECT window_start, volume, round(response_time_ms, 6) AS response_time_ms, round(error_rate, 6) AS error_rate FROM ingestion",
)
def x1_stream_ingestion_windows(spark, sf):
    """Streamed 10-minute windows from the live file source (watermark 10 min), final state."""
    out = st.run_upsert(st.ingestion_windows(st.event_stream(spark, sf)), "x1", ["window_start"])
    return out.select("window_start", "volume", F.round("response_time_ms", 6).alias("response_time_ms"), F.round("error_rate", 6).alias("error_rate"))


@query(
    "x3_stream_metrics_alerts",
    """WITH s AS (SELECT CAST(event_type = 'error' AND value > 150 AS INTEGER) AS y_true,
    ((event_id * 48271) % 1000) / 1000.0 * 0.5 + CAST(event_type = 'error' AND value > 150 AS INTEGER) * 0.5 AS score FROM events),
c AS (SELECT count(CASE WHEN y_true = 1 AND score >= 0.7 THEN 1 END) AS tp, count(CASE WHEN y_true <> 1 AND score >= 0.7 THEN 1 END) AS fp,
  count(CASE WHEN y_true = 1 AND score < 0.7 THEN 1 END) AS fn, count(CASE WHEN y_true <> 1 AND score < 0.7 THEN 1 END) AS tn FROM s),
r AS (SELECT tp, fp, fn, tn, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS detection_rate,
  coalesce(CAST(fp AS DOUBLE) / nullif(fp + tn, 0), 0.0) AS false_positive_rate FROM c)
SELECT tp, fp, fn, tn, round(detection_rate, 6) AS detection_rate, round(false_positive_rate, 6) AS false_positive_rate,
  CASE WHEN detection_rate < 0.7 THEN 'CRITIQUE' WHEN detection_rate < 0.8 THEN 'ATTENTION' END AS detection_alert,
  CASE WHEN false_positive_rate > 0.02 THEN 'CRITIQUE' WHEN false_positive_rate > 0.01 THEN 'ATTENTION' END AS fp_alert FROM r""",
)
def x3_stream_metrics_alerts(spark, sf):
    """Streamed confusion counts into a metric sink, then rates and alert levels."""
    sink = st.run_upsert(st.metric_counts(st.scored_events(st.event_stream(spark, sf))), "x3", ["window_start"])
    tot = sink.agg(*[F.sum(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")])
    r = mt.rates(tot)
    det, fp = F.col("recall"), F.col("fp_rate")
    return r.select(
        "tp", "fp", "fn", "tn", F.round(det, 6).alias("detection_rate"), F.round(fp, 6).alias("false_positive_rate"),
        F.when(det < dr.DETECTION_CRITICAL, dr.CRITICAL).when(det < dr.DETECTION_WARNING, dr.WARNING).alias("detection_alert"),
        F.when(fp > dr.FP_CRITICAL, dr.CRITICAL).when(fp > dr.FP_WARNING, dr.WARNING).alias("fp_alert"),
    )


@query(
    "x4_stream_incidents_by_ip_hour",
    with_ctes(LOGS) + "SELECT date_trunc('hour', \"timestamp\") AS hour_start, source_ip, count(*) AS incidents FROM logs WHERE is_malicious GROUP BY 1, 2",
)
def x4_stream_incidents_by_ip_hour(spark, sf):
    """Streamed malicious-event counts per IP and hour, final state."""
    return st.run_upsert(st.incidents_by_ip_hour(st.event_stream(spark, sf)), "x4", ["hour_start", "source_ip"])


@query(
    "x5_stream_dedup",
    "SELECT count(*) AS rows_out, count(DISTINCT event_id) AS distinct_ids FROM events",
)
def x5_stream_dedup(spark, sf):
    """The event stream unioned with a replay of every 10th event, deduplicated by id."""
    ev = st.event_stream(spark, sf)
    replay = st.event_stream(spark, sf).where(F.pmod(F.col("event_id"), F.lit(10)) == 0)
    out = st.run_append(st.dedup_stream(ev.unionByName(replay)), "x5")
    return out.agg(F.count(F.lit(1)).alias("rows_out"), F.countDistinct("event_id").alias("distinct_ids"))


def _as_files(spark, sf, files, name):
    """The event table as so many files, one after the other, each over the whole time."""
    path = os.path.join(ensure_checkpoint_dir(spark), "io", f"{name}-{uuid.uuid4().hex[:12]}")
    events = read_table(spark, sf, "events")
    for k in range(files):
        events.where(F.pmod("event_id", F.lit(files)) == k).coalesce(1).write.mode("append").parquet(os.path.join(path, "events.parquet"))
    return path


# A batch drops what is late by the watermark that held in the batch before it: the newest time of
# the batches up to two before, less the delay.
_LATE_SQL = """e AS (SELECT event_id % 4 AS batch_id, ts, time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' AS closes FROM events{where}),
wm AS (SELECT batch_id, max(max(ts)) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL '{delay}' AS watermark FROM e GROUP BY batch_id)
SELECT batch_id, count(*) AS input_rows, count(CASE WHEN watermark IS NULL OR {closes} > watermark THEN 1 END) AS kept_rows,
  count(CASE WHEN {closes} <= watermark THEN 1 END) AS late_rows FROM e JOIN wm USING (batch_id) GROUP BY batch_id"""


@query("x1_stream_late_rows", "WITH " + _LATE_SQL.format(where="", delay="5 days", closes="closes"))
def x1_stream_late_rows(spark, sf):
    """Events in four batches, each over the whole time: rows that came within five days of
    the newest are kept in their windows, the others counted as late, per batch."""
    source = st.event_stream(spark, _as_files(spark, sf, 4, "late"), max_files=1)
    _, late = st.run_counted(source, lambda e: st.ingestion_windows(e, watermark="5 days"), "x1late", ["window_start"], "volume")
    return late.where("input_rows > 0").select("batch_id", "input_rows", "kept_rows", "late_rows")


@query(
    "x4_stream_late_incidents",
    "WITH " + _LATE_SQL.format(where=" WHERE event_type = 'error'", delay="10 minutes", closes="(date_trunc('hour', ts) + INTERVAL '1 hour')"),
)
def x4_stream_late_incidents(spark, sf):
    """Incidents by address and hour of a backlog in any order of time, with the late rows counted."""
    source = st.event_stream(spark, _as_files(spark, sf, 4, "late"), max_files=1).where(F.col("event_type") == "error")
    _, late = st.run_counted(source, st.incidents_by_ip_hour, "x4late", ["hour_start", "source_ip"], "incidents")
    return late.where("input_rows > 0").select("batch_id", "input_rows", "kept_rows", "late_rows")


_BASELINE_DAYS = 7
_MONITOR_FEATURES = ["Amount", "Hour"]
_MONITOR_SQL = with_ctes(
    """t AS (SELECT value AS Amount, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1e6 AS s, CAST(event_type = 'error' AND value > 150 AS INTEGER) AS y_true, event_id FROM events)""",
    f"""p AS (SELECT Amount, (s / 3600.0) % 24.0 AS Hour, CASE WHEN s < {_BASELINE_DAYS} * 86400 THEN 0 ELSE CAST(floor(s / 86400) AS INTEGER) END AS period, y_true,
    CAST(((event_id * 48271) % 1000) / 1000.0 * 0.5 + y_true * 0.5 >= 0.7 AS INTEGER) AS y_pred FROM t)""",
    "long AS (" + " UNION ALL ".join(f"SELECT period, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM p" for c in _MONITOR_FEATURES) + ")",
    PERIOD_KS_SQL,
)


def _monitored(spark, sf):
    rows = st.event_stream(spark, _as_files(spark, sf, 3, "monitor"), max_files=1)
    plain = read_table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))

    def features(e):
        scored = st.scored_events(e.withColumn("Amount", F.col("value")), ["Amount"])
        s = (F.unix_micros("ts") - F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))) / F.lit(1e6)
        return scored.select("*", F.pmod(s / F.lit(3600.0), F.lit(24.0)).alias("Hour"), F.floor(s / F.lit(86400)).cast("int").alias("period"))

    folder = st.run_dir(spark, "x3monitor")
    return mo.run_monitor(features(rows).where(F.col("period") >= _BASELINE_DAYS), features(plain).where(F.col("period") < _BASELINE_DAYS), folder, _MONITOR_FEATURES)


@query(
    "x3_stream_period_monitor",
    _MONITOR_SQL + "SELECT period, CAST((SELECT count(*) FROM p WHERE p.period = mon.period) AS BIGINT) AS n, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in ("detection_rate", "false_positive_rate", "precision", "f1_score", "data_drift_score")) + " FROM mon",
)
def x3_stream_period_monitor(spark, sf):
    """Days monitored in the stream against the first week, over three batches that each add
    rows to every day; the days' rows after the last batch."""
    status, _ = _monitored(spark, sf)
    return status.select("period", "n", *[F.round(c, 6).alias(c) for c in ("detection_rate", "false_positive_rate", "precision", "f1_score", "data_drift_score")])


@query(
    "x3_stream_period_alerts",
    _MONITOR_SQL + ", " + ALERTS_SQL + " SELECT period, type, metric, round(value, 6) AS value, message, action FROM al WHERE type IS NOT NULL",
)
def x3_stream_period_alerts(spark, sf):
    """The alerts of the streamed days after the last batch."""
    _, alerts = _monitored(spark, sf)
    return alerts.select("period", "type", "metric", F.round("value", 6).alias("value"), "message", "action")
