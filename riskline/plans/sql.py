"""DuckDB SQL text for the fixture views, used by the oracles.

The oracle runs on the raw tables (``events``, ``embeddings`` ... registered as views
by the checker), so every fixture view is rebuilt here as a CTE chain.
"""

from __future__ import annotations

V = [f"V{i}" for i in range(1, 29)]

_V_SELECT = ",\n    ".join(f"CAST(em.embedding[{i}] AS DOUBLE) * 8.0 AS V{i}" for i in range(1, 29))

TX = f"""transactions AS (
  SELECT e.event_id,
    (epoch_us(e.ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1e6 AS "Time",
    {_V_SELECT},
    e.value AS Amount,
    CAST(e.event_type = 'error' AND e.value > 150 AS INTEGER) AS Class
  FROM events e
  JOIN embeddings em ON em.vec_id = e.event_id % (SELECT count(*) FROM embeddings)
)"""

BASE_COLS = ['"Time"', *V, "Amount", "Class"]

_SQ = " + ".join(f"{v}*{v}" for v in V)


def extreme_count_sql(t: float = 3.0) -> str:
    return " + ".join(f"CAST(abs({v}) > {t} AS INTEGER)" for v in V)


FEAT = f"""feat0 AS (
  SELECT *,
    ("Time" / 3600.0) % 24.0 AS Hour,
    CAST(floor("Time" / 86400.0) AS INTEGER) AS Day,
    ln(1 + Amount) AS Amount_log,
    CASE WHEN Amount > 200 THEN 3 WHEN Amount > 50 THEN 2 WHEN Amount > 10 THEN 1 ELSE 0 END AS Amount_Category,
    sqrt({_SQ}) AS PCA_Magnitude,
    {extreme_count_sql(3.0)} AS PCA_Extreme_Count
  FROM transactions
),
feat AS (
  SELECT *,
    CAST(Hour >= 22 OR Hour <= 6 AS INTEGER) AS Is_Night,
    CAST(Day % 7 >= 5 AS INTEGER) AS Is_Weekend
  FROM feat0
)"""

SCORED = """scored AS (
  SELECT event_id, Class AS y_true,
    ((event_id * 48271) % 1000) / 1000.0 * 0.5 + Class * 0.5 AS score,
    CAST(((event_id * 48271) % 1000) / 1000.0 * 0.5 + Class * 0.5 >= 0.7 AS INTEGER) AS y_pred,
    Amount, "Time"
  FROM transactions
)"""

INGESTION = """ingestion AS (
  SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start,
    count(*) AS volume,
    avg(value) AS response_time_ms,
    avg(CAST(event_type = 'error' AS DOUBLE)) AS error_rate
  FROM events GROUP BY 1
)"""

LOGS = """logs AS (
  SELECT ts AS "timestamp",
    CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
    event_type AS message,
    '10.0.0.' || CAST(user_id AS VARCHAR) AS source_ip,
    event_type = 'error' AS is_malicious
  FROM events
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
