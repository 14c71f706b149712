"""Queries: scans, validation, class balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskline.operators import validate as val
from riskline.plans.registry import query
from riskline.plans.sql import BASE_COLS, TX, V, with_ctes
from riskline.sources import fixtures as fx

_MISS = " + ".join(f"CAST({c} IS NULL OR isnan({c}) AS BIGINT)" for c in ['"Time"', *V, "Amount"]) + " + CAST(Class IS NULL AS BIGINT)"


def _base(spark, sf):
    return fx.transactions(spark, sf).select(*fx.BASE_COLUMNS)


def _quality_sql(n_cols: int) -> str:
    pct = f"s.miss * 100.0 / (s.n * {n_cols})"
    return f"""CASE WHEN s.n = 0 THEN false WHEN s.n < 1000 THEN false WHEN {pct} > 5.0 THEN false ELSE true END AS is_valid,
  CASE WHEN s.n = 0 THEN 'Dataset vide'
       WHEN s.n < 1000 THEN printf('Trop peu de lignes: %d < 1000', s.n)
       WHEN {pct} > 5.0 THEN printf('Trop de valeurs manquantes: %.2f%% > 5.0%%', {pct})
       ELSE 'Dataset valide' END AS message,
  s.n AS rows_count,
  {n_cols} AS columns_count,
  CASE WHEN s.n = 0 OR s.n < 1000 THEN 0.0 ELSE {pct} END AS missing_percentage"""


@query(
    "v1_dataset_quality",
    with_ctes(TX, f"s AS (SELECT count(*) AS n, CAST(sum({_MISS}) AS BIGINT) AS miss FROM transactions)")
    + f"SELECT {_quality_sql(31)}, '[]' AS missing_columns FROM s",
)
def v1_dataset_quality(spark, sf):
    """V1: ordered data-quality checks on the 31-column transaction table."""
    r = val.dataset_quality(_base(spark, sf))
    return r.withColumn("missing_columns", F.to_json("missing_columns"))


@query(
    "v1_dataset_quality_missing_cols",
    with_ctes(TX, "t AS (SELECT \"Time\", Amount, Class FROM transactions)",
              "s AS (SELECT count(*) AS n, CAST(sum(CAST(\"Time\" IS NULL AS BIGINT) + CAST(Amount IS NULL AS BIGINT) + CAST(Class IS NULL AS BIGINT)) AS BIGINT) AS miss FROM t)")
    + "SELECT false AS is_valid, CASE WHEN n = 0 THEN 'Dataset vide' WHEN n < 1000 THEN printf('Trop peu de lignes: %d < 1000', n) "
    + "ELSE 'Colonnes manquantes: [''V1'', ''V2'']' END AS message, n AS rows_count, 3 AS columns_count, 0.0 AS missing_percentage, "
    + "'[\"V1\",\"V2\"]' AS missing_columns FROM s",
)
def v1_dataset_quality_missing_cols(spark, sf):
    """V1 failure path: required columns absent from a projection."""
    df = fx.transactions(spark, sf).select("Time", "Amount", "Class")
    r = val.dataset_quality(df, required_columns=["Time", "V1", "V2", "Amount", "Class"])
    return r.withColumn("missing_columns", F.to_json("missing_columns"))


@query(
    "v3_business_ranges",
    with_ctes(TX)
    + """SELECT (min("Time") >= 0.0 AND max("Time") <= 200000.0) AS time_range_valid,
  (min(Amount) >= 0.0 AND max(Amount) <= 30000.0) AS amount_range_valid,
  coalesce(min(CAST(coalesce(Class IN (0, 1), false) AS INTEGER)) = 1, true) AS class_values_valid
FROM transactions""",
)
def v3_business_ranges(spark, sf):
    """V3/U4: business range checks with the reference defaults (Time check fails on 30 days)."""
    return val.business_ranges(_base(spark, sf))


@query(
    "v3_business_ranges_30d",
    with_ctes(TX)
    + """SELECT (min("Time") >= 0.0 AND max("Time") <= 2592000.0) AS time_range_valid,
  (min(Amount) >= 0.0 AND max(Amount) <= 30000.0) AS amount_range_valid,
  coalesce(min(CAST(coalesce(Class IN (0, 1), false) AS INTEGER)) = 1, true) AS class_values_valid
FROM transactions""",
)
def v3_business_ranges_30d(spark, sf):
    """V3 with the Time bound widened to 30 days (the fixture span)."""
    return val.business_ranges(_base(spark, sf), time_range=(0.0, 2592000.0))


@query(
    "v4_check_report",
    with_ctes(
        TX,
        f"s AS (SELECT count(*) AS n, CAST(sum({_MISS}) AS BIGINT) AS miss, min(\"Time\") AS tmin, max(\"Time\") AS tmax, "
        "min(Amount) AS amin, max(Amount) AS amax, coalesce(min(CAST(coalesce(Class IN (0,1), false) AS INTEGER)) = 1, true) AS cv, "
        "sum(CASE WHEN Class = 1 THEN 1 ELSE 0 END) AS n1 FROM transactions)",
        "c AS (SELECT Class, count(*) AS cnt FROM transactions WHERE Class IS NOT NULL GROUP BY Class)",
        "d AS (SELECT to_json(map(list(Class ORDER BY Class), list(cnt ORDER BY Class))) AS class_distribution, "
        "max(cnt) AS nmax, min(cnt) AS nmin FROM c)",
    )
    + f"""SELECT CASE WHEN ({_quality_sql(31).split(' AS is_valid')[0]}) AND (s.tmin >= 0.0 AND s.tmax <= 200000.0)
      AND (s.amin >= 0.0 AND s.amax <= 30000.0) AND s.cv THEN 'success' ELSE 'failed' END AS status,
  {_quality_sql(31).split('AS is_valid,')[1]},
  s.n1 * 100.0 / s.n AS fraud_percentage,
  CAST(d.nmax AS DOUBLE) / d.nmin AS imbalance_ratio,
  (s.tmin >= 0.0 AND s.tmax <= 200000.0) AS time_range_valid,
  (s.amin >= 0.0 AND s.amax <= 30000.0) AS amount_range_valid,
  s.cv AS class_values_valid,
  d.class_distribution
FROM s, d""",
)
def v4_check_report(spark, sf):
    """V4: the daily check task's report (quality + ranges + class distribution), one scan."""
    return val.pipeline_check_report(_base(spark, sf))


@query(
    "v5_range_violations",
    with_ctes(TX)
    + """SELECT event_id, "Time", Amount, Class FROM transactions
WHERE NOT ("Time" BETWEEN 0.0 AND 200000.0) OR NOT (Amount BETWEEN 0.0 AND 30000.0) OR NOT coalesce(Class IN (0, 1), false)""",
)
def v5_range_violations(spark, sf):
    """V5: row-level quarantine of range violations (default bounds)."""
    return val.range_violations(fx.transactions(spark, sf)).select("event_id", "Time", "Amount", "Class")


@query(
    "a1_class_balance",
    with_ctes(TX)
    + """SELECT Class AS class, count(*) AS count, count(*) * 100.0 / (SELECT count(*) FROM transactions) AS percentage,
  (SELECT count(*) FROM transactions) AS total_samples
FROM transactions WHERE Class IS NOT NULL GROUP BY Class""",
)
def a1_class_balance(spark, sf):
    """A1: class counts and percentages."""
    return val.class_balance(_base(spark, sf))


@query(
    "a1_class_balance_labels",
    """SELECT toxic AS class, count(*) AS count, count(*) * 100.0 / (SELECT count(*) FROM labels) AS percentage,
  (SELECT count(*) FROM labels) AS total_samples
FROM labels WHERE toxic IS NOT NULL GROUP BY toxic""",
)
def a1_class_balance_labels(spark, sf):
    """A1 on a second binary label table (labels.toxic)."""
    return val.class_balance(fx.labels_binary(spark, sf), label="toxic")


@query(
    "a2_imbalance",
    with_ctes(TX, "c AS (SELECT Class, count(*) AS n FROM transactions WHERE Class IS NOT NULL GROUP BY Class)")
    + """SELECT count(*) AS n_classes, CAST(arg_max(Class, struct_pack(n := n, neg := -Class)) AS INTEGER) AS majority_class,
  CAST(arg_min(Class, struct_pack(n := n, lab := Class)) AS INTEGER) AS minority_class,
  max(n) AS majority_count, min(n) AS minority_count, CAST(max(n) AS DOUBLE) / min(n) AS imbalance_ratio FROM c""",
)
def a2_imbalance(spark, sf):
    """A2: imbalance ratio, minority and majority labels."""
    return val.imbalance_summary(_base(spark, sf))
