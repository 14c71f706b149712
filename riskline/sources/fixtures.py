"""Fixture views over the generated tables (see FIXTURES.md).

``transactions`` reshapes ``events`` + ``embeddings`` into the card-transaction
schema (Time, V1..V28, Amount, Class) plus the row key ``event_id``.  The other
views (``scored``, ``ingestion``, ``logs``, ``labels_binary``, ``lineitem_amounts``)
are derived from it or from the raw tables, so their work grows with the data.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.functions.features import V_COLS
from riskline.sources.tables import read_table

BASE_COLUMNS = ["Time", *V_COLS, "Amount", "Class"]
EPOCH = "2024-01-01 00:00:00"


def seconds_since(ts_col: str, epoch: str = EPOCH):
    """Exact seconds (micro precision) between ``epoch`` and a timestamp column."""
    ts = F.col(ts_col).cast("timestamp")
    return (F.unix_micros(ts) - F.unix_micros(F.lit(epoch).cast("timestamp"))) / F.lit(1e6)


_ROWS: weakref.WeakKeyDictionary[DataFrame, int] = weakref.WeakKeyDictionary()


def _rows_of(spark: SparkSession, sf_dir: str) -> int:
    relation = read_table(spark, sf_dir, "embeddings")
    if relation not in _ROWS:
        _ROWS[relation] = relation.count()
    return _ROWS[relation]


def transactions(spark: SparkSession, sf_dir: str, *, with_key: bool = True) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n_vec = _rows_of(spark, sf_dir)  # from the files' footers
    # no hint: Spark broadcasts the vectors where their bytes are few, and AQE where they prove so
    joined = ev.join(emb, F.pmod(ev["event_id"], F.lit(n_vec)) == emb["vec_id"])
    cols = ["event_id"] if with_key else []
    cols.append(f"(unix_micros(CAST(ts AS TIMESTAMP)) - unix_micros(TIMESTAMP '{EPOCH}')) / 1e6 AS `Time`")
    cols += [f"CAST(embedding[{i}] AS DOUBLE) * 8.0 AS V{i + 1}" for i in range(28)]
    cols.append("value AS Amount")
    cols.append("CAST(event_type = 'error' AND value > 150 AS INT) AS Class")
    return joined.selectExpr(*cols)


def transactions_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``transactions`` with Amount blanked on every 97th key (imputation input)."""
    tx = transactions(spark, sf_dir)
    return tx.withColumn(
        "Amount", F.when(F.pmod(F.col("event_id"), F.lit(97)) == 0, F.lit(None).cast("double")).otherwise(F.col("Amount"))
    )


def transactions_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``transactions`` (without key) plus an exact copy of every 10th row (dedup input)."""
    tx = transactions(spark, sf_dir)
    dup = tx.where(F.pmod(F.col("event_id"), F.lit(10)) == 0)
    return tx.unionByName(dup).drop("event_id")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic predictions: score = pmod(event_id*48271,1000)/1000*.5 + Class*.5; y_pred = score >= .7."""
    tx = transactions(spark, sf_dir)
    u = F.pmod(F.col("event_id") * F.lit(48271), F.lit(1000)) / F.lit(1000.0)
    score = u * F.lit(0.5) + F.col("Class") * F.lit(0.5)
    return tx.select(
        "event_id",
        F.col("Class").alias("y_true"),
        score.alias("score"),
        (score >= F.lit(0.7)).cast("int").alias("y_pred"),
        "Amount",
        "Time",
    )


def ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-minute ingestion windows from ``events`` (volume, mean response, error rate)."""
    ev = read_table(spark, sf_dir, "events")
    w = F.window(F.col("ts").cast("timestamp"), "10 minutes")
    return (
        ev.groupBy(w.alias("w"))
        .agg(
            F.count(F.lit(1)).alias("volume"),
            F.avg("value").alias("response_time_ms"),
            F.avg((F.col("event_type") == "error").cast("double")).alias("error_rate"),
        )
        .select(F.col("w.start").alias("window_start"), "volume", "response_time_ms", "error_rate")
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Security-log view over ``events``."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.col("event_type").alias("message"),
        F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")).alias("source_ip"),
        (F.col("event_type") == "error").alias("is_malicious"),
    )


def labels_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")


def lineitem_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("Amount"))


def monitoring_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched transactions with the deterministic ``scored`` prediction columns."""
    from riskline.operators.featurize import enrich

    tx = enrich(transactions(spark, sf_dir))
    u = F.pmod(F.col("event_id") * F.lit(48271), F.lit(1000)) / F.lit(1000.0)
    score = u * F.lit(0.5) + F.col("Class") * F.lit(0.5)
    return tx.select("event_id", F.col("Class").alias("y_true"), score.alias("score"),
                     (score >= F.lit(0.7)).cast("int").alias("y_pred"), "Amount", "Hour", "PCA_Magnitude",
                     "Is_Night", "PCA_Extreme_Count", "Time")


def model_predictions(spark: SparkSession, sf_dir: str, threshold: float = 0.7) -> DataFrame:
    """Three deterministic scorers over the same rows (model comparison input)."""
    m = monitoring_input(spark, sf_dir)
    scores = {
        "lcg_blend": F.col("score"),
        "amount_scaled": F.least(F.col("Amount") / F.lit(300.0), F.lit(1.0)),
        "extreme_night": (F.col("PCA_Extreme_Count") > 0).cast("double") * F.lit(0.5) + F.col("Is_Night") * F.lit(0.5),
    }
    parts = [
        m.select(F.lit(name).alias("model"), "event_id", "y_true", s.alias("score"),
                 (s >= F.lit(threshold)).cast("int").alias("y_pred"))
        for name, s in scores.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
