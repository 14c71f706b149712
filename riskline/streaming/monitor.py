"""Period monitoring in the stream, with an idempotent sink.

Every micro-batch adds its rows' counts to the periods that they belong to and judges these
periods anew: detection rate, false positives, F1 and drift against a fixed baseline (D4), and
the alerts that follow (D5).  The period state are counts: the confusion matrix, and how often
each value of a drift feature occurred.

State and results are tables with a partition per batch.  A batch reads the partitions up to its
own and overwrites its own, so a batch that runs again (after a kill, or by a restart from the
same folder) leaves the same tables; a period's current row is that of its latest batch.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.operators import drift as dr
from riskline.operators.metrics import confusion
from riskline.sources.staging import exists

_CONFUSION = "period int, tp long, fp long, fn long, tn long, n long"
_VALUES = "period int, feature string, value double, c long"
_STATUS = "period int, n long, detection_rate double, false_positive_rate double, precision double, f1_score double, data_drift_score double"
_ALERTS = "period int, type string, metric string, value double, message string, action string"
_TABLES = {"confusion": _CONFUSION, "values": _VALUES, "status": _STATUS, "alerts": _ALERTS}


def _read(spark: SparkSession, folder: str, name: str, upto: int | None = None) -> DataFrame:
    rows = spark.read.schema(f"{_TABLES[name]}, batch int").parquet(os.path.join(folder, name))
    return rows if upto is None else rows.where(F.col("batch") <= upto)


def run_monitor(scored: DataFrame, baseline: DataFrame, folder: str, features: list[str] = dr.DRIFT_FEATURES) -> tuple[DataFrame, DataFrame]:
    """Run the stream ``scored`` (period >= 1, y_true, y_pred, features) to its end and return
    (status, alerts) of every period, as they stand after the last batch.

    ``baseline`` holds the features of the reference rows; the first run in ``folder`` writes its
    counts, later ones keep them.  A run in a folder that was used before goes on after the last
    finished batch."""
    spark = baseline.sparkSession
    base_path = os.path.join(folder, "baseline")
    if not exists(spark, os.path.join(base_path, "_SUCCESS")):
        counts = dr.value_counts(baseline.withColumn("period", F.lit(0)), features)
        counts.select("feature", "value", F.col("c").alias("b")).write.mode("overwrite").parquet(base_path)
    base = spark.read.schema("feature string, value double, b long").parquet(base_path)
    for name, schema in _TABLES.items():  # the tables exist without any batch
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(os.path.join(folder, name, "batch=-1"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession

        def write(name: str, rows: DataFrame) -> None:
            rows.select(*_names(_TABLES[name])).write.mode("overwrite").parquet(os.path.join(folder, name, f"batch={batch_id}"))

        write("confusion", confusion(batch, group=["period"]))
        write("values", dr.value_counts(batch, features))
        touched = _read(session, folder, "confusion").where(F.col("batch") == batch_id).select("period").distinct()
        sums = [F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn", "n")]
        now = _read(session, folder, "confusion", batch_id).join(touched, "period", "left_semi").groupBy("period").agg(*sums)
        values = _read(session, folder, "values", batch_id).join(touched, "period", "left_semi").groupBy("period", "feature", "value").agg(F.sum("c").alias("c"))
        status = dr.monitoring_of(now, dr.ks_of_counts(base, values)).join(now.select("period", "n"), "period")
        write("status", status)
        own = _read(session, folder, "status").where(F.col("batch") == batch_id)
        write("alerts", dr.alerts(own))

    query = scored.writeStream.foreachBatch(sink).option("checkpointLocation", os.path.join(folder, "offsets")).trigger(availableNow=True).start()
    query.awaitTermination()
    status = _read(spark, folder, "status")
    latest = status.groupBy("period").agg(F.max("batch").alias("batch"))
    return status.join(latest, ["period", "batch"]).drop("batch"), _read(spark, folder, "alerts").join(latest, ["period", "batch"]).drop("batch")


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]
