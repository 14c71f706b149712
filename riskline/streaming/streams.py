"""Structured Streaming operators X1-X5 and the metric sink S7.

Sources are file streams over the input tables (a Kafka source plugs in the same
way: only ``readStream`` changes).  Event time must be ``timestamp``: the fixture's
``timestamp_ntz`` is cast first (N16), with the session time zone in UTC.

Windowed aggregates run in ``update`` mode with a watermark (bounded state) and a
``foreachBatch`` sink that appends each micro-batch's updated rows with its batch
id; the current state of a key is its row from the latest batch.  This is the
upsert pattern for sinks without MERGE.  With one batch, or files in time order, the final state
equals the batch result, windows that the watermark has not closed yet included; rows that come
later than the watermark allows are dropped, and ``run_counted`` counts them.

Every run writes under ``spark.checkpoint.dir`` (the cluster's shared folder): output, stream
checkpoint and the upsert log.  A run has a folder of its own unless one is named
(``run_counted``, ``monitor.run_monitor``): only a run in a named folder goes on where the one
before stopped.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskline.session import ensure_checkpoint_dir
from riskline.sources.tables import table_path

WATERMARK = "10 minutes"


def run_dir(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def event_stream(spark: SparkSession, sf_dir: str, table: str = "events", max_files: int | None = None) -> DataFrame:
    """File-source stream of one input table (S6), event time cast to timestamp.

    A table may be one file or a folder of files in any order of time.  By default all files
    that wait make one batch, so the watermark, which moves between batches, drops none of a
    backlog's rows; ``max_files`` bounds a batch for a source whose files come in time order.
    """
    path = table_path(sf_dir, table)
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(conf).getFileStatus(at).isDirectory():
        s = reader.parquet(path)
    else:
        s = reader.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path))
    if "ts" in s.columns:
        s = s.withColumn("ts", F.col("ts").cast("timestamp"))
    return s


def run_append(stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream to completion (availableNow) into parquet; read it back."""
    spark = stream.sparkSession
    d = run_dir(spark, name)
    q = (stream.writeStream.format("parquet").option("path", os.path.join(d, "out"))
         .option("checkpointLocation", os.path.join(d, "checkpoint")).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(os.path.join(d, "out"))


def run_observed(stream: DataFrame, name: str, metric: str) -> tuple[DataFrame, dict[str, int]]:
    """:func:`run_append`, and the sums over all batches of the counts observed as ``metric``."""
    spark = stream.sparkSession
    d = run_dir(spark, name)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1000000")
    try:
        q = (stream.writeStream.format("parquet").option("path", os.path.join(d, "out"))
             .option("checkpointLocation", os.path.join(d, "checkpoint")).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    sums: dict[str, int] = {}
    for p in q.recentProgress:
        if metric in p.observedMetrics:
            for k, v in p.observedMetrics[metric].asDict().items():
                sums[k] = sums.get(k, 0) + (v or 0)
    return spark.read.schema(stream.schema).parquet(os.path.join(d, "out")), sums


def run_upsert(stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Run an update-mode aggregate to completion; return the latest row per key."""
    spark = stream.sparkSession
    d = run_dir(spark, name)
    log = os.path.join(d, "log")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(log)

    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", os.path.join(d, "checkpoint"))
         .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()
    values = [c for c in stream.columns if c not in keys]
    schema = stream.schema.add("_batch", "long")
    hist = spark.read.schema(schema).parquet(log)
    latest = hist.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("_batch")).alias("_v"))
    return latest.select(*keys, "_v.*")


LATE = "batch_id long, input_rows long, kept_rows long, late_rows long, watermark string"


def run_counted(source: DataFrame, windows, name: str, keys: list[str], count: str, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Like :func:`run_upsert` of ``windows(source)``, and beside the result a table of the
    rows that came too late: (result, late).

    ``count`` names the aggregate that counts a window's rows.  Rows are counted as they enter
    (``observe``), so per batch late rows are those that no window has gained.  Spark's own figure
    of dropped rows is no count of rows where they are summed before the watermark is applied; it
    must be zero or not together with ours.  The table is written as ``late`` in the run's folder.
    """
    spark = source.sparkSession
    d = folder or run_dir(spark, name)
    log = os.path.join(d, "log")
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1000000")
    try:
        stream = windows(source.observe("entered", F.count(F.lit(1)).alias("rows")))

        def sink(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(os.path.join(log, f"_batch={batch_id}"))

        q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", os.path.join(d, "checkpoint"))
             .outputMode("update").trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    hist = spark.read.schema(stream.schema.add("_batch", "long")).parquet(log)
    values = [c for c in stream.columns if c not in keys]
    result = hist.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("_batch")).alias("_v")).select(*keys, "_v.*")
    before = F.lag(count, 1, 0).over(Window.partitionBy(*keys).orderBy("_batch"))  # a window's rows: one per batch
    gained = hist.withColumn("_gain", F.col(count) - before).groupBy(F.col("_batch").alias("batch_id")).agg(F.sum("_gain").alias("kept_rows"))
    seen = {}  # one row per batch
    for p in q.recentProgress:
        if "entered" in p.observedMetrics:
            rows, state = p.observedMetrics["entered"].rows, p.stateOperators[0]
            old = seen.get(p.batchId, (p.batchId, 0, 0, None))
            seen[p.batchId] = (p.batchId, old[1] + rows, old[2] + state.numRowsDroppedByWatermark, p.eventTime.get("watermark", old[3]))
    entered = spark.createDataFrame(list(seen.values()), "batch_id long, input_rows long, dropped long, watermark string")
    late = entered.join(gained, "batch_id", "left").select(
        "batch_id", "input_rows", F.coalesce("kept_rows", F.lit(0)).cast("long").alias("kept_rows"), "dropped", "watermark")
    late = late.withColumn("late_rows", F.col("input_rows") - F.col("kept_rows"))
    late = late.withColumn("late_rows", F.when((F.col("late_rows") > 0) != (F.col("dropped") > 0), F.raise_error(F.lit("late rows and dropped rows disagree"))).otherwise(F.col("late_rows")))
    path = os.path.join(d, "late")
    late.select(*[c.split()[0] for c in LATE.split(", ")]).write.mode("overwrite").parquet(path)
    return result, spark.read.schema(LATE).parquet(path)


def ingestion_windows(events: DataFrame, width: str = "10 minutes", watermark: str = WATERMARK) -> DataFrame:
    """Tumbling volume / mean response / error rate per window."""
    w = F.window("ts", width)
    return (events.withWatermark("ts", watermark).groupBy(w.alias("w"))
            .agg(F.count(F.lit(1)).alias("volume"), F.avg("value").alias("response_time_ms"),
                 F.avg((F.col("event_type") == "error").cast("double")).alias("error_rate"))
            .select(F.col("w.start").alias("window_start"), "volume", "response_time_ms", "error_rate"))


def incidents_by_ip_hour(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Malicious events per source IP and hour window."""
    mal = events.where(F.col("event_type") == "error").withColumn("source_ip", F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")))
    return (mal.withWatermark("ts", watermark).groupBy(F.window("ts", "1 hour").alias("w"), "source_ip")
            .agg(F.count(F.lit(1)).alias("incidents"))
            .select(F.col("w.start").alias("hour_start"), "source_ip", "incidents"))


def scored_events(events: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Per-event label and deterministic score (the ``scored`` view, without features)."""
    y = ((F.col("event_type") == "error") & (F.col("value") > 150)).cast("int")
    score = F.pmod(F.col("event_id") * F.lit(48271), F.lit(1000)) / F.lit(1000.0) * F.lit(0.5) + y * F.lit(0.5)
    return events.select("event_id", "ts", y.alias("y_true"), score.alias("score"), (score >= F.lit(0.7)).cast("int").alias("y_pred"), *keep)


def metric_counts(scored: DataFrame, watermark: str = WATERMARK, width: str = "1 day") -> DataFrame:
    """Confusion counts per event-time window (the metric sink's rows)."""
    t, p = F.col("y_true") == 1, F.col("y_pred") == 1
    c = lambda cond: F.count(F.when(cond, F.lit(1)))
    return (scored.withWatermark("ts", watermark).groupBy(F.window("ts", width).alias("w"))
            .agg(c(t & p).alias("tp"), c(~t & p).alias("fp"), c(t & ~p).alias("fn"), c(~t & ~p).alias("tn"))
            .select(F.col("w.start").alias("window_start"), "tp", "fp", "fn", "tn"))


def dedup_stream(events: DataFrame, key: str = "event_id", watermark: str = WATERMARK) -> DataFrame:
    """Drop repeated keys within the watermark delay (state bounded by the delay)."""
    return events.withWatermark("ts", watermark).dropDuplicatesWithinWatermark([key])
