"""The seeded generator's independence, and streams over tables of several files."""

import numpy as np
from pyspark.sql import functions as F

from riskline.functions.rng import lcg_int, lcg_uniform, lcg_uniform_np
from riskline.streaming import streams as st


def test_generator(spark):
    df = spark.range(20000).select("id", *[lcg_uniform(F.col("id"), s).alias(f"u{s}") for s in range(6)]).orderBy("id").toPandas()
    u = df[[f"u{s}" for s in range(6)]].to_numpy()
    assert np.abs(np.corrcoef(u.T) - np.eye(6)).max() < 0.03
    normal = np.sqrt(-2 * np.log(np.maximum(u[:, 0], 1e-12))) * np.cos(2 * np.pi * u[:, 1])
    assert abs(normal.mean()) < 0.03 and abs(normal.std() - 1) < 0.03
    assert (lcg_uniform_np(df.id.to_numpy()[:50], 3) == u[:50, 3]).all()
    big = spark.range(1).select(lcg_int(F.lit(8 * 10**18)).alias("x")).first().x
    assert 0 <= big < 1 << 60


def test_streams_over_several_files(spark, tmp_path):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.orderBy(F.xxhash64("event_id")).repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    s = st.event_stream(spark, str(tmp_path))
    windows = st.run_upsert(st.ingestion_windows(s), "t1", ["window_start"])
    assert windows.agg(F.sum("volume")).first()[0] == ev.count()
    out = st.run_append(st.dedup_stream(st.event_stream(spark, str(tmp_path))), "t2")
    assert out.count() == ev.select("event_id").distinct().count()
