"""Tables written once under the shared checkpoint folder and read back with column pruning."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskline.session import ensure_checkpoint_dir


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of its own: later passes read only their columns, and a lost
    executor costs only its tasks.  Call :func:`drop_stage` when nothing reads it any more."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), "staged", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the folder of a table from :func:`stage`."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/staged/" in folder:
            delete(df.sparkSession, folder)


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _path(spark, path)
    fs.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _path(spark, path)
    return fs.exists(at)
