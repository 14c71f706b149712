"""Versioned artifacts with an index that is written last.

A run's artifacts lie in ``<out_dir>/<prefix>/run=<run>``: models by the ``pyspark.ml`` writers,
DataFrames as Parquet, everything else as JSON.  The index names them and is the commit marker:
it is deleted before a run writes and written after all else, and a reader only goes by a whole
index, so it never sees half a run.  A run that is repeated replaces its own folder alone.
"""

from __future__ import annotations

import datetime
import json
import os

from pyspark.ml.util import DefaultParamsReader, MLWritable
from pyspark.sql import DataFrame, SparkSession

from riskline.sources.staging import delete, exists

_INDEX = "prefix string, run string, saved_at string, name string, kind string, path string"


def _folder(out_dir: str, prefix: str, run: str) -> str:
    if not run or "/" in run or "=" in run:
        raise ValueError(f"not a run's name: {run!r}")
    return os.path.join(out_dir, prefix, f"run={run}")


def save_artifacts(spark: SparkSession, artifacts: dict[str, object], out_dir: str, run: str, prefix: str = "model") -> str:
    """Write the artifacts of a run and, last, their index; returns the index's path.

    Raises ValueError without artifacts or for a name or a run that is no folder's name, and OSError
    if an artifact can't be written; the run then has no index."""
    if not artifacts:
        raise ValueError("no artifacts to save")
    bad = [n for n in artifacts if not n or "/" in n or n == "index"]
    if bad:
        raise ValueError(f"not an artifact's name: {bad}")
    folder = _folder(out_dir, prefix, run)
    index = os.path.join(folder, "index")
    saved_at = datetime.datetime.now(datetime.timezone.utc).isoformat()
    delete(spark, folder)
    rows = []
    for name, artifact in artifacts.items():
        path = os.path.join(folder, name)
        try:
            kind = _write(spark, artifact, path)
        except Exception as exc:
            raise OSError(f"artifact {name!r} could not be written to {path}") from exc
        rows.append((prefix, run, saved_at, name, kind, path))
    spark.createDataFrame(rows, _INDEX).coalesce(1).write.mode("overwrite").json(index)
    return index


def _write(spark: SparkSession, artifact: object, path: str) -> str:
    if isinstance(artifact, DataFrame):
        artifact.write.mode("overwrite").parquet(path)
        return "table"
    if isinstance(artifact, MLWritable):
        artifact.write().overwrite().save(path)
        return "model"
    text = json.dumps(artifact, sort_keys=True, ensure_ascii=False)  # a TypeError for what JSON can't hold
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return "json"


def load_artifacts(spark: SparkSession, index: str) -> dict[str, object]:
    """The artifacts of an index by name.

    Raises FileNotFoundError if there is no whole index (none, or a run that was cut off), and
    OSError if an artifact that it names can't be read."""
    if not exists(spark, os.path.join(index, "_SUCCESS")):
        raise FileNotFoundError(index)
    out = {}
    for row in spark.read.schema(_INDEX).json(index).collect():  # a row per artifact
        try:
            out[row["name"]] = _read(spark, row["kind"], row["path"])
        except Exception as exc:
            raise OSError(f"artifact {row['name']!r} could not be read from {row['path']}") from exc
    return out


def _read(spark: SparkSession, kind: str, path: str) -> object:
    if kind == "table":
        return spark.read.parquet(path)
    if kind == "model":
        return DefaultParamsReader.loadParamsInstance(path, spark)
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def committed_runs(spark: SparkSession, out_dir: str, prefix: str = "model") -> DataFrame:
    """(prefix, run, saved_at, name, kind, path) of all whole runs; a run without index is not there."""
    root = os.path.join(out_dir, prefix)
    if not exists(spark, root):
        return spark.createDataFrame([], _INDEX)
    return spark.read.schema(_INDEX).option("recursiveFileLookup", True).option("pathGlobFilter", "part-*.json").json(root).where("kind is not null")


def latest_index(spark: SparkSession, out_dir: str, prefix: str = "model") -> str:
    """The index of the run that was saved last; FileNotFoundError without any."""
    last = committed_runs(spark, out_dir, prefix).orderBy("saved_at", ascending=False).select("run").first()
    if last is None:
        raise FileNotFoundError(os.path.join(out_dir, prefix))
    return os.path.join(_folder(out_dir, prefix, last["run"]), "index")
