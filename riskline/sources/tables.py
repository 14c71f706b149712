"""Parquet table loading."""

from __future__ import annotations

import os
import weakref

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_READ: weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = weakref.WeakKeyDictionary()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one input table.

    The resolved relation (file listing + footer schema) is reused within a session: inputs are
    immutable, and re-listing them for every query costs more than the small-scale queries
    themselves; :func:`forget_tables` drops it for inputs that have changed.  Catalyst still prunes
    columns and pushes filters per query, since each query builds its own plan on the relation."""
    known, path = _READ.setdefault(spark, {}), table_path(sf_dir, name)
    if path not in known:
        known[path] = spark.read.parquet(path)
    return known[path]


def forget_tables(spark: SparkSession) -> None:
    """List the files of all tables anew when they are read next."""
    _READ.pop(spark, None)
