"""Query registry: id -> (Spark plan builder, optional DuckDB oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable
import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskline.session import tune

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    qid: str
    fn: QueryFn
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def query(qid: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``qid`` with its oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if qid in REGISTRY:
            raise ValueError(f"duplicate query id {qid}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return fn(spark, sf_dir)

        REGISTRY[qid] = Query(qid, run, sql, (fn.__doc__ or "").strip())
        return fn

    return deco
