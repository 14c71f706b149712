"""Queries: oversampling with noise, Gaussian copula, generator ranking, isolation
forest (B4-B9, D9, D11)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from riskline.functions.rng import lcg_uniform_sql
from riskline.operators import balance as bl
from riskline.operators import copula as cp
from riskline.operators import generators as gn
from riskline.operators import logs as lg
from riskline.operators.anomaly import isolation_forest
from riskline.operators.featurize import enrich
from riskline.plans.registry import query
from riskline.plans.sql import FEAT, TX, with_ctes
from riskline.sources import fixtures as fx
from riskline.sources.staging import stage

_F = bl.SMOTE_FEATURES
_Q = ['"Time"' if c == "Time" else c for c in _F]
_BASE_COLS = ["Time", *[f"V{i}" for i in range(1, 29)], "Amount"]


def _noise_sql(i: int) -> str:
    u1 = f"greatest({lcg_uniform_sql('g.j', str(100 + 2 * i))}, 1e-12)"
    u2 = lcg_uniform_sql("g.j", str(101 + 2 * i))
    return f"sqrt(-2.0 * ln({u1})) * cos({2 * math.pi!r} * {u2})"


@query(
    "b4_oversample_noise",
    with_ctes(
        TX, FEAT,
        "mino AS (SELECT event_id, " + ", ".join(_Q) + ", row_number() OVER (ORDER BY event_id) AS rn FROM feat WHERE Class = 1)",
        "cnt AS (SELECT count(CASE WHEN Class = 1 THEN 1 END) AS n_min, count(CASE WHEN Class <> 1 THEN 1 END) AS n_maj FROM feat)",
        "sd AS (SELECT " + ", ".join(f"stddev_samp({c}) AS s_{i}" for i, c in enumerate(_Q)) + " FROM mino)",
        "g AS (SELECT j, j % n_min + 1 AS rn FROM (SELECT unnest(range(0, CAST(floor(CAST(0.1 AS DOUBLE) * n_maj) AS BIGINT) - n_min)) AS j, n_min FROM cnt))",
    )
    + "SELECT g.j AS synthetic_id, m.event_id AS base_id, "
    + ", ".join(f"round(m.{c} + (0.01 * sd.s_{i}) * {_noise_sql(i)}, 6) AS {c}" for i, c in enumerate(_Q))
    + ", 1 AS Class FROM g JOIN mino m ON m.rn = g.rn, sd",
)
def b4_oversample_noise(spark, sf):
    """Minority rows duplicated round-robin with 1 % Gaussian noise (seeded)."""
    s = bl.oversample_with_noise(enrich(fx.transactions(spark, sf)), _F)
    if s is None:
        return spark.createDataFrame([], "synthetic_id bigint, base_id bigint, " + ", ".join(f"{c} double" for c in _F) + ", Class int")
    return s.select("synthetic_id", "base_id", *[F.round(c, 6).alias(c) for c in _F], "Class")


@query("b5_gaussian_copula")
def b5_gaussian_copula(spark, sf):
    """2000 copula rows fitted on the fraud rows (normal rows + synthetic, N11)."""
    tx = fx.transactions(spark, sf)
    syn = cp.gaussian_copula(tx, _BASE_COLS)
    if syn is None:
        return spark.createDataFrame([], ", ".join(f"`{c}` double" for c in _BASE_COLS) + ", Class int")
    return bl.balanced_dataset(tx, syn, _BASE_COLS, keep_original_minority=False)


@query("b6_b9_generators_ranked")
def b6_b9_generators_ranked(spark, sf):
    """Run every enabled generator with the reference's parameters, score it by 1 -
    discriminator accuracy, sort by quality, band; what fails has a row with its error."""
    e = stage(enrich(fx.transactions(spark, sf)).select("event_id", "Class", *_F), "transactions")
    return gn.evaluate(e, gn.generate_all(e, _F), _F)


@query(
    "b9_balanced_datasets",
    with_ctes(
        TX,
        "c AS (SELECT count(CASE WHEN Class = 1 THEN 1 END) AS n_min, count(CASE WHEN Class <> 1 THEN 1 END) AS n_maj FROM transactions)",
        "m AS (SELECT *, greatest(CAST(floor(CAST(0.2 AS DOUBLE) * n_maj) AS BIGINT) - n_min, 0) AS more FROM c)",
    )
    + """SELECT 'smote' AS method, CASE WHEN more > 0 AND n_min > 5 THEN 'success' ELSE 'none' END AS status, n_maj AS majority, n_min + CASE WHEN n_min > 5 THEN more ELSE 0 END AS minority FROM m
UNION ALL SELECT 'simple_oversampling', CASE WHEN more > 0 AND n_min > 0 THEN 'success' ELSE 'none' END, n_maj, n_min + CASE WHEN n_min > 0 THEN more ELSE 0 END FROM m
UNION ALL SELECT 'gaussian_copula', CASE WHEN n_min >= 10 THEN 'success' ELSE 'none' END, n_maj, CASE WHEN n_min >= 10 THEN 2000 ELSE n_min END FROM m
UNION ALL SELECT 'no_such_method', 'failed', n_maj, n_min FROM m""",
)
def b9_balanced_datasets(spark, sf):
    """The table balanced to a ratio of 0.2 by several methods; an unknown one leaves it as it is."""
    e = stage(enrich(fx.transactions(spark, sf)).select("event_id", "Class", *_F), "transactions")
    out = None
    for method in ("smote", "simple_oversampling", "gaussian_copula", "no_such_method"):
        rows, got = gn.create_balanced_dataset(e, _F, method, 0.2)
        one = rows.agg(F.count_if(F.col("Class") != 1).alias("majority"), F.count_if(F.col("Class") == 1).alias("minority")).select(F.lit(method).alias("method"), F.lit(got.status).alias("status"), "majority", "minority")
        out = one if out is None else out.unionByName(one)
    return out


@query("d9_isolation_forest")
def d9_isolation_forest(spark, sf):
    """Isolation forest (100 trees, 256 samples, contamination .1) on ingestion windows."""
    ing = fx.ingestion(spark, sf).withColumn("_k", F.unix_seconds("window_start"))
    out = isolation_forest(ing, ["volume", "response_time_ms", "error_rate"], "_k")
    return out.select("window_start", "volume", "response_time_ms", "error_rate", F.round("anomaly_score", 6).alias("anomaly_score"),
                      "detected_anomaly")


@query("d11_forest_evaluation")
def d11_forest_evaluation(spark, sf):
    """D11 with the isolation-forest detector against windows with error rate >= 50 %."""
    ing = fx.ingestion(spark, sf).withColumn("_k", F.unix_seconds("window_start"))
    out = isolation_forest(ing, ["volume", "response_time_ms", "error_rate"], "_k")
    return lg.detector_evaluation(out, F.col("error_rate") >= 0.5)
