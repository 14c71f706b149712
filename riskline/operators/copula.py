"""Gaussian-copula synthetic rows (B5) and quality by a real-vs-synthetic discriminator.

Copula fit on the minority rows only (fewer than 10 rows -> nothing):
  * per-column ranks from the bucketed row-number operator (grouped by column, no
    single-task sort), normal scores z = Phi^-1(rank / (n + 1));
  * correlation of the scores with ``pyspark.ml.stat.Correlation`` (distributed);
    the d x d matrix (d = number of columns, ~30) and its Cholesky factor are the
    only driver-side data;
  * sampling: ``spark.range(num_samples)``; independent normals by Box-Muller on
    seeded per-row uniforms and the Cholesky product in Arrow batches
    (``mapInPandas``: dense d x d algebra is what numpy is for), mapped through Phi and
    the empirical quantile of each column (rank lookup = equi-join), so values stay
    inside the observed min / max (enforce_min_max) and are not rounded.
The marginals are empirical, not a fitted parametric family (SURVEY hard part d).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.functions.rng import lcg_uniform_np
from riskline.functions.stats import norm_ppf
from riskline.operators.explore import to_long
from riskline.operators.ordered import row_numbers
from riskline.operators.split import stratified_split
from riskline.sources.staging import drop_stage, stage

MIN_ROWS = 10
NUM_SAMPLES = 2000


def _norm_cdf_np(x: np.ndarray) -> np.ndarray:
    z = np.abs(x) / math.sqrt(2.0)
    t = 1.0 / (1.0 + 0.3275911 * z)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1.0 - poly * np.exp(-z * z)
    return np.where(x >= 0, 0.5 * (1.0 + erf), 0.5 * (1.0 - erf))


def gaussian_copula(df: DataFrame, features: list[str], label: str = "Class", key: str = "event_id", minority: int = 1,
                    num_samples: int = NUM_SAMPLES, seed: int = 42) -> DataFrame | None:
    spark = df.sparkSession
    mino = df.where(F.col(label) == minority).select(key, *features)
    n = mino.count()
    if n < MIN_ROWS:
        return None
    long = to_long(mino, features, [key]).where(F.col("value").isNotNull())
    ranked = row_numbers(long, ["value", key], group=["feature"], out="rn").checkpoint(eager=True)
    z = ranked.withColumn("z", norm_ppf(F.col("rn") / F.lit(float(n + 1))))
    wide = z.groupBy(key).pivot("feature", features).agg(F.first("z"))
    vec = VectorAssembler(inputCols=features, outputCol="zv", handleInvalid="skip").transform(wide)
    corr = Correlation.corr(vec, "zv", "pearson").first()[0].toArray()
    corr = np.nan_to_num(corr, nan=0.0)
    np.fill_diagonal(corr, 1.0)
    try:
        chol = np.linalg.cholesky(corr)
    except np.linalg.LinAlgError:
        w, v = np.linalg.eigh(corr)
        chol = np.linalg.cholesky(v @ np.diag(np.clip(w, 1e-9, None)) @ v.T)
    d = len(features)
    L = spark.sparkContext.broadcast(chol)  # d x d, d = number of columns (bounded)

    def correlate(batches):
        # Arrow batches of ids -> correlated uniforms; dense d x d algebra in numpy
        for pdf in batches:
            ids = pdf["id"].to_numpy(dtype=np.int64)
            e = np.empty((len(ids), d))
            for i in range(d):
                u1 = np.maximum(lcg_uniform_np(ids, 2 * i + 1, seed), 1e-12)
                u2 = lcg_uniform_np(ids, 2 * i + 2, seed)
                e[:, i] = np.sqrt(-2.0 * np.log(u1)) * np.cos(2 * math.pi * u2)
            u = _norm_cdf_np(e @ L.value.T)
            out = pd.DataFrame(u, columns=features)
            out.insert(0, "synthetic_id", ids)
            yield out

    schema = "synthetic_id long, " + ", ".join(f"`{c}` double" for c in features)
    u = spark.range(num_samples).mapInPandas(correlate, schema)
    counts = ranked.groupBy("feature").agg(F.max("rn").alias("n_f"))
    ul = to_long(u, features, ["synthetic_id"], "feature", "u").join(F.broadcast(counts), "feature")  # one row per column
    ul = ul.withColumn("rn", F.least(F.greatest(F.ceil(F.col("u") * F.col("n_f")), F.lit(1)), F.col("n_f")).cast("bigint"))
    vals = ul.join(ranked.select("feature", "rn", "value"), ["feature", "rn"])
    out = vals.groupBy("synthetic_id").pivot("feature", features).agg(F.first("value"))
    return out.withColumn(label, F.lit(minority))


def discriminator_quality(real: DataFrame, synthetic: DataFrame, features: list[str], trees: int = 100, seed: int = 42) -> float:
    """1 - accuracy of a random forest telling real from synthetic rows on a stratified 30 %
    test split.  Raises what the training raises."""
    both = real.select(*features).withColumn("_is_syn", F.lit(0)).unionByName(synthetic.select(*features).withColumn("_is_syn", F.lit(1)))
    both = stage(both.withColumn("_k", F.monotonically_increasing_id()), "discriminator")  # written with their key
    s = stratified_split(both, key="_k", label="_is_syn", test_size=0.3, val_size=0.0, seed=seed)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"),
                            RandomForestClassifier(labelCol="_is_syn", numTrees=trees, seed=seed)])
    model = pipe.fit(s.where(F.col("split") == "train"))
    acc = MulticlassClassificationEvaluator(labelCol="_is_syn", metricName="accuracy").evaluate(model.transform(s.where(F.col("split") == "test")))
    drop_stage(both)
    return 1.0 - float(acc)
