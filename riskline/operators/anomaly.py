"""Isolation forest on ingestion windows.

* Standardise the features (exact mean / population std, one pass).
* Sampling: every row draws one seeded uniform per tree, and the sample of a tree are the 256
  rows of the smallest draws.  A threshold on the draws, a little above 256/N, leaves few more
  rows than that of each tree to be ranked; it is doubled in the rare case that it left fewer.
* Tree building: ``groupBy(tree).applyInPandas`` - each group is one tree's
  bounded sample, grown with numpy (random feature, random split, height limit
  ceil(log2 256)).  Output: the node table (at most 511 rows per tree).
* Scoring: the node tables (T x 511 rows at most, a proven bound) are broadcast to
  an Arrow-batched iterator ``pandas_udf`` that lays out the trees once a task and walks them
  vectorised over each batch.
  Score s = 2^(-E[h(x)] / c(256)); anomalies are the rows above the exact
  (1 - contamination) quantile of s, as in scikit-learn's offset rule.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.functions.rng import lcg_uniform
from riskline.operators.scale import fit_standard
from riskline.operators.selection import column_quantiles
from riskline.sources.staging import drop_stage, stage

N_TREES = 100
SAMPLE_SIZE = 256
CONTAMINATION = 0.1
_NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size long, leaf boolean"


def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(pdf: pd.DataFrame, n_features: int, seed: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    x = pdf[[f"f{i}" for i in range(n_features)]].to_numpy(dtype=float)
    rng = np.random.default_rng(seed * 100003 + tree)
    limit = int(math.ceil(math.log2(max(len(x), 2))))
    rows = []
    stack = [(np.arange(len(x)), 0, 0)]
    next_id = 1
    while stack:
        idx, node, depth = stack.pop()
        sub = x[idx]
        if depth >= limit or len(idx) <= 1 or np.all(sub.max(axis=0) == sub.min(axis=0)):
            rows.append((tree, node, -1, 0.0, -1, -1, len(idx), True))
            continue
        spread = np.flatnonzero(sub.max(axis=0) > sub.min(axis=0))
        f = int(rng.choice(spread))
        lo, hi = sub[:, f].min(), sub[:, f].max()
        thr = float(rng.uniform(lo, hi))
        left, right = next_id, next_id + 1
        next_id += 2
        rows.append((tree, node, f, thr, left, right, len(idx), False))
        stack.append((idx[sub[:, f] < thr], left, depth + 1))
        stack.append((idx[sub[:, f] >= thr], right, depth + 1))
    return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "size", "leaf"])


def tree_samples(df: DataFrame, key: str, n: int, n_trees: int = N_TREES, sample_size: int = SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """The rows of ``df`` (n of them) in each tree's sample, with column ``tree``: the min(n,
    sample_size) rows of the smallest draws, ties by key."""
    want = min(sample_size, n)
    p = (sample_size + 8.0 * math.sqrt(sample_size) + 16.0) / max(n, 1)
    while True:
        draws = F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.struct(t.alias("tree"), lcg_uniform(F.col(key), t + F.lit(1000), seed).alias("u")))
        few = F.filter(draws, lambda d: d["u"] < F.lit(min(p, 1.0))) if p < 1 else draws
        drawn = stage(df.select("*", F.explode(few).alias("_d")).select("*", "_d.tree", "_d.u").drop("_d"), "draws")
        if p >= 1 or drawn.groupBy("tree").count().where(F.col("count") >= want).count() == n_trees:
            rank = F.row_number().over(Window.partitionBy("tree").orderBy("u", key))  # few more than sample_size rows
            return drawn.withColumn("_r", rank).where(F.col("_r") <= want).drop("_r", "u")
        drop_stage(drawn)
        p *= 2


def fit_forest(df: DataFrame, features: list[str], key: str, n_trees: int = N_TREES, sample_size: int = SAMPLE_SIZE, seed: int = 42):
    scaler = fit_standard(df, features)
    z = scaler.transform(df).select(key, *[F.col(c).alias(f"f{i}") for i, c in enumerate(features)])
    n = df.count()
    nf = len(features)
    nodes = tree_samples(z, key, n, n_trees, sample_size, seed).groupBy("tree").applyInPandas(lambda pdf: _grow(pdf, nf, seed), _NODE_SCHEMA)
    table = nodes.orderBy("tree", "node").toPandas()  # bounded: n_trees x (2 * sample_size - 1) rows
    return scaler, table, min(sample_size, n)


def _score_fn(table: pd.DataFrame, nf: int, psi: int):
    trees = []
    for _, g in table.groupby("tree"):
        g = g.sort_values("node")
        size = int(g["node"].max()) + 1
        feat = np.full(size, -1)
        thr = np.zeros(size)
        left = np.full(size, -1)
        right = np.full(size, -1)
        leafsize = np.zeros(size)
        nodes = g["node"].to_numpy()
        feat[nodes] = g["feature"].to_numpy()
        thr[nodes] = g["threshold"].to_numpy()
        left[nodes] = g["left"].to_numpy()
        right[nodes] = g["right"].to_numpy()
        leafsize[nodes] = g["size"].to_numpy()
        trees.append((feat, thr, left, right, np.array([_c(v) for v in leafsize])))
    cpsi = _c(psi)

    def score(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        total = np.zeros(len(x))
        for feat, thr, left, right, adj_of in trees:
            node = np.zeros(len(x), dtype=int)
            depth = np.zeros(len(x))
            active = feat[node] >= 0
            while active.any():
                f = feat[node[active]]
                go_left = x[active, f] < thr[node[active]]
                node[active] = np.where(go_left, left[node[active]], right[node[active]])
                depth[active] += 1
                active = feat[node] >= 0
            total += depth + adj_of[node]
        mean_h = total / max(len(trees), 1)
        return pd.Series(np.power(2.0, -mean_h / cpsi if cpsi > 0 else 0.0))

    return score


def isolation_forest(df: DataFrame, features: list[str], key: str, contamination: float = CONTAMINATION, n_trees: int = N_TREES,
                     sample_size: int = SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """Adds ``anomaly_score`` and ``detected_anomaly``."""
    df = stage(df, "forest")  # read for the scaler, the samples and the scores
    scaler, table, psi = fit_forest(df, features, key, n_trees, sample_size, seed)
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(table)
    nf = len(features)

    @F.pandas_udf(T.DoubleType())
    def score_udf(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        score = _score_fn(bc.value, nf, psi)
        for cols in batches:
            yield score(*cols)

    zcols = [F.col(c) for c in features]
    scored = scaler.transform(df.select("*", *[F.col(c).alias(f"_raw_{c}") for c in features]))
    scored = scored.withColumn("anomaly_score", score_udf(*zcols))
    for c in features:
        scored = scored.withColumn(c, F.col(f"_raw_{c}")).drop(f"_raw_{c}")
    scored = stage(scored, "scores")
    found = column_quantiles(scored, ["anomaly_score"], [1.0 - contamination])
    limit = F.lit(found["anomaly_score"][0]) if found else F.lit(None).cast("double")
    return scored.withColumn("detected_anomaly", F.col("anomaly_score") > limit)
