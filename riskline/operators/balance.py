"""Rebalancing with synthetic rows.

SMOTE: x + u * (neighbour - x) for a seeded choice of (sample, neighbour) and gap u.
The number of new rows is int(ratio * n_majority) - n_minority.  Seeded choices use
the shared integer generator (``rng``), so they are identical in SQL and do not
depend on partitioning; bit parity with numpy's generator is not a goal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.functions.rng import lcg_int, lcg_uniform
from riskline.operators.neighbors import knn
from riskline.operators.ordered import row_numbers
from riskline.sources.staging import stage

# fixed values: reference defaults
SAMPLING_RATIO = 0.1
K_NEIGHBORS = 5
M_NEIGHBORS = 10
SEED = 42
SMOTE_FEATURES = ["Time", "Amount", "Hour", "Amount_log", "PCA_Magnitude", *[f"V{i}" for i in range(1, 11)]]
QUALITY_GOOD, QUALITY_FAIR = 0.8, 0.5


def _vec(df: DataFrame, features: list[str], key: str, more: list[str] = ()) -> DataFrame:
    return df.selectExpr(f"`{key}` AS id", "array(" + ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in features) + ") AS vec", *more)


def class_counts(df: DataFrame, label: str, minority: int) -> tuple[int, int]:
    row = df.agg(F.count(F.when(F.col(label) == minority, 1)).alias("n_min"),
                 F.count(F.when(F.col(label) != minority, 1)).alias("n_maj")).first()
    return int(row["n_min"]), int(row["n_maj"])


def n_synthetic(n_min: int, n_maj: int, ratio: float) -> int:
    return max(int(ratio * n_maj) - n_min, 0)


def _interpolate(spark, bases: DataFrame, vecs: DataFrame, nn: DataFrame, n_new: int, k: int, seed: int, features: list[str],
                 label: str, n_base: int | None = None) -> DataFrame:
    """Draw n_new (base, neighbour-rank, gap) triples and build the new rows."""
    n_base = bases.count() if n_base is None else n_base
    if n_new <= 0 or n_base == 0:
        return None
    j = F.col("id")
    idx = F.pmod(lcg_int(j, 1, seed), F.lit(n_base * k))
    gen = spark.range(n_new).select(j.alias("synthetic_id"), (F.floor(idx / F.lit(k)) + F.lit(1)).cast("bigint").alias("base_rn"),
                                     (F.pmod(idx, F.lit(k)) + F.lit(1)).cast("int").alias("nn_rank"), lcg_uniform(j, 2, seed).alias("gap"))
    b = gen.join(bases.select(F.col("rn").alias("base_rn"), F.col("id").alias("base_id")), "base_rn")
    b = b.join(nn.select(F.col("qid").alias("base_id"), F.col("rank").alias("nn_rank"), F.col("pid").alias("nn_id")), ["base_id", "nn_rank"])
    b = b.join(vecs.select(F.col("id").alias("base_id"), F.col("vec").alias("bvec")), "base_id")
    b = b.join(vecs.select(F.col("id").alias("nn_id"), F.col("vec").alias("nvec")), "nn_id")
    new = b.selectExpr("synthetic_id", "base_id", "nn_id", "zip_with(bvec, nvec, (x, y) -> x + gap * (y - x)) AS vec")
    return new.selectExpr("synthetic_id", "base_id", "nn_id", *[f"vec[{i}] AS `{c}`" for i, c in enumerate(features)], f"1 AS `{label}`")


def smote(df: DataFrame, features: list[str] = SMOTE_FEATURES, label: str = "Class", key: str = "event_id",
          ratio: float = SAMPLING_RATIO, k: int = K_NEIGHBORS, seed: int = SEED, minority: int = 1) -> DataFrame | None:
    """B1: synthetic minority rows (None when no row is needed)."""
    spark = df.sparkSession
    n_min, n_maj = class_counts(df, label, minority)
    n_new = n_synthetic(n_min, n_maj, ratio)
    if n_new == 0 or n_min <= k:
        return None
    # narrow minority table, reused by every kNN / sampling pass: materialize once
    vecs = stage(_vec(df.where(F.col(label) == minority), features, key), "minority")
    nn = knn(vecs, vecs, k)
    bases = row_numbers(vecs.select("id"), ["id"], out="rn")
    return _interpolate(spark, bases, vecs, nn, n_new, k, seed, features, label, n_base=n_min)


def danger_set(df: DataFrame, features: list[str], label: str, key: str, m: int, minority: int) -> DataFrame:
    """Minority rows whose m nearest rows (any class) hold m/2 <= majority < m."""
    all_vecs = stage(_vec(df, features, key, [f"`{label}` AS _y"]), "vectors")
    mino = all_vecs.where(F.col("_y") == minority)
    nn = knn(mino.select("id"), all_vecs.select("id", "vec"), m)
    lab = all_vecs.select(F.col("id").alias("pid"), F.col("_y").alias("_py"))
    maj = nn.join(lab, "pid").groupBy("qid").agg(F.count(F.when(F.col("_py") != minority, 1)).alias("n_majority_neighbors"))
    return maj.where((F.col("n_majority_neighbors") >= F.lit(m / 2.0)) & (F.col("n_majority_neighbors") < F.lit(m))).select(
        F.col("qid").alias("id"), "n_majority_neighbors")


def borderline_smote(df: DataFrame, features: list[str] = SMOTE_FEATURES, label: str = "Class", key: str = "event_id",
                     ratio: float = SAMPLING_RATIO, k: int = K_NEIGHBORS, m: int = M_NEIGHBORS, seed: int = SEED,
                     minority: int = 1) -> DataFrame | None:
    """B2 (borderline-1): SMOTE from the danger rows only, neighbours among the minority."""
    spark = df.sparkSession
    n_min, n_maj = class_counts(df, label, minority)
    n_new = n_synthetic(n_min, n_maj, ratio)
    if n_new == 0 or n_min <= k:
        return None
    danger = stage(danger_set(df, features, label, key, m, minority).select("id"), "danger")
    vecs = stage(_vec(df.where(F.col(label) == minority), features, key), "minority")
    nn = knn(danger, vecs, k)
    bases = row_numbers(danger, ["id"], out="rn")
    return _interpolate(spark, bases, vecs, nn, n_new, k, seed, features, label)


def oversample_with_noise(df: DataFrame, features: list[str], label: str = "Class", key: str = "event_id", ratio: float = SAMPLING_RATIO,
                          noise: float = 0.01, seed: int = SEED, minority: int = 1) -> DataFrame | None:
    """Duplicate minority rows round-robin with Gaussian noise (sigma = noise * column std).

    Normal draws use Box-Muller on two seeded uniforms of (copy id, feature index)."""
    spark = df.sparkSession
    n_min, n_maj = class_counts(df, label, minority)
    n_new = n_synthetic(n_min, n_maj, ratio)
    if n_new == 0 or n_min == 0:
        return None
    mino = df.where(F.col(label) == minority)
    stds = mino.agg(*[F.stddev_samp(c).alias(c) for c in features]).first()
    bases = row_numbers(mino.select(F.col(key).alias("id"), *features), ["id"], out="rn")
    j = F.col("id")
    gen = spark.range(n_new).select(j.alias("synthetic_id"), (F.pmod(j, F.lit(n_min)) + F.lit(1)).alias("rn"))
    b = gen.join(bases.withColumnRenamed("id", "base_id"), "rn")

    def normal(i):
        u1 = F.greatest(lcg_uniform(F.col("synthetic_id"), 100 + 2 * i, seed), F.lit(1e-12))
        u2 = lcg_uniform(F.col("synthetic_id"), 101 + 2 * i, seed)
        return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * 3.141592653589793) * u2)

    cols = [(F.col(c) + F.lit(noise * (stds[c] or 0.0)) * normal(i)).alias(c) for i, c in enumerate(features)]
    return b.select("synthetic_id", "base_id", *cols, F.lit(1).alias(label))


def balanced_dataset(df: DataFrame, synthetic: DataFrame | None, features: list[str], label: str = "Class", keep_original_minority: bool = True,
                     minority: int = 1) -> DataFrame:
    """Original rows (or majority only, for generators that replace the
    minority, N11) plus synthetic rows; the input when generation produced nothing."""
    base = df if keep_original_minority else df.where(F.col(label) != minority)
    base = base.select(*features, label)
    if synthetic is None:
        return df.select(*features, label)
    return base.unionByName(synthetic.select(*features, label))


def quality_band(score) -> F.Column:
    """Status band of a quality score."""
    return F.when(score >= QUALITY_GOOD, F.lit("good")).when(score >= QUALITY_FAIR, F.lit("fair")).otherwise(F.lit("poor"))


def svm_smote(df: DataFrame, features: list[str] = SMOTE_FEATURES, label: str = "Class", key: str = "event_id",
              ratio: float = SAMPLING_RATIO, k: int = K_NEIGHBORS, seed: int = SEED, minority: int = 1) -> DataFrame | None:
    """SMOTE from the minority rows on or inside a linear SVM's margin.

    The SVM is Spark ML's ``LinearSVC`` on standardised features; rows with
    |decision value| <= 1 are the margin rows (all minority rows when none is)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    spark = df.sparkSession
    n_min, n_maj = class_counts(df, label, minority)
    n_new = n_synthetic(n_min, n_maj, ratio)
    if n_new == 0 or n_min <= k:
        return None
    df = stage(df.select(key, label, *features).hint("rebalance"), "svm")  # the scaler, the machine and the choice read it
    pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_raw", handleInvalid="keep"),
                            StandardScaler(inputCol="_raw", outputCol="_x", withMean=True, withStd=True),
                            LinearSVC(featuresCol="_x", labelCol=label, maxIter=50)])
    model = pipe.fit(df)
    margin = vector_to_array(F.col("rawPrediction"))[1]
    scored = model.transform(df.where(F.col(label) == minority)).select(F.col(key).alias("id"), margin.alias("_m"))
    support = stage(scored.where(F.abs(F.col("_m")) <= 1.0).select("id"), "support")
    if support.limit(1).count() == 0:
        support = scored.select("id")
    vecs = stage(_vec(df.where(F.col(label) == minority), features, key), "minority")
    nn = knn(support, vecs, k)
    bases = row_numbers(support, ["id"], out="rn")
    return _interpolate(spark, bases, vecs, nn, n_new, k, seed, features, label)
