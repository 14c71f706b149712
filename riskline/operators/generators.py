"""Generators of synthetic minority rows as a set (B6-B9): which are enabled, what each gave or why
it failed, how good its rows are, which is best, and a balanced table by a named method."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskline.operators import balance as bl
from riskline.operators import copula as cp
from riskline.sources.staging import stage

#: name: (function of (df, features, label, key, minority, **params), rows replace the minority)
METHODS: dict[str, tuple[Callable, bool]] = {
    "smote": (lambda df, features, label, key, minority, **p: bl.smote(df, features, label, key, minority=minority, **p), False),
    "borderline_smote": (lambda df, features, label, key, minority, **p: bl.borderline_smote(df, features, label, key, minority=minority, **p), False),
    "svm_smote": (lambda df, features, label, key, minority, **p: bl.svm_smote(df, features, label, key, minority=minority, **p), False),
    "simple_oversampling": (lambda df, features, label, key, minority, **p: bl.oversample_with_noise(df, features, label, key, minority=minority, **p), False),
    "gaussian_copula": (lambda df, features, label, key, minority, **p: cp.gaussian_copula(df, features, label, key, minority, **p), True),
}

#: The reference's parameters; a method without an entry or with ``enabled`` False is left out.
DEFAULT_CONFIG: dict[str, dict] = {
    "smote": {"enabled": True, "params": {"ratio": 0.1, "k": 5, "seed": 42}},
    "borderline_smote": {"enabled": True, "params": {"ratio": 0.1, "k": 5, "seed": 42}},
    "simple_oversampling": {"enabled": True, "params": {"ratio": 0.1, "seed": 42}},
    "gaussian_copula": {"enabled": True, "params": {"num_samples": 2000, "seed": 42}},
}
TREES = 100


@dataclass
class Generated:
    """What a method gave: ``rows`` (features and label, written), or None with a status: ``none`` (no
    row was needed, or too few to learn from) or ``failed`` with the error."""

    method: str
    status: str
    rows: DataFrame | None = None
    error: str | None = None


def generate(df: DataFrame, method: str, features: list[str], label: str = "Class", key: str = "event_id", minority: int = 1, **params) -> Generated:
    """B1-B5 by name; an unknown method or one that raises is ``failed``, not fatal."""
    if method not in METHODS:
        return Generated(method, "failed", error=f"unknown method {method!r}")
    try:
        rows = METHODS[method][0](df, features, label, key, minority, **params)
        if rows is None:
            return Generated(method, "none")
        return Generated(method, "success", stage(rows.select(*features, label), method))
    except Exception as exc:  # noqa: BLE001 - reported with the method's status
        return Generated(method, "failed", error=repr(exc)[:500])


def generate_all(df: DataFrame, features: list[str], label: str = "Class", key: str = "event_id", minority: int = 1, config: dict[str, dict] | None = None) -> list[Generated]:
    """Every enabled method of the configuration, in its order."""
    config = DEFAULT_CONFIG if config is None else config
    return [generate(df, name, features, label, key, minority, **c.get("params", {})) for name, c in config.items() if c.get("enabled", False)]


def evaluate(df: DataFrame, generated: list[Generated], features: list[str], label: str = "Class", minority: int = 1, trees: int = TREES) -> DataFrame:
    """One row per method: method, status, error, synthetic_rows, quality, band, rank (best
    first).  Quality is 1 - accuracy of a forest that tells the minority's rows from synthetic ones;
    a method without rows, or whose evaluation fails, has none and comes last."""
    spark = df.sparkSession
    real = stage(df.where(F.col(label) == minority).select(*features), "real")
    rows = []
    for g in generated:
        quality, status, error = None, g.status, g.error
        if g.rows is not None:
            try:
                quality = cp.discriminator_quality(real, g.rows, features, trees)
            except Exception as exc:  # noqa: BLE001 - reported with the method's status
                status, error = "not evaluated", repr(exc)[:500]
        rows.append((g.method, status, error, g.rows.count() if g.rows is not None else 0, quality))
    table = spark.createDataFrame(rows, "method string, status string, error string, synthetic_rows long, quality double")
    order = Window.orderBy(F.col("quality").desc_nulls_last(), "method")  # one row per method
    band = F.when(F.col("quality").isNotNull(), bl.quality_band(F.col("quality")))
    return table.withColumn("rank", F.row_number().over(order)).withColumn("band", band)


def best_method(evaluated: DataFrame) -> str:
    """The method of the highest quality; ValueError if none was evaluated."""
    best = evaluated.where("quality is not null").orderBy("rank").select("method").first()
    if best is None:
        raise ValueError("no method was evaluated")
    return best["method"]


def create_balanced_dataset(df: DataFrame, features: list[str], method: str = "smote", target_ratio: float = 0.1, label: str = "Class", key: str = "event_id", minority: int = 1, **params) -> tuple[DataFrame, Generated]:
    """The table (features and label) balanced by ``method`` to ``target_ratio`` of minority to
    majority, and what the method gave.  Where it failed or had nothing to do, the table as it is."""
    own = {} if method == "gaussian_copula" else {"ratio": target_ratio}
    got = generate(df, method, features, label, key, minority, **{**own, **params})
    replaces = got.rows is not None and METHODS[method][1]
    return bl.balanced_dataset(df, got.rows, features, label, keep_original_minority=not replaces, minority=minority), got
