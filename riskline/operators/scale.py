"""Exact scalers C8-C10, feature alignment P5 and C13.

Spark ML's scalers differ from the reference (N1): ``StandardScaler`` divides by the
sample std, ``MinMaxScaler`` maps a constant column to 0.5 and ``RobustScaler`` uses
approximate quantiles.  These scalers fit exact statistics in one aggregate pass
(plus the histogram-selection passes for robust columns) and apply them as plain
column arithmetic, so ``transform`` is a narrow projection with no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.functions.features import V_COLS
from riskline.operators.selection import column_quantiles

# fixed values: the reference's scaler groups
STANDARD_COLS = ["Time", "Hour", "Amount_Daily_Zscore", "PCA_Magnitude"]
ROBUST_COLS = ["Amount"]
MINMAX_COLS = ["Amount_log", "Amount_Category", "PCA_Extreme_Count"]
MODEL_FEATURES = [*V_COLS, "Amount", "Amount_log", "Hour", "Day", "Is_Night", "Is_Weekend", "PCA_Magnitude",
                  "PCA_Extreme_Count", "Amount_Category"]


@dataclass
class ScalerModel:
    """Frozen per-column (center, scale): x -> (x - center) / scale."""

    kind: str
    params: dict[str, tuple[float, float]] = field(default_factory=dict)

    def expr(self, c: str) -> Column:
        center, scale = self.params[c]
        return (F.col(c).cast("double") - F.lit(center)) / F.lit(scale)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.expr(c) for c in self.params if c in df.columns})


def _safe(scale: float | None) -> float:
    # zero or undefined spread -> scale 1 (constant column maps to 0)
    return 1.0 if scale is None or scale == 0 else float(scale)


def fit_standard(df: DataFrame, cols: list[str]) -> ScalerModel:
    """Mean and population std in one pass."""
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    return ScalerModel("standard", {c: (row[f"m_{i}"] or 0.0, _safe(row[f"s_{i}"])) for i, c in enumerate(cols)})


def fit_minmax(df: DataFrame, cols: list[str]) -> ScalerModel:
    """Min and range in one pass; constant column -> 0."""
    row = df.agg(*[F.min(c).alias(f"lo_{i}") for i, c in enumerate(cols)],
                 *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(cols)]).first()
    params = {}
    for i, c in enumerate(cols):
        lo, hi = row[f"lo_{i}"], row[f"hi_{i}"]
        params[c] = (float(lo or 0.0), _safe(None if lo is None else float(hi) - float(lo)))
    return ScalerModel("minmax", params)


def fit_robust(df: DataFrame, cols: list[str]) -> ScalerModel:
    """Exact median and interquartile range."""
    found = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    params = {c: (found[c][1], _safe(found[c][2] - found[c][0])) if c in found else (0.0, 1.0) for c in cols}
    return ScalerModel("robust", params)


def fit_scalers(df: DataFrame, standard: list[str], robust: list[str], minmax: list[str]) -> list[ScalerModel]:
    """C8-C10 together: one aggregate pass for the standard and min-max statistics,
    the histogram-selection passes for the robust columns."""
    aggs = [F.avg(c).alias(f"m_{i}") for i, c in enumerate(standard)]
    aggs += [F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(standard)]
    aggs += [F.min(c).alias(f"lo_{i}") for i, c in enumerate(minmax)]
    aggs += [F.max(c).alias(f"hi_{i}") for i, c in enumerate(minmax)]
    out = []
    if aggs:
        row = df.agg(*aggs).first()
        if standard:
            out.append(ScalerModel("standard", {c: (row[f"m_{i}"] or 0.0, _safe(row[f"s_{i}"])) for i, c in enumerate(standard)}))
        if minmax:
            mm = {}
            for i, c in enumerate(minmax):
                lo, hi = row[f"lo_{i}"], row[f"hi_{i}"]
                mm[c] = (float(lo or 0.0), _safe(None if lo is None else float(hi) - float(lo)))
            out.append(ScalerModel("minmax", mm))
    if robust:
        out.append(fit_robust(df, robust))
    return out


def align_to_features(df: DataFrame, features: list[str], label: str | None = "Class") -> DataFrame:
    """P5: fixed feature order, absent features as 0, label last when present."""
    cols = [F.col(c) if c in df.columns else F.lit(0).alias(c) for c in features]
    if label and label in df.columns:
        cols.append(F.col(label))
    return df.select(*cols)
