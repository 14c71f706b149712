"""Cleaning and feature engineering C1-C7, W1/J1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.functions import features as fx
from riskline.operators.selection import column_quantiles

# fixed values (reference defaults)
OUTLIER_Z = 3.0
DAILY_Z_EPS = 1e-8

ENRICHED = ["Hour", "Day", "Is_Night", "Is_Weekend", "Amount_log", "Amount_Category", "PCA_Magnitude", "PCA_Extreme_Count"]


def add_temporal(df: DataFrame, night_variant: str = "notebook") -> DataFrame:
    """C5 (F1-F4)."""
    return (
        df.withColumn("Hour", fx.hour("Time"))
        .withColumn("Day", fx.day("Time"))
        .withColumn("Is_Night", fx.is_night("Hour", night_variant))
        .withColumn("Is_Weekend", fx.is_weekend("Day"))
    )


def add_amount(df: DataFrame, category_variant: str = "notebook") -> DataFrame:
    """C6 without the daily z-score."""
    return df.withColumn("Amount_log", fx.amount_log("Amount")).withColumn(
        "Amount_Category", fx.amount_category("Amount", category_variant)
    )


def add_pca(df: DataFrame, extreme_threshold: float = fx.EXTREME_THRESHOLD_NOTEBOOK) -> DataFrame:
    """C7 (F7, F8)."""
    return df.withColumn("PCA_Magnitude", fx.pca_magnitude()).withColumn(
        "PCA_Extreme_Count", fx.pca_extreme_count(threshold=extreme_threshold)
    )


def enrich(
    df: DataFrame,
    night_variant: str = "notebook",
    category_variant: str = "notebook",
    extreme_threshold: float = fx.EXTREME_THRESHOLD_NOTEBOOK,
) -> DataFrame:
    """The 39-column enriched schema (base + 8 features); pure projection, built in two
    ``withColumns`` steps so the (wide) plan is analysed twice, not eight times."""
    first = df.withColumns({
        "Hour": fx.hour("Time"),
        "Day": fx.day("Time"),
        "Amount_log": fx.amount_log("Amount"),
        "Amount_Category": fx.amount_category("Amount", category_variant),
        "PCA_Magnitude": fx.pca_magnitude(),
        "PCA_Extreme_Count": fx.pca_extreme_count(threshold=extreme_threshold),
    })
    second = first.withColumns({"Is_Night": fx.is_night("Hour", night_variant), "Is_Weekend": fx.is_weekend("Day")})
    order = [c for c in df.columns] + ENRICHED
    return second.select(*order)


def daily_stats(df: DataFrame, day_col: str = "Day", amount: str = "Amount") -> DataFrame:
    """Per-day mean and sample std of Amount (partial aggregation)."""
    return df.groupBy(day_col).agg(
        F.avg(amount).alias("amount_day_mean"), F.stddev_samp(amount).alias("amount_day_std"), F.count(F.lit(1)).alias("n")
    )


def add_daily_zscore(df: DataFrame, day_col: str = "Day", amount: str = "Amount") -> DataFrame:
    """(Amount - day mean) / (day std + 1e-8).

    Written as aggregate + join rather than ``Window.partitionBy(Day)``: a window puts a
    whole day into one task, while the aggregate is map-side combined and the per-day
    table (one row per day) is broadcast by AQE from its measured size (no extra job
    to count it).  A one-row day has no
    sample std; we use 0 there (our choice), which gives z = 0.
    """
    stats = daily_stats(df, day_col, amount).select(day_col, "amount_day_mean", "amount_day_std")
    z = (F.col(amount) - F.col("amount_day_mean")) / (F.coalesce(F.col("amount_day_std"), F.lit(0.0)) + F.lit(DAILY_Z_EPS))
    return (
        df.join(stats, on=day_col, how="left")
        .withColumn("Amount_Daily_Zscore", z)
        .drop("amount_day_mean", "amount_day_std")
    )


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row dedup (hash aggregate on all columns, map-side combined)."""
    return df.dropDuplicates()


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def impute_median(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fill NULL/NaN of numeric columns with the exact (interpolated) median.

    The medians of all columns with missing values are searched in the same passes of the
    histogram selection; only they (one double per column) reach the driver.
    """
    columns = columns or numeric_columns(df)
    clean = df
    for c in columns:
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            clean = clean.withColumn(c, F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)))
    null_counts = clean.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns]).first()
    todo = [c for c in columns if null_counts[c]]
    if not todo:
        return clean
    medians = {c: q[0] for c, q in column_quantiles(clean, todo, [0.5]).items()}
    out = clean
    for c, m in medians.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(m).cast(df.schema[c].dataType)))
    return out


def amount_outlier_bounds(df: DataFrame, amount: str = "Amount") -> tuple[float | None, float | None]:
    row = df.agg(F.avg(amount).alias("m"), F.stddev_samp(amount).alias("s")).first()
    return row["m"], row["s"]


def filter_amount_outliers(df: DataFrame, threshold: float = OUTLIER_Z, amount: str = "Amount",
                           mean: float | None = None, std: float | None = None) -> DataFrame:
    """Keep rows with |z| <= threshold (sample std).

    With stats given (frozen at fit) no pass is made.  When std is 0 or undefined the
    reference's NaN z would drop every row; we keep all rows (N10) and say so here.
    Rows with NULL Amount have no z and are dropped, as NaN z is in the reference.
    """
    if mean is None or std is None:
        mean, std = amount_outlier_bounds(df, amount)
    if mean is None or std is None or std == 0:
        return df
    z = F.abs((F.col(amount) - F.lit(mean)) / F.lit(std))
    return df.where(z <= F.lit(threshold))


def iqr_filter(df: DataFrame, col: str = "Amount", k: float = 1.5) -> DataFrame:
    """C4: keep Q1 - k*IQR <= x <= Q3 + k*IQR (exact quartiles)."""
    found = column_quantiles(df, [col], [0.25, 0.75])
    if not found:
        return df
    q1, q3 = found[col]
    return df.where(F.col(col).between(q1 - k * (q3 - q1), q3 + k * (q3 - q1)))


def percentile_cap(df: DataFrame, col: str = "Amount", p: float = 0.995) -> DataFrame:
    """C4: cap a column at its exact p-quantile."""
    found = column_quantiles(df, [col], [p])
    if not found:
        return df
    return df.withColumn(col, F.least(F.col(col), F.lit(found[col][0])))
