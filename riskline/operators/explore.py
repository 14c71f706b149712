"""Exploration aggregates A3-A17 and top-k T1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.operators.selection import quantile_table

def r6(c: Column) -> Column:
    return F.round(c, 6)


def fraud_by_category(df: DataFrame, category: str = "Amount_Category", label: str = "Class") -> DataFrame:
    """Fraud count and rate per amount category."""
    return df.groupBy(category).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(label).cast("bigint").alias("frauds"),
        r6(F.avg(label)).alias("fraud_rate"),
    )


def amount_by_class(df: DataFrame, amount: str = "Amount", label: str = "Class") -> DataFrame:
    """A3: mean and exact median of Amount per class."""
    med = quantile_table(df, amount, [0.5], [label], ["median_amount"])
    mean = df.groupBy(label).agg(F.avg(amount).alias("mean_amount"), F.count(F.lit(1)).alias("n"))
    return mean.join(F.broadcast(med.withColumnRenamed(label, "_g")), F.col(label).eqNullSafe(F.col("_g")), "left").select(label, "n", r6(F.col("mean_amount")).alias("mean_amount"), r6(F.col("median_amount")).alias("median_amount"))


def to_long(df: DataFrame, columns: list[str], keep: list[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Unpivot ``columns`` into (name, value) rows, values cast to double."""
    return df.selectExpr(*[f"`{k}`" for k in keep], *[f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in columns]).unpivot(keep, columns, name, value)


def five_number_summary(df: DataFrame, columns: list[str], label: str = "Class") -> DataFrame:
    """A4: min, quartiles and max per class and feature (exact)."""
    long = to_long(df, columns, [label])
    q = quantile_table(long, "value", [0.0, 0.25, 0.5, 0.75, 1.0], [label, "feature"], ["q0", "q1", "q2", "q3", "q4"])
    return q.select(label, "feature", *[r6(F.col(c)).alias(n) for c, n in zip(["q0", "q1", "q2", "q3", "q4"], ["min", "q1", "median", "q3", "max"])])


def histogram_density(df: DataFrame, col: str, bins: int, upper: float | None = None, label: str = "Class") -> DataFrame:
    """A5: per-class histogram over the class's own [min, max] (after an optional
    upper bound), ``bins`` equal-width bins, last bin closed; density = count/(n*width)."""
    data = df.where(F.col(col) <= F.lit(upper)) if upper is not None else df
    data = data.where(F.col(col).isNotNull())
    rng = data.groupBy(label).agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    idx = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((F.col(col) - F.col("lo")) / width), F.lit(bins - 1)))
    # one row per class: AQE broadcasts it from its measured size
    binned = data.join(rng, on=label).select(label, idx.cast("int").alias("bin"), "lo", "hi", "n")
    counts = binned.groupBy(label, "bin", "lo", "hi", "n").agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return counts.select(
        label,
        "bin",
        r6(F.col("lo") + F.col("bin") * w).alias("bin_start"),
        "count",
        r6(F.when(w == 0, F.lit(None).cast("double")).otherwise(F.col("count") / (F.col("n") * w))).alias("density"),
    )


def hourly_volume(df: DataFrame, label: str = "Class") -> DataFrame:
    """Transactions per integer hour and class (N8: floor of the fractional hour)."""
    return df.groupBy(F.floor("Hour").cast("int").alias("hour"), label).agg(F.count(F.lit(1)).alias("n"))


def hourly_share(df: DataFrame, label: str = "Class") -> DataFrame:
    """Share (%) of a class's transactions falling in each hour.

    The class total is a window over the hourly table (at most 24 x classes rows)."""
    from pyspark.sql import Window

    hv = hourly_volume(df, label)
    tot = F.sum("n").over(Window.partitionBy(label))
    return hv.select("hour", label, "n", r6(F.col("n") * F.lit(100.0) / tot).alias("pct"))


def night_day_fraud(df: DataFrame, label: str = "Class") -> DataFrame:
    """Fraud rate at night and by day, and their ratio (one pass)."""
    night = F.col("Is_Night") == 1
    agg = df.agg(
        F.avg(F.when(night, F.col(label))).alias("night_rate"),
        F.avg(F.when(~night, F.col(label))).alias("day_rate"),
        F.count(F.when(night, F.lit(1))).alias("night_n"),
        F.count(F.when(~night, F.lit(1))).alias("day_n"),
    )
    return agg.select(
        r6(F.col("night_rate")).alias("night_rate"),
        r6(F.col("day_rate")).alias("day_rate"),
        "night_n",
        "day_n",
        r6(F.try_divide(F.col("night_rate"), F.col("day_rate"))).alias("night_day_ratio"),
    )


def extreme_by_class(df: DataFrame, label: str = "Class") -> DataFrame:
    """A10: mean PCA_Extreme_Count per class and fraud/normal ratio."""
    agg = df.agg(
        F.avg(F.when(F.col(label) == 0, F.col("PCA_Extreme_Count"))).alias("m0"),
        F.avg(F.when(F.col(label) == 1, F.col("PCA_Extreme_Count"))).alias("m1"),
    )
    return agg.select(
        r6(F.col("m0")).alias("mean_extreme_normal"),
        r6(F.col("m1")).alias("mean_extreme_fraud"),
        r6(F.try_divide(F.col("m1"), F.col("m0"))).alias("extreme_ratio"),
    )


def abs_correlations(df: DataFrame, columns: list[str], label: str = "Class") -> DataFrame:
    """|Pearson r| of each column with the label, one aggregate pass."""
    row = df.agg(*[F.expr(f"corr(CAST(`{c}` AS DOUBLE), CAST(`{label}` AS DOUBLE)) AS `{c}`") for c in columns])
    return row.unpivot([], columns, "feature", "corr").select("feature", r6(F.abs(F.col("corr"))).alias("abs_corr"))


def top_correlated(df: DataFrame, columns: list[str], k: int = 5, label: str = "Class") -> DataFrame:
    """The k columns most correlated (in absolute value) with the label.

    The label itself (always first, r = 1) is excluded by construction."""
    from pyspark.sql import Window

    c = abs_correlations(df, columns, label).where(F.col("abs_corr").isNotNull())
    # ranking runs over one row per feature (bounded by the column count)
    w = Window.orderBy(F.col("abs_corr").desc(), F.col("feature"))
    return c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def distinct_counts(df: DataFrame, columns: list[str], approx: bool = False) -> DataFrame:
    """Distinct values per column.

    Exact: unpivot to (column, value), dedup with map-side combine, count per column;
    one shuffle for all columns instead of one expand per distinct aggregate.
    ``approx=True`` uses HyperLogLog++ (one pass, no shuffle of values)."""
    if approx:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return row.unpivot([], columns, "column", "n_distinct")
    long = to_long(df, columns, [], "column", "value").where(F.col("value").isNotNull())
    return long.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def time_span(df: DataFrame) -> DataFrame:
    """Time and Amount ranges and the span in days."""
    return df.agg(
        F.min("Time").alias("time_min"),
        F.max("Time").alias("time_max"),
        r6(F.max("Time") / F.lit(86400.0)).alias("span_days"),
        F.min("Amount").alias("amount_min"),
        F.max("Amount").alias("amount_max"),
    )


# fixed values: re-identification risk bands
REID_HIGH = "ÉLEVÉ"
REID_MEDIUM = "MOYEN"
REID_LIMIT = 0.8


def reidentification_risk(df: DataFrame, cols: tuple[str, ...] = ("Time", "Amount")) -> DataFrame:
    """Distinct (Time, Amount) pairs over rows; > 0.8 is high risk."""
    pairs = df.select(*cols).distinct().agg(F.count(F.lit(1)).alias("distinct_pairs"))
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    both = pairs.withColumn("_k", F.lit(1)).join(rows.withColumn("_k", F.lit(1)), "_k")  # two one-row frames
    risk = F.col("distinct_pairs") / F.col("rows")
    return both.select(
        "distinct_pairs",
        "rows",
        r6(risk).alias("risk"),
        F.when(risk > F.lit(REID_LIMIT), F.lit(REID_HIGH)).otherwise(F.lit(REID_MEDIUM)).alias("level"),
    )


def overview(df: DataFrame) -> DataFrame:
    """Rows, columns and missing cells (NULL or NaN) in one pass."""
    from riskline.operators.validate import _missing_cells

    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.coalesce(F.sum(_missing_cells(df)), F.lit(0)).cast("bigint").alias("missing_cells"),
    )


def insights(df: DataFrame, columns: list[str], label: str = "Class", amount: str = "Amount") -> DataFrame:
    """Headline row (rows, 1:ratio text, columns, top-5 features, mean amounts)."""
    top = top_correlated(df, columns, 5, label).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "feature"))), lambda s: s["feature"]), ",").alias(
            "top_features"
        )
    )
    stats = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.avg(amount).alias("m")).agg(
        F.sum("n").alias("total_transactions"),
        F.max(F.when(F.col(label) == 0, F.col("n"))).alias("n0"),
        F.max(F.when(F.col(label) == 1, F.col("n"))).alias("n1"),
        F.max(F.when(F.col(label) == 0, F.col("m"))).alias("m0"),
        F.max(F.when(F.col(label) == 1, F.col("m"))).alias("m1"),
    )
    both = stats.withColumn("_k", F.lit(1)).join(top.withColumn("_k", F.lit(1)), "_k")  # two one-row frames
    return both.select(
        "total_transactions",
        F.concat(F.lit("1:"), F.format_string("%.0f", F.try_divide(F.col("n0").cast("double"), F.col("n1")))).alias("fraud_ratio"),
        F.lit(len(df.columns)).alias("total_variables"),
        "top_features",
        F.round("m0", 2).alias("avg_amount_normal"),
        F.round("m1", 2).alias("avg_amount_fraud"),
    )
