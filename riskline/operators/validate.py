"""Validation V1-V5 and class balance A1/A2.

Every report is a one-row DataFrame computed by a single aggregate pass (row count,
per-column NULL/NaN counts, ranges, class counts); the ordered rule chain is a SQL
``CASE`` over that row, so nothing but the final row ever reaches the driver.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.functions.features import V_COLS

# ---- fixed values (defaults and messages of the reference's validation) --------------
REQUIRED_COLUMNS = ["Time", *V_COLS, "Amount", "Class"]
MIN_ROWS = 1000
MAX_MISSING_PCT = 0.05
TIME_RANGE = (0.0, 200000.0)
AMOUNT_RANGE = (0.0, 30000.0)
CLASS_VALUES = (0, 1)
MSG_EMPTY = "Dataset vide"
MSG_TOO_FEW = "Trop peu de lignes: {rows} < {min_rows}"
MSG_MISSING_COLS = "Colonnes manquantes: {cols}"
MSG_TOO_MANY_MISSING = "Trop de valeurs manquantes: {pct}% > {limit}%"
MSG_VALID = "Dataset valide"
# ---------------------------------------------------------------------------------------

CONTRACT = T.StructType(
    [T.StructField("Time", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in V_COLS]
    + [T.StructField("Amount", T.DoubleType()), T.StructField("Class", T.IntegerType())]
)


def _is_missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    col = F.col(f"`{c}`")
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _py_list_repr(cols: list[str]) -> str:
    return "[" + ", ".join(repr(c) for c in cols) + "]"


def _quality_columns(
    rows: Column, missing_cells: Column, n_cols: int, missing_cols: list[str], min_rows: int, max_missing_pct: float
) -> list[Column]:
    pct = F.coalesce(F.try_divide(missing_cells * F.lit(100.0), rows * F.lit(n_cols)), F.lit(0.0))
    limit = max_missing_pct * 100
    early = [
        (rows == 0, F.lit(MSG_EMPTY)),
        (rows < F.lit(min_rows), F.format_string(MSG_TOO_FEW.format(rows="%d", min_rows=min_rows), rows)),
    ]
    if missing_cols:
        early.append((F.lit(True), F.lit(MSG_MISSING_COLS.format(cols=_py_list_repr(missing_cols)))))
    pattern = MSG_TOO_MANY_MISSING.replace("%", "%%").format(pct="%.2f", limit=repr(float(limit)))
    pct_check = (pct > F.lit(limit), F.format_string(pattern, pct))
    msg, valid, reached_pct = F.lit(MSG_VALID), F.lit(True), F.lit(True)
    for cond, text in reversed([*early, pct_check]):
        msg = F.when(cond, text).otherwise(msg)
        valid = F.when(cond, F.lit(False)).otherwise(valid)
    for cond, _ in early:
        reached_pct = F.when(cond, F.lit(False)).otherwise(reached_pct)
    return [
        valid.alias("is_valid"),
        msg.alias("message"),
        rows.alias("rows_count"),
        F.lit(n_cols).alias("columns_count"),
        F.when(reached_pct, pct).otherwise(F.lit(0.0)).alias("missing_percentage"),
        F.array(*[F.lit(c) for c in missing_cols]).cast("array<string>").alias("missing_columns"),
    ]


def _missing_sql(df: DataFrame, c: str) -> str:
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return f"CAST(`{c}` IS NULL OR isnan(`{c}`) AS BIGINT)"
    return f"CAST(`{c}` IS NULL AS BIGINT)"


def _missing_cells(df: DataFrame) -> Column:
    """Missing (NULL or NaN) cells of one row, as one SQL expression."""
    return F.expr(" + ".join(["CAST(0 AS BIGINT)", *[_missing_sql(df, c) for c in df.columns]]))


def dataset_quality(
    df: DataFrame,
    required_columns: list[str] = REQUIRED_COLUMNS,
    min_rows: int = MIN_ROWS,
    max_missing_pct: float = MAX_MISSING_PCT,
) -> DataFrame:
    """V1: ordered checks, first failure wins (empty, min rows, missing columns, missing %).

    ``missing_percentage`` stays 0.0 when an earlier check fails, as in the reference.
    """
    if not required_columns:
        raise ValueError("required_columns must not be empty")
    missing_cols = [c for c in required_columns if c not in df.columns]
    stats = df.agg(F.count(F.lit(1)).alias("_rows"), F.sum(_missing_cells(df)).alias("_missing"))
    return stats.select(
        *_quality_columns(F.col("_rows"), F.coalesce(F.col("_missing"), F.lit(0)), len(df.columns), missing_cols, min_rows, max_missing_pct)
    )


#: Values of a class label.
MAX_CLASSES = 1000


def class_balance(df: DataFrame, label: str = "Class") -> DataFrame:
    """A1: one row per class value with count and percentage of all rows.

    NULL labels are not a class but count in the total (percentages may not reach 100).
    The total is a window over the per-class table (a handful of rows).
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return (
        counts.select(F.col(label).alias("class"), "count", total.alias("total_samples"))
        .where(F.col("class").isNotNull())
        .select(
            "class",
            "count",
            (F.col("count") * F.lit(100.0) / F.col("total_samples")).alias("percentage"),
            "total_samples",
        )
    )


def imbalance_summary(df: DataFrame, label: str = "Class") -> DataFrame:
    """A2: imbalance ratio with minority/majority labels (tie -> smallest label).

    Raises nothing at plan time; ``n_classes`` < 2 shows the reference's error case.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    s = F.struct
    return counts.agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.max("n").alias("majority_count"),
        F.min("n").alias("minority_count"),
        # max by (count, -label): ties resolve to the smallest label
        F.max(s(F.col("n"), (-F.col(label)).alias("neg")))["neg"].alias("_maj"),
        F.min(s(F.col("n"), F.col(label).alias("lab")))["lab"].alias("minority_class"),
    ).select(
        "n_classes",
        (-F.col("_maj")).cast("int").alias("majority_class"),
        F.col("minority_class").cast("int").alias("minority_class"),
        "majority_count",
        "minority_count",
        F.try_divide(F.col("majority_count").cast("double"), F.col("minority_count")).alias("imbalance_ratio"),
    )


def class_balance_metrics(df: DataFrame, label: str = "Class") -> dict:
    """A1/A2 with the reference's errors: total, count and percentage per class, ratio, minority and
    majority class; ties resolve to the smallest label.

    Raises ValueError for an absent label column, an empty table, or fewer than two classes."""
    if label not in df.columns:
        raise ValueError(f"no column {label!r}")
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()}
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"{label!r} has more than {MAX_CLASSES} values: not a class label")
    total = sum(counts.values())
    if not total:
        raise ValueError("the table is empty")
    counts.pop(None, None)
    if len(counts) < 2:
        raise ValueError("at least two classes are needed")
    ordered = sorted(counts.items())
    minority, majority = min(ordered, key=lambda c: c[1])[0], max(ordered, key=lambda c: c[1])[0]
    return {
        "total_samples": total, "class_counts": dict(ordered), "class_percentages": {k: n / total * 100 for k, n in ordered},
        "imbalance_ratio": counts[majority] / counts[minority], "minority_class": minority, "majority_class": majority,
    }


def business_ranges(
    df: DataFrame,
    time_range: tuple[float, float] = TIME_RANGE,
    amount_range: tuple[float, float] = AMOUNT_RANGE,
    class_values: tuple[int, ...] = CLASS_VALUES,
    label: str = "Class",
) -> DataFrame:
    """V3: inclusive range checks on Time and Amount, class values subset check (U4).

    A NULL label fails the subset check (pandas would see NaN as a value).
    """
    in_set = F.col(label).isin(*class_values)
    return df.agg(
        ((F.min("Time") >= F.lit(time_range[0])) & (F.max("Time") <= F.lit(time_range[1]))).alias("time_range_valid"),
        ((F.min("Amount") >= F.lit(amount_range[0])) & (F.max("Amount") <= F.lit(amount_range[1]))).alias(
            "amount_range_valid"
        ),
        F.coalesce(F.min(F.coalesce(in_set, F.lit(False)).cast("int")) == 1, F.lit(True)).alias("class_values_valid"),
    )


def range_violations(
    df: DataFrame,
    time_range: tuple[float, float] = TIME_RANGE,
    amount_range: tuple[float, float] = AMOUNT_RANGE,
    class_values: tuple[int, ...] = CLASS_VALUES,
    label: str = "Class",
) -> DataFrame:
    """V5: row-level quarantine of V3 violations, with the failed rule names."""
    rules = F.array_compact(
        F.array(
            F.when(~F.col("Time").between(*time_range) | F.col("Time").isNull(), F.lit("time_range")),
            F.when(~F.col("Amount").between(*amount_range) | F.col("Amount").isNull(), F.lit("amount_range")),
            F.when(~F.coalesce(F.col(label).isin(*class_values), F.lit(False)), F.lit("class_values")),
        )
    )
    return df.withColumn("violations", rules).where(F.size("violations") > 0)


def schema_contract(df: DataFrame, contract: T.StructType = CONTRACT) -> DataFrame:
    """V2: compare the frame's schema with the declared contract, one row per field, with the
    column's values (neither null nor NaN) and how many of them are no value of the declared type."""
    spark = df.sparkSession
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = []
    for f in (f for f in contract.fields if f.name in actual):
        c = F.col(f"`{f.name}`")
        there = ~F.isnan(c) if actual[f.name] in ("double", "float") else F.lit(True)
        aggs += [F.count_if(c.isNotNull() & there).alias(f"n_{f.name}"), F.count_if(c.isNotNull() & there & c.try_cast(f.dataType).isNull()).alias(f"bad_{f.name}")]
    seen = df.agg(*aggs).first().asDict() if aggs else {}
    rows = [
        (f.name, f.dataType.simpleString(), actual.get(f.name), actual.get(f.name) == f.dataType.simpleString(), seen.get(f"n_{f.name}"), seen.get(f"bad_{f.name}"))
        for f in contract.fields
    ]
    schema = "column string, expected_type string, actual_type string, matches boolean, n_values long, n_malformed long"
    return spark.createDataFrame(rows, schema)


def pipeline_check_report(
    df: DataFrame,
    required_columns: list[str] = REQUIRED_COLUMNS,
    min_rows: int = MIN_ROWS,
    max_missing_pct: float = MAX_MISSING_PCT,
    time_range: tuple[float, float] = TIME_RANGE,
    amount_range: tuple[float, float] = AMOUNT_RANGE,
    class_values: tuple[int, ...] = CLASS_VALUES,
    label: str = "Class",
) -> DataFrame:
    """V4: combined data-check report; ``success`` iff V1 is valid and all V3 checks hold.

    One scan: a partial aggregate per class (count, missing cells, ranges), folded into one
    row.  Labels outside ``class_values`` form one class ``other``, so the fold stays tiny on
    a dirty label column.  A missing or non-numeric column fails its check; nothing raises.
    """
    missing_cols = [c for c in required_columns if c not in df.columns]

    def number(c: str) -> Column:
        return F.col(f"`{c}`").try_cast("double") if c in df.columns else F.lit(None).cast("double")

    lab = number(label)
    known = lab.isin(*[float(v) for v in class_values])
    raw = F.col(f"`{label}`") if label in df.columns else F.lit(None)
    kind = F.when(known, lab.cast("bigint").cast("string")).when(raw.isNotNull(), F.lit("other"))
    per_label = df.groupBy(kind.alias("_lab")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_missing_cells(df)).alias("miss"),
        F.min(number("Time")).alias("tmin"),
        F.max(number("Time")).alias("tmax"),
        F.min(number("Amount")).alias("amin"),
        F.max(number("Amount")).alias("amax"),
        F.min(F.coalesce(known, F.lit(False)).cast("int")).alias("inset"),
    )
    labelled = F.col("_lab").isNotNull()

    def within(low: str, high: str, limits: tuple[float, float]) -> Column:
        return F.coalesce((F.min(low) >= F.lit(limits[0])) & (F.max(high) <= F.lit(limits[1])), F.lit(False))

    folded = per_label.agg(
        F.sum("n").alias("_rows"),
        F.sum("miss").alias("_missing"),
        within("tmin", "tmax", time_range).alias("time_range_valid"),
        within("amin", "amax", amount_range).alias("amount_range_valid"),
        F.coalesce(F.min("inset") == 1, F.lit(True)).alias("class_values_valid"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(labelled, F.struct(F.col("_lab").alias("k"), F.col("n").alias("v")))))).alias("_dist"),
        F.sum(F.when(F.col("_lab") == "1", F.col("n"))).alias("_n1"),
        F.max(F.when(labelled, F.col("n"))).alias("_nmax"),
        F.min(F.when(labelled, F.col("n"))).alias("_nmin"),
    ).withColumn("_rows", F.coalesce("_rows", F.lit(0)))
    q = _quality_columns(F.col("_rows"), F.coalesce(F.col("_missing"), F.lit(0)), len(df.columns), missing_cols, min_rows, max_missing_pct)
    is_valid = q[0]
    return folded.select(
        F.when(is_valid & F.col("time_range_valid") & F.col("amount_range_valid") & F.col("class_values_valid"), F.lit("success"))
        .otherwise(F.lit("failed"))
        .alias("status"),
        q[1],
        q[2],
        q[3],
        q[4],
        F.try_divide(F.col("_n1") * F.lit(100.0), F.col("_rows")).alias("fraud_percentage"),
        F.try_divide(F.col("_nmax").cast("double"), F.col("_nmin")).alias("imbalance_ratio"),
        "time_range_valid",
        "amount_range_valid",
        "class_values_valid",
        F.to_json("_dist").alias("class_distribution"),
    )
