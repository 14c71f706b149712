"""Queries: exploration aggregates and features (A3-A17, T1, F, P, U, C1-C7, W1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskline.operators import explore as ex
from riskline.operators import featurize as fz
from riskline.plans.registry import query
from riskline.plans.sql import FEAT, TX, with_ctes
from riskline.sources import fixtures as fx


def enriched(spark, sf):
    return fz.enrich(fx.transactions(spark, sf))


@query(
    "a9_fraud_by_amount_category",
    with_ctes(TX, FEAT)
    + """SELECT Amount_Category, count(*) AS n, CAST(sum(Class) AS BIGINT) AS frauds, round(avg(Class), 6) AS fraud_rate
FROM feat GROUP BY Amount_Category""",
)
def a9_fraud_by_amount_category(spark, sf):
    """A9 (flagship): scan -> features -> fraud rate and count per amount band."""
    return ex.fraud_by_category(enriched(spark, sf))


V_COLS = [f"V{i}" for i in range(1, 29)]


@query(
    "a3_amount_by_class",
    with_ctes(TX)
    + """SELECT Class, count(*) AS n, round(avg(Amount), 6) AS mean_amount, round(quantile_cont(Amount, 0.5), 6) AS median_amount
FROM transactions GROUP BY Class""",
)
def a3_amount_by_class(spark, sf):
    """A3: mean and exact median of Amount per class."""
    return ex.amount_by_class(fx.transactions(spark, sf))


_A4_COLS = ["Amount", "PCA_Magnitude", "V1", "V2"]


@query(
    "a4_five_number_summary",
    with_ctes(TX, FEAT)
    + " UNION ALL ".join(
        f"""SELECT Class, '{c}' AS feature, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q1,
  round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3, round(max({c}), 6) AS max
FROM feat GROUP BY Class"""
        for c in _A4_COLS
    ),
)
def a4_five_number_summary(spark, sf):
    """A4: boxplot data per class for Amount, PCA_Magnitude and two components."""
    return ex.five_number_summary(enriched(spark, sf), _A4_COLS)


def _hist_sql(col: str, bins: int, upper: float, src: str) -> str:
    return f"""d AS (SELECT Class, {col} AS x FROM {src} WHERE {col} <= {upper} AND {col} IS NOT NULL),
r AS (SELECT Class, min(x) AS lo, max(x) AS hi, count(*) AS n FROM d GROUP BY Class),
b AS (SELECT d.Class, CAST(CASE WHEN (r.hi - r.lo) / {float(bins)} = 0 THEN 0
        ELSE least(floor((d.x - r.lo) / ((r.hi - r.lo) / {float(bins)})), {bins - 1}) END AS INTEGER) AS bin, r.lo, r.hi, r.n
      FROM d JOIN r ON d.Class = r.Class)
SELECT Class, bin, round(lo + bin * ((hi - lo) / {float(bins)}), 6) AS bin_start, count(*) AS count,
  round(CASE WHEN (hi - lo) / {float(bins)} = 0 THEN NULL ELSE count(*) / (n * ((hi - lo) / {float(bins)})) END, 6) AS density
FROM b GROUP BY Class, bin, lo, hi, n"""


@query("a5_amount_histogram_300", with_ctes(TX) + ", " + _hist_sql("Amount", 50, 300.0, "transactions"))
def a5_amount_histogram_300(spark, sf):
    """A5: 50-bin class-wise density of Amount <= 300."""
    return ex.histogram_density(fx.transactions(spark, sf), "Amount", 50, 300.0)


@query("a5_amount_histogram_500", with_ctes(TX) + ", " + _hist_sql("Amount", 30, 500.0, "transactions"))
def a5_amount_histogram_500(spark, sf):
    """A5: 30-bin class-wise density of Amount <= 500 (bias view)."""
    return ex.histogram_density(fx.transactions(spark, sf), "Amount", 30, 500.0)


@query("a5_amount_log_histogram", with_ctes(TX, FEAT) + ", " + _hist_sql("Amount_log", 40, 1e308, "feat"))
def a5_amount_log_histogram(spark, sf):
    """A5: 40-bin class-wise density of log1p(Amount)."""
    df = enriched(spark, sf)
    return ex.histogram_density(df, "Amount_log", 40, 1e308)


@query(
    "a6_hourly_volume",
    with_ctes(TX, FEAT) + "SELECT CAST(floor(Hour) AS INTEGER) AS hour, Class, count(*) AS n FROM feat GROUP BY 1, 2",
)
def a6_hourly_volume(spark, sf):
    """Volume per hour of day and class."""
    return ex.hourly_volume(enriched(spark, sf))


@query(
    "a7_hourly_share",
    with_ctes(TX, FEAT, "h AS (SELECT CAST(floor(Hour) AS INTEGER) AS hour, Class, count(*) AS n FROM feat GROUP BY 1, 2)")
    + "SELECT hour, Class, n, round(n * 100.0 / sum(n) OVER (PARTITION BY Class), 6) AS pct FROM h",
)
def a7_hourly_share(spark, sf):
    """Hourly share within class, %."""
    return ex.hourly_share(enriched(spark, sf))


@query(
    "a8_night_day_fraud",
    with_ctes(TX, FEAT)
    + """SELECT round(avg(CASE WHEN Is_Night = 1 THEN Class END), 6) AS night_rate,
  round(avg(CASE WHEN Is_Night <> 1 THEN Class END), 6) AS day_rate,
  count(CASE WHEN Is_Night = 1 THEN 1 END) AS night_n, count(CASE WHEN Is_Night <> 1 THEN 1 END) AS day_n,
  round(avg(CASE WHEN Is_Night = 1 THEN Class END) / nullif(avg(CASE WHEN Is_Night <> 1 THEN Class END), 0), 6) AS night_day_ratio
FROM feat""",
)
def a8_night_day_fraud(spark, sf):
    """Fraud rate by night/day and the night/day ratio."""
    return ex.night_day_fraud(enriched(spark, sf))


@query(
    "a10_extreme_by_class",
    with_ctes(TX, FEAT)
    + """SELECT round(avg(CASE WHEN Class = 0 THEN PCA_Extreme_Count END), 6) AS mean_extreme_normal,
  round(avg(CASE WHEN Class = 1 THEN PCA_Extreme_Count END), 6) AS mean_extreme_fraud,
  round(avg(CASE WHEN Class = 1 THEN PCA_Extreme_Count END) / nullif(avg(CASE WHEN Class = 0 THEN PCA_Extreme_Count END), 0), 6) AS extreme_ratio
FROM feat""",
)
def a10_extreme_by_class(spark, sf):
    """A10: mean extreme-component count per class and ratio."""
    return ex.extreme_by_class(enriched(spark, sf))


_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{v}' AS feature, round(abs(corr({v}, CAST(Class AS DOUBLE))), 6) AS abs_corr FROM transactions" for v in V_COLS
)


@query("a11_abs_correlation", with_ctes(TX) + _CORR_SQL)
def a11_abs_correlation(spark, sf):
    """|Pearson r| of V1..V28 with Class."""
    return ex.abs_correlations(fx.transactions(spark, sf), V_COLS)


@query(
    "t1_top5_correlated",
    with_ctes(TX, f"c AS ({_CORR_SQL})")
    + "SELECT feature, abs_corr, rank FROM (SELECT feature, abs_corr, row_number() OVER (ORDER BY abs_corr DESC, feature) AS rank "
    + "FROM c WHERE abs_corr IS NOT NULL) WHERE rank <= 5",
)
def t1_top5_correlated(spark, sf):
    """Top-5 components by |corr| with Class."""
    return ex.top_correlated(fx.transactions(spark, sf), V_COLS, 5)


_A12_COLS = ["Time", *V_COLS, "Amount", "Class"]


@query(
    "a12_distinct_counts",
    with_ctes(TX)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(DISTINCT CAST({chr(34) + c + chr(34) if c == 'Time' else c} AS DOUBLE)) AS n_distinct FROM transactions"
        for c in _A12_COLS
    ),
)
def a12_distinct_counts(spark, sf):
    """Exact distinct count of every base column (one shuffle)."""
    return ex.distinct_counts(fx.transactions(spark, sf), _A12_COLS)


@query(
    "a13_daily_amount_stats",
    with_ctes(TX, FEAT)
    + "SELECT Day, round(avg(Amount), 6) AS amount_day_mean, round(stddev_samp(Amount), 6) AS amount_day_std, count(*) AS n FROM feat GROUP BY Day",
)
def a13_daily_amount_stats(spark, sf):
    """Per-day mean and sample std of Amount."""
    d = fz.daily_stats(enriched(spark, sf))
    return d.select("Day", F.round("amount_day_mean", 6).alias("amount_day_mean"), F.round("amount_day_std", 6).alias("amount_day_std"), "n")


@query(
    "a14_time_span",
    with_ctes(TX)
    + """SELECT min("Time") AS time_min, max("Time") AS time_max, round(max("Time") / 86400.0, 6) AS span_days,
  min(Amount) AS amount_min, max(Amount) AS amount_max FROM transactions""",
)
def a14_time_span(spark, sf):
    """Ranges and span in days."""
    return ex.time_span(fx.transactions(spark, sf))


@query(
    "a15_reidentification_risk",
    with_ctes(TX, "p AS (SELECT count(*) AS distinct_pairs FROM (SELECT DISTINCT \"Time\", Amount FROM transactions))",
              "r AS (SELECT count(*) AS rows FROM transactions)")
    + """SELECT distinct_pairs, rows, round(distinct_pairs / rows, 6) AS risk,
  CASE WHEN distinct_pairs / rows > 0.8 THEN 'ÉLEVÉ' ELSE 'MOYEN' END AS level FROM p, r""",
)
def a15_reidentification_risk(spark, sf):
    """Re-identification risk from distinct (Time, Amount) pairs."""
    return ex.reidentification_risk(fx.transactions(spark, sf))


@query(
    "a16_overview",
    with_ctes(TX)
    + "SELECT count(*) AS rows, 31 AS columns, CAST(coalesce(sum("
    + " + ".join(f"CAST({c} IS NULL OR isnan({c}) AS BIGINT)" for c in ['"Time"', *V_COLS, "Amount"])
    + " + CAST(Class IS NULL AS BIGINT)), 0) AS BIGINT) AS missing_cells FROM transactions",
)
def a16_overview(spark, sf):
    """Dataset overview (rows, columns, missing cells)."""
    return ex.overview(fx.transactions(spark, sf).drop("event_id"))


@query(
    "a17_insights",
    with_ctes(
        TX,
        f"c AS ({_CORR_SQL})",
        "t AS (SELECT string_agg(feature, ',' ORDER BY rank) AS top_features FROM (SELECT feature, row_number() OVER (ORDER BY abs_corr DESC, feature) AS rank FROM c WHERE abs_corr IS NOT NULL) WHERE rank <= 5)",
        "s AS (SELECT count(*) AS total_transactions, sum(CASE WHEN Class = 0 THEN 1 ELSE 0 END) AS n0, sum(CASE WHEN Class = 1 THEN 1 ELSE 0 END) AS n1, "
        "avg(CASE WHEN Class = 0 THEN Amount END) AS m0, avg(CASE WHEN Class = 1 THEN Amount END) AS m1 FROM transactions)",
    )
    + """SELECT total_transactions, '1:' || printf('%.0f', CAST(n0 AS DOUBLE) / n1) AS fraud_ratio, 31 AS total_variables, top_features,
  round(m0, 2) AS avg_amount_normal, round(m1, 2) AS avg_amount_fraud FROM s, t""",
)
def a17_insights(spark, sf):
    """Insights row (rows, ratio, top features, mean amounts)."""
    return ex.insights(fx.transactions(spark, sf).drop("event_id"), V_COLS)


# ---- features (F1-F13, C5-C7) -----------------------------------------------------------

@query(
    "f_enriched_features",
    with_ctes(TX, FEAT)
    + """SELECT event_id, round(Hour, 6) AS Hour, Day, Is_Night, Is_Weekend, round(Amount_log, 6) AS Amount_log, Amount_Category,
  round(PCA_Magnitude, 6) AS PCA_Magnitude, PCA_Extreme_Count FROM feat""",
)
def f_enriched_features(spark, sf):
    """The eight engineered columns per transaction (notebook variants; abs, sqrt, rounding)."""
    df = enriched(spark, sf)
    return df.select(
        "event_id", F.round("Hour", 6).alias("Hour"), "Day", "Is_Night", "Is_Weekend", F.round("Amount_log", 6).alias("Amount_log"),
        "Amount_Category", F.round("PCA_Magnitude", 6).alias("PCA_Magnitude"), "PCA_Extreme_Count",
    )


@query(
    "f_module_variants",
    with_ctes(TX)
    + f"""SELECT event_id,
  CAST(((("Time" / 3600.0) % 24.0) >= 22 OR (("Time" / 3600.0) % 24.0) < 6) AS INTEGER) AS Is_Night,
  CASE WHEN Amount IS NULL OR Amount <= 0 THEN -1 WHEN Amount <= 10 THEN 0 WHEN Amount <= 50 THEN 1
       WHEN Amount <= 200 THEN 2 WHEN Amount <= 1000 THEN 3 ELSE 4 END AS Amount_Category,
  {__import__('riskline.plans.sql', fromlist=['extreme_count_sql']).extreme_count_sql(2.0)} AS PCA_Extreme_Count
FROM transactions""",
)
def f_module_variants(spark, sf):
    """F3/F6/F8 library-module variants: hour < 6, five right-closed bins, |V| > 2."""
    df = fz.enrich(fx.transactions(spark, sf), night_variant="module", category_variant="five_bin", extreme_threshold=2.0)
    return df.select("event_id", "Is_Night", "Amount_Category", "PCA_Extreme_Count")


@query(
    "f_amount_category_large",
    """WITH li AS (SELECT l_extendedprice / 100.0 AS Amount FROM lineitem)
SELECT CASE WHEN Amount IS NULL OR Amount <= 0 THEN -1 WHEN Amount <= 10 THEN 0 WHEN Amount <= 50 THEN 1
       WHEN Amount <= 200 THEN 2 WHEN Amount <= 1000 THEN 3 ELSE 4 END AS five_bin,
  CASE WHEN Amount > 200 THEN 3 WHEN Amount > 50 THEN 2 WHEN Amount > 10 THEN 1 ELSE 0 END AS notebook,
  count(*) AS n FROM li GROUP BY 1, 2""",
)
def f_amount_category_large(spark, sf):
    """F6 both variants over lineitem prices /100 (reaches the > 1000 top band)."""
    from riskline.functions import features as fn

    li = fx.lineitem_amounts(spark, sf).select((F.col("Amount") / F.lit(100.0)).alias("Amount"))
    return li.groupBy(
        fn.amount_category("Amount", "five_bin").alias("five_bin"), fn.amount_category("Amount", "notebook").alias("notebook")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "f11_default_transaction_id",
    with_ctes(TX)
    + """SELECT event_id, coalesce(CASE WHEN Class = 1 THEN 'FR-' || CAST(event_id AS VARCHAR) END, 'txn_' || CAST(event_id AS VARCHAR)) AS transaction_id
FROM transactions""",
)
def f11_default_transaction_id(spark, sf):
    """keep a supplied id, else a per-row ``txn_<key>`` id."""
    from riskline.functions import features as fn

    tx = fx.transactions(spark, sf).withColumn(
        "transaction_id", F.when(F.col("Class") == 1, F.concat(F.lit("FR-"), F.col("event_id").cast("string")))
    )
    return tx.select("event_id", fn.default_transaction_id("transaction_id", "event_id").alias("transaction_id"))


@query(
    "f12_request_length_check",
    with_ctes(TX)
    + """SELECT CASE WHEN Class = 1 THEN 29 ELSE 30 END = 30 AS length_ok, count(*) AS n FROM transactions GROUP BY 1""",
)
def f12_request_length_check(spark, sf):
    """scoring requests with 30 features pass, truncated ones (29) fail."""
    from riskline.operators.scoring import requests_from_transactions
    from riskline.functions import features as fn

    req = requests_from_transactions(fx.transactions(spark, sf))
    req = req.withColumn("features", F.when(F.col("Class") == 1, F.slice("features", 1, 29)).otherwise(F.col("features")))
    return req.groupBy(fn.features_length_ok("features").alias("length_ok")).agg(F.count(F.lit(1)).alias("n"))


# ---- predicates and projections (P1-P7) -------------------------------------------------

@query("p1_fraud_rows", with_ctes(TX) + 'SELECT event_id, "Time", Amount FROM transactions WHERE Class = 1')
def p1_fraud_rows(spark, sf):
    """Split by class (fraud side)."""
    return fx.transactions(spark, sf).where(F.col("Class") == 1).select("event_id", "Time", "Amount")


@query(
    "p2_amount_bound_counts",
    with_ctes(TX) + "SELECT Class, count(CASE WHEN Amount <= 300 THEN 1 END) AS n_le_300, count(*) AS n_le_500 FROM transactions WHERE Amount <= 500 GROUP BY Class",
)
def p2_amount_bound_counts(spark, sf):
    """Rows under the 300 and 500 amount bounds, per class."""
    tx = fx.transactions(spark, sf).where(F.col("Amount") <= F.lit(500.0))
    return tx.groupBy("Class").agg(
        F.count(F.when(F.col("Amount") <= F.lit(300.0), F.lit(1))).alias("n_le_300"), F.count(F.lit(1)).alias("n_le_500")
    )


@query(
    "p3_night_rows",
    with_ctes(TX, FEAT) + "SELECT event_id, round(Hour, 6) AS Hour, Class FROM feat WHERE Hour >= 22 OR Hour <= 6",
)
def p3_night_rows(spark, sf):
    """Night predicate with OR."""
    df = enriched(spark, sf)
    return df.where((F.col("Hour") >= 22) | (F.col("Hour") <= 6)).select("event_id", F.round("Hour", 6).alias("Hour"), "Class")


@query(
    "p4_feature_selection",
    with_ctes(TX) + "SELECT event_id, " + ", ".join(V_COLS) + " FROM transactions",
)
def p4_feature_selection(spark, sf):
    """Select the component columns by name prefix."""
    df = fx.transactions(spark, sf)
    return df.select("event_id", *[c for c in df.columns if c.startswith("V")])


@query(
    "p5_schema_alignment",
    with_ctes(TX, FEAT) + "SELECT event_id, Amount, round(Amount_log, 6) AS Amount_log, 0 AS Amount_Daily_Zscore, Is_Night, Class FROM feat",
)
def p5_schema_alignment(spark, sf):
    """P5: align to a fitted feature list; absent columns become 0, label last."""
    from riskline.operators.scale import align_to_features

    df = enriched(spark, sf).withColumn("Amount_log", F.round("Amount_log", 6))
    return align_to_features(df, ["event_id", "Amount", "Amount_log", "Amount_Daily_Zscore", "Is_Night"], label="Class")


@query("p6_drop_target", with_ctes(TX) + 'SELECT event_id, "Time", ' + ", ".join(V_COLS) + ", Amount FROM transactions")
def p6_drop_target(spark, sf):
    """Drop the label column."""
    return fx.transactions(spark, sf).drop("Class")


@query(
    "p7_bool_to_int",
    with_ctes(TX) + "SELECT event_id, CAST(Amount > 100 AS INTEGER) AS high_amount FROM transactions",
)
def p7_bool_to_int(spark, sf):
    """Boolean predicate cast to 0/1."""
    return fx.transactions(spark, sf).select("event_id", (F.col("Amount") > 100).cast("int").alias("high_amount"))


# ---- set operations (U1-U3) --------------------------------------------------------------

@query(
    "u1_union_by_class",
    with_ctes(TX) + "SELECT Class, count(*) AS n FROM (SELECT * FROM transactions WHERE Class = 0 UNION ALL SELECT * FROM transactions WHERE Class = 1) GROUP BY Class",
)
def u1_union_by_class(spark, sf):
    """Union-all of the class-split halves (by name)."""
    tx = fx.transactions(spark, sf)
    u = tx.where(F.col("Class") == 0).unionByName(tx.where(F.col("Class") == 1))
    return u.groupBy("Class").agg(F.count(F.lit(1)).alias("n"))


@query(
    "u2_dedup_rows",
    with_ctes(TX, "d AS (SELECT * EXCLUDE (event_id) FROM transactions UNION ALL SELECT * EXCLUDE (event_id) FROM transactions WHERE event_id % 10 = 0)")
    + 'SELECT count(*) AS rows_after, (SELECT count(*) FROM d) AS rows_before FROM (SELECT DISTINCT * FROM d)',
)
def u2_dedup_rows(spark, sf):
    """Whole-row dedup of the table with every 10th row duplicated."""
    d = fx.transactions_with_duplicates(spark, sf)
    before = d.agg(F.count(F.lit(1)).alias("rows_before"))
    after = fz.drop_duplicates(d).agg(F.count(F.lit(1)).alias("rows_after"))
    return after.withColumn("_k", F.lit(1)).join(before.withColumn("_k", F.lit(1)), "_k").drop("_k")


@query("u3_distinct_pairs", with_ctes(TX) + 'SELECT DISTINCT "Time", Amount FROM transactions')
def u3_distinct_pairs(spark, sf):
    """Distinct (Time, Amount)."""
    return fx.transactions(spark, sf).select("Time", "Amount").distinct()


# ---- cleaning (C2-C4, W1) ----------------------------------------------------------------

@query(
    "c2_median_imputation",
    with_ctes(TX, "t AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE Amount END AS Amount FROM transactions)")
    + "SELECT event_id, coalesce(Amount, (SELECT quantile_cont(Amount, 0.5) FROM t)) AS Amount FROM t",
)
def c2_median_imputation(spark, sf):
    """Exact-median imputation of missing Amount."""
    df = fx.transactions_with_nulls(spark, sf).select("event_id", "Amount")
    return fz.impute_median(df, ["Amount"])


@query(
    "c3_outlier_filter",
    with_ctes(TX, "s AS (SELECT avg(Amount) AS m, stddev_samp(Amount) AS sd FROM transactions)")
    + "SELECT event_id, Amount FROM transactions, s WHERE abs((Amount - s.m) / s.sd) <= 3.0",
)
def c3_outlier_filter(spark, sf):
    """Keep |z| <= 3 on Amount (sample std)."""
    return fz.filter_amount_outliers(fx.transactions(spark, sf).select("event_id", "Amount"))


@query(
    "c4_iqr_filter",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT count(*) AS kept, min(l_extendedprice) AS kept_min, max(l_extendedprice) AS kept_max FROM lineitem, q
WHERE l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""",
)
def c4_iqr_filter(spark, sf):
    """C4: IQR x1.5 rule on large amounts (lineitem prices)."""
    kept = fz.iqr_filter(fx.lineitem_amounts(spark, sf), "Amount")
    return kept.agg(F.count(F.lit(1)).alias("kept"), F.min("Amount").alias("kept_min"), F.max("Amount").alias("kept_max"))


@query(
    "c4_percentile_cap",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.995) AS cap FROM lineitem)
SELECT round(sum(least(l_extendedprice, cap)), 4) AS capped_sum, round(max(least(l_extendedprice, cap)), 6) AS capped_max FROM lineitem, q""",
)
def c4_percentile_cap(spark, sf):
    """C4: cap at the exact 99.5th percentile."""
    capped = fz.percentile_cap(fx.lineitem_amounts(spark, sf), "Amount", 0.995)
    return capped.agg(F.round(F.sum("Amount"), 4).alias("capped_sum"), F.round(F.max("Amount"), 6).alias("capped_max"))


@query(
    "w1_daily_zscore",
    with_ctes(TX, FEAT, "s AS (SELECT Day, avg(Amount) AS m, stddev_samp(Amount) AS sd FROM feat GROUP BY Day)")
    + "SELECT f.event_id, f.Day, round((f.Amount - s.m) / (coalesce(s.sd, 0.0) + 1e-8), 6) AS Amount_Daily_Zscore FROM feat f JOIN s ON f.Day = s.Day",
)
def w1_daily_zscore(spark, sf):
    """Daily z-score of Amount (aggregate + size-checked broadcast join)."""
    df = fz.add_daily_zscore(enriched(spark, sf))
    return df.select("event_id", "Day", F.round("Amount_Daily_Zscore", 6).alias("Amount_Daily_Zscore"))
