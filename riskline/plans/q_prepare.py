"""Queries: scalers, preprocessor, split, folds, weights."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from riskline.functions.rng import lcg_uniform_sql
from riskline.operators import featurize as fz
from riskline.operators import scale as sc
from riskline.operators import split as sp
from riskline.operators.preprocess import TransactionPreprocessor, TransactionPreprocessorModel
from riskline.plans.registry import query
from riskline.plans.sql import FEAT, TX, with_ctes
from riskline.session import ensure_checkpoint_dir
from riskline.sources import fixtures as fx

_DZ = "dz AS (SELECT f.*, (f.Amount - s.m) / (coalesce(s.sd, 0.0) + 1e-8) AS Amount_Daily_Zscore FROM feat f JOIN (SELECT Day, avg(Amount) AS m, stddev_samp(Amount) AS sd FROM feat GROUP BY Day) s ON f.Day = s.Day)"


def _feat_dz(spark, sf):
    return fz.add_daily_zscore(fz.enrich(fx.transactions(spark, sf)))


def _std_sql(c):
    return f"round(CASE WHEN stddev_pop({c}) OVER () = 0 THEN {c} - avg({c}) OVER () ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END, 6) AS {c}"


def _mm_sql(c):
    return f"round(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN {c} - min({c}) OVER () ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END, 6) AS {c}"


@query(
    "c8_c10_scaled_features",
    with_ctes(TX, FEAT, _DZ,
              "q AS (SELECT quantile_cont(Amount, 0.25) AS q1, quantile_cont(Amount, 0.5) AS med, quantile_cont(Amount, 0.75) AS q3 FROM dz)")
    + "SELECT event_id, "
    + ", ".join(_std_sql(c if c != "Time" else '"Time"').replace('AS "Time"', 'AS "Time"') for c in sc.STANDARD_COLS)
    + ", round(CASE WHEN q.q3 = q.q1 THEN Amount - q.med ELSE (Amount - q.med) / (q.q3 - q.q1) END, 6) AS Amount, "
    + ", ".join(_mm_sql(c) for c in sc.MINMAX_COLS)
    + " FROM dz, q",
)
def c8_c10_scaled_features(spark, sf):
    """Standard (population std), robust (exact median / IQR) and min-max scaling."""
    df = _feat_dz(spark, sf)
    out = df
    for m in sc.fit_scalers(df, sc.STANDARD_COLS, sc.ROBUST_COLS, sc.MINMAX_COLS):
        out = m.transform(out)
    cols = [*sc.STANDARD_COLS, *sc.ROBUST_COLS, *sc.MINMAX_COLS]
    return out.select("event_id", *[F.round(c, 6).alias(c) for c in cols])


_SPLIT_SQL = f"""r AS (SELECT event_id, Class,
    row_number() OVER (PARTITION BY Class ORDER BY {lcg_uniform_sql('event_id')}, event_id) AS rn,
    count(*) OVER (PARTITION BY Class) AS nc FROM transactions),
c AS (SELECT *, floor(nc * 0.2 + 0.5) AS n_test FROM r),
d AS (SELECT *, floor((nc - n_test) * 0.2 + 0.5) AS n_val FROM c)"""


@query(
    "c12_stratified_split",
    with_ctes(TX, _SPLIT_SQL)
    + "SELECT event_id, Class, CASE WHEN rn <= n_test THEN 'test' WHEN rn <= n_test + n_val THEN 'val' ELSE 'train' END AS split FROM d",
)
def c12_stratified_split(spark, sf):
    """Exact stratified 64/16/20 split with a seeded order."""
    return sp.stratified_split(fx.transactions(spark, sf).select("event_id", "Class")).select("event_id", "Class", "split")


@query(
    "c12_split_summary",
    with_ctes(TX, _SPLIT_SQL)
    + ", e AS (SELECT Class, CASE WHEN rn <= n_test THEN 'test' WHEN rn <= n_test + n_val THEN 'val' ELSE 'train' END AS split FROM d) "
    + "SELECT split, Class, count(*) AS n FROM e GROUP BY 1, 2",
)
def c12_split_summary(spark, sf):
    """Rows per split and class (stratification check)."""
    s = sp.stratified_split(fx.transactions(spark, sf).select("event_id", "Class"))
    return s.groupBy("split", "Class").agg(F.count(F.lit(1)).alias("n"))


@query(
    "m6_stratified_folds",
    with_ctes(TX)
    + f"SELECT event_id, Class, CAST((row_number() OVER (PARTITION BY Class ORDER BY {lcg_uniform_sql('event_id')}, event_id) - 1) % 5 AS INTEGER) AS fold FROM transactions",
)
def m6_stratified_folds(spark, sf):
    """M6: stratified 5-fold assignment."""
    return sp.stratified_folds(fx.transactions(spark, sf).select("event_id", "Class"), 5).select("event_id", "Class", "fold")


@query(
    "m5_balanced_weights",
    with_ctes(TX, "c AS (SELECT Class, count(*) AS nc FROM transactions GROUP BY Class)")
    + "SELECT t.event_id, t.Class, round((SELECT count(*) FROM transactions) / ((SELECT count(*) FROM c) * c.nc), 6) AS weight FROM transactions t JOIN c ON t.Class = c.Class",
)
def m5_balanced_weights(spark, sf):
    """M5: balanced class weights n / (2 n_c)."""
    w = sp.balanced_weights(fx.transactions(spark, sf).select("event_id", "Class"))
    return w.select("event_id", "Class", F.round("weight", 6).alias("weight"))


def _train_test(spark, sf):
    df = fz.enrich(fx.transactions(spark, sf))
    return sp.stratified_split(df, test_size=0.3, val_size=0.0)


_C13_SQL = f"""r AS (SELECT *, row_number() OVER (PARTITION BY Class ORDER BY {lcg_uniform_sql('event_id')}, event_id) AS rn,
    count(*) OVER (PARTITION BY Class) AS nc FROM feat),
s AS (SELECT *, CASE WHEN rn <= floor(nc * 0.3 + 0.5) THEN 'test' ELSE 'train' END AS split FROM r),
st AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in sc.MODEL_FEATURES)} FROM s WHERE split = 'train')"""


@query(
    "c13_standardize_on_train",
    with_ctes(TX, FEAT, _C13_SQL)
    + "SELECT event_id, "
    + ", ".join(f"round(CASE WHEN s_{c} = 0 THEN {c} - m_{c} ELSE ({c} - m_{c}) / s_{c} END, 6) AS {c}" for c in sc.MODEL_FEATURES)
    + " FROM s, st WHERE split = 'test'",
)
def c13_standardize_on_train(spark, sf):
    """Standardise the 37 model features with train-only statistics, applied to test."""
    df = _train_test(spark, sf)
    train = df.where(F.col("split") == "train")
    model = sc.fit_standard(train, sc.MODEL_FEATURES)
    test = model.transform(df.where(F.col("split") == "test"))
    return test.select("event_id", *[F.round(c, 6).alias(c) for c in sc.MODEL_FEATURES])


def _dirty(spark, sf):
    """Transactions with missing amounts and components and an exact copy of every tenth row."""
    tx = fx.transactions(spark, sf)
    key = F.col("event_id")
    tx = tx.withColumns({"Amount": F.when(F.pmod(key, F.lit(97)) == 0, F.lit(None)).otherwise(F.col("Amount")),
                         "V3": F.when(F.pmod(key, F.lit(101)) == 0, F.lit(float("nan"))).otherwise(F.col("V3"))})
    return tx.unionByName(tx.where(F.pmod(key, F.lit(10)) == 0))


_XFEAT = FEAT.replace("feat", "xfeat").replace("FROM transactions", "FROM ximp")
_FFEAT = FEAT.replace("FROM transactions", "FROM fimp")
_C11_COLS = ["Time", *[c for c in sc.V_COLS], "Amount", "Hour", "Day", "Is_Night", "Is_Weekend", "Amount_log", "Amount_Category", "PCA_Magnitude", "PCA_Extreme_Count", "Amount_Daily_Zscore"]


def _c11_sql() -> str:
    q = lambda c: '"Time"' if c == "Time" else c
    fill = "SELECT d.* REPLACE (coalesce(d.Amount, med.a) AS Amount, coalesce(d.V3, med.v) AS V3) FROM {} d, med"
    z = "(f.Amount - coalesce(s.m, g.m)) / (coalesce(s.sd, g.sd) + 1e-8) AS Amount_Daily_Zscore"
    z = f"SELECT f.*, {z} FROM {{}} f LEFT JOIN days s ON f.Day = s.Day, g"
    stats = [f"avg({q(c)}) AS m_{c}, stddev_pop({q(c)}) AS s_{c}" for c in sc.STANDARD_COLS]
    stats += [f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}" for c in sc.ROBUST_COLS]
    stats += [f"min({c}) AS m_{c}, max({c}) - min({c}) AS s_{c}" for c in sc.MINMAX_COLS]
    scaled = {*sc.STANDARD_COLS, *sc.ROBUST_COLS, *sc.MINMAX_COLS}
    out = [f"round(({q(c)} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {q(c)}" if c in scaled else f"round({c}, 6) AS {c}" for c in _C11_COLS]
    return with_ctes(
        TX,
        "one AS (SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN NULL ELSE Amount END AS Amount, CASE WHEN event_id % 101 = 0 THEN NULL ELSE V3 END AS V3) FROM transactions)",
        "dirty AS (SELECT * FROM one UNION ALL SELECT * FROM one WHERE event_id % 10 = 0)",
        "ded AS (SELECT DISTINCT * FROM dirty)",
        "med AS (SELECT quantile_cont(Amount, 0.5) AS a, quantile_cont(V3, 0.5) AS v FROM ded)",
        f"dimp AS ({fill.format('ded')})", f"ximp AS ({fill.format('dirty')})",
        "st AS (SELECT avg(Amount) AS m, stddev_samp(Amount) AS s FROM dimp)",
        "fimp AS (SELECT dimp.* FROM dimp, st WHERE abs((Amount - m) / s) <= 3)",
        _FFEAT, _XFEAT,
        "days AS (SELECT Day, avg(Amount) AS m, stddev_samp(Amount) AS sd FROM feat GROUP BY Day)",
        "g AS (SELECT avg(Amount) AS m, stddev_samp(Amount) AS sd FROM feat)",
        f"fz AS ({z.format('feat')})", f"xz AS ({z.format('xfeat')})",
        f"sc AS (SELECT {', '.join(stats)} FROM fz)",
    ) + f"SELECT event_id, {', '.join(out)}, Class FROM xz, sc"


@query("c11_preprocessor_fit_transform", _c11_sql())
def c11_preprocessor_fit_transform(spark, sf):
    """C11: fit on rows with missing values, copies and outliers; transform keeps every row."""
    df = _dirty(spark, sf)
    out = TransactionPreprocessor().fit(df).transform(df)
    return out.select("event_id", *[F.round(c, 6).alias(c) for c in _C11_COLS], "Class")


@query("c11_preprocessor_saved", _c11_sql())
def c11_preprocessor_saved(spark, sf):
    """C11: the fitted preprocessor written, loaded and applied gives the same rows."""
    df = _dirty(spark, sf)
    path = os.path.join(ensure_checkpoint_dir(spark), "models", f"preprocessor-{uuid.uuid4().hex}")
    TransactionPreprocessor().fit(df).write().save(path)
    out = TransactionPreprocessorModel.load(path).transform(df)
    return out.select("event_id", *[F.round(c, 6).alias(c) for c in _C11_COLS], "Class")
