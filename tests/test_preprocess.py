"""The preprocessor: frozen at fit, rows independent of their batch, saved and loaded."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from riskline.functions.features import V_COLS
from riskline.operators.preprocess import TransactionPreprocessor, TransactionPreprocessorModel

SCHEMA = "event_id long, Time double, " + ", ".join(f"{c} double" for c in V_COLS) + ", Amount double, Class int"


def rows_of(n=400, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        amount = None if k % 37 == 5 else float("nan") if k % 41 == 6 else 1e6 if k % 97 == 3 else float(np.exp(rng.normal() + 3))
        v = [float(x) for x in rng.normal(size=28)]
        if k % 29 == 4:
            v[2] = None
        out.append((k, float(rng.integers(0, 3 * 86400)), *v, amount, int(k % 50 == 0)))
    return out + out[::10]


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA).repartition(3)
    return df, TransactionPreprocessor(minRows=100).fit(df)


def as_dict(df):
    return sorted((tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect()), key=repr)


def test_learns_from_distinct_filled_rows_without_outliers(fitted):
    import pandas as pd

    df, model = fitted
    pdf = df.toPandas().drop_duplicates()
    assert model.medians == {"V3": pdf.V3.median(), "Amount": pdf.Amount.median()}
    pdf = pdf.fillna({"V3": pdf.V3.median(), "Amount": pdf.Amount.median()})
    pdf = pdf[((pdf.Amount - pdf.Amount.mean()) / pdf.Amount.std()).abs() <= 3]
    assert np.isclose(model.amount, (pdf.Amount.mean(), pdf.Amount.std())).all()
    scaler = {c: p for s in model.scalers for c, p in s.params.items()}
    assert np.isclose(scaler["Time"], (pdf.Time.mean(), pdf.Time.std(ddof=0))).all()
    q = pdf.Amount.quantile([0.25, 0.5, 0.75]).values
    assert np.isclose(scaler["Amount"], (q[1], q[2] - q[0])).all()
    days = {r.Day: (r.day_mean, r.day_std) for r in model.days.collect()}
    for day, d in pdf.groupby((pdf.Time // 86400).astype(int)):
        assert np.isclose(days[day], (d.Amount.mean(), d.Amount.std())).all()
    assert pd.Series(model.feature_names).is_unique


def test_no_row_is_dropped_or_depends_on_its_batch(spark, fitted):
    df, model = fitted
    out = model.transform(df)
    assert out.count() == df.count() and out.where("Amount is null or isnan(Amount)").count() == 0
    alone = as_dict(model.transform(df.where("event_id in (0, 5, 6)")))
    assert alone == as_dict(out.where("event_id in (0, 5, 6)"))
    # the median fills an amount that is missing, also in a batch of nothing else
    assert model.transform(df.where("event_id = 5").limit(1)).first()["Amount_log"] == out.where("event_id = 5").first()["Amount_log"]


def test_unseen_days_and_absent_columns(spark, fitted):
    df, model = fitted
    other = df.withColumn("Time", F.lit(50.5 * 86400)).drop("Class").limit(3)
    with pytest.raises(ValueError):
        model.transform(other.drop("V28"))
    out = model.transform(other).collect()
    scaler = {c: p for s in model.scalers for c, p in s.params.items()}
    mean, std = model.amount
    for r in out:
        assert r.Day == 50
        amount = r.Amount * scaler["Amount"][1] + scaler["Amount"][0]
        z = r.Amount_Daily_Zscore * scaler["Amount_Daily_Zscore"][1] + scaler["Amount_Daily_Zscore"][0]
        assert math.isclose(z, (amount - mean) / (std + 1e-8), rel_tol=1e-9)


def test_save_and_load(spark, fitted, tmp_path):
    df, model = fitted
    model.write().save(f"file://{tmp_path}/model")
    loaded = TransactionPreprocessorModel.load(f"file://{tmp_path}/model")
    assert loaded.uid == model.uid and loaded.extractParamMap().values() and loaded.getOrDefault("minRows") == 100
    assert as_dict(loaded.transform(df)) == as_dict(model.transform(df))
    est = TransactionPreprocessor(minRows=7, extremeThreshold=2.0)
    est.write().save(f"file://{tmp_path}/estimator")
    again = TransactionPreprocessor.load(f"file://{tmp_path}/estimator")
    assert (again.getOrDefault("minRows"), again.getOrDefault("extremeThreshold")) == (7, 2.0)


def test_as_a_stage_of_a_pipeline(spark, fitted, tmp_path):
    df, model = fitted
    pipe = Pipeline(stages=[TransactionPreprocessor(minRows=100)]).fit(df)
    pipe.write().save(f"file://{tmp_path}/pipe")
    assert as_dict(PipelineModel.load(f"file://{tmp_path}/pipe").transform(df)) == as_dict(model.transform(df))


def test_streams(spark, fitted, tmp_path):
    df, model = fitted
    df.write.parquet(f"file://{tmp_path}/in")
    out = model.transform(spark.readStream.schema(df.schema).parquet(f"file://{tmp_path}/in"))
    out.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert as_dict(spark.read.schema(out.schema).parquet(f"file://{tmp_path}/out")) == as_dict(model.transform(df))


def test_invalid_input(spark, fitted):
    df, _ = fitted
    with pytest.raises(ValueError):
        TransactionPreprocessor().fit(df)  # fewer than 1000 rows
    with pytest.raises(ValueError):
        TransactionPreprocessor(minRows=1).fit(df.drop("V9"))


def test_features_can_be_left_out(spark, fitted):
    df, _ = fitted
    model = TransactionPreprocessor(minRows=1, temporalFeatures=False, pcaFeatures=False).fit(df)
    assert "Hour" not in model.feature_names and "Amount_Daily_Zscore" not in model.feature_names and "Amount_log" in model.feature_names
    assert model.days is None and model.transform(df).count() == df.count()
