"""C11: the preprocessor as an Estimator and a Model of ``pyspark.ml``.

``fit`` learns everything from the training rows, after duplicates are dropped, missing values
filled and amounts beyond ``outlierThreshold`` standard deviations left out: the medians, the
mean and deviation of the amount per day and over all days, and the scalers.  ``transform`` only
applies what was learnt; no row is dropped, added or looked at together with others, so a
row's output does not depend on the batch it comes in.  Both parts are saved and loaded by the
``pyspark.ml`` protocol: the metadata, the learnt numbers as JSON rows, and the days as Parquet.
"""

from __future__ import annotations

import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.functions.features import V_COLS
from riskline.operators import featurize as fz
from riskline.operators import validate as val
from riskline.operators.scale import MINMAX_COLS, ROBUST_COLS, STANDARD_COLS, ScalerModel, fit_scalers
from riskline.operators.selection import column_quantiles
from riskline.sources.staging import drop_stage, stage

BASE_COLS = ["Time", *V_COLS, "Amount"]
LABEL = "Class"
_STATS = "kind string, name string, a double, b double, position int"
_DAYS = "Day int, day_mean double, day_std double"


class _PreprocessorParams(Params):
    temporalFeatures = Param(Params._dummy(), "temporalFeatures", "add hour, day, night and weekend", TypeConverters.toBoolean)
    amountFeatures = Param(Params._dummy(), "amountFeatures", "add log, category and daily z-score of the amount", TypeConverters.toBoolean)
    pcaFeatures = Param(Params._dummy(), "pcaFeatures", "add magnitude and extreme count of the components", TypeConverters.toBoolean)
    removeOutliers = Param(Params._dummy(), "removeOutliers", "learn without amounts beyond the threshold", TypeConverters.toBoolean)
    outlierThreshold = Param(Params._dummy(), "outlierThreshold", "standard deviations of the amount", TypeConverters.toFloat)
    nightVariant = Param(Params._dummy(), "nightVariant", "notebook or module", TypeConverters.toString)
    categoryVariant = Param(Params._dummy(), "categoryVariant", "notebook or module", TypeConverters.toString)
    extremeThreshold = Param(Params._dummy(), "extremeThreshold", "of a component's absolute value", TypeConverters.toFloat)
    minRows = Param(Params._dummy(), "minRows", "rows below which the input is invalid", TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(temporalFeatures=True, amountFeatures=True, pcaFeatures=True, removeOutliers=True, outlierThreshold=fz.OUTLIER_Z,
                         nightVariant="notebook", categoryVariant="notebook", extremeThreshold=3.0, minRows=val.MIN_ROWS)

    def _plain_features(self, df: DataFrame) -> DataFrame:
        """The features of a row alone."""
        get = self.getOrDefault
        if get("temporalFeatures"):
            df = fz.add_temporal(df, get("nightVariant"))
        if get("amountFeatures"):
            df = fz.add_amount(df, get("categoryVariant"))
        return fz.add_pca(df, get("extremeThreshold")) if get("pcaFeatures") else df

    def _with_zscore(self, df: DataFrame, days: DataFrame | None, mean: float, std: float) -> DataFrame:
        """The amount's z-score within its day; a day that was not learnt, or of one row, has the
        deviation (the former also the mean) of all days."""
        if days is None or not (self.getOrDefault("amountFeatures") and "Day" in df.columns):
            return df
        # one row per day: AQE broadcasts it from its measured size
        joined = df.join(days.withColumnRenamed("Day", "_rl_day"), F.col("Day") == F.col("_rl_day"), "left")
        center, spread = F.coalesce("day_mean", F.lit(mean)), F.coalesce("day_std", F.lit(std))
        return joined.withColumn("Amount_Daily_Zscore", (F.col("Amount") - center) / (spread + F.lit(fz.DAILY_Z_EPS))).drop("_rl_day", "day_mean", "day_std")


class TransactionPreprocessor(Estimator, _PreprocessorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns medians, daily statistics and scalers from transactions (Time, V1..V28, Amount; a
    label and other columns pass through)."""

    @keyword_only
    def __init__(self, *, temporalFeatures=True, amountFeatures=True, pcaFeatures=True, removeOutliers=True, outlierThreshold=fz.OUTLIER_Z,
                 nightVariant="notebook", categoryVariant="notebook", extremeThreshold=3.0, minRows=val.MIN_ROWS):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "TransactionPreprocessorModel":
        report = val.dataset_quality(dataset, BASE_COLS, min_rows=self.getOrDefault("minRows")).first()
        if not report["is_valid"]:
            raise ValueError(f"invalid data: {report['message']}")
        # Duplicates are whole rows; only the columns that are learnt from are written.
        plain = stage(_nan_to_null(fz.drop_duplicates(dataset).select(*BASE_COLS)), "preprocess")
        missing = plain.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in BASE_COLS]).first()
        medians = {c: q[0] for c, q in column_quantiles(plain, [c for c in BASE_COLS if missing[c]], [0.5]).items()} if any(missing) else {}
        rows = _filled(plain, medians)
        if self.getOrDefault("removeOutliers"):
            rows = fz.filter_amount_outliers(rows, self.getOrDefault("outlierThreshold"))
        rows = self._plain_features(rows)
        days, mean, std = None, 0.0, 0.0
        if self.getOrDefault("amountFeatures") and "Day" in rows.columns:
            stats = fz.daily_stats(rows).select("Day", F.col("amount_day_mean").alias("day_mean"), F.col("amount_day_std").alias("day_std"))
            days = stats.checkpoint()
            r = rows.agg(F.avg("Amount").alias("m"), F.stddev_samp("Amount").alias("s")).first()
            mean, std = r["m"] or 0.0, r["s"] or 0.0
        rows = self._with_zscore(rows, days, mean, std)
        here = lambda cols: [c for c in cols if c in rows.columns]
        scalers = fit_scalers(rows, here(STANDARD_COLS), here(ROBUST_COLS), here(MINMAX_COLS))
        model = TransactionPreprocessorModel(medians, (mean, std), scalers, list(rows.columns), days)
        drop_stage(plain)
        return self._copyValues(model)


def _nan_to_null(df: DataFrame) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(kinds[c])) for c in BASE_COLS if kinds[c] in ("double", "float")})


def _filled(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m).cast(kinds[c])) for c, m in medians.items()}) if medians else df


class TransactionPreprocessorModel(Model, _PreprocessorParams, MLReadable, MLWritable):
    """What was learnt: ``medians`` (column: value), ``amount`` (mean, deviation), ``scalers``,
    ``feature_names`` in order, and ``days`` (Day, day_mean, day_std)."""

    def __init__(self, medians=None, amount=(0.0, 0.0), scalers=(), feature_names=(), days=None):
        super().__init__()
        self.medians, self.amount, self.scalers = dict(medians or {}), tuple(amount), list(scalers)
        self.feature_names, self.days = list(feature_names), days

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """One row per row: the columns that are no feature, then the features in the learnt order,
        then the label.  A missing value without a learnt median stays missing.  Raises ValueError
        without one of the base columns."""
        absent = [c for c in BASE_COLS if c not in dataset.columns]
        if absent:
            raise ValueError(f"columns are absent: {absent}")
        others = [c for c in dataset.columns if c not in BASE_COLS and c != LABEL and c not in self.feature_names]
        rows = self._plain_features(_filled(_nan_to_null(dataset), self.medians))
        rows = self._with_zscore(rows, self.days, *self.amount)
        for s in self.scalers:
            rows = s.transform(rows)
        features = [F.col(c) if c in rows.columns else F.lit(0).alias(c) for c in self.feature_names]
        return rows.select(*others, *features, *[c for c in (LABEL,) if c in rows.columns])

    def stats(self) -> list[tuple]:
        """The learnt numbers as rows (kind, name, a, b, position)."""
        rows = [("median", c, float(m), None, None) for c, m in self.medians.items()]
        rows.append(("amount", "Amount", float(self.amount[0]), float(self.amount[1]), None))
        rows += [(s.kind, c, float(a), float(b), None) for s in self.scalers for c, (a, b) in s.params.items()]
        return rows + [("feature", c, None, None, k) for k, c in enumerate(self.feature_names)]

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


class _ModelWriter(MLWriter):
    def __init__(self, instance: TransactionPreprocessorModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m = self.instance
        spark = SparkSession.active()
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"hasDays": m.days is not None})
        spark.createDataFrame(m.stats(), _STATS).coalesce(1).write.parquet(os.path.join(path, "stats"))
        if m.days is not None:
            m.days.write.parquet(os.path.join(path, "days"))


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TransactionPreprocessorModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        rows = spark.read.schema(_STATS).parquet(os.path.join(path, "stats")).collect()  # a row per column
        of = lambda kind: [r for r in rows if r["kind"] == kind]
        scalers = [ScalerModel(k, {r["name"]: (r["a"], r["b"]) for r in of(k)}) for k in ("standard", "minmax", "robust") if of(k)]
        amount = of("amount")[0]
        days = spark.read.schema(_DAYS).parquet(os.path.join(path, "days")) if metadata["hasDays"] else None
        model = self.cls({r["name"]: r["a"] for r in of("median")}, (amount["a"], amount["b"]), scalers, [r["name"] for r in sorted(of("feature"), key=lambda r: r["position"])], days)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
