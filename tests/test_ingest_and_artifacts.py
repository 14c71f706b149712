"""Malformed rows, artifacts with a commit marker, the report sink, class balance errors."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.operators import artifacts as ar
from riskline.operators import report as rp
from riskline.operators import validate as val
from riskline.sources import io
from riskline.sources.staging import delete, exists

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("name", T.StringType()), T.StructField("day", T.DateType())])
LINES = [
    "id,x,name,day", "1,1.5,plain,2024-01-01", '2,2.5,"quoted, with comma",2024-01-02', "3,abc,n,2024-01-03", "4,1.0,n", "5,1.0,n,2024-01-05,more", "x,y,n,2024-13-45",
    "6,,,", "", "   ", "7,NaN,n,2024-01-07", '8,"1,5",n,2024-01-08', "9,1e400,n,2024-01-09", "1,1.5,plain,2024-01-01",
]


@pytest.fixture()
def csv(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(LINES))
    (tmp_path / "in" / "b.csv").write_text("id,x,name,day\n20,zzz,n,2024-01-20\n")
    return f"file://{tmp_path}/in"


def test_every_line_is_kept_or_quarantined(spark, csv):
    sound, bad = io.split_malformed(io.scan_with_records(spark, csv, SCHEMA), SCHEMA)
    assert sorted(r.id for r in sound.collect()) == [1, 1, 2, 6, 7, 9]
    got = {r.record: list(r.reasons) for r in bad.collect()}
    assert got == {
        "3,abc,n,2024-01-03": ["x: not double: abc"], "4,1.0,n": ["row: 3 cells, 4 expected"], "5,1.0,n,2024-01-05,more": ["row: 5 cells, 4 expected"],
        "x,y,n,2024-13-45": ["id: not bigint: x", "x: not double: y", "day: not date: 2024-13-45"], '8,"1,5",n,2024-01-08': ["x: not double: 1,5"], "20,zzz,n,2024-01-20": ["x: not double: zzz"],
    }
    assert {r.file.rsplit("/", 1)[1] for r in bad.collect()} == {"a.csv", "b.csv"}


def test_a_bad_cell_shows_whatever_columns_are_read(spark, csv):
    rows = io.scan_with_records(spark, csv, SCHEMA)
    assert rows.where(F.col(io.RECORD).isNull()).select("name").count() == 6
    assert io.split_malformed(rows, SCHEMA)[1].count() == 6


def test_ingest_replaces_its_own_run(spark, csv, tmp_path):
    root = f"file://{tmp_path}/layers"
    for run in ("a", "b", "b"):
        sound, bad = io.ingest_csv(spark, csv, SCHEMA, root, run)
        assert (sound.count(), bad.count()) == (6, 6)
    assert spark.read.parquet(f"{root}/quarantine").groupBy("run").count().count() == 2 and spark.read.parquet(f"{root}/raw").count() == 12


def test_artifacts_round_trip(spark, tmp_path):
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    out = f"file://{tmp_path}/models"
    df = spark.range(50).selectExpr("double(id) as a", "double(id * id) as b")
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="v")
    scaler = StandardScaler(inputCol="v", outputCol="s").fit(vec.transform(df))
    with pytest.raises(FileNotFoundError):
        ar.latest_index(spark, out)
    first = ar.save_artifacts(spark, {"scaler": scaler, "rows": df, "metadata": {"é": [1, 2.5, None]}}, out, "r1")
    second = ar.save_artifacts(spark, {"metadata": {"n": 2}}, out, "r2")
    got = ar.load_artifacts(spark, first)
    assert got["metadata"] == {"é": [1, 2.5, None]} and got["rows"].count() == 50 and got["scaler"].mean == scaler.mean
    assert ar.latest_index(spark, out) == second and ar.load_artifacts(spark, second) == {"metadata": {"n": 2}}
    assert {(r.run, r.name) for r in ar.committed_runs(spark, out).collect()} == {("r1", "scaler"), ("r1", "rows"), ("r1", "metadata"), ("r2", "metadata")}


def test_a_run_that_was_cut_off_is_not_seen(spark, tmp_path):
    out = f"file://{tmp_path}/models"
    kept = ar.save_artifacts(spark, {"metadata": {"n": 1}}, out, "r1")
    ar.save_artifacts(spark, {"metadata": {"n": 2}}, out, "r2")
    with pytest.raises(OSError):  # the run is repeated and fails half way
        ar.save_artifacts(spark, {"metadata": {"n": 3}, "bad": object()}, out, "r2")
    assert ar.latest_index(spark, out) == kept
    with pytest.raises(FileNotFoundError):
        ar.load_artifacts(spark, f"{out}/model/run=r2/index")
    index = ar.save_artifacts(spark, {"metadata": {"n": 4}}, out, "r2")
    delete(spark, f"{out}/model/run=r2/metadata")
    with pytest.raises(OSError) as e:
        ar.load_artifacts(spark, index)
    assert not isinstance(e.value, FileNotFoundError)


def test_artifacts_need_names(spark, tmp_path):
    for bad in ({}, {"a/b": 1}, {"index": 1}, {"": 1}):
        with pytest.raises(ValueError):
            ar.save_artifacts(spark, bad, f"file://{tmp_path}", "r")
    with pytest.raises(ValueError):
        ar.save_artifacts(spark, {"a": 1}, f"file://{tmp_path}", "a/b")


def test_report_sink_and_text(spark, tmp_path):
    root = f"file://{tmp_path}/reports"
    one = spark.createDataFrame([(True, 5, 0.25, None)], "is_valid boolean, rows long, share double, note string")
    report = rp.pipeline_report([rp.step_rows("data_validation", one), rp.step_rows("preprocessing", spark.createDataFrame([(8,)], "features_created int"))])
    rp.write_report(report, root, "r1")
    rp.write_report(report.where("step = 'preprocessing'"), root, "r2")
    rp.write_report(report, root, "r2")
    (tmp_path / "reports" / "run=cut_off").mkdir()
    got = rp.read_reports(spark, root, ["r1", "r2", "cut_off", "never"])
    assert {(r.run, r["count"]) for r in got.groupBy("run").count().collect()} == {("r1", 5), ("r2", 5)}
    lines = rp.report_lines(got.where("run = 'r1'"), "2024-01-01 00:00:00")
    assert lines[:13] == [
        rp.TITLE, "**Date d'exécution:** 2024-01-01 00:00:00", "", rp.SUMMARY, "", "### Data Validation", "", "- **is_valid:** true", "- **rows:** 5", "- **share:** 0.250000", "- **note:** None", "",
        "### Preprocessing",
    ]
    assert lines[-1] == "*Rapport généré automatiquement le 2024-01-01 00:00:00*" and exists(spark, f"{root}/run=r1/_SUCCESS")


def test_class_balance_errors(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (None,)], "Class int")
    got = val.class_balance_metrics(df)
    assert (got["total_samples"], got["class_counts"], got["imbalance_ratio"], got["minority_class"], got["majority_class"]) == (4, {0: 2, 1: 1}, 2.0, 1, 0)
    for bad in (df.limit(0), df.where("Class = 0"), df.where("Class is null"), df.withColumnRenamed("Class", "other")):
        with pytest.raises(ValueError):
            val.class_balance_metrics(bad)
