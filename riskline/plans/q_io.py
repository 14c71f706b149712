"""Queries: CSV scan, layered sink, schema contract, SVM-SMOTE."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.operators import validate as val
from riskline.operators.featurize import enrich
from riskline.plans.registry import query
from riskline.plans.sql import FEAT, TX, V, with_ctes
from riskline.session import ensure_checkpoint_dir
from riskline.sources import fixtures as fx
from riskline.sources import io


def _scratch(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), "io", f"{name}-{uuid.uuid4().hex[:12]}")


@query("s1_csv_scan", with_ctes(TX) + 'SELECT event_id, "Time", ' + ", ".join(V) + ", Amount, Class FROM transactions")
def s1_csv_scan(spark, sf):
    """Transactions written as header CSV and scanned back with the typed contract."""
    path = _scratch(spark, "csv")
    fx.transactions(spark, sf).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), *val.CONTRACT.fields])
    return io.read_transactions_csv(spark, path, schema)


@query(
    "s2_layered_sink",
    with_ctes(TX, FEAT) + "SELECT Day, count(*) AS n, CAST(sum(Class) AS BIGINT) AS frauds FROM feat GROUP BY Day",
)
def s2_layered_sink(spark, sf):
    """Processed layer written partitioned by Day, and all of it read back."""
    root = _scratch(spark, "layers")
    io.write_layer(enrich(fx.transactions(spark, sf)), root, "processed")
    back = io.read_layer(spark, root, "processed")
    return back.groupBy("Day").agg(F.count(F.lit(1)).alias("n"), F.sum("Class").cast("bigint").alias("frauds"))


@query(
    "v2_schema_contract",
    with_ctes(TX)
    + " UNION ALL ".join(
        f"""SELECT '{c.strip('"')}' AS "column", '{t}' AS expected_type, '{t}' AS actual_type, true AS matches, count({c}) AS n_values, CAST(0 AS BIGINT) AS n_malformed FROM transactions"""
        for c, t in [('"Time"', "double"), *[(v, "double") for v in V], ("Amount", "double"), ("Class", "int")]
    ),
)
def v2_schema_contract(spark, sf):
    """V2: the transaction table's schema and values against the declared type contract."""
    return val.schema_contract(fx.transactions(spark, sf).select(*fx.BASE_COLUMNS))


_COLS = ["event_id", "Time", *V, "Amount", "Class"]
_N = len(_COLS)


@query(
    "v2_malformed_rows",
    with_ctes(
        TX,
        "r AS (SELECT event_id, Amount, Class, list_filter(["
        "CASE WHEN event_id % 83 = 5 THEN 'Time: not double: 12h' END, CASE WHEN event_id % 71 = 3 THEN 'V7: not double: 1.2.3' END, "
        "CASE WHEN event_id % 50 = 7 THEN 'Amount: not double: abc' END, CASE WHEN event_id % 60 = 9 AND event_id % 110 <> 13 THEN 'Class: not int: 1.5' END, "
        f"CASE WHEN event_id % 90 = 11 AND event_id % 110 <> 13 THEN 'row: {_N + 1} cells, {_N} expected' WHEN event_id % 90 <> 11 AND event_id % 110 = 13 THEN 'row: {_N - 1} cells, {_N} expected' END"
        "], lambda x: x IS NOT NULL) AS w FROM transactions)",
    )
    + "SELECT CAST(event_id AS VARCHAR) AS event_id, len(w) > 0 AS quarantined, array_to_string(w, '; ') AS reasons, "
    "CASE WHEN len(w) = 0 THEN Amount END AS Amount, CASE WHEN len(w) = 0 THEN Class END AS Class FROM r WHERE NOT (event_id % 90 = 11 AND event_id % 110 = 13)",
)
def v2_malformed_rows(spark, sf):
    """V2: transactions written as CSV with bad cells, a cell too many and a cell too few; the typed
    scan puts every such line into quarantine with its reasons and keeps the others."""
    tx = fx.transactions(spark, sf).where("not (event_id % 90 = 11 and event_id % 110 = 13)")
    key = F.col("event_id")
    bad = {"Time": (83, 5, "12h"), "V7": (71, 3, "1.2.3"), "Amount": (50, 7, "abc"), "Class": (60, 9, "1.5")}
    cells = [F.when(key % bad[c][0] == bad[c][1], F.lit(bad[c][2])).otherwise(F.col(c).cast("string")) if c in bad else F.col(c).cast("string") for c in _COLS]
    line = F.concat_ws(",", *cells[:-1], F.when(key % 110 != 13, cells[-1]), F.when(key % 90 == 11, F.lit("more")))
    path = _scratch(spark, "lines")
    tx.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), *val.CONTRACT.fields])
    rows = io.scan_with_records(spark, path, schema, header=False)
    sound, quarantine = io.split_malformed(rows, schema)
    none = F.lit(None)
    return sound.select(key.cast("string").alias("event_id"), F.lit(False).alias("quarantined"), F.lit("").alias("reasons"), "Amount", "Class").unionByName(
        quarantine.select(F.substring_index("record", ",", 1).alias("event_id"), F.lit(True).alias("quarantined"), F.array_join("reasons", "; ").alias("reasons"),
                          none.cast("double").alias("Amount"), none.cast("int").alias("Class"))
    )


@query("b3_svm_smote")
def b3_svm_smote(spark, sf):
    """SVM-SMOTE - bases are fraud rows inside a linear SVM's margin (|f(x)| <= 1)."""
    from riskline.operators.balance import SMOTE_FEATURES, svm_smote

    s = svm_smote(enrich(fx.transactions(spark, sf)), SMOTE_FEATURES)
    if s is None:
        return spark.createDataFrame([], "synthetic_id bigint, base_id bigint, nn_id bigint, Class int")
    return s
