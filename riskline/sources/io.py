"""CSV scan (S1), capture of malformed rows (V2) and layered dataset sink."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.sources.staging import drop_stage, stage

RECORD = "_malformed"
#: Columns of the quarantine table.
QUARANTINE = "file string, record string, reasons array<string>"
LAYERS = ("raw", "processed", "synthetic")


def read_transactions_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass); NaN -> NULL at the
    scan so NULL is the only missing marker downstream."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    fix = {f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)) for f in schema.fields
           if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(fix) if fix else df


def scan_with_records(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """V2: every line of a CSV, typed, with the raw line in ``_malformed`` where a cell is not of
    its type or the number of cells is wrong (null for a sound line), and its file.

    Lines are parsed by ``from_csv`` with all columns whatever a query asks for: the CSV reader
    prunes columns, so that a bad cell of a column that is not read would go unseen.  Blank lines
    and, with ``header``, lines of the column names are no rows."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file")).where(F.trim("value") != "")
    if header:
        lines = lines.where(F.col("value") != ",".join(schema.fieldNames()))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, T.StructField(RECORD, T.StringType())])
    rows = lines.select(F.from_csv("value", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}).alias("row"), "_file").select("row.*", "_file")
    fix = {f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)) for f in schema.fields
           if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return rows.withColumns(fix) if fix else rows


def malformed_reasons(record: Column, schema: T.StructType) -> Column:
    """What is wrong with a raw line: a text per cell that is not of its column's type, and one
    for a wrong number of cells."""
    cells = F.from_csv(record, ", ".join(f"`{c}` string" for c in schema.fieldNames()), {"mode": "PERMISSIVE"})
    # commas outside quotes
    plain = F.regexp_replace(record, '"[^"]*"', "")
    n = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1
    wrong = [
        F.when(cells[f.name].isNotNull() & cells[f.name].try_cast(f.dataType).isNull(),
               F.concat(F.lit(f"{f.name}: not {f.dataType.simpleString()}: "), cells[f.name]))
        for f in schema.fields if not isinstance(f.dataType, T.StringType)
    ]
    count = F.when(n != len(schema.fields), F.concat(F.lit("row: "), n.cast("string"), F.lit(f" cells, {len(schema.fields)} expected")))
    return F.array_compact(F.array(*wrong, count))


def split_malformed(rows: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(sound rows, quarantined rows) of :func:`scan_with_records`; a line is in exactly one."""
    sound = rows.where(F.col(RECORD).isNull()).select(*schema.fieldNames())
    bad = rows.where(F.col(RECORD).isNotNull()).select(F.col("_file").alias("file"), F.col(RECORD).alias("record"), malformed_reasons(F.col(RECORD), schema).alias("reasons"))
    return sound, bad


def ingest_csv(spark: SparkSession, path: str, schema: T.StructType, root: str, run: str) -> tuple[DataFrame, DataFrame]:
    """One pass over the CSV at ``path`` into ``root``/raw and ``root``/quarantine, both
    with a partition for ``run``, which a repeated run overwrites.  Returns both partitions."""
    rows = stage(scan_with_records(spark, path, schema), "csv")
    out = []
    for name, part in zip(("raw", "quarantine"), split_malformed(rows, schema)):
        at = os.path.join(root, name, f"run={run}")
        part.write.mode("overwrite").parquet(at)
        out.append(spark.read.schema(part.schema).parquet(at))
    drop_stage(rows)
    return out[0], out[1]


def write_layer(df: DataFrame, root: str, layer: str, partition_by: str | None = "Day", mode: str = "overwrite") -> str:
    """Write one layer (raw / processed / synthetic) as parquet, partitioned by day
    so later reads prune partitions."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    path = os.path.join(root, layer)
    w = df.write.mode(mode)
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def read_layer(spark: SparkSession, root: str, layer: str) -> DataFrame:
    return spark.read.parquet(os.path.join(root, layer))
