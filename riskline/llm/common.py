"""Helpers shared by the operators: staged tables, row keys, exact ranks, word lists."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskline.session import ensure_checkpoint_dir, shuffle_partitions

# ASCII white space, as a Java regex class and as the characters themselves.
WS_CLASS = "\\x20\\x09-\\x0D"
WS_CHARS = " \t\n\x0b\x0c\r"

_STAGED: dict[str, list[str]] = {}


def staged(df: DataFrame, name: str, codec: str = "zstd", by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage: a lost executor costs only the tasks that read the table.
    The folders of a session are listed until :func:`release` deletes them.  ``by``, a column of a
    few values, gives each value a folder, so that :func:`drop_part` can delete one; the rows are
    not sorted for that.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    writer = df.write.option("compression", codec)
    if by is None:
        writer.parquet(path)
    else:
        writers = "spark.sql.maxConcurrentOutputFileWriters"
        old = spark.conf.get(writers, "0")
        spark.conf.set(writers, "8")
        try:
            writer.partitionBy(by).parquet(path)
        finally:
            spark.conf.set(writers, old)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_part(df: DataFrame, part: str) -> None:
    """Delete the folder ``part`` (column=value) of a table from :func:`staged` with ``by``."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.endswith(f"/{part}"):
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path under ``spark.checkpoint.dir``, deleted by :func:`release`."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def keyed(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as (row, row_key), written once: a key computed anew in a second scan
    depends on how that scan splits the files, and may be another row's."""
    return staged(df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), F.monotonically_increasing_id().alias("row_key")), "keyed")


def _folders(df: DataFrame) -> set[str]:
    """The folders above the tables that ``df`` reads."""
    tables = {re.sub(r"(/[^/=]+=[^/]*)*/[^/]+$", "", f) for f in df.inputFiles()}
    return {t.rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/") for t in tables}


def drop_staged(df: DataFrame, keep: DataFrame | None = None) -> None:
    """Delete the folders of tables from :func:`staged` that ``df`` reads and nothing else does
    any more; those that ``keep`` reads stay."""
    spark = df.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _STAGED.get(spark.sparkContext.applicationId, [])
    folders = _folders(df) - (_folders(keep) if keep is not None else set())
    for p in [p for p in paths if p.rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/") in folders]:
        parent = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p).getParent()
        parent.getFileSystem(conf).delete(parent, True)
        paths.remove(p)


def staged_paths(spark: SparkSession) -> list[str]:
    """The tables staged by this application that are not deleted yet."""
    return list(_STAGED.get(spark.sparkContext.applicationId, []))


def drop_paths(spark: SparkSession, paths: list[str], keep: DataFrame) -> None:
    """Delete the staged tables at ``paths`` that ``keep`` doesn't read."""
    conf, known, used = spark.sparkContext._jsc.hadoopConfiguration(), _STAGED.get(spark.sparkContext.applicationId, []), _folders(keep)
    for p in paths:
        if p in known and p.rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/") not in used:
            parent = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p).getParent()
            parent.getFileSystem(conf).delete(parent, True)
            known.remove(p)


def tidy(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished queries now: its cleaner does so once the
    driver's JVM has collected their plans, which an idle heap puts off for long."""
    spark.sparkContext._jvm.System.gc()


def release(spark: SparkSession) -> int:
    """Delete the tables staged by this application; results that still read them must
    have been written before.  Returns the number of folders deleted."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        parent = jvm.org.apache.hadoop.fs.Path(p).getParent()
        parent.getFileSystem(conf).delete(parent, True)
    return len(paths)


def partitions(spark: SparkSession) -> int:
    return max(1, shuffle_partitions(spark))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The runs of non-white-space as an array (empty for a text without any)."""
    trimmed = F.btrim(text, F.lit(WS_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"[{WS_CLASS}]+")
    )


def word_count(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WS_CHARS))
    return F.length(F.regexp_replace(trimmed, f"[^{WS_CLASS}]+[{WS_CLASS}]*", "x")).cast("long")


def in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``, equals ``fold`` (a null id: never)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def ranked(df: DataFrame, group: str, order: list[str], rank: str = "rank") -> DataFrame:
    """Exact 1-based ranks within ``group`` by ``order``, without one task per group.

    The rows are range-partitioned on (group, order), so that a group of any size
    spreads over many partitions.  A row's rank is its place among its group's rows in
    its own partition plus the group's rows in the partitions before it.  ``order`` must
    be total up to rows that are interchangeable.  Nulls come last in either.
    """
    keys = [F.col(c).asc_nulls_last() for c in [group, *order]]
    n = partitions(df.sparkSession)
    dealt = staged(
        df.repartitionByRange(n, *keys).withColumn("_part", F.spark_partition_id()), "ranked"
    )
    gkey = F.struct(F.col(group).isNull().alias("z"), F.col(group).alias("g"))
    dealt = dealt.withColumn("_group", gkey)
    counts = dealt.groupBy("_group", "_part").agg(F.count("*").alias("_n"))
    # One row for each (group, partition) pair that occurs: at most groups + partitions.
    before = counts.select(
        "_group", "_part",
        (F.sum("_n").over(Window.partitionBy("_group").orderBy("_part")) - F.col("_n")).alias("_before"),
    )
    local = dealt.withColumn(
        "_local",
        F.row_number().over(
            Window.partitionBy("_group", "_part").orderBy(*[F.col(c).asc_nulls_last() for c in order])
        ),
    )
    return (
        local.join(before, ["_group", "_part"])
        .withColumn(rank, F.col("_local") + F.col("_before"))
        .drop("_group", "_part", "_local", "_before")
    )
