"""Filter interaction audit by incremental retraction streaming.

All files of a table are processed as available-now micro-batches of one stream.  A document
fails some of the filters A to D by itself; E, "identical to a document of smaller id", depends
on what else the table holds and on the order in which files come.  So every text has a keyed
state: the smallest id seen so far and the failures that its rows were counted under.  When a
smaller id arrives, the earlier rows are retracted from their counter and counted again with E
failed.

State and counters are tables with a partition per batch: the rows that became the first of their
text in it, and the signed changes of the counters (documents per part and set of failed filters).
A batch reads the partitions before its own and overwrites its own, so one that runs again after
a failure leaves the same.  The texts themselves are read once and never shuffled: what follows
are rows of a digest and a few numbers, dealt by digest and id, so that a text of any number of
copies is spread.

From the at most 32 counters of a part follow all orders of the filters: after every step what is
kept, removed, redundant, failed by no other filter, and lost of the labelled documents.
"""

from __future__ import annotations

import hashlib
import itertools
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.llm.common import drop_staged, scratch, staged

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT = 65
MAX_CAPITALS = 5
SYMBOLS = b"#$%&*|"
#: Micro-batches that the files are dealt to.
BATCHES = 4

_CAPITALS = bytes(range(65, 91))
_FOLLOWS = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that are no code point of their own
_E = 1 << FILTERS.index("E")
_ROW = "key binary, doc_id long, part string, mask int"
_STATE = "key binary, doc_id long, part string, mask int, good int, toxic int, n long"
_CHANGE = "part string, mask int, good long, toxic long, n long"


def failures(text: bytes) -> int:
    """The filters A to D that a text fails, as bits from A up."""
    words = text.split()
    distinct, points = len(set(words)), len(text.translate(None, _FOLLOWS))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    fails = (
        len(words) < MIN_WORDS,
        100 * distinct < MIN_DISTINCT * len(words),
        100 * capitals > MAX_CAPITALS * points,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << k for k, f in enumerate(fails) if f)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py() for t in batch.column("text")]
        keys, masks = [hashlib.sha256(t).digest() for t in texts], [failures(t) for t in texts]
        cols = [pa.array(keys, pa.binary()), batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32())]
        yield pa.RecordBatch.from_arrays(cols, names=["key", "doc_id", "part", "mask"])


def _stream(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """The table at ``path``, a folder of files or one file, as a stream of so many batches."""
    table = spark.read.parquet(path)
    files = max(1, -(-len(table.inputFiles()) // batches))
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(conf).getFileStatus(at).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path))


def _counted(rows: DataFrame, mask: Column, sign: int) -> DataFrame:
    """Changes of the counters by ``rows``, each counted ``n`` times."""
    return rows.select("part", mask.alias("mask"), *[(sign * F.col(c) * F.col("n")).alias(c) for c in ("good", "toxic")], (sign * F.col("n")).alias("n"))


def _batch(batch: DataFrame, known: DataFrame, folder: str, batch_id: int) -> None:
    """Write the changes of the counters and the new state of a batch's texts."""
    spark, none = batch.sparkSession, F.lit(0)
    # Labels grow with the documents: they are never broadcast.
    labelled = batch.join(known.hint("merge"), F.col("doc_id") == F.col("label_id"), "left")
    row = ["key", "doc_id", "part", "mask", "good", "toxic"]
    rows = staged(
        labelled.select("key", "doc_id", "part", "mask", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic")).groupBy(*row).agg(F.count("*").alias("n")), "rows"
    )
    state = spark.read.schema(f"{_STATE}, batch int").parquet(f"{folder}/state").where(F.col("batch") < batch_id).drop("batch")
    least = rows.where("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    before = state.groupBy("key").agg(F.min("doc_id").alias("before"))
    # texts whose smallest id is in this batch, alone or with an earlier row of the same id
    first = staged(least.join(before, "key", "left").where("before is null or doc_id <= before"), "first")
    now = staged(rows.join(first.drop("before"), ["key", "doc_id"]), "now")
    gone = state.join(first.where("doc_id < before").select("key", F.col("before").alias("doc_id")), ["key", "doc_id"])
    passes, fails = F.col("mask"), F.col("mask").bitwiseOR(_E)
    changes = _counted(rows, F.when(F.col("doc_id").isNull(), passes).otherwise(fails), 1)
    for some, sign in ((now, 1), (gone, -1)):
        changes = changes.unionByName(_counted(some, passes, sign)).unionByName(_counted(some, fails, -sign))
    now.select(*row, "n").write.mode("overwrite").parquet(f"{folder}/state/batch={batch_id}")
    sums = [F.sum(c).alias(c) for c in ("good", "toxic", "n")]
    changes.groupBy("part", "mask").agg(*sums).write.mode("overwrite").parquet(f"{folder}/counters/batch={batch_id}")
    for table in (rows, first, now):
        drop_staged(table)


def count_failures(spark: SparkSession, path: str, labels: DataFrame, folder: str | None = None, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, good, toxic, n): documents of the Parquet table at ``path`` by part and set of
    failed filters (bits from A up), and how many of them are labelled good or toxic.

    ``folder`` (under ``spark.checkpoint.dir`` by default) keeps the state and the counters: a call
    that was cut off and is made again with the same folder goes on where it stopped, and files
    added since are counted then."""
    folder = folder or scratch(spark, "audit")
    counters, flag = f"{folder}/counters", lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0))
    known = staged(labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(flag("quality").alias("good"), flag("toxic").alias("toxic")), "labels")
    spark.createDataFrame([], _CHANGE).write.mode("overwrite").parquet(f"{counters}/batch=-1")  # the table exists without any batch
    spark.createDataFrame([], _STATE).write.mode("overwrite").parquet(f"{folder}/state/batch=-1")
    docs = _stream(spark, path, batches).select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
    )

    def sink(batch: DataFrame, batch_id: int) -> None:
        _batch(batch, known, folder, batch_id)

    query = docs.mapInArrow(_rows, _ROW).writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True).start()
    query.awaitTermination()
    written = spark.read.schema(_CHANGE).parquet(counters)
    return written.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("good", "toxic", "n")])


def _bits(letters: str) -> Column:
    """The bits of a string of filters, an SQL expression."""
    return F.expr(f"aggregate(filter(split({letters}, ''), x -> x <> ''), 0, (bits, x) -> bits | shiftleft(1, ascii(x) - {ord('A')}))")


def orders(counters: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the result of :func:`count_failures`."""
    parts = counters.where("n <> 0").groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))  # 32 cells at most
    every = F.lit(",".join(map("".join, itertools.permutations(FILTERS))))
    steps = parts.withColumn("filter_order", F.explode(F.split(every, ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    steps = steps.withColumn("own", _bits("substring(filter_order, step, 1)")).withColumn("prior", _bits("substring(filter_order, 1, step - 1)"))
    total = lambda test, what: F.expr(f"aggregate(filter(cells, x -> {test}), 0L, (s, x) -> s + {what})")
    removed = "x.mask & prior = 0 AND x.mask & own <> 0"
    share = 120  # the orders in which a filter is the first of those failed
    return steps.select(
        "part", "filter_order", "step",
        total("x.mask & (prior | own) = 0", "x.n").alias("kept"),
        total(removed, "x.n").alias("removed"),
        total("x.mask & prior <> 0 AND x.mask & own <> 0", "x.n").alias("redundant"),
        total("x.mask = own", "x.n").alias("unique_fails"),
        total(removed, "x.good").alias("good_lost"),
        total(removed, "x.toxic").alias("toxic_lost"),
        total("x.mask & own <> 0", f"x.n * ({share} div bit_count(x.mask))").alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, **how) -> DataFrame:
    """One row per part, order of the filters A to E and step 1 to 5: part, filter_order, step,
    kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null texts are empty.  A null part is the empty string's.  A null id is smaller than none and
    has no smaller one; rows of the smallest id of their text pass E, repeated ones too.  Several
    labels of an id count as one, good or toxic if any is.  An empty table has no parts.
    """
    return orders(count_failures(spark, path, labels, **how))


def audit_rows(docs: DataFrame, labels: DataFrame, files: int = BATCHES, **how) -> DataFrame:
    """:func:`audit` of a DataFrame, written as so many files first."""
    cols = [how.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("part_col", "source"))]
    path = scratch(docs.sparkSession, "docs")
    docs.select(*cols).repartition(files).write.parquet(path)
    return audit(docs.sparkSession, path, labels, **how)
