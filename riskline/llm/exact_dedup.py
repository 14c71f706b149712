"""Exact dedup by content sort.

Rows are range-partitioned and sorted by the first bytes of their normalised text, its
digest and their id; Spark samples the splitters.  Equal texts are then neighbours, and
each row's whole text is compared with the text at the head of its run.  A run may cross
partition borders, so that a group of copies of any size spreads over many tasks; the
borders (two rows a partition) are compared afterwards.

The sort key holds a prefix and the digest instead of the whole text to keep the sampled
splitters, which go through the driver, small; equality itself is decided on whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskline.llm.common import WS_CLASS, partitions, staged, text_or_empty

#: Characters of the normalised text that lead the sort key.
PREFIX_CHARS = 32
_RUNS = re.compile(rb"[\x20\x09-\x0d]+")


def normalised(text):
    return F.regexp_replace(text, f"[{WS_CLASS}]+", " ")


def _norm(text: str) -> bytes:
    return _RUNS.sub(b" ", text.encode("utf-8", "surrogatepass"))


def _scan(carry: list[pa.Field]):
    """Neighbouring comparisons over one sorted partition.

    Gives one row per document (with carried columns: one per run, for its head), and for
    the partition's first and last run an edge row that holds the text of its head."""
    schema = pa.schema(
        [
            pa.field("id", pa.int64()), pa.field("sha", pa.string()), pa.field("part", pa.int32()),
            pa.field("run", pa.int64()), pa.field("head_id", pa.int64()), pa.field("n", pa.int64()),
            pa.field("is_head", pa.bool_()), pa.field("edge", pa.string()), pa.field("edge_text", pa.string()),
            *carry,
        ]
    )
    names = [f.name for f in carry]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, out = TaskContext.get().partitionId(), -1, []
        sha, text, norm, kept, ids = None, None, None, (), []

        def row(**more) -> dict:
            return {"sha": sha, "part": part, "run": run, "head_id": ids[0], "n": len(ids), "is_head": False} | more

        def close() -> None:
            out.append(row(id=ids[0], is_head=True, **dict(zip(names, kept))))
            if not names:
                out.extend(row(id=i) for i in ids[1:])
            if run == 0:
                out.append(row(edge="first", edge_text=text))

        for batch in batches:
            texts, cols = batch.column("text"), [batch.column(n) for n in names]
            for k, (i, s) in enumerate(zip(batch.column("id").to_pylist(), batch.column("sha").to_pylist())):
                if s == sha:
                    norm = _norm(text) if norm is None else norm
                    if _norm(texts[k].as_py()) == norm:
                        ids.append(i)
                        continue
                if run >= 0:
                    close()
                run, sha, text, norm, ids = run + 1, s, texts[k].as_py(), None, [i]
                kept = tuple(c[k].as_py() for c in cols)
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        if run >= 0:
            close()
            out.append(row(edge="last", edge_text=text))
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return scan


_LOCAL = T.StructType(
    [
        T.StructField("id", T.LongType()), T.StructField("sha", T.StringType()), T.StructField("part", T.IntegerType()),
        T.StructField("run", T.LongType()), T.StructField("head_id", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("is_head", T.BooleanType()), T.StructField("edge", T.StringType()), T.StructField("edge_text", T.StringType()),
    ]
)


def _sorted_runs(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    text = text_or_empty(text_col)
    norm = normalised(text)
    keyed = docs.select(
        F.col(id_col).cast("long").alias("id"),
        text.alias("text"),
        F.substring(norm, 1, PREFIX_CHARS).alias("prefix"),
        F.sha2(norm.cast("binary"), 256).alias("sha"),
        *[F.col(c).alias(f"c{k}") for k, c in enumerate(carry)],
    )
    order = [F.col("prefix"), F.col("sha"), F.col("id").asc_nulls_last()]
    dealt = keyed.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order).drop("prefix")
    fields = [T.StructField(f"c{k}", docs.schema[c].dataType) for k, c in enumerate(carry)]
    arrow = [pa.field(f.name, to_arrow_type(f.dataType)) for f in fields]
    return staged(dealt.mapInArrow(_scan(arrow), T.StructType([*_LOCAL.fields, *fields])), "runs")


def _merged_borders(runs: DataFrame) -> DataFrame:
    """Runs that continue across partitions: (part, run) -> id at their very head, rows in
    all, and whether the run began in an earlier partition.  Two rows a partition at most,
    without texts, come to the driver."""
    spark = runs.sparkSession
    edges = runs.where("edge is not null")
    known = {(r["part"], r["edge"]): r for r in edges.select("part", "edge", "run", "sha", "head_id", "n").collect()}
    parts = sorted({p for p, _ in known})
    near = [(a, b) for a, b in zip(parts, parts[1:]) if known[a, "last"]["sha"] == known[b, "first"]["sha"]]
    same: set[int] = set()
    if near:
        a = edges.where("edge = 'last'").select(F.col("part").alias("a"), normalised(F.col("edge_text")).alias("x"))
        b = edges.where("edge = 'first'").select(F.col("part").alias("b"), normalised(F.col("edge_text")).alias("y"))
        pairs = spark.createDataFrame(near, "a int, b int").join(a, "a").join(b, "b")
        same = {r["b"] for r in pairs.where("x = y").select("b").collect()}
    fixed: list[tuple] = []
    chain: list = []

    def end() -> None:
        if len(chain) > 1:
            total = sum(r["n"] for r in chain)
            fixed.extend((r["part"], r["run"], chain[0]["head_id"], total, k > 0) for k, r in enumerate(chain))

    for p in parts:
        first, last = known[p, "first"], known[p, "last"]
        if p not in same:
            end()
            chain = []
        chain.append(first)
        if last["run"] != first["run"]:
            end()
            chain = [last]
    end()
    return spark.createDataFrame(fixed, "part int, run long, fix_id long, fix_n long, continues boolean")


def _joined(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    runs = _sorted_runs(docs, id_col, text_col, carry)
    # At most two rows a partition: a size bound that does not depend on the documents.
    fixes = F.broadcast(_merged_borders(runs))
    return runs.where("edge is null").join(fixes, ["part", "run"], "left")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space became one space.
    Null texts count as empty; empty texts are equal to each other.  A null id sorts after
    all others, so it is kept only if every id of its group is null.  Of rows with equal
    text and id exactly one is kept.  Other columns are ignored.
    """
    head = F.col("is_head") & ~F.coalesce(F.col("continues"), F.lit(False))
    return _joined(docs, id_col, text_col, []).select(
        F.col("id").alias("doc_id"),
        F.coalesce("fix_id", "head_id").alias("keep_id"),
        F.coalesce("fix_n", "n").alias("group_size"),
        head.alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of ``docs`` with all their columns, which travel with the sort."""
    rows = _joined(docs, id_col, text_col, docs.columns)
    kept = rows.where(F.col("is_head") & ~F.coalesce(F.col("continues"), F.lit(False)))
    return kept.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])
