"""Mixing sources to target weights by systematic sampling.

Targets share all words by weight; a source's target stops at ``max_repeat`` times its
size and the excess goes to the others.  Within a source the documents are put in order of
size, largest first, their expected copies are prefix-summed, one offset in [0, 1) from the
source's name and a seed is added, and a document is taken once for each integer that its
interval of the sum crosses.  Expected copies are target / size, for all documents over
``LARGE`` of the target; for those after them they are what is then left of the target by
what is left of the size, so that the few large documents of a small source do not carry
it off its target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskline.llm.common import keyed, ranked, text_or_empty, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"
#: Share of the target above which a document counts as large.
LARGE = 0.05


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """One row per source: source, source_size, target, expected (copies), offset.

    ``sizes``: source, size.  Sources take the weights in turn in order of code point, null
    last.  A source without words has target 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # over one row per source
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    # Water level: capped sources come first in order of cap / weight.  Before the k-th, the
    # level is what is left for the rest per unit of weight; a source is capped as long as
    # its cap lies under that level.
    per = per.withColumn("weight", pick).withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    per = (
        per.withColumn("cap_before", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("w_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("level", (F.sum("source_size").over(whole) - F.col("cap_before")) / F.col("w_left"))
        .withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level"))
    )
    per = per.withColumn("final", F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "source", "level"))).over(whole)["level"])
    u = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce("source", F.lit("")))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    target = F.when(F.col("capped") | F.col("final").isNull(), F.col("cap")).otherwise(F.col("weight") * F.col("final"))
    return per.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("expected"),
        u.alias("offset"),
    )


def _copies(docs: DataFrame, id_col: str, text_col: str, source_col: str, key_col: str | None = None, large: float = LARGE, **how) -> DataFrame:
    sizes = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(text_or_empty(text_col)).alias("size"),
        (F.col(key_col) if key_col else F.monotonically_increasing_id()).alias("row_key"),
    ).withColumn("down", -F.col("size"))
    placed = ranked(sizes, "source", ["down", "doc_id", "row_key"])
    targets = source_targets(placed.select("source", "size"), **how).withColumnRenamed("source", "t_source")
    top = float(how.get("max_repeat", MAX_REPEAT))
    placed = placed.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    is_large = F.col("size") > large * F.col("target")

    def crossed(upto, before):
        return F.least(F.floor(upto + F.col("offset")) - F.floor(before + F.col("offset")), F.lit(int(top)).cast("long"))

    first = crossed(F.col("rank") * F.col("expected"), (F.col("rank") - 1) * F.col("expected"))
    over = placed.groupBy(F.col("source").alias("t_source")).agg(
        F.count_if(is_large).alias("n_large"),
        F.sum(F.when(is_large, first * F.col("size")).otherwise(0)).alias("taken_large"),
        F.sum(F.when(is_large, 0).otherwise(F.col("size"))).alias("size_rest"),
    )
    placed = placed.join(over, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    rest = F.when(F.col("size_rest") > 0, F.greatest(F.lit(0.0), F.least(F.lit(top), (F.col("target") - F.col("taken_large")) / F.col("size_rest")))).otherwise(F.lit(0.0))
    gone, k = F.col("n_large") * F.col("expected"), F.col("rank") - F.col("n_large")
    return placed.withColumn("rest", rest).withColumn(
        "copies", F.when(is_large, first).otherwise(crossed(gone + k * F.col("rest"), gone + (k - 1) * F.col("rest")))
    )


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    Null texts have no words.  A null source is a source of its own.  Rows of equal source,
    size and id are interchangeable.  Other columns are ignored.
    """
    return _copies(docs, id_col, text_col, source_col, **how).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of the mix with the columns of ``docs``, each as often as it is taken.

    The rows are written once with their key.
    """
    rows = keyed(docs)
    plain = rows.select(*[F.col("row")[c].alias(n) for c, n in ((id_col, "doc_id"), (text_col, "text"), (source_col, "source"))], "row_key")
    picked = _copies(plain, "doc_id", "text", "source", "row_key", **how).where("copies > 0").select("row_key", "copies")
    return rows.join(picked, "row_key").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
