"""Distributed ordered statistics without a single-task global window.

A ``Window.orderBy`` with no partition key moves every row into one task.  The
operators here (running totals, exact quantiles, row numbers) instead:

1. pre-aggregate to one row per distinct (group, value) where that is valid, so a
   hot value collapses to one row before any shuffle;
2. cut the values of each group with more than an even share of the rows into balanced
   buckets at the group's own approximate-quantile cut points (``n_buckets`` groups at
   most are collected once: the only driver data); other groups are one bucket;
3. run the window per (group, bucket), so each window task holds ~1/n of the rows;
4. add per-(group, bucket) offsets from a table of at most groups x buckets rows,
   joined back (AQE broadcasts it from its measured runtime size).

Cut points are literals, so every recomputation (retry after a lost executor,
second consumer of the same frame) buckets rows identically.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.session import shuffle_partitions

_B = "_rl_bucket"


def _cut_points(df: DataFrame, col: str, group: list[str], n_buckets: int, accuracy: int = 20000) -> dict[tuple, list[float]]:
    """Equi-depth cut points of each group that has more than an even share of the rows; the
    others are one bucket anyway.  So at most ``n_buckets`` groups reach the driver."""
    if n_buckets <= 1:
        return {}
    probs = [i / n_buckets for i in range(1, n_buckets)]
    found = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(F.col(col).cast("double"), probs, accuracy).alias("_q"))
    large = found.orderBy(F.col("_n").desc()).limit(n_buckets).collect()
    total = sum(r["_n"] for r in large)
    cuts = {}
    for r in large:
        if r["_n"] * n_buckets > total and r["_q"]:
            every = max(1, total // r["_n"])  # a group's share of the buckets is its share of the rows
            cuts[tuple(r[g] for g in group)] = sorted({float(q) for q in r["_q"][every - 1 :: every] if not math.isnan(q)})
    return cuts


def _with_bucket(df: DataFrame, col: str, cuts: dict[tuple, list[float]], group: list[str], descending: bool) -> DataFrame:
    if not any(cuts.values()):  # one bucket (tiny or constant input)
        return df.withColumn(_B, F.lit(0))
    if not group:
        return _with_one_bucketing(df, col, cuts[()], descending)
    schema = T.StructType([*[T.StructField(f"_rl_g{i}", df.schema[g].dataType) for i, g in enumerate(group)], T.StructField("_rl_cuts", T.ArrayType(T.DoubleType()))])
    table = F.broadcast(df.sparkSession.createDataFrame([(*k, v) for k, v in cuts.items()], schema))  # n_buckets rows at most
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_rl_g{i}"))
    below = F.size(F.filter("_rl_cuts", lambda c: c <= F.col(col).cast("double")))
    b = F.size("_rl_cuts") - below if descending else below
    return df.join(table, same, "left").withColumn(_B, F.when(F.col("_rl_cuts").isNull(), 0).otherwise(b)).drop("_rl_cuts", *[f"_rl_g{i}" for i in range(len(group))])


def _with_one_bucketing(df: DataFrame, col: str, cuts: list[float], descending: bool) -> DataFrame:
    splits = [-math.inf, *cuts, math.inf]
    tmp = "_rl_bucket_in"
    out = Bucketizer(splits=splits, inputCol=tmp, outputCol=_B, handleInvalid="keep").transform(
        df.withColumn(tmp, F.col(col).cast("double"))
    )
    b = F.col(_B).cast("int")
    if descending:
        b = F.lit(len(cuts)) - b
    return out.withColumn(_B, b).drop(tmp)


def _order_cols(order: list[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def _bucketed_running(
    rows: DataFrame,
    order: list[str],
    values: dict[str, Column],
    group: list[str],
    descending: bool,
    n_buckets: int | None,
    keep: list[str],
) -> DataFrame:
    """Inclusive running sums of ``values`` in ``order`` within ``group``.

    ``(group, order)`` must be unique per row so the ordering is total.
    Adds ``cum_<name>`` and ``tot_<name>`` for every value.
    """
    n_buckets = n_buckets or shuffle_partitions(rows.sparkSession)
    names = list(values)
    vals = rows.select(*keep, *[e.alias(f"_rl_v_{n}") for n, e in values.items()])
    if isinstance(rows.schema[order[0]].dataType, (T.StringType, T.BinaryType)):
        raise TypeError(f"{order[0]}: rows are cut into buckets by number, date or time, not by text")
    cuts = _cut_points(vals, order[0], group, n_buckets)
    b = _with_bucket(vals, order[0], cuts, group, descending)

    per_bucket = b.groupBy(*group, _B).agg(*[F.sum(f"_rl_v_{n}").alias(f"_rl_bt_{n}") for n in names])
    before = Window.partitionBy(*group).orderBy(F.col(_B)).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = per_bucket.select(
        *group,
        _B,
        *[F.coalesce(F.sum(f"_rl_bt_{n}").over(before), F.lit(0)).alias(f"_rl_off_{n}") for n in names],
        *[F.sum(f"_rl_bt_{n}").over(whole).alias(f"tot_{n}") for n in names],
    )
    w = Window.partitionBy(*group, _B).orderBy(*_order_cols(order, descending)).rowsBetween(Window.unboundedPreceding, 0)
    run = b.select(*keep, _B, *[F.col(f"_rl_v_{n}") for n in names], *[F.sum(f"_rl_v_{n}").over(w).alias(f"_rl_r_{n}") for n in names])
    # ``offsets`` has one row per (group, bucket).  No explicit hint: a count to prove
    # its size would re-run the whole upstream plan, while AQE turns this join into a
    # broadcast from the measured size of the materialized offsets stage.
    joined = run.join(offsets, on=[*group, _B])
    return joined.select(
        *keep,
        *[F.col(f"_rl_v_{n}").alias(n) for n in names],
        *[(F.col(f"_rl_r_{n}") + F.col(f"_rl_off_{n}")).alias(f"cum_{n}") for n in names],
        *[F.col(f"tot_{n}") for n in names],
    )


def running_totals(
    df: DataFrame,
    order: str,
    sums: dict[str, Column],
    group: list[str] | tuple = (),
    descending: bool = False,
    n_buckets: int | None = None,
) -> DataFrame:
    """Per distinct (group, order value): the summed ``sums`` at that value, their
    inclusive running totals ``cum_*`` in value order, and group totals ``tot_*``.
    NULL order values are skipped (as pandas skips NaN)."""
    group = list(group)
    agg = (
        df.where(F.col(order).isNotNull())
        .groupBy(*group, order)
        .agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    )
    return _bucketed_running(agg, [order], {n: F.col(n) for n in sums}, group, descending, n_buckets, [*group, order])


def row_numbers(
    df: DataFrame,
    order: list[str] | str,
    group: list[str] | tuple = (),
    out: str = "rn",
    descending: bool = False,
    n_buckets: int | None = None,
    total: str | None = None,
) -> DataFrame:
    """``row_number() over (partition by group order by order)`` for every row,
    optionally with the group's row count in column ``total`` (no extra pass),
    computed bucket-wise.  ``order`` (with ``group``) must identify rows uniquely;
    append a key column as the last tie-breaker when it does not."""
    order = [order] if isinstance(order, str) else list(order)
    group = list(group)
    res = _bucketed_running(df, order, {"_rl_one": F.lit(1)}, group, descending, n_buckets, df.columns)
    res = res.withColumn(out, F.col("cum__rl_one").cast("bigint"))
    if total is not None:
        res = res.withColumn(total, F.col("tot__rl_one").cast("bigint"))
    return res.drop("_rl_one", "cum__rl_one", "tot__rl_one")


def exact_quantiles(
    df: DataFrame,
    col: str,
    probs: list[float],
    group: list[str] | tuple = (),
    names: list[str] | None = None,
    n_buckets: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas ``quantile`` / SQL
    ``quantile_cont``), one row per group, one column per probability.

    Works on the distinct-value table, so memory per task is bounded by the
    bucket size rather than by the group size."""
    group = list(group)
    names = names or [f"q_{str(p).replace('.', '_')}" for p in probs]
    rt = running_totals(df, col, {"n": F.lit(1)}, group, n_buckets=n_buckets)
    before = F.col("cum_n") - F.col("n")
    aggs = []
    for p, name in zip(probs, names):
        h = (F.col("tot_n") - F.lit(1)) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        aggs += [
            F.max(F.when((before <= lo) & (lo < F.col("cum_n")), F.col(col))).alias(f"_lo_{name}"),
            F.max(F.when((before <= hi) & (hi < F.col("cum_n")), F.col(col))).alias(f"_hi_{name}"),
            F.max(h - lo).alias(f"_fr_{name}"),
        ]
    q = rt.groupBy(*group).agg(*aggs)
    return q.select(
        *group,
        *[
            (F.col(f"_lo_{n}") + F.col(f"_fr_{n}") * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n)
            for n in names
        ],
    )


def exact_quantile_values(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    """Driver-side scalars for fitted statistics (a handful of numbers)."""
    row = exact_quantiles(df, col, probs, names=[f"p{i}" for i in range(len(probs))]).first()
    if row is None:
        return [None] * len(probs)
    return [row[f"p{i}"] for i in range(len(probs))]
