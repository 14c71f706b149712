"""Order statistics by successive histograms: no row is shuffled or sorted.

To find the value at a rank, the range of the values is cut into equal bins, the rows of each
bin are counted (a partial aggregate: only counts leave the tasks), the bin that holds the rank
becomes the new range, with its own least and greatest value, and so on until a range is one
value.  Skew does no harm: a value that holds a third of all rows is one count.  Groups, several
ranks and several columns (unpivoted to a group each) share the same passes; every row lies in at
most one open range of its group.

The state is a few numbers for each group and rank.  It is kept on the driver, so groups are
for label-like domains; over ``MAX_RANKS`` groups x ranks raise an error that names the
window-based :func:`riskline.operators.ordered.exact_quantiles` instead.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bins of a range.
BINS = 4096
#: Groups x ranks that are searched at a time.
MAX_RANKS = 100_000

_X, _LO, _HI, _BIN = "_rl_x", "_rl_lo", "_rl_hi", "_rl_bin"


@dataclass
class Found:
    """A value at a rank: ``value``, how many rows of the group have it (``ties``), and which of
    them the rank is (``place``, from 0)."""

    group: tuple
    rank: str
    value: object
    ties: int
    place: int
    total: int


def _comparable(df: DataFrame, col: str) -> tuple[Column, Callable[[Column], Column]]:
    """The column as a double or a long of the same order, and the way back."""
    t = df.schema[col].dataType
    c = F.col(col)
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return F.nanvl(c.cast("double"), F.lit(None).cast("double")), lambda v: v.cast(t)
    if isinstance(t, (T.IntegralType, T.BooleanType)):
        return c.cast("int").cast("long") if isinstance(t, T.BooleanType) else c.cast("long"), lambda v: v.cast(t)
    if isinstance(t, T.DecimalType):
        return c.cast("double"), lambda v: v.cast(t)
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("long"), lambda v: F.date_from_unix_date(v.cast("int"))
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")), lambda v: F.timestamp_micros(v).cast(t)
    raise TypeError(f"{col}: no order statistics of {t.simpleString()}")


def _bin(whole: bool) -> Column:
    """The bin of a value in its range; the range's ends fall into the first and the last bin."""
    if whole:
        near = F.expr(f"double({_HI}) - double({_LO}) < 9e15")
        part = F.when(near, (F.col(_X) - F.col(_LO)).cast("double") / (F.col(_HI) - F.col(_LO)).cast("double")).otherwise(
            (F.col(_X).cast("double") - F.col(_LO).cast("double")) / (F.col(_HI).cast("double") - F.col(_LO).cast("double"))
        )
    else:
        # halves, so that a range of both signs doesn't overflow
        width = F.col(_HI) / 2 - F.col(_LO) / 2
        part = F.when(width > 0, (F.col(_X) / 2 - F.col(_LO) / 2) / width).otherwise((F.col(_X) > F.col(_LO)).cast("double"))
    return F.least(F.lit(BINS - 1), F.floor(part * BINS).cast("int"))


def _state(spark, rows: list[tuple], group: list[T.StructField], value: str, extra: str = "") -> DataFrame:
    fields = [T.StructField(f.name, f.dataType) for f in group]
    schema = T.StructType([*fields, *T.StructType.fromDDL(f"{_LO} {value}, {_HI} {value}{extra}").fields])
    return spark.createDataFrame(rows, schema)


def _in_open_range(df: DataFrame, ranges: list[tuple], group: list[T.StructField], value: str) -> DataFrame:
    """The rows whose value lies in an open range of their group, with the range."""
    if not group:  # at most as many ranges as ranks were asked for
        lo, hi = F.lit(None).cast(value), F.lit(None).cast(value)
        for a, b in ranges:
            inside = F.col(_X).between(F.lit(a), F.lit(b))
            lo, hi = F.when(inside, F.lit(a)).otherwise(lo), F.when(inside, F.lit(b)).otherwise(hi)
        return df.withColumns({_LO: lo, _HI: hi}).where(F.col(_LO).isNotNull())
    known = F.broadcast(_state(df.sparkSession, ranges, group, value))  # MAX_RANKS rows at most
    same = F.col(_X).between(F.col(_LO), F.col(_HI))
    for f in group:
        same = same & F.col(f.name).eqNullSafe(F.col(f"_rl_g_{f.name}"))
    for f in group:
        known = known.withColumnRenamed(f.name, f"_rl_g_{f.name}")
    return df.join(known, same).drop(*[f"_rl_g_{f.name}" for f in group])


def select_ranks(df: DataFrame, col: str, ranks: dict[str, Callable[[int, tuple], list[int] | int | None]], group: list[str] | tuple = ()) -> list[Found]:
    """The values of ``col`` at 0-based ranks within ``group``, nulls and NaN left out.

    ``ranks`` gives each rank's name and a function of the group's size and key; ranks outside
    the group (None too) are left out.  Values come back as doubles, or as longs for whole
    numbers, dates (days) and timestamps (microseconds).
    """
    group = list(group)
    x, _ = _comparable(df, col)
    fields = [df.schema[g] for g in group]
    rows = df.select(*group, x.alias(_X)).where(F.col(_X).isNotNull())
    value = rows.schema[_X].dataType.simpleString()
    sizes = rows.groupBy(*group).agg(F.min(_X).alias("lo"), F.max(_X).alias("hi"), F.count("*").alias("n")).limit(MAX_RANKS // len(ranks) + 1).collect()
    if len(sizes) * len(ranks) > MAX_RANKS:
        raise ValueError(f"more than {MAX_RANKS} groups x ranks; use ordered.exact_quantiles for groups without a bound")
    found: list[Found] = []
    open_: list[tuple] = []  # (group, rank, place, lo, hi, total)
    for r in sizes:
        key = tuple(r[g] for g in group)
        for name, of in ranks.items():
            at = of(r["n"], key) if r["n"] else None
            if at is None or not 0 <= at < r["n"]:
                continue
            if r["lo"] == r["hi"]:
                found.append(Found(key, name, r["lo"], r["n"], at, r["n"]))
            else:
                open_.append((key, name, at, r["lo"], r["hi"], r["n"]))
    while open_:
        ranges = sorted({(*key, lo, hi) for key, _, _, lo, hi, _ in open_}, key=repr)
        binned = _in_open_range(rows, ranges, fields, value).withColumn(_BIN, _bin(value == "bigint"))
        counts = binned.groupBy(*group, _LO, _HI, _BIN).agg(F.count("*").alias("c"), F.min(_X).alias("lo"), F.max(_X).alias("hi"))
        # of each range only the bins that hold a rank are needed, so at most one row per rank
        wanted = _state(df.sparkSession, [(*key, lo, hi, name, at, total) for key, name, at, lo, hi, total in open_], fields, value, ", name string, place long, total long")
        running = F.sum("c").over(_by(group).orderBy(_BIN).rowsBetween(-BINS, 0))  # a range's bins are at most BINS rows
        cums = counts.withColumn("upto", running).select(*[F.col(g).alias(f"_rl_g_{g}") for g in group], F.col(_LO).alias("_l"), F.col(_HI).alias("_h"), "c", "lo", "hi", "upto")
        same = (F.col(_LO) == F.col("_l")) & (F.col(_HI) == F.col("_h")) & (F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("c"))
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"_rl_g_{g}"))
        got = cums.join(F.broadcast(wanted), same).select(*group, "name", (F.col("place") - F.col("upto") + F.col("c")).alias("place"), "lo", "hi", "c", "total").collect()
        open_ = []
        for r in got:
            key = tuple(r[g] for g in group)
            if r["lo"] == r["hi"]:
                found.append(Found(key, r["name"], r["lo"], r["c"], r["place"], r["total"]))
            else:
                open_.append((key, r["name"], r["place"], r["lo"], r["hi"], r["total"]))
    return found


def _by(group: list[str]):
    from pyspark.sql import Window

    return Window.partitionBy(*group, _LO, _HI)


def _around(p: float) -> dict[str, Callable]:
    return {f"{p!r}-": lambda n, _: math.floor((n - 1) * p), f"{p!r}+": lambda n, _: math.ceil((n - 1) * p)}


def quantiles(df: DataFrame, col: str, probs: list[float], group: list[str] | tuple = ()) -> dict[tuple, list[float]]:
    """Exact quantiles with linear interpolation for each group that has a value."""
    ranks: dict[str, Callable] = {}
    for p in probs:
        ranks |= _around(p)
    at = {(f.group, f.rank): (f.value, f.total) for f in select_ranks(df, col, ranks, group)}
    out: dict[tuple, list[float]] = {}
    for key in {k for k, _ in at}:
        out[key] = []
        for p in probs:
            (lo, n), (hi, _) = at[key, f"{p!r}-"], at[key, f"{p!r}+"]
            h = (n - 1) * p
            out[key].append(float(lo + (h - math.floor(h)) * (hi - lo)))
    return out


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, list[float]]:
    """:func:`quantiles` of several numeric columns in the same passes; a column without values
    is left out."""
    if len(columns) == 1:
        got = quantiles(df, columns[0], probs)
        return {columns[0]: got[()]} if () in got else {}
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "_rl_feature", "_rl_value")
    return {k[0]: v for k, v in quantiles(long, "_rl_value", probs, ["_rl_feature"]).items()}


def quantile_table(df: DataFrame, col: str, probs: list[float], group: list[str] | tuple = (), names: list[str] | None = None) -> DataFrame:
    """:func:`quantiles` as a table, one row per group, one column per probability."""
    names = names or [f"q_{str(p).replace('.', '_')}" for p in probs]
    schema = T.StructType([*[df.schema[g] for g in group], *[T.StructField(n, T.DoubleType()) for n in names]])
    got = quantiles(df, col, probs, group)
    return df.sparkSession.createDataFrame([(*k, *v) for k, v in got.items()], schema)


def cut_keys(df: DataFrame, order: str, tie: str, ranks: dict[str, Callable[[int, tuple], int | None]], group: list[str] | tuple = ()) -> dict[tuple[tuple, str], tuple]:
    """The (order, tie) keys at ranks in the order of both columns, within ``group``.

    ``tie`` is only searched among the rows that share the value of ``order`` at a rank.
    Returns {(group, rank): (order value, tie value)}; the tie value is None where the order value
    is that of a single row."""
    group = list(group)
    first = select_ranks(df, order, ranks, group)
    out = {(f.group, f.rank): (f.value, None) for f in first}
    tied = [f for f in first if f.ties > 1]
    if tied:
        fields = [df.schema[g] for g in group]
        x, _ = _comparable(df, order)
        value = df.select(x.alias(_X)).schema[_X].dataType.simpleString()
        shared = _in_open_range(df.select(*group, tie, x.alias(_X)), sorted({(*f.group, f.value, f.value) for f in tied}, key=repr), fields, value)
        shared = shared.withColumnRenamed(_LO, "_rl_value").drop(_HI, _X)
        # a rank of the group is a place among the rows of its value
        places = {}
        for f in tied:
            places.setdefault((*f.group, f.value), {})[f.rank] = f.place
        names = {f.rank for f in tied}
        second = select_ranks(shared, tie, {n: (lambda _, key, n=n: places.get(key, {}).get(n)) for n in names}, [*group, "_rl_value"])
        for f in second:
            out[f.group[:-1], f.rank] = (f.group[-1], f.value)
    return out


def mark_up_to(df: DataFrame, order: str, tie: str, cuts: dict[tuple[tuple, str], tuple], names: list[str], group: list[str] | tuple = ()) -> DataFrame:
    """``df`` with a boolean column per rank of :func:`cut_keys`: whether the row's (order, tie) is
    at most the key.  False where the group has no such rank.  A comparison: no row moves."""
    group = list(group)
    if not group:
        marks = {n: _up_to(order, tie, *(F.lit(v) for v in cuts[(), n])) if ((), n) in cuts else F.lit(False) for n in names}
        return df.withColumns(marks)
    kinds = {c: "long" if isinstance(df.schema[c].dataType, (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)) else "double" for c in (order, tie)}
    fields = [T.StructField(f"_rl_g_{g}", df.schema[g].dataType) for g in group]
    fields += [T.StructField(f"_rl_{n}_{i}", T.LongType() if kinds[c] == "long" else T.DoubleType()) for n in names for i, c in enumerate((order, tie))]
    keys = sorted({k for k, _ in cuts}, key=repr)  # groups x ranks were bounded when they were searched
    table = df.sparkSession.createDataFrame([(*k, *[v for n in names for v in cuts.get((k, n), (None, None))]) for k in keys], T.StructType(fields))
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_rl_g_{g}"))
    out = df.join(F.broadcast(table), same, "left")
    out = out.withColumns({n: _up_to(order, tie, F.col(f"_rl_{n}_0"), F.col(f"_rl_{n}_1")) for n in names})
    return out.drop(*[f.name for f in fields])


def _up_to(order: str, tie: str, value: Column, tied: Column) -> Column:
    o, t = F.col(order), F.col(tie)
    return F.coalesce((o < value) | ((o == value) & (tied.isNull() | (t <= tied))), F.lit(False))
