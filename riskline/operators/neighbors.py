"""Exact k-nearest neighbours by pivots, with a bounded top-k in every task.

1. *Cells.*  A bounded number of points are pivots; every point belongs to the cell of its
   nearest pivot, and to a ring of it by its distance from that pivot.  Rings are cut so that
   one holds about ``CHUNK`` points; the points of a larger one are dealt over several chunks.
2. *Bound.*  A query is compared with the points of its own ring.  The distance of the k-th
   nearest of them, r, bounds that of its true k-th neighbour.
3. *Pruning.*  |d(q, pivot) - d(x, pivot)| <= d(q, x), so only rings within r of the query's own
   distance from their pivot can hold a neighbour; and a cell whose bisecting plane with the
   query's own cell is farther than r has none.  The query goes to the chunks that are left.
4. *Merge.*  In each chunk a task keeps the k nearest points of each query, so what is shuffled
   and ranked for a query is at most k rows for each chunk it has visited.

Pivots only steer the search: the result equals brute force (ties by id).  Chunks with many
queries are cut into blocks of queries, so a task holds a block of queries and a chunk of points.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskline.sources.staging import stage

#: Points of a chunk and queries of a block: what a task compares at a time.
CHUNK, BLOCK = 8192, 8192
#: Pivots, and rings of a cell; beyond that, rings are dealt over chunks.
MAX_PIVOTS, MAX_RINGS = 256, 64
#: Cells of the distance matrix that a task computes at a time, and rows that it sends on at a time.
_MATRIX = 1_000_000
SENT = 50_000

_POINT = "key long, pid long, pvec array<double>"
_QUERY = "key long, qid long, qvec array<double>"


def dist_expr(a: str, b: str) -> str:
    """Euclidean distance of two array<double> columns, summed left to right."""
    return f"sqrt(aggregate(zip_with({a}, {b}, (x, y) -> (x - y) * (x - y)), CAST(0 AS DOUBLE), (acc, v) -> acc + v))"


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _distances(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """All distances, summed over the coordinates from the first to the last as ``dist_expr`` does."""
    out = np.zeros((len(q), len(p)))
    for j in range(p.shape[1]):
        diff = q[:, j, None] - p[None, :, j]
        out += diff * diff
    return np.sqrt(out)


class _Cells:
    """Pivots, and for each the outer limits of its rings and their numbers of chunks."""

    def __init__(self, pivots: np.ndarray, rings: list[list[float]], chunks: list[list[int]]):
        self.pivots, self.rings, self.chunks = pivots, [np.array(r) for r in rings], chunks
        starts = np.cumsum([0] + [c for cell in chunks for c in cell])
        first = np.cumsum([0] + [len(c) for c in chunks])
        #: number of the first chunk of each ring
        self.keys = [starts[a:b] for a, b in zip(first, first[1:])]
        self.apart = _distances(pivots, pivots)

    def place(self, vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance from all pivots) of each row."""
        d = _distances(vecs, self.pivots)
        return d.argmin(axis=1), d

    def ring(self, cell: int, d: float) -> int:
        return int(np.searchsorted(self.rings[cell], d, side="left"))


def _cells(points: DataFrame, n: int, chunk: int) -> _Cells:
    """Pivots are those points whose ids have the smallest hashes: MAX_PIVOTS rows at most, and
    MAX_RINGS numbers for each, reach the driver."""
    if n <= chunk:  # one cell, whatever its pivot
        return _Cells(np.zeros((1, 0)), [[]], [[1]])
    wanted = min(MAX_PIVOTS, math.ceil(math.sqrt(n / chunk)))
    rows = points.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()
    pivots = np.array([r["vec"] for r in rows])
    cells = _Cells(pivots, [[] for _ in rows], [[1] for _ in rows])
    probs = [k / MAX_RINGS for k in range(1, MAX_RINGS)]
    found = {r["cell"]: r for r in points.mapInArrow(_placed(cells), "cell int, d double").groupBy("cell").agg(F.count("*").alias("n"), F.percentile_approx("d", probs, 2000).alias("q")).collect()}
    rings, chunks = [], []
    for c in range(len(rows)):
        size = found[c]["n"] if c in found else 0
        want = max(1, min(MAX_RINGS, math.ceil(size / chunk)))
        cuts = sorted({found[c]["q"][round(k * MAX_RINGS / want) - 1] for k in range(1, want)}) if want > 1 else []
        rings.append(cuts)
        chunks.append([max(1, math.ceil(size / ((len(cuts) + 1) * chunk)))] * (len(cuts) + 1))
    return _Cells(pivots, rings, chunks)


def _blocks(n: int, width: int) -> Iterator[slice]:
    step = max(1, _MATRIX // max(width, 1))
    return (slice(k, k + step) for k in range(0, n, step))


def _placed(cells: _Cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = _matrix(batch.column(1))
            for s in _blocks(len(vecs), len(cells.pivots)):
                cell, d = cells.place(vecs[s])
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(d[np.arange(len(cell)), cell])], names=["cell", "d"])

    return run


def _dealt_points(cells: _Cells):
    """Each point with the key of its chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vecs = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
            keys = []
            for s in _blocks(len(vecs), len(cells.pivots)):
                cell, d = cells.place(vecs[s])
                for i, c, x in zip(ids[s].tolist(), cell.tolist(), d[np.arange(len(cell)), cell].tolist()):
                    r = cells.ring(c, x)
                    keys.append(int(cells.keys[c][r]) + (i * 0x9E3779B1 >> 7) % cells.chunks[c][r])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column(0), batch.column(1)], names=["key", "pid", "pvec"])

    return run


def _dealt_queries(cells: _Cells, near: bool):
    """Each query with the keys of the chunks it visits: those of its own ring (``near``), or all
    others within its radius."""

    def sent(batch: pa.RecordBatch, keys: list, rows: list) -> pa.RecordBatch:
        take = pa.array(rows, pa.int64())
        cols = [pa.array(keys, pa.int64()), batch.column(0).take(take), batch.column(1).take(take)]
        names = ["key", "qid", "qvec"]
        if not near:
            cols.append(batch.column(2).take(take))
            names.append("r")
        return pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = _matrix(batch.column(1))
            keys, rows = [], []
            for s in _blocks(len(vecs), len(cells.pivots)):
                cell, d = cells.place(vecs[s])
                radius = None if near else batch.column(2).to_numpy(zero_copy_only=False)[s]
                for i, own in enumerate(cell.tolist()):
                    at = cells.ring(own, d[i, own])
                    if near:
                        hit = [(own, at)]
                    else:
                        # a little more than the radius, for what rounding may have cost
                        r = radius[i] * (1 + 1e-9) + 1e-9 * d[i, own]
                        hit = []
                        for c in range(len(cells.pivots)):
                            if c != own and math.isfinite(r) and d[i, c] ** 2 - d[i, own] ** 2 > 2 * r * cells.apart[own, c] * (1 + 1e-9):
                                continue
                            lo, hi = (cells.ring(c, d[i, c] - r), cells.ring(c, d[i, c] + r)) if math.isfinite(r) else (0, len(cells.rings[c]))
                            hit += [(c, k) for k in range(lo, hi + 1) if (c, k) != (own, at)]
                    own_keys = [int(cells.keys[c][k]) + j for c, k in hit for j in range(cells.chunks[c][k])]
                    keys += own_keys
                    rows += [s.start + i] * len(own_keys)
                    if len(keys) >= SENT:
                        yield sent(batch, keys, rows)
                        keys, rows = [], []
            if keys:
                yield sent(batch, keys, rows)

    return run


def _close(q: np.ndarray, p: np.ndarray, k: int, own: np.ndarray, reach: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of all pairs that may be among the k nearest of their query and within its reach.

    Squared distances by a matrix product only sift, by a bound on their rounding; what is left is
    measured by :func:`_apart`.  ``own``: (row, column) of the queries themselves among the points."""
    centre = p.mean(axis=0)
    with np.errstate(invalid="ignore", over="ignore"):
        a, b = q - centre, p - centre
        qq, pp = (a * a).sum(axis=1), (b * b).sum(axis=1)
        slack = 1e-13 * (np.sqrt(qq) + np.sqrt(pp.max())) ** 2
    if not np.isfinite(slack).all():  # an infinite coordinate
        d = _distances(q, p) ** 2
        slack = np.where(np.isfinite(slack), slack, 0.0)
    else:
        d = a @ b.T
        d *= -2.0
        d += qq[:, None]
        d += pp
    d[own[0], own[1]] = np.inf
    # a bound that leaves few is as good as the k-th distance, which costs more
    limit = np.full(len(q), np.inf) if reach is None else reach * reach * (1 + 1e-9) + slack
    near = None if reach is None else d <= limit[:, None]
    if near is None or np.count_nonzero(near) > 8 * k * len(q):
        if len(p) > k:
            limit = np.minimum(limit, np.partition(d, k - 1, axis=1)[:, k - 1] + 2 * slack)
        near = d <= limit[:, None]
    return np.nonzero(near)


def _apart(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The distance of each row of ``q`` from that of ``p``, summed as ``_distances`` does."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        diff = q[:, j] - p[:, j]
        out += diff * diff
    return np.sqrt(out)


def _same(qid: np.ndarray, pid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of equal ids; ``pid`` is in order."""
    first, last = np.searchsorted(pid, qid, "left"), np.searchsorted(pid, qid, "right")
    rows = np.repeat(np.arange(len(qid)), last - first)
    return rows, np.arange(len(rows)) - np.searchsorted(rows, rows) + first[rows]


def _nearest(k: int, bounded: bool):
    """The k nearest points of a chunk for each query of a block, itself left out."""

    def run(queries: pa.Table, points: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if queries.num_rows and points.num_rows:
            qid, pid = queries.column("qid").to_numpy(), points.column("pid").to_numpy()
            order = np.argsort(pid, kind="stable")
            pid, pvec, qvec = pid[order], _matrix(points.column("pvec"))[order], _matrix(queries.column("qvec"))
            reach = queries.column("r").to_numpy() if bounded else None
            for s in _blocks(len(qid), len(pid)):
                q = qvec[s]
                rows, cols = _close(q, pvec, k, _same(qid[s], pid), reach[s] if bounded else None)
                far = _apart(q[rows], pvec[cols])
                ok = np.isfinite(far) & (qid[s][rows] != pid[cols])
                if bounded:
                    ok &= far <= reach[s][rows]
                rows, cols, far = rows[ok], cols[ok], far[ok]
                by = np.lexsort((cols, far, rows))  # ties are settled by id
                rows, cols, far = rows[by], cols[by], far[by]
                place = np.arange(len(rows)) - np.searchsorted(rows, rows)
                keep = place < k
                out[0].append(qid[s][rows[keep]])
                out[1].append(pid[cols[keep]])
                out[2].append(far[keep])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, kinds)], names=["qid", "pid", "dist"])

    return run


def _visit(queries: DataFrame, points: DataFrame, k: int, block: int, bounded: bool) -> DataFrame:
    """(qid, pid, dist): the k nearest points of each visited chunk."""
    visited = queries.groupBy("key").agg(F.ceil(F.count("*") / F.lit(float(block))).cast("int").alias("blocks"))
    q = queries.join(visited, "key").withColumn("block", F.pmod(F.xxhash64("qid"), "blocks").cast("int")).drop("blocks")
    # chunks that no query visits are not shuffled
    p = points.join(visited, "key").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    return q.groupBy("key", "block").cogroup(p.groupBy("key", "block")).applyInArrow(_nearest(k, bounded), "qid long, pid long, dist double")


def knn(queries: DataFrame, points: DataFrame, k: int, key: str = "id", vec: str = "vec", exclude_self: bool = True, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """(qid, rank, pid, dist) for the k nearest points of every query id (ties by id).

    ``queries`` holds the ids to answer, each also in ``points``; an id with fewer than k other
    points gets all of them.  Points with a missing coordinate are no neighbours and have none.
    Exact duplicate vectors are collapsed first, so a vector shared by many rows (a hot group)
    never produces all pairs: the search runs over distinct vectors, and each duplicate group
    contributes only its k+1 smallest ids, which the ranked window cuts before its shuffle."""
    whole = F.forall(F.col(vec), lambda x: x.isNotNull() & ~F.isnan(x))
    pts = points.where(whole).select(F.col(key).cast("long").alias("id"), F.col(vec).alias("vec"))
    ranked = pts.withColumn("mrank", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("mrank") <= k + 1)
    # the k+1 smallest ids of each distinct vector, the smallest standing for it
    members = stage(ranked.withColumn("rep", F.min("id").over(Window.partitionBy("vec"))), "neighbours")
    reps = members.where("mrank = 1").select("id", "vec")
    asked = queries.select(F.col(key).cast("long").alias("qid"))
    q = asked.join(members.select(F.col("id").alias("qid"), F.col("rep").alias("qrep")), "qid", "left")
    # ids beyond the k+1 smallest of their vector are found by the vector
    rest = q.where("qrep is null").select("qid").join(pts.withColumnRenamed("id", "qid"), "qid").join(reps.withColumnRenamed("id", "qrep"), "vec").select("qid", "qrep")
    q = stage(q.where("qrep is not null").unionByName(rest), "queries")
    dn = _knn_distinct(q.select(F.col("qrep").alias("id")).distinct(), reps, k, chunk, block)
    same = members.select(F.col("rep").alias("qrep"), F.col("id").alias("pid"), F.lit(0.0).alias("dist"))
    other = dn.join(members.where(F.col("mrank") <= k).select(F.col("rep").alias("prep"), F.col("id").alias("pid")), "prep").select("qrep", "pid", "dist")
    j = q.join(same.unionByName(other), "qrep")
    if exclude_self:
        j = j.where(F.col("pid") != F.col("qid"))
    top = j.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("dist", "pid"))).where(F.col("rank") <= k)
    return top.select("qid", "rank", "pid", "dist")


def _knn_distinct(queries: DataFrame, points: DataFrame, k: int, chunk: int, block: int) -> DataFrame:
    """(qrep, prep, dist): the k nearest other points of every query id; vectors are distinct."""
    n = points.count()
    if n < 2:
        return queries.sparkSession.createDataFrame([], "qrep long, prep long, dist double")
    cells = _cells(points, n, chunk)
    asked = queries.join(points, "id")
    dealt = points.mapInArrow(_dealt_points(cells), _POINT)
    found = _visit(asked.mapInArrow(_dealt_queries(cells, True), _QUERY), dealt, k, block, False)
    if sum(map(sum, cells.chunks)) > 1:
        found = stage(found, "near")
        kth = F.row_number().over(Window.partitionBy("qid").orderBy("dist", "pid"))
        radius = found.withColumn("_r", kth).where(F.col("_r") == k).select(F.col("qid").alias("id"), F.col("dist").alias("r"))
        asked = asked.join(radius, "id", "left").select("id", "vec", F.coalesce("r", F.lit(math.inf)).alias("r"))
        found = found.unionByName(_visit(asked.mapInArrow(_dealt_queries(cells, False), f"{_QUERY}, r double"), dealt, k, block, True))
    best = F.row_number().over(Window.partitionBy("qid").orderBy("dist", "pid"))
    return found.withColumn("_r", best).where(F.col("_r") <= k).select(F.col("qid").alias("qrep"), F.col("pid").alias("prep"), "dist")
