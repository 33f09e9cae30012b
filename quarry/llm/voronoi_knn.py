"""Operator 10: exact top-k inner products by a Voronoi kNN join.

Queries and data are grouped by their nearest pivot.  Each group's summary
(size, pivot, radius) bounds the scores between a query group Q and a data
group D: with q = p + e, |e| <= r and x = p' + e', |e'| <= r',

    |q.x - p.p'| <= |p| r' + r |p'| + r r'

The lower bounds tell a score that the k best of every query of Q reach, the
upper bounds which data groups can matter; only those are replicated.  Groups
are cut into blocks of bounded size, so a hot cell spreads over many tasks, and
every (query block, data block) pair is solved by one integer-exact matrix
product whose k best per query are merged at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm import tables

MAX_PIVOTS = 256
QUERY_BLOCK = 1024
DATA_BLOCK = 8192
STEP = 256  # queries multiplied at once


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, v = floor(scale * x) per component (x as double).

    Rows whose id or vector is null, or whose vector holds a null or non-finite
    component, are left out.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return tables.columns(vectors, "vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        "vec_id", F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long")).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim)


def _pivots(vectors: DataFrame, rows: int) -> dict[int, np.ndarray]:
    """Pivots by dimension: the vectors of the ``sqrt(rows) / 16`` (4 to MAX_PIVOTS) smallest id hashes."""
    n = min(max(round(math.sqrt(rows) / 16), 4), MAX_PIVOTS)
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).collect()
    by_dim: dict[int, list] = {}
    for r in chosen:
        by_dim.setdefault(len(r.v), []).append(r.v)
    return {d: np.unique(np.array(v, dtype=np.float64), axis=0) for d, v in by_dim.items()}


def _placed(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """vec_id, row, dim, cell, dist, v; dimensions without a pivot have the one cell around the origin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.diff(batch.column(2).offsets.to_numpy())
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                x = _matrix(rows.column(2), int(dim)).astype(np.float64)
                p = pivots.get(int(dim), np.zeros((1, int(dim))))
                d2 = np.stack([((x - c) ** 2).sum(axis=1) for c in p], axis=1)
                cell = d2.argmin(axis=1)
                dist = np.sqrt(d2[np.arange(len(x)), cell])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(np.full(len(x), dim, np.int32)), pa.array(cell.astype(np.int32)),
                     pa.array(dist), rows.column(2)], ["vec_id", "row", "dim", "cell", "dist", "v"])

    return vectors.select("vec_id", "row", "v").mapInArrow(
        run, "vec_id long, row long, dim int, cell int, dist double, v array<long>")


def _summary(placed: DataFrame) -> dict[tuple[int, int], tuple[int, float]]:
    """(dim, cell) -> (rows, radius); one entry per pivot."""
    rows = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("r")).collect()
    return {(r.dim, r.cell): (r.n, r.r) for r in rows}


def _ids(placed: DataFrame) -> dict[tuple[int, int], int]:
    """(dim, cell) -> ids, each counted in one of its cells, so that several cells together
    hold at least the sum of their counts."""
    once = placed.groupBy("dim", "vec_id").agg(F.min("cell").alias("cell"))
    return {(r.dim, r.cell): r.n for r in once.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n")).collect()}


def _needed(queries: dict, data: dict, pivots: dict[int, np.ndarray], k: int) -> list[tuple[int, int, int]]:
    """(dim, query cell, data cell) pairs whose scores can be among the k best.

    ``data`` gives the distinct ids and the radius of every cell: k + 1 ids are at least
    k rows that are not the query's own.
    """
    out = []
    for (dim, qc), (_, rq) in queries.items():
        centre = pivots.get(dim, np.zeros((1, dim)))
        cells = [(c, n, r) for (d, c), (n, r) in data.items() if d == dim]
        mid = np.array([centre[qc] @ centre[c] for c, _, _ in cells])
        slack = np.array([np.linalg.norm(centre[qc]) * r + rq * np.linalg.norm(centre[c]) + rq * r for c, _, r in cells])
        slack = slack * (1 + 1e-9) + 1e-6 * (1 + np.abs(mid))
        sure, have = -math.inf, 0
        for i in np.argsort(-(mid - slack)):
            have += cells[i][1]
            if have >= k + 1:  # the query itself may be among them
                sure = mid[i] - slack[i]
                break
        out += [(dim, qc, c) for (c, _, _), up in zip(cells, mid + slack, strict=True) if up >= sure]
    return out


def _best(k: int):
    """Solves one (query block, data block) pair."""
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        qid, did = (t.column("vec_id").to_numpy() for t in (left, right))
        rows = left.column("row").to_numpy()
        q, d = (_matrix(t.column("v").combine_chunks(), t.column("dim")[0].as_py()) for t in (left, right))
        order = np.argsort(did, kind="stable")  # equal scores then come by id
        did, d = did[order], d[order]
        dim = q.shape[1]
        top = lambda m: float(np.abs(m.astype(np.float64)).max(initial=0))
        exact = dim * top(q) * top(d) < 2**53  # products and sums are whole numbers a double holds
        kind = np.float64 if exact else np.int64
        q, d = q.astype(kind), d.astype(kind).T
        least = -np.inf if exact else np.iinfo(np.int64).min
        own = np.stack([np.searchsorted(did, qid, side) for side in ("left", "right")], axis=1)  # the rows of a query's own id
        keep = min(k, len(did))
        out = [[], [], [], []]
        for at in range(0, len(qid), STEP):
            scores = q[at:at + STEP] @ d
            for row, (a, b) in zip(scores, own[at:at + STEP], strict=True):
                row[a:b] = least
            floor = np.partition(scores, len(did) - keep, axis=1)[:, len(did) - keep]
            for i, row in enumerate(scores):
                hit = np.flatnonzero(row >= floor[i])
                a, b = own[at + i]
                hit = hit[(hit < a) | (hit >= b)]
                hit = hit[np.argsort(-row[hit], kind="stable")][:k]
                out[0].append(np.full(len(hit), rows[at + i]))
                out[1].append(np.full(len(hit), qid[at + i]))
                out[2].append(did[hit])
                out[3].append(row[hit].astype(np.int64))
        return pa.table([pa.array(np.concatenate(c)) for c in out], schema=schema)

    return solve


def knn_join(queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products.

    Both frames have vec_id and v (whole-number components).  Candidates are all
    data rows of the query's dimension but those of the query's own id; ties go to
    the smaller vec_id.  Rows count, not ids: a repeated data row is as many
    candidates, and every query row is answered, a repeated one repeatedly.  A query
    with fewer candidates has all of them, one with none has no row.
    """
    spark: SparkSession = data.sparkSession
    queries, data = (tables.keep(x.select("vec_id", "v", F.monotonically_increasing_id().alias("row")), "vectors")
                     for x in (queries, data))
    pivots = _pivots(data, data.count())
    q, d = (tables.keep(_placed(x, pivots), "placed") for x in (queries, data))
    q_sum, d_sum, ids = _summary(q), _summary(d), _ids(d)
    bounds = {cell: (ids.get(cell, 0), radius) for cell, (_, radius) in d_sum.items()}
    # one row per pair of cells at most
    plan = [(dim, qc, math.ceil(q_sum[dim, qc][0] / QUERY_BLOCK), dc, math.ceil(d_sum[dim, dc][0] / DATA_BLOCK))
            for dim, qc, dc in _needed(q_sum, bounds, pivots, k)]
    # made anew for each side: a cogroup tells its sides' columns apart by where they come from
    cells = lambda side: F.broadcast(spark.createDataFrame(
        plan, "dim int, qc int, qn int, dc int, dn int")).withColumn("cell", F.col(side))
    hashed = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")  # noqa: E731  (an id may hold any share of the rows)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    key = ["dim", "qc", "qb", "dc", "db"]
    left = q.join(cells("qc"), ["dim", "cell"]).withColumn(
        "qb", hashed("qn")).withColumn("db", every("dn")).select(*key, "vec_id", "row", "v")
    right = d.join(cells("dc"), ["dim", "cell"]).withColumn(
        "db", hashed("dn")).withColumn("qb", every("qn")).select(*key, "vec_id", "row", "v")
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        _best(k), "query_row long, query_id long, vec_id long, score long")
    by = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
