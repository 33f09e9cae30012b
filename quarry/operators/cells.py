"""Exact nearest-neighbour joins with pruning (J7, R3, R5, T9 over every vector).

The corpus is cut into cells around pivots (rows of the corpus, at most
``PIVOT_BYTES`` of them); a cell's summary is its number of rows and the range
of their distances to the pivot.  Two rounds of cogroups follow:

1. every query meets its nearest cells, as many as surely hold ``k`` rows; the
   ``k``-th best of these bounds the distance of the true neighbours;
2. a query then meets only the cells that the triangle inequality cannot rule
   out: those whose ring of distances around the pivot comes within that bound.

Both rounds use ``best_rows`` of ``quarry.operators.knn``, so a pair has the score it
has there.  What travels is not a query per cell but a query per group of cells, with
the bits of those it meets, so it is never more than where every block meets every
block.  Groups are cut into blocks of bounded bytes on both sides: a cell with a third
of all rows is many tasks.  Reaching the driver: the pivots, one summary row per cell
and one count per group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.knn import _LEAST_ROWS, DEFAULT_BLOCK_BYTES, arrow_type, best_rows, blocked, matrix, prepared, ranked
from quarry.session import materialize

#: Most bytes of pivots (as doubles); their number grows as the root of the corpus below that.
PIVOT_BYTES = 32 * 1024 * 1024
#: Pairs up to which every block meets every block: the rounds' jobs cost more than they save.
LEAST_PAIRS = 4 * 10**8
#: Distances held at once while rows are compared with the pivots.
_AT_ONCE = 1 << 19


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (rows * rows).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _slack(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """More than what rounding can change a distance by, per row."""
    return 1e-6 * (1 + np.abs(rows).max(axis=1, initial=0) + np.abs(pivots).max(initial=0)) * math.sqrt(pivots.shape[1])


def _slices(n_rows: int, n_pivots: int) -> Iterator[slice]:
    step = max(1, _AT_ONCE // max(n_pivots, 1))
    return (slice(lo, lo + step) for lo in range(0, n_rows, step))


def _assign(pivots: np.ndarray, metric: str):
    """Arrow map (id, vec) -> (id, vec, cell, dist); the last cell holds the zero vectors of a cosine search."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = prepared(matrix(batch.column(1), pivots.shape[1])[0], metric)
            cell, dist = np.zeros(len(rows), np.int32), np.zeros(len(rows))
            for s in _slices(len(rows), len(pivots)):
                d = _distances(rows[s], pivots)
                cell[s] = d.argmin(axis=1)
                dist[s] = d[np.arange(len(d)), cell[s]]
            if metric == "cosine":
                cell[~rows.any(axis=1)] = len(pivots)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(dist)], ["id", "vec", "cell", "dist"])
    return run


def _route(pivots: np.ndarray, cells: np.ndarray, metric: str, k: int):
    """Arrow map (qid, qvec, bound) -> (qid, qvec, cells to meet).

    ``cells`` has a row (rows that surely count, least and greatest distance) per cell.
    Without a bound (null) these are the nearest cells that hold ``k`` rows, with one
    those within it that were not among them."""
    count, least, most = cells.T
    filled = most >= 0  # the greatest distance of a cell without rows is negative

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = prepared(matrix(batch.column(1), pivots.shape[1])[0], metric)
            bound = batch.column(2).to_numpy(zero_copy_only=False)
            for s in _slices(len(rows), len(pivots)):
                wanted: list[np.ndarray] = []
                some = rows[s]
                d = np.hstack([_distances(some, pivots), np.zeros((len(some), 1))])
                if metric == "cosine":
                    d[~some.any(axis=1)] = np.nan  # a zero vector is equally near to all rows
                far = np.nan_to_num(d, nan=1e300, posinf=1e300)
                far[:, -1] = 1e300  # zero vectors say nothing about the nearest rows
                order = np.argsort(np.where(filled, far, np.inf), axis=1, kind="stable")
                enough = np.cumsum(np.where(filled, count, 0)[order], axis=1) >= k
                first = np.where(enough.any(axis=1), enough.argmax(axis=1) + 1, filled.sum())
                slack = _slack(some, pivots)
                gap = np.maximum(d - most, least - d)
                gap[:, -1] = 0
                for i in range(len(some)):
                    near = order[i, :min(first[i], filled.sum())]
                    if np.isnan(bound[s][i]):
                        wanted.append(near)
                        continue
                    open_ = filled & ~(gap[i] > bound[s][i] + slack[i])
                    open_[near] = False
                    wanted.append(np.flatnonzero(open_).astype(np.int32))
                ends = np.concatenate([[0], np.cumsum([len(w) for w in wanted])]).astype(np.int32)
                flat = np.concatenate(wanted).astype(np.int32)
                own = batch.slice(s.start, len(some))
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    ["qid", "qvec", "cells"])
    return run


def _groups(pivots: np.ndarray, sizes: dict[int, int], most: int) -> list[list[int]]:
    """The cells in groups of neighbours, of about ``most`` rows; a larger cell is a group of its own."""
    out, left = [], [sorted(sizes)]
    places = np.vstack([pivots, np.zeros((1, pivots.shape[1]))])  # the cell of zero vectors
    while left:
        cells = left.pop()
        wanted = math.ceil(sum(sizes[c] for c in cells) / most)
        if wanted < 2 or len(cells) == 1:
            out.append(cells)
            continue
        at = places[cells]
        cells = [cells[i] for i in np.argsort(at[:, np.ptp(at, axis=0).argmax()], kind="stable")]
        share = np.cumsum([sizes[c] for c in cells])
        cut = int(np.searchsorted(share, share[-1] * (wanted // 2) / wanted)) + 1
        cut = min(cut, len(cells) - 1)
        left += [cells[cut:], cells[:cut]]
    return out


def _grouped(route, groups: list[list[int]], sizes: dict[int, int], n_cells: int):
    """``route`` with the cells as their groups and, of each group, the bits of its cells; with the number of
    cells, of rows in them, and the distance that a neighbour may have (null: any)."""
    rows_in = np.array([sizes.get(c, 0) for c in range(n_cells)], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for some in route(iter([batch])):
                open_ = np.zeros((some.num_rows, n_cells), bool)
                ends = some.column(2).offsets.to_numpy()
                open_[np.repeat(np.arange(some.num_rows), np.diff(ends)), some.column(2).flatten().to_numpy()] = True
                to: list[list[dict]] = [[] for _ in range(some.num_rows)]
                for g, cells in enumerate(groups):
                    bits = open_[:, cells]
                    packed = np.packbits(bits, axis=1, bitorder="little")
                    for i in np.flatnonzero(bits.any(axis=1)).tolist():
                        to[i].append({"g": g, "bits": packed[i].tobytes()})
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), batch.column(2).slice(at, some.num_rows),
                     pa.array(to, pa.list_(pa.struct([("g", pa.int32()), ("bits", pa.binary())]))),
                     pa.array(open_.sum(axis=1), pa.int64()), pa.array(open_ @ rows_in, pa.int64())],
                    ["qid", "qvec", "bound", "to", "cells", "rows"])
                at += some.num_rows
    return run


def routed_type(queries: T.StructType) -> T.StructType:
    """What ``_grouped`` makes of queries (qid, qvec)."""
    goes = T.ArrayType(T.StructType([T.StructField("g", T.IntegerType()), T.StructField("bits", T.BinaryType())]))
    return T.StructType([queries["qid"], queries["qvec"], T.StructField("bound", T.DoubleType()), T.StructField("to", goes),
                         T.StructField("cells", T.LongType()), T.StructField("rows", T.LongType())])


def _cell_solver(k: int, metric: str, exclude_self: bool, schema: pa.Schema):
    """``block_solver`` for rows with their place among the group's cells (``at``) and queries with the bits of
    the cells they meet; a query's rows must come within its ``bound``."""
    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[object, object, float]] = []
        if left.num_rows and right.num_rows:
            left = left.take(pa.array(np.argsort(left.column("at").to_numpy(), kind="stable")))
            dim = right.column("qvec").combine_chunks().value_lengths()[0].as_py()
            q, c = matrix(right.column("qvec"), dim)[0], matrix(left.column("vec"), dim)[0]
            cells, starts = np.unique(left.column("at").to_numpy(), return_index=True)
            bits = np.frombuffer(b"".join(right.column("bits").to_pylist()), np.uint8).reshape(len(q), -1)
            parts = [(lo, hi, np.flatnonzero(bits[:, x >> 3] >> (x & 7) & 1)) for x, lo, hi in
                     zip(cells.tolist(), starts.tolist(), [*starts.tolist()[1:], len(c)], strict=True)]
            bound = right.column("bound").to_numpy()
            bound = np.where(np.isfinite(bound), bound, np.nan)
            reach = -bound * bound if metric == "l2sq" else 1 - bound * bound / 2
            out += best_rows(right.column("qid").to_pylist(), q, left.column("id").to_pylist(), c, k, metric, exclude_self, reach, parts)
        return pa.table([pa.array(col, f.type) for col, f in zip(zip(*out, strict=True) if out else ([],) * 3, schema, strict=True)],
                        schema=schema)
    return solve


def _meet(queries: DataFrame, corpus: DataFrame, groups: list[list[int]], sizes: dict[int, int], per_block: int,
          solve, schema: T.StructType) -> DataFrame:
    """Solve (queries of ``_grouped``) against the rows of their cells, block by block.

    A query goes to each group of cells it meets, not to each cell; a group's rows go to each block of its queries."""
    to = queries.select("qid", "qvec", "bound", F.explode("to").alias("t")).select("qid", "qvec", "bound", "t.g", "t.bits")
    asked = {r.g: r["count"] for r in to.groupBy("g").count().collect()}  # at most one row per group
    if not asked:
        return queries.sparkSession.createDataFrame([], schema)
    spark = queries.sparkSession
    blocks = lambda n: max(1, round(n / per_block))
    cut = {g: (blocks(sum(sizes[c] for c in groups[g])), blocks(n)) for g, n in asked.items()}
    by_cell = spark.createDataFrame([(c, g, at, *cut[g]) for g in asked for at, c in enumerate(groups[g])],
                                    "cell int, g int, at int, cbs int, qbs int")
    by_group = spark.createDataFrame([(g, *n) for g, n in cut.items()], "g int, cbs int, qbs int")
    # by row, so that a repeated id is spread as well; the rows come from written tables, so a row keeps its number
    part = lambda key, n: F.pmod(F.xxhash64(key, F.monotonically_increasing_id()), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = corpus.join(F.broadcast(by_cell), "cell").withColumn("cb", part("id", "cbs")).withColumn("qb", every("qbs")) \
        .select("g", "cb", "qb", "at", "id", "vec")  # at most one row per cell
    right = to.join(F.broadcast(by_group), "g").withColumn("qb", part("qid", "qbs")).withColumn("cb", every("cbs")) \
        .select("g", "cb", "qb", "qid", "qvec", "bound", "bits")
    keys = ["g", "cb", "qb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(solve, schema)


def knn_join(queries: DataFrame, corpus: DataFrame, k: int, *,
             query_id: str = "qid", query_vec: str = "qvec", id_col: str = "id", vec_col: str = "embedding",
             metric: str = "cosine", exclude_self: bool = False, n_pivots: int | None = None,
             block_bytes: int = DEFAULT_BLOCK_BYTES, least_pairs: int = LEAST_PAIRS,
             report: dict | None = None) -> DataFrame:
    """The rows of ``quarry.operators.knn.knn`` with cells that cannot matter left out.

    ``metric`` is cosine or l2sq.  Up to ``least_pairs`` pairs, and for vectors of
    several dimensions, the search is that of ``knn``; also if the first round shows
    that meeting the open cells moves more vectors than meeting every block (vectors
    without clusters).  ``least_pairs=0`` meets cells in any case.  ``report`` receives the number
    of ``cells``, the ``pairs`` compared of ``all_pairs``, and ``copies``, the
    cells met per query.
    """
    if metric not in ("cosine", "l2sq"):
        raise ValueError(metric)
    spark = queries.sparkSession
    counted: list[int] = []
    q = materialize(queries.select(F.col(query_id).alias("qid"), F.col(query_vec).alias("qvec")).where(F.size("qvec") > 0),
                    counter=counted)
    c = corpus.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where(F.size("vec") > 0)
    nq, (q_lo, q_hi) = counted[0], q.agg(F.min(F.size("qvec")), F.max(F.size("qvec"))).first()
    nc, c_lo, c_hi = c.agg(F.count("*"), F.min(F.size("vec")), F.max(F.size("vec"))).first()
    every_block = lambda: blocked(q, c, k, nq, nc, q_hi or 0, metric, exclude_self, block_bytes)
    if nq * nc <= least_pairs or not nq or not nc or len({q_lo, q_hi, c_lo, c_hi}) > 1:
        return every_block()
    most = max(1, PIVOT_BYTES // (8 * c_lo))
    wanted = min(n_pivots or math.isqrt(nc), most)
    sample = c.select("vec").orderBy(F.xxhash64("id"), F.xxhash64("vec")).limit(wanted).collect()
    pivots = np.unique(prepared(np.array([r.vec for r in sample], dtype=np.float64), metric), axis=0)
    pivots = pivots[np.isfinite(pivots).all(axis=1)]
    if not len(pivots):
        return every_block()

    id_type, qid_type = c.schema["id"].dataType, q.schema["qid"].dataType
    placed = materialize(c.mapInArrow(_assign(pivots, metric), T.StructType(
        [*c.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("dist", T.DoubleType())])))
    # rows of other ids than a query's own are at least the cell's distinct ids less one
    surely = F.count_distinct("id") - 1 if exclude_self else F.count("*")
    summary = np.tile([0.0, 0.0, -1.0], (len(pivots) + 1, 1))
    sizes: dict[int, int] = {}
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), surely.alias("sure"), F.min("dist").alias("lo"),
                                        F.max("dist").alias("hi")).collect():  # one row per cell
        sizes[r.cell] = r.n
        # rows of no finite distance and the zero vectors can always matter
        bounded = r.cell < len(pivots) and math.isfinite(r.hi)
        summary[r.cell] = (r.sure, r.lo, r.hi) if bounded else (r.sure, 0.0, math.inf)

    schema = T.StructType([T.StructField("qid", qid_type), T.StructField("id", id_type), T.StructField("rv", T.DoubleType())])
    arrow = pa.schema([(f.name, arrow_type(f.dataType)) for f in schema.fields])
    solve = _cell_solver(k, metric, exclude_self, arrow)
    per_block = max(1, block_bytes // (8 * c_lo))
    share = math.ceil(nc / spark.sparkContext.defaultParallelism)  # so that small inputs use all cores
    groups = _groups(pivots, sizes, min(per_block, max(_LEAST_ROWS, share)))
    routed = routed_type(q.schema)

    def route(rows: DataFrame) -> DataFrame:
        return materialize(rows.mapInArrow(_grouped(_route(pivots, summary, metric, k), groups, sizes, len(pivots) + 1), routed))

    def met(rows: DataFrame) -> DataFrame:
        return _meet(rows, placed.select("id", "vec", "cell"), groups, sizes, per_block, solve, schema)

    near = route(q.withColumn("bound", F.lit(None).cast("double")))
    first = materialize(ranked(met(near), k))
    reach = F.sqrt(-F.min("rv")) if metric == "l2sq" else F.sqrt(F.greatest(2 - 2 * F.min("rv"), F.lit(0.0)))
    # with fewer than k rows in the first round a query has met every cell already
    bounds = first.groupBy("qid").agg(F.when(F.count("*") >= k, F.nanvl(reach, F.lit(math.inf))).otherwise(F.lit(math.inf)).alias("bound"))
    left_open = route(q.join(bounds, "qid", "left").select("qid", "qvec", F.coalesce("bound", F.lit(math.inf)).alias("bound")))
    in_blocks = nq * math.ceil(nc / per_block) + nc * math.ceil(nq / per_block)
    if least_pairs and left_open.agg(F.sum("cells")).first()[0] > in_blocks:
        return every_block()
    rest = met(left_open)
    if report is not None:
        copies, pairs = near.unionByName(left_open).agg(F.sum("cells"), F.sum("rows")).first()
        report |= {"cells": len(sizes), "pairs": pairs, "all_pairs": nq * nc, "copies": copies / nq}
    value = -F.col("rv") if metric == "l2sq" else F.col("rv")
    return ranked(first.select("qid", "id", "rv").unionByName(rest), k) \
        .select("qid", "rank", "id", value.alias("distance" if metric == "l2sq" else "score"))
