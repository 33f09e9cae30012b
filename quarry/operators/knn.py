"""Exact k-nearest-neighbour search.

Queries and corpus are cut into hash blocks of bounded bytes, both sides; every
(query block, corpus block) pair meets in one cogroup, which multiplies the
blocks in row chunks and keeps each query's k best, so a task's memory does not
depend on the sizes of either side.  A ``row_number`` window (planned as
``WindowGroupLimit`` before and after the shuffle) merges the blocks.  Only ids
and vectors take part; attributes of the winners are joined to them afterwards
(``answers.store_search``).

The product only preselects: whatever could be among the k best in spite of
rounding is scored again, row by row, so a pair has one score wherever it is
computed, and ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import materialize

#: Bytes of vectors (as doubles) in one block of either side.
DEFAULT_BLOCK_BYTES = 32 * 1024 * 1024
#: Rows of the corpus and queries multiplied at once inside a block.
_ROWS, _QUERIES = 4096, 128
#: Sizes of squared lengths within which the preselection is made in single precision.
_SINGLE = (1e-20, 1e30)
#: Corpus rows that are worth a block of their own, so that small inputs use all cores.
_LEAST_ROWS = 256


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows x dim matrix of the vectors of that dimension, their row numbers)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fit = np.flatnonzero(sizes == dim)
    flat = column.take(pa.array(fit)).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(fit), dim), fit


def prepared(vectors: np.ndarray, metric: str) -> np.ndarray:
    """Unit vectors for cosine (a zero vector stays), others as they are."""
    if metric != "cosine":
        return vectors
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(norm == 0, 1.0, norm)


def _exact(c: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    """Ranking value of each row with one query; a row's value does not depend on the others."""
    if metric == "l2sq":
        return -((c - q) ** 2).sum(axis=1)
    return (c * q).sum(axis=1)


def _own_rows(q_ids, c_ids) -> tuple[np.ndarray, np.ndarray]:
    """(corpus rows, queries) of equal ids, by corpus row."""
    at: dict[object, list[int]] = {}
    for j, x in enumerate(q_ids):
        at.setdefault(x, []).append(j)
    pairs = [(i, j) for i, x in enumerate(c_ids) for j in at.get(x, ())]
    rows = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return rows[:, 0], rows[:, 1]


class _Product:
    """Preselection values of query and corpus rows, and what rounding can change one by.

    In single precision, about twice as fast, unless a vector's length does not allow it."""

    def __init__(self, metric: str, single: bool) -> None:
        self.kind, self.doubled = (np.float32 if single else np.float64), metric == "l2sq"
        self.buffer = np.empty(0, self.kind)

    def factor(self, rows: np.ndarray, square: np.ndarray, corpus: bool) -> np.ndarray:
        if not self.doubled:
            return rows.astype(self.kind)
        out = np.empty((len(rows), rows.shape[1] + 1), self.kind)  # 2 q.c - c.c as one product
        out[:, :-1], out[:, -1] = (rows, square) if corpus else (2 * rows, -1)
        return out

    def values(self, some: np.ndarray, part: np.ndarray) -> np.ndarray:
        n = len(some) * len(part)
        if len(self.buffer) < n:
            self.buffer = np.empty(n, self.kind)
        return np.matmul(some, part.T, out=self.buffer[:n].reshape(len(some), len(part)))

    def slack(self, dim: int, scale: np.ndarray) -> np.ndarray:
        return 2.5e-7 * (dim + 8) * scale + 1e-30 if self.kind is np.float32 else 1e-9 * (scale + 1)


def best_rows(q_ids, q: np.ndarray, c_ids, c: np.ndarray, k: int, metric: str, exclude_self: bool,
              reach: np.ndarray | None = None,
              parts: list[tuple[int, int, np.ndarray | None]] | None = None) -> Iterator[tuple[object, object, float]]:
    """(query id, corpus id, ranking value) of each query's k best rows.

    A query that has k rows only looks at rows that may reach the k-th of them.  ``reach``:
    per query a ranking value that its rows must reach, or nan.  ``parts``: ranges of corpus
    rows and the queries that meet them (None: all); by default every query meets every row."""
    n, dim = len(q_ids), q.shape[1]
    by_id = sorted(range(len(c_ids)), key=lambda i: (c_ids[i] is not None, c_ids[i]))
    place = np.empty(len(c_ids), np.int64)
    place[by_id] = np.arange(len(c_ids))
    own_c, own_q = _own_rows(q_ids, c_ids) if exclude_self else (np.empty(0, np.int64),) * 2
    # of every query the best so far: ranking values, best first, and corpus rows
    best, rows_of = np.full((n, k), -np.inf), np.full((n, k), -1, np.int64)
    floor_of = np.full(n, np.nan) if reach is None else reach.astype(np.float64)
    q = prepared(q, metric)
    q_square = (q * q).sum(axis=1)
    longest = q_square.max(initial=0)
    product, local = None, np.full(n, -1, np.int64)
    for lo, hi, who in [(lo, min(lo + _ROWS, end), who) for start, end, who in parts or [(0, len(c_ids), None)]
                        for lo in range(start, end, _ROWS)]:
        part = prepared(c[lo:hi], metric)
        length = (part * part).sum(axis=1)
        most = length.max(initial=0)
        low, high = _SINGLE
        single = bool(low < max(longest, most) < high) and (product is None or product.kind is np.float32)
        if product is None or single != (product.kind is np.float32):
            product = _Product(metric, single)
            factors = product.factor(q, q_square, False)
        right = product.factor(part, length, True)
        a, b = np.searchsorted(own_c, [lo, hi])
        step = max(_QUERIES, _ROWS * _QUERIES // len(part))
        for at in range(0, n if who is None else len(who), step):
            some = np.arange(at, min(at + step, n)) if who is None else who[at:at + step]
            values = product.values(factors[at:at + step] if who is None else factors[some], right)
            local[some] = np.arange(len(some))
            mine = local[own_q[a:b]], own_c[a:b] - lo
            mine = mine[0][mine[0] >= 0], mine[1][mine[0] >= 0]
            local[some] = -1
            square = q_square[some]
            floor = floor_of[some] + (square if metric == "l2sq" else 0.0)
            new = np.flatnonzero(np.isnan(floor))
            if len(new):
                spare = min(k + exclude_self, len(part))
                floor[new] = np.partition(values[new], len(part) - spare, axis=1)[:, len(part) - spare]
            floor -= product.slack(dim, most + square)
            # rounded towards less, or a value at the floor would be cut off
            within = values >= np.nextafter(floor.astype(product.kind), product.kind(-np.inf))[:, None]
            within[mine] = False
            j, i = np.divmod(np.flatnonzero(within), len(part))
            if product.kind is np.float32 and len(j) > (16 * k + 64) * len(some):  # too coarse for these rows
                product = _Product(metric, False)
                factors, right = product.factor(q, q_square, False), product.factor(part, length, True)
            for few in range(0, len(j), _ROWS):
                query, row = some[j[few:few + _ROWS]], i[few:few + _ROWS]
                _keep(best, rows_of, query, lo + row, _exact(part[row], q[query], metric), place)
            full = some[rows_of[some, -1] >= 0]
            floor_of[full] = np.fmax(best[full, -1], floor_of[full])
    found, column = np.nonzero(rows_of >= 0)
    return ((q_ids[j], c_ids[i], v) for j, i, v in zip(found.tolist(), rows_of[found, column].tolist(),
                                                       best[found, column].tolist(), strict=True))


def _keep(best: np.ndarray, rows_of: np.ndarray, query: np.ndarray, row: np.ndarray, value: np.ndarray, place: np.ndarray) -> None:
    """Put the rows found into their queries' k best, by value, then by the place of their id."""
    k = best.shape[1]
    changed = np.unique(query)
    have, column = np.nonzero(rows_of[changed] >= 0)
    have = changed[have]
    query = np.concatenate([have, query])
    row, value = np.concatenate([rows_of[have, column], row]), np.concatenate([best[have, column], value])
    order = np.lexsort((place[row], -value, query))
    query, row, value = query[order], row[order], value[order]
    starts = np.searchsorted(query, query)
    rank = np.arange(len(query)) - starts
    first = rank < k
    best[query[first], rank[first]], rows_of[query[first], rank[first]] = value[first], row[first]


def ranked(candidates: DataFrame, k: int) -> DataFrame:
    """(qid, rank, id, rv): the k best of each query, by value, then id."""
    w = Window.partitionBy("qid").orderBy(F.col("rv").desc(), F.col("id").asc())
    return candidates.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select("qid", "rank", "id", "rv")


def block_solver(k: int, metric: str, exclude_self: bool, schema: pa.Schema):
    """Arrow cogroup function (corpus rows ``id, vec``; query rows ``qid, qvec``)."""
    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        dims = right.column("qvec").combine_chunks().value_lengths() if right.num_rows else pa.array([], pa.int32())
        out: list[tuple[object, object, float]] = []
        for dim in sorted({d for d in dims.to_pylist() if d}):
            q, q_rows = matrix(right.column("qvec"), dim)
            c, c_rows = matrix(left.column("vec"), dim)
            q_ids = right.column("qid").take(pa.array(q_rows)).to_pylist()
            c_ids = left.column("id").take(pa.array(c_rows)).to_pylist()
            if c_ids:
                out += best_rows(q_ids, q, c_ids, c, k, metric, exclude_self)
        return pa.table([pa.array(col, f.type) for col, f in zip(zip(*out, strict=True) if out else ([],) * 3, schema, strict=True)],
                        schema=schema)
    return solve


def arrow_type(dt: T.DataType) -> pa.DataType:
    known = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(), T.DoubleType: pa.float64()}
    if type(dt) not in known:
        raise TypeError(f"unsupported id type {dt}")
    return known[type(dt)]


def knn(queries: DataFrame, corpus: DataFrame, k: int, *,
        query_id: str = "qid", query_vec: str = "qvec",
        id_col: str = "id", vec_col: str = "embedding",
        metric: str = "cosine", exclude_self: bool = False,
        block_bytes: int = DEFAULT_BLOCK_BYTES) -> DataFrame:
    """Top-k corpus rows per query row.

    Returns ``(qid, rank, id, score)`` for cosine/dot or ``(qid, rank, id, distance)``
    for l2sq; rank is 1-based, ordered by the ranking value then by id.
    ``exclude_self`` drops corpus rows whose id equals the query id (W5) before
    ranking.  A query meets the corpus rows of its own dimension; null and empty
    vectors take no part.
    """
    if metric not in ("cosine", "dot", "l2sq"):
        raise ValueError(metric)
    counted: list[int] = []
    # written once: an expensive producer (an embedder) runs a single time
    q = materialize(queries.select(F.col(query_id).alias("qid"), F.col(query_vec).alias("qvec"))
                    .where(F.size("qvec") > 0), counter=counted)
    c = corpus.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where(F.size("vec") > 0)
    dim = int(q.agg(F.max(F.size("qvec"))).first()[0] or 0)
    return blocked(q, c, k, counted[0], c.count() if counted[0] else 0, dim, metric, exclude_self, block_bytes)


def blocked(q: DataFrame, c: DataFrame, k: int, n_q: int, n_c: int, dim: int, metric: str, exclude_self: bool,
            block_bytes: int) -> DataFrame:
    """``knn`` of ``n_q`` written queries (qid, qvec) and ``n_c`` rows (id, vec) of at most ``dim`` dimensions."""
    spark = q.sparkSession
    row_bytes = 8 * max(dim, 1)
    q_blocks = max(1, math.ceil(n_q * row_bytes / block_bytes))
    c_blocks = max(1, math.ceil(n_c * row_bytes / block_bytes),
                   min(spark.sparkContext.defaultParallelism, math.ceil(n_c / _LEAST_ROWS)))
    schema = T.StructType([T.StructField("qid", q.schema["qid"].dataType), T.StructField("id", c.schema["id"].dataType),
                           T.StructField("rv", T.DoubleType())])
    arrow = pa.schema([(f.name, arrow_type(f.dataType)) for f in schema.fields])
    block = lambda col, n: F.pmod(F.xxhash64(col), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = c.withColumn("cb", block("id", c_blocks)).withColumn("qb", every(q_blocks))
    right = q.withColumn("qb", block("qid", q_blocks)).withColumn("cb", every(c_blocks))
    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(
        block_solver(k, metric, exclude_self, arrow), schema)
    value = -F.col("rv") if metric == "l2sq" else F.col("rv")
    return ranked(found, k).select("qid", "rank", "id", value.alias("distance" if metric == "l2sq" else "score"))
