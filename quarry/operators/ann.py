"""Approximate top-k with an inverted-file index (k-means lists).

``write_index`` / ``append`` keep the lists on storage, one folder per segment
and list; ``calibrate`` measures on a bounded sample of stored vectors how many
lists a query has to probe for a wanted recall, and ``search_index`` reads only
the probed lists' folders.  ``build_index`` / ``search`` do the same in one
session without storage.

The exact blocked search (``quarry.operators.knn``) is the default; this is the
opt-in approximate form for corpora where ``n_queries x n_vectors`` is too much.

* ``build_index``: spherical k-means (MLlib) on unit vectors; every vector is
  assigned to its nearest list.  Centroids (``n_lists x d``) are small.
* ``search``: each query probes its ``nprobe`` nearest lists.  Lists are packed
  in groups of neighbours of about ``block_rows`` vectors (a list holding a third
  of the corpus becomes many blocks), a query goes once to each group with lists
  it probes, and each block's cogroup compares the pairs of queries and probed
  lists with the solver of the exact search, emitting ``k`` rows per query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import vectors as vx
from quarry.operators.cells import _cell_solver, _grouped, _groups, _meet, routed_type
from quarry.operators.knn import _LEAST_ROWS, arrow_type, knn, matrix, prepared, ranked
from quarry.session import materialize


AT_ONCE = 1 << 18  # similarities with centroids held at once


def _unit(col):
    """The vector as doubles of length 1 (a zero vector stays); the norm is bound, so it is taken once a row."""
    def scaled(n):
        return F.when(n > 0, F.transform(F.col(col), lambda x: x.cast("double") / n)).otherwise(
            F.transform(F.col(col), lambda x: x.cast("double")))
    return F.transform(F.array(vx.norm(col)), scaled)[0]


def build_index(corpus: DataFrame, n_lists: int, *, id_col: str = "id", vec_col: str = "embedding",
                seed: int = 42, max_iter: int = 20):
    """Returns (centroids as a numpy array, assignments ``id, vec, list_id``)."""
    unit = corpus.select(F.col(id_col).alias("id"), _unit(vec_col).alias("vec"))
    feats = unit.withColumn("features", array_to_vector("vec"))
    model = KMeans(k=n_lists, seed=seed, maxIter=max_iter, featuresCol="features",
                   predictionCol="list_id").fit(feats)
    cents = np.vstack([c / (np.linalg.norm(c) or 1.0) for c in model.clusterCenters()])
    assigned = model.transform(feats).select("id", "vec", F.col("list_id").cast("int"))
    return cents, assigned


def _nearest(spark, centroids: np.ndarray, nprobe: int):
    """Column function: the ``nprobe`` nearest lists of a vector, nearest first."""
    bc = spark.sparkContext.broadcast(centroids)
    probe = min(nprobe, centroids.shape[0])

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def nearest_lists(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = bc.value
        step = max(1, AT_ONCE // len(c))
        for v in batches:
            for lo in range(0, len(v), step):
                m = np.vstack([np.asarray(x, dtype=np.float64) for x in v[lo:lo + step]])
                s = prepared(m, "cosine") @ c.T
                if probe == 1:
                    idx = np.where(np.isnan(s), -np.inf, s).argmax(axis=1)[:, None]
                else:
                    idx = np.argsort(-s, axis=1, kind="stable")[:, :probe]
                yield pd.Series([row.tolist() for row in idx])

    return nearest_lists


def _probed(centroids: np.ndarray, nprobe: int):
    """Arrow map (qid, qvec, ...) -> (qid, qvec, the ``nprobe`` nearest lists, nearest first)."""
    probe, step = min(nprobe, len(centroids)), max(1, AT_ONCE // len(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                some = batch.slice(lo, step)
                s = prepared(matrix(some.column(1), centroids.shape[1])[0], "cosine") @ centroids.T
                lists = np.argsort(-s, axis=1, kind="stable")[:, :probe].astype(np.int32)
                ends = np.arange(0, lists.size + 1, probe, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.ListArray.from_arrays(ends, pa.array(lists.ravel()))], ["qid", "qvec", "cells"])

    return run


def _queries(queries: DataFrame, query_id: str, query_vec: str, centroids: np.ndarray) -> DataFrame:
    """The queries that the lists can answer, without a bound on a neighbour's distance."""
    return queries.select(F.col(query_id).alias("qid"), F.col(query_vec).alias("qvec"), F.lit(None).cast("double").alias("bound")) \
        .where(F.size("qvec") == centroids.shape[1])


def search(queries: DataFrame, centroids: np.ndarray, assigned: DataFrame, k: int, *, nprobe: int = 4,
           query_id: str = "qid", query_vec: str = "qvec", exclude_self: bool = False,
           block_rows: int = 50_000) -> DataFrame:
    """Approximate cosine top-k: ``(qid, rank, id, score)``.  A vector sits in one list, so a pair is scored once."""
    sizes = {r.list_id: r["count"] for r in assigned.groupBy("list_id").count().collect()}  # at most n_lists rows
    share = math.ceil(sum(sizes.values()) / queries.sparkSession.sparkContext.defaultParallelism)
    groups = _groups(centroids, sizes, min(block_rows, max(_LEAST_ROWS, share))) if sizes else []
    q = _queries(queries, query_id, query_vec, centroids)
    routed = materialize(q.mapInArrow(_grouped(_probed(centroids, nprobe), groups, sizes, len(centroids)), routed_type(q.schema)))
    out_schema = T.StructType([T.StructField("qid", q.schema["qid"].dataType), T.StructField("id", assigned.schema["id"].dataType),
                               T.StructField("rv", T.DoubleType())])
    arrow = pa.schema([(f.name, arrow_type(f.dataType)) for f in out_schema.fields])
    found = _meet(routed, assigned.select("id", "vec", F.col("list_id").alias("cell")), groups, sizes, block_rows,
                  _cell_solver(k, "cosine", exclude_self, arrow), out_schema)
    return ranked(found, k).withColumnRenamed("rv", "score")


# ---------------------------------------------------------------- stored index

FIT_ROWS = 100_000  # rows (smallest id hashes) that the centroids are fitted on; every row is indexed
SAMPLE_QUERIES = 400  # stored vectors whose exact neighbours calibrate the number of probes


def write_index(corpus: DataFrame, path: str, n_lists: int | None = None, *, id_col: str = "id",
                vec_col: str = "embedding", segment: str = "first", seed: int = 42) -> None:
    """Fit the centroids and store all rows of ``corpus`` as the first segment.

    Null and empty vectors are left out.  Layout: ``path/centroids`` (one row per
    list), ``path/vectors/segment=.../list_id=...`` (id, vec)."""
    spark = corpus.sparkSession
    rows = corpus.where(F.size(vec_col) > 0)
    n = n_lists or default_lists(rows.count())
    cents, _ = build_index(rows.orderBy(F.xxhash64(id_col)).limit(FIT_ROWS), n, id_col=id_col, vec_col=vec_col, seed=seed)
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(cents)], "list_id int, centroid array<double>") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    append(corpus, path, segment, id_col=id_col, vec_col=vec_col)


def append(rows: DataFrame, path: str, segment: str, *, id_col: str = "id", vec_col: str = "embedding") -> None:
    """Add rows as a segment of their own; the same segment written again replaces itself.

    Rows are rebalanced by list, so a list with a third of all rows is written by many tasks."""
    cents = read_centroids(rows.sparkSession, path)
    unit = rows.where(F.size(vec_col) > 0).select(F.col(id_col).alias("id"), _unit(vec_col).alias("vec"))
    unit.withColumn("list_id", F.element_at(_nearest(rows.sparkSession, cents, 1)("vec"), 1)).hint("rebalance", "list_id") \
        .write.mode("overwrite").partitionBy("list_id").parquet(f"{path}/vectors/segment={segment}")


def read_centroids(spark, path: str) -> np.ndarray:
    """The centroids in list order (``n_lists`` rows, whatever the corpus size)."""
    return np.array([r.centroid for r in spark.read.parquet(f"{path}/centroids").orderBy("list_id").collect()])


def read_lists(spark, path: str, lists: list[int] | None = None) -> DataFrame:
    """(id, vec, list_id) of all segments; with ``lists`` only their folders are read."""
    rows = spark.read.parquet(f"{path}/vectors")
    return (rows if lists is None else rows.where(F.col("list_id").isin(lists))).select("id", "vec", "list_id")


def calibrate(spark, path: str, k: int, wanted: float = 0.95, sample: int = SAMPLE_QUERIES) -> int:
    """Fewest probes with which the sample's exact top-k neighbours are found at the ``wanted`` rate.

    The exact search compares ``sample`` stored vectors with all of them; a
    neighbour counts as found if its list is among the query's first ones."""
    cents = read_centroids(spark, path)
    rows = read_lists(spark, path)
    queries = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select(F.col("id").alias("qid"), F.col("vec").alias("qvec"))
    exact = knn(queries, rows, k, vec_col="vec", exclude_self=True)
    order = _nearest(spark, cents, len(cents))
    place = exact.join(rows.select("id", "list_id"), "id").join(queries.select("qid", order("qvec").alias("lists")), "qid") \
        .select(F.array_position("lists", F.col("list_id")).alias("place"))
    counts = sorted(tuple(r) for r in place.groupBy("place").count().collect())  # at most n_lists rows
    total, found = sum(n for _, n in counts), 0
    for at, n in counts:
        found += n
        if found >= wanted * total:
            return int(at)
    return len(cents)


def search_index(queries: DataFrame, path: str, k: int, nprobe: int, *, query_id: str = "qid", query_vec: str = "qvec",
                 exclude_self: bool = False, block_rows: int = 50_000) -> DataFrame:
    """Approximate cosine top-k over the stored lists that some query probes."""
    spark = queries.sparkSession
    cents = read_centroids(spark, path)
    probed = _probed(cents, nprobe)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in probed(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(some.column(2).flatten().to_numpy()))], ["list_id"])

    probes = _queries(queries, query_id, query_vec, cents).mapInArrow(distinct, "list_id int").distinct()
    lists = sorted(r.list_id for r in probes.collect())  # at most n_lists rows
    return search(queries, cents, read_lists(spark, path, lists), k, nprobe=nprobe, query_id=query_id,
                  query_vec=query_vec, exclude_self=exclude_self, block_rows=block_rows)


def recall(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Per query: share of the exact top-k ids the approximate search found."""
    hit = exact.select("qid", "id").join(approx.select("qid", "id", F.lit(1).alias("h")), ["qid", "id"], "left")
    return hit.groupBy("qid").agg((F.sum(F.coalesce("h", F.lit(0))) / F.count("*")).alias("recall"))


def default_lists(n_rows: int) -> int:
    """About sqrt(n) lists, at least 1."""
    return max(1, int(math.sqrt(max(n_rows, 1))))
