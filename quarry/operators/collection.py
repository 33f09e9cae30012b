"""Vector collection and vector-set utilities (J1, J2, J6, X4, G2, G8, G9, I1-I3,
I10, W3, W8, W9, K4, K5, K7, R7).

The collection is one table: ``id, embedding, document, metadata fields`` --
the catalog inner-joined with its vectors (J1); rows without a vector drop out
(G2).  The join is a plain equi-join so Catalyst/AQE choose broadcast or
sort-merge from the real sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import text as tx
from quarry.functions import vectors as vx
from quarry.session import materialize
from quarry.sources.vectors import read_vectors, write_vectors  # noqa: F401

META_FIELDS = ("title", "description", "agency", "api_url", "url", "tags")


def build_collection(catalog: DataFrame, vectors: DataFrame, *, id_col: str = "id",
                     vec_id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """J1 + C8 + C9: catalog x vectors on ``str(id)``; NULL metadata -> ''."""
    cat_cols = set(catalog.columns)
    cat = catalog.select(
        F.col(id_col).cast("string").alias("id"),
        *[(F.col(f) if f in cat_cols else F.lit(None).cast("string")).alias(f)
          for f in META_FIELDS])
    vec = vectors.select(F.col(vec_id_col).cast("string").alias("id"),
                         F.col(vec_col).alias("embedding"))
    joined = cat.join(vec, "id", "inner")
    return joined.select(
        "id", "embedding",
        tx.document_text("title", "description", "agency", "tags").alias("document"),
        *[tx.safe_str(f).alias(f) for f in META_FIELDS])


def last_write_wins(df: DataFrame, key: str, order_col: str, value_cols: list[str]) -> DataFrame:
    """Dict-build semantics -- per key keep the values of the last row by ``order_col``."""
    packed = F.struct(*[F.col(c) for c in value_cols])
    return df.groupBy(key).agg(F.max_by(packed, F.col(order_col)).alias("_v")) \
        .select(key, *[F.col(f"_v.{c}").alias(c) for c in value_cols])


def subset(vectors: DataFrame, ids: DataFrame, id_col: str = "id", ids_col: str = "id") -> DataFrame:
    """Vectors whose id is in the list (left semi join)."""
    return vectors.join(ids.select(F.col(ids_col).alias(id_col)), id_col, "left_semi")


def lookup(ids: DataFrame, table: DataFrame, id_col: str = "id", order_cols: tuple[str, ...] = ()) -> DataFrame:
    """G9 / G11 / J2 batch form: left join, with a ``found`` flag; first row per id by
    ``order_cols`` (default: the values of all other columns that can be ordered)."""
    # First row per id as an aggregate (combined map-side: a hot id is never one task's group).
    others = [c for c in table.columns if c != id_col]
    order = F.struct(*[F.col(c) for c in (order_cols or others)])
    first = table.groupBy(id_col).agg(F.min_by(F.struct(*[F.col(c) for c in others]), order).alias("_r")) \
        .select(id_col, *[F.col(f"_r.{c}").alias(c) for c in others]).withColumn("_found", F.lit(True))
    out = ids.join(first, id_col, "left")
    return out.withColumn("found", F.coalesce(F.col("_found"), F.lit(False))).drop("_found")


def search_ids(df: DataFrame, pattern: str, id_col: str = "id", show: int = 20) -> DataFrame:
    """Ids containing ``pattern`` (case-insensitive): first ``show`` by id plus totals."""
    hit = df.where(F.instr(F.lower(F.col(id_col).cast("string")), pattern.lower()) > 0) \
        .select(F.col(id_col).alias("id"))
    w = Window.orderBy("id")  # over at most ``show`` rows
    total = hit.select(F.count("*")).scalar()  # scalar subquery, computed once
    shown = hit.orderBy("id").limit(show).withColumn("rn", F.row_number().over(w).cast("bigint"))
    return shown.withColumn("n_total", total) \
        .withColumn("n_more", F.greatest(F.col("n_total") - show, F.lit(0)).cast("bigint"))


def vector_info(vectors: DataFrame, id_col: str = "id", vec_col: str = "embedding",
                n_ids: int = 5) -> DataFrame:
    """Count, dimension of the first vector (lowest id), first ids, element type."""
    first = F.min_by(F.size(vec_col), F.col(id_col))
    ids = vectors.select(id_col).orderBy(id_col).limit(n_ids) \
        .select(F.array_join(F.sort_array(F.collect_list(F.col(id_col))).cast("array<string>"), ",")).scalar()
    info = vectors.agg(F.count("*").alias("total_embeddings"),
                       first.cast("bigint").alias("embedding_dimension"))
    elem = vectors.schema[vec_col].dataType.elementType.simpleString()
    return info.withColumn("sample_ids", ids).withColumn("data_type", F.lit(elem))


def quick_stats(vectors: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Count, dimension, mean L2 norm, global min / max (one pass, partial aggregation)."""
    return vectors.agg(
        F.count("*").alias("n"),
        F.max(F.size(vec_col)).cast("bigint").alias("dim"),
        F.avg(vx.norm(vec_col)).alias("mean_norm"),
        F.min(F.array_min(vec_col)).cast("double").alias("min_value"),
        F.max(F.array_max(vec_col)).cast("double").alias("max_value"))


def dimension_stats(vectors: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Per-dimension mean and population std, all dimensions.

    ``posexplode`` then ``groupBy(pos)``: the partial aggregate runs before the
    shuffle, so the shuffle carries ``dims x partitions`` rows.
    """
    ex = vectors.select(F.posexplode(vec_col).alias("dim", "x"))
    return ex.groupBy("dim").agg(F.avg(F.col("x").cast("double")).alias("mean"),
                                 F.stddev_pop(F.col("x").cast("double")).alias("std")) \
        .select(F.col("dim").cast("bigint").alias("dim"), "mean", "std")


def head_tail(vectors: DataFrame, id_col: str = "id", vec_col: str = "embedding",
              n: int = 10) -> DataFrame:
    """First / last ``n`` values, norm and dimension, as long rows."""
    base = vectors.select(
        F.col(id_col).alias("id"), F.size(vec_col).cast("bigint").alias("dim"),
        vx.norm(vec_col).alias("norm"),
        F.array(F.struct(F.lit("head").alias("part"), vx.head(vec_col, n).alias("v")),
                F.struct(F.lit("tail").alias("part"), vx.tail(vec_col, n).alias("v"))).alias("_p"))
    parts = base.select("id", "dim", "norm", F.explode("_p").alias("_q"))
    return parts.select("id", "dim", "norm", F.col("_q.part").alias("part"),
                        F.posexplode("_q.v").alias("pos", "value")).select("id", "dim", "norm", "part",
                                   F.col("pos").cast("bigint").alias("pos"),
                                   F.col("value").cast("double").alias("value"))


def show_vectors(vectors: DataFrame, ids: DataFrame, id_col: str = "id", vec_col: str = "embedding", n: int = 10) -> DataFrame:
    """W8 for wanted ids: dimension, norm, first and last ``n`` values; an unknown id gets
    the first ``n`` ids of the vectors instead (``found`` false, ``sample_ids``)."""
    known = vectors.select(F.col(id_col).alias("id"), F.size(vec_col).cast("bigint").alias("dim"), vx.norm(vec_col).alias("norm"),
                           vx.head(vec_col, n).alias("head"), vx.tail(vec_col, n).alias("tail"), F.lit(True).alias("found"))
    some = vectors.select(F.col(id_col).alias("id")).distinct().orderBy("id").limit(n) \
        .agg(F.sort_array(F.collect_list("id")).alias("sample_ids"))
    shown = ids.select(F.col(id_col).alias("id")).distinct().join(known, "id", "left") \
        .withColumn("found", F.coalesce("found", F.lit(False)))
    # one row of at most n ids
    return shown.join(F.broadcast(some), ~F.col("found"), "left")


def with_row_index(df: DataFrame, order_cols: list[str], name: str = "row_index") -> DataFrame:
    """Consecutive 0-based index in ``order_cols`` order without a one-task window.

    The rows are range-partitioned and sorted, written once, numbered inside their
    range, and shifted by the sizes of the ranges before (one row per range).
    """
    ranges = materialize(df.repartitionByRange(*order_cols).withColumn("_range", F.spark_partition_id()))
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order_cols)) - 1
    return ranges.withColumn("_i", inside).join(F.broadcast(starts), "_range") \
        .select(*df.columns, (F.col("_start") + F.col("_i")).cast("bigint").alias(name))


def batches(df: DataFrame, order_cols: list[str], batch_size: int) -> DataFrame:
    """``batch_id`` = floor(index / n) in the given order (last batch short)."""
    idx = with_row_index(df, order_cols, "_idx")
    return idx.withColumn("batch_id", F.floor(F.col("_idx") / batch_size).cast("bigint")) \
        .withColumnRenamed("_idx", "row_index")


def wide_export(vectors: DataFrame, dim: int, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """K7: ``id, dim_000 ... dim_{d-1}`` (3-digit pad); ``dim`` from one row of the data."""
    return vectors.select(F.col(id_col).alias("id"), *[
        F.col(vec_col)[i].cast("double").alias(f"dim_{i:03d}") for i in range(dim)])


def first_dimension(vectors: DataFrame, vec_col: str = "embedding") -> int:
    row = vectors.select(F.size(vec_col).alias("d")).where("d > 0").first()
    return int(row["d"]) if row else 0


def wide_blocks(vectors: DataFrame, id_col: str = "id", vec_col: str = "embedding", rows: int = 1024) -> DataFrame:
    """The vectors as row-major matrix blocks of at most about ``rows`` rows each.

    One row per (dimension, block): ids in order and their components, concatenated.
    Null and empty vectors take no part; blocks are made by hash, so no task holds more
    than its blocks.
    """
    v = vectors.where(F.size(vec_col) > 0).select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    n = v.count()
    block = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // rows)))).cast("int")
    packed = v.groupBy(F.size("v").alias("dims"), block.alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("id", "v"))).alias("_r"))
    return packed.select("dims", "block", F.size("_r").alias("rows"), F.col("_r.id").alias("ids"),
                         F.flatten("_r.v").alias("values"))
