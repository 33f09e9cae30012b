"""Catalog build: JSON files -> flows -> catalog rows.

Flow of work, all distributed:
``read_json_files`` (one row per file, VARIANT) -> ``unwrap_flows`` (one row
per flow, ``posexplode`` of the chosen list) -> ``typed_flows`` (typed
columns + ``_valid``; invalid flows go to a quarantine frame) ->
``normalise`` (one ``select``) -> ``keep_first`` (per id, first by path/pos,
as an aggregate so a hot id is combined map-side) -> ``write_catalog_csv``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import catalog as cf
from quarry.functions.text import first_nonblank
from quarry.sources.catalog_csv import (CATALOG_COLUMNS, path_exists, read_catalog_csv,  # noqa: F401
                                        write_catalog_csv)
from quarry.sources.json_files import read_json_files
from quarry.session import spread

CATALOG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CATALOG_COLUMNS])
ANNOTATIONS_TYPE = "array<struct<type:string,title:string,text:string>>"
# List keys tried, in order, when ``data.dataflows`` is absent.
FALLBACK_LIST_KEYS = ("dataflows", "datasets", "results", "items", "records")


def _kind(v: F.Column) -> F.Column:
    return F.schema_of_variant(v)


def unwrap_flows(files: DataFrame, json_col: str = "json") -> DataFrame:
    """A2: one row per flow (``path, pos, flow``).

    ``data.dataflows`` if it is a list; else the first list among the fallback
    keys; else a root list; else the root object itself.  An empty chosen list
    counts as none found: the root object is the one flow (an empty root list
    yields no row).
    """
    v = F.col(json_col)

    def as_list(path: str) -> F.Column:
        return F.try_variant_get(v, path, "array<variant>")

    data_ok = _kind(F.try_variant_get(v, "$.data", "variant")).startswith("OBJECT")
    found = F.when(data_ok & as_list("$.data.dataflows").isNotNull(), as_list("$.data.dataflows"))
    for k in FALLBACK_LIST_KEYS:
        found = found.when(_kind(v).startswith("OBJECT") & as_list(f"$.{k}").isNotNull(), as_list(f"$.{k}"))
    root = _kind(v).startswith("OBJECT")
    chosen = F.when(_kind(v).startswith("ARRAY"), as_list("$")) \
        .when(root & (F.size(F.coalesce(found, F.array())) == 0), F.array(v)).when(root, found)
    return files.where(v.isNotNull()).select("path", F.posexplode(chosen).alias("pos", "flow"))


def typed_flows(flows: DataFrame, flow_col: str = "flow") -> DataFrame:
    """C6 + field access: typed columns and a ``_valid`` flag.

    Invalid (the reference raises and skips the flow): not an object; ``names``
    or ``descriptions`` truthy but not an object; ``annotations`` truthy but not
    a list of objects.
    """
    f = F.col(flow_col)

    def g(path, typ="string"):
        return F.try_variant_get(f, path, typ)

    def truthy_non_object(path):
        k = _kind(F.try_variant_get(f, path, "variant"))
        s = F.try_variant_get(f, path, "string")
        falsy = k.isNull() | (k == "VOID") | (s.isin("", "0", "false", "0.0")) | (k.startswith("ARRAY") & (F.size(g(path, "array<variant>")) == 0)) \
            | (k.startswith("OBJECT") & (F.size(F.coalesce(F.try_variant_get(f, path, "map<string,variant>"), F.create_map())) == 0))
        return ~falsy & ~k.startswith("OBJECT")

    ann_items = g("$.annotations", "array<variant>")
    ann_kind = _kind(F.try_variant_get(f, "$.annotations", "variant"))
    ann_bad = (ann_items.isNotNull() & ~F.forall(ann_items, lambda a: _kind(a).startswith("OBJECT"))) \
        | (ann_items.isNull() & truthy_non_object("$.annotations") & ~ann_kind.startswith("OBJECT"))
    anns = F.transform(F.coalesce(ann_items, F.array()), lambda a: F.struct(
        F.try_variant_get(a, "$.type", "string").alias("type"),
        F.try_variant_get(a, "$.title", "string").alias("title"),
        F.try_variant_get(a, "$.text", "string").alias("text")))
    valid = _kind(f).startswith("OBJECT") & ~truthy_non_object("$.names") \
        & ~truthy_non_object("$.descriptions") & ~F.coalesce(ann_bad, F.lit(False))
    return flows.select(
        "path", "pos",
        g("$.id").alias("native_id"), g("$.name").alias("name"), g("$.names.en").alias("names_en"),
        g("$.description").alias("description"), g("$.descriptions.en").alias("descriptions_en"),
        g("$.agencyID").alias("agency_id"), anns.cast(ANNOTATIONS_TYPE).alias("annotations"),
        F.coalesce(valid, F.lit(False)).alias("_valid"))


def normalise(flows: DataFrame) -> DataFrame:
    """Typed flows -> 9 catalog columns (+ ``path, pos`` for ordering)."""
    agency = F.coalesce(first_nonblank("agency_id", F.lit(cf.DEFAULT_AGENCY)), F.lit(""))
    return spread(flows).select(
        "path", "pos",
        cf.stable_id("native_id", "path", "pos", agency).alias("id"),
        F.coalesce(first_nonblank("name", "names_en"), F.lit("")).alias("title"),
        F.coalesce(first_nonblank("description", "descriptions_en"), F.lit("")).alias("description"),
        agency.alias("agency"),
        F.lit("").alias("collected"),
        cf.infer_freq("annotations").alias("freq"),
        cf.api_url("native_id").alias("api_url"),
        F.lit("").alias("download_url"),
        F.array_join(cf.collect_tags("annotations"), ";").alias("tags"))


def keep_first(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """Per key the first row in ``order_cols`` order.

    Written as ``min_by`` aggregation (partial aggregation before the shuffle),
    so a key holding a large share of rows never lands whole on one task.
    """
    others = [c for c in df.columns if c != key]
    packed = F.struct(*[F.col(c) for c in others])
    order = F.struct(*[F.col(c) for c in order_cols])
    return df.groupBy(key).agg(F.min_by(packed, order).alias("_r")) \
        .select(key, *[F.col(f"_r.{c}").alias(c) for c in others])


def build_catalog(spark: SparkSession, path: str, glob: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """A1 -> K1 chain. Returns (catalog, quarantine)."""
    files = read_json_files(spark, path, glob)
    bad_files = files.where(F.col("json").isNull()) \
        .select("path", F.lit(None).cast("long").alias("pos"), F.lit("not valid JSON").alias("reason"))
    typed = typed_flows(unwrap_flows(files))
    bad_flows = typed.where(~F.col("_valid")).select("path", F.col("pos").cast("long"),
                                                      F.lit("flow skipped").alias("reason"))
    cat = keep_first(normalise(typed.where("_valid")), "id", ["path", "pos"])
    return cat.select(*CATALOG_COLUMNS), bad_files.unionByName(bad_flows)


