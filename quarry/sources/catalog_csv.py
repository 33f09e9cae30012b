"""A3 / K1: the catalog as CSV (fixed columns, header, UTF-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import materialize
from quarry.sources.sinks import CSV_OPTIONS

CATALOG_COLUMNS = ("id", "title", "description", "agency", "collected", "freq",
                   "api_url", "download_url", "tags")


def write_catalog_csv(catalog: DataFrame, path: str) -> None:
    """K1: fixed column order, header, UTF-8; no rows is an error."""
    out = materialize(catalog.select(*CATALOG_COLUMNS))  # the build runs once, for the check and the file
    if out.isEmpty():
        raise ValueError("No dataflows found. Check your input structure.")
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def read_catalog_csv(spark: SparkSession, preferred: str, fallback: str,
                     extra_columns: tuple[str, ...] = ("url",)) -> DataFrame:
    """A3: the combined catalog if it exists, else the plain one.

    Every column is read as text (no inference: empty cells stay blank, never
    NaN); columns the file lacks (e.g. ``url`` in the plain catalog) are NULL.
    """
    path = preferred if path_exists(spark, preferred) else fallback
    df = spark.read.options(**CSV_OPTIONS).option("multiLine", "true").option("inferSchema", "false").csv(path)
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else F.lit(None).cast("string")).alias(c)
                       for c in CATALOG_COLUMNS + tuple(extra_columns)])
