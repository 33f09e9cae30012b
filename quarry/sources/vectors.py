"""A4 / K4 / K5: vector tables (Parquet; pickle files are not read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_vectors(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4 / K5: full refresh of a vector table (Parquet)."""
    df.write.mode(mode).parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """A4: vector-map scan."""
    return spark.read.parquet(path)
