"""Scratch tables of the operators in the shared checkpoint folder."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import session
from quarry.session import ensure_checkpoint_dir, read_table, ship_package


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder registered and the package importable on executors."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, deleted when Python exits."""
    return session.scratch_path(spark, f"llm-{name}")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned_shuffles(spark: SparkSession):
    """Queries started inside delete their shuffle files as soon as they end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    The file-based copy cuts the lineage: after a lost executor later steps
    read files again instead of running the earlier steps again.
    """
    path = scratch_path(df.sparkSession, name)
    with cleaned_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns under their names, whatever else the frame holds.

    Extra columns may clash with the operators' own working names, so every
    operator starts from exactly the columns it needs.
    """
    return df.select(*(F.col(f"`{n}`") for n in names))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)
