"""The append-only audit log (JSON, partitioned by day), one folder per batch.

A batch is committed by the ``_SUCCESS`` marker that Spark's output committer
writes last.  Appending a batch again replaces it, and readers take committed
batches only, so a retried or replayed write never doubles a record and a write
that died half-way is never seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MARKER = "_SUCCESS"


def append_audit(records: DataFrame, path: str, batch: str | int) -> None:
    """K6 sink: the records of one batch as JSON, partitioned by day."""
    target = f"{path}/batch={batch}"
    _delete(records.sparkSession, f"{target}/{MARKER}")  # a batch being replaced is not committed
    records.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true") \
        .partitionBy("dt").json(target)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.delete(p, False)


def committed_batches(spark: SparkSession, path: str) -> list[str]:
    """Folders of the committed batches (one listing, no data is read)."""
    p, fs = _file_system(spark, f"{path}/batch=*/{MARKER}")
    return sorted(s.getPath().getParent().toString() for s in (fs.globStatus(p) or []))


def read_audit(spark: SparkSession, path: str, schema, day: str | None = None) -> DataFrame:
    """A6 scan: the committed batches with a given schema (nothing is inferred); ``day``
    reads one day's folders only."""
    batches = committed_batches(spark, path)
    if not batches:
        return spark.createDataFrame([], schema)
    log = spark.read.schema(schema).option("basePath", path).json(batches).select(*schema.names)
    return log if day is None else log.where(log["dt"] == day)
