"""Structured Streaming jobs.

* ``chunk_stream`` -- pages arriving as files -> chunk rows (stateless, append).
* ``dedupe_stream`` -- drop repeats of a key within a watermark delay
  (``dropDuplicatesWithinWatermark``).  The reference's ``visited`` set never
  expires; with a watermark a repeat arriving later than the delay passes.
  ``dedupe_stream(..., delay=None)`` keeps all keys forever (exact, state grows).
* ``expiring_dedupe`` -- the same by event time alone, whatever the micro-batches
  of a stream in time order: one row per key and delay, keys expire.
* ``answer_stream`` -- a query stream answered against a static collection in
  ``foreachBatch``; each batch's answers and audit records are written to a
  path keyed by batch id, so a replayed batch overwrites itself (idempotent).
"""

from __future__ import annotations

import bisect
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from quarry.functions import urls as ux
from quarry.operators.answers import answer_queries, audit_records
from quarry.operators.pages import extract_pages, page_chunks
from quarry.session import ensure_checkpoint_dir


def chunk_stream(pages: DataFrame, url_col: str = "url", html_col: str = "html", **chunk_args) -> DataFrame:
    """Streaming pages -> K3 chunk rows."""
    fields = extract_pages(pages, url_col, html_col)
    return page_chunks(fields, **chunk_args)


def dedupe_stream(df: DataFrame, key_cols: list[str], ts_col: str, delay: str | None = "1 hour",
                  canonical_url: str | None = None) -> DataFrame:
    """Drop repeats of ``key_cols`` (optionally a url canonicalised first)."""
    if canonical_url is not None:
        df = df.withColumn(canonical_url, ux.canonical(canonical_url))
    if delay is None:
        return df.dropDuplicates(key_cols)
    if df.schema[ts_col].dataType.typeName() == "timestamp_ntz":  # watermarks need TIMESTAMP
        df = df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return df.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(key_cols)


#: How a key is written as text and read again without loss.
_KEY_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def expiring_dedupe(df: DataFrame, key_cols: list[str], ts_col: str, delay: str, lateness: str,
                    buckets: int = 1 << 10) -> DataFrame:
    """A row passes if no row of its key that passed lies within ``delay`` of it.

    Returns ``key_cols`` and ``ts_col`` (timestamp).  A key's state is the times that
    passed and that a row in time can still meet; it goes when the watermark (the
    latest time less ``lateness``) is ``delay`` beyond the last of them, so the state
    holds recent keys only.  Rows later than the watermark and rows without a time are
    dropped.  Rows of one micro-batch are taken in time order.  Keys share ``buckets``
    states by their hash: what a call of Python costs is paid per bucket, not per key.
    """
    df = df.select(*key_cols, F.col(ts_col).cast("timestamp").alias(ts_col)).where(F.col(ts_col).isNotNull())
    wait = pd.Timedelta(delay).value // 1000
    key_type = T.StructType([df.schema[c] for c in key_cols])

    def passed(_, batches, state):
        held = dict(zip(*state.get, strict=True)) if state.exists else {}
        mark = state.getCurrentWatermarkMs() * 1000
        rows = [] if state.hasTimedOut else sorted(
            row for pdf in batches
            for row in zip(pdf["_key"].tolist(), pdf[ts_col].astype("datetime64[us]").astype("int64").tolist(), strict=True))
        new = []
        for key, t in rows:
            kept = held.setdefault(key, [])
            at = bisect.bisect_left(kept, t - wait)
            if at == len(kept) or kept[at] > t + wait:
                bisect.insort(kept, t)
                new.append((key, t))
        met = {key for key, _ in rows}
        held = {key: [t for t in kept if t + wait >= mark] or kept[-1:] for key, kept in held.items()
                if key in met or kept[-1] + wait >= mark}
        if held:
            state.update((list(held), list(held.values())))
            state.setTimeoutTimestamp(max((min(kept[-1] for kept in held.values()) + wait) // 1000, mark // 1000) + 1)
        elif state.exists:
            state.remove()
        if new:
            yield pd.DataFrame({"_key": [key for key, _ in new], ts_col: pd.to_datetime([t for _, t in new], unit="us")})

    found = df.withWatermark(ts_col, lateness).select(
        F.pmod(F.xxhash64(*key_cols), F.lit(buckets)).cast("int").alias("_bucket"),
        F.to_json(F.struct(*key_cols), _KEY_TEXT).alias("_key"), ts_col).groupBy("_bucket").applyInPandasWithState(
        passed, T.StructType([T.StructField("_key", T.StringType()), T.StructField(ts_col, T.TimestampType())]),
        "keys array<string>, kept array<array<long>>", "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.from_json("_key", key_type, _KEY_TEXT).alias("_key"), ts_col) \
        .select(*[F.col("_key")[c].alias(c) for c in key_cols], ts_col)


def run_available_now(df: DataFrame, root: str | None = None, fmt: str = "parquet",
                      output_mode: str = "append") -> str:
    """Run a streaming frame to completion over what is available; returns the sink path."""
    spark = df.sparkSession
    root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-stream-{uuid.uuid4().hex}"
    q = (df.writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start(f"{root}/out"))
    q.awaitTermination()
    return f"{root}/out"


def answer_stream(queries: DataFrame, collection: DataFrame, root: str | None = None, *,
                  qid: str = "qid", text_col: str = "query", k: int = 4,
                  deterministic_audit: bool = False, extra: dict[str, str] | None = None,
                  cache_collection: bool = False):
    """Z3: answer each micro-batch of queries and append its audit records.

    Returns ``(query_handle, answers_path, audit_path)``.  Output paths carry the
    batch id, so a batch re-run after a failure replaces its own files.  Each
    batch scans the collection; ``cache_collection`` keeps a small one in memory.
    """
    spark = queries.sparkSession
    root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-answers-{uuid.uuid4().hex}"
    if cache_collection:
        collection = collection.cache()

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        out = answer_queries(batch, collection, k=k, qid=qid, text_col=text_col,
                             deterministic_audit=deterministic_audit).cache()
        out.write.mode("overwrite").parquet(f"{root}/answers/batch_id={batch_id}")
        audit_records(out, extra).drop("dt").write.mode("overwrite") \
            .parquet(f"{root}/audit/batch_id={batch_id}")
        out.unpersist()

    q = (queries.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start())
    return q, f"{root}/answers", f"{root}/audit"


def table_stream(spark: SparkSession, sf_dir: str, table: str, max_files: int | None = None) -> DataFrame:
    """A driver table as a file stream (the table's parquet file, or the files of its folder, are the source)."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return r.parquet(path)
    return r.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)
