"""Session helpers: building a session for tests/bench and reading tables."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "quarry") -> SparkSession:
    """A session tuned for local runs; on a cluster use the cluster's own session."""
    master = master or os.environ.get("QUARRY_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEM", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` wins; only when it is unset and the
    master is local (tests) a scratch folder is made and registered.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-ckpt-"))
    else:  # a folder of the driver's machine is not seen by the executors
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return sc.getCheckpointDir()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    for t in TABLES:
        read_table(spark, sf_dir, t).createOrReplaceTempView(t)


SPREAD_MAX_BYTES_PER_CORE = 64 * 1024 * 1024


def _input_bytes(spark: SparkSession, files: list[str]) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for f in files:
        p = jvm.org.apache.hadoop.fs.Path(f)
        total += p.getFileSystem(conf).getFileStatus(p).getLen()
    return total


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per core before a CPU-heavy per-row stage.

    Decided from the input files only (nothing is executed): when the frame
    reads fewer files than there are cores and little data in total, a small
    file would otherwise run the whole stage as one task, and a round-robin
    repartition of little data is cheap.  Large inputs already arrive in many
    splits and are left alone.  A stream's files are not known yet: every
    micro-batch, which may be a single file, is spread.
    """
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    if df.isStreaming:
        return df.repartition(target)
    files = df.inputFiles()
    if not files or len(files) >= target:
        return df
    if _input_bytes(spark, files) > target * SPREAD_MAX_BYTES_PER_CORE:
        return df
    return df.repartition(target)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable on the executors (UDFs refer to its functions).

    Zips the package sources once per application and hands the zip to
    ``SparkContext.addPyFile``, which copies it to every executor's path.
    """
    import zipfile

    import quarry

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(quarry.__file__))
    base = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="quarry-pkg-"), "quarry.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str = "quarry") -> str:
    """A new path in the checkpoint folder; what is written there is deleted when Python exits."""
    import uuid

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_drop_scratch)
    _SCRATCH.append((spark, path))
    return path


_SCRATCH: list[tuple[SparkSession, str]] = []


def _drop_scratch() -> None:
    """Delete the scratch tables of sessions that are still running."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session has ended; its cluster cleans the folder
            return


def materialize(df: DataFrame, bucket_of: str | None = None, buckets: int = 0,
                counter: list | None = None, path: str | None = None) -> DataFrame:
    """Cut lineage: write to the shared checkpoint folder and read back.

    One job per write (a reliable ``checkpoint()`` computes the plan twice);
    the read-back is file-based, so a lost executor re-reads files instead of
    replaying the crawl.  With ``bucket_of`` the table is laid out in
    ``_b = hash(col) mod buckets`` folders, so a join on ``(_b, col)`` with a
    small frontier reads only the folders of the frontier's urls (dynamic
    partition pruning).  With ``counter`` the row count of the written files is
    appended to it (an ``observe`` has no result when the plan turns out empty).
    """
    spark = df.sparkSession
    path = path or scratch_path(spark)
    if bucket_of is not None:
        df = df.withColumn("_b", bucket(bucket_of, buckets))
        df.repartition("_b").write.partitionBy("_b").parquet(path)
    else:
        df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)  # an empty bucketed table has no files to infer from
    if counter is not None:
        counter.append(written.count())
    return written


def bucket(col: str, buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).cast("int")
