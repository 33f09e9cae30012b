from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir, read_table, spread

SF = "/root/testdata/sf0.001"


def test_spread_runs_no_job(spark):
    sc = spark.sparkContext
    docs = read_table(spark, SF, "documents")
    joined = docs.join(read_table(spark, SF, "embeddings"), F.col("doc_id") == F.col("vec_id"))
    sc.setJobGroup("spread-check", "spread must not execute plans")
    try:
        a = spread(joined)
        b = spread(docs)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert sc.statusTracker().getJobIdsForGroup("spread-check") == []
    assert b.rdd.getNumPartitions() >= sc.defaultParallelism   # small single-file scan gets spread
    assert a is not None


def test_checkpoint_dir_is_kept(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == before


def test_bucketed_table_prunes_partitions(spark):
    from quarry.operators.crawl import _present_buckets, _prune
    from quarry.session import bucket, materialize

    edges = spark.createDataFrame([(f"u{i % 50}", i, f"v{i}") for i in range(500)], "src string, pos long, dst string")
    table = materialize(edges, "src", 16)
    frontier = spark.createDataFrame([("u3",), ("u7",)], "url string").withColumn("_b", bucket("url", 16))
    present = _present_buckets(frontier, 2, 16)
    assert present and len(present) <= 2
    pruned = _prune(table, present)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_b" in plan.split("PartitionFilters: [")[1].split("]")[0]
    got = pruned.join(frontier.withColumnRenamed("url", "src"), ["_b", "src"]).count()
    assert got == 20                                         # every edge of u3 and u7, nothing else read


def test_empty_table_is_counted(spark):
    """A plan that Spark finds to be empty has no node left that could be observed."""
    from quarry.session import materialize

    counted = []
    for rows in (spark.range(3).where(F.lit(False)), spark.range(3)):
        table = materialize(rows, "id", 4, counter=counted)
        assert table.count() == counted[-1]
    assert counted == [0, 3]
