"""The stored inverted-file index: recall, segments, pruning, hot lists."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import ann
from quarry.operators.knn import knn
from quarry.session import scratch_path


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "id long, embedding array<double>")


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_mean_recall_of_every_vector_as_a_query(spark, sf):
    e = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    path = scratch_path(spark, "ann-test")
    ann.write_index(e.where("id % 3 > 0"), path)
    ann.append(e.where("id % 3 = 0"), path, "second")
    assert ann.read_lists(spark, path).count() == e.count()
    q = e.select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    found = ann.search_index(q, path, 5, ann.calibrate(spark, path, 5), exclude_self=True)
    rates = ann.recall(found, knn(q, e, 5, exclude_self=True))
    assert rates.agg({"recall": "avg"}).first()[0] >= 0.9


def test_clusters_need_few_probes_and_read_only_their_folders(spark):
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(20, 16)) * 10
    rows = np.vstack([c + rnd.normal(size=(50, 16)) * 0.1 for c in centres])
    e = _vectors(spark, rows)
    path = scratch_path(spark, "ann-test")
    ann.write_index(e, path, 20)
    probes = ann.calibrate(spark, path, 5)
    assert probes <= 4
    q = e.where("id < 50").select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    found = ann.search_index(q, path, 5, probes, exclude_self=True)
    assert ann.recall(found, knn(q, e, 5, exclude_self=True)).agg({"recall": "min"}).first()[0] > 0.7
    lists = ann.read_lists(spark, path, [1, 2])
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*list_id#\d+ IN \(1,2\)", plan), plan


def test_segment_written_again_replaces_itself(spark):
    e = _vectors(spark, np.random.default_rng(3).normal(size=(60, 8)))
    path = scratch_path(spark, "ann-test")
    ann.write_index(e.where("id < 40"), path, 3)
    for _ in range(2):
        ann.append(e.where("id >= 40"), path, "late")
    assert ann.read_lists(spark, path).count() == 60
    nulls = spark.createDataFrame([(99, None), (98, [])], "id long, embedding array<double>")
    ann.append(nulls, path, "nothing")
    assert ann.read_lists(spark, path).count() == 60


def test_a_query_travels_once_per_group_of_lists(spark, monkeypatch):
    """Probing every list finds every neighbour; a query goes to a few groups of lists, not to each."""
    e = _vectors(spark, np.random.default_rng(6).normal(size=(700, 8)))
    q = e.select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    cents, assigned = ann.build_index(e, 60)
    travelled, meet = [], ann._meet

    def counted(queries, corpus, groups, *rest):
        travelled.append((queries.select(F.explode("to")).count(), len(groups)))
        return meet(queries, corpus, groups, *rest)

    monkeypatch.setattr(ann, "_meet", counted)
    rows = lambda df: sorted((r[0], r[1], r[2], round(r[3], 9)) for r in df.collect())
    found = ann.search(q, cents, assigned, 3, nprobe=60, exclude_self=True, block_rows=250)
    assert rows(found) == rows(knn(q, e, 3, exclude_self=True))
    assert travelled == [(700 * travelled[0][1], travelled[0][1])] and travelled[0][1] <= 5
    some = ann.search(q.unionByName(spark.createDataFrame([(-1, None)], q.schema)), cents, assigned, 3, nprobe=5, exclude_self=True)
    assert 0.5 < ann.recall(some, knn(q, e, 3, exclude_self=True)).agg({"recall": "avg"}).first()[0] < 1
