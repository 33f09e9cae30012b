import numpy as np
import pytest

from quarry.operators.cells import knn_join
from quarry.operators.knn import knn

ROW = "id long, embedding array<double>"


def _frames(spark, q, c):
    return spark.createDataFrame(q, "qid long, qvec array<double>"), spark.createDataFrame(c, ROW)


def _rows(df):
    return sorted((r[0], r[1], r[2], round(r[3], 9)) for r in df.collect())


def _clusters(n, dim, n_centres, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n_centres, dim)) * 20
    return [(i, (centres[i % n_centres] + rng.normal(size=dim) * 0.1).tolist()) for i in range(n)]


@pytest.mark.parametrize("metric", ["l2sq", "cosine"])
def test_far_cells_are_not_read(spark, metric):
    c = _clusters(1200, 8, 12)
    q, cdf = _frames(spark, c, c)
    report = {}
    got = _rows(knn_join(q, cdf, 5, metric=metric, exclude_self=True, n_pivots=120, least_pairs=0, report=report))
    assert got == _rows(knn(q, cdf, 5, metric=metric, exclude_self=True))
    assert report["all_pairs"] == 1200 * 1200 and report["pairs"] < 0.15 * report["all_pairs"]


@pytest.mark.parametrize("metric", ["l2sq", "cosine"])
def test_ties_zero_vectors_repeated_ids_and_a_hot_cell(spark, metric):
    rng = np.random.default_rng(3)
    hot = [1.0, 2.0, 3.0]
    c = [(i % 90, hot) for i in range(200)] + [(500 + i, rng.normal(size=3).round(1).tolist()) for i in range(200)] \
        + [(900 + i, [0.0, 0.0, 0.0]) for i in range(30)]
    q = [(i, v) for i, v in c[::5]] + [(7000, hot), (7001, [0.0, 0.0, 0.0])]
    q = list({i: (i, v) for i, v in q}.values())
    qdf, cdf = _frames(spark, q, c)
    for self_out in (True, False):
        want = _rows(knn(qdf, cdf, 7, metric=metric, exclude_self=self_out))
        for size in (1 << 20, 600):
            assert _rows(knn_join(qdf, cdf, 7, metric=metric, exclude_self=self_out, n_pivots=15, least_pairs=0, block_bytes=size)) == want


def test_vectors_without_clusters_are_searched_block_by_block(spark):
    rng = np.random.default_rng(5)
    flat, near = [(i, rng.normal(size=24).tolist()) for i in range(300)], _clusters(300, 8, 6)
    for rows, size, used in ((flat, 1 << 20, False), (near, 640, True)):
        q, cdf = _frames(spark, rows, rows)
        report = {}
        got = _rows(knn_join(q, cdf, 3, exclude_self=True, least_pairs=1, block_bytes=size, n_pivots=30, report=report))
        assert got == _rows(knn(q, cdf, 3, exclude_self=True)) and bool(report) == used


def test_fewer_rows_than_k_and_odd_inputs(spark):
    c = _clusters(6, 4, 2)
    qdf, cdf = _frames(spark, c, c)
    assert _rows(knn_join(qdf, cdf, 9, exclude_self=True, least_pairs=0)) == _rows(knn(qdf, cdf, 9, exclude_self=True))
    assert knn_join(qdf, cdf.where("id < 0"), 3, least_pairs=0).count() == 0
    mixed = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0]), (2, [1.0]), (3, []), (4, None)], ROW)
    assert [r.id for r in knn_join(qdf.where("qid = 0"), mixed, 3, least_pairs=0).collect()] == [1]
    with pytest.raises(ValueError):
        knn_join(qdf, cdf, 3, metric="dot")


def test_routing_gives_bounded_batches(monkeypatch):
    """The cells of a query batch leave slice by slice, not all rows' cells at once."""
    import pyarrow as pa

    from quarry.operators import cells

    monkeypatch.setattr(cells, "_AT_ONCE", 64)
    rng = np.random.default_rng(2)
    pivots, rows = rng.normal(size=(8, 4)), rng.normal(size=(50, 4))
    summary = np.array([[10.0, 0.0, 9.0]] * 8 + [[0.0, 0.0, -1.0]])
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(rows.tolist()), pa.array([9.0] * 50)], ["qid", "qvec", "bound"])
    out = list(cells._route(pivots, summary, "l2sq", 3)(iter([batch])))
    assert [b.num_rows for b in out] == [8] * 6 + [2]
    assert [q for b in out for q in b.column(0).to_pylist()] == list(range(50))
    near = np.argmin(((rows[:, None] - pivots[None]) ** 2).sum(axis=2), axis=1)
    assert [sorted(c) for b in out for c in b.column(2).to_pylist()] == [sorted(set(range(8)) - {n}) for n in near.tolist()]


@pytest.mark.parametrize("metric", ["l2sq", "cosine"])
def test_a_query_travels_once_per_group_of_cells(spark, monkeypatch, metric):
    """Vectors without clusters leave nearly all of 80 cells open; a query goes to a few groups of them."""
    from pyspark.sql import functions as F

    from quarry.operators import cells

    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(600)]
    q, cdf = _frames(spark, rows, rows)
    travelled, meet = [], cells._meet

    def counted(queries, corpus, groups, *rest):
        travelled.append((queries.select(F.explode("to")).count(), len(groups)))
        return meet(queries, corpus, groups, *rest)

    monkeypatch.setattr(cells, "_meet", counted)
    report = {}
    got = _rows(knn_join(q, cdf, 4, metric=metric, exclude_self=True, n_pivots=80, least_pairs=0, block_bytes=150 * 8 * 16, report=report))
    assert got == _rows(knn(q, cdf, 4, metric=metric, exclude_self=True))
    assert report["copies"] > 40 and all(n <= 600 * g and g <= 8 for n, g in travelled)


def test_groups_hold_neighbours_and_large_cells_stand_alone():
    from quarry.operators.cells import _groups

    pivots = np.array([[0.0, 0.0], [9.0, 0.0], [0.1, 0.0], [9.1, 0.0], [5.0, 0.0]])
    groups = _groups(pivots, {0: 10, 1: 10, 2: 10, 3: 10, 4: 500}, 20)
    assert sorted(map(sorted, groups)) == [[0, 2], [1, 3], [4]]
    assert _groups(pivots, {1: 3, 5: 2}, 100) == [[1, 5]]
