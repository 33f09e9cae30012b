import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators.knn import knn


def _brute(q, c, k, metric="cosine", exclude_self=False):
    out = []
    for qi, qv in q:
        rows = []
        for ci, cv in c:
            if exclude_self and ci == qi:
                continue
            a, b = np.asarray(qv, float), np.asarray(cv, float)
            if metric == "cosine":
                na, nb = np.linalg.norm(a), np.linalg.norm(b)
                s = 0.0 if na == 0 or nb == 0 else float(a @ b / (na * nb))
                rows.append((-s, ci, s))
            else:
                d = float(((a - b) ** 2).sum())
                rows.append((d, ci, d))
        rows.sort()
        out += [(qi, r + 1, ci, round(v, 9)) for r, (_, ci, v) in enumerate(rows[:k])]
    return sorted(out)


def _run(spark, q, c, k, **kw):
    qdf = spark.createDataFrame(q, "qid long, qvec array<double>")
    cdf = spark.createDataFrame(c, "id long, embedding array<double>")
    res = knn(qdf, cdf, k, **kw).collect()
    return sorted((r[0], r[1], r[2], round(r[3], 9)) for r in res)


@settings(max_examples=8, deadline=None)
@given(st.integers(1, 6), st.integers(1, 40), st.integers(0, 10_000))
def test_topk_equals_brute_force(spark, k, n, seed):
    rng = np.random.default_rng(seed)
    c = [(i, rng.normal(size=4).round(1).tolist()) for i in range(n)]  # rounding makes ties
    q = [(i, rng.normal(size=4).round(1).tolist()) for i in range(3)]
    assert _run(spark, q, c, k) == _brute(q, c, k)


def test_many_blocks_equal_one(spark):
    rng = np.random.default_rng(1)
    c = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    q = [(i, rng.normal(size=8).tolist()) for i in range(0, 300, 7)]
    a = _run(spark, q, c, 5, exclude_self=True)
    b = _run(spark, q, c, 5, exclude_self=True, block_bytes=512)
    assert a == b == _brute(q, c, 5, exclude_self=True)


def test_l2sq_ranks_by_distance(spark):
    c = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [3.0, 0.0])]
    q = [(9, [0.9, 0.0])]
    got = _run(spark, q, c, 2, metric="l2sq")
    assert [g[2] for g in got] == [2, 1]
    assert got == _brute(q, c, 2, metric="l2sq")


def test_zero_vector_scores_zero(spark):
    got = _run(spark, [(1, [0.0, 0.0])], [(5, [1.0, 2.0])], 1)
    assert got == [(1, 1, 5, 0.0)]


def test_plan_prunes_before_shuffle(spark):
    c = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "id long, embedding array<double>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "qid long, qvec array<double>")
    plan = knn(q, c, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "Window" in plan
    assert "FlatMapCoGroupsInArrow" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_search_sees_ids_and_vectors_only(spark):
    from quarry.operators.answers import store_search

    rng = np.random.default_rng(3)
    c = [(f"d{i}", rng.normal(size=6).tolist(), f"title {i}", "long text " * 50, "a", "u", "v") for i in range(120)]
    cdf = spark.createDataFrame(c, "id string, embedding array<double>, title string, description string, agency string, api_url string, url string")
    q = spark.createDataFrame([(f"d{i}", rng.normal(size=6).tolist()) for i in range(9)], "qid string, qvec array<double>")
    found = store_search(q, cdf, 4)
    assert all(r.title == f"title {r.id[1:]}" and r.description for r in found.collect())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("FlatMapCoGroupsInArrow"):]
    assert "description" not in below.split("LogicalRDD")[0]


def test_pairs_have_one_score_and_blocks_are_bounded(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=5).tolist()
    c = [(i, v) for i in range(900)] + [(1000 + i, rng.normal(size=5).tolist()) for i in range(300)]  # many ties
    q = [(-1, v), (-2, rng.normal(size=5).tolist())]
    for metric in ("l2sq", "cosine"):
        one, many = (_run(spark, q, c, 7, metric=metric, block_bytes=b) for b in (1 << 25, 2000))
        assert one == many and [g[2] for g in one if g[0] == -1] == list(range(7))


def test_string_ids_block_path(spark):
    rng = np.random.default_rng(5)
    c = [(f"d{i}", rng.normal(size=4).tolist()) for i in range(60)]
    q = [(f"d{i}", v) for i, v in c[:13]]
    qdf = spark.createDataFrame(q, "qid string, qvec array<double>")
    cdf = spark.createDataFrame(c, "id string, embedding array<double>")
    a = sorted(map(tuple, knn(qdf, cdf, 3, exclude_self=True).collect()))
    b = sorted(map(tuple, knn(qdf, cdf, 3, exclude_self=True, block_bytes=200).collect()))
    assert [x[:3] for x in a] == [x[:3] for x in b]


def test_ann_probing_all_lists_is_exact(spark):
    from quarry.operators import ann

    rng = np.random.default_rng(11)
    c = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(400)], "id long, embedding array<double>")
    q = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(25)], "qid long, qvec array<double>")
    cents, assigned = ann.build_index(c, 6)
    approx = ann.search(q, cents, assigned, 5, nprobe=6, block_rows=30)
    exact = knn(q, c, 5)
    norm = lambda df: sorted((r["qid"], r["rank"], r["id"], round(r["score"], 9)) for r in df.collect())
    assert norm(approx) == norm(exact)
    low = ann.search(q, cents, assigned, 5, nprobe=1)
    rec = ann.recall(low, exact).agg({"recall": "avg"}).first()[0]
    assert 0.0 < rec <= 1.0


@pytest.mark.parametrize("metric", ["cosine", "l2sq"])
def test_later_rows_replace_earlier_ones(monkeypatch, metric):
    """Only rows that may reach the k-th best are looked at again; ties go to the smaller id wherever it stands."""
    from quarry.operators import knn as module

    monkeypatch.setattr(module, "_ROWS", 7)
    monkeypatch.setattr(module, "_QUERIES", 3)
    looked = []
    exact = module._exact
    monkeypatch.setattr(module, "_exact", lambda c, q, m: looked.append(len(c)) or exact(c, q, m))
    rng = np.random.default_rng(4)
    c = rng.integers(-3, 4, (200, 3)).astype(float)
    c[100:] = c[:100]  # every vector twice, the smaller id behind
    ids = list(range(200, 0, -1))
    got = list(module.best_rows([1, 50, 150, 999], c[[199, 150, 50, 0]], ids, c, 5, metric, True))
    want = []
    for qid, q in zip([1, 50, 150, 999], c[[199, 150, 50, 0]]):
        v = exact(module.prepared(c, metric), module.prepared(q[None], metric)[0], metric)
        want += [(qid, i, x) for x, i in sorted([(-a, i) for a, i in zip(v, ids) if i != qid])[:5]]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert len(looked) < 4 * (200 // 7)


@pytest.mark.parametrize("metric", ["cosine", "l2sq", "dot"])
def test_preselection_in_single_precision_keeps_close_calls(metric):
    """Far from the origin single precision does not tell neighbours apart; tiny and huge vectors are beyond it."""
    from quarry.operators.knn import best_rows

    rng = np.random.default_rng(4)
    for shift, scale in ((0, 1), (1000, 1e-3), (0, 1e-25), (0, 1e25)):
        c, q = (shift + rng.normal(size=(n, 8)) * scale for n in (6000, 300))
        a, b = (c, q) if metric != "cosine" else (x / np.sqrt((x * x).sum(axis=1, keepdims=True)) for x in (c, q))
        got = {}
        for j, i, v in best_rows(list(range(300)), q, list(range(6000)), c, 3, metric, True):
            got.setdefault(j, []).append((i, v))
        for j in range(0, 300, 29):
            v = -((a - b[j]) ** 2).sum(axis=1) if metric == "l2sq" else (a * b[j]).sum(axis=1)
            v[j] = -np.inf
            want = sorted(range(6000), key=lambda i: (-v[i], i))[:3]
            assert got[j] == [(i, v[i]) for i in want]
