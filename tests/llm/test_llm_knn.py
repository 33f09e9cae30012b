import duckdb
import numpy as np
import pytest

from quarry.llm import voronoi_knn
from quarry.llm.queries import KNN_SQL

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cell int"


def brute(rows, k=20, every=20):
    good = [(i, np.floor(64 * np.array(v, dtype=np.float64)).astype(int)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in good:
        if q % every == 0:
            ranked = sorted((-int(x @ y), i) for i, y in good if i != q and len(x) == len(y))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(ranked, 1)]
    return sorted(out)


def run(spark, rows, k=20):
    df = spark.createDataFrame([(i, v, 0, "z", 1) for i, v in rows], SCHEMA).repartition(3)
    vectors = voronoi_knn.quantised(df)
    return sorted(tuple(r) for r in voronoi_knn.knn_join(vectors.where("vec_id % 20 = 0"), vectors, k).collect())


@pytest.mark.parametrize("blocks", [(1024, 8192), (3, 17)])
def test_against_brute_force_with_ties_and_bad_rows(spark, monkeypatch, blocks):
    monkeypatch.setattr(voronoi_knn, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(voronoi_knn, "DATA_BLOCK", blocks[1])
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(4, 6))
    rows = [(i, [float(x) for x in np.round(centres[i % 4] + rnd.normal(size=6) * 0.1, 1).astype(np.float32)]) for i in range(300)]
    rows += [(1000, None), (1001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1020, [float("nan")] * 6), (1040, [float("inf")] * 6), (None, [1.0] * 6),
             (1060, [1.0, 2.0]), (1061, [2.0, 1.0]), (1080, [1.0, 1.0, 1.0])]
    rows += [rows[20], rows[21]] + [rows[5]] * 30  # repeated rows
    assert run(spark, rows) == brute(rows)


def test_bounds_leave_out_far_cells_and_lose_nothing(spark):
    rnd = np.random.default_rng(4)
    far = [(i, [float(x) for x in (np.array([10.0, 0]) if i % 2 else np.array([-10.0, 0])) + rnd.normal(size=2) * 0.01]) for i in range(200)]
    assert run(spark, far, 5) == brute(far, 5)
    pivots = {2: np.array([[640.0, 0], [-640.0, 0]])}
    sums = {(2, 0): (100, 5.0), (2, 1): (100, 5.0)}
    assert sorted(voronoi_knn._needed(sums, sums, pivots, 5)) == [(2, 0, 0), (2, 1, 1)]


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    assert run(spark, rows) == [(0, 1, 1, 96 * 64), (0, 2, 2, 96 * 64)] == brute(rows)
    assert run(spark, [(20, [1.0])]) == []
    assert run(spark, [(1, None)]) == []


def test_repeated_rows_are_candidates_of_their_own(spark, monkeypatch, tmp_path):
    """As the SQL has it, also where the copies lie in several blocks."""
    monkeypatch.setattr(voronoi_knn, "DATA_BLOCK", 7)
    monkeypatch.setattr(voronoi_knn, "_pivots", lambda vectors, rows: {2: np.array([[640.0, 0], [-640.0, 0]])})
    rows = [(20, [10.0, 0.5])] * 2 + [(3, [10.0, 0.0])] * 9 + [(4, [10.0, 0.0])] * 2 + [(i, [-10.0, i / 8]) for i in range(21, 110)]
    got = run(spark, rows)
    assert got == brute(rows) and len([r for r in got if r[0] == 20]) == 40
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "e"))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet'")
        assert sorted(db.sql(KNN_SQL).project("query_id, rank, vec_id, score").fetchall()) == got


@pytest.mark.parametrize("copies", [100, 400])
def test_a_repeated_id_of_the_query_does_not_hide_far_cells(spark, monkeypatch, copies):
    """The nearest cell holds rows of the query's own id, so the k best come from the far one."""
    monkeypatch.setattr(voronoi_knn, "_pivots", lambda vectors, rows: {2: np.array([[640.0, 0], [-640.0, 0]])})
    rows = [(20, [10.0, 0.5])] * copies + [(5, [10.0, 0.0])] * 2 + [(100 * i + 1, [-10.0, i / 100]) for i in range(1, 101)]
    assert run(spark, rows, 5) == brute(rows, 5)
