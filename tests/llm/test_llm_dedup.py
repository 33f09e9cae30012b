import random
import tracemalloc

import numpy as np
import pyarrow as pa
from llm_cases import SF, classes, documents, edge_docs, empty_docs, lines_without_repeats

from quarry.llm import line_dedup, minhash_dedup, queries
from quarry.llm.components import components


def test_components_of_chains_stars_and_cycles(spark):
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(100, 140)] + [(200, 200 + i) for i in range(1, 30)] + [(300, 301), (301, 302), (302, 300)]
    links += [(rnd.randint(400, 460), rnd.randint(400, 460)) for _ in range(50)]
    root = {x: x for e in links for x in e}
    for _ in range(100):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: r for x, r in root.items() if x != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_against_all_pairs(spark):
    docs = documents()
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in queries.QUERIES["op7_minhash_dedup"](spark, SF).collect()}
    assert got == {(d, n, c, d == c) for d, n, c in classes(list(zip(docs.doc_id, docs.text, strict=True)), 4)}


def test_large_bucket_of_near_copies(spark):
    """Many different near copies of one text, chains of near copies, and an outsider sharing half."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(60)] = f"x{rnd.randrange(1000)}"
        rows.append((1000 + i, " ".join(w)))
    chain = [f"c{i}" for i in range(50)]
    for i in range(12):  # each link changes one end a little: neighbours are linked, the ends are not
        rows.append((2000 + i, " ".join(chain[i:] + [f"d{j}" for j in range(i)])))
    rows += [(3000, " ".join(base[:30] + [f"y{i}" for i in range(30)])), (3001, "Hello  World"), (3002, "hello world")]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for width in (4, 5):
        got = {(r.doc_id, r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(df, width).collect()}
        assert got == set(classes(rows, width))


def test_near_duplicates_edge_rows(spark):
    got = sorted(((r.doc_id or -1, r.component_id, r.n_shingles, r.kept) for r in
                  minhash_dedup.near_duplicates(edge_docs(spark), 4).collect()), key=str)
    by = {g[0]: g[1:] for g in got}
    assert len(got) == 12
    assert by[1] == (1, 0, True) and by[2] == (2, 0, True) and by[3] == (3, 0, True)
    assert by[5] == (4, 12, False) and by[4] == (4, 12, True)
    assert by[-1][0] is None and by[-1][2] is True
    assert by[10] == (10, 1, True)
    assert minhash_dedup.near_duplicates(empty_docs(spark)).count() == 0


def test_lines_against_brute_force(spark):
    rnd = random.Random(4)
    base = ["".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(20, 60))).strip() or "x" for _ in range(30)]

    def changed(s):
        i, how = rnd.randrange(len(s)), rnd.random()
        return s[:i] + (rnd.choice("xyzü") if how < 0.6 else "") + s[i + (how < 0.3 or how >= 0.6):]

    docs = []
    for d in range(60):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            s = rnd.choice(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                s = changed(s)
            lines.append(rnd.choice(["", "  ", "\t"]) + s + rnd.choice(["", " ", "\r"]))
        docs.append((d, "\n".join(lines)))
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in
           line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert got == lines_without_repeats(docs)


def test_all_one_edit_pairs_are_found(spark):
    """Edits at every place of a line, over the lengths where block borders move."""
    rnd = random.Random(6)
    docs, d = [], 0
    for n in (24, 31, 32, 33, 47, 48, 49, 64):
        s = "".join(rnd.choice("abcdefgh") for _ in range(n))
        docs.append((d, s))
        d += 1
        for i in range(n):
            docs.append((d, s[:i] + "Z" + s[i + 1:]))
            docs.append((d + 1, s[:i] + "Y" + s[i:]))
            d += 2
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {k: v[1] for k, v in lines_without_repeats(docs).items()}


def test_line_dedup_edge_rows(spark):
    out = line_dedup.dedup_lines(edge_docs(spark)).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert len(out) == 12
    assert by[1][0].text is None and by[1][0].n_lines == 0
    assert by[2][0].text == "" and by[3][0].text == " \n\t "
    assert by[4][0].n_dropped == 0 and [r.n_dropped for r in by[5]] == [1, 1]
    assert by[6][0].n_dropped == 1 and by[8][0].text == "a\nb"
    assert by[None][0].n_dropped == 0
    assert by[9][0].text == "é" * 40
    assert line_dedup.dedup_lines(empty_docs(spark)).count() == 0


def test_cleaned_rows_keep_the_columns(spark):
    docs = edge_docs(spark).withColumn("n_chars", __import__("pyspark.sql.functions", fromlist=["length"]).length("text").cast("long"))
    out = line_dedup.without_repeated_lines(docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert 5 not in rows and 6 not in rows and 2 in rows and 3 in rows
    assert rows[8].text == "a\nb" and rows[8].n_chars == 3 and rows[8].h1 == "z"


def test_long_documents_one_shingle_under_the_bound_are_not_linked():
    """100 * 207539 = 83 * 250047 - 1: as 32-bit floats the two sides are equal."""
    both, union = 207_539, 250_047
    one, other = np.arange(both), np.arange(union)

    def table(node, values):
        return pa.table({"node": [node], "c": [node], "set": pa.array([values], pa.list_(pa.int64()))})

    assert minhash_dedup._block_links(83)(table(1, one), table(2, other)).num_rows == 0
    assert minhash_dedup._block_links(82)(table(1, one), table(2, other)).num_rows == 1


def test_lines_are_hashed_in_small_slices():
    """Texts are hashed piece by piece: memory stays far below that of a whole batch."""
    class Taken:
        def mapInArrow(self, fn, schema):
            return fn

    line = "some words of a line that is long enough "
    texts = ["\n".join(f"{line}{d} {i}" for i in range(60)) for d in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    run = line_dedup._hashed(Taken())
    list(run(iter([batch.slice(0, 9)])))  # tables of powers are made once
    tracemalloc.start()
    rows = sum(b.num_rows for b in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 500 * 60 and peak < 50 << 20
