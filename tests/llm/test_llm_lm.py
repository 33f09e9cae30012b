"""Context-mixing scores: base against counting, the coder against a bit-by-bit version, held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quarry.llm import context_mixing as cm
from quarry.llm import lm_score, texthash
from llm_cases import documents, edge_docs, empty_docs


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def crc(d):
    return zlib.crc32(("" if d is None else str(d)).encode())


def base(rows):
    counts, end = Counter(), ("end",)
    for d, t in rows:
        if crc(d) % 7 != 2:
            counts.update(words(t) + [end])
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        toks = words(t) + [end]
        out.append((d, crc(d) % 7 == 2, len(toks), sum(counts[w] > 0 for w in toks), n,
                    sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in toks)))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 5))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5])) for g, w in zip(got, want))


@pytest.fixture(scope="module")
def scored(spark):
    pdf = documents("/root/testdata/sf0.01")
    df = spark.createDataFrame(pdf[["doc_id", "text"]])
    return pdf, lm_score.score(df, lm_score.train(df)).collect()


def test_base_scores(scored):
    pdf, rows = scored
    same([tuple(r)[:6] for r in rows], base(list(zip(pdf.doc_id, pdf.text))))
    assert all(r.score < 0 for r in rows)


def test_held_out_texts_score_above_the_base(spark):
    """On 10 000 documents (3.4 million tokens) the held-out ones gain on the add-one unigrams."""
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = lm_score.score(df, lm_score.train(df)).where("held_out").agg({"score": "sum", "base_score": "sum", "*": "count"}).first()
    assert held["count(1)"] > 1000 and held["sum(score)"] > 0.96 * held["sum(base_score)"]


def test_scores_do_not_depend_on_partitions(spark, scored):
    pdf, rows = scored
    df = spark.createDataFrame(pdf[["doc_id", "text"]]).repartition(13, "doc_id")
    again = {r.doc_id: r.score for r in lm_score.score(df, lm_score.train(df)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-4 * abs(r.score) for r in rows)


def small_model(seed=1):
    rng = np.random.default_rng(seed)
    lex = cm.Lexicon(["the", "of", "ab"], [50, 20, 5], 30, 10, rng.integers(0, 50, 256))
    return lex, rng.integers(-60, 60, (cm.CONTEXTS, 1 << 14)).astype(np.int8), rng.random((cm.GATES, cm.CONTEXTS)) * 0.4


def bitwise(weights, model, lex, bits, s, text):
    """Log-probability with one decision after the other."""
    total = 0.0
    for lane in range(int(s.first[text]), int(s.first[text + 1]), cm.LANE):
        change, grad, turn = np.zeros(cm.CONTEXTS), np.zeros(cm.CONTEXTS), 0
        for j in range(lane, min(lane + cm.LANE, int(s.first[text + 1]))):
            for k in range(lex.length[s.sym[j]]):
                p = lex.first[s.sym[j]] + k
                x = np.array([model[i][(int(s.base[i, j]) + int(lex.mixed[p])) & ((1 << bits) - 1)] for i in range(cm.CONTEXTS)], dtype=float)
                sure = [int(v != 0) + int(v > 25) + int(v < -25) for v in x[1:]]
                z = (weights[lex.gate[p] + sure[0] * 3 + sure[1]] + change) @ x / cm.SCALE
                y = 2 * int(lex.bit[p]) - 1
                z = min(max(z * y, -11), 11)
                total -= math.log1p(math.exp(-z))
                grad += x * y * math.exp(-z) / (1 + math.exp(-z))
                turn += 1
                if turn == cm.TURN:
                    change, grad, turn = change + cm.RATE * grad, grad * 0, 0
    return total


def test_lanes_in_step_equal_one_bit_after_the_other(monkeypatch):
    monkeypatch.setattr(cm, "LANE", 70)
    monkeypatch.setattr(cm, "PART", 33)
    monkeypatch.setattr(cm, "BLOCK", 200)
    lex, model, weights = small_model()
    texts = ["the of ab the xyz", "", "The quick brown fox " * 30, None, "of", "ä" * 40 + " the"]
    import pyarrow as pa
    data, offsets = texthash.text_buffer(pa.array(texts))
    s = cm.symbols(lex, data, offsets)
    got = cm.log_probability(weights, model, lex, 14, s)
    # corrections are kept in units of the stored log-odds
    want = [bitwise(weights, model, lex, 14, s, i) for i in range(len(texts))]
    assert np.allclose(got, want, rtol=2e-3), (got, want)


def test_symbols_spell_the_text():
    """Every text is given back by its symbols, and the codes are complete prefix codes."""
    import pyarrow as pa
    lex, _, _ = small_model()
    texts = ["The ab  zz\tof", "", None, "q", "of the"]
    data, offsets = texthash.text_buffer(pa.array(texts))
    s = cm.symbols(lex, data, offsets)
    for i, t in enumerate(texts):
        out, spell = [], None
        for x in s.sym[s.first[i]:s.first[i + 1]]:
            if x == lex.escape:
                spell = b""
            elif x >= lex.bytes:
                if x - lex.bytes == cm.BLANK:
                    out.append(spell.decode())
                else:
                    spell += bytes([x - lex.bytes])
            elif x < lex.escape:
                out.append(lex.words[int(x)].as_py())
        assert out == words(t) and s.sym[s.first[i + 1] - 1] == lex.end
    for part in (slice(0, lex.bytes), slice(lex.bytes, None)):
        assert sum(2.0 ** -n for n in lex.length[part]) == 1


def test_edges(spark):
    docs = edge_docs(spark)
    got = [tuple(r)[:6] for r in lm_score.score(docs, lm_score.train(docs)).collect()]
    same(got, base([(r.doc_id, r.text) for r in docs.collect()]))
    none = empty_docs(spark)
    assert lm_score.score(none, lm_score.train(none)).count() == 0
    held = spark.createDataFrame([(d, "a b") for d in range(50) if crc(d) % 7 == 2], "doc_id long, text string")
    assert {(r.train_tokens, r.n_known, r.base_score) for r in lm_score.score(held, lm_score.train(held)).collect()} == {(0, 0, 0.0)}


def test_every_learning_text_is_counted_and_fits_the_weights(spark, monkeypatch):
    """The texts of each half of the folds are read by counting once and by every Newton step."""
    seen = []
    keep = lm_score.tables.keep

    def kept(df, name):
        seen.append(name)
        return keep(df, name)

    monkeypatch.setattr(lm_score.tables, "keep", kept)
    monkeypatch.setattr(lm_score, "STEPS", 1)
    gates = []
    newton = cm.newton
    monkeypatch.setattr(cm, "newton", lambda w, sums: gates.append(sums.copy()) or newton(w, sums))
    ids = [d for d in range(400) if crc(d) % 49 == 6]  # the former fitting texts alone
    df = spark.createDataFrame([(d, "one two one two three") for d in ids], "doc_id long, text string")
    both = spark.createDataFrame([(d, "one two one two three") for d in range(400) if crc(d) % 7 != 2], "doc_id long, text string")
    only, all_ = lm_score.train(df), lm_score.train(both)
    assert seen.count("counts") == 2 * lm_score.HALVES
    assert np.abs(only.shared.value[1]).max() > 0  # they are counted
    assert np.abs(gates[1]).sum() > 20 * np.abs(gates[0]).sum()  # and so are all others fitted on
    assert all_.tokens == 6 * both.count()


def test_tables_are_added_a_block_at_a_time():
    """A batch of packed blocks is not copied into Python as a whole; its sums are those of numpy."""
    import tracemalloc

    import pyarrow as pa

    counts = np.random.default_rng(3).integers(0, 1 << 60, (60, 2 * lm_score.BLOCK_SLOTS), dtype=np.uint64)
    rows = [(0, i // 20, 0, lm_score._pack(c)) for i, c in enumerate(counts)]  # 15 MB that no packing shortens
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
        pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["context", "block", "team", "counts"])
    del rows
    tracemalloc.start()
    got = {b[1][0].as_py(): lm_score._unpack(b[3][0].as_buffer()).copy() for b in lm_score._add_counts(iter([batch]))}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 << 20
    assert all((got[k] == counts[20 * k:20 * k + 20].sum(axis=0)).all() for k in range(3)) and len(got) == 3


def test_tables_are_added_and_turned_into_odds_in_one_process(spark):
    """A task of the last sum has one Python process, not a second one for the log-odds."""
    rows = [(0, 0, t, lm_score._pack(np.arange(2 * lm_score.BLOCK_SLOTS, dtype=np.uint64))) for t in range(3)]
    added = lm_score._sum_tables(spark.createDataFrame(rows, lm_score.COUNTS), lm_score._block_odds)
    assert added._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2
    want = cm.odds(3 * np.arange(2 * lm_score.BLOCK_SLOTS, dtype=np.uint64)).tobytes()
    assert [(r.context, r.block, r.counts) for r in added.collect()] == [(0, 0, want)]


def test_outcomes_count_and_fit_like_one_decision_after_the_other(monkeypatch):
    """Distinct outcomes with their numbers give the statistics of all decisions, however slices are merged; so do counts."""
    import pyarrow as pa
    monkeypatch.setattr(cm, "PART", 33)
    lex, model, weights = small_model()
    texts = ["the of ab the xyz", "", "the of the of " * 40, None, "ä" * 40 + " the xyz"]
    data, offsets = texthash.text_buffer(pa.array(texts))
    s = cm.symbols(lex, data, offsets)
    table, want = np.zeros((cm.CONTEXTS, 2 << 14), np.uint32), np.zeros((cm.CONTEXTS, 2 << 14), np.uint32)
    sums, decisions = np.zeros((cm.GATES, cm.CONTEXTS + cm.CONTEXTS ** 2)), 0
    for j, y in enumerate(s.sym):
        for k in range(lex.length[y]):
            p = lex.first[y] + k
            slot = [(int(b) + int(lex.mixed[p])) & ((1 << 14) - 1) for b in s.base[:, j]]
            x = np.array([model[i][slot[i]] for i in range(cm.CONTEXTS)], dtype=float) / cm.SCALE
            sure = [int(v != 0) + int(v * cm.SCALE > 25.5) + int(v * cm.SCALE < -25.5) for v in x[1:]]
            g = lex.gate[p] + sure[0] * 3 + sure[1]
            q = 1 / (1 + math.exp(-min(max(weights[g] @ x, -15), 15)))
            sums[g] += np.append(x * (lex.bit[p] - q), np.outer(x, x).ravel() * q * (1 - q))
            for i in range(cm.CONTEXTS):
                want[i, 2 * slot[i] + int(lex.bit[p])] += 1
            decisions += 1
    cm.count(table, lex, 14, s)
    assert (table == want).all()
    found = [cm.outcomes(model, lex, 14, cm.symbols(lex, data, offsets[a:b + 1])) for a, b in ((0, 2), (2, 3), (3, 5))]
    once = cm.merged(found)
    assert (once & np.uint64(0xFFFFFFFF)).sum() == decisions
    assert len(np.unique(once >> np.uint64(32))) == len(once) < decisions
    for these in (found, [once], [cm.outcomes(model, lex, 14, s)]):
        assert np.allclose(sum(cm.statistics(weights, o) for o in these), sums, rtol=1e-9, atol=1e-9)


def test_texts_are_read_for_the_weights_once(spark, monkeypatch):
    """Newton steps read kept outcomes: more steps keep no more tables and read the texts no more often."""
    df = spark.createDataFrame([(d, "one two one two three") for d in range(60)], "doc_id long, text string")
    read, kept, mapped, keep = {}, [], lm_score._mapped, lm_score.tables.keep
    monkeypatch.setattr(lm_score.tables, "keep", lambda d, name: kept.append(name) or keep(d, name))
    for steps in (1, 3):
        columns = []
        monkeypatch.setattr(lm_score, "STEPS", steps)
        monkeypatch.setattr(lm_score, "_mapped", lambda d, run, schema: columns.append(d.columns) or mapped(d, run, schema))
        lm_score.train(df)
        read[steps] = columns.count(["text"])
    assert read[1] == read[3] and kept.count("outcomes") == 2
