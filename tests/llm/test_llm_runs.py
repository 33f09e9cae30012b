"""Periodic runs against a version that tries every start and period."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from quarry.llm import period_runs
from llm_cases import edge_docs, empty_docs


def brute(words, least=24):
    """(start, length, period) of all runs: maximal stretches at each lag, smallest period first."""
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 3 * q):
                out.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in out.items())


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def sequences(seed, n):
    """Texts full of nested and overlapping repetitions, as word numbers."""
    rnd = random.Random(seed)

    def piece(depth):
        if depth == 0 or rnd.random() < 0.3:
            return [rnd.randrange(rnd.choice([2, 3, 50, 1000])) for _ in range(rnd.randrange(1, 30))]
        body = [w for _ in range(rnd.randrange(1, 3)) for w in piece(depth - 1)]
        times = rnd.choice([1, 2, 3, 4, 7])
        return (body * times)[:rnd.randrange(1, 900)]

    return [[w for _ in range(rnd.randrange(0, 5)) for w in piece(4)][:1500] for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_repetitions(seed):
    texts = sequences(seed, 40)
    first = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    got = period_runs.find_runs(np.array([w for t in texts for w in t], dtype=np.int64), first)
    want = [(i, *r) for i, t in enumerate(texts) for r in brute(t, least=0)]
    assert [tuple(map(int, r)) for r in got] == want
    assert max(r[3] for r in want) > 64


@pytest.mark.parametrize("period", [15, 16, 17, 31, 32, 33, 63, 64, 100, 127, 128, 500])
def test_every_scale_and_hidden_short_runs(period):
    """Periods at the borders of scales; a period whose words are nearly all the same."""
    rnd = random.Random(period)
    for body in ([rnd.randrange(10**6) for _ in range(period)], [1] * (period - 1) + [2], [1, 2] * (period // 2) + [3] * (period % 2 or 2)):
        for extra in (0, 1, period - 1):
            words = [-5, -6] + (body * 4)[:3 * len(body) + extra] + [-7]
            got = period_runs.find_runs(np.array(words, dtype=np.int64), np.array([0, len(words)]))
            assert [tuple(map(int, r[1:])) for r in got] == brute(words, least=0)


def test_equal_hashes_do_not_make_runs(monkeypatch):
    """With a hash that tells hardly anything apart the result is the same."""
    texts = sequences(9, 10)
    first = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    words = np.array([w for t in texts for w in t], dtype=np.int64)
    want = period_runs.find_runs(words, first)
    real = period_runs.texthash.span_hash
    monkeypatch.setattr(period_runs.texthash, "span_hash", lambda *a: real(*a) & np.uint64(7))
    # seeds and extensions are now often wrong; every reported run still holds word by word
    for t, s, m, q in period_runs.find_runs(words, first):
        x = texts[t][s:s + m]
        assert x[q:] == x[:-q]
    assert len(want)


def test_documents_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(f"w{rnd.randrange(8)}" for _ in range(rnd.randrange(0, 160)))) for i in range(80)]
    rows += [(200 + i, " ".join(f"w{w}" for w in t)) for i, t in enumerate(sequences(5, 40))] + [(None, "a " * 30), (201, None), (202, "")]
    found = period_runs.digest(period_runs.period_runs(period_runs.with_planted_runs(spark.createDataFrame(rows, "doc_id long, text string"))))
    want = sorted((expected(*r) for r in rows), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert any(r[1] for r in want)


def test_edges(spark):
    found = period_runs.digest(period_runs.period_runs(period_runs.with_planted_runs(edge_docs(spark)))).collect()
    rows = [(r.doc_id, r.text) for r in edge_docs(spark).collect()]
    assert sorted((tuple(r) for r in found if r.doc_id != 7), key=str) == sorted((expected(*r) for r in rows if r[0] != 7), key=str)
    assert period_runs.period_runs(empty_docs(spark)).count() == 0


def test_time_is_linear_in_a_long_text():
    """Random words, one word, and nested periods: four times the words take about four times as long."""
    rnd = np.random.default_rng(1)
    for make in (lambda n: rnd.integers(0, 1000, n), lambda n: np.zeros(n, dtype=np.int64),
                 lambda n: np.tile(np.append(np.zeros(200, dtype=np.int64), 1), n // 201 + 1)[:n]):
        took = []
        for n in (250_000, 1_000_000):
            words = make(n)
            began = time.process_time()
            period_runs.find_runs(words, np.array([0, n]))
            took.append(time.process_time() - began)
        assert took[1] < 10 * took[0] + 1, took
