"""Fixtures and brute-force versions shared by the tests of the training-data operators."""

import re
from collections import Counter

import pandas as pd

SF = "/root/testdata/sf0.001"
CLASHING = ["n", "h1", "row", "ids", "set", "node", "key", "v", "label", "start", "spans", "bands"]


def edge_docs(spark, extra=True):
    """Nulls, empty, blank and very long texts, ties, repeated rows and clashing extra columns."""
    line = "the quick brown fox jumps over the lazy dog near the old river bank today"
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, line), (5, line), (5, line), (6, line.replace("quick", "quicc")),
            (7, ("word%d " % 7) * 3 + "x" * 70_000 + "\n" + " ".join(f"w{i}" for i in range(20_000))),
            (8, "a\n" + line + "\nb"), (None, "no id " + line), (9, "é" * 40 + "\n" + "é" * 39 + "ü"), (10, "one two")]
    cols = "doc_id long, text string" + (", " + ", ".join(f"{c} string" for c in CLASHING) if extra else "")
    return spark.createDataFrame([r + (("z",) * len(CLASHING) if extra else ()) for r in rows], cols)


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def documents(sf=SF):
    return pd.read_parquet(f"{sf}/documents.parquet")


def words4(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingle_set(text, width):
    w = words4(text)
    k = min(width, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def classes(rows, width):
    """{doc_id: (set size, smallest reachable id)} by comparing all pairs; rows: (doc_id, text)."""
    sets = [(d, shingle_set(t, width)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((top(a), top(b)))
                root[q] = p
    return [(d, len(s), top(d)) for d, s in sets]


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + (len(a) == len(b)):] == b[p + 1:]


def lines_without_repeats(rows, least=24):
    """{doc_id: (lines, dropped, text)} by comparing every line with all earlier ones."""
    split = [(d, t.split("\n")) for d, t in sorted(rows)]
    firsts, out = {}, {}
    order = [(d, i, s.strip(" \t\r\x0b\x0c")) for d, parts in split for i, s in enumerate(parts)]
    gone = set()
    for d, i, s in order:
        if s in firsts:
            gone.add((d, i))
        elif s:
            if len(s) >= least and any(one_edit(s, t) for t in firsts if len(t) >= least and abs(len(t) - len(s)) <= 1):
                gone.add((d, i))
            firsts[s] = (d, i)
    for d, parts in split:
        out[d] = (len(parts), sum((d, i) in gone for i in range(len(parts))),
                  "\n".join(s for i, s in enumerate(parts) if (d, i) not in gone))
    return out


def bench_words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def passages(docs, items, width=5, percent=80):
    """{(doc_id, item_id): (start, words, similarity)}: every window of every document against every item."""
    out = {}
    sh = lambda w: [tuple(w[i:i + width]) for i in range(len(w) - width + 1)]
    prepared = [(i, bench_words(t)) for i, t in items]
    prepared = [(i, len(w), Counter(sh(w))) for i, w in prepared if len(w) >= width]
    for d, t in docs:
        w = bench_words(t)
        grams = sh(w)
        here = set(grams)
        for i, n, c in prepared:
            if not here & set(c):
                continue
            n = min(n, len(w))
            for s in range(len(w) - n + 1):
                x = Counter(grams[s:s + n - width + 1])
                both, either = sum((x & c).values()), sum((x | c).values())
                if 100 * both >= percent * either and both / either > out.get((d, i), (0, 0, 0))[2]:
                    out[d, i] = (s, n, both / either)
    return out
