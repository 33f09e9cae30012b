"""Prefix trie of conversations against a brute-force trie."""

import hashlib
import random
import re
import zlib

import pytest

from quarry.llm import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            order = (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest())
            own.setdefault(c, []).append((order, role, text))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = int(c - (abs(c) % 20) * (1 if c >= 0 else -1))
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for q, ids in members.items():
        under = [x for x in members if x[:len(q)] == q]
        words = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) if x else 0
        parents = {x[:-1] for x in members if x}
        ends = ",".join(str(c) for c in sorted(ids) if len(whole[c]) == len(q))
        out.append((min(ids), len(q), min(members[q[:-1]]) if q else None, len(ids),
                    sum(len(x) == len(q) + 1 and x[:-1] == q for x in members), sum(x not in parents for x in under),
                    sum((len(members[x]) - 1) * words(x) for x in under), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens", "ends_sha256").collect()), key=str)


def random_rows(seed, n):
    rnd = random.Random(seed)
    texts = ["", " ", None, "one", "one two", "a b  c\n", "ä ö"]
    return [(rnd.choice([None, *range(-25, 45)]), rnd.choice([None, 0, 1, 2, 3, 4]), rnd.choice(["user", "bot", None]),
             rnd.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("seed,n", [(1, 150), (2, 400)])
def test_trie_equals_brute_force(spark, seed, n):
    rows = random_rows(seed, n)
    rows += rows[:10]
    assert got(conversation_trie.trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_long_conversation_spreads_over_parts(spark):
    """A conversation with most of the rows, copies of it, and a base with fewer turns than are taken."""
    turns = [("user" if i % 2 else "bot", f"word {i % 7} {i}") for i in range(90)]
    rows = [(c, i, *t) for c in (3, 7, 11, 45) for i, t in enumerate(turns)] + [(0, 0, "user", "only turn")]
    rows += [(c, i, "user", "same") for c in range(100, 130) for i in range(2)] + [(9, 1, "u", "x")] * 40
    df = spark.createDataFrame(rows, SCHEMA)
    convs, placed = conversation_trie.rebuilt(df)
    assert placed.where("conv_id = 3").select("part").distinct().count() > 1
    assert got(conversation_trie.trie(df)) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert conversation_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(c, t, "user", f"t{t}") for c in range(5) for t in range(3)]
    wide = spark.createDataFrame([r + ("z",) * 8 for r in rows],
                                 SCHEMA + ", depth string, k1 string, part string, words string, row string, h string, base string, n string")
    assert got(conversation_trie.trie(wide)) == brute(rows)


def test_end_lists_cut_into_pieces(spark):
    """One sequence with many conversations: its ids come in many pieces."""
    rows = [(c, 0, "user", "same") for c in range(0, 60_000, 20)]
    node = [r for r in conversation_trie.trie(spark.createDataFrame(rows, SCHEMA)).collect() if r.n_convs > 500 and r.depth == 1]
    ids = ",".join(str(c) for c, *_ in rows)
    assert [r.ends_sha256 for r in node] == [hashlib.sha256(ids.encode()).hexdigest()]
