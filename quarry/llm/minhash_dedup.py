"""Operator 7: near-duplicate documents by min-max hashing.

Every document's set of word shingles gets ``PERMUTATIONS`` random permutations;
of each, both the smallest and the largest value are kept, so a signature has
twice as many values as hash evaluations.  Signatures are cut into bands of
``BAND_ROWS`` values; documents that share a band are candidates.

Documents with equal sets are one class from the start (a digest groups them),
so a copy never makes a pair.  Within a band bucket pairs are not enumerated:
one pivot per bucket is compared with the other members on the full sets, and the
confirmed links give components.  What the pivots leave open is settled exactly:
the members outside the largest component of their group of buckets are compared
with the group's members, block by block, and a block emits only the links that
connect components.  So every candidate pair is compared or already connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import tables, texthash
from quarry.llm.byte_bpe import small_batches
from quarry.llm.components import components

PERMUTATIONS = 80
#: 160 values in 32 bands of 5: a pair of similarity 0.8 shares no band once in 300 000 times.
BAND_ROWS = 5
COLUMNS = 512
#: Sets, and shingles of all sets together, in one block of the open members' comparison.
BLOCK_ROWS, BLOCK_VALUES = 512, 2_000_000
_RNG = np.random.default_rng(77)
_A = _RNG.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
WORDS = texthash.byte_codes(texthash.BLANKS)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of every permutation, then maximum of every permutation (min-max hash)."""
    low = np.full(PERMUTATIONS, (1 << 64) - 1, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for i in range(0, len(shingles), COLUMNS):
        x = _A[:, None] * shingles[None, i:i + COLUMNS] + _B[:, None]
        np.minimum(low, x.min(axis=1), out=low)
        np.maximum(high, x.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of BAND_ROWS signature values; the band's number goes in."""
    rows = sig.reshape(-1, BAND_ROWS)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for j in range(BAND_ROWS):
        key = texthash.mix(key ^ rows[:, j])
    return key.view(np.int64)


def _signed(documents: DataFrame, width: int) -> DataFrame:
    """doc_id, n, d1, d2 (digest of the set), bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, d, bands = [], [], []
            for s in texthash.shingle_sets(batch.column(1), WORDS, width):
                n.append(len(s))
                d.append([texthash.mix(s + np.uint64(k)).sum(dtype=np.uint64) for k in (1, 0xABCDEF)] if len(s) else [0, 0])
                bands.append(band_keys(signature(s)) if len(s) else np.zeros(0, np.int64))
            digest = np.array(d, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            keys = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, bands)]), pa.int32()),
                                            pa.array(np.concatenate([*bands, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest[:, 0]),
                                              pa.array(digest[:, 1]), keys], ["doc_id", "n", "d1", "d2", "bands"])

    return small_batches(documents, run, "doc_id long, n long, d1 long, d2 long, bands array<long>")


def _sets(documents: DataFrame, width: int) -> DataFrame:
    """node, set (distinct shingles) of the given documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [*texthash.shingle_sets(batch.column(1), WORDS, width)]
            values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()),
                                                           pa.array(values))], ["node", "set"])

    return small_batches(documents, run, "node long, set array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    sa, sb = (sets.select(F.col("node").alias(x), F.col("set").alias(f"s{x}")) for x in "ab")
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa").cast("long") + F.size("sb") - F.col("both")
    # the hub side (a, narrow rows) first; b is spread evenly
    return (pairs.join(sa.hint("merge"), "a").join(sb.hint("merge"), "b").withColumn("both", both)
            .where(F.lit(100) * F.col("both") >= F.lit(percent) * union).select("a", "b"))


def _similar_sizes(x: str, y: str, percent: int):
    """Sets that are similar enough have sizes that are."""
    return F.lit(100) * F.least(x, y) >= F.lit(percent) * F.greatest(x, y)


def _star_pairs(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pivot a, member b) pairs, one pivot per bucket, and the members that are no
    pivots.  The pivot is the first in a random order that is the same in all buckets."""
    ordered = members.withColumn("order", F.xxhash64("node"))
    firsts = ordered.groupBy("bucket").agg(F.min("order").alias("first"))
    live = tables.keep(ordered.join(firsts, "bucket").withColumn("pivot", F.col("order") == F.col("first")), "live")
    p = live.where("pivot").select("bucket", F.col("node").alias("a"), F.col("n").alias("an"))
    pairs = live.where("NOT pivot").join(p, "bucket").where(_similar_sizes("n", "an", percent))
    return pairs.select("a", F.col("node").alias("b")).distinct(), live.where("NOT pivot").select("bucket", "node", "n")


class _Forest:
    """Union-find over the rows of one block pair."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        while self.up.get(x, x) != x:
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.top(x), self.top(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection size of every left with every right set."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    lv, rv = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(lv, rv)
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    at = [np.minimum(np.searchsorted(shared, v), max(len(shared) - 1, 0)) for v in (lv, rv)]
    for lo in range(0, len(shared), COLUMNS * 8):
        part = shared[lo:lo + COLUMNS * 8]
        dense = []
        for x, v, r, i in zip((left, right), (lv, rv), rows, at, strict=True):
            hit = (i >= lo) & (i < lo + len(part)) & (shared[i] == v)
            m = np.zeros((len(x), len(part)), dtype=np.float32)
            m[r[hit], i[hit] - lo] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def _block_links(percent: int):
    """Links between the components of one (open block, member block) pair: as many as
    connect what is connected, so that a block emits no more rows than it reads."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows:
            (ln, lc, ls), (rn, rc, rs) = (
                (t.column("node").to_numpy(), t.column("c").to_numpy(), [np.array(x.values) for x in t.column("set")])
                for t in (left, right))
            sizes = [np.array([len(s) for s in x], dtype=np.int64) for x in (ls, rs)]
            both = _overlaps(ls, rs).astype(np.int64)  # the counts are exact, a hundred times them would not be
            linked = 100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both)
            forest = _Forest()
            for i, j in zip(*np.nonzero(linked & (lc[:, None] != rc[None, :])), strict=True):
                if forest.join(int(lc[i]), int(rc[j])):
                    out.append((int(ln[i]), int(rn[j])))
        return pa.table([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], schema=schema)

    return solve


def _open_links(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among members of a bucket that ``roots`` does not connect yet.

    Buckets that share members form one group.  In a group the members outside its
    largest component are compared with all members, in blocks of bounded size.
    """
    first = members.groupBy("bucket").agg(F.min("node").alias("b"))
    groups = components(members.join(first, "bucket").select(F.col("node").alias("a"), "b"))
    grouped = members.select("node", "n").distinct().join(groups.withColumnRenamed("root", "g"), "node", "left").join(
        roots, "node", "left").select("node", "n", F.coalesce("g", "node").alias("g"), F.coalesce("root", "node").alias("c"))
    grouped = tables.keep(grouped, "groups")
    parts = grouped.groupBy("g", "c").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("values"))
    blocks = lambda rows, values: F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(values / BLOCK_VALUES), F.lit(1)).cast("int")
    total = parts.groupBy("g").agg(F.max(F.struct("rows", "c", "values")).alias("m"), F.sum("rows").alias("rows"),
                                   F.sum("values").alias("values"), F.count(F.lit(1)).alias("k")).where("k > 1")
    plan = total.select("g", F.col("m.c").alias("main"), blocks(F.col("rows"), F.col("values")).alias("rn"),
                        blocks(F.col("rows") - F.col("m.rows"), F.col("values") - F.col("m.values")).alias("ln"))
    rows = tables.keep(grouped.join(plan, "g").join(sets, "node"), "open")
    at = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    key, carried = ["g", "lb", "rb"], ["node", "c", "set"]
    left = rows.where("c <> main").withColumn("lb", at("ln")).withColumn("rb", every("rn")).select(*key, *carried)
    right = rows.withColumn("rb", at("rn")).withColumn("lb", every("ln")).select(*key, *carried)
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_block_links(percent), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document.

    ``docs`` has doc_id and text, other columns are ignored.  Words are runs of
    non-blank characters with A-Z lower-cased; a set holds the distinct shingles of
    ``width`` words (with fewer words, the whole sequence as one).  Two documents
    are linked if 100 * intersection >= ``percent`` * union; ``component_id`` is the
    smallest doc_id reachable and ``kept`` tells whether it is the document's own.
    Documents with a null text, or without words, link with nothing.  A repeated
    doc_id is one document with several texts, each row with its own count.  Rows
    with a null doc_id take no part: component_id is null and they are kept.
    An empty table gives an empty result.
    """
    documents = tables.columns(docs, "doc_id", "text")
    signed = tables.keep(_signed(documents, width), "signed")
    known = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = tables.keep(known.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("node")), "classes")
    placed = known.select("doc_id", "d1", "d2", "n").join(classes, ["d1", "d2", "n"]).select("doc_id", "n", "node")
    roots = _roots(documents, signed, classes, placed, width, percent)
    final = placed.join(roots, "node", "left").select("doc_id", "n", F.coalesce("root", "node").alias("component_id"))
    lone = signed.where("NOT (n > 0 AND doc_id IS NOT NULL)").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return final.unionByName(lone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _roots(documents: DataFrame, signed: DataFrame, classes: DataFrame, placed: DataFrame,
           width: int, percent: int) -> DataFrame:
    """(node, root) of the classes that are linked to a smaller one."""
    # merge joins at every size: what is shuffled then grows as the input
    heads = signed.where("n > 0").join(classes.withColumnRenamed("node", "doc_id").hint("merge"), ["d1", "d2", "n", "doc_id"])
    banded = heads.select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("node"), "n")
    shared = banded.groupBy("bucket").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y")
    members = tables.keep(banded.join(shared.select("bucket").hint("merge"), "bucket", "left_semi"), "members")
    nodes = members.select(F.col("node").alias("doc_id")).distinct()
    sets = tables.keep(_sets(documents.join(nodes.hint("merge"), "doc_id", "left_semi"), width), "sets")
    # a repeated doc_id belongs to several classes: one document, hence one component
    ids = placed.groupBy("doc_id").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y")
    links = placed.join(ids, "doc_id").where("node <> x").select(F.col("node").alias("a"), F.col("x").alias("b"))
    pairs, rest = _star_pairs(members, percent)
    links = tables.keep(_confirm(pairs, sets, percent).unionByName(links), "links")
    open_links = _open_links(rest, components(links), sets, percent)
    return components(links.unionByName(open_links))
