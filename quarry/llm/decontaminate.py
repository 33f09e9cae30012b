"""Operator 6: passages of a benchmark inside documents.

For every benchmark item the document's windows of the item's size are
fingerprinted by a 128-bit SimHash of their word shingles (a sliding sum per
bit).  The fingerprints are looked up in a multi-index: cut into eight 16-bit
blocks, two fingerprints within ``RADIUS`` bits agree in some block up to
``RADIUS // 8`` bits, so an index that lists each item under all block values
that near finds every fingerprint within the radius.  Candidates are verified by
the exact weighted (multiset) Jaccard similarity of their shingles.

A window similar to an item shares a shingle with it, so only windows around
shared shingles are fingerprinted; that loses nothing.
"""

from __future__ import annotations

import functools
import itertools
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import tables, texthash
from quarry.llm.byte_bpe import small_batches

BITS, BLOCKS = 128, 8
#: At similarity 0.8 the expected distance is 19.5 bits with a deviation of 4; 31 is 2.8 deviations above.
RADIUS = 31
#: Bounds of one pass over the documents; a larger benchmark takes several passes.
PASS_ITEMS, PASS_CHARS = 2000, 8 << 20
WORDS = texthash.byte_codes(texthash.NOT_ALNUM)
SCHEMA = "doc_id long, item_id long, start_word long, n_words long, similarity double"


def _bits(shingles: np.ndarray) -> np.ndarray:
    """+1 / -1 per shingle and fingerprint bit."""
    two = np.stack([shingles, texthash.mix(shingles ^ np.uint64(0x5851F42D4C957F2D))], axis=1)
    return np.unpackbits(two.view(np.uint8), axis=1).astype(np.int32) * 2 - 1


def simhashes(shingles: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints (rows of two 64-bit words) of all runs of ``size`` shingles."""
    sums = np.zeros((len(shingles) + 1, BITS), dtype=np.int32)
    np.cumsum(_bits(shingles), axis=0, out=sums[1:])
    return np.packbits(sums[size:] - sums[:-size] > 0, axis=1).view(np.uint64)


def hashed_words(column: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of every text: lower case, runs of letters, digits and non-ASCII characters."""
    data, offsets = texthash.text_buffer(pc.utf8_lower(column.cast(pa.large_string())))
    for a, b in texthash.slices(offsets):
        _, _, h, first = texthash.words(data, offsets[a:b + 1], WORDS)
        yield from (h[first[i]:first[i + 1]] for i in range(b - a))


@functools.lru_cache(maxsize=1)
def _near_values() -> np.ndarray:
    """Masks of all 16-bit values with at most RADIUS // BLOCKS bits set."""
    ones = [sum(1 << i for i in c) for n in range(RADIUS // BLOCKS + 1) for c in itertools.combinations(range(16), n)]
    return np.array(ones, dtype=np.uint16)


class MultiIndex:
    """Finds all stored fingerprints within RADIUS bits of a given one."""

    def __init__(self, prints: np.ndarray) -> None:
        self.prints = prints
        masks = _near_values()
        self.rows, self.at = [], []
        for block in prints.view(np.uint16).reshape(len(prints), BLOCKS).T:
            values = (block[:, None] ^ masks[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            self.rows.append((order // len(masks)).astype(np.int32))
            self.at.append(np.concatenate([[0], np.cumsum(np.bincount(values, minlength=1 << 16))]))

    def find(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query row, stored row) of every pair within the radius."""
        pairs = []
        for rows, at, block in zip(self.rows, self.at, prints.view(np.uint16).reshape(len(prints), BLOCKS).T, strict=True):
            lo, n = at[block], at[block.astype(np.int64) + 1] - at[block]
            q = np.repeat(np.arange(len(prints)), n)
            inside = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)
            pairs.append(q * len(self.prints) + rows[lo[q] + inside])
        both = np.unique(np.concatenate(pairs))
        q, s = both // len(self.prints), both % len(self.prints)
        near = np.bitwise_count(prints[q] ^ self.prints[s]).sum(axis=1) <= RADIUS
        return q[near], s[near]


@dataclass
class Items:
    """Benchmark items of one pass, prepared for lookups."""

    ids: list[int]
    words: np.ndarray  # words per item
    shingles: list[np.ndarray]
    width: int

    def __post_init__(self) -> None:
        self.counts = [np.unique(s, return_counts=True) for s in self.shingles]
        rows = np.concatenate([np.full(len(u), i) for i, (u, _) in enumerate(self.counts)])
        values = np.concatenate([u for u, _ in self.counts])
        order = np.argsort(values, kind="stable")
        self.values, first = np.unique(values[order], return_index=True)
        self.owners = np.split(rows[order], first[1:])
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[self.values & np.uint64(0xFFFFF)] = True
        self.index = MultiIndex(np.concatenate([simhashes(s, len(s)) for s in self.shingles]))

    def shared(self, g: np.ndarray) -> np.ndarray:
        """Positions of the shingles that some item has."""
        at = np.flatnonzero(self.seen[g & np.uint64(0xFFFFF)])
        return at[self.values[np.minimum(np.searchsorted(self.values, g[at]), len(self.values) - 1)] == g[at]]

    def similarity(self, window: np.ndarray, item: int) -> tuple[int, int]:
        """(sum of minima, sum of maxima) of the shingle counts of a window and an item."""
        u, n = self.counts[item]
        at = np.minimum(np.searchsorted(u, window), len(u) - 1)
        held = np.bincount(at[u[at] == window], minlength=len(u))
        both = int(np.minimum(held, n).sum())
        return both, len(window) + int(n.sum()) - both

    def found_in(self, h: np.ndarray, percent: int) -> list[tuple[int, int, int, float]]:
        """The matches of a text's word hashes."""
        g = texthash.shingles(h, self.width)
        hits = self.shared(g)
        return [*self.matches(h, g, hits, percent)] if len(hits) else []

    def matches(self, h: np.ndarray, g: np.ndarray, hits: np.ndarray, percent: int) -> Iterator[tuple[int, int, int, float]]:
        """(item row, first word, words, similarity) of the best window per matching item."""
        best: dict[int, tuple[float, int, int]] = {}
        near: dict[int, set[int]] = {}  # shared positions by number of words in the window
        for p in hits:
            for i in self.owners[np.searchsorted(self.values, g[p])]:
                near.setdefault(min(int(self.words[i]), len(h)), set()).add(int(p))
        for n_words, places in near.items():
            m = n_words - self.width + 1  # shingles in a window
            starts = np.zeros(len(g) - m + 1, dtype=bool)
            for p in places:
                starts[max(p - m + 1, 0):p + 1] = True
            for lo, hi in _runs(starts):
                q, item = self.index.find(simhashes(g[lo:hi + m - 1], m))
                for s, i in zip((q + lo).tolist(), item.tolist(), strict=True):
                    if min(int(self.words[i]), len(h)) == n_words:
                        both, either = self.similarity(g[s:s + m], i)
                        if 100 * both >= percent * either and both / either > best.get(i, (0.0, 0, 0))[0]:
                            best[i] = both / either, s, n_words
        return ((i, s, n, round(x, 6)) for i, (x, s, n) in sorted(best.items()))


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)


def _items(rows: list, width: int) -> tuple[list[int], np.ndarray, list[np.ndarray]] | None:
    """(ids, words per item, shingles per item) of the items that have a shingle."""
    texts = pa.array([r.text for r in rows], pa.string())
    kept = [(r.item_id, h) for r, h in zip(rows, hashed_words(texts), strict=True) if len(h) >= width]
    if not kept:
        return None
    return [i for i, _ in kept], np.array([len(h) for _, h in kept]), [texthash.shingles(h, width) for _, h in kept]


#: Passes whose items a worker holds at once.
READY_PASSES = 4
_READY: dict[str, Items] = {}


def _ready(name: str, shared, width: int) -> Items:
    """The pass's items with their index, built once per worker."""
    if name not in _READY:
        if len(_READY) >= READY_PASSES:
            _READY.clear()
        _READY[name] = Items(*shared.value, width)
    return _READY[name]


def _passes(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """The benchmark with a pass number, so that each pass keeps its bounds."""
    size = benchmark.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("c")).head()
    n = max(math.ceil(size.n / PASS_ITEMS), math.ceil(size.c / PASS_CHARS), 1)
    while True:
        numbered = benchmark.withColumn("pass", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
        over = numbered.groupBy("pass").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("c")).where(
            (F.col("n") > 1) & ((F.col("n") > PASS_ITEMS) | (F.col("c") > PASS_CHARS)))
        if n == 1 or not over.head(1):
            return numbered, n
        n *= 2


def _prepared(benchmark: DataFrame, width: int) -> Iterator[tuple[object, str]]:
    """(broadcast items, name) of every pass over the benchmark."""
    items = tables.columns(benchmark, "item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    numbered, n = _passes(items)
    for k in range(n):
        rows = numbered.where(F.col("pass") == k).orderBy("item_id", "text").collect()  # at most PASS_ITEMS
        if (found := _items(rows, width)) is not None:
            yield benchmark.sparkSession.sparkContext.broadcast(found), uuid.uuid4().hex


def find_passages(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, item_id, start_word, n_words, similarity: each item found in each document.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are
    ignored.  Words are lower-cased runs of letters and digits.  A document holds an
    item if a window of as many words as the item (the whole document if it is
    shorter) has a weighted Jaccard similarity of word shingles of at least
    ``percent`` / 100; the row gives the most similar window, the first of equals.
    Null or empty texts, texts of fewer than ``width`` words and items with a null
    item_id match nothing.  Repeated rows of either table count once per distinct
    row of ``benchmark`` and once per row of ``docs``.  Empty tables give no rows.
    """
    documents = tables.columns(docs, "doc_id", "text")
    out = None
    for shared, name in _prepared(benchmark, width):
        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            found = _ready(name, shared, width)
            for batch in batches:
                rows = []
                for doc, h in zip(batch.column(0).to_pylist(), hashed_words(batch.column(1)), strict=True):
                    rows += [(doc, found.ids[i], s, n, x) for i, s, n, x in found.found_in(h, percent)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5,
                                                    [pa.int64()] * 4 + [pa.float64()], strict=True)],
                    ["doc_id", "item_id", "start_word", "n_words", "similarity"])

        part = small_batches(documents, run, SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def without_passages(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose texts hold no benchmark item; nothing is shuffled."""
    for shared, name in _prepared(benchmark, width):
        docs = docs.where(~_holds(shared, name, width, percent)(F.col("`text`")))
    return docs


def _holds(shared, name: str, width: int, percent: int):
    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        found = _ready(name, shared, width)
        column = pa.Array.from_pandas(texts, type=pa.large_string())
        return pd.Series([bool(found.found_in(h, percent)) for h in hashed_words(column)], dtype=bool)

    return holds
