"""Periodic runs of words found with multi-scale minimizers.

A run is a maximal stretch of words with smallest period q and at least 3 q
words.  Short periods are found by comparing the words with themselves at each
lag.  For periods in [L, 2 L) the hashes of all grams of L / 4 words are taken
and every window of L / 4 grams marks its smallest one.  Inside a run, windows a
period apart hold the same grams, so they mark positions a period apart with
equal grams: pairs of equal marks with a distance in [L, 2 L) are the seeds,
which are extended both ways.

Grams that are themselves periodic (they lie in a run already found, of at most
a third of their length) are never marked.  Any run of a longer period has
other grams, and those cannot repeat within a third of their length, so a mark
has at most 24 partners: seeds stay linear in the words, and none is left out.

Texts are worked on in slices of about one megabyte with a separator of its own
behind each text.  Words are compared by their exact dictionary numbers; hashes
choose seeds and measure extensions, whose result is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import tables, texthash

SHORT = 16  # periods below are found by lag scans
REPEATS = 3  # least length / period
LEAST_WORDS = 24  # least length of a reported run
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_IS_WORD = texthash.byte_codes(texthash.BLANKS)[0]

RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(all words of the texts as a dictionary array, first word of each text)."""
    lo = int(offsets[0])
    data = data[lo:int(offsets[-1])]
    inside = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets - lo] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    start = np.flatnonzero(opens)
    letters = data[inside]
    at = np.append(np.cumsum(inside)[start] - 1, len(letters)).astype(np.int64) if len(start) else np.zeros(1, np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(at), pa.py_buffer(letters)])
    return words.dictionary_encode(), np.searchsorted(start, offsets - lo)


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the maximal stretches of True."""
    d = np.diff(equal.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def _lag_runs(seq: np.ndarray, q: int) -> np.ndarray:
    s, e = _stretches(seq[q:] == seq[:-q])
    ok = e - s >= (REPEATS - 1) * q
    return np.stack([s[ok], e[ok] + q, np.full(int(ok.sum()), q)], axis=1)


def _sliding(v: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every window of ``width`` values, a power of two."""
    step = 1
    while step < width:
        v = pick(v[:-step], v[step:])
        step *= 2
    return v


def _marks(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the smallest gram of some full window of ``width`` grams."""
    if len(grams) < width:
        return np.zeros(0, dtype=np.int64)
    least = _sliding(grams, width, np.minimum)
    pad = np.zeros(width - 1, dtype=np.uint64)
    largest = _sliding(np.concatenate([pad, least, pad]), width, np.maximum)  # over the windows that hold a position
    return np.flatnonzero((grams == largest) & (grams != _NONE))


def _seeds(grams: np.ndarray, marks: np.ndarray, lo: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, lag) of equal marks with a lag in [lo, 2 lo)."""
    order = marks[np.argsort(grams[marks], kind="stable")]
    left, lag = [], []
    x, t = np.arange(len(order)), 0
    while len(x):
        t += 1
        x = x[x + t < len(order)]
        a, b = order[x], order[x + t]
        near = (grams[a] == grams[b]) & (b - a < 2 * lo)
        x, a, b = x[near], a[near], b[near]
        far = b - a >= lo
        left.append(a[far])
        lag.append((b - a)[far])
    return (np.concatenate(left), np.concatenate(lag)) if left else (order, order)


def _common(sums: np.ndarray, a: np.ndarray, b: np.ndarray, longest: int, back: bool) -> np.ndarray:
    """Words that agree from a and b on (or before them), by hashes of doubling spans."""
    n, found = len(sums) - 1, np.zeros(len(a), dtype=np.int64)
    step = 1 << max(0, int(longest).bit_length() - 1)
    while step:
        if back:
            x, y = a - found - step, b - found - step
            ok = x >= 0
        else:
            x, y = a + found, b + found
            ok = y + step <= n
        i = np.flatnonzero(ok)
        same = texthash.span_hash(sums, x[i], x[i] + step) == texthash.span_hash(sums, y[i], y[i] + step)
        found[i[same]] += step
        step //= 2
    return found


def _scale_runs(seq: np.ndarray, runs: np.ndarray, lo: int) -> np.ndarray:
    """Runs with a period in [lo, 2 lo); ``runs``: those with smaller periods."""
    k = lo // 4
    if len(seq) <= 2 * k:
        return np.zeros((0, 3), dtype=np.int64)
    sums = texthash.prefix_sums(texthash.mix(seq.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    at = np.arange(len(seq) - k + 1)
    grams = texthash.mix(texthash.span_hash(sums, at, at + k))
    inner = runs[(runs[:, 2] * 3 <= k) & (runs[:, 1] - runs[:, 0] >= k)]
    covered = np.zeros(len(grams) + 1, dtype=np.int64)
    np.add.at(covered, inner[:, 0], 1)
    np.add.at(covered, inner[:, 1] - k + 1, -1)
    grams[np.cumsum(covered[:-1]) > 0] = _NONE
    x, q = _seeds(grams, _marks(grams, k), lo)
    if not len(x):
        return np.zeros((0, 3), dtype=np.int64)
    longest = len(seq)
    s = x - _common(sums, x, x + q, longest, back=True)
    e = x + q + _common(sums, x, x + q, longest, back=False)
    found = np.unique(np.stack([s, e, q], axis=1)[e - s >= REPEATS * q], axis=0)
    exact = [np.array_equal(seq[a:b - p], seq[a + p:b]) for a, b, p in found]
    if all(exact):
        return found
    # equal hashes of different words: these lags are scanned directly
    again = [_lag_runs(seq, int(p)) for p in np.unique(found[~np.array(exact), 2])]
    return np.unique(np.concatenate([found[exact], *again]), axis=0)


def find_runs(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Runs (text, start, length, period) of the texts words[first[i]:first[i+1]].

    Sorted by text, start and period; all runs of at least REPEATS periods.
    """
    n_texts = len(first) - 1
    size = np.diff(first)
    begin = first[:-1] + np.arange(n_texts)  # a separator stands behind each text
    seq = np.empty(len(words) + n_texts, dtype=np.int64)
    seq[np.arange(len(words)) + np.repeat(np.arange(n_texts), size)] = words
    seq[begin + size] = np.arange(n_texts) - n_texts  # negative, each its own
    found = [_lag_runs(seq, q) for q in range(1, min(SHORT, len(seq)))]
    runs = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
    lo = SHORT
    while size.max(initial=0) >= REPEATS * lo:
        # only texts that can hold such a run; they stay in order, so places map by text
        take = size >= REPEATS * lo
        at = np.flatnonzero(np.repeat(take, size + 1))
        moved = np.full(len(seq) + 1, -1, dtype=np.int64)
        moved[at] = np.arange(len(at))
        here = runs[moved[runs[:, 0]] >= 0]
        length = here[:, 1:2] - here[:, :1]
        new = _scale_runs(seq[at], np.concatenate([moved[here[:, :1]], moved[here[:, :1]] + length, here[:, 2:]], axis=1), lo)
        start = at[new[:, 0]]
        runs = np.concatenate([runs, np.stack([start, start + new[:, 1] - new[:, 0], new[:, 2]], axis=1)])
        lo *= 2
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):  # a multiple of the smallest period has the same ends
        runs = runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))]
    text = np.searchsorted(begin, runs[:, 0], side="right") - 1
    out = np.stack([text, runs[:, 0] - begin[text], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _slice(data: np.ndarray, offsets: np.ndarray) -> Iterator[pa.Array]:
    """Columns n_words, runs, collapsed of a slice of texts."""
    words, first = split_words(data, offsets)
    ids = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    runs = find_runs(ids, first)
    runs = runs[runs[:, 2] >= LEAST_WORDS]
    at = first[runs[:, 0]] + runs[:, 1]
    gone = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(gone, at + runs[:, 3], 1)
    np.add.at(gone, at + runs[:, 2], -1)
    kept = np.cumsum(gone[:-1]) == 0
    before = np.append(0, np.cumsum(kept))
    text = pc.binary_join(pa.LargeListArray.from_arrays(
        pa.array(before[first]), words.dictionary.take(pa.array(ids[kept]))), pa.scalar(" ", pa.large_string()))
    per_text = np.searchsorted(runs[:, 0], np.arange(len(first))).astype(np.int32)
    structs = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in (1, 2, 3)], ["start", "length", "period"])
    yield from (pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(per_text), structs), text.cast(pa.string()))


def _map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = texthash.text_buffer(b["text"])
        for lo, hi in texthash.slices(offsets):
            yield pa.RecordBatch.from_arrays([b["doc_id"].slice(lo, hi - lo), *_slice(data, offsets[lo:hi + 1])],
                                             ["doc_id", "n_words", "runs", "collapsed"])


def period_runs(docs: DataFrame) -> DataFrame:
    """Periodic runs of every text, and the text with each run cut to its first period.

    Columns: doc_id, n_words, runs (start, length, period in words; by start,
    then period), collapsed (the words that no run holds beyond its first
    period, joined by one space).  Null, empty and blank texts have no words and
    no runs; repeated rows each give a row; a null doc_id stays null; other
    columns are not read.
    """
    return tables.columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(_map, SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) in which those with crc32(doc_id) % 10 = 0 end in a repeated passage.

    With g = floor(crc32 / 10), a = g % n and p = 1 + floor((n - a) / (3 + g % 8)), word i >= a
    becomes word a + (i - a) % p of the text.  Rows without a doc_id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size("_w").cast("long")
    g = F.floor(h / 10).cast("long")
    planted = F.when(F.size("_w") > 0, F.array_join(F.transform(
        F.sequence(F.lit(0).cast("long"), n - 1),
        lambda i: F.get("_w", F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))), " "))
    rows = tables.columns(docs, "doc_id", "text").withColumn("_w", F.when(h % 10 == 0, words))
    rows = rows.withColumn("_a", F.when(n > 0, g % n)).withColumn("_p", 1 + F.floor((n - F.col("_a")) / (3 + g % 8)))
    return rows.select("doc_id", F.coalesce(planted, "text").alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The strongest run, and digests of all runs and of the collapsed text."""
    def stronger(best, r):
        return F.when(best["length"].isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    nothing = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = found.withColumn("_b", F.reduce("runs", nothing, stronger))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_b.start").alias("start"), F.col("_b.length").alias("length"),
        F.col("_b.period").alias("period"), F.floor(F.lit(1000) * F.col("_b.length") / F.col("_b.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
