"""Operator 3: near-duplicate lines by a deletion-neighbourhood join.

Two lines within one edit (insertion, deletion or substitution of a character)
have a common variant with at most one character deleted.  Every line emits
hashed keys of its variants; lines with equal keys meet, the edit distance is
verified on the texts, and of every pair the earlier line stays.

Two things keep the number of variants small without losing a pair:

* Equal lines are one line (its first occurrence) from the start.
* A line only emits variants where it can have a partner.  Cut into ``BLOCKS``
  blocks, two lines within one edit agree outside one block, so the key of a
  line without block i is shared by every partner that differs in block i.
  Variants are emitted only for blocks whose key several lines have, and only
  with deletions inside that block.

A key's members are not paired with each other: lines that give the same text by
deleting the character at the *same* place are all within one edit of each
other, and so are a line and all lines that give it by one deletion; so the
earliest member of a key decides for all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import tables, texthash
from quarry.llm.byte_bpe import small_batches
from quarry.llm.texthash import mix, prefix_sums, shift_left, span_hash, to_origin

#: Shorter lines (headings, list marks, brackets) only go as exact repeats: an edit changes what they say.
MIN_CHARS = 24
BLOCKS = 4
#: Block borders depend on length // CLASS only, so lines of neighbouring lengths mostly share them.
CLASS = 16
SLICE = 1 << 18  # bytes of text worked on at once: a text takes some eighty times its size while its lines are hashed
BLANK_CHARS = " \t\r\x0b\x0c"
_RNG = np.random.default_rng(31)
_CODES = _RNG.integers(1, 1 << 63, (2, 1 << 16), dtype=np.uint64)
_U = np.uint64


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


class Lines:
    """The lines of one slice of texts that are not blank, hashed.

    ``doc`` (row in the slice), ``pos`` (line number), ``start`` and ``end``
    (without surrounding blanks) are arrays; h1 and h2 identify the line's text, and
    h1 is the key of the text alone, as ``variants`` makes it for shorter texts.
    """

    def __init__(self, texts: list[str]) -> None:
        joined = "\n".join(texts)  # a line feed ends each text
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.append(np.flatnonzero(chars == 10), len(chars))
        starts = np.concatenate([[0], ends[:-1] + 1])
        count = np.array([t.count("\n") + 1 for t in texts])
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        doc = np.repeat(np.arange(len(texts)), count)
        pos = np.arange(len(starts)) - np.repeat(first, count)
        solid = np.flatnonzero(~np.isin(chars, np.frombuffer((BLANK_CHARS + "\n").encode("utf-32-le"), np.uint32)))
        a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
        full = np.flatnonzero(b > a)
        start, end = solid[a[full]], solid[b[full] - 1] + 1
        self.chars, self.start, self.end = chars, start, end
        self.doc, self.pos = doc[full], pos[full]
        low, high = chars & 0xFFFF, (chars >> 16).astype(_U)
        self.sums = prefix_sums(_CODES[0][low] + high * _U(0x2545F4914F6CDD1D))
        second = prefix_sums(_CODES[1][low] + high * _U(0x9E6C63D0876A9A47))
        n = (self.end - self.start).astype(_U)
        self.h1 = _signed(mix(span_hash(self.sums, self.start, self.end) + n))
        self.h2 = _signed(mix(span_hash(second, self.start, self.end) ^ n))

    def occurrence(self) -> np.ndarray:
        """Identifies a line's text and number together."""
        return _signed(mix(self.h1.view(_U) + mix(self.pos.astype(_U) + _U(1))))

    def classes(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(lines, length class) of the lines that are compared by edits: a line's own
        class, and the class below if a partner that is one character shorter has that."""
        n = self.end - self.start
        long = np.flatnonzero(n >= MIN_CHARS)
        edge = long[n[long] % CLASS == 0]
        return [(long, n[long] // CLASS), (edge, n[edge] // CLASS - 1)]

    def block_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(line, key, from, to): per line and block the key of the rest, and where the block may lie."""
        out = []
        for lines, c in self.classes():
            start, end, step = self.start[lines], self.end[lines], c * CLASS // BLOCKS
            for i in range(BLOCKS):
                lo, hi = start + i * step, end - (BLOCKS - 1 - i) * step
                key = mix(span_hash(self.sums, start, lo) + (c * BLOCKS + i).astype(_U))
                key = mix(key ^ (span_hash(self.sums, hi, end) * _U(0xD6E8FEB86659FD93)))
                out.append((lines, _signed(key), lo, hi))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def variants(self, line: int, lo: int, hi: int) -> np.ndarray:
        """Keys of the line's texts without the character at lo..hi-1: text alone, then text with place."""
        start, end = int(self.start[line]), int(self.end[line])
        at = np.arange(lo, hi)
        left = self.sums[at] - self.sums[start]
        right = shift_left(self.sums[end] - self.sums[at + 1])
        text = mix(to_origin(left + right, start) + _U(end - start - 1))
        place = mix(text ^ (at - start + 1).astype(_U) * _U(0xA0761D6478BD642F))
        return np.concatenate([_signed(text), _signed(place)])


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """Rows of a batch in slices of bounded text."""
    _, offsets = texthash.text_buffer(batch.column(1))
    for a, b in texthash.slices(offsets, SLICE):
        yield a, [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]


def _hashed(documents: DataFrame) -> DataFrame:
    """doc_id, pos, h1, h2 of every line that is not blank, with the keys of long-enough ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, texts in _slices(batch):
                x = Lines(texts)
                line, key, _, _ = x.block_keys()
                order = np.argsort(line, kind="stable")
                at = np.concatenate([[0], np.cumsum(np.bincount(line, minlength=len(x.start)))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a + x.doc], pa.int64()), pa.array(x.pos.astype(np.int32)), pa.array(x.h1), pa.array(x.h2),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(key[order]))],
                    ["doc_id", "pos", "h1", "h2", "keys"])

    return small_batches(documents, run, "doc_id long, pos int, h1 long, h2 long, keys array<long>")


def _variants(wanted: DataFrame) -> DataFrame:
    """id (h1), doc_id, pos, line, variants of the wanted lines of documents.

    ``wanted`` has doc_id, text and at: an array of (h1, pos, keys).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in _slices(batch):
                rows = []
                asked = batch.column(2).slice(a, len(texts)).to_pylist()
                ids = batch.column(0).slice(a, len(texts)).to_pylist()
                x = Lines(texts)
                row_of = {(d, p): i for i, (d, p) in enumerate(zip(x.doc.tolist(), x.pos.tolist(), strict=True))}
                line, key, lo, hi = x.block_keys()
                blocks: dict[tuple[int, int], list[tuple[int, int]]] = {}
                for entry in zip(line.tolist(), key.tolist(), lo.tolist(), hi.tolist(), strict=True):
                    blocks.setdefault(entry[:2], []).append(entry[2:])
                for d in range(len(texts)):
                    for w in asked[d]:
                        i = row_of.get((d, w["pos"]))
                        if i is None or int(x.h1[i]) != w["h1"]:  # another row of the same doc_id
                            continue
                        keys = [x.variants(i, *span) for k in w["keys"] for span in blocks.get((i, k), ())]
                        half = [np.split(k, 2) for k in keys]
                        text = x.chars[x.start[i]:x.end[i]].tobytes().decode("utf-32-le", "surrogatepass")
                        rows.append((w["h1"], ids[d], w["pos"], text,
                                     np.unique(np.concatenate([h[0] for h in half] or [np.zeros(0, np.int64)])),
                                     np.unique(np.concatenate([h[1] for h in half] or [np.zeros(0, np.int64)]))))
                names = ["id", "doc_id", "pos", "line", "shorter", "placed"]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names)

    return small_batches(wanted, run, "id long, doc_id long, pos int, line string, "
                                      "shorter array<long>, placed array<long>")


def _keyed(kind: int):
    return lambda v: F.struct(v.alias("v"), F.lit(kind).cast("tinyint").alias("kind"))


def _near(documents: DataFrame, hashed: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h1, h2, doc_id, pos) of first occurrences that have an earlier line within one edit."""
    keyed = hashed.select("h1", F.explode("keys").alias("key"))
    several = keyed.groupBy("key").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x <> y").select("key")
    open_keys = tables.keep(keyed.join(several, "key", "left_semi").distinct(), "keys")
    asked = open_keys.groupBy("h1").agg(F.collect_list("key").alias("keys"))  # a few keys per line
    lines = firsts.join(asked, "h1").select("doc_id", F.struct("h1", "pos", "keys").alias("at"))
    per_doc = tables.keep(lines.groupBy("doc_id").agg(F.collect_list("at").alias("at")), "asked")
    # both grow with the corpus: never a broadcast, the plan is the same at every size
    asking = documents.join(per_doc.hint("merge"), "doc_id").select("doc_id", "text", "at")
    candidates = tables.keep(_variants(asking), "variants")

    here = F.struct("doc_id", "pos", "id").alias("here")
    emitted = candidates.select(here, F.explode(F.concat(*(
        F.transform(values, _keyed(k))
        for k, values in enumerate((F.array("id"), F.col("shorter"), F.col("placed")))))).alias("e")).select("e.v", "e.kind", "here")
    # A key's rows are distinct lines one character away from one text, so its window is short.
    # The partners of a shorter text are the line that is it, and the reverse.
    key = Window.partitionBy("v")
    first = [F.min(F.when(F.col("kind") == k, F.col("here"))).over(key) for k in (1, 0, 2)]
    by = F.when(F.col("kind") == 0, first[0]).when(F.col("kind") == 1, first[1]).otherwise(first[2])
    met = emitted.withColumn("by", by).where("by < here").groupBy("here").agg(F.min("by").alias("by"))
    text = candidates.select("doc_id", "pos", "id", "line")
    pairs = met.select("here.*", F.col("by.doc_id").alias("d"), F.col("by.pos").alias("p"), F.col("by.id").alias("i"))
    mine = pairs.join(text, ["doc_id", "pos", "id"])
    theirs = text.select(F.col("doc_id").alias("d"), F.col("pos").alias("p"), F.col("id").alias("i"), F.col("line").alias("other"))
    return mine.join(theirs, ["d", "p", "i"]).where(F.levenshtein("line", "other", 1) >= 0).select(
        "doc_id", "pos", F.col("id").alias("h1")).distinct()


def dedup_lines(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, n_lines, n_dropped: every document without its repeated lines.

    ``docs`` has doc_id and text; of other columns only those in ``carry`` are kept,
    in a struct ``carried``.  Lines end at line feeds; they are compared without surrounding blanks, character by character.
    A line that is not blank is dropped if an equal line comes earlier in the order of
    (doc_id, line number), a line of at least ``MIN_CHARS`` characters also if the
    first occurrence of a line of that length within one edit does.  A null text has no lines and
    stays null; rows with a null doc_id take no part and stay as they are.
    Rows that repeat a doc_id count as one document.  An empty table gives no rows.
    """
    documents = tables.columns(docs, "doc_id", "text")
    known = documents.where("doc_id IS NOT NULL")
    hashed = tables.keep(_hashed(known), "lines")
    firsts = tables.keep(hashed.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "pos")).alias("at"))
                         .select("h1", "h2", "at.doc_id", "at.pos"), "firsts")
    near = tables.keep(_near(known, hashed, firsts), "near")
    stays = firsts.select("doc_id", "pos", "h1").join(near, ["doc_id", "pos", "h1"], "left_anti")
    per_doc = tables.keep(stays.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "h1")).alias("stays")), "stays")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.column(2)
            known_doc = np.array(batch.column(0).is_valid())
            null = np.array(batch.column(1).is_null())
            for a, texts in _slices(batch):
                out, lines, dropped = [], [], []
                x = Lines(texts)
                mine = kept.slice(a, len(texts))
                flat = mine.flatten()
                sizes = np.diff(mine.offsets.to_numpy())
                pos = flat.field(0).to_numpy(zero_copy_only=False).astype(_U)
                h1 = flat.field(1).to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(_U)
                row = mix(np.repeat(np.arange(len(texts)), sizes).astype(_U))
                held = mix(h1 + mix(pos + _U(1))) ^ row
                drop = ~np.isin(x.occurrence().view(_U) ^ mix(x.doc.astype(_U)), held) & known_doc[a + x.doc]
                gone: dict[int, set[int]] = {}
                for d, p in zip(x.doc[drop].tolist(), x.pos[drop].tolist(), strict=True):
                    gone.setdefault(d, set()).add(p)
                for d, t in enumerate(texts):
                    parts = t.split("\n")
                    cut = gone.get(d, ())
                    lines.append(0 if null[a + d] else len(parts))
                    dropped.append(len(cut))
                    out.append(None if null[a + d] else t if not cut else
                               "\n".join([s for i, s in enumerate(parts) if i not in cut]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, len(texts)), pa.array(out, pa.string()), pa.array(lines, pa.int64()),
                     pa.array(dropped, pa.int64()), batch.column(3).slice(a, len(texts))],
                    ["doc_id", "text", "n_lines", "n_dropped", "carried"])

    none = F.array().cast("array<struct<pos:int,h1:bigint>>")
    extra = F.struct(F.lit(0).alias("_none"), *(F.col(f"`{c}`") for c in carry)).alias("carried")
    rows = docs.select("doc_id", "text", extra)
    joined = rows.join(per_doc.hint("merge"), "doc_id", "left").select("doc_id", "text", F.coalesce("stays", none).alias("stays"), "carried")
    schema = f"doc_id long, text string, n_lines long, n_dropped long, carried {rows.schema['carried'].dataType.simpleString()}"
    return small_batches(joined, run, schema)


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their texts without repeated lines and, if there is
    one, ``n_chars`` as the length of the remaining text; rows whose text lost lines
    and has nothing but blanks left go."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    clean = dedup_lines(docs, others).where("NOT (n_dropped > 0 AND trim(BOTH ' \t\r\n' FROM text) = '')")
    value = {"doc_id": F.col("doc_id"), "text": F.col("text")} | {c: F.col("carried").getField(c) for c in others}
    if "n_chars" in value:
        value["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(value["n_chars"])
    return clean.select(*(value[c].alias(c) for c in docs.columns))
