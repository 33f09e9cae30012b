"""Operator 4: token ids in ORC files.

One row per document in ascending ``doc_id`` order: files are ranges of
``doc_id``, rows are sorted inside a file.  ORC stores the ids with its integer
run-length encoding, keeps row indexes (minimum and maximum per row group) and
Bloom filters on ``doc_id``; a reader prunes stripes and row groups by
``doc_id``, and Spark reads the stripes of a file in parallel.

``start`` (ids of all documents before a document) needs no global sort: a file
records the ids before each document in its own part, and the parts' totals,
one number per file, are summed up when reading.
"""

from __future__ import annotations

import functools
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm import tables
from quarry.llm.byte_bpe import MARKS, MEMO_CHARS, MEMO_PIECES, small_batches

ORC_OPTIONS = {
    "orc.compress": "ZSTD",
    "orc.stripe.size": str(16 << 20),
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
#: Mark of a word's last token in tokenizer files, and words encoded in one call.
WORD_END, TOGETHER = "</w>", 200
#: A mark at the end of a part, after a letter that stays one letter: a token of its own, as if a blank came before.
LAST_MARK = "([A-Za-z])([" + "".join(MARKS) + "])( |$)"
SCHEMA = "doc_id long, n_tokens long, ids array<int>, part int, part_start long"


def _letters(word: str) -> bool:
    """Letters only, also as the tokenizer sees them: composed and in lower case (``İ`` becomes i and a dot)."""
    return word.isascii() and word.isalpha() or unicodedata.normalize("NFC", word).lower().isalpha() and word.lower().isalpha()


class Encoder:
    """Ids (little-endian unsigned 32-bit) of a text by a tokenizer file whose
    splitter drops blanks, so that parts between blanks are encoded apart.

    The parts met before are remembered; the others of a batch go to the library together.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a word
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.memo: dict[str, bytes] = {}
        self.marks = {m: self._each([m])[0] for m in MARKS}

    def _each(self, parts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _ids(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of each part.  Words of letters only are encoded many at a time,
        with blanks between, and told apart by the ids that end a word."""
        words, out = [p for p in parts if _letters(p)], {}
        groups = [words[i:i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        for group, raw in zip(groups, self._each([" ".join(g) for g in groups]), strict=True):
            cuts = [0, *(4 * np.flatnonzero(self.ends[np.frombuffer(raw, dtype="<u4")]) + 4).tolist()]
            if len(cuts) == len(group) + 1 and cuts[-1] == len(raw):
                out |= {w: raw[a:b] for w, a, b in zip(group, cuts, cuts[1:], strict=False)}
        others = [p for p in parts if p not in out]
        return out | dict(zip(others, self._each(others), strict=True))

    def _lookup(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts, from those met before or the library."""
        memo = self.memo
        if len(memo) > MEMO_PIECES:
            memo.clear()
        memo[""] = b""
        ids = [*map(memo.get, parts)]
        missed = [i for i, found in enumerate(ids) if found is None]
        if not missed:
            return ids
        new = {parts[i] for i in missed}
        joined = [p for p in new if p[-1] in MARKS and _letters(p[:-1])]  # a word, then a mark of its own
        new.difference_update(joined)
        new.update(w for p in joined if (w := p[:-1]) not in memo)
        fresh = [*new]
        found = self._ids(fresh)
        once = {p: (found[p[:-1]] if p[:-1] in found else memo[p[:-1]]) + self.marks[p[-1]] for p in joined}
        once |= {p: found.pop(p) for p in fresh if len(p) > MEMO_CHARS}
        for i in missed:
            p = parts[i]
            ids[i] = once[p] if p in once else found[p]
        memo |= found
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids per text); a null text has none.

        Marks after a letter become parts, so that a word is one part with and without
        them.  The parts of all texts are numbered as they are distinct, so each distinct
        part is looked up once; the ids are then gathered by these numbers."""
        spaced = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        lists = pc.split_pattern(pc.replace_substring_regex(spaced, LAST_MARK, r"\1 \2\3"), " ")
        parts = lists.flatten().dictionary_encode()
        found = self._lookup(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) // 4
        each = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends])),
                                             pa.array(np.frombuffer(b"".join(found), dtype="<u4")))
        taken = each.take(parts.indices)
        ends = taken.offsets.to_numpy()[np.cumsum(lists.value_lengths().to_numpy())]  # a text has one part at least
        return taken.flatten().to_numpy(), np.diff(ends, prepend=0)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_ids(docs: DataFrame, tokenizer_path: str, out: str, end_id: int) -> None:
    """Write every document's ids, ``end_id`` last, to ORC files in ``out``.

    ``docs`` has doc_id and text (other columns are ignored).  A null text holds
    only ``end_id``; null doc_ids come first; repeated doc_ids are ordered by a
    hash of their text; an empty table writes an empty folder of the same schema.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part, start = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values, sizes = e.encode(batch.column(1))
            values = np.insert(values, np.cumsum(sizes), end_id).astype("<i4")
            sizes = sizes + 1
            ends = np.cumsum(sizes)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), ids, pa.array(np.full(len(sizes), part, np.int32)),
                 pa.array(start + ends - sizes)], ["doc_id", "n_tokens", "ids", "part", "part_start"])
            start += int(ends[-1])

    rows = tables.columns(docs, "doc_id", "text").withColumn("_tie", F.xxhash64("text"))
    spark = docs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = rows.repartitionByRange(n, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")
    writer = small_batches(ordered, run, SCHEMA).write
    for k, v in ORC_OPTIONS.items():
        writer = writer.option(k, v)
    writer.orc(out)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of the files in ``path``; filters on doc_id reach the files."""
    stored = spark.read.schema(SCHEMA).orc(path)
    totals = stored.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("total"))
    # one row per file
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    return stored.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def with_crc(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (unsigned, over the ids as little-endian 32-bit integers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            offsets = ids.offsets.to_numpy()
            values = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return small_batches(tokens.select("doc_id", "start", "n_tokens", "ids"), run,
                         "doc_id long, start long, n_tokens long, ids_crc32 long")
