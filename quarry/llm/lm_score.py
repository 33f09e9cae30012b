"""Language-model scores of documents: learning and scoring on Spark.

The model gives a proper probability: words outside the lexicon are spelled.
The add-one base gives every unknown word the same probability however long it
is, which on a corpus of less than about a million tokens is more than spelling
can; from there on the model's scores of held-out texts are the higher ones.

Learning aggregates the whole corpus: word counts (one row per distinct word,
shuffled), the lexicon of frequent words, context counts as sums of each task's
tables, and the gated weights from statistics summed per gate.  The decisions that
the weights are fitted on are made once: a task keeps the distinct ones (gate,
log-odds, bit) with their numbers, and every Newton step reads those.  Every learning
text is counted and fits the weights: the texts of either half meet the context
counts of the other half, so none is predicted from its own counts; scoring
uses the counts of both.  What reaches
the driver is bounded: at most ``LEXICON`` words, 256 byte counts, tables of
``CONTEXTS * 2 ** MAX_BITS`` bytes, and GATES rows.  Scoring is one map over
all documents; words outside the lexicon get their counts by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import context_mixing as cm
from quarry.llm import tables, texthash
from quarry.llm.byte_bpe import forget_codecs
from quarry.llm.period_runs import split_words

FOLDS, HELD_OUT = 7, 2  # crc32(doc_id) % 7 = 2: never learned from
HALVES = 2  # of the learning texts, by crc32(doc_id) % 49 / 7: weights are fitted on each with the counts of the other
LEXICON = 1 << 16  # most words of the lexicon; all are met at least twice
MIN_BITS, MAX_BITS = 14, 22  # slots of a context table: twice the learning tokens, within these
STEPS = 2  # Newton steps of the weights
BLOCK_SLOTS = 1 << 14  # slots of a table that travel in one row
GROUP = 64  # tasks whose tables are summed first
COUNTED = 1 << 20  # rows of word counts, or of outcomes, that a task sums before it passes them on
KEPT = 1 << 17  # outcomes that are kept in one row
MERGED = 1 << 27  # bytes of text whose outcomes are summed, so that their numbers stay below 2^32
SLICE = 1 << 19  # bytes of text worked on at once
TAIL = pa.list_(pa.struct([("word", pa.string()), ("tf", pa.int64())]))


@dataclass
class Model:
    """What scoring needs; ``words`` holds the count of every learned word."""

    words: DataFrame
    tokens: int
    distinct: int
    ends: int
    bits: int
    weights: np.ndarray
    shared: Broadcast  # (lexicon, log-odds tables)


def _rows(docs: DataFrame) -> DataFrame:
    """Documents with their fold; a null doc_id counts as the empty text (fold 0)."""
    return tables.columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), "text",
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % (FOLDS * FOLDS)).alias("fold"))


def _slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = texthash.text_buffer(column)
    for lo, hi in texthash.slices(offsets, SLICE):
        yield lo, hi, data, offsets[lo:hi + 1]


def _mapped(df: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow whose worker, which lives on for other stages, gives back what Arrow does not use."""
    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_codecs()
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(released, schema)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts, summed over slices while their rows stay below COUNTED."""
    held, rows = [], 0

    def summed() -> list[pa.RecordBatch]:
        if not held:
            return []
        total = pa.Table.from_batches(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
        total = total.select(["word", "n_sum"]).rename_columns(["word", "n"])
        return total.combine_chunks().to_batches()

    for b in batches:
        for _, _, data, offsets in _slices(b["text"]):
            lo, hi = int(offsets[0]), int(offsets[-1])
            words, _ = split_words(cm._FOLD[data[lo:hi]], offsets - lo)
            n = np.bincount(words.indices.to_numpy(zero_copy_only=False), minlength=len(words.dictionary))
            held.append(pa.RecordBatch.from_arrays([words.dictionary.cast(pa.string()), pa.array(n, pa.int64())], ["word", "n"]))
            rows += len(n)
        if rows > COUNTED:
            held = summed()
            rows = sum(len(x) for x in held)
            if rows > COUNTED // 2:  # mostly distinct: further summing gains little
                yield from held
                held, rows = [], 0
    yield from summed()


def _count_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte counts of spelled words, with the closing blank."""
    total = np.zeros(256, dtype=np.int64)
    for b in batches:
        data, offsets = texthash.text_buffer(b["word"])
        n = b["n"].to_numpy()
        part = data[offsets[0]:offsets[-1]]
        total += np.bincount(part, np.repeat(n, np.diff(offsets)), 256).astype(np.int64)
        total[cm.BLANK] += n.sum()
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], ["byte", "n"])


def _threshold(words: DataFrame) -> int:
    """Least count, from 2 on, that at most LEXICON words reach; counts are told apart in sixteenths of an octave."""
    octave = F.floor(F.log2("n") * 16).cast("long")
    total, least = 0, None
    for b, n in sorted(words.where("n >= 2").groupBy(octave.alias("b")).agg(F.count(F.lit(1))).collect(), reverse=True):
        total += n  # at most 16 * 63 rows
        if total > LEXICON:
            break
        least = b
    return 1 << 62 if least is None else max(2, int(np.ceil(2.0 ** (least / 16))))


def _pack(counts: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as do, lowest bytes of all first, behind that number of bytes."""
    small = counts if counts.dtype == np.uint32 or counts.max() >> np.uint64(32) else counts.astype(np.uint32)
    width = small.itemsize
    planes = np.ascontiguousarray(small.view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(data: pa.Buffer, size: int = 2 * BLOCK_SLOTS) -> np.ndarray:
    width = data[0]
    planes = pa.decompress(data.slice(1), size * width, codec="zstd", asbytes=True)
    numbers = np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(width, size).T)
    return numbers.view(f"u{width}").reshape(-1).astype(np.uint64, copy=False)


COUNTS = "context int, block int, team int, counts binary"


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, pa.Buffer]]:
    """Rows of ``COUNTS``; a block stays in the batch's memory."""
    for i, key in enumerate(zip(*(batch[c].to_pylist() for c in range(3)))):
        yield *key, batch[3][i].as_buffer()


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    names = ["context", "block", "team", "counts"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
        (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], names)


def _context_counts(lexicon: Broadcast, bits: int, spelling: bool = False):
    """Tables of a task's texts; with ``spelling`` of the spelled lexicon instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((cm.CONTEXTS, 2 << bits), dtype=np.uint32)
        if spelling:
            cm.count_spelling(total, lexicon.value, bits)
        for b in batches:
            for _, _, data, offsets in _slices(b["text"]) if not spelling else ():
                cm.count(total, lexicon.value, bits, cm.symbols(lexicon.value, data, offsets))
        team = TaskContext.get().partitionId() // GROUP
        for c in range(cm.CONTEXTS):
            blocks = total[c].reshape(-1, 2 * BLOCK_SLOTS)
            for k in np.flatnonzero(blocks.any(axis=1)).tolist():
                yield _packed([(c, k, team, _pack(blocks[k]))])
    return run


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the sorted rows of each (context, block, team), one in memory at a time."""
    key, total = None, None
    for b in batches:
        for c, k, team, data in _blocks(b):
            if (c, k, team) != key:
                if key is not None:
                    yield _packed([(*key, _pack(total))])
                key, total = (c, k, team), _unpack(data).copy()
            else:
                total += _unpack(data)
    if key is not None:
        yield _packed([(*key, _pack(total))])


def _block_odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Log-odds of the sum of each (context, block, team), in one Python process with the adding."""
    for b in _add_counts(batches):
        for c, k, team, data in _blocks(b):
            yield _packed([(c, k, team, cm.odds(_unpack(data)).tobytes())])


def _sum_tables(parts: DataFrame, last=_add_counts) -> DataFrame:
    """Tables of all tasks added up: within teams of tasks first, then over the teams, there by ``last``."""
    for team, add in ((F.col("team"), _add_counts), (F.lit(0), last)):
        by = ["context", "block", "team"]
        parts = _mapped(parts.withColumn("team", team).repartition(*by).sortWithinPartitions(*by), add, COUNTS)
    return parts


OUTCOMES = "size int, outcomes binary"


def _outcomes(shared: Broadcast, bits: int):
    """Distinct outcomes of a task's texts, summed over slices while their rows stay below COUNTED."""
    def rows(found: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(found), KEPT):
            part = found[at:at + KEPT]
            yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int32()), pa.array([_pack(part)], pa.binary())], ["size", "outcomes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, texts = [], 0, 0
        for b in batches:
            lex, model = shared.value
            for _, _, data, offsets in _slices(b["text"]):
                held.append(cm.outcomes(model, lex, bits, cm.symbols(lex, data, offsets)))
                size += len(held[-1])
                texts += int(offsets[-1] - offsets[0])
                if size > 2 * COUNTED or texts > MERGED:
                    held = [cm.merged(held)]
                    size = len(held[0])
                    if size > COUNTED or texts > MERGED:
                        yield from rows(held[0])
                        held, size, texts = [], 0, 0
        if held:
            yield from rows(cm.merged(held))
    return run


def _statistics(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((cm.GATES, cm.CONTEXTS + cm.CONTEXTS ** 2))
        for b in batches:
            for size, data in zip(b["size"].to_pylist(), b["outcomes"]):
                total += cm.statistics(weights, _unpack(data.as_buffer(), size))
        gate, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(gate), pa.array(place), pa.array(total[gate, place])], ["gate", "place", "v"])
    return run


def train(docs: DataFrame) -> Model:
    """Learn from all documents whose crc32(doc_id) % 7 is not 2.

    Null and empty texts are texts of the end token only; without learning
    texts every count is 0 and the weights stay at their start."""
    spark = docs.sparkSession
    rows = _rows(docs).where(F.col("fold") % FOLDS != HELD_OUT)
    words = tables.keep(_mapped(rows.select("text"), _count_words, "word string, n long").groupBy("word")
                        .agg(F.sum("n").alias("n")), "words")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = rows.select("fold").count()
    tokens = total + ends
    often = F.col("n") >= _threshold(words)
    frequent = words.where(often).collect()  # at most LEXICON rows
    letters = np.zeros(256, dtype=np.int64)
    for byte, n in _mapped(words.where(~often), _count_letters, "byte long, n long").groupBy("byte").agg(F.sum("n")).collect():
        letters[byte] = n
    lex = cm.Lexicon([r.word for r in frequent], [r.n for r in frequent], total - sum(r.n for r in frequent), ends, letters)
    bits = min(max(int(2 * tokens).bit_length(), MIN_BITS), MAX_BITS)
    lexicon = spark.sparkContext.broadcast(lex)

    def summed(texts: DataFrame, spelling: bool = False) -> DataFrame:
        return _sum_tables(_mapped(texts.select("text"), _context_counts(lexicon, bits, spelling), COUNTS))

    def shared(*counts: DataFrame) -> Broadcast:
        with tables.cleaned_shuffles(spark):
            found = _sum_tables(reduce(DataFrame.unionByName, counts), _block_odds).collect()
        model = np.zeros((cm.CONTEXTS, 1 << bits), dtype=np.int8)
        for r in found:
            model[r.context].reshape(-1, BLOCK_SLOTS)[r.block] = np.frombuffer(r.counts, dtype=np.int8)
        return spark.sparkContext.broadcast((lex, model))

    halves = [rows.where(F.floor(F.col("fold") / FOLDS) % HALVES == h) for h in range(HALVES)]
    counts = [tables.keep(summed(half), "counts") for half in halves]
    spelled = tables.keep(summed(spark.range(1, numPartitions=1).select(F.lit("").alias("text")), spelling=True), "spelled")
    others = [shared(spelled, *counts[:h], *counts[h + 1:]) for h in range(HALVES)]

    met = tables.keep(reduce(DataFrame.unionByName, [
        _mapped(half.select("text"), _outcomes(other, bits), OUTCOMES)
        for half, other in zip(halves, others, strict=True)]), "outcomes")
    for other in others:
        other.unpersist()

    weights = np.full((cm.GATES, cm.CONTEXTS), cm.START)
    for _ in range(STEPS):
        sums = np.zeros((cm.GATES, cm.CONTEXTS + cm.CONTEXTS ** 2))
        found = _mapped(met, _statistics(weights), "gate long, place long, v double")
        for gate, place, v in found.groupBy("gate", "place").agg(F.sum("v")).collect():
            sums[gate, place] = v
        weights = cm.newton(weights, sums)
    return Model(words, tokens, distinct + (ends > 0), ends, bits, weights, shared(spelled, *counts))


SCORED = ("row long, doc_id long, fold long, n_tokens long, n_frequent long, log_counts double, score double, "
          "tail array<struct<word:string,tf:long>>")


def _score(shared: Broadcast, bits: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lex, model = shared.value
            logs = np.append(np.log10(lex.counts + 1.0), 0.0)
            for lo, hi, data, offsets in _slices(b["text"]):
                s = cm.symbols(lex, data, offsets)
                n = hi - lo
                ids = s.words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                text = np.repeat(np.arange(n), np.diff(s.token_first))
                known = s.lexical[ids]
                log_counts = np.bincount(text, logs[known], n).astype(float)  # of no tokens it is of integers
                rare = known < 0
                pair, tf = np.unique(text[rare] * len(s.words.dictionary) + ids[rare], return_counts=True)
                size = max(len(s.words.dictionary), 1)
                tail = pa.StructArray.from_arrays([s.words.dictionary.take(pa.array(pair % size)).cast(pa.string()),
                                                   pa.array(tf.astype(np.int64))], ["word", "tf"])
                cut = np.searchsorted(pair // size, np.arange(n + 1)).astype(np.int32)
                score = cm.log_probability(weights, model, lex, bits, s) / np.log(10)
                kept = [b[c].slice(lo, n) for c in ("row", "doc_id", "fold")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(np.diff(s.token_first) + 1), pa.array(np.bincount(text[~rare], minlength=n)),
                     pa.array(log_counts), pa.array(score), pa.ListArray.from_arrays(pa.array(cut), tail)],
                    ["row", "doc_id", "fold", "n_tokens", "n_frequent", "log_counts", "score", "tail"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: base and model log10 probabilities of its whole text.

    Columns: doc_id, held_out, n_tokens (words and the end), n_known (tokens met
    while learning), train_tokens, base_score (add-one unigrams), score (the
    mixing model; of the same tokens).  Null and empty texts are the end alone;
    repeated rows each give a row; a null doc_id stays null and is not held out;
    other columns are not read.
    """
    rows = _rows(docs).withColumn("row", F.monotonically_increasing_id())
    scored = tables.keep(_mapped(rows, _score(model.shared, model.bits, model.weights), SCORED), "scored")
    # lexicon words are done; more than LEXICON words are as frequent as any other, so no key of this join is hot
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.tf")
    rest = tail.join(model.words, "word").groupBy("row").agg(
        F.sum("tf").alias("n_rest"), F.sum(F.col("tf") * F.log10(F.col("n") + 1)).alias("log_rest"))
    ends = 1 if model.ends else 0
    zero, nothing = F.lit(0).cast("long"), F.lit(0.0)
    return scored.drop("tail").join(rest, "row", "left").select(
        "doc_id", (F.col("fold") % FOLDS == HELD_OUT).alias("held_out"), "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rest", zero) + ends).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.coalesce("log_rest", nothing) + float(np.log10(model.ends + 1.0))
         - F.col("n_tokens") * float(np.log10(model.tokens + model.distinct + 1.0))).alias("base_score"), "score")
