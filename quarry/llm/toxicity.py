"""Operator 1: toxicity grades by cumulative-link ordinal regression.

Sparse features of a text are its distinct words and the beginnings of those
words (4 and 5 characters), hashed; a beginning counts once per distinct word.
One weight vector is shared by all thresholds,

    P(grade <= j) = sigmoid(threshold_j - weights . features),

so the score moves a text along one ordered scale.  The output is the expected
severity, the sum of j * P(grade = j).

The model is fitted on a bounded sample of labelled documents (``MAX_ROWS``,
the smallest hashes of doc_id, and ``MAX_FEATURES``) by proximal gradient steps with an L1 penalty;
scoring covers every document.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import tables
from quarry.llm.byte_bpe import forget_codecs, small_batches

#: Bound of the labelled sample the model is fitted on.
MAX_ROWS = 8000
#: Features of all sampled documents together (four bytes each on the driver).
MAX_FEATURES = 20_000_000
FEATURES = 1 << 20
STEPS = 300
#: L1 penalty on the mean loss.
PENALTY = 2e-4
#: Features must occur in this many sampled documents, and separate grade 0 from the rest by as many deviations.
MIN_DOCS, MIN_Z = 4, 4.0
#: A text is toxic if grade 1 or more has at least this probability.
TOXIC_FROM = 0.2
MEMO_WORDS = 500_000
_WORD = re.compile(r"\w+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of one distinct word: itself and its beginnings."""
    names = [word] + [f"^{word[:n]}" for n in (4, 5) if len(word) > n]
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) % FEATURES for x in names)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    """Weights by feature and ascending thresholds; no thresholds: every text has grade 0."""

    weights: dict[int, float] = field(default_factory=dict)
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j) for every text and threshold."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def fit(features: list[np.ndarray], grades: np.ndarray) -> OrdinalModel:
    """Fit on the feature ids of each text (repeats count) and grades 0, 1, ..."""
    levels = int(grades.max(initial=0)) + 1
    if levels < 2 or not (grades == 0).any():
        return OrdinalModel()
    n0, n1 = document_counts(features, grades > 0)
    t1, t0 = (grades > 0).sum(), (grades == 0).sum()
    rate = (n0 + n1) / (t0 + t1)
    z = (n1 / t1 - n0 / t0) / np.sqrt(np.maximum(rate * (1 - rate) * (1 / t0 + 1 / t1), 1e-12))
    ids = np.flatnonzero((n0 + n1 >= MIN_DOCS) & (np.abs(z) >= MIN_Z))
    if not len(ids):
        return OrdinalModel()
    number = np.full(FEATURES, -1, dtype=np.int32)
    number[ids] = np.arange(len(ids))
    used = [number[f][number[f] >= 0] for f in features]
    row, column = np.repeat(np.arange(len(used)), [len(u) for u in used]), np.concatenate(used)
    return _proximal(row, column, ids, grades, levels)


def document_counts(features: list[np.ndarray], second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts that hold each feature, among those not in ``second`` and those in it."""
    counts = np.zeros((2, FEATURES), dtype=np.int32)
    for f, k in zip(features, second.astype(int), strict=True):
        counts[k, np.unique(f)] += 1
    return counts[0], counts[1]


def _thresholds(gaps: np.ndarray) -> np.ndarray:
    """Ascending thresholds: the first, then positive steps exp(gap)."""
    return np.cumsum(np.concatenate([gaps[:1], np.exp(np.clip(gaps[1:], -5, 3))]))


def _proximal(row: np.ndarray, column: np.ndarray, ids: np.ndarray, grades: np.ndarray, levels: int) -> OrdinalModel:
    """Accelerated proximal gradient on the mean log-likelihood.

    Step sizes are per feature, from the bound mean_i x_ij * (sum_k x_ik) / 2
    of the curvature.
    """
    share = 1.0 / len(grades)
    per_row = np.bincount(row, minlength=len(grades)) + 2  # the thresholds move the score too
    curve = np.bincount(column, weights=per_row[row] * share, minlength=len(ids)) / 2
    top, bottom = grades + 1 < levels, grades > 0
    w = ahead = np.zeros(len(ids))
    gaps, t = np.ones(levels - 1), 1.0
    for _ in range(STEPS):
        theta = _thresholds(gaps)
        eta = np.bincount(row, weights=ahead[column], minlength=len(grades))
        upper = np.where(top, _sigmoid(theta[np.minimum(grades, levels - 2)] - eta), 1.0)
        lower = np.where(bottom, _sigmoid(theta[np.maximum(grades - 1, 0)] - eta), 0.0)
        p = np.maximum(upper - lower, 1e-12)
        slope = share * (upper + lower - 1)  # d log P / d eta
        new = ahead + np.bincount(column, weights=slope[row], minlength=len(ids)) / curve
        new = np.sign(new) * np.maximum(np.abs(new) - PENALTY / curve, 0)
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
        pull = np.bincount(np.minimum(grades, levels - 2), weights=np.where(top, share * upper * (1 - upper) / p, 0),
                           minlength=levels - 1)
        pull -= np.bincount(np.maximum(grades - 1, 0), weights=np.where(bottom, share * lower * (1 - lower) / p, 0),
                            minlength=levels - 1)
        tail = np.cumsum(pull[::-1])[::-1]
        # curvature of the first threshold is at most 1/2, of a gap as much times exp(gap)^2
        gaps = gaps + np.concatenate([tail[:1], tail[1:] / np.exp(np.clip(gaps[1:], -5, 3))])
    kept = np.flatnonzero(w)
    return OrdinalModel({int(i): float(x) for i, x in zip(ids[kept], w[kept], strict=True)}, _thresholds(gaps))


def sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> list:
    """(doc_id, toxic, features) of at most ``max_rows`` labelled documents, by doc_id hash.

    A repeated doc_id gives one row, of the text whose features are the greatest as bytes.
    Documents beyond ``max_features`` features in all, in the order of the hash, are not sampled.
    """
    known = tables.columns(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    chosen = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = tables.columns(docs, "doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array([i for w in sorted(words_of(t)) for i in word_features(w)], dtype="<i4").tobytes()
                     for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())],
                                             ["doc_id", "toxic", "features"])

    found = small_batches(texts.select("doc_id", "toxic", "text"), run, "doc_id long, toxic int, features binary")
    rows = tables.keep(found.groupBy("doc_id", "toxic").agg(F.max("features").alias("features")), "labelled")
    sizes = rows.select("doc_id", F.xxhash64("doc_id").alias("h"), (F.length("features") / 4).cast("long").alias("n")).collect()
    sizes.sort(key=lambda r: (r.h, r.doc_id))
    total = np.cumsum([r.n for r in sizes])
    if len(sizes) and total[-1] > max_features:
        last = sizes[int(np.searchsorted(total, max_features, side="right"))]  # the first that is too much
        h = F.xxhash64("doc_id")
        rows = rows.where((h < last.h) | ((h == last.h) & (F.col("doc_id") < last.doc_id)))
    return sorted(rows.collect(), key=lambda r: r.doc_id)


def severity_grades(toxic: np.ndarray, features: list[np.ndarray], levels: int = 3) -> np.ndarray:
    """Ordered grades from 0/1 labels: 0 if not toxic, else 1..levels by how many
    features it has that at least 20 times as large a share of toxic texts has
    (equal shares of the toxic texts per grade, ties to the lower one)."""
    toxic = toxic.astype(np.int64)
    if not toxic.any() or toxic.all():
        return toxic
    n0, n1 = document_counts(features, toxic > 0)
    telling = (n1 >= MIN_DOCS) & (n1 / toxic.sum() >= 20 * (n0 + 1) / (len(toxic) - toxic.sum()))
    count = np.array([telling[f].sum() for f in features])
    edges = np.quantile(count[toxic > 0], np.arange(1, levels) / levels)
    return np.where(toxic > 0, 1 + np.searchsorted(edges, count, side="left"), 0)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> OrdinalModel:
    """Model of the labelled documents; labels has doc_id and toxic (0 or 1)."""
    rows = sample(docs, labels, max_rows)
    if not rows:
        return OrdinalModel()
    features = [np.frombuffer(r.features, dtype="<i4") for r in rows]
    return fit(features, severity_grades(np.array([r.toxic > 0 for r in rows]), features))


class Scorer:
    """Scores texts by a model, remembering the weight of every word met."""

    def __init__(self, model: OrdinalModel) -> None:
        self.model, self.memo = model, {}

    def _weight(self, word: str) -> float:
        get = self.model.weights.get
        if len(self.memo) >= MEMO_WORDS:
            self.memo.clear()
        total = self.memo[word] = sum([get(i, 0.0) for i in word_features(word)])
        return total

    def above(self, texts: Iterable[str | None]) -> np.ndarray:
        """P(grade > j) for every text and threshold."""
        memo, scores = self.memo, []
        for text in texts:
            words = words_of(text or "")
            # summed in a fixed order, so that equal texts have equal scores
            found = [x for w in words if (x := memo[w] if w in memo else self._weight(w))]
            scores.append(float(np.sum(np.sort(found))) if found else 0.0)
        return self.model.above(np.array(scores))

    def toxic(self, above: np.ndarray) -> np.ndarray:
        return above[:, 0] >= TOXIC_FROM if above.shape[1] else np.zeros(len(above), dtype=bool)


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id, expected_severity, grade (most likely), toxic for every document.

    ``docs`` has doc_id and text, other columns are ignored.  ``toxic`` means that
    P(grade >= 1) is at least ``TOXIC_FROM``.  A null or empty text has no
    features and is scored as such; repeated rows give repeated rows; without
    usable labels (``train`` found fewer than two grades) every document has
    severity 0; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            above = scorer.above(batch.column(1).to_pylist())
            ends = np.ones((len(above), 1))
            edges = np.concatenate([ends, above, 0 * ends], axis=1)
            grade = (edges[:, :-1] - edges[:, 1:]).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.round(above.sum(axis=1), 6)), pa.array(grade.astype(np.int32)),
                 pa.array(scorer.toxic(above))], ["doc_id", "expected_severity", "grade", "toxic"])

    return small_batches(tables.columns(docs, "doc_id", "text"), run,
                         "doc_id long, expected_severity double, grade int, toxic boolean")


def without_toxic(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The rows of ``docs`` whose texts are not toxic; nothing is shuffled."""
    scorer = Scorer(model)

    @F.pandas_udf("boolean")
    def toxic(texts: pd.Series) -> pd.Series:
        forget_codecs()
        return pd.Series(scorer.toxic(scorer.above(texts)), dtype=bool)

    return docs.where(~toxic(F.col("`text`")))
