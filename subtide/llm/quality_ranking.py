"""Quality scores by Bradley-Terry ranking of labelled pairs.

1. Each text gives a few shares and lengths: words, lines, signs, capitals, repetition, compression. They are the only input
   of a score; ids, sources, languages and labels are none.
2. A sample of labelled rows, at most ``sample`` by a hash of their id, goes to the driver. Each feature is cut at
   quantiles of the sample into bins; a score is a sum of bin weights.
3. Preference pairs (a row of label 1 over a row of label 0) are drawn, and the weights fitted by the logistic loss of
   the difference of both scores, with a penalty on their size.
4. The cut is the quantile of the sample's scores that puts most labels on the right side. Scores become numbers from 0 to 1
   so that the cut is ``THRESHOLD``.

Features are one row per document and never meet in one place. Null and empty texts have features too, and a score.
Labels that are null, or whose doc_id is null, teach nothing; several labels of one id are several rows. Without both labels in
the sample every score is 0.5. Repeated rows are scored each for itself; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.llm import batch
from subtide.llm.line_quality import text_counts
from subtide.llm.shared import bounded, hash_sample, text_column, written

THRESHOLD = 0.7

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0x80:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = ~(_LETTER | _DIGIT | batch.SPACE)
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:")] = True

FEATURES = [
    "words", "word_length", "symbol_share", "sign_share", "stop_share", "upper_share", "digit_share", "distinct_words", "top_word", "repeat_words", "dup_lines", "line_words", "lines", "compression"
]


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of features for each text."""
    n = len(offsets) - 1
    counts, _ = text_counts(data, offsets)
    found = batch.words(data, offsets)
    hashes, rows = found.hashes(), found.rows()
    words = counts["n_words"].astype(float)
    chars = np.maximum(np.diff(offsets), 1).astype(float)
    kinds = [np.diff(np.concatenate([[0], np.cumsum(table[data])])[offsets]) for table in (_LETTER, _SIGN, _STOP, _UPPER, _DIGIT)]
    letters, signs, stops, uppers, digits = (k.astype(float) for k in kinds)
    order = np.lexsort((hashes, rows))
    new = np.ones(len(order), bool)
    new[1:] = (rows[order][1:] != rows[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    begin = np.flatnonzero(new)
    times = np.diff(np.append(begin, len(order)))
    distinct = np.bincount(rows[order[begin]], minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, rows[order[begin]], times)
    lines = 1.0 + np.diff(np.concatenate([[0], np.cumsum(data == 0x0A)])[offsets])
    some = np.maximum(words, 1)
    packed = [len(zlib.compress(data[a:b].tobytes(), 1)) for a, b in zip(offsets, offsets[1:], strict=False)]
    return np.column_stack(
        [
            np.log1p(words), counts["word_chars"] / some, counts["n_symbols"] / some, (signs - stops) / some, stops / some, uppers / np.maximum(letters, 1), digits / chars, distinct / some,
            top / some, counts["n_repeat_words"] / some, counts["n_dup_lines"] / lines, words / lines, np.log(lines), np.array(packed) / chars,
        ]
    )


def document_features(docs: DataFrame) -> DataFrame:
    """doc_id and an array of features for each document."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for first, data, offsets in batch.runs(rows.column(1)):
                found = text_features(data, offsets)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * len(FEATURES), pa.int32()), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([rows.column(0).slice(first, len(found)), flat], names=["doc_id", "features"])

    return bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_column("text").alias("text")).mapInArrow(emit, "doc_id long, features array<double>")


@dataclass
class Ranking:
    """Bins of each feature, weights of the bins, and the line that turns raw scores into scores."""

    edges: list[np.ndarray]
    weights: list[np.ndarray]
    cut: float
    scale: float

    def raw(self, features: np.ndarray) -> np.ndarray:
        return sum(w[np.searchsorted(e, x, "right")] for e, w, x in zip(self.edges, self.weights, features.T, strict=True))

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.edges:
            return np.full(len(features), 0.5)
        at = np.clip((self.raw(features) - self.cut) / self.scale + np.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)
        return 1 / (1 + np.exp(-at))


def fit_ranking(features: np.ndarray, labels: np.ndarray, bins: int = 24, pairs: int = 200_000, penalty: float = 2e-4, steps: int = 300, seed: int = 7) -> Ranking:
    """Bradley-Terry weights by gradient descent with momentum over drawn pairs."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return Ranking([], [], 0.0, 1.0)
    edges = [np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) for x in features.T]
    places = [np.searchsorted(e, x, "right") for e, x in zip(edges, features.T, strict=True)]
    starts = np.cumsum([0, *(len(e) + 1 for e in edges)])
    columns = np.stack([p + s for p, s in zip(places, starts, strict=False)])
    rng = np.random.default_rng(seed)
    better, worse = rng.choice(good, pairs), rng.choice(bad, pairs)
    weights, first, second = np.zeros(starts[-1]), np.zeros(starts[-1]), np.zeros(starts[-1])
    for step in range(1, steps + 1):
        raw = weights[columns].sum(axis=0)
        pull = 1 / (1 + np.exp(np.clip(raw[better] - raw[worse], -30, 30)))
        own = np.bincount(better, pull, len(labels)) - np.bincount(worse, pull, len(labels))
        slope = penalty * weights - sum(np.bincount(c, own, starts[-1]) for c in columns) / pairs
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        weights -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    raw = weights[columns].sum(axis=0)
    order = np.argsort(raw, kind="stable")
    # Right labels if everything before a place of the order is 0 and the rest 1; a cut lies between different scores.
    right = np.concatenate([[0], np.cumsum(labels[order] == 0)]) + np.concatenate([[0], np.cumsum(labels[order][::-1] == 1)])[::-1]
    ends = np.concatenate([[True], raw[order][1:] != raw[order][:-1], [True]])
    at = int(np.argmax(np.where(ends, right, -1)))
    low, high = raw[order[max(0, at - 1)]], raw[order[min(at, len(order) - 1)]]
    return Ranking(edges, [weights[a:b] for a, b in zip(starts, starts[1:], strict=False)], float((low + high) / 2), float(max(raw.std() / 2, 1e-6)))


def held_out(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 20_000) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Rows whose crc32(doc_id) is 2 modulo 4 never teach."""
    features = written(document_features(docs), "features")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("label IN (0, 1)").where(~held_out("doc_id"))
    taught = hash_sample(known.join(features, "doc_id").select("doc_id", "label", "features"), F.col("doc_id"), sample, known.count())
    x = np.array([r["features"] for r in taught]).reshape(-1, len(FEATURES))
    ranking = fit_ranking(x, np.array([r["label"] for r in taught], np.int64))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            flat = rows.column(2)
            own = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            score = np.round(ranking.score(own), 9)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"]
            )

    return features.select("doc_id", held_out("doc_id").alias("held_out"), "features").mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")
