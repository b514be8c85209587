"""Operator 3: quality rules and a calibrated hashed n-gram classifier.

Rules count, for every whole text, words, code points in words, symbols,
repeated lines and words in repeated three-word windows.  What passes them is
scored by logistic regression over hashed words, word pairs and character
four-grams (2^20 buckets a kind, averaged over the text, so length does not
count), trained on labelled rows and calibrated by Platt's method on rows that
training did not see.  Scoring runs in Arrow batches; the threshold is fixed.

Training takes at most TRAIN_ROWS labelled ids, those of smallest hash, whatever
the lengths of their texts.  Each of them reaches the driver as a vector of at most
TEXT_FEATURES features: of a text with more, those of smallest hash (the same ones in
all texts), scaled to the sum of all.  Everything else, scoring too, covers all
documents and all features.

Defined results: a null or empty text has no words and fails the rules; a null
doc_id is kept as null; repeated rows are each scored; an id with several
labels counts as low quality if any says so; without both classes among the
labels the verdict is that of the rules alone; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ngrams import BITS, by_slice, char_grams, labelled_sample, word_grams
from .shared import staged, table
from .textkernel import Words, mix64, window_hash, window_starts

#: Labelled ids that the classifier is trained and calibrated on, at most.
TRAIN_ROWS = 2000
#: Distinct features of one training text that the fit sees, at most.
TEXT_FEATURES = 3072
CHAR_GRAM = 4
THRESHOLD = 0.5
MIN_WORDS = 50
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
KINDS = 3
SIZE = KINDS << BITS


class Model(NamedTuple):
    weights: Broadcast  # SIZE float32: a fixed size
    slope: float
    offset: float


def repeated_words(words: Words, k: int = 3) -> np.ndarray:
    """Words of each row that lie in a k-word window found twice or more in the row."""
    rows = len(words.offsets) - 1
    starts = window_starts(words.first, k)
    if not len(starts):
        return np.zeros(rows, np.int64)
    row = words.row()
    key = mix64(window_hash(words.hash, starts, k) ^ mix64(row[starts].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for i in range(k):
        covered[starts[twice] + i] = True
    return np.bincount(row[covered], minlength=rows)


def repeated_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    raw, out = data.tobytes(), np.zeros(len(offsets) - 1, np.int64)
    for i in range(len(out)):
        lines = [x for x in raw[offsets[i] : offsets[i + 1]].split(b"\n") if x.split()]
        out[i] = len(lines) - len(set(lines))
    return out


def per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def features(data: np.ndarray, offsets: np.ndarray, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, bucket, n-grams of the row) of each kind."""
    rows = len(offsets) - 1
    row, one, pair_row, two = word_grams(words)
    chars = char_grams(data, offsets, CHAR_GRAM)
    for kind, (where, what) in enumerate(((row, one), (pair_row, two), chars)):
        yield where, what + (kind << BITS), np.maximum(1, np.bincount(where, minlength=rows))


def sketch(name: np.ndarray, value: np.ndarray, most: int = TEXT_FEATURES) -> tuple[bytes, bytes]:
    """At most `most` of one text's features, those of smallest hash, with the sum of all."""
    if len(name) > most:
        keep = np.sort(np.argpartition(mix64(name.astype(np.uint64)), most)[:most])
        name, value = name[keep], value[keep] * np.float32(value.sum() / value[keep].sum())
    return name.tobytes(), value.astype(np.float32).tobytes()


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """label, feature numbers and values of the sample; one row an id."""
    sample = staged(labelled_sample(labels.where("quality is not null"), rows).select(F.col("doc_id").alias("_id"), F.col("quality").alias("_label")))

    most = TEXT_FEATURES

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(data: np.ndarray, offsets: np.ndarray) -> list[list[bytes]]:
            found = [(w, b, (1 / n)[w]) for w, b, n in features(data, offsets, Words(data, offsets))]
            where, what, value = (np.concatenate(x) for x in zip(*found, strict=True))
            key, inverse = np.unique(where * SIZE + what, return_inverse=True)
            total = np.bincount(inverse, value, minlength=len(key)).astype(np.float32)
            cut = np.searchsorted(key // SIZE, np.arange(len(offsets)))
            name = (key % SIZE).astype(np.uint32)
            return [list(x) for x in zip(*(sketch(name[a:b], total[a:b], most) for a, b in zip(cut[:-1], cut[1:], strict=True)), strict=True)] or [[], []]

        for batch, (name, value) in by_slice(of, 0)(batches):
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(name, pa.binary()), pa.array(value, pa.binary())], ["id", "label", "name", "value"])

    # at most `rows` rows of two integers: safe to broadcast at any size of the corpus
    known = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("text", F.col("doc_id").cast("long").alias("id"), F.col("_label").cast("int").alias("label"))
    made = known.mapInArrow(extract, "id long, label int, name binary, value binary")
    return made.groupBy("id").agg(F.min(F.struct("label", "name", "value")).alias("r")).select("id", "r.*")


def fit(docs: DataFrame, labels: DataFrame, epochs: int = 60) -> Model | None:
    """Full-batch logistic regression with Adam; a fifth of the sample calibrates it."""
    made = staged(training_rows(docs, labels))
    # TRAIN_ROWS rows of bounded size
    found = made.orderBy(F.xxhash64("id")).collect()
    y = np.array([r.label for r in found], np.float32)
    held = np.arange(len(found)) % 5 == 4
    if not len(found) or any(len(set(y[m].tolist())) < 2 for m in (held, ~held)):
        return None
    name = np.concatenate([np.frombuffer(r.name, np.uint32) for r in found])
    value = np.concatenate([np.frombuffer(r.value, np.float32) for r in found])
    row = np.repeat(np.arange(len(found), dtype=np.int32), [len(r.name) // 4 for r in found])
    del found
    used, index = np.unique(name, return_inverse=True)
    index = index.astype(np.int32)
    del name
    share = np.where(y > 0, 0.5 / max(1, (y[~held] > 0).sum()), 0.5 / max(1, (y[~held] == 0).sum()))
    w, b = np.zeros(len(used)), 0.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(1, epochs + 1):
        z = np.bincount(row, w[index] * value, minlength=len(y)) + b
        error = np.where(held, 0, share * (1 / (1 + np.exp(-z)) - y))
        g, gb = np.bincount(index, error[row] * value, minlength=len(used)) + 1e-7 * w, error.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix = np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        w -= 0.5 * fix * m / (np.sqrt(v) + 1e-8)
        b -= 0.05 * fix * mb / (np.sqrt(vb) + 1e-8)
    slope, offset = platt(np.bincount(row, w[index] * value, minlength=len(y))[held], y[held])
    table = np.zeros(SIZE, np.float32)
    table[used] = w
    return Model(docs.sparkSession.sparkContext.broadcast(table), slope, offset)


def platt(score: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve through held-out scores, with Platt's softened targets."""
    good, bad = (y > 0).sum(), (y == 0).sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = score.std() or 1.0
    x = np.stack([score / scale, np.ones(len(score))])
    theta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -30, 30)))
        hessian = (x * (p * (1 - p))) @ x.T + 1e-4 * np.eye(2)
        theta -= np.clip(np.linalg.solve(hessian, x @ (p - target) + 1e-4 * (theta - [1, 0])), -2, 2)
    return float(max(theta[0], 1e-6) / scale), float(theta[1])


def judge(docs: DataFrame, model: Model | None) -> DataFrame:
    """Counts, rules and verdict of every document."""

    def of(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        words = Words(data, offsets)
        n, rows = words.counts, len(offsets) - 1
        inside = np.zeros(len(data) + 1, np.int8)
        inside[words.start] += 1
        inside[words.end] -= 1
        chars = per_row((np.cumsum(inside[:-1]) > 0) & ((data & 0xC0) != 0x80), offsets)
        repeats = repeated_words(words)
        failed = (n < MIN_WORDS) | (100 * repeats > 50 * n)
        if model is None:
            p, kept = np.where(failed, 0.0, 1.0), ~failed
        else:
            weights, z = model.weights.value, np.full(rows, 0.0)
            for where, what, total in features(data, offsets, words):
                z += np.bincount(where, weights[what], minlength=rows) / total
            p = 1 / (1 + np.exp(-np.clip(model.slope * z + model.offset, -60, 60)))
            kept = ~failed & (p >= THRESHOLD)
        return [pa.array(x) for x in (n.astype(np.int64), chars, per_row(_SYMBOL[data], offsets), repeated_lines(data, offsets), repeats.astype(np.int64), failed, kept, p)]

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, columns in by_slice(of, 1)(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, p_good double"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op3_ngram_logistic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels")))
