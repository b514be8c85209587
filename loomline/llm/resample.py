"""Operator 10: data selection by importance resampling.

Hashed n-gram models, in 2^20 buckets, are counted of the raw text (all
documents) and of the target (documents labelled good and not toxic).  Each has
two factors: how often words and word pairs occur, and how many documents hold
a word, which a text that repeats one word cannot distort.  With c the target's
count of a bucket and e the count that the raw model leads to expect, the log
ratio of a bucket is log((c + 1) / (e + 1)), drawn towards 0 by its standard
error: the raw model is the prior of the target model, and a bucket says only
what its counts bear out.

A document's log importance weight is the sum of the factors' log ratios: that
of occurrences for a passage of PASSAGE words, so that long documents are not
judged by their length, and that of documents over all words of the text.

Documents are then sampled without replacement by Gumbel top-k: each log weight
gets Gumbel noise, made from the document's id by hash, and the k largest sums
win.  k is a share of the documents with words; unless given, the share of
labelled ids that are good.  The k-th largest key is found exactly by counting
keys in ever narrower ranges, so nothing is sorted or gathered.

Defined results: a document without words is never selected; ties at the k-th
key are all selected (a repeated row has its copies' key); a null id is hashed
as null; without usable labels the target model is the raw one and every
document with words is selected; an empty table gives an empty result; other
columns pass through, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ngrams import by_slice, count_tables, labelled_sample, word_grams
from .shared import staged, table
from .textkernel import Words

#: Labelled ids that the target model is fitted on, at most; also what is broadcast.
LABELLED_ROWS = 100_000
#: Words of the passage whose occurrences are weighed.
PASSAGE = 200
SEED = 20_24


class Model(NamedTuple):
    ratios: Broadcast  # 2 x 2^20 float32: of occurrences, of documents
    share: float  # to select


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the models in each bucket, drawn towards 0 by one standard error."""
    out = np.zeros(len(raw), np.float32)
    share = target.sum() / max(1, raw.sum())
    for at in range(0, len(raw) if share else 0, 1 << 16):  # small temporaries
        c, e = target[at : at + (1 << 16)] + 1.0, raw[at : at + (1 << 16)] * share + 1.0
        ratio = np.log(c) - np.log(e)
        out[at : at + (1 << 16)] = np.sign(ratio) * np.maximum(0, np.abs(ratio) - np.sqrt(1 / c + 1 / e))
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Count both models over all documents."""
    spark = docs.sparkSession
    # at most LABELLED_ROWS rows of two columns: safe to broadcast at any size of the corpus
    sample = staged(labelled_sample(labels, LABELLED_ROWS).select(F.col("doc_id").alias("_id"), (F.expr("coalesce(quality = 1, false) and coalesce(toxic, 0) = 0")).alias("_good")))
    marked = docs.select(F.col("doc_id"), F.col("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("_id"), "left").select("text", F.coalesce("_good", F.lit(False)).alias("good"))
    raw, target, raw_rows, target_rows = count_tables(marked, "good")
    share = sample.agg(F.avg(F.col("_good").cast("int"))).first()[0] if target.sum() else 1.0
    return Model(spark.sparkContext.broadcast(np.stack([log_ratios(raw, target), log_ratios(raw_rows, target_rows)])), share)


def log_weight(ratios: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Log importance weight of each row; -inf for a row without words."""
    words = Words(data, offsets)
    n, row, one, pair_row, two = len(offsets) - 1, *word_grams(words)
    occurring = np.bincount(row, ratios[0][one], minlength=n) + np.bincount(pair_row, ratios[0][two], minlength=n)
    return np.where(words.counts > 0, PASSAGE * occurring / np.maximum(1, words.counts) + np.bincount(row, ratios[1][one], minlength=n), -np.inf)


def gumbel(key: Column) -> Column:
    """Gumbel noise made from a key: the same whenever a lost task is run again."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(SEED)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def scored(docs: DataFrame, model: Model, weight_as: str, key_as: str) -> DataFrame:
    """docs' columns, then the log weight and the key under these names."""
    columns = docs.columns
    place = columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, weight in by_slice(lambda d, o: log_weight(model.ratios.value, d, o), place)(batches):
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(weight)], [*rows.schema.names, weight_as])

    schema = T.StructType([*docs.schema.fields, T.StructField(weight_as, T.DoubleType())])
    return docs.mapInArrow(score, schema).withColumn(key_as, F.col(weight_as) + gumbel(F.col("doc_id")))


def kth_largest(keys: DataFrame, name: str, k: int) -> float:
    """Exactly the k-th largest of a double column: -inf if k is all rows or more, inf for none.

    Ranges are narrowed 4096-fold a pass by counting; each pass sends at most 4096 counts."""
    if k <= 0:
        return float("inf")
    finite = keys.select(F.col(name).alias("v")).where(F.col("v") > float("-inf"))
    low, high, rows = finite.select(F.min("v"), F.max("v"), F.count("v")).first()
    if k > rows:
        return float("-inf")
    while low < high:
        step = (high - low) / 4096
        if low + step <= low:
            break
        counts = {r.b: r for r in finite.where((F.col("v") >= low) & (F.col("v") <= high)).groupBy(F.least(F.floor((F.col("v") - low) / step), F.lit(4095)).alias("b")).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
        for b in sorted(counts, reverse=True):
            if k <= counts[b].n:
                low, high = counts[b].lo, counts[b].hi
                break
            k -= counts[b].n
    return low


def selection(docs: DataFrame, labels: DataFrame, share: float | None = None) -> tuple[Model, float, DataFrame]:
    """The model, the least key that is selected, and (doc_id, log weight, key) of all rows."""
    model = fit(docs, labels)
    keys = staged(scored(docs.select("doc_id", "text"), model, "log_weight", "key").drop("text"))
    k = round(keys.where(F.col("log_weight") > float("-inf")).count() * (model.share if share is None else share))
    return model, kth_largest(keys, "key", k), keys


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """Selected rows of docs with all their columns."""
    model, least, _ = selection(docs, labels, share)
    weight, key = (f"_{name}_{uuid.uuid4().hex}" for name in ("weight", "key"))  # clash with no column
    out = scored(docs, model, weight, key)
    return out.where((out[key] >= least) & (out[key] > float("-inf"))).drop(weight, key)


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, least, keys = selection(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return keys.where((F.col("key") >= least) & (F.col("key") > float("-inf")))
