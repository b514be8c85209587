"""Hashed n-gram features, and counts of them over a whole table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkernel import Words, flat, mix64, slices

#: log2 of the buckets of each feature table; tables have a fixed size whatever the corpus.
BITS = 20
#: Tables of counts, buckets of each in which partial counts travel (so that places fit 16 bits), and parts that one task adds up.
TABLES = 4
CHUNK = 1 << 14
FAN_IN = 64


def bucket(hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def word_grams(words: Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of each word, its bucket, row of each two-word window, its bucket)."""
    row = words.row()
    at, pairs = words.windows(2)
    return row, bucket(words.hash, bits), row[at], bucket(pairs, bits)


def char_grams(data: np.ndarray, offsets: np.ndarray, n: int, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each run of n characters (code points of UTF-8) inside one row."""
    start = np.flatnonzero((data & 0xC0) != 0x80)
    size = len(start) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length = np.diff(np.append(start, len(data)))
    point = data[start].astype(np.uint64)
    for i in range(1, int(length.max())):
        long = length > i
        point[long] = point[long] << np.uint64(8) | data[start[long] + i]
    packed = np.zeros(size, np.uint64)
    for i in range(n):
        packed = packed * np.uint64(0x9E3779B97F4A7C15) + point[i : i + size]
    row = np.searchsorted(offsets, start, "right") - 1
    same = row[:size] == row[n - 1 :]
    return row[:size][same], bucket(mix64(packed[same]), bits)


def labelled_sample(labels: DataFrame, rows: int) -> DataFrame:
    """At most `rows` labelled ids, those of smallest hash: doc_id, quality, toxic.

    An id with several labels counts as low quality if any says so, and as toxic likewise."""
    one = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def count_tables(docs: DataFrame, flag: str, text: str = "text", bits: int = BITS) -> np.ndarray:
    """Counts of hashed n-grams over all rows (0, 2) and rows whose flag is true (1, 3): of words and
    word pairs as often as they occur (0, 1), of words in as many rows as hold them (2, 3).

    Each task counts into fixed tables and sends their non-zero parts; these
    are added up in levels of FAN_IN, so that no task gets more than FAN_IN
    parts of CHUNK buckets however many tasks there are.  What reaches the
    driver has a fixed size."""
    n = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((TABLES, n), np.int64)
        for batch in batches:
            data, offsets = flat(batch.column(0))
            mark = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
            for a, b in slices(offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                row, one, pair_row, two = word_grams(words, bits)
                held_row, held = distinct_grams(row, one, bits)
                for at, rows, names in ((0, row, one), (0, pair_row, two), (2, held_row, held)):
                    total[at] += np.bincount(names, minlength=n)
                    if mark[a:b].any():
                        total[at + 1] += np.bincount(names[mark[a:b][rows]], minlength=n)
        yield from _rows((c, total[:, c * CHUNK : (c + 1) * CHUNK]) for c in range(max(1, n // CHUNK)))

    parts = docs.select(F.col(text), F.col(flag)).mapInArrow(count, "chunk int, part long, at binary, n binary")
    tasks = docs.rdd.getNumPartitions()
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        parts = parts.withColumn("part", F.col("part") % F.lit(tasks)).groupBy("chunk", "part").applyInArrow(_add_up, "chunk int, part long, at binary, n binary")
    out = np.zeros((TABLES, n), np.int64)
    width = min(CHUNK, n)
    for r in parts.toLocalIterator():  # not all at once: the driver holds the tables and one partition
        out[:, r.chunk * width : (r.chunk + 1) * width] += _dense(r.at, r.n, width)
    return out


def distinct_grams(row: np.ndarray, names: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket), each pair once."""
    key = np.unique(row.astype(np.int64) << bits | names)
    return key >> bits, key & ((1 << bits) - 1)


def _dense(at: bytes, counts: bytes, width: int) -> np.ndarray:
    where = np.frombuffer(at, np.uint16)
    out = np.zeros(TABLES * width, np.int64)
    out[where] = np.frombuffer(counts, np.int64 if len(counts) == 8 * len(where) else np.uint32)
    return out.reshape(TABLES, width)


def _rows(tables: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    for chunk, table in tables:
        where = np.flatnonzero(table.ravel())
        if len(where):
            counts = table.ravel()[where]
            kind = np.uint32 if counts.max() < 1 << 32 else np.int64
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([part], pa.int64()), pa.array([where.astype(np.uint16).tobytes()], pa.binary()), pa.array([counts.astype(kind).tobytes()], pa.binary())], ["chunk", "part", "at", "n"])


def _add_up(group: pa.Table) -> pa.Table:
    total = None
    for at, n in zip(group.column("at"), group.column("n"), strict=True):
        table = _dense(at.as_py(), n.as_py(), CHUNK)
        total = table if total is None else total + table
    batch = next(_rows(iter([(group.column("chunk")[0].as_py(), total)])))
    return pa.Table.from_batches([batch]).set_column(1, "part", group.column("part").slice(0, 1))


def by_slice(score: Callable[[np.ndarray, np.ndarray], list[pa.Array]], column: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, list[pa.Array]]]]:
    """Calls score(bytes, offsets) on bounded slices of one text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for batch in batches:
            data, offsets = flat(batch.column(column))
            for a, b in slices(offsets):
                yield batch.slice(a, b - a), score(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])

    return run
