"""Retrieval pipeline: pages to articles to chunks to vectors to answers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.vectors import embed, hash_embed, matrix
from loomline.operators.chunkers import Config, chunk_documents
from loomline.operators.warehouse import rag_prompt, unprocessed_articles, vector_search


def chunk_and_embed(articles: DataFrame, kind: str = "sentence", config: Config | None = None, dimensions: int = 1024, load: Callable | None = None) -> DataFrame:
    """article_chunks rows of every article, in one plan without a shuffle."""
    chunks = chunk_documents(articles.select("id", "content"), kind, config, "id", "content")
    vector = embed(F.col("content"), dimensions, load)
    return chunks.select(
        F.sha2(F.concat_ws("/", F.col("id").cast("string"), F.col("chunk_index").cast("string")), 256).alias("id"), F.col("id").alias("article_id"), "content", F.md5("content").alias("content_hash"),
        vector.alias("embedding"), "chunk_index", F.length("content").alias("chunk_size"), F.to_json("metadata").alias("metadata"),
    )


def process_new(articles: DataFrame, chunks: DataFrame, limit: int | None = None, **settings: object) -> DataFrame:
    """Chunks to append for articles that have none yet."""
    return chunk_and_embed(unprocessed_articles(articles, chunks, limit), **settings)


def answer(question: str, chunks: DataFrame, articles: DataFrame, generate: Callable[[str], str], dimensions: int, limit: int = 5, encode: Callable | None = None) -> dict:
    """Answer with its sources; only the k best rows reach the driver. Raises LookupError if nothing is found."""
    vector = [float(x) for x in (encode or (lambda texts: hash_embed(texts, dimensions)))([question])[0]]
    row = rag_prompt(vector_search(chunks, articles, vector, limit, None), question).first()
    if row is None or not row.sources:
        raise LookupError("no chunk found")
    return {"answer": generate(row.prompt), "sources": row.sources}


#: Vectors and queries of a cell of a search, at most (about); pairs of a slice whose likeness is computed at once.
ROWS, QUERIES, SLICE = 65_536, 4_096, 65_536
#: What a single-precision product of unit vectors may be off by.
MARGIN = 1e-4


def lsh_index(chunks: DataFrame, bits: int = 12, tables: int = 8, dimensions: int = 64, seed: int = 7) -> DataFrame:
    """(id, embedding, buckets): the random-hyperplane bucket of every vector in each table, an approximate index for cosine search.

    One matrix product an Arrow batch gives the signs for all tables; every vector is indexed."""
    planes = np.random.default_rng(seed).normal(size=(dimensions, tables * bits)).astype(np.float32)

    @F.arrow_udf("array<int>")
    def buckets(lists: pa.Array) -> pa.Array:
        _, vectors = matrix(lists, dimensions)
        signs = (vectors @ planes >= 0).reshape(len(vectors), tables, bits)
        found = (signs << np.arange(bits)).sum(axis=2).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1) * tables, pa.int32()), pa.array(found.ravel()))

    whole = chunks.where(F.col("id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") == dimensions)).select("id", "embedding")
    return whole.withColumn("buckets", buckets("embedding"))


class _Vectors:
    """Vectors of a cell, with what comparisons need: lengths as `cosine` computes them, single-precision unit vectors, buckets."""

    def __init__(self, lists: pa.ChunkedArray, buckets: pa.ChunkedArray, dimensions: int, tables: int):
        lists = lists.combine_chunks()
        self.exact = matrix(lists, dimensions)[1].astype(np.float64)
        self.lacking = pc.is_null(lists.flatten()).to_numpy(zero_copy_only=False).reshape(-1, dimensions).any(axis=1)  # a component is null
        self.buckets = matrix(buckets, tables)[1]
        with np.errstate(all="ignore"):
            self.length = np.sqrt(_summed(self.exact, self.exact))
            unit = self.exact / self.length[:, None]
        self.odd = ~np.isfinite(self.length) & ~self.lacking  # likeness may be NaN, which sorts first
        self.unit = np.where(np.isfinite(unit).all(axis=1)[:, None] & ~self.lacking[:, None], unit, 0).astype(np.float32)
        # so short that their products vanish: looked at whatever the estimate
        self.odd |= ~self.lacking & ((self.length < 1e-140) | (self.length > 1e140)) & (self.exact != 0).any(axis=1)


def _summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed from the first component on as `dot` does."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def _likeness(q: _Vectors, v: _Vectors, which: np.ndarray, what: np.ndarray) -> np.ndarray:
    """`cosine` of pairs, bit by bit."""
    out = np.zeros(len(which))
    for at in range(0, len(which), SLICE):
        i, j = which[at : at + SLICE], what[at : at + SLICE]
        with np.errstate(all="ignore"):
            dots, norm = _summed(q.exact[i], v.exact[j]), v.length[j] * q.length[i]
            found = np.where((norm > 0) | np.isnan(norm), dots / norm, 0.0)
        out[at : at + SLICE] = np.where(q.lacking[i] | v.lacking[j], 0.0, found)
    return out


def _places(which: np.ndarray) -> np.ndarray:
    """For each of sorted numbers, how many of the same come before."""
    return np.arange(len(which)) - np.searchsorted(which, which)


def _best(q: _Vectors, v: _Vectors, first: int, stop: int, order: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, likeness) of the best `limit` vectors that share a bucket with each query of first to stop.

    Products in single precision rule out vectors that cannot be among the best so far; only for the
    others are buckets compared and likeness computed, so what is held is a block's pairs at most."""
    which, what, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    least, at, step = np.full(stop - first, -np.inf, np.float32), 0, 512
    while at < len(v.unit):
        to = min(at + step, len(v.unit))
        near = q.unit[first:stop] @ v.unit[at:to].T
        near[:, v.odd[at:to]] = np.inf
        near[q.odd[first:stop]] = np.inf
        i, j = np.nonzero(near >= least[:, None])
        alike = np.zeros(len(i), bool)
        for table in range(q.buckets.shape[1]):
            rest = np.flatnonzero(~alike)
            alike[rest] = q.buckets[i[rest] + first, table] == v.buckets[j[rest] + at, table]
        i, j = i[alike], j[alike]
        rough = near[i, j]
        by = np.lexsort((-rough, i))
        i, j, rough = i[by], j[by], rough[by]
        place = _places(i)
        last = np.full(stop - first, -np.inf, np.float32)
        last[i[place == limit - 1]] = rough[place == limit - 1] - MARGIN
        kept = rough >= last[i]
        i, j = i[kept] + first, j[kept] + at
        which, what, score = np.concatenate((which, i)), np.concatenate((what, j)), np.concatenate((score, _likeness(q, v, i, j)))
        value = np.where(np.isnan(score), np.inf, score)  # NaN before all others, as Spark sorts
        by = np.lexsort((order[what], -value, which))
        which, what, score, value = which[by], what[by], score[by], value[by]
        place = _places(which)
        full = place == limit - 1
        least[which[full] - first] = value[full] - MARGIN
        which, what, score = which[place < limit], what[place < limit], score[place < limit]
        at, step = to, 4096
    return which, what, score


def lsh_search(index: DataFrame, queries: DataFrame, limit: int = 10, bits: int = 12, tables: int = 8, dimensions: int = 64, seed: int = 7) -> DataFrame:
    """(query_id, id, similarity, rank): best `limit` among vectors that share a bucket with queries(id, embedding).

    Vectors and queries are dealt into parts of bounded size, and each pair of parts is a group that gives `limit`
    rows a query: pairs that share a bucket, most of all pairs where buckets are few, are never rows."""
    q = lsh_index(queries, bits, tables, dimensions, seed)
    kind, mine = dict(q.dtypes)["id"], dict(index.dtypes)["id"]
    cores = index.sparkSession.sparkContext.defaultParallelism
    parts, asked = max(2 * cores, -(-index.count() // ROWS)), max(1, -(-q.count() // QUERIES))

    def part(column: str, n: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def compared(held: pa.Table, wanted: pa.Table) -> pa.Table:
        found = []
        if held.num_rows and wanted.num_rows:
            ids, order = held["id"].combine_chunks(), pc.rank(held["id"].combine_chunks(), tiebreaker="dense").to_numpy().astype(np.int64)
            v, a = (_Vectors(t["embedding"], t["buckets"], dimensions, tables) for t in (held, wanted))
            most = limit * int(np.bincount(order).max())  # an id may be there several times
            for first in range(0, len(a.unit), 256):
                which, what, score = _best(a, v, first, min(first + 256, len(a.unit)), order, most)
                found.append(pa.table([wanted["id"].combine_chunks().take(pa.array(which)), ids.take(pa.array(what)), pa.array(score)], ["query_id", "id", "similarity"]))
        return pa.concat_tables(found) if found else pa.table([wanted["id"].slice(0, 0), held["id"].slice(0, 0), pa.array([], pa.float64())], ["query_id", "id", "similarity"])

    held = index.select(part("id", parts).alias("part"), every(asked).alias("asked"), "id", "embedding", "buckets")
    wanted = q.select(every(parts).alias("part"), part("id", asked).alias("asked"), "id", "embedding", "buckets")
    near = held.groupBy("part", "asked").cogroup(wanted.groupBy("part", "asked")).applyInArrow(compared, f"query_id {kind}, id {mine}, similarity double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= limit)
