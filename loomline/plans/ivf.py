"""An inverted file for cosine search: vectors by cell, binary codes, exact likeness for few.

Vectors are written in partitions by their nearest of `cells` centroids, which are
fitted on a bounded sample; each has a binary code, the signs of its products with
fixed random directions.  A search reads the partitions of the nearest `probe`
cells only (partition pruning), ranks what is there by differing code bits, and
computes the likeness of the nearest `share` of all vectors by code, a number of
bits that is found for each query on the sample's codes.

Bounds: centroids, directions and the sample's codes (SAMPLE rows of BITS / 8 bytes) go
to every task; their sizes do not grow with the table.  A cell that holds a third
of all rows is many blocks, each a row and each met by blocks of at most QUERIES queries.

Vectors that are null, of another length or zero are not in the index; repeated ids are
repeated rows of a result; no vectors give an empty index and empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.functions.vectors import cosine_to, matrix

#: Vectors that centroids and code distances are fitted on, at most.
SAMPLE = 8192
BITS = 256
#: Vectors of a block, and queries of one.
ROWS, QUERIES = 2048, 256


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-30)


def fitted(sample: np.ndarray, cells: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Unit centroids of unit vectors by spherical k-means."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.permutation(len(sample))[:cells]].copy()
    for _ in range(rounds):
        nearest = (sample @ centroids.T).argmax(axis=1)
        for j in range(len(centroids)):
            if (nearest == j).any():
                centroids[j] = sample[nearest == j].mean(axis=0)
        centroids = unit(centroids)
    return centroids


def codes(vectors: np.ndarray, seed: int = 11) -> np.ndarray:
    """BITS signs of each vector, as 64-bit words."""
    planes = np.random.default_rng(seed).normal(size=(vectors.shape[1], BITS)).astype(np.float32)
    return np.packbits(vectors @ planes >= 0, axis=1).view(np.uint64)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of every code of a from every code of b."""
    out = np.zeros((len(a), len(b)), np.int16)
    for word in range(a.shape[1]):
        out += np.bitwise_count(a[:, word, None] ^ b[None, :, word])
    return out


def build(chunks: DataFrame, path: str, dimensions: int, cells: int = 16, sample: int = SAMPLE) -> None:
    """Write the index of chunks(id, embedding) under path."""
    spark = chunks.sparkSession
    whole = chunks.where(F.col("embedding").isNotNull() & (F.size("embedding") == dimensions) & F.exists("embedding", lambda x: x != 0)).select("id", "embedding")
    some = np.array([r.embedding for r in whole.orderBy(F.xxhash64("id")).limit(sample).select("embedding").collect()], np.float32).reshape(-1, dimensions)
    centroids = fitted(unit(some), cells) if len(some) else some

    @F.arrow_udf("int")
    def cell(lists: pa.Array) -> pa.Array:
        return pa.array((unit(matrix(lists, dimensions)[1]) @ centroids.T).argmax(axis=1).astype(np.int32))

    # rebalanced: a large cell is several files, a small one does not become many
    placed = whole.withColumn("cell", cell("embedding") if len(some) else F.lit(0)).hint("rebalance", "cell")
    placed.write.partitionBy("cell").parquet(f"{path}/vectors")
    fit = [(dimensions, centroids.astype(np.float32).tobytes(), codes(unit(some)).tobytes())] if len(some) else []
    spark.createDataFrame(fit, "dimensions int, centroids binary, codes binary").coalesce(1).write.parquet(f"{path}/fit")


class Index:
    """An index that build() has written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        fit = spark.read.parquet(f"{path}/fit").first()
        self.dimensions = fit.dimensions if fit else 0
        self.centroids = np.frombuffer(fit.centroids, np.float32).reshape(-1, fit.dimensions) if fit else np.zeros((0, 1), np.float32)
        self.sample = np.frombuffer(fit.codes, np.uint64).reshape(-1, BITS // 64) if fit else np.zeros((0, BITS // 64), np.uint64)
        self.vectors = spark.read.schema("id " + (dict(spark.read.parquet(f"{path}/vectors").dtypes)["id"] if fit else "long") + ", embedding array<float>, cell int").parquet(f"{path}/vectors")

    def cells_of(self, vectors: np.ndarray, probe: int) -> np.ndarray:
        return np.argsort(-(unit(vectors) @ self.centroids.T), axis=1, kind="stable")[:, :probe].astype(np.int32)

    def nearest(self, vector: list[float], limit: int = 10, probe: int = 12) -> DataFrame:
        """id, similarity of the best `limit` vectors in the nearest cells: other partitions are not read."""
        cells = self.cells_of(np.array([vector], np.float32), probe)[0].tolist() if len(self.centroids) else []
        scored = self.vectors.where(F.col("cell").isin(cells)).select("id", cosine_to(F.col("embedding"), vector).alias("similarity"))
        return scored.orderBy(F.desc("similarity"), "id").limit(limit)

    def search(self, queries: DataFrame, limit: int = 10, probe: int = 12, share: float = 0.12) -> DataFrame:
        """query_id, id, similarity, rank for queries(id, embedding); compared: the vectors of a query whose likeness was computed, up to its row."""
        centroids, sample, dimensions = self.centroids, self.sample, self.dimensions
        kind, mine = dict(queries.dtypes)["id"], dict(self.vectors.dtypes)["id"]

        def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Blocks of queries for each cell: ids, vectors, and the most bits that each looks at."""
            for batch in batches:
                for at in range(0, batch.num_rows, QUERIES):
                    part = batch.slice(at, QUERIES)
                    kept, vectors = matrix(part.column(1), dimensions)
                    if not len(vectors):
                        continue
                    vectors = unit(vectors.astype(np.float32))
                    cells = np.argsort(-(vectors @ centroids.T), axis=1, kind="stable")[:, :probe]
                    reach = np.quantile(apart(codes(vectors), sample), share, axis=1).astype(np.int16)
                    ids = part.column(0).take(pa.array(kept))
                    rows = [(int(c), ids.filter(pa.array(m := (cells == c).any(axis=1))), vectors[m].tobytes(), reach[m].tobytes()) for c in np.unique(cells)]
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1].to_pylist() for r in rows], pa.list_(part.column(0).type)), pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary())], ["cell", "ids", "vectors", "reach"])

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells = batch.column(2).to_numpy()
                for c in np.unique(cells):
                    for at in np.array_split(places := np.flatnonzero(cells == c), -(-len(places) // ROWS)):
                        rows = batch.take(pa.array(at))
                        vectors = unit(matrix(rows.column(1), dimensions)[1].astype(np.float32))
                        yield pa.RecordBatch.from_arrays([pa.array([int(c)], pa.int32()), pa.array([rows.column(0).to_pylist()], pa.list_(rows.column(0).type)), pa.array([vectors.tobytes()], pa.binary())], ["cell", "members", "held"])

        def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, raw, reach, members, held = (batch.column(c)[i] for c in range(5))
                    q, v = (np.frombuffer(x.as_py(), np.float32).reshape(-1, dimensions) for x in (raw, held))
                    near = apart(codes(q), codes(v)) <= np.frombuffer(reach.as_py(), np.int16)[:, None]
                    which, what = np.nonzero(near)
                    score = np.einsum("ij,ij->i", q[which].astype(np.float64), v[what].astype(np.float64))
                    order = np.lexsort((-score, which))
                    which, what, score = which[order], what[order], score[order]
                    place = np.arange(len(which)) - np.searchsorted(which, which)
                    counts, best = near.sum(axis=1), place < limit
                    yield pa.RecordBatch.from_arrays([ids.values.take(pa.array(which[best])), members.values.take(pa.array(what[best])), pa.array(score[best]), pa.array(np.where(place == 0, counts[which], 0)[best])], ["query_id", "id", "similarity", "compared"])

        asked = queries.where(F.size("embedding") == dimensions).select("id", "embedding").mapInArrow(dealt, f"cell int, ids array<{kind}>, vectors binary, reach binary")
        held = self.vectors.select("id", "embedding", "cell").mapInArrow(blocks, f"cell int, members array<{mine}>, held binary")
        pairs = asked.join(held, "cell").select("ids", "vectors", "reach", "members", "held").mapInArrow(compared, f"query_id {kind}, id {mine}, similarity double, compared long")
        by = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")  # `limit` rows a pair of blocks at most
        return pairs.withColumn("rank", F.row_number().over(by)).withColumn("compared", F.sum("compared").over(Window.partitionBy("query_id"))).where(F.col("rank") <= limit)
