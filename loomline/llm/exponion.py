"""Operator 13: k-means in whole numbers by exponion search.

(Newling and Fleuret, 2016.)  Every vector carries an upper bound on the distance
to its centroid and a lower bound on that to any other.  After a round the bounds
are loosened by how far centroids have moved; a vector whose upper bound stays
below the lower one keeps its centroid unseen.  Otherwise the upper bound is made
exact, and if that does not settle it, only centroids within 2 u + s of the
current one are compared, u the exact distance and s the distance from the
current centroid to its nearest neighbour: a prefix of the current centroid's
list of all others by distance.  That ball holds the nearest and the second
nearest centroid, and the radius is inclusive, so that a centroid exactly as far
away, of smaller number, is found: ties are won by the smaller number.  Bounds
are rounded outwards (a few parts in 10^12), distances themselves are whole
numbers.

Vectors are packed in blocks: a row is up to ROWS vectors with their numbers and
bounds, and what the block adds to each centroid's sum and count.  A round is one
pass over the blocks, without a shuffle, written to the shared folder (the one
before is then deleted: two copies at most); the sums are read back by themselves
and added up in Spark.  Only k x d sums, k centroids and their distances pass
through the driver; they do not grow with the data.  A vector that many rows share
is as many rows of some blocks: nothing is gathered by its value.

Defined results: vectors that are null, of another length, or with a null or
non-finite component are left out; fewer vectors than k give fewer centroids, none
an empty result; a vector without an id can be a centroid only after all with one;
repeated rows are kept and each counts; other columns are not read.  Components are
whole numbers below 2^26 in size, so that every distance fits a long; a larger one is an
error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import discard, staged, table

#: Vectors of one block.
ROWS = 8192
#: A squared distance of d components fits a long below this for d = 64; products are exact in floating point below EXACT.
LARGEST, EXACT = 1 << 26, 1 << 22
#: Bounds are rounded outwards by this share.
SLACK = 1e-11
BLOCKS = "ids binary, vectors binary, number binary, upper binary, lower binary, sums binary"


@dataclass
class Centroids:
    """Integer centroids, and what a search needs to know of them."""

    values: np.ndarray
    moved: np.ndarray = field(default_factory=lambda: np.zeros(0))  # at least how far each went in the last round

    def __post_init__(self) -> None:
        k = len(self.values)
        if not len(self.moved):
            self.moved = np.zeros(k)
        squared = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y, strict=True)) for y in self.values] for x in self.values]
        apart = np.array(squared, np.float64).reshape(k, k) ** 0.5
        # the others of each, by distance; its own place is first
        apart[np.arange(k), np.arange(k)] = -1
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.radius = np.sort(apart, axis=1) * (1 - SLACK)
        self.radius[:, :1] = 0
        self.nearest = self.radius[:, 1] if k > 1 else np.zeros(k)


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to one centroid."""
    apart = vectors - centroid
    if len(apart) and max(-int(apart.min()), int(apart.max())) < EXACT:
        real = apart.astype(np.float64)  # sums stay below 2^53
        return np.einsum("ij,ij->i", real, real).astype(np.int64)
    return np.einsum("ij,ij->i", apart, apart)


def outward(distance: np.ndarray, sign: int) -> np.ndarray:
    return np.sqrt(distance.astype(np.float64)) * (1 + sign * SLACK)


def first_search(vectors: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, upper and lower bound of vectors that have none yet."""
    n = len(vectors)
    best, second, number = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int32)
    for j, centroid in enumerate(centroids.values):
        d = squared(vectors, centroid)
        nearer = d < best
        second = np.where(nearer, best, np.minimum(second, d))
        number[nearer], best = j, np.where(nearer, d, best)
    return number, outward(best, 1), outward(second, -1)


def search(vectors: np.ndarray, number: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """As first_search, from the bounds of the round before; also how many distances were computed."""
    moved, k = centroids.moved, len(centroids.values)
    number, computed = number.copy(), 0
    # the farthest move of any other centroid
    top = np.argsort(-moved, kind="stable")
    others = np.where(np.arange(k) == top[0], moved[top[1]] if k > 1 else 0.0, moved[top[0]])
    upper, lower = upper * (1 + SLACK) + moved[number], lower * (1 - SLACK) - others[number]
    for a in range(k):
        open_ = np.flatnonzero((number == a) & (upper >= lower))
        if not len(open_):
            continue
        exact = squared(vectors[open_], centroids.values[a])
        computed += len(open_)
        upper[open_] = outward(exact, 1)
        unsettled = upper[open_] >= lower[open_]
        open_, exact = open_[unsettled], exact[unsettled]
        ball = 2 * upper[open_] + centroids.nearest[a] * (1 + 4 * SLACK)
        reach = np.searchsorted(centroids.radius[a], ball, "right")
        best, second, found = exact.copy(), np.full(len(open_), np.iinfo(np.int64).max), np.full(len(open_), a)
        for place in range(1, int(reach.max(initial=0))):
            inside = np.flatnonzero(reach > place)
            j = int(centroids.order[a, place])
            d = squared(vectors[open_[inside]], centroids.values[j])
            computed += len(inside)
            wins = (d < best[inside]) | (d == best[inside]) & (j < found[inside])
            second[inside] = np.where(wins, best[inside], np.minimum(second[inside], d))
            best[inside] = np.where(wins, d, best[inside])
            found[inside[wins]] = j
        upper[open_], lower[open_] = outward(best, 1), outward(second, -1)
        number[open_] = found
    return number, upper, lower, computed


def sums_of(vectors: np.ndarray, number: np.ndarray, k: int) -> np.ndarray:
    """k rows of the sum of each component, and the count."""
    out = np.zeros((k, vectors.shape[1] + 1), np.int64)
    for j in range(k):
        mine = number == j
        out[j, :-1], out[j, -1] = vectors[mine].sum(axis=0, dtype=np.int64), mine.sum()
    return out


def _blocks(dimensions: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, vector) rows to blocks without numbers and bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            values = rows.column(1).combine_chunks().flatten().to_numpy().reshape(-1, dimensions)
            if len(values) and max(-int(values.min()), int(values.max())) >= LARGEST:
                raise ValueError(f"a component of {LARGEST} or more: distances would not fit a long")
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.select([0]).schema) as out:
                out.write_table(rows.select([0]))
            cells = [sink.getvalue().to_pybytes(), values.astype(np.int32).tobytes(), b"", b"", b"", b""]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["ids", "vectors", "number", "upper", "lower", "sums"])

        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                if count + part.num_rows > ROWS:
                    yield block()
                    held, count = [], 0
                held.append(part)
                count += part.num_rows
        if held:
            yield block()

    return run


def vectors_in(cell: bytes, dimensions: int) -> np.ndarray:
    return np.frombuffer(cell, np.int32).reshape(-1, dimensions).astype(np.int64)


def _round(centroids: Centroids, dimensions: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, raw, number, upper, lower, _ = (batch.column(c)[i].as_py() for c in range(6))
                vectors = vectors_in(raw, dimensions)
                if number:
                    number, upper, lower, _ = search(vectors, np.frombuffer(number, np.int32), np.frombuffer(upper), np.frombuffer(lower), centroids)
                else:
                    number, upper, lower = first_search(vectors, centroids)
                cells = [ids, raw, number.astype(np.int32).tobytes(), upper.tobytes(), lower.tobytes(), sums_of(vectors, number, len(centroids.values)).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["ids", "vectors", "number", "upper", "lower", "sums"])

    return run


def _added(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sums of this task's blocks, a row for each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)  # whole numbers of any size
        for batch in batches:
            for cell in batch.column(0):
                total = total + np.frombuffer(cell.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array([str(x) for x in total], pa.string())], ["cell", "part"])

    return run


def added(blocks: DataFrame, k: int, dimensions: int) -> list[list[int]]:
    """k rows of the sum of each component and the count, over all blocks."""
    width = k * (dimensions + 1)
    parts = blocks.select("sums").mapInArrow(_added(width), "cell int, part string")
    rows = dict(parts.groupBy("cell").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect())
    return [[int(rows.get(j * (dimensions + 1) + c) or 0) for c in range(dimensions + 1)] for j in range(k)]


def whole_vectors(rows: DataFrame, vector: str, dimensions: int, scale: int) -> Column:
    """floor(scale * x) of every component, null for vectors that are left out."""
    v = F.col(f"`{vector}`")
    sound = (F.size(v) == dimensions) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floor of a double gives a long, at its limits for what is beyond them: an error later
    return F.when(v.isNotNull() & sound, F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


@dataclass
class Clustering:
    """What kmeans() leaves: blocks with their numbers, and the final centroids."""

    blocks: DataFrame
    centroids: Centroids
    dimensions: int
    key: str
    key_type: T.DataType

    def assignments(self) -> DataFrame:
        """key, cluster, distance: a row for every vector that was kept."""
        schema = T.StructType([T.StructField(self.key, self.key_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
        values, dimensions = self.centroids.values, self.dimensions

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, raw, number = (batch.column(c)[i].as_py() for c in range(3))
                    number, vectors = np.frombuffer(number, np.int32), vectors_in(raw, dimensions)
                    keys = pa.ipc.open_stream(ids).read_all().column(0).combine_chunks()
                    yield pa.RecordBatch.from_arrays([keys, pa.array(number), pa.array(squared(vectors, values[number]))], schema.names)

        return self.blocks.select("ids", "vectors", "number").mapInArrow(run, schema)

    def clusters(self) -> DataFrame:
        """cluster, centroid (array<long>): a row for each centroid."""
        rows = [(j, [int(x) for x in c]) for j, c in enumerate(self.centroids.values)]
        return self.blocks.sparkSession.createDataFrame(rows, "cluster int, centroid array<long>")


def kmeans(rows: DataFrame, seeds: Callable[[DataFrame], DataFrame], key: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024) -> Clustering:
    """Cluster the vectors of rows; seeds(kept rows: key, vector of whole numbers) orders them, the first k are the first centroids.

    A round assigns every vector, then puts every centroid that has vectors at the floor of their mean."""
    kept = rows.select(F.col(f"`{key}`"), whole_vectors(rows, vector, dimensions, scale).alias("vector")).where(F.col("vector").isNotNull())
    values = np.array([r.vector for r in seeds(kept).limit(k).select("vector").collect()], np.int64).reshape(-1, dimensions)
    if len(values) and max(-int(values.min()), int(values.max())) >= LARGEST:
        raise ValueError(f"a component of {LARGEST} or more: distances would not fit a long")
    centroids = Centroids(values)
    blocks = staged(kept.mapInArrow(_blocks(dimensions), BLOCKS))
    if not len(values):
        return Clustering(blocks, centroids, dimensions, key, rows.schema[key].dataType)
    for step in range(rounds + 1):
        before, blocks = blocks, staged(blocks.mapInArrow(_round(centroids, dimensions), BLOCKS))
        discard(before)
        if step == rounds:
            break
        totals = added(blocks, len(values), dimensions)
        new = np.array([[s // row[-1] for s in row[:-1]] if row[-1] else [int(x) for x in old] for row, old in zip(totals, centroids.values, strict=True)], np.int64)
        if (new == centroids.values).all():
            break  # every later round would do the same again
        moved = [sum((int(a) - int(b)) ** 2 for a, b in zip(x, y, strict=True)) ** 0.5 * (1 + SLACK) for x, y in zip(new, centroids.values, strict=True)]
        centroids = Centroids(new, np.array(moved))
    return Clustering(blocks, centroids, dimensions, key, rows.schema[key].dataType)


SEED = 3


def by_hash(kept: DataFrame, key: str = "vec_id") -> DataFrame:
    """Rows by SHA-256 of `SEED:<key>`; rows of one key by their vector, those without one last."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col(f"`{key}`").cast("string")), 256)
    return kept.orderBy(digest.asc_nulls_last(), "vector")


def op13_exponion_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kmeans(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), by_hash)
    rows = found.assignments()
    inertia = dict(rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect())  # a row a centroid
    named = [(j, inertia.get(j), sum(inertia.values()), ",".join(str(x) for x in c)) for j, c in enumerate(found.centroids.values)]
    clusters = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, components string").withColumn("centroid_sha256", F.sha2("components", 256))
    return rows.join(F.broadcast(clusters), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op13_sql(k: int = 8, rounds: int = 10, dimensions: int = 64) -> str:
    """The rounds one after another, every distance computed."""
    away = "list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT v.row, v.vec_id, v.x, arg_min(c.n, {{'d': {away}, 'n': c.n}}) AS n, min({away}) AS d FROM v, c{i} c GROUP BY ALL)")
        if i < rounds:
            steps.append(
                f"s{i} AS (SELECT n, j, sum(x[j])::HUGEINT AS s, count(*) AS m FROM a{i}, range(1, {dimensions + 1}) t(j) GROUP BY n, j), "
                f"m{i} AS (SELECT n, list(((s - ((s % m) + m) % m) // m)::BIGINT ORDER BY j) AS x FROM s{i} GROUP BY n), "
                f"c{i + 1} AS MATERIALIZED (SELECT c.n, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (n))"
            )
    return f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x FROM embeddings
        WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dimensions}),
      c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id::VARCHAR), x) - 1 AS n, x FROM v ORDER BY n LIMIT {k}),
      {", ".join(steps)}
      SELECT a.vec_id, a.n::INT AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.n))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
      FROM a{rounds} a JOIN c{rounds} c USING (n)"""


OP13_SQL = _op13_sql()
